"""The SQL route on disk: drops are compressed, and only rows of repeated events and foreign types are moved."""

from __future__ import annotations

import gzip
import json
import os

import pytest

from conftest import SF_SMALL
from slotwise.functions.contract import SILVER_COLUMNS
from slotwise.operators import silver_sql
from slotwise.plans import catalog
from slotwise.session import scratch_path

COMMON = {"event_type": "ad_request", "event_ts": "2031-05-18T09:00:00Z", "session_id": "s", "content_id": "c", "pod_id": "p", "break_type": "preroll", "platform": "web", "market": "IN", "campaign_id": "cmp"}


def _line(**fields):
    return json.dumps({**COMMON, **fields})


def _bronze(spark, files):
    """A bronze folder of one compressed and one plain file for each list of lines."""
    root = scratch_path(spark, "sql-odd")
    os.makedirs(f"{root}/bronze")
    for i, lines in enumerate(files):
        with gzip.open(f"{root}/bronze/part-{i}.json.gz", "wt") if i % 2 else open(f"{root}/bronze/part-{i}.json", "w") as f:
            f.write("".join(f"{x}\n" for x in lines))
    return root


ODD = [
    [
        *[_line(event_id=f"one-{i:04d}", slot_index=float(i)) for i in range(20)],
        _line(event_id="late", event_type="ad_impression", clearing_price_micros=10),
        _line(event_id="same", event_type="ad_click"),
        _line(event_id="gone"),
        _line(event_id="back", event_type="ad_weird", ingest_ts="2031-05-18T10:00:00Z"),
        _line(event_id="odd", event_type="ad_weird"),
        _line(event_id="untyped", event_type=None),
        _line(event_id=None, market="GB", ingest_ts="2031-05-18T11:00:00Z"),
        # the last of a line's double keys counts
        _line(event_id="twice-1")[:-1] + ', "event_type": "ad_weird"}',
        _line(event_id="twice-2", event_type="ad_weird")[:-1] + ', "event_type": "ad_click"}',
        _line(event_id="first")[:-1] + ', "event_id": "late", "ingest_ts": "2031-05-18T08:00:00Z"}',
        _line(event_id="cut")[:-5],
        "[]",
        "5",
        "",
    ],
    [
        _line(event_id="late", event_type="ad_impression", clearing_price_micros=20, is_late=True, ingest_ts="2031-05-18T21:00:00Z"),
        _line(event_id="same", event_type="ad_click"),
        _line(event_id="gone", event_type="ad_weird", ingest_ts="2031-05-18T10:00:00Z"),
        _line(event_id="back", ingest_ts="2031-05-18T11:00:00Z"),
        _line(event_id=None, market="US", ingest_ts="2031-05-18T12:00:00Z"),
        _line(event_id="flag", is_late="yes"),
    ],
]


@pytest.mark.parametrize("most", [1_000_000, 5, 4, -1])
def test_silver_is_the_same_whichever_way_copies_are_ranked(spark, monkeypatch, most):
    monkeypatch.setattr(silver_sql, "MOST_REPEATS", most)
    root = _bronze(spark, ODD)
    silver_sql.build_silver_sql(spark, f"{root}/bronze", f"{root}/silver")
    got = spark.read.parquet(f"{root}/silver")
    assert got.columns == list(SILVER_COLUMNS)
    rows = lambda df: sorted(map(repr, (tuple(r) for r in df.collect())))
    assert rows(got) == rows(silver_sql.silver_from_view(spark, "bronze_ad_events"))
    by_id = {r["event_id"]: r for r in got.collect()}
    assert set(by_id) == {*(f"one-{i:04d}" for i in range(20)), "late", "same", "back", "twice-2", "flag", None} and got.count() == len(by_id)
    assert by_id["late"]["clearing_price_micros"] == 20 and by_id[None]["market"] == "US" and by_id["one-0007"]["slot_index"] == 7
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
    assert not spark.catalog.tableExists("bronze_ad_events_repeats")


def test_only_rows_of_repeated_events_and_foreign_types_are_moved(spark):
    root = _bronze(spark, ODD)
    spark.read.schema(silver_sql.FILE_SCHEMA).json(f"{root}/bronze").createOrReplaceTempView("odd_bronze")
    repeats = spark.sql(silver_sql.repeats_statement("odd_bronze")).persist()
    repeats.createOrReplaceTempView("odd_repeats")
    want = spark.sql("SELECT xxhash64(id) FROM VALUES ('late'), ('same'), ('gone'), ('back'), (CAST(NULL AS STRING)) t(id)")
    assert sorted(repeats.collect()) == sorted(want.collect())
    found = spark.sql(silver_sql.few_repeats_statement("odd_bronze", "odd_repeats"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    repeats.unpersist()
    alone, ranked = plan[: plan.index("Window [")], plan[plan.index("Window [") :]
    assert "hashpartitioning(event_id" not in alone and "Sort [" not in alone and "isnull(id_hash" in alone
    assert ranked.count("hashpartitioning(event_id") == 1 and "isnotnull(id_hash" in ranked
    assert "PushedFilters: [In" not in plan and "PushedFilters: [Is" not in plan


@pytest.mark.parametrize("most", [1_000_000, -1])
def test_unreadable_instants_are_refused_whatever_the_row(spark, monkeypatch, most):
    monkeypatch.setattr(silver_sql, "MOST_REPEATS", most)
    for odd in ({}, {"event_type": "ad_weird"}, {"event_id": "one"}):
        root = _bronze(spark, [[_line(event_id="one"), _line(**{"event_id": "two", "event_ts": "garbage", **odd})]])
        with pytest.raises(Exception, match="garbage"):
            silver_sql.build_silver_sql(spark, f"{root}/bronze", f"{root}/silver")
        assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_drops_are_compressed(spark, monkeypatch):
    root = scratch_path(spark, "sql-drops")
    monkeypatch.setattr(catalog, "scratch_path", lambda *_: root)
    out = catalog.queries()["silver_sql"](spark, SF_SMALL)
    files = [f for f in os.listdir(f"{root}/bronze") if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files)
    lines = spark.read.text(f"{root}/bronze").count()
    # the lines are what they were: more than four times the size of their files
    text = sum(len(gzip.open(f"{root}/bronze/{f}").read()) for f in files)
    assert text > 4 * sum(os.path.getsize(f"{root}/bronze/{f}") for f in files)
    assert lines == catalog.queries()["beacons_raw"](spark, SF_SMALL).count() > out.count()
