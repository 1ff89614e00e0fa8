"""Hand-made edge rows (FIXTURES.md §3): marts, rounding, dedup order, dates."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import beacons_df, ts
from slotwise.operators import gold, silver


def _mart(spark, rows, **kw):
    s = silver.silver(beacons_df(spark, rows), by=("event_id",))
    return {tuple(r[k] for k in ("campaign_id", "market")): r.asDict() for r in gold.campaign_daily(s, **kw).collect()}


def test_quartile_only_key_present_with_zeros_and_absent_when_active_only(spark):
    rows = [{"event_type": "ad_quartile", "quartile": 25, "campaign_id": "cmp_q"}]
    full = _mart(spark, rows)
    r = full[("cmp_q", "GB")]
    assert (r["requests"], r["impressions"], r["completions"], r["revenue_micros"]) == (0, 0, 0, 0)
    assert r["fill_rate"] is None and r["ctr"] is None and r["ecpm"] is None
    assert _mart(spark, rows, active_only=True) == {}


def test_impressions_without_requests(spark):
    rows = [{"event_type": "ad_impression", "clearing_price_micros": 1_500_000} for _ in range(2)]
    r = _mart(spark, rows)[("spring", "GB")]
    assert r["fill_rate"] is None
    assert r["ecpm"] == pytest.approx(1500.0)
    assert r["revenue"] == pytest.approx(3.0)


def test_requests_only(spark):
    r = _mart(spark, [{} for _ in range(3)])[("spring", "GB")]
    assert r["fill_rate"] == 0.0
    assert r["ctr"] is None and r["completion_rate"] is None and r["ecpm"] is None


def test_null_clearing_price_counts_as_impression_with_zero_revenue(spark):
    r = _mart(spark, [{"event_type": "ad_impression"}])[("spring", "GB")]
    assert r["impressions"] == 1 and r["revenue_micros"] == 0 and r["ecpm"] == 0.0


def test_rounding_tie_is_half_up(spark):
    rows = [{}] * 128 + [{"event_type": "ad_impression", "clearing_price_micros": 1}]
    r = _mart(spark, rows)[("spring", "GB")]
    assert r["fill_rate"] == 0.007813


def test_ecpm_tie_single_division(spark):
    prices = [511_456] * 15 + [8_183_300 - 511_456 * 15]
    rows = [{"event_type": "ad_impression", "clearing_price_micros": p} for p in prices]
    r = _mart(spark, rows)[("spring", "GB")]
    assert r["revenue_micros"] == 8_183_300
    assert r["ecpm"] == 511.4563


def test_latest_copy_with_bad_type_drops_the_event(spark):
    rows = [
        {"event_id": "dup-00000001", "event_type": "ad_impression", "ingest_ts": "2031-05-18T10:00:00Z"},
        {"event_id": "dup-00000001", "event_type": "ad_unknown", "ingest_ts": "2031-05-18T11:00:00Z"},
    ]
    out = silver.silver(beacons_df(spark, rows), by=("event_id",)).collect()
    assert out == []


@pytest.mark.parametrize("method", ["window", "max"])
def test_equal_ingest_tie_has_one_winner_in_any_input_order(spark, method):
    a = {"event_id": "dup-00000002", "event_type": "ad_impression", "ingest_ts": "2031-05-18T10:00:00Z",
         "clearing_price_micros": 100}
    b = {**a, "clearing_price_micros": 200, "is_late": True}
    one = silver.silver(beacons_df(spark, [a, b]), by=("event_id",), method=method).collect()
    two = silver.silver(beacons_df(spark, [b, a]), by=("event_id",), method=method).collect()
    assert one == two and len(one) == 1
    assert one[0]["clearing_price_micros"] == 200  # the late copy wins the tie


def test_mixed_offsets_compare_as_instants(spark):
    from slotwise.functions.contract import BRONZE_TEXT_SCHEMA

    rows = [
        ("dup-00000003", "ad_impression", "2031-05-18T09:00:00Z", "2031-05-18T10:00:00+05:30", 10),
        ("dup-00000003", "ad_impression", "2031-05-18T09:00:00Z", "2031-05-18T06:00:00Z", 20),
    ]
    base = {f.name: None for f in BRONZE_TEXT_SCHEMA.fields}
    data = []
    for eid, et, ets, its, price in rows:
        r = {**base, "event_id": eid, "event_type": et, "event_ts": ets, "ingest_ts": its, "session_id": "s",
             "content_id": "c", "pod_id": "p", "break_type": "preroll", "platform": "web", "market": "IN",
             "campaign_id": "c", "clearing_price_micros": price}
        data.append(tuple(r[f.name] for f in BRONZE_TEXT_SCHEMA.fields))
    bronze = spark.createDataFrame(data, BRONZE_TEXT_SCHEMA)
    out = silver.silver(bronze, by=("event_id",)).collect()
    assert [r["clearing_price_micros"] for r in out] == [20]  # 06:00Z is after 04:30Z


def test_event_date_is_the_utc_date(spark):
    rows = [{"event_ts": "2031-05-18T23:30:00-05:00"}]
    out = silver.silver(beacons_df(spark, rows), by=("event_id",)).collect()
    assert out[0]["event_date"] == dt.date(2031, 5, 19)


def test_late_copy_in_next_partition_counted_once_across_partitions(spark):
    orig = {"event_id": "dup-00000004", "event_type": "ad_impression", "ingest_ts": "2031-05-18T23:00:00Z",
            "event_ts": "2031-05-18T23:00:00Z", "clearing_price_micros": 100, "dt": "2031-05-18"}
    late = {**orig, "ingest_ts": "2031-05-19T11:00:00Z", "clearing_price_micros": 600, "is_late": True,
            "dt": "2031-05-19"}
    rows = beacons_df(spark, [orig, late])
    assert silver.silver(rows, by=("dt", "event_id")).count() == 2  # per-partition dedup keeps both
    across = silver.silver(rows, by=("event_id",)).collect()
    assert len(across) == 1 and across[0]["clearing_price_micros"] == 600


def test_null_pod_key_is_its_own_group(spark):
    rows = [{"content_id": None}, {"content_id": None, "event_type": "ad_impression"}, {}]
    s = silver.silver(beacons_df(spark, rows), by=("event_id",))
    pods = {r["content_id"]: r for r in gold.pod_fill(s).collect()}
    assert set(pods) == {None, "film-7"}
    assert (pods[None]["requests"], pods[None]["impressions"], pods[None]["filled"]) == (1, 1, 1)


def test_empty_input_gives_empty_marts(spark):
    empty = beacons_df(spark, []).where(F.lit(False))
    s = silver.silver(empty, by=("event_id",))
    assert gold.campaign_daily(s).count() == 0
    assert gold.pod_fill(s).count() == 0


def test_missing_required_column_fails_without_a_job(spark):
    df = beacons_df(spark, [{}]).drop("campaign_id", "market")
    with pytest.raises(silver.ContractError, match="campaign_id"):
        silver.conform(df)


def test_single_pass_mart_equals_six_group_bys_joined(spark):
    from conftest import SF_SMALL
    from slotwise.sources import fixtures

    s = silver.silver(fixtures.beacons(spark, SF_SMALL), by=("event_id",))
    extra = silver.silver(beacons_df(spark, [{"event_type": "ad_quartile", "quartile": 50, "campaign_id": "q"}]),
                          by=("event_id",))
    s = s.unionByName(extra)
    a = gold.campaign_daily(s, active_only=True)
    b = gold.campaign_daily_by_joins(s)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert gold.campaign_daily(s).count() == a.count() + 1  # only the quartile-only key differs


def test_pod_and_campaign_totals_agree(spark):
    from conftest import SF_SMALL
    from slotwise.sources import fixtures

    s = silver.silver(fixtures.beacons(spark, SF_SMALL), by=("event_id",))
    c = gold.campaign_daily(s).agg(F.sum("requests"), F.sum("impressions"), F.sum("errors")).first()
    p = gold.pod_fill(s).agg(F.sum("requests"), F.sum("impressions"), F.sum("errors")).first()
    assert tuple(c) == tuple(p)


def test_ts_helper():
    assert ts("2031-05-18T10:00:00+05:30") == dt.datetime(2031, 5, 18, 4, 30)


def test_decimal_tie_rounds_half_up_on_the_exact_ratio(spark):
    # 50,086,900 micros over 80 impressions = 626.08625 exactly; the binary double sits just below
    prices = [626_086] * 79 + [50_086_900 - 626_086 * 79]
    rows = [{"event_type": "ad_impression", "clearing_price_micros": p} for p in prices]
    r = _mart(spark, rows)[("spring", "GB")]
    assert r["ecpm"] == 626.0863
    from slotwise.operators import reads

    s = silver.silver(beacons_df(spark, rows), by=("event_id",))
    assert reads.fill_by_slice(gold.campaign_daily(s)).first()["ecpm"] == 626.0863


def test_sql_route_reads_bronze_json_and_equals_dataframe_route(spark):
    """Bronze JSON (explicit schema) -> temp view -> SQL -> overwrite, on edge rows."""
    import json
    import os

    from slotwise.functions.contract import SILVER_COLUMNS
    from slotwise.operators import silver_sql
    from slotwise.session import scratch_path

    rows = [
        {"event_id": "dup-00000007", "event_type": "ad_impression", "event_ts": "2031-05-18T09:00:00Z",
         "ingest_ts": "2031-05-18T10:00:00+05:30", "clearing_price_micros": 10},
        {"event_id": "dup-00000007", "event_type": "ad_impression", "event_ts": "2031-05-18T09:00:00Z",
         "ingest_ts": "2031-05-18T06:00:00Z", "clearing_price_micros": 20},
        {"event_id": "evt-00000008", "event_type": "ad_request", "event_ts": "2031-05-18T23:30:00-05:00"},
        {"event_id": "evt-00000009", "event_type": "ad_unknown", "event_ts": "2031-05-18T01:00:00Z"},
    ]
    common = {"session_id": "s", "content_id": "c", "pod_id": "p", "break_type": "preroll", "platform": "web",
              "market": "IN", "campaign_id": "cmp"}
    root = scratch_path(spark, "sql-route")
    os.makedirs(f"{root}/bronze", exist_ok=True)
    with open(f"{root}/bronze/part-a.jsonl", "w") as f:
        for r in rows:
            f.write(json.dumps({**common, **r}) + "\n")
    silver_sql.build_silver_sql(spark, f"{root}/bronze", f"{root}/silver")
    got = spark.read.parquet(f"{root}/silver")
    from slotwise.functions.contract import BRONZE_TEXT_SCHEMA

    expected = silver.silver(spark.read.schema(BRONZE_TEXT_SCHEMA).json(f"{root}/bronze"), by=("event_id",))
    key = lambda df: sorted(tuple(r) for r in df.select(*SILVER_COLUMNS).collect())
    assert key(got) == key(expected)
    by_id = {r["event_id"]: r for r in got.collect()}
    assert set(by_id) == {"dup-00000007", "evt-00000008"}
    assert by_id["dup-00000007"]["clearing_price_micros"] == 20
    assert by_id["evt-00000008"]["event_date"] == dt.date(2031, 5, 19)


def test_json_records_keep_nulls(spark):
    import json

    from slotwise.operators import reads

    df = spark.createDataFrame([(1, None, 0.5)], "a int, b string, c double")
    rec = json.loads(reads.json_records(df).first()["record"])
    assert rec == {"a": 1, "b": None, "c": 0.5}


def test_money_rounds_negative_amounts_away_from_zero_and_holds_large_ones(spark):
    from slotwise.functions import money

    rows = spark.createDataFrame([(-1_500_000, 7), (1_500_000, 7), (10**15, 1), (9 * 10**18, 1_000_000), (0, 3)], "m bigint, n bigint")
    got = [r[0] for r in rows.select(money.ecpm("m", "n")).collect()]
    assert got == [-214.2857, 214.2857, 10.0**12, 9.0 * 10**9, 0.0]


def test_records_keep_null_fields_and_lines_of_tabs_are_blank(spark):
    import json

    from slotwise.operators import landing, reads

    record = reads.publish_payload(beacons_df(spark, [{}])).first()["value"]
    assert "creative_id" in json.loads(record) and len(json.loads(record)) == 19
    lines = spark.createDataFrame([("\t \t",), ("\x0b",), ("{\"a\":1}",), ("{oops",)], "value string")
    assert landing.classify(lines).count() == 2
    got = {(r["value"], r["rejected"]) for r in reads.drop_records(lines).collect()}
    assert got == {('{"a":1}', None), (None, "{oops")}
