"""The flow's dedup across days: only events that the index shows more than once are moved and ranked."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import beacons_df
from slotwise.operators import gold, silver
from slotwise.plans import flow


def _frame(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def _feed(spark):
    """Eighteen single events, one copied on two days and one that also moved to another date; two rows without an id."""
    shown = {"event_type": "ad_impression", "clearing_price_micros": 1000}
    feed = [{"event_id": f"evt-{i:08d}", "event_ts": f"2031-05-{17 + i % 2}T10:00:00+00:00"} for i in range(18)]
    for eid, first, again in (("evt-copy-1", 18, 18), ("evt-move-1", 18, 17)):
        feed.append({**shown, "event_id": eid, "event_ts": f"2031-05-{first}T20:00:00+00:00"})
        late = {"event_ts": f"2031-05-{again}T20:00:00+00:00", "ingest_ts": "2031-05-19T08:00:00+00:00", "clearing_price_micros": 1500, "is_late": True}
        feed.append({**shown, "event_id": eid, **late})
    rows = beacons_df(spark, feed).withColumn("dt", F.to_date(F.coalesce("ingest_ts", "event_ts")))
    none = rows.where("event_id IN ('evt-00000000', 'evt-00000001')").withColumn("event_id", F.lit(None).cast("string"))
    return rows.unionByName(none)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("share", [1.0, 0.0])
def test_gold_is_the_same_whichever_way_copies_are_ranked(spark, monkeypatch, share):
    monkeypatch.setattr(flow, "FEW_REPEATS", share)
    rows, lake = _feed(spark), flow.Lake.fresh(spark, "few")
    flow.run_range(spark, lake, rows)
    w3 = silver.silver(silver.silver(rows, by=("dt", "event_id")), by=("event_id",))
    marts = ((lake.campaign_daily, gold.campaign_daily(w3), gold.campaign_daily_columns()), (lake.pod_fill, gold.pod_fill(w3), gold.pod_fill_columns()))
    for _ in range(2):
        for path, want, columns in marts:
            assert _frame(flow.read_table(spark, path).select(*columns)) == _frame(want.select(*columns))
        flow.drop_partition(spark, lake.campaign_daily, "event_date", "2031-05-18")
        flow.run_day(spark, lake, rows, "2031-05-18", gate=False)
        flow.run_day(spark, lake, rows, "2031-05-19", gate=False)


def test_single_events_are_neither_moved_nor_ranked(spark):
    lake = flow.Lake.fresh(spark, "few-plan")
    flow.write_silver(spark, lake, _feed(spark))
    scope = flow.read_table(spark, lake.silver)
    days = sorted({d for d, _ in flow.date_pairs(spark, lake)})
    repeats = flow.store_repeats(spark, lake, days)
    assert {r[0] for r in repeats.read(spark).select("event_id").collect()} == {"evt-copy-1", "evt-move-1", None}
    assert (repeats.events, repeats.repeated) == (21, 3)
    repeats.events = 100
    found = flow.last_copies(spark, scope, repeats)
    assert _frame(found.select("event_id", "ingest_ts")) == _frame(silver.dedup_window(scope).select("event_id", "ingest_ts"))
    alone, ranked = _plan(found).split("LeftSemi")[0], _plan(found).split("LeftSemi")[1:]
    assert "LeftAnti" in alone + "".join(ranked) and len(ranked) == 1
    before_ranking = _plan(found)[: _plan(found).index("LeftAnti")]
    assert "hashpartitioning(event_id" not in before_ranking and "Window" not in before_ranking
    assert flow.store_repeats(spark, lake, [*days, "2031-06-01"]) is None  # the index does not hold that day


def test_input_is_read_once_and_empty_input_leaves_nothing(spark, monkeypatch):
    rows, lake = _feed(spark), flow.Lake.fresh(spark, "none")
    for run in (lambda: flow.run_day(spark, lake, rows, "2031-06-01"), lambda: flow.run_range(spark, lake, rows, "2031-06-01"), lambda: flow.run_range_gated(spark, lake, rows, "2031-06-01")):
        with pytest.raises(ValueError, match="no input rows"):
            run()
        assert not flow.table_exists(spark, lake.silver)
    monkeypatch.setattr(type(rows), "isEmpty", None)  # the write itself tells
    flow.run_range(spark, lake, rows)
    held = _frame(flow.read_table(spark, lake.silver))
    with pytest.raises(ValueError, match="no input rows"):
        flow.run_day(spark, lake, rows, "2031-06-01")
    assert _frame(flow.read_table(spark, lake.silver)) == held
