"""Hot keys: one event id / one campaign holding a third of all rows.

The results must be whole and right, and the plans must pre-reduce in the map
tasks (partial group limit / partial aggregate) so the hot key never travels
whole to one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from slotwise.operators import gold, silver
from slotwise.sources import fixtures


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _with_hot_copies(spark):
    base = fixtures.beacons(spark, SF_SMALL)
    n = base.count()
    # n/2 extra copies of one impression = a third of the final rows, ingest spread over time
    hot = (
        base.where(F.col("event_id") == "bcn-imp-3")
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(n // 2 - 1))))  # the copies
        .withColumn("ingest_ts", F.col("ingest_ts") + F.expr("make_interval(0, 0, 0, 0, 0, 0, k)"))
        .withColumn("clearing_price_micros", F.col("k"))
        .drop("k")
    )
    return base.unionByName(hot), n


def test_hot_event_id_keeps_latest_copy(spark):
    rows, n = _with_hot_copies(spark)
    out = silver.silver(rows, by=("event_id",))
    plan = _plan(out)
    # a partial group limit sits below the exchange on event_id
    assert plan.count("WindowGroupLimit") >= 2
    hot = out.where(F.col("event_id") == "bcn-imp-3").collect()
    assert len(hot) == 1 and hot[0]["clearing_price_micros"] == n // 2 - 1
    expected = silver.silver(fixtures.beacons(spark, SF_SMALL), by=("event_id",)).count()
    assert out.count() == expected


def test_hot_campaign_is_pre_aggregated(spark):
    base = silver.silver(fixtures.beacons(spark, SF_SMALL), by=("event_id",))
    n = base.count()
    copies = F.explode(F.sequence(F.lit(1), F.lit(n // 2)))
    hot = base.limit(1).withColumn("k", copies).drop("k").withColumns(
        {"event_type": F.lit("ad_request"), "event_date": F.lit(dt.date(2024, 1, 1))}
    )
    rows = base.unionByName(hot)
    mart = gold.campaign_daily(rows)
    assert "partial_count" in _plan(mart)
    total = mart.agg(F.sum("requests")).first()[0]
    assert total == base.where(F.col("event_type") == "ad_request").count() + n // 2
