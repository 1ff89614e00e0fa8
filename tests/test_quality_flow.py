"""Gate rules (one failing day each), day/range flows, re-runs, streaming replay."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, beacons_df
from slotwise.operators import gold, quality, reads, silver
from slotwise.plans import flow
from slotwise.sources import fixtures


def _healthy_day(n_req=60, n_imp=48):
    return [{}] * n_req + [{"event_type": "ad_impression", "clearing_price_micros": 1000}] * n_imp


def _verdict(spark, rows, mart_rows=None, built=True):
    b = beacons_df(spark, rows)
    per_dt = silver.silver(b, by=("dt", "event_id"))
    if not built:
        mart = None
    elif mart_rows is not None:
        mart = mart_rows
    else:
        mart = gold.campaign_daily(silver.silver(b, by=("event_id",)))
    report = quality.gate_report(per_dt, mart)
    v = quality.gate_verdicts(report).collect()
    return report, {str(r["ds"]): (r["passed"], r["message"]) for r in v}


def test_healthy_day_passes(spark):
    report, v = _verdict(spark, _healthy_day())
    assert v == {"2031-05-18": (True, None)}
    quality.enforce(report, "2031-05-18")


def test_too_small(spark):
    _, v = _verdict(spark, _healthy_day(29, 20))
    assert v["2031-05-18"] == (False, "only 49 silver rows arrived on 2031-05-18")


def test_no_requests(spark):
    _, v = _verdict(spark, [{"event_type": "ad_click"}] * 60)
    assert v["2031-05-18"][1] == "day holds no ad requests"


def test_impressions_far_above_requests(spark):
    _, v = _verdict(spark, _healthy_day(50, 58))
    assert v["2031-05-18"][1] == "58 impressions against 50 requests"


def test_no_gold_rows_and_no_silver(spark):
    b = beacons_df(spark, _healthy_day())
    other_day = gold.campaign_daily(silver.silver(b, by=("event_id",))).withColumn(
        "event_date", F.lit("2031-05-17").cast("date")
    )
    report = quality.gate_report(silver.silver(b, by=("dt", "event_id")), other_day)
    v = {str(r["ds"]): r["message"] for r in quality.gate_verdicts(report).collect()}
    assert v["2031-05-18"] == "campaign mart has no rows dated 2031-05-18"
    assert v["2031-05-17"] == "no silver rows arrived on 2031-05-17"  # first rule wins


def test_negative_revenue(spark):
    b = beacons_df(spark, _healthy_day())
    mart = gold.campaign_daily(silver.silver(b, by=("event_id",))).withColumn("revenue_micros", F.lit(-1).cast("bigint"))
    _, v = _verdict(spark, _healthy_day(), mart_rows=mart)
    assert v["2031-05-18"][1] == "campaign mart holds negative revenue"


@pytest.mark.parametrize("n_imp,shown", [(6, "0.100"), (60, "1.000")])
def test_fill_rate_band(spark, n_imp, shown):
    _, v = _verdict(spark, _healthy_day(60, n_imp))
    assert v["2031-05-18"] == (False, f"mean fill rate out of bounds: {shown}")
    with pytest.raises(quality.GateFailed, match="mean fill rate"):
        quality.enforce(_verdict(spark, _healthy_day(60, n_imp))[0], "2031-05-18")


def test_mart_not_built_skips_gold_rules(spark):
    _, v = _verdict(spark, _healthy_day(60, 6), built=False)
    assert v["2031-05-18"] == (True, None)


def test_table_checks_pass_on_fixture(spark):
    s = silver.silver(fixtures.beacons(spark, SF_SMALL), by=("event_id",))
    out = quality.not_null_report(gold.campaign_daily(s), gold.pod_fill(s), s).collect()
    assert len(out) == 10 and all(r["passed"] for r in out)


# --- flows -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def fixture_rows(spark):
    return fixtures.beacons(spark, SF_SMALL)


def _frame(df):
    return sorted(tuple(r) for r in df.collect())


def test_day_by_day_equals_backfill_equals_rebuild(spark, fixture_rows):
    expected = _frame(gold.campaign_daily(silver.silver(fixture_rows, by=("event_id",))))
    lake = flow.Lake.fresh(spark, "flow-test")
    dts = sorted(str(r[0]) for r in fixture_rows.select("dt").distinct().collect())
    for ds in dts[:6]:
        flow.run_day(spark, lake, fixture_rows, ds, gate=False)
    flow.run_range(spark, lake, fixture_rows, start=dts[6])
    got = flow.read_table(spark, lake.campaign_daily).select(*gold.campaign_daily_columns())
    assert _frame(got) == expected
    for ds in dts[:6]:  # G4: re-running changes nothing
        flow.run_day(spark, lake, fixture_rows, ds, gate=False)
    assert _frame(flow.read_table(spark, lake.campaign_daily).select(*gold.campaign_daily_columns())) == expected
    assert flow.latest_partition(spark, lake.silver).first()[0].isoformat() == dts[-1]
    assert {r["table"]: r["available"] for r in flow.health(spark, lake).collect()} == {
        "campaign_daily": True,
        "pod_fill": True,
    }


def test_event_date_other_than_dt_rerun_twice_is_stable(spark):
    rows = beacons_df(spark, [{"event_ts": "2031-05-17T23:00:00Z", "dt": "2031-05-18"}, {"dt": "2031-05-18"}])
    lake = flow.Lake.fresh(spark, "d8")
    for _ in range(2):
        flow.run_day(spark, lake, rows, "2031-05-18", gate=False)
    mart = flow.read_table(spark, lake.campaign_daily).collect()
    assert sorted((str(r["event_date"]), r["requests"]) for r in mart) == [("2031-05-17", 1), ("2031-05-18", 1)]


def test_run_day_enforces_gate(spark):
    rows = beacons_df(spark, _healthy_day(10, 5))
    lake = flow.Lake.fresh(spark, "gate")
    with pytest.raises(quality.GateFailed, match="silver rows arrived"):
        flow.run_day(spark, lake, rows, "2031-05-18")


def test_mart_not_built(spark):
    lake = flow.Lake.fresh(spark, "none")
    with pytest.raises(flow.MartNotBuilt):
        flow.read_table(spark, lake.campaign_daily, "campaign_daily")
    assert not flow.table_exists(spark, lake.pod_fill)


# --- reads --------------------------------------------------------------------------------


def test_read_parameters(spark, fixture_rows):
    mart = gold.campaign_daily(silver.silver(fixture_rows, by=("event_id",)))
    with pytest.raises(ValueError):
        reads.campaigns_daily(mart, limit=0)
    with pytest.raises(ValueError):
        reads.campaigns_daily(mart, limit=1001)
    day = str(mart.agg(F.max("event_date")).first()[0])
    top = reads.campaigns_daily(mart, ds=day, campaign_id="", market="IN", limit=5).collect()
    assert 0 < len(top) <= 5 and all(str(r["event_date"]) == day and r["market"] == "IN" for r in top)
    assert [r["revenue_micros"] for r in top] == sorted((r["revenue_micros"] for r in top), reverse=True)
    s = reads.day_summary(mart, day).first()
    assert s["requests"] > 0 and 0 < s["fill_rate"] <= 1
    with pytest.raises(reads.NotFound):
        reads.day_summary(mart, "1999-01-01")


def test_snapshot_document_matches_tables(spark, fixture_rows):
    import json

    s = silver.silver(fixture_rows, by=("event_id",))
    camp, pods = gold.campaign_daily(s), gold.pod_fill(s)
    docs = {str(r["event_date"]): json.loads(r["payload"]) for r in reads.report_snapshot(camp, pods).collect()}
    day = max(docs)
    doc = docs[day]
    top = reads.campaigns_daily(camp, ds=day, limit=40).collect()
    assert [c["campaign_id"] for c in doc["campaigns"]] == [r["campaign_id"] for r in top]
    assert len(doc["pods"]) <= 30 and doc["summary"]["ds"] == day
    summary = reads.day_summaries(camp).where(F.col("ds") == F.lit(day).cast("date")).first()
    assert doc["summary"]["requests"] == summary["requests"]


def test_formatting_ties(spark):
    from slotwise.functions import formatting as fmt

    df = spark.createDataFrame([(293.455, 0.8083333, None), (1.005, 0.0078125, 0.0)], "x double, r double, z double")
    out = df.select(fmt.num("x", 2).alias("n"), fmt.pct("r").alias("p"), fmt.pct("z").alias("z")).collect()
    assert [tuple(r) for r in out] == [("293.46", "80.8%", "—"), ("1.01", "0.8%", "0.0%")]


# --- streaming replay ----------------------------------------------------------------------


def test_repair_batch_replay_is_harmless(spark):
    from slotwise.session import scratch_path
    from slotwise.streaming.jobs import _rebuild

    root = scratch_path(spark, "replay")
    orig = {"event_id": "dup-00000009", "event_type": "ad_impression", "clearing_price_micros": 100,
            "ingest_ts": "2031-05-18T10:00:00Z"}
    late = {**orig, "clearing_price_micros": 600, "ingest_ts": "2031-05-18T22:00:00Z", "is_late": True}
    step = _rebuild(spark, f"{root}/raw", f"{root}/silver")
    step(beacons_df(spark, [orig, {}]), 0)
    step(beacons_df(spark, [late]), 1)
    step(beacons_df(spark, [late]), 1)  # replayed batch
    out = spark.read.parquet(f"{root}/silver").collect()
    prices = sorted((r["event_type"], r["clearing_price_micros"]) for r in out)
    assert prices == [("ad_impression", 600), ("ad_request", None)]
    from slotwise.streaming.jobs import too_late

    assert too_late(spark, f"{root}/raw").count() == 0


def test_end_to_end_from_drop_lines(spark):
    """land (strict timestamps) -> bronze -> silver -> gold -> gate, for one day."""
    from slotwise.operators import landing

    lines = fixtures.drop_lines(spark, SF_SMALL)
    ds = str(lines.agg(F.min("dt")).first()[0])
    lake = flow.Lake.fresh(spark, "e2e")
    with pytest.raises(flow.MartNotBuilt):
        flow.read_bronze_day(spark, lake, ds)
    day = lines.where(F.col("dt") == F.lit(ds).cast("date")).select("value", "dt", "src")
    n_ok, n_bad = landing.land(day, lake.landed, strict_timestamps=True)
    assert n_ok > 0 and n_bad > 0
    flow.silver_day_from_landed(spark, lake, ds)
    touched = flow.refresh_gold(spark, lake, [ds])
    assert touched == [ds]
    s = flow.read_table(spark, lake.silver).collect()
    assert len(s) == n_ok and all(r["event_type"] == "ad_request" for r in s)
    with pytest.raises(ValueError, match="no valid landed rows"):
        flow.read_bronze_day(spark, lake, "1999-01-01")
    names = flow.register_views(spark, lake)
    assert set(names) == {"ad_events_silver", "fct_campaign_daily", "fct_pod_fill"}
    assert spark.table("fct_campaign_daily").agg(F.sum("requests")).first()[0] == n_ok


def test_rerun_day_that_lost_all_rows_clears_its_partitions(spark):
    lake = flow.Lake.fresh(spark, "cleared")
    flow.run_day(spark, lake, beacons_df(spark, [{}, {"event_type": "ad_impression"}]), "2031-05-18", gate=False)
    assert flow.read_table(spark, lake.campaign_daily).count() == 1
    touched = flow.run_day(spark, lake, beacons_df(spark, [{"event_type": "ad_gone"}]), "2031-05-18", gate=False)
    assert touched == ["2031-05-18"]
    for table, part in ((lake.silver, "dt"), (lake.campaign_daily, "event_date"), (lake.pod_fill, "event_date")):
        assert not flow.table_exists(spark, f"{table}/{part}=2031-05-18")


def test_withdrawn_late_copy_restores_the_original(spark):
    """Day 19 carried a late copy of an event of the 18th; delivered again without it, the 18th goes back."""
    seen = {"event_id": "evt-late-0001", "event_type": "ad_impression", "clearing_price_micros": 100}
    late = {**seen, "clearing_price_micros": 600, "is_late": True, "ingest_ts": "2031-05-19T01:00:00Z", "dt": "2031-05-19"}
    other = {"event_id": "evt-other-001", "event_ts": "2031-05-19T10:00:00Z", "dt": "2031-05-19"}
    lake = flow.Lake.fresh(spark, "withdrawn")
    flow.run_range(spark, lake, beacons_df(spark, [seen, late, other]))
    revenue = lambda: {str(r["event_date"]): r["revenue_micros"] for r in flow.read_table(spark, lake.campaign_daily).collect()}
    assert revenue() == {"2031-05-18": 600, "2031-05-19": 0}
    assert flow.run_day(spark, lake, beacons_df(spark, [other]), "2031-05-19", gate=False) == ["2031-05-18", "2031-05-19"]
    assert revenue() == {"2031-05-18": 100, "2031-05-19": 0}


def test_copy_under_another_event_date_counts_once(spark):
    seen = {"event_id": "evt-moved-001", "event_type": "ad_impression", "clearing_price_micros": 100}
    moved = {**seen, "event_ts": "2031-05-19T10:00:00Z", "ingest_ts": "2031-05-19T11:00:00Z", "clearing_price_micros": 600, "dt": "2031-05-19"}
    more = {"event_id": "evt-more-0001", "ingest_ts": "2031-05-20T01:00:00Z", "dt": "2031-05-20"}
    lake = flow.Lake.fresh(spark, "moved")
    for day, rows in (("2031-05-18", [seen]), ("2031-05-19", [moved]), ("2031-05-20", [more])):
        flow.run_day(spark, lake, beacons_df(spark, rows), day, gate=False)
    got = {str(r["event_date"]): (r["impressions"], r["revenue_micros"]) for r in flow.read_table(spark, lake.campaign_daily).collect()}
    assert got == {"2031-05-18": (0, 0), "2031-05-19": (1, 600)}


def test_missing_input_raises_and_a_missing_day_fails_the_gate(spark):
    lake = flow.Lake.fresh(spark, "missing")
    rows = beacons_df(spark, [{}])
    flow.run_day(spark, lake, rows, "2031-05-18", gate=False)
    with pytest.raises(ValueError, match="no input rows"):
        flow.run_day(spark, lake, rows, "2031-05-21", gate=False)
    verdict = quality.gate_verdicts(flow.gate_report(spark, lake, ["2031-05-21"])).collect()
    assert [(r["passed"], r["message"]) for r in verdict] == [(False, "no silver rows arrived on 2031-05-21")]


def test_chunked_backfill_equals_rebuild(spark, fixture_rows):
    expected = _frame(gold.pod_fill(silver.silver(fixture_rows, by=("event_id",))))
    lake = flow.Lake.fresh(spark, "chunked")
    flow.run_range(spark, lake, fixture_rows, chunk_days=10)
    assert _frame(flow.read_table(spark, lake.pod_fill).select(*gold.pod_fill_columns())) == expected


def test_reads_prune_partitions_and_push_filters(spark, fixture_rows):
    lake = flow.Lake.fresh(spark, "pruning")
    flow.run_range(spark, lake, fixture_rows)
    mart = flow.read_table(spark, lake.campaign_daily)
    day = str(mart.agg(F.max("event_date")).first()[0])
    top = reads.campaigns_daily(mart, ds=day, campaign_id="cmp_3", market="IN", limit=10)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and day in plan  # only one day's folder is listed
    assert "PushedFilters: [IsNotNull(campaign_id), IsNotNull(market), EqualTo(campaign_id,cmp_3)" in plan
    assert "TakeOrderedAndProject" in plan
    # a two-column question reads two columns
    narrow = flow.read_table(spark, lake.silver).where(F.col("dt") == F.lit(day).cast("date")).groupBy(
        "campaign_id"
    ).count()
    narrow_plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<campaign_id:string>" in narrow_plan
