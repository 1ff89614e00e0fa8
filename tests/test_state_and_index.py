"""Streaming state, the event index, gates on the write, gated backfill, reads of written marts."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SF_SMALL, beacons_df
from slotwise.operators import gold, quality, reads, silver, silver_sql
from slotwise.plans import flow
from slotwise.session import scratch_path
from slotwise.sources import fixtures
from slotwise.streaming import jobs, stateful, topic


@pytest.fixture(scope="module")
def rows(spark):
    path = scratch_path(spark, "fixture")
    fixtures.beacons(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def lake(spark, rows):
    lake = flow.Lake.fresh(spark, "indexed")
    flow.run_range(spark, lake, rows)
    return lake


def _frame(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- ST3: last write wins in state ------------------------------------------------------


def test_state_batches_read_only_their_own_days(spark, rows):
    """Ten batches: what a batch reads is bounded by its own days' changes, not by what came before."""
    root, figures = scratch_path(spark, "ten-batches"), []
    for chunk in jobs.arrival_chunks(rows, 10):
        jobs.arrive(rows, f"{root}/bronze", chunk)
        query = stateful.lww_stream(spark, f"{root}/bronze", root, f"{root}/_checkpoint", report=figures.append)
        state = sum(op.numRowsTotal for op in query.lastProgress.stateOperators)
        arrived = rows.where(F.col("dt") <= F.lit(chunk[-1]).cast("date")).count()
    got = spark.read.parquet(f"{root}/silver").select(*silver.SILVER_COLUMNS)
    assert _frame(got) == _frame(silver.silver(rows, by=("event_id",)).select(*silver.SILVER_COLUMNS))
    assert len(figures) >= 10
    log = {str(r["day"]): r["count"] for r in spark.read.parquet(f"{root}/changes").groupBy("day").count().collect()}
    assert all(f.read <= sum(log[d] for d in f.dates) for f in figures)
    assert max(f.read for f in figures) < sum(log.values()) / 4 and all(len(f.dates) <= 6 for f in figures)
    assert figures[-1].read < 2 * figures[1].read and state < arrived / 2  # neither reads nor state follow history


def test_state_settles_moved_late_and_foreign_copies(spark):
    first = {"event_type": "ad_impression", "clearing_price_micros": 100}
    at = lambda i, **kw: {**first, "event_id": f"evt-state-{i:04d}", **kw}
    days = [
        [at(1), at(2), at(3), at(4, is_late=True, ingest_ts="2031-05-18T12:00:00Z")],
        [  # moved to the next date; replaced; latest copy of a foreign type; an older copy that arrives later
            at(1, event_ts="2031-05-19T01:00:00Z", ingest_ts="2031-05-19T02:00:00Z", clearing_price_micros=500),
            at(2, ingest_ts="2031-05-19T01:00:00Z", clearing_price_micros=600),
            at(3, ingest_ts="2031-05-19T01:00:00Z", event_type="ad_other"),
            at(4, ingest_ts="2031-05-18T11:00:00Z", clearing_price_micros=1),
        ],
        [at(2, ingest_ts="2031-05-21T09:00:00Z", clearing_price_micros=700, is_late=True)],  # 71 hours late: no shared state window
    ]
    root = scratch_path(spark, "state")
    for i, day in enumerate(days):
        jobs.arrive(beacons_df(spark, day, f"2031-05-{18 + i}"), f"{root}/bronze", [f"2031-05-{18 + i}"])
        stateful.lww_stream(spark, f"{root}/bronze", root, f"{root}/_checkpoint")
    got = {(r["event_id"][-1], str(r["event_date"])): (r["clearing_price_micros"], r["too_late"]) for r in spark.read.parquet(f"{root}/silver").collect()}
    assert got == {("1", "2031-05-19"): (500, False), ("2", "2031-05-18"): (700, True), ("4", "2031-05-18"): (100, False)}


def test_state_keeps_a_hot_event_as_one_row(spark):
    root = scratch_path(spark, "hot-state")
    hot = [{"event_id": "evt-hot-000001", "bid_floor_micros": i, "ingest_ts": f"2031-05-18T10:{i % 60:02d}:{i // 60:02d}Z"} for i in range(300)]
    jobs.arrive(beacons_df(spark, hot + [{}] * 20), f"{root}/bronze", ["2031-05-18"])
    query = stateful.lww_stream(spark, f"{root}/bronze", root, f"{root}/_checkpoint")
    assert sum(op.numRowsTotal for op in query.lastProgress.stateOperators) <= 2 * 21
    out = spark.read.parquet(f"{root}/silver").where("event_id = 'evt-hot-000001'").collect()
    assert [r["bid_floor_micros"] for r in out] == [299]


# --- ST4, ST2, S14 -----------------------------------------------------------------------


def test_closed_days_stay_and_open_days_are_absent(spark):
    root = scratch_path(spark, "closed")
    feeds = [
        [{"event_id": "evt-open-0001"}, {"event_id": "evt-open-0001", "is_late": True}, {"event_id": "evt-open-0002"}],
        [{"event_id": "evt-open-0003", "event_ts": "2031-05-20T11:00:00Z"}],  # 35 hours after the end of the 18th: not closed
        [{"event_id": "evt-open-0004", "event_ts": "2031-05-20T12:00:01Z"}],
        [{"event_id": "evt-open-0005", "event_ts": "2031-05-18T09:00:00Z"}],  # the 18th is closed
    ]
    seen = []
    for i, feed in enumerate(feeds):
        jobs.arrive(beacons_df(spark, feed, f"2031-06-0{i + 1}"), f"{root}/bronze", [f"2031-06-0{i + 1}"])
        stateful.closed_days_stream(spark, f"{root}/bronze", f"{root}/out", f"{root}/_checkpoint")
        seen.append({str(r["event_date"]): r["requests"] for r in spark.read.schema("event_date date, requests long").parquet(f"{root}/out").collect()})
    assert seen == [{}, {}, {"2031-05-18": 2}, {"2031-05-18": 2}]


def test_lateness_split_has_its_border_on_time(spark):
    root = scratch_path(spark, "split")
    feed = [{"ingest_ts": None}, {"ingest_ts": "2031-05-19T22:00:00Z"}, {"ingest_ts": "2031-05-19T22:00:01Z"}]
    jobs.arrive(beacons_df(spark, feed), f"{root}/bronze", ["2031-05-18"])
    for _ in range(2):  # a second run has nothing to add
        stateful.lateness_split_stream(spark, f"{root}/bronze", f"{root}/received", f"{root}/_checkpoint")
    sides = {s: stateful.side_of(spark, f"{root}/received", s) for s in (stateful.ON_TIME, stateful.TOO_LATE)}
    assert [r["event_id"] for r in sides["too_late"].collect()] == ["evt-00000002"] and sides["on_time"].count() == 2
    assert "PartitionFilters: [isnotnull(side" in _plan(sides["too_late"])


def test_topic_resumes_without_loss_or_repeat(spark):
    root = scratch_path(spark, "topic")
    lines = fixtures.drop_lines(spark, SF_SMALL).where("e < 200")
    records = lines.select(F.col("e").cast("string").alias("key"), "value", F.col("dt").cast("timestamp").alias("timestamp"))
    topic.publish(records.repartition(5), f"{root}/topic")
    stopped = []

    def stop_at(batch):
        def stop(batch_id):
            stopped.append(batch_id)
            if batch_id == batch:
                raise RuntimeError("stop")

        return stop

    for batch in (0, 2):  # each run ends between a write and its commit
        with pytest.raises(StreamingQueryException):
            topic.land_topic(spark, topic.records(spark, f"{root}/topic"), f"{root}/landed", f"{root}/_c", stop_at(batch))
    query = topic.land_topic(spark, topic.records(spark, f"{root}/topic", files_per_batch=2), f"{root}/landed", f"{root}/_c", stop_at(-1))
    assert stopped[:4] == [0, 0, 1, 2] and query.lastProgress.batchId >= 3
    from slotwise.operators import landing

    want = landing.classify(lines.select("e", "value")).groupBy("status").count()
    assert _frame(spark.read.parquet(f"{root}/landed").groupBy("status").count()) == _frame(want)
    options = topic.kafka_options("broker:9092", "beacons", 5000)
    assert options["maxOffsetsPerTrigger"] == "5000" and options["startingOffsets"] == "earliest"


def test_a_batch_of_one_file_and_one_day_is_landed_by_many_tasks(spark):
    root = scratch_path(spark, "topic")
    lines = fixtures.drop_lines(spark, SF_SMALL).where("e < 200").withColumn("dt", F.lit("2031-05-18").cast("date"))
    records = lines.select(F.col("e").cast("string").alias("key"), "value", F.col("dt").cast("timestamp").alias("timestamp"))
    topic.publish(records.repartition(1), f"{root}/topic")
    topic.land_topic(spark, topic.records(spark, f"{root}/topic"), f"{root}/landed", f"{root}/_c")
    landed = spark.read.parquet(f"{root}/landed")
    assert landed.count() == 195 and len(landed.inputFiles()) > 1  # 5 of 200 lines are blank


# --- reading: rows are dealt without a sort ------------------------------------------------


def test_tables_are_dealt_without_sorting_each_split(spark):
    events = fixtures.read_table(spark, SF_SMALL, "events")
    assert "RoundRobinPartitioning" not in _plan(events) and "hashpartitioning(event_id" in _plan(events)
    sizes = events.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * min(r["count"] for r in sizes)


# --- ST3: events whose copies carry different dates --------------------------------------


def test_spread_events_of_a_batch(spark):
    import datetime as dt

    day = dt.date(2031, 5, 18)
    rows = [("two", day, 0), ("two", day + dt.timedelta(days=1), 1), ("one", day, 0), ("one", day, 1), ("old", day, 0)]
    rows += [("old", day + dt.timedelta(days=1), 0), ("half", None, 0), ("half", day, 1), ("none", None, 1), (None, day, 0), (None, day + dt.timedelta(days=1), 1)]
    raw = spark.createDataFrame(rows, "event_id string, event_date date, batch_id long")
    found = jobs.spread_events(raw, 1)
    assert sorted(r[0] for r in found.collect()) == ["half", "two"]
    assert "Join" not in _plan(found) and "ObjectHashAggregate" not in _plan(found)


def test_batches_without_moved_events_look_up_no_copies(spark):
    root = scratch_path(spark, "still")
    jobs.arrive(beacons_df(spark, [{}, {}]), f"{root}/bronze", ["2031-05-18"])
    jobs.repair_stream(spark, f"{root}/bronze", f"{root}/raw", f"{root}/silver", f"{root}/_c")
    assert spark.read.parquet(f"{root}/silver").count() == 2
    assert not flow.table_exists(spark, f"{root}/raw_moved") and not flow.table_exists(spark, f"{root}/raw_spread-0")


# --- D8 / G2: the event index --------------------------------------------------------------


@pytest.mark.parametrize("broadcast", [-1, 10_000_000])
def test_finding_moved_events_never_moves_the_index(spark, lake, broadcast):
    index = flow.read_index(spark, lake)
    ids = flow.read_table(spark, lake.silver).where("dt = DATE'2024-01-05'").select("event_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plan = _plan(flow.moved_copies(index, ids))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = plan[: plan.index("event_index_")]
    assert "Bucketed: true" in plan and "Exchange" not in above.replace("BroadcastExchange", "")
    assert "ReadSchema: struct<event_id:string,event_date:date>" in plan


def test_spread_events_of_the_whole_index_are_found_in_place(spark, lake):
    index = flow.read_index(spark, lake)
    found = flow.spread_events(index)
    plan = _plan(found)
    assert not any(x in plan for x in ("Exchange", "Join", "ObjectHashAggregate", "SortAggregate"))
    every = flow.moved_copies(index, index.select("event_id"))
    assert _frame(found) == _frame(every.select("event_id").distinct())


def test_index_follows_silver(spark, rows, lake):
    columns = ["event_id", "event_date", "dt"]
    stored = lambda: _frame(flow.read_index(spark, lake).select(*columns))
    held = lambda: _frame(flow.read_table(spark, lake.silver).select(*columns))
    assert stored() == held()
    name, _ = flow.open_index(spark, lake)
    spark.sql(f"DROP TABLE {name}")  # as a new session finds it
    assert stored() == held()
    day = rows.where("dt = DATE'2024-01-07'")
    flow.run_day(spark, lake, day.withColumn("event_type", F.lit("ad_gone")), "2024-01-07", gate=False)
    assert stored() == held() and not [x for x in stored() if "2024, 1, 7)" in x.rsplit("datetime", 1)[1]]
    flow.drop_folder(spark, lake.event_index)  # a lake written without one
    spark.sql(f"DROP TABLE {name}")
    flow.run_day(spark, lake, rows, "2024-01-07", gate=False)
    assert stored() == held()


def test_gold_files_follow_the_size_of_a_day(spark, rows, monkeypatch):
    monkeypatch.setattr(flow, "GOLD_ROWS_PER_FILE", 4)
    fine = gold.grain_counts(silver.silver(rows.where("dt <= DATE'2024-01-03'"), by=("event_id",)), gold.FINE_KEYS)
    files = flow.gold_files(fine)
    assert files["2024-01-03"] == -(-fine.where("event_date = DATE'2024-01-03'").count() // 4) > 1
    lake = flow.Lake.fresh(spark, "files")
    flow.run_day(spark, lake, rows, "2024-01-03", gate=False)
    got = flow.read_table(spark, lake.pod_fill).where("event_date = DATE'2024-01-03'").select(*gold.pod_fill_columns())
    want = gold.pod_fill_from_counts(fine).where("event_date = DATE'2024-01-03'")
    assert got.count() == want.count()


# --- Q1-Q8 on the write, gated backfill ------------------------------------------------------


def test_gate_of_the_write_equals_the_gate_of_the_tables(spark, rows, monkeypatch):
    odd = fixtures.with_odd_days(rows)
    lake = flow.Lake.fresh(spark, "observed")
    for ds in ("2024-01-03", "2024-01-04", "2024-01-06"):
        _, report = flow.run_day_observed(spark, lake, odd, ds)
        assert _frame(report) == _frame(flow.gate_report(spark, lake, [ds]))
    monkeypatch.setattr(flow, "gate_report", None)  # the day flow does not read the tables back
    flow.run_day(spark, lake, odd, "2024-01-05")
    with pytest.raises(quality.GateFailed, match="no ad requests"):
        flow.run_day(spark, lake, odd, "2024-01-06")


def test_gate_of_a_day_that_only_brings_late_copies(spark, rows):
    lake = flow.Lake.fresh(spark, "late-only")
    flow.run_day(spark, lake, rows, "2024-01-05")
    late = rows.where("dt = DATE'2024-01-06' AND is_late AND to_date(event_ts) = DATE'2024-01-05'")
    _, report = flow.run_day_observed(spark, lake, late, "2024-01-06")
    assert _frame(report) == _frame(flow.gate_report(spark, lake, ["2024-01-06"]))
    assert quality.gate_verdicts(report).first()["passed"] is False


def test_backfill_publishes_only_days_that_pass(spark, rows):
    lake = flow.Lake.fresh(spark, "gated")
    days = [f"2024-01-{d:02d}" for d in range(2, 7)]
    flow.run_range(spark, lake, rows, days[0], days[-1])
    by_day = lambda: {str(r["event_date"]): (r["req"], r["rev"]) for r in flow.read_table(spark, lake.campaign_daily).groupBy("event_date").agg(F.sum("requests").alias("req"), F.sum("revenue_micros").alias("rev")).collect()}
    old = by_day()
    raised = rows.withColumn("clearing_price_micros", F.col("clearing_price_micros") + 700)
    bad = raised.where("NOT (event_type = 'ad_request' AND to_date(event_ts) = DATE'2024-01-04')")
    verdicts = {str(r["ds"]): r["passed"] for r in flow.run_range_gated(spark, lake, bad, days[0], days[-1]).collect()}
    assert verdicts["2024-01-04"] is False and all(verdicts[d] for d in days if d != "2024-01-04")
    new = by_day()
    assert new["2024-01-04"] == old["2024-01-04"]
    assert all(new[d][0] == old[d][0] and new[d][1] > old[d][1] for d in days if d != "2024-01-04")
    assert not [x for x in flow.children(spark, lake.root) if x.startswith("_staging")]
    again = flow.run_range_gated(spark, lake, raised, days[0], days[-1])
    assert again.where("passed").count() == len(verdicts) and by_day()["2024-01-04"][1] > old["2024-01-04"][1]


# --- reads of the written marts, unmatched slots, numbers as text ------------------------------


def test_reads_of_a_day_list_one_folder_and_skip_row_groups(spark, lake):
    camp, pods = flow.read_table(spark, lake.campaign_daily), flow.read_table(spark, lake.pod_fill)
    for got, pushed in (
        (reads.campaigns_daily(camp, ds="2024-01-09", campaign_id="cmp_3", market="IN"), "EqualTo(campaign_id,cmp_3)"),
        (reads.pods_fill(pods, ds="2024-01-09", break_type="midroll"), "EqualTo(break_type,midroll)"),
        (reads.day_summary(camp, "2024-01-09"), ""),
    ):
        plan = _plan(got)
        assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-09" in plan and pushed in plan
    assert "ReadSchema: struct<campaign_id:string,requests:bigint,impressions:bigint,clicks:bigint,revenue_micros:bigint>" in plan
    one = flow.read_table(spark, lake.campaign_daily).where("event_date = DATE'2024-01-09'").select("campaign_id", "market").collect()
    assert [tuple(r) for r in one] == sorted(tuple(r) for r in one)  # the file order that lets row groups be skipped


def test_unmatched_slots_of_null_repeated_and_hot_keys(spark):
    shown = {"event_type": "ad_impression", "clearing_price_micros": 1}
    ended = {"event_type": "ad_quartile", "quartile": 100}
    hot = [{**shown, "session_id": "hot", "slot_index": 1}] * 200
    feed = [{**shown, "pod_id": None}, {**ended, "pod_id": None}, {**shown, "slot_index": 2}, {**ended, "slot_index": 3}, {**ended, "slot_index": 3, "event_ts": "2031-05-17T10:00:00Z"}]
    feed += [{"event_type": "ad_quartile", "quartile": 75, "slot_index": 9}, *hot]
    found = reads.unmatched_slots(silver.silver(beacons_df(spark, feed), by=("event_id",)))
    got = {(r["session_id"], r["slot_index"]): (r["side"], str(r["event_date"]), r["beacons"]) for r in found.collect()}
    assert got == {("s1", 2): ("impression_only", "2031-05-18", 1), ("s1", 3): ("completion_only", "2031-05-17", 2), ("hot", 1): ("impression_only", "2031-05-18", 200)}
    plan = _plan(found)
    assert "FullOuter" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_both_routes_read_text_integers_exactly(spark):
    texts = ["9007199254740993", "12.0", "1e3", "-7", "1.5", "x", "", "99999999999999999999", None]
    row = beacons_df(spark, [{"bid_floor_micros": 1}] * len(texts)).drop("dt", "bid_floor_micros", "event_date").coalesce(1)
    values = spark.createDataFrame([(f"evt-{i:08d}", t) for i, t in enumerate(texts)], "event_id string, bid_floor_micros string")
    feed = row.join(values, "event_id")
    feed.select([F.col(f.name).cast("boolean" if f.name == "is_late" else "string") for f in silver_sql.FILE_SCHEMA.fields]).createOrReplaceTempView("texts")
    want = [9007199254740993, 12, 1000, -7, None, None, None, None, None]
    for out in (silver.silver(feed, by=("event_id",)), silver_sql.silver_from_view(spark, "texts")):
        assert [r["bid_floor_micros"] for r in out.orderBy("event_id").collect()] == want


def test_landing_reports_what_it_wrote(spark):
    from slotwise.operators import landing

    lines = fixtures.drop_lines(spark, SF_SMALL).select("value", "dt", "src")
    root = scratch_path(spark, "counted")
    stamp = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)
    n_ok, n_bad = landing.land(lines, root, landed_at=stamp)
    got = {r["status"]: r["count"] for r in spark.read.parquet(root).groupBy("status").count().collect()}
    assert got == {"ok": n_ok, "bad": n_bad} and n_ok and n_bad
