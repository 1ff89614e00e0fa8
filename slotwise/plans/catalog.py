"""The query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every entry reads the provided tables (``events``, via the fixture mapping) in
full, so its work grows with them. Keys match ``slotwise.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException

from slotwise.functions.contract import SILVER_COLUMNS
from slotwise.operators import gold, landing, quality, reads, silver, silver_sql
from slotwise.plans import flow
from slotwise.session import configure, scratch_path
from slotwise.sources import fixtures
from slotwise.streaming import jobs as streams
from slotwise.streaming import stateful, topic

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        CATALOG[name] = run
        return run

    return deco


def _silver_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-partition silver (W3) over every arrival day: the marts' input."""
    return silver.silver(fixtures.beacons(spark, sf_dir), by=("event_id",))


@register("beacons_raw")
def beacons_raw(spark, sf_dir):
    """Fixture mapping: every beacon of every slot, with its arrival ``dt``."""
    return fixtures.beacons(spark, sf_dir)


@register("silver_dedup")
def silver_dedup(spark, sf_dir):
    """Last write wins inside each arrival partition."""
    return silver.silver(fixtures.beacons(spark, sf_dir), by=("dt", "event_id"), method="window")


@register("silver_dedup_maxby")
def silver_dedup_maxby(spark, sf_dir):
    """W2 alternative: the same rows through a partial/final ``max(struct)``."""
    return silver.silver(fixtures.beacons(spark, sf_dir), by=("dt", "event_id"), method="max")


@register("silver_cross_partition")
def silver_cross_partition(spark, sf_dir):
    """A late copy that arrived in the next ``dt`` still replaces the original."""
    return _silver_all(spark, sf_dir)


@register("campaign_metrics")
def campaign_metrics(spark, sf_dir):
    """Counts and revenue per campaign grain (the intermediate model)."""
    return gold.campaign_metrics(_silver_all(spark, sf_dir))


@register("campaign_daily")
def campaign_daily(spark, sf_dir):
    """The campaign mart (all keys with any event)."""
    return gold.campaign_daily(_silver_all(spark, sf_dir))


@register("campaign_daily_active")
def campaign_daily_active(spark, sf_dir):
    """The mart restricted to keys with activity and no null key."""
    return gold.campaign_daily(_silver_all(spark, sf_dir), active_only=True)


@register("campaign_daily_joined")
def campaign_daily_joined(spark, sf_dir):
    """The six filtered group-bys joined on the keys, over beacons with null markets and quartile-only campaigns."""
    return gold.campaign_daily_by_joins(silver.silver(fixtures.with_gaps(fixtures.beacons(spark, sf_dir)), by=("event_id",)))


@register("campaign_daily_raw_rates")
def campaign_daily_raw_rates(spark, sf_dir):
    """The JVM job's variant: three counts, revenue, unrounded fill rate and eCPM."""
    return gold.campaign_daily_raw_rates(_silver_all(spark, sf_dir))


@register("pod_fill")
def pod_fill(spark, sf_dir):
    """The pod mart (null keys kept as their own group)."""
    return gold.pod_fill(_silver_all(spark, sf_dir))


# --- landing -------------------------------------------------------------------


@register("land_classify")
def land_classify(spark, sf_dir):
    """V1-V18 on defect-injected raw lines: status and broken rule ids per line."""
    return landing.classify(fixtures.drop_lines(spark, sf_dir)).select("e", "status", "error")


@register("land_counts")
def land_counts(spark, sf_dir):
    """Ok / bad counts per arrival day (blank lines are in neither)."""
    landed = landing.classify(fixtures.drop_lines(spark, sf_dir))
    return landed.groupBy("dt").agg(
        F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") == "bad").alias("n_bad"),
    )


@register("quarantine_rows")
def quarantine_rows(spark, sf_dir):
    """Rejected lines keep their raw text and rule ids."""
    landed = landing.classify(fixtures.drop_lines(spark, sf_dir))
    return landing.quarantine(landed).select("e", "raw", "error", "dt")


# --- reads, reports, analysis questions ----------------------------------------------


def _marts(spark, sf_dir):
    s = _silver_all(spark, sf_dir)
    return gold.campaign_daily(s), gold.pod_fill(s)


@register("campaigns_top")
def campaigns_top(spark, sf_dir):
    """R1 / T1 with defaults: newest day, highest revenue, 100 rows."""
    return reads.campaigns_daily(_marts(spark, sf_dir)[0])


@register("campaigns_top_filtered")
def campaigns_top_filtered(spark, sf_dir):
    """One campaign in one market, 50 rows."""
    return reads.campaigns_daily(_marts(spark, sf_dir)[0], campaign_id="cmp_3", market="IN", limit=50)


@register("pods_top")
def pods_top(spark, sf_dir):
    """R2 / T2 with defaults."""
    return reads.pods_fill(_marts(spark, sf_dir)[1])


@register("pods_top_midroll")
def pods_top_midroll(spark, sf_dir):
    """Midroll pods only, 200 rows."""
    return reads.pods_fill(_marts(spark, sf_dir)[1], break_type="midroll", limit=200)


@register("day_summary")
def day_summary(spark, sf_dir):
    """R3 / A13-A15 for every day."""
    return reads.day_summaries(_marts(spark, sf_dir)[0])


@register("report_cards")
def report_cards(spark, sf_dir):
    """Six formatted summary cards per day."""
    return reads.report_cards(reads.day_summaries(_marts(spark, sf_dir)[0]))


@register("report_campaigns")
def report_campaigns(spark, sf_dir):
    """Formatted top-25 campaign table."""
    return reads.report_campaigns(_marts(spark, sf_dir)[0])


@register("report_pods")
def report_pods(spark, sf_dir):
    """Formatted top-20 pod table."""
    return reads.report_pods(_marts(spark, sf_dir)[1])


@register("report_snapshot")
def report_snapshot(spark, sf_dir):
    """Per-day JSON document (summary, top-40 campaigns, top-30 pods)."""
    camp, pods = _marts(spark, sf_dir)
    return reads.report_snapshot(camp, pods)


SNAPSHOT_SCHEMA = (
    "summary struct<ds string, requests bigint, impressions bigint, clicks bigint, revenue double, "
    "fill_rate double, campaigns bigint>, "
    "campaigns array<struct<campaign_id string, market string, platform string, break_type string, "
    "revenue_micros bigint>>, "
    "pods array<struct<pod_id string, break_type string, content_id string, platform string, market string, "
    "requests bigint>>"
)


@register("report_snapshot_rows")
def report_snapshot_rows(spark, sf_dir):
    """R8 content check: the snapshot documents parsed back into ranked entries."""
    camp, pods = _marts(spark, sf_dir)
    doc = reads.report_snapshot(camp, pods).select("event_date", F.from_json("payload", SNAPSHOT_SCHEMA).alias("d"))
    # both sections become one array of (section, rank, item, measure): one generator, one pass over the document
    entries = """concat(
        transform(d.campaigns, (x, i) -> named_struct('section', 'campaign', 'rank', CAST(i + 1 AS BIGINT),
            'item', concat_ws('|', x.campaign_id, x.market, x.platform, x.break_type), 'measure', x.revenue_micros)),
        transform(d.pods, (x, i) -> named_struct('section', 'pod', 'rank', CAST(i + 1 AS BIGINT),
            'item', concat_ws('|', x.pod_id, x.break_type, x.content_id, x.platform, x.market), 'measure', x.requests))
    )"""
    return doc.selectExpr("event_date", f"inline({entries})")


@register("fill_by_slice")
def fill_by_slice(spark, sf_dir):
    """Ratio-of-sums fill rate and eCPM over break types."""
    return reads.fill_by_slice(_marts(spark, sf_dir)[0])


@register("midroll_break_rate")
def midroll_break_rate(spark, sf_dir):
    """Per-day share of midroll pods that requested but never filled."""
    return reads.midroll_break_rate(_marts(spark, sf_dir)[1])


@register("midroll_broken_pods")
def midroll_broken_pods(spark, sf_dir):
    """The broken midroll pods themselves."""
    return reads.midroll_broken_pods(_marts(spark, sf_dir)[1])


@register("completion_reconcile")
def completion_reconcile(spark, sf_dir):
    """Slots with an impression, a completion, or both, per day."""
    return reads.completion_reconcile(_silver_all(spark, sf_dir))


@register("unmatched_slots")
def unmatched_slots(spark, sf_dir):
    """Every slot with a completion but no impression, or the reverse, and its side."""
    return reads.unmatched_slots(_silver_all(spark, sf_dir))


@register("publish_payload")
def publish_payload(spark, sf_dir):
    """K8: topic records of silver rows, parsed back to check the round trip."""
    rec = reads.publish_payload(_silver_all(spark, sf_dir))
    schema = "event_id string, event_type string, event_ts timestamp, campaign_id string, quartile int, clearing_price_micros bigint, is_late boolean"
    parsed = rec.select("key", F.size(F.json_object_keys("value")).alias("n_keys"), F.from_json("value", schema, {"timestampFormat": reads.TS_TEXT}).alias("j"))
    return parsed.select("key", "j.*", "n_keys")


# --- quality --------------------------------------------------------------------------


@register("gate_report")
def gate_report(spark, sf_dir):
    """Q1-Q7, Q12 per day: per-dt silver against the campaign mart."""
    beacons = fixtures.beacons(spark, sf_dir)
    per_dt = silver.silver(beacons, by=("dt", "event_id"))
    mart = gold.campaign_daily(silver.silver(beacons, by=("event_id",)))
    return quality.gate_report(per_dt, mart)


@register("gate_verdicts")
def gate_verdicts(spark, sf_dir):
    """Q8: per day, pass flag and the first failed rule's message."""
    return quality.gate_verdicts(gate_report(spark, sf_dir))


def _odd_days(spark, sf_dir):
    return fixtures.with_odd_days(fixtures.beacons(spark, sf_dir))


@register("gate_odd_days")
def gate_odd_days(spark, sf_dir):
    """The gate over days with negative revenue, without requests, with too many or too few impressions."""
    rows = _odd_days(spark, sf_dir)
    return quality.gate_report(silver.silver(rows, by=("dt", "event_id")), gold.campaign_daily(silver.silver(rows, by=("event_id",))))


@register("not_null_report")
def not_null_report(spark, sf_dir):
    """Q9-Q11: not-null, uniqueness, type and range checks over the tables."""
    camp, pods = _marts(spark, sf_dir)
    return quality.not_null_report(camp, pods, _silver_all(spark, sf_dir))


# --- written tables: backfill, day re-runs, partition scans ---------------------------


def _backfilled(spark, sf_dir):
    """A fresh lake in the shared folder, backfilled from every arrival day in one job."""
    lake = flow.Lake.fresh(spark, "lake")
    rows = fixtures.beacons(spark, sf_dir)
    flow.run_range(spark, lake, rows)
    return lake, rows


def _latest_dts(spark, lake, n):
    dates = flow.read_table(spark, lake.silver_dates).select("dt").distinct().orderBy(F.col("dt").desc()).limit(n)
    return sorted(str(r[0]) for r in dates.collect())


@register("staging_projection")
def staging_projection(spark, sf_dir):
    """All silver partitions through hive discovery, 20 typed columns, no dt."""
    lake = flow.Lake.fresh(spark, "lake")
    flow.write_silver(spark, lake, fixtures.beacons(spark, sf_dir))
    return silver.staging(flow.read_table(spark, lake.silver, "silver"))


@register("latest_partition")
def latest_partition(spark, sf_dir):
    """Newest arrival partition of the written silver table, from its map of dates."""
    lake = flow.Lake.fresh(spark, "lake")
    flow.write_silver(spark, lake, fixtures.beacons(spark, sf_dir))
    return flow.latest_partition(spark, lake.silver_dates, "dt")


def _lose_gold(spark, lake, ds):
    """Delete the gold of every event date an arrival day touches, so a re-run that does nothing shows."""
    for e in sorted({e for d, e in flow.date_pairs(spark, lake) if d == ds}):
        for table in (lake.campaign_daily, lake.pod_fill):
            flow.drop_partition(spark, table, "event_date", e)


@register("gold_replace_day")
def gold_replace_day(spark, sf_dir):
    """After a backfill, the newest day's gold is lost and the day run again, which
    replaces exactly the event dates it touches; the campaign mart read back equals a full rebuild."""
    lake, rows = _backfilled(spark, sf_dir)
    for ds in _latest_dts(spark, lake, 1):
        _lose_gold(spark, lake, ds)
        flow.run_day(spark, lake, rows, ds, gate=False)
    return flow.read_table(spark, lake.campaign_daily, "campaign_daily").select(*gold.campaign_daily_columns())


def _corrected(rows):
    """The newest arrival day that holds more than late copies, delivered again: late copies withdrawn, prices raised, every 40th slot moved back a day."""
    last = rows.where(~F.col("is_late")).agg(F.max("dt")).first()[0]
    hit = F.col("dt") == F.lit(last)
    slot = F.regexp_extract("event_id", "([0-9]+)$", 1).cast("bigint")
    fixed = rows.where(~(hit & F.col("is_late"))).withColumns(
        {
            "clearing_price_micros": F.col("clearing_price_micros") + F.when(hit, F.lit(700)).otherwise(F.lit(0)),
            "event_ts": F.when(hit & (slot % 40 == 0), F.col("event_ts") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("event_ts")),
        }
    )
    return fixed, str(last)


@register("gold_corrected_day")
def gold_corrected_day(spark, sf_dir):
    """After a backfill the newest day arrives corrected and is run again;
    the campaign mart read back equals a rebuild over the corrected rows."""
    lake, rows = _backfilled(spark, sf_dir)
    fixed, last = _corrected(rows)
    flow.run_day(spark, lake, fixed, last, gate=False)
    return flow.read_table(spark, lake.campaign_daily, "campaign_daily").select(*gold.campaign_daily_columns())


@register("day_flow_gate")
def day_flow_gate(spark, sf_dir):
    """G3 / Q1-Q8 on the written lake: requested days are all reported, the day after the last one as missing."""
    lake, _ = _backfilled(spark, sf_dir)
    dts = sorted({d for d, _ in flow.date_pairs(spark, lake)})
    missing = str(dt.date.fromisoformat(dts[-1]) + dt.timedelta(days=7))
    return quality.gate_verdicts(flow.gate_report(spark, lake, [*dts, missing]))


@register("day_gate_observed")
def day_gate_observed(spark, sf_dir):
    """G3 / Q1-Q8 on the write: a passing day and one without requests, gated on what their writes observed."""
    rows = _odd_days(spark, sf_dir)
    lake = flow.Lake.fresh(spark, "lake")
    reports = []
    for (ds,) in sorted(rows.select("dt").distinct().where(F.dayofmonth("dt").isin(5, 6)).collect()):
        reports.append(flow.run_day_observed(spark, lake, rows, str(ds))[1])
    out = reports[0]
    for more in reports[1:]:
        out = out.unionByName(more)
    return out


@register("backfill_gated")
def backfill_gated(spark, sf_dir):
    """G3 backfill: all days are delivered again with raised prices, one of them without its requests;
    the campaign mart has the old rows of that day and the new ones of all others."""
    lake, rows = _backfilled(spark, sf_dir)
    raised = rows.withColumn("clearing_price_micros", F.col("clearing_price_micros") + 700)
    flow.run_range_gated(spark, lake, raised.where("NOT (event_type = 'ad_request' AND dayofmonth(event_ts) = 6)"))
    return flow.read_table(spark, lake.campaign_daily, "campaign_daily").select(*gold.campaign_daily_columns())


@register("moved_events")
def moved_events(spark, sf_dir):
    """The copies of events that carry different event dates, found by the flow through the event index."""
    lake = flow.Lake.fresh(spark, "lake")
    flow.run_range(spark, lake, fixtures.with_moved(fixtures.beacons(spark, sf_dir)))
    return spark.read.parquet(lake.moved).distinct()


def _newest_day(spark, table):
    return str(flow.latest_partition(spark, table, "event_date").first()[0])


@register("written_campaigns_day")
def written_campaigns_day(spark, sf_dir):
    """R1 / F6 / F8 on the written mart: one campaign's rows of the newest day, top 100."""
    lake, _ = _backfilled(spark, sf_dir)
    mart = flow.read_table(spark, lake.campaign_daily, "campaign_daily").select(*gold.campaign_daily_columns())
    return reads.campaigns_daily(mart, ds=_newest_day(spark, lake.campaign_daily), campaign_id="cmp_3")


@register("written_pods_day")
def written_pods_day(spark, sf_dir):
    """R2 / F7 / F8 on the written mart: midroll pods of the newest day, top 100."""
    lake, _ = _backfilled(spark, sf_dir)
    mart = flow.read_table(spark, lake.pod_fill, "pod_fill").select(*gold.pod_fill_columns())
    return reads.pods_fill(mart, ds=_newest_day(spark, lake.pod_fill), break_type="midroll")


@register("written_day_summary")
def written_day_summary(spark, sf_dir):
    """R3 / F8 / K11 on the written mart: the newest day's summary, with its JSON record."""
    lake, _ = _backfilled(spark, sf_dir)
    mart = flow.read_table(spark, lake.campaign_daily, "campaign_daily")
    day = reads.day_summary(mart, _newest_day(spark, lake.campaign_daily))
    return day.withColumn("record", reads.json_record(["ds", "requests", "impressions", "clicks", "campaigns"]))


@register("health")
def health(spark, sf_dir):
    """Which marts stand, before a backfill and after it."""
    lake = flow.Lake.fresh(spark, "lake")
    before = flow.health(spark, lake).withColumn("stage", F.lit("empty"))
    flow.run_range(spark, lake, fixtures.beacons(spark, sf_dir))
    return before.unionByName(flow.health(spark, lake).withColumn("stage", F.lit("built")))


@register("land_report")
def land_report(spark, sf_dir):
    """What landing reports per drop file, with strict timestamps, and the missing stamps it set."""
    root = scratch_path(spark, "landed")
    lines = fixtures.drop_lines(spark, sf_dir).select("value", "dt", "src")
    stamp = dt.datetime(2030, 1, 1, tzinfo=dt.timezone.utc)
    found = []
    for src in (f"drop-{i}" for i in range(4)):
        n_ok, n_bad = landing.land(lines.where(F.col("src") == src), root, landed_at=stamp, strict_timestamps=True)
        found.append((src, n_ok, n_bad))
    stamped = spark.read.parquet(root).where(F.col("ingest_ts").startswith("2030-01-01")).groupBy("src").agg(F.count(F.lit(1)).alias("n_stamped"))
    counts = spark.createDataFrame(found, "src string, n_ok bigint, n_bad bigint")
    return counts.join(stamped, "src", "left").fillna(0, ["n_stamped"])


@register("land_written")
def land_written(spark, sf_dir):
    """Drops landed, one of them delivered again without its bad lines, read back."""
    root = scratch_path(spark, "landed")
    lines = fixtures.drop_lines(spark, sf_dir).select("value", "dt", "src")
    landing.land(lines, root)
    again = lines.where(F.col("src") == "drop-1")
    good = landing.classify(again).where("status = 'ok'").select("value", "dt", "src")
    landing.land(good, root)
    return spark.read.parquet(root).select("dt", "src", "status", "error", F.col("value").alias("raw"))


@register("gold_refresh_touched")
def gold_refresh_touched(spark, sf_dir):
    """The gold of the two newest days is lost and the days are run again in
    order; the pod mart read back equals a full rebuild."""
    lake, rows = _backfilled(spark, sf_dir)
    for ds in _latest_dts(spark, lake, 2):
        _lose_gold(spark, lake, ds)
        flow.run_day(spark, lake, rows, ds, gate=False)
    return flow.read_table(spark, lake.pod_fill, "pod_fill").select(*gold.pod_fill_columns())


# --- streaming ----------------------------------------------------------------------------

STREAM_RUNS = 4  # arrival days are fed in this many successive availableNow runs
SILVER_OUT = [*SILVER_COLUMNS, "too_late"]


@register("stream_landing")
def stream_landing(spark, sf_dir):
    """ST1: drop files streamed through the contract into ``landed``."""
    root = scratch_path(spark, "stream-landing")
    lines = fixtures.drop_lines(spark, sf_dir)
    lines.select("dt", "value").write.partitionBy("dt").text(f"{root}/drops")
    streams.landing_stream(spark, f"{root}/drops", f"{root}/landed", f"{root}/_checkpoint")
    landed = spark.read.parquet(f"{root}/landed")
    return landed.select("dt", "status", "error", landed["value"].alias("raw"))


@register("stream_dedup_lww")
def stream_dedup_lww(spark, sf_dir):
    """ST2 / ST3: last-write-wins silver kept current across successive arrivals."""
    root = scratch_path(spark, "stream-repair")
    rows = fixtures.beacons(spark, sf_dir)
    for chunk in streams.arrival_chunks(rows, STREAM_RUNS):
        streams.arrive(rows, f"{root}/bronze", chunk)
        streams.repair_stream(spark, f"{root}/bronze", f"{root}/raw", f"{root}/silver", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/silver").select(*SILVER_OUT)


@register("stream_daily_counts")
def stream_daily_counts(spark, sf_dir):
    """ST4: day counts kept current across successive arrivals, duplicates counted once."""
    root = scratch_path(spark, "stream-counts")
    rows = fixtures.beacons(spark, sf_dir)
    for chunk in streams.arrival_chunks(rows, STREAM_RUNS):
        streams.arrive(rows, f"{root}/bronze", chunk)
        streams.daily_counts_stream(spark, f"{root}/bronze", f"{root}/raw", f"{root}/counts", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/counts")


@register("stream_lww_state")
def stream_lww_state(spark, sf_dir):
    """ST3: last-write-wins silver from streaming state, fed in successive arrivals; each batch reads only its own days' changes."""
    root = scratch_path(spark, "stream-state")
    rows = fixtures.beacons(spark, sf_dir)
    for chunk in streams.arrival_chunks(rows, STREAM_RUNS):
        streams.arrive(rows, f"{root}/bronze", chunk)
        stateful.lww_stream(spark, f"{root}/bronze", root, f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/silver").select(*SILVER_OUT)


@register("stream_closed_days")
def stream_closed_days(spark, sf_dir):
    """ST4: counts of the closed days, by event-time windows in append mode; open days are absent."""
    root = scratch_path(spark, "stream-closed")
    rows = fixtures.beacons(spark, sf_dir)
    for chunk in streams.arrival_chunks(rows, STREAM_RUNS):
        streams.arrive(rows, f"{root}/bronze", chunk)
        stateful.closed_days_stream(spark, f"{root}/bronze", f"{root}/counts", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/counts")


@register("stream_late_split")
def stream_late_split(spark, sf_dir):
    """ST2: every received beacon on its side of the 36-hour rule, from one pass over each batch."""
    root = scratch_path(spark, "stream-late")
    rows = fixtures.with_stragglers(fixtures.beacons(spark, sf_dir))
    for chunk in streams.arrival_chunks(rows, 2):
        streams.arrive(rows, f"{root}/bronze", chunk)
        stateful.lateness_split_stream(spark, f"{root}/bronze", f"{root}/received", f"{root}/_checkpoint")
    columns = ["event_id", "event_date", "ingest_ts", "is_late", "clearing_price_micros"]
    sides = [stateful.side_of(spark, f"{root}/received", side).select(*columns).withColumn("side", F.lit(side)) for side in (stateful.ON_TIME, stateful.TOO_LATE)]
    return sides[0].unionByName(sides[1])


class _Stop(RuntimeError):
    """Ends a streaming run between a batch's write and its commit."""


@register("topic_landing")
def topic_landing(spark, sf_dir):
    """Drop lines published to a topic and landed at a bounded rate by a run that is stopped and resumed."""
    root = scratch_path(spark, "topic")
    lines = fixtures.drop_lines(spark, sf_dir)
    records = lines.select(F.col("e").cast("string").alias("key"), "value", F.col("dt").cast("timestamp").alias("timestamp"))
    topic.publish(records.repartition(4), f"{root}/topic")

    def stop(batch_id):
        if batch_id == 1:
            raise _Stop(batch_id)

    try:
        topic.land_topic(spark, topic.records(spark, f"{root}/topic"), f"{root}/landed", f"{root}/_checkpoint", after_write=stop)
    except StreamingQueryException:
        pass  # stopped after the write of its second batch
    topic.land_topic(spark, topic.records(spark, f"{root}/topic"), f"{root}/landed", f"{root}/_checkpoint")
    landed = spark.read.parquet(f"{root}/landed")
    return landed.select("dt", "status", "error", landed["value"].alias("raw"))


# --- SQL route, views, full refresh, topic records --------------------------------------


@register("silver_sql")
def silver_sql_route(spark, sf_dir):
    """Beacons written as JSON drops (numbers with a fraction part
    of zero, absent defaults), read back and deduplicated by the SQL route."""
    root = scratch_path(spark, "sql-route")
    rows = fixtures.beacons(spark, sf_dir)
    text = rows.withColumns(
        {
            "event_ts": F.date_format("event_ts", reads.TS_TEXT),
            "ingest_ts": F.when(F.col("is_late"), F.date_format("ingest_ts", reads.TS_TEXT)),
            "slot_index": F.when(F.col("slot_index") > 0, F.col("slot_index").cast("double")),
            "quartile": F.col("quartile").cast("double"),
            "is_late": F.when(F.col("is_late"), True),
        }
    )
    # a compressed drop is read by one task, so its lines are bounded
    drops = text.drop("dt").write.options(maxRecordsPerFile=100_000, **{"zlib.compress.level": "BEST_SPEED"})
    drops.json(f"{root}/bronze", compression="gzip")
    silver_sql.build_silver_sql(spark, f"{root}/bronze", f"{root}/silver")
    return spark.read.parquet(f"{root}/silver")


@register("silver_text")
def silver_text(spark, sf_dir):
    """Silver of beacons as text, with defaults left out, odd numbers and a foreign event type."""
    return silver.silver(fixtures.as_text(fixtures.beacons(spark, sf_dir)).drop("dt"), by=("event_id",))


@register("silver_text_sql")
def silver_text_sql(spark, sf_dir):
    """The same text rows through the SQL route."""
    fixtures.as_text(fixtures.beacons(spark, sf_dir)).drop("dt").createOrReplaceTempView("bronze_text_events")
    return silver_sql.silver_from_view(spark, "bronze_text_events")


@register("full_refresh")
def full_refresh(spark, sf_dir):
    """Silver of the newest day is corrected, then the marts are rebuilt whole
    from all written silver and read through the catalog view name."""
    lake, rows = _backfilled(spark, sf_dir)
    fixed, last = _corrected(rows)
    flow.write_silver(spark, lake, fixed.where(F.col("dt") == F.lit(last).cast("date")))
    flow.full_refresh(spark, lake)
    flow.register_views(spark, lake)
    return spark.table("fct_campaign_daily").select(*gold.campaign_daily_columns())


@register("drop_records")
def drop_records(spark, sf_dir):
    """Drop lines re-serialised as topic records, parsed back to check fields."""
    recs = reads.drop_records(fixtures.drop_lines(spark, sf_dir).select("value"))
    return recs.select(
        F.get_json_object("value", "$.event_id").alias("event_id"),
        F.get_json_object("value", "$.market").alias("market"),
        F.get_json_object("value", "$.event_type").alias("event_type"),
        "rejected",
    )


def queries() -> dict[str, Query]:
    return dict(CATALOG)
