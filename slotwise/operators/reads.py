"""Parameterised read queries over the marts, report tables and analysis questions.

All of them run on the (small, aggregated) gold marts except the completion
reconcile, which reads silver: it is a conditional aggregation per slot rather
than a join, so a hot key is pre-combined in every map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.functions import formatting as fmt
from slotwise.operators.landing import BLANKS
from slotwise.functions.contract import BEACON_SCHEMA, CAMPAIGN_KEYS, POD_KEYS
from slotwise.functions.money import ecpm, micros_to_currency, rate_sql, ratio_of_sums, safe_rate

MAX_LIMIT = 1000
DEFAULT_LIMIT = 100
# report sizes shown by the static report
REPORT_CAMPAIGNS, REPORT_PODS = 25, 20
SNAPSHOT_CAMPAIGNS, SNAPSHOT_PODS = 40, 30


class NotFound(LookupError):
    """No rows for the requested day."""


def _check_limit(limit: int) -> int:
    if not 1 <= int(limit) <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}, got {limit}")
    return int(limit)


def _day(ds: str) -> Column:
    # typed comparison so the filter prunes event_date partitions
    return F.col("event_date") == F.lit(ds).cast("date")


def campaign_order() -> list[Column]:
    """Newest day, highest revenue first; the grain keys break ties."""
    return [F.col("event_date").desc(), F.col("revenue_micros").desc()] + [
        F.col(k).asc_nulls_first() for k in CAMPAIGN_KEYS[1:]
    ]


def pod_order() -> list[Column]:
    """Newest day, most requests first; the grain keys break ties."""
    return [F.col("event_date").desc(), F.col("requests").desc()] + [F.col(k).asc_nulls_first() for k in POD_KEYS[1:]]


def campaigns_daily(
    campaign_daily: DataFrame,
    ds: str | None = None,
    campaign_id: str | None = None,
    market: str | None = None,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """R1 (F6 + T1): optional equality filters (empty = not given), top ``limit``."""
    n = _check_limit(limit)
    df = campaign_daily
    if ds:
        df = df.where(_day(ds))
    if campaign_id:
        df = df.where(F.col("campaign_id") == campaign_id)
    if market:
        df = df.where(F.col("market") == market)
    return df.orderBy(*campaign_order()).limit(n)


def pods_fill(pod_fill: DataFrame, ds: str | None = None, break_type: str | None = None, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """R2 (F7 + T2)."""
    n = _check_limit(limit)
    df = pod_fill
    if ds:
        df = df.where(_day(ds))
    if break_type:
        df = df.where(F.col("break_type") == break_type)
    return df.orderBy(*pod_order()).limit(n)


def _summary_aggs() -> list[Column]:
    return [
        F.sum("requests").cast("bigint").alias("requests"),
        F.sum("impressions").cast("bigint").alias("impressions"),
        F.sum("clicks").cast("bigint").alias("clicks"),
        # from the integer micros, so the value does not depend on addition order
        micros_to_currency("sum(revenue_micros)").alias("revenue"),
        ratio_of_sums("impressions", "requests", 4).alias("fill_rate"),
        F.count_distinct("campaign_id").cast("bigint").alias("campaigns"),
    ]


def day_summaries(campaign_daily: DataFrame) -> DataFrame:
    """R3 for every day: one row per event_date."""
    return campaign_daily.groupBy(F.col("event_date").alias("ds")).agg(*_summary_aggs())


def day_summary(campaign_daily: DataFrame, ds: str) -> DataFrame:
    """R3 for one day; raises ``NotFound`` when the day has no rows."""
    day = campaign_daily.where(_day(ds))
    if day.isEmpty():
        raise NotFound(f"no data for {ds}")
    return day.groupBy(F.col("event_date").alias("ds")).agg(*_summary_aggs())


def report_cards(summaries: DataFrame) -> DataFrame:
    """The six summary cards of each day as (ds, position, label, value)."""
    def card(position: int, label: str, value: Column) -> Column:
        return F.struct(F.lit(position).alias("position"), F.lit(label).alias("label"), value.alias("value"))

    cards = F.array(
        card(1, "Day", F.col("ds").cast("string")),
        card(2, "Requests", F.col("requests").cast("string")),
        card(3, "Impressions", F.col("impressions").cast("string")),
        card(4, "Fill rate", fmt.pct("fill_rate")),
        card(5, "Clicks", F.col("clicks").cast("string")),
        card(6, "Revenue", fmt.num("revenue", 3)),
    )
    return summaries.select("ds", F.inline(cards))


def report_campaigns(campaign_daily: DataFrame, limit: int = REPORT_CAMPAIGNS) -> DataFrame:
    """The campaign table of the report (10 display columns)."""
    top = campaigns_daily(campaign_daily, limit=limit)
    return top.select(
        F.col("event_date").cast("string").alias("event_date"),
        "campaign_id",
        "market",
        "platform",
        "break_type",
        "requests",
        "impressions",
        fmt.pct("fill_rate").alias("fill_rate"),
        fmt.num("ecpm", 2).alias("ecpm"),
        fmt.num("revenue", 3).alias("revenue"),
    )


def report_pods(pod_fill: DataFrame, limit: int = REPORT_PODS) -> DataFrame:
    """The pod table of the report (9 display columns)."""
    top = pods_fill(pod_fill, limit=limit)
    return top.select(
        F.col("event_date").cast("string").alias("event_date"),
        fmt.short_id("pod_id").alias("pod"),
        "break_type",
        "platform",
        "market",
        "requests",
        "impressions",
        fmt.yes_no("filled").alias("filled"),
        fmt.pct("pod_fill_rate").alias("pod_fill_rate"),
    )


PRINTED = "decimal(28,6)"


def _printed(mart: DataFrame) -> list[Column]:
    """A mart's columns with its doubles as decimals (their values have at most six places)."""
    return [F.col(c).cast(PRINTED).alias(c) if kind == "double" else F.col(c) for c, kind in mart.dtypes]


def report_snapshot(campaign_daily: DataFrame, pod_fill: DataFrame) -> DataFrame:
    """Per day, one JSON document {summary, campaigns[40], pods[30]}.

    The arrays are bounded (top 40 / top 30 per day, ranked by a window with a
    group limit), so no unbounded group is collected. Amounts and rates are written
    as decimals, so the text of a document does not depend on an engine's way to print doubles.
    """
    camp_rank = Window.partitionBy("event_date").orderBy(*campaign_order()[1:])
    pod_rank = Window.partitionBy("event_date").orderBy(*pod_order()[1:])
    camps = (
        campaign_daily.withColumn("rank", F.row_number().over(camp_rank))
        .where(F.col("rank") <= SNAPSHOT_CAMPAIGNS)
        .groupBy("event_date")
        .agg(F.sort_array(F.collect_list(F.struct("rank", *_printed(campaign_daily)))).alias("campaign_rows"))
    )
    pods = (
        pod_fill.withColumn("rank", F.row_number().over(pod_rank))
        .where(F.col("rank") <= SNAPSHOT_PODS)
        .groupBy("event_date")
        .agg(F.sort_array(F.collect_list(F.struct("rank", *_printed(pod_fill)))).alias("pod_rows"))
    )
    summary = day_summaries(campaign_daily).withColumnRenamed("ds", "event_date")
    doc = summary.join(camps, "event_date", "left").join(pods, "event_date", "left")
    return doc.select(
        "event_date",
        F.to_json(
            F.struct(
                F.struct(
                    F.col("event_date").cast("string").alias("ds"),
                    "requests",
                    "impressions",
                    "clicks",
                    F.col("revenue").cast(PRINTED).alias("revenue"),
                    F.col("fill_rate").cast(PRINTED).alias("fill_rate"),
                    "campaigns",
                ).alias("summary"),
                F.transform("campaign_rows", lambda r: r.dropFields("rank")).alias("campaigns"),
                F.transform("pod_rows", lambda r: r.dropFields("rank")).alias("pods"),
            ),
            {"ignoreNullFields": "false"},
        ).alias("payload"),
    )


# --- analysis questions (derived from the marts) --------------------------------


def fill_by_slice(campaign_daily: DataFrame) -> DataFrame:
    """Fill rate and eCPM per day x campaign x platform x market — a ratio of
    sums over break types, never a mean of ratios."""
    keys = ["event_date", "campaign_id", "platform", "market"]
    agg = campaign_daily.groupBy(*keys).agg(
        F.sum("requests").cast("bigint").alias("requests"),
        F.sum("impressions").cast("bigint").alias("impressions"),
        F.sum("revenue_micros").cast("bigint").alias("revenue_micros"),
    )
    return agg.select(
        *keys,
        "requests",
        "impressions",
        "revenue_micros",
        safe_rate("impressions", "requests").alias("fill_rate"),
        ecpm("revenue_micros", "impressions").alias("ecpm"),
    )


def _broken(pod_fill: DataFrame) -> DataFrame:
    return pod_fill.where((F.col("break_type") == "midroll"))


def midroll_break_rate(pod_fill: DataFrame) -> DataFrame:
    """Share of midroll pods with a request but no impression, per day."""
    mid = _broken(pod_fill)
    return mid.groupBy("event_date").agg(
        F.count(F.lit(1)).cast("bigint").alias("pods"),
        F.count_if((F.col("requests") > 0) & (F.col("impressions") == 0)).cast("bigint").alias("broken_pods"),
        # the share of pods with filled = 0, rounded half-up on the exact ratio
        F.expr(rate_sql("count_if(filled = 0)", "count(1)")).alias("break_rate"),
    )


def midroll_broken_pods(pod_fill: DataFrame) -> DataFrame:
    """The list of broken midroll pods."""
    return _broken(pod_fill).where((F.col("requests") > 0) & (F.col("impressions") == 0))


def completion_reconcile(silver: DataFrame) -> DataFrame:
    """Per slot (session, pod, slot index), does it have an impression, a
    100 % quartile, or both? Counted per day as both / completion_only /
    impression_only. One conditional aggregation, no join."""
    slot = ["session_id", "pod_id", "slot_index"]
    is_imp = F.col("event_type") == "ad_impression"
    is_done = (F.col("event_type") == "ad_quartile") & (F.col("quartile") == 100)
    per_slot = (
        silver.where(is_imp | is_done)
        .groupBy(*slot)
        .agg(
            F.min("event_date").alias("event_date"),
            F.count_if(is_imp).alias("imp"),
            F.count_if(is_done).alias("done"),
        )
    )
    return per_slot.groupBy("event_date").agg(
        F.count_if((F.col("imp") > 0) & (F.col("done") > 0)).cast("bigint").alias("both"),
        F.count_if((F.col("imp") == 0) & (F.col("done") > 0)).cast("bigint").alias("completion_only"),
        F.count_if((F.col("imp") > 0) & (F.col("done") == 0)).cast("bigint").alias("impression_only"),
    )


def unmatched_slots(silver: DataFrame) -> DataFrame:
    """The slots with a completion but no impression, or the reverse, one row each.

    ``session_id, pod_id, slot_index, side, event_date, beacons``: the side that is
    there (``completion_only`` / ``impression_only``), the first date and the number of
    its beacons. The two sides meet in a full outer join whose matches fall away.

    Skew: each side is summed up per slot before it moves, so a slot with any number of
    beacons is one row per map task, and after the final sum no key is repeated on
    either side: the join cannot meet a hot key. Null slot fields match each other.
    """
    slot = ["session_id", "pod_id", "slot_index"]

    def side(rows: DataFrame, tag: str) -> DataFrame:
        return rows.groupBy(*slot).agg(F.min("event_date").alias(f"{tag}_date"), F.count(F.lit(1)).alias(f"{tag}_beacons"))

    shown = side(silver.where("event_type = 'ad_impression'"), "shown")
    ended = side(silver.where("event_type = 'ad_quartile' AND quartile = 100"), "ended").withColumnsRenamed({k: f"e_{k}" for k in slot})
    same = [shown[k].eqNullSafe(ended[f"e_{k}"]) for k in slot]
    alone = shown.join(ended, same, "full").where("shown_beacons IS NULL OR ended_beacons IS NULL")
    has_shown = F.col("shown_beacons").isNotNull()
    return alone.select(
        *[F.when(has_shown, F.col(k)).otherwise(F.col(f"e_{k}")).alias(k) for k in slot],
        F.when(has_shown, "impression_only").otherwise("completion_only").alias("side"),
        F.coalesce("shown_date", "ended_date").alias("event_date"),
        F.coalesce("shown_beacons", "ended_beacons").alias("beacons"),
    )


# --- publishing (K8) and JSON records (K11) ----------------------------------------

TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def publish_payload(rows: DataFrame) -> DataFrame:
    """K8: (key, value) records for a topic writer — the contract fields as JSON.

    ``rows.write.format('kafka')`` takes this frame as is when the connector is
    on the classpath; timestamps are written with an explicit offset format so a
    round trip is lossless."""
    fields = [f.name for f in BEACON_SCHEMA.fields]
    return rows.select(
        F.col("event_id").alias("key"),
        F.to_json(F.struct(*fields), {"timestampFormat": TS_TEXT, "ignoreNullFields": "false"}).alias("value"),
    )


def json_record(columns: list[str]) -> Column:
    """Some columns of a row as one JSON text (nulls kept as null)."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_records(df: DataFrame) -> DataFrame:
    """One JSON text per row (nulls kept as null)."""
    return df.select(json_record(df.columns).alias("record"))


def drop_records(lines: DataFrame) -> DataFrame:
    """A drop file as topic records ``value, rejected``.

    Blank lines are skipped. Every other line is a row: parsed and re-serialised as
    compact JSON in ``value``, or, if it is not JSON, as received in ``rejected``,
    so a writer can send the two to different topics and no line is lost.
    """
    trimmed = lines.select(F.btrim(F.col("value"), F.lit(BLANKS)).alias("line")).where(F.col("line") != "")
    parsed = trimmed.select("line", F.try_parse_json("line").alias("v"))
    return parsed.select(
        F.to_json(F.col("v")).alias("value"),
        F.when(F.col("v").isNull(), F.col("line")).alias("rejected"),
    )
