"""Quality gate (Q1-Q8, Q12) and table checks (Q9-Q11) as rule DataFrames.

Each day is reduced to one aggregate row per input (silver by arrival ``dt``,
the campaign mart by ``event_date``) — two small per-day frames — and then
unfolded into one row per check, in rule order. ``enforce`` raises with the
first failed rule, as the daily flow requires.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.formatting import num
from slotwise.functions.money import half_up_sql
from slotwise.functions.contract import (
    EVENT_TYPES,
    GATE_FILL_BAND,
    GATE_MAX_IMPRESSION_RATIO,
    GATE_MIN_ROWS,
    GATE_SOFT_FILL_BAND,
)


class GateFailed(RuntimeError):
    """A hard gate rule failed for the day."""


def _silver_day_stats(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.col("dt").alias("ds")).agg(
        F.count(F.lit(1)).cast("bigint").alias("silver_rows"),
        F.count_if(F.col("event_type") == "ad_request").cast("bigint").alias("requests"),
        F.count_if(F.col("event_type") == "ad_impression").cast("bigint").alias("impressions"),
    )


def _gold_day_stats(campaign_daily: DataFrame) -> DataFrame:
    """Per event date: rows, negative-revenue rows, and the unweighted mean of the
    non-null fill rates. The rates carry 6 decimals, so the mean is taken exactly
    on integer micro-rates and rounded half-up to 6 decimals (a mean of doubles
    would depend on summation order and round differently on ties)."""
    day = campaign_daily.groupBy(F.col("event_date").alias("ds")).agg(
        F.count(F.lit(1)).cast("bigint").alias("gold_rows"),
        F.count_if(F.col("revenue_micros") < 0).cast("bigint").alias("negative_revenue_rows"),
        F.expr("sum(CAST(round(fill_rate * 1000000) AS BIGINT))").alias("fill_micro_sum"),
        F.count("fill_rate").alias("fill_n"),  # null rates are skipped
    )
    return day.select("ds", "gold_rows", "negative_revenue_rows", F.expr(_MEAN_FILL_SQL).alias("mean_fill_rate"))


_MEAN_FILL_SQL = f"CASE WHEN fill_n > 0 THEN {half_up_sql('fill_micro_sum', 'fill_n', 0)} / 1000000 END"


#: The gate's figures of one day, as a write can observe them.
SILVER_FIGURES = ("silver_rows", "requests", "impressions")
GOLD_FIGURES = ("gold_rows", "negative_revenue_rows", "fill_micro_sum", "fill_n")


def silver_figures() -> list[Column]:
    """Q1-Q4 over the rows of one arrival day's silver."""
    return [
        F.count(F.lit(1)).alias("silver_rows"),
        F.count_if(F.col("event_type") == "ad_request").alias("requests"),
        F.count_if(F.col("event_type") == "ad_impression").alias("impressions"),
    ]


def gold_figures(ds: str) -> list[Column]:
    """Q5-Q7 over the campaign mart's rows of one event date, among any others."""
    day = F.col("event_date") == F.lit(ds).cast("date")
    return [
        F.count_if(day).alias("gold_rows"),
        F.count_if(day & (F.col("revenue_micros") < 0)).alias("negative_revenue_rows"),
        F.sum(F.when(day, F.round(F.col("fill_rate") * 1000000).cast("bigint"))).alias("fill_micro_sum"),
        F.count(F.when(day, F.col("fill_rate"))).alias("fill_n"),
    ]


def observed_report(spark: SparkSession, ds: str, silver: dict[str, int], mart: dict[str, int] | None) -> DataFrame:
    """``gate_report`` of one day from its figures; ``mart=None``: the mart is not built."""
    figures = {k: int(v) if v is not None else None for k, v in (silver | (mart or dict.fromkeys(GOLD_FIGURES))).items()}
    schema = "ds string, " + ", ".join(f"{k} bigint" for k in (*SILVER_FIGURES, *GOLD_FIGURES))
    day = spark.createDataFrame([(ds, *[figures[k] for k in (*SILVER_FIGURES, *GOLD_FIGURES)])], schema)
    day = day.select(F.to_date("ds").alias("ds"), *SILVER_FIGURES, "gold_rows", "negative_revenue_rows", F.expr(_MEAN_FILL_SQL).alias("mean_fill_rate"))
    return _report(day, F.lit(mart is not None))


def _check(no: int, name: str, severity: str, observed: Column, threshold: str, passed: Column, message: Column) -> Column:
    return F.struct(
        F.lit(no).alias("check_no"),
        F.lit(name).alias("check"),
        F.lit(severity).alias("severity"),
        # rounded: a mean of doubles differs in its last bits with the summation order
        F.round(observed.cast("double"), 6).alias("observed"),
        F.lit(threshold).alias("threshold"),
        passed.alias("passed"),
        F.when(~passed, message).alias("message"),
    )


def gate_report(silver: DataFrame, campaign_daily: DataFrame | None, days: list[str] | None = None) -> DataFrame:
    """One row per (day, check): observed value, threshold, pass flag, message.

    Days are every arrival ``dt`` of silver and every ``event_date`` of the mart, or
    exactly ``days`` if given: a requested day without any row is reported, and fails.
    ``campaign_daily=None`` means the mart is not built: Q5-Q7 are skipped
    (they pass), as the source gate does.
    """
    s = _silver_day_stats(silver)
    if campaign_daily is not None:
        g = _gold_day_stats(campaign_daily)
        day = s.join(g, "ds", "full")
        mart_built = F.lit(True)
    else:
        day = s.withColumns(
            {"gold_rows": F.lit(None).cast("bigint"), "negative_revenue_rows": F.lit(None).cast("bigint"), "mean_fill_rate": F.lit(None).cast("double")}
        )
        mart_built = F.lit(False)
    if days is not None:
        asked = silver.sparkSession.createDataFrame([(d,) for d in days], "ds string").select(F.to_date("ds").alias("ds"))
        day = asked.join(day, "ds", "left")
    return _report(day, mart_built)


def _report(day: DataFrame, mart_built: Column) -> DataFrame:
    """The rules over one row of figures per day."""
    rows = F.coalesce(F.col("silver_rows"), F.lit(0))
    req = F.coalesce(F.col("requests"), F.lit(0))
    imp = F.coalesce(F.col("impressions"), F.lit(0))
    gold_rows = F.coalesce(F.col("gold_rows"), F.lit(0))
    neg = F.coalesce(F.col("negative_revenue_rows"), F.lit(0))
    fill = F.col("mean_fill_rate")
    ds = F.col("ds").cast("string")
    lo, hi = GATE_FILL_BAND
    slo, shi = GATE_SOFT_FILL_BAND
    checks = F.array(
        _check(1, "silver_exists", "error", rows, ">= 1", rows > 0, F.concat(F.lit("no silver rows arrived on "), ds)),
        _check(
            2,
            "silver_min_rows",
            "error",
            rows,
            f">= {GATE_MIN_ROWS}",
            rows >= GATE_MIN_ROWS,
            F.format_string("only %d silver rows arrived on %s", rows, ds),
        ),
        _check(3, "requests_present", "error", req, "> 0", req > 0, F.lit("day holds no ad requests")),
        _check(
            4,
            "impressions_vs_requests",
            "error",
            imp,
            f"<= requests * {GATE_MAX_IMPRESSION_RATIO}",
            imp <= req * GATE_MAX_IMPRESSION_RATIO,
            F.format_string("%d impressions against %d requests", imp, req),
        ),
        _check(
            5,
            "gold_rows_for_day",
            "error",
            gold_rows,
            "> 0",
            ~mart_built | (gold_rows > 0),
            F.concat(F.lit("campaign mart has no rows dated "), ds),
        ),
        _check(6, "no_negative_revenue", "error", neg, "= 0", neg == 0, F.lit("campaign mart holds negative revenue")),
        _check(
            7,
            "mean_fill_rate_band",
            "error",
            fill,
            f"[{lo}, {hi}]",
            fill.isNull() | fill.between(lo, hi),
            F.concat(F.lit("mean fill rate out of bounds: "), num(fill, 3)),
        ),
        _check(
            12,
            "mean_fill_rate_soft_band",
            "warn",
            fill,
            f"[{slo}, {shi}]",
            fill.isNull() | fill.between(slo, shi),
            F.concat(F.lit("mean fill rate "), num(fill, 3), F.lit(" lies outside the usual band")),
        ),
    )
    # every rule is evaluated; the verdict (Q8) is the first failed error rule
    return day.select(F.col("ds"), F.inline(checks))


def gate_verdicts(report: DataFrame) -> DataFrame:
    """Q8: per day, pass/fail and the message of the first failed error rule."""
    errors = report.where(F.col("severity") == "error")
    first = F.min_by(F.col("message"), F.when(~F.col("passed"), F.col("check_no")))
    return errors.groupBy("ds").agg(
        F.bool_and("passed").alias("passed"),
        first.alias("message"),
    )


def enforce(report: DataFrame, ds: str) -> None:
    """Raise ``GateFailed`` with the first failed error rule of ``ds``."""
    day = report.where((F.col("ds") == F.lit(ds).cast("date")) & (F.col("severity") == "error") & ~F.col("passed"))
    first = day.orderBy("check_no").select("message").limit(1).collect()
    if first:
        raise GateFailed(first[0]["message"])


def not_null_report(campaign_daily: DataFrame, pod_fill: DataFrame, silver: DataFrame) -> DataFrame:
    """Q9-Q11: (table, check, failures, passed), all counts in one aggregate per table."""
    camp = campaign_daily.agg(
        F.count_if(F.col("event_date").isNull()).alias("c1"),
        F.count_if(F.col("campaign_id").isNull()).alias("c2"),
        F.count_if(F.col("revenue_micros") < 0).alias("c3"),
        F.count_if((F.col("requests") > 0) & ~F.col("fill_rate").between(0, GATE_MAX_IMPRESSION_RATIO)).alias("c4"),
        F.coalesce(F.sum("requests"), F.lit(0)).alias("req"),
        F.coalesce(F.sum("impressions"), F.lit(0)).alias("imp"),
    )
    pods = pod_fill.agg(
        F.count_if(F.col("pod_id").isNull()).alias("p1"),
        F.count_if(F.col("filled").isNull()).alias("p2"),
    )
    # uniqueness and types in one pass: per id (partial counts per map task first), then totals
    per_id = silver.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("event_type").isin(*EVENT_TYPES)).alias("bad")
    )
    ids = per_id.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("s1"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("s2"),
    )

    def unfold(one_row: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
        rows = F.array(
            *[
                F.struct(F.lit(t).alias("table"), F.lit(c).alias("check"), v.cast("bigint").alias("failures"))
                for t, c, v in checks
            ]
        )
        return one_row.select(F.inline(rows))

    out = (
        unfold(
            camp,
            [
                ("fct_campaign_daily", "not_null(event_date)", F.col("c1")),
                ("fct_campaign_daily", "not_null(campaign_id)", F.col("c2")),
                ("fct_campaign_daily", "revenue_micros >= 0", F.col("c3")),
                ("fct_campaign_daily", "sum(requests) > 0", F.when(F.col("req") > 0, 0).otherwise(1)),
                ("fct_campaign_daily", "sum(impressions) > 0", F.when(F.col("imp") > 0, 0).otherwise(1)),
                ("fct_campaign_daily", "0 <= fill_rate <= 1.15", F.col("c4")),
            ],
        )
        .unionByName(
            unfold(
                pods,
                [
                    ("fct_pod_fill", "not_null(pod_id)", F.col("p1")),
                    ("fct_pod_fill", "not_null(filled)", F.col("p2")),
                ],
            )
        )
        .unionByName(
            unfold(
                ids,
                [("silver", "unique(event_id)", F.col("s1")), ("silver", "event_type in contract", F.col("s2"))],
            )
        )
    )
    return out.withColumn("passed", F.col("failures") == 0)
