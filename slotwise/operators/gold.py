"""Silver -> gold marts: campaign x day and pod x day.

Each mart is one conditional aggregation: a partial ``HashAggregate`` in every
map task (so a hot campaign or pod is pre-summed before it moves), one
exchange on the grain, a final ``HashAggregate``. The source system's six
separate group-bys joined back on the keys collapse into that single pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.contract import CAMPAIGN_KEYS, POD_KEYS
from slotwise.functions.money import currency_sql, ecpm_sql, rate_sql, raw_ecpm, raw_fill_rate

COUNT_COLUMNS = ("requests", "impressions", "clicks", "errors", "completions")
# the union of both mart grains: counts here roll up into either mart
FINE_KEYS = tuple(dict.fromkeys(CAMPAIGN_KEYS + POD_KEYS))


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _count(pred: Column) -> Column:
    # a null predicate (e.g. null quartile) is simply not counted
    return F.count_if(pred)


# measures as SQL text (parsed once on the JVM)
MEASURES_SQL = {
    "requests": "count_if(event_type = 'ad_request')",
    "impressions": "count_if(event_type = 'ad_impression')",
    "clicks": "count_if(event_type = 'ad_click')",
    "errors": "count_if(event_type = 'ad_error')",
    "completions": "count_if(event_type = 'ad_quartile' AND quartile = 100)",
    "revenue_micros": "CAST(coalesce(sum(CASE WHEN event_type = 'ad_impression' THEN clearing_price_micros END), 0)"
    " AS BIGINT)",
}


def grain_counts(silver: DataFrame, keys) -> DataFrame:
    """A1-A6 at any grain: five conditional counts and the revenue sum."""
    return silver.groupBy(*keys).agg(*[F.expr(sql).alias(name) for name, sql in MEASURES_SQL.items()])


def campaign_metrics(silver: DataFrame) -> DataFrame:
    """Counts and revenue per campaign grain (every key with any event)."""
    return grain_counts(silver, CAMPAIGN_KEYS)


def _rollup(counts: DataFrame, keys, measures) -> DataFrame:
    return counts.groupBy(*keys).agg(*[F.sum(m).cast("bigint").alias(m) for m in measures])


def campaign_daily_from_counts(counts: DataFrame) -> DataFrame:
    """The campaign mart from counts at a finer grain (counts are additive)."""
    return with_campaign_rates(_rollup(counts, CAMPAIGN_KEYS, COUNT_COLUMNS + ("revenue_micros",)))


def pod_fill_from_counts(counts: DataFrame) -> DataFrame:
    """The pod mart from counts at a finer grain."""
    return _pod_columns(_rollup(counts, POD_KEYS, ("requests", "impressions", "errors")))


RATES_SQL = (
    f"{currency_sql('revenue_micros')} AS revenue",
    f"{rate_sql('impressions', 'requests')} AS fill_rate",
    f"{rate_sql('clicks', 'impressions')} AS ctr",
    f"{rate_sql('completions', 'impressions')} AS completion_rate",
    f"{ecpm_sql('revenue_micros', 'impressions')} AS ecpm",
)


def with_campaign_rates(metrics: DataFrame) -> DataFrame:
    """X1-X7 on top of the metrics (``functions.money`` rules, as SQL text)."""
    return metrics.selectExpr(*CAMPAIGN_KEYS, *COUNT_COLUMNS, "revenue_micros", *RATES_SQL)


def campaign_daily(silver: DataFrame, active_only: bool = False) -> DataFrame:
    """A8. ``active_only`` keeps the pandas universe (D1): no null keys, and only
    keys with a request, impression, click, error or completion."""
    m = campaign_metrics(silver)
    if active_only:
        m = m.where(F.greatest(*[F.col(c) for c in COUNT_COLUMNS]) > 0)
        for k in CAMPAIGN_KEYS:
            m = m.where(F.col(k).isNotNull())
    return with_campaign_rates(m)


def campaign_daily_by_joins(silver: DataFrame) -> DataFrame:
    """J1 as the source system wrote it: one filtered group-by per measure,
    full outer joined on the five keys, zeros for the gaps. Kept only as a
    checked equivalent of ``campaign_daily(active_only=True)`` — it scans the
    silver six times and shuffles six times, so it is never the production path."""
    keys = list(CAMPAIGN_KEYS)
    nonnull = silver
    for k in keys:
        nonnull = nonnull.where(F.col(k).isNotNull())
    parts = [
        nonnull.where(_is("ad_request")).groupBy(*keys).agg(F.count(F.lit(1)).alias("requests")),
        nonnull.where(_is("ad_impression")).groupBy(*keys).agg(F.count(F.lit(1)).alias("impressions")),
        nonnull.where(_is("ad_click")).groupBy(*keys).agg(F.count(F.lit(1)).alias("clicks")),
        nonnull.where(_is("ad_error")).groupBy(*keys).agg(F.count(F.lit(1)).alias("errors")),
        nonnull.where(_is("ad_impression"))
        .groupBy(*keys)
        .agg(F.coalesce(F.sum("clearing_price_micros"), F.lit(0)).cast("bigint").alias("revenue_micros")),
        nonnull.where(_is("ad_quartile") & (F.col("quartile") == 100))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("completions")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, keys, "full")
    out = out.select(
        *keys,
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in COUNT_COLUMNS],
        F.coalesce(F.col("revenue_micros"), F.lit(0)).cast("bigint").alias("revenue_micros"),
    )
    return with_campaign_rates(out)


def campaign_daily_raw_rates(silver: DataFrame) -> DataFrame:
    """The JVM job's variant: three counts, revenue, unrounded fill_rate and ecpm."""
    return (
        silver.groupBy(*CAMPAIGN_KEYS)
        .agg(
            _count(_is("ad_request")).alias("requests"),
            _count(_is("ad_impression")).alias("impressions"),
            _count(_is("ad_click")).alias("clicks"),
            F.coalesce(F.sum(F.when(_is("ad_impression"), F.col("clearing_price_micros"))), F.lit(0))
            .cast("bigint")
            .alias("revenue_micros"),
        )
        .withColumn("fill_rate", raw_fill_rate("impressions", "requests"))
        .withColumn("ecpm", raw_ecpm("revenue_micros", "impressions"))
    )


def pod_fill(silver: DataFrame) -> DataFrame:
    """Pod grain, null keys kept as their own group."""
    base = silver.groupBy(*POD_KEYS).agg(
        *[F.expr(MEASURES_SQL[m]).alias(m) for m in ("requests", "impressions", "errors")]
    )
    return _pod_columns(base)


def _pod_columns(base: DataFrame) -> DataFrame:
    return base.selectExpr(
        *POD_KEYS,
        "requests",
        "impressions",
        "errors",
        "CASE WHEN impressions > 0 THEN 1 ELSE 0 END AS filled",
        f"{rate_sql('impressions', 'requests')} AS pod_fill_rate",
    )


def campaign_daily_columns() -> list[str]:
    return [*CAMPAIGN_KEYS, *COUNT_COLUMNS, "revenue_micros", "revenue", "fill_rate", "ctr", "completion_rate", "ecpm"]


def pod_fill_columns() -> list[str]:
    return [*POD_KEYS, "requests", "impressions", "errors", "filled", "pod_fill_rate"]
