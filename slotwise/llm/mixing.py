"""Operator 4: mix sources to target weights by Poisson replication (DataFrame functions only).

Each source gets a mean repetition rate
``rate = epochs * total_bytes * weight / bytes(source)``; each document draws its
number of copies by inverting the Poisson distribution of that rate at a uniform
number taken from ``md5(seed:piece:id)``. The copies are exploded and sorted by
another hash, which shuffles them globally. A rate above ``PIECE`` is split into
equal parts that are drawn one by one and added (a sum of Poisson counts is
Poisson), so no rate is cut and no ``exp(-rate)`` underflows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import free_names, quoted, stored

#: Largest rate inverted at once, and the number of terms its distribution is
#: summed to: P(count > 64 | rate 8) is below 2**-52, the step of the uniform number.
PIECE = 8.0
TERMS = 64
#: Most sources whose rates are broadcast; with more, the rates are joined by a shuffle.
BROADCAST_SOURCES = 50_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits from the MD5 of the colon-joined parts."""
    text = F.concat_ws(":", *parts)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(2**52))


def source_rates(docs: DataFrame, source_col: str, bytes_col: Column, alpha: float, epochs: float, weights: dict | None) -> DataFrame:
    """One row per source: ``source, bytes, rate``. Weights default to ``bytes ** alpha``, scaled to sum to 1."""
    per = docs.groupBy(quoted(source_col).alias("source")).agg(F.sum(bytes_col).alias("bytes"))
    if weights is None:
        weight = F.pow(F.col("bytes").cast("double"), F.lit(alpha))
    else:
        keys = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))])
        weight = F.coalesce(keys[F.col("source")], F.lit(0.0))
    per = stored(per.withColumn("weight", weight), "source-bytes")
    sums = per.agg(F.sum("bytes"), F.sum("weight")).first()  # two numbers
    total, every = float(sums[0] or 0), float(sums[1] or 0)
    return per.select(
        "source",
        "bytes",
        (F.lit(epochs) * F.lit(total) * (F.col("weight") / F.lit(every)) / F.col("bytes")).alias("rate")
        if every
        else F.lit(0.0).alias("rate"),
    )


def poisson_count(rate: Column, key: Column, seed: int) -> Column:
    """The number of copies: parts of at most ``PIECE`` inverted at their own uniform numbers and added.

    ``rate`` null or not above 0 gives 0.
    """
    parts = F.greatest(F.ceil(rate / F.lit(PIECE)), F.lit(1)).cast("int")
    mean = rate / parts

    def inverse(i: Column) -> Column:
        u = uniform(F.lit(str(seed)), i.cast("string"), key)
        zero = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"), F.lit(0).alias("k"))
        step = F.aggregate(
            F.sequence(F.lit(1), F.lit(TERMS)),
            zero,
            lambda s, k: F.when(
                s["cdf"] <= u,
                F.struct(
                    (s["p"] * mean / k).alias("p"),
                    (s["cdf"] + s["p"] * mean / k).alias("cdf"),
                    k.alias("k"),
                ),
            ).otherwise(s),
        )
        return step["k"]

    total = F.aggregate(F.sequence(F.lit(0), parts - 1), F.lit(0), lambda s, i: s + inverse(i))
    return F.when(rate > 0, total).otherwise(0)


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    alpha: float = 0.7,
    epochs: float = 1.0,
    weights: dict | None = None,
    seed: int = 17,
) -> DataFrame:
    """Every copy of every document, globally shuffled: ``docs`` plus ``copy`` (from 0) and ``mix_key``.

    Sizes are UTF-8 bytes of the text plus 1, so null and empty texts count 1 and
    no source has size 0. A null source is a source of its own (with explicit
    ``weights`` it has weight 0, like every source not named). Rows that repeat
    an id draw the same count. A null id draws as the text ``null``. Columns named
    ``copy`` or ``mix_key`` in the input are replaced. An empty table stays empty.
    Rows come sorted by ``mix_key`` over the whole result.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("copy", "mix_key")])
    size = F.octet_length(F.coalesce(quoted(text_col), F.lit(""))).cast("bigint") + 1
    rates = stored(source_rates(docs, source_col, size, alpha, epochs, weights), "source-rates")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    source, rate, count = free_names(docs, "rate_source", "rate", "copies")
    rates = rates.select(F.col("source").alias(source), F.col("rate").alias(rate))
    key = F.coalesce(quoted(id_col).cast("string"), F.lit("null"))
    drawn = (
        docs.join(rates, quoted(source_col).eqNullSafe(F.col(source)), "inner")
        .withColumn(count, poisson_count(F.col(rate), key, seed))
        .where(F.col(count) > 0)
    )
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col(count) - 1)))
    shuffled = copies.withColumn("mix_key", uniform(F.lit(f"{seed}/mix"), F.col("copy").cast("string"), key))
    return shuffled.orderBy("mix_key", "copy").select(*[quoted(c) for c in docs.columns], "copy", "mix_key")


def oracle_sql(alpha: float = 0.7, epochs: float = 1.0, seed: int = 17) -> str:
    """The same rows in DuckDB SQL over ``documents``: a recursive sum inverts the distribution."""
    unit = "(('0x' || substr(md5({}), 1, 13))::BIGINT / 4503599627370496.0)"
    u = unit.format(f"'{seed}:' || piece || ':' || id")
    mix = unit.format(f"'{seed}/mix:' || copy || ':' || id")
    return f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS id, source, strlen(coalesce(text, '')) + 1 AS b FROM documents),
per AS (SELECT source, CAST(sum(b) AS DOUBLE) AS bytes, pow(CAST(sum(b) AS DOUBLE), {alpha}) AS weight FROM sized GROUP BY source),
rates AS (SELECT source, {epochs} * (SELECT sum(bytes) FROM per) * (weight / (SELECT sum(weight) FROM per)) / bytes AS rate FROM per),
parts AS (SELECT source, rate, greatest(ceil(rate / {PIECE}), 1) AS n FROM rates),
dist(source, mean, k, p, cdf) AS (
  SELECT source, rate / n, 0, exp(-rate / n), exp(-rate / n) FROM parts
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), cdf + p * mean / (k + 1) FROM dist WHERE k < {TERMS}),
draws AS (
  SELECT s.doc_id, s.id, s.source, p.n, unnest(range(CAST(p.n AS BIGINT))) AS piece
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source),
hit AS (SELECT *, {u} AS u FROM draws),
counted AS (
  SELECT h.doc_id, h.id, h.source, h.piece, count(*) FILTER (WHERE d.cdf <= h.u AND d.k < {TERMS}) AS k
  FROM hit h JOIN dist d ON h.source IS NOT DISTINCT FROM d.source GROUP BY ALL),
total AS (SELECT doc_id, id, source, CAST(sum(k) AS BIGINT) AS copies FROM counted GROUP BY ALL),
rowsof AS (SELECT doc_id, id, source, unnest(range(copies)) AS copy FROM total WHERE copies > 0)
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy, {mix} AS mix_key FROM rowsof"""
