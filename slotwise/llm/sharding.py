"""Operator 10: contiguous shards of nearly equal bytes.

Method: rows are laid out in one global order, every range partition of that
order reports its byte and row totals, the totals' prefix sums give each
partition its global start, and the line of bytes is cut at equal targets.

The global order is the hash of the group column (the text), so copies of one
text are neighbours. A group smaller than ``max_group_share`` of a shard is never
cut: it goes where its first byte falls. A larger one is dealt by its rows'
own positions, salted over the range partitions, so that no task and no shard
gets it whole. A shard therefore differs from the target by less than one such
group or one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.llm.common import free_names, quoted, stored


def byte_shards(
    df: DataFrame, id_col: str, size_col: str, group_col: str, shards: int = 24, max_group_share: float = 1 / 64
) -> DataFrame:
    """``df`` plus ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 in each shard).

    ``size_col`` holds each row's bytes (null counts 0), ``group_col`` the value
    whose copies belong together; nulls form one group. Rows equal in id, size
    and group are interchangeable: which of them takes which of their slots is
    free. Columns named ``shard`` or ``slot`` in the input are replaced. An empty
    table gives an empty table; if all sizes are 0, every row goes to shard 0.
    """
    df = df.drop(*[c for c in df.columns if c.lower() in ("shard", "slot")])
    h, tie, size, salt, part, start, row, big, group_start, base = free_names(
        df, "h", "tie", "size_", "salt", "part", "start", "row", "big", "group_start", "base"
    )
    keyed = df.withColumns(
        {
            h: F.xxhash64(quoted(group_col)),
            tie: F.xxhash64(quoted(id_col), quoted(group_col)),
            size: F.coalesce(quoted(size_col).cast("bigint"), F.lit(0)),
        }
    )
    sums = keyed.groupBy(h).agg(F.sum(size).alias(size))
    total = int(sums.agg(F.sum(size)).first()[0] or 0)
    limit = int(total / shards * max_group_share)
    # at most shards / max_group_share groups can be this large: safe to broadcast
    large = sums.where(F.col(size) > limit).select(h, F.lit(True).alias(big))
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    laid = (
        keyed.join(F.broadcast(large), h, "left")
        .withColumn(salt, F.when(F.col(big), F.col(tie)).otherwise(F.lit(0)))
        .repartitionByRange(parts, h, salt)
        .withColumn(part, F.spark_partition_id())
    )
    laid = stored(laid, "shard-rows")  # the range cut is drawn once, then fixed in files

    totals = laid.groupBy(part).agg(F.sum(size).alias(start), F.count(F.lit(1)).alias(row)).collect()  # one row per partition
    starts, at, rows = [], 0, 0
    for r in sorted(totals, key=lambda r: r[part]):
        starts.append((r[part], at, rows))
        at, rows = at + r[start], rows + r[row]
    offsets = spark.createDataFrame(starts, f"{part} int, {start} bigint, {base} bigint")

    order = W.partitionBy(part).orderBy(h, salt, tie, size)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    placed = laid.join(F.broadcast(offsets), part).withColumns(
        {
            start: F.col(start) + F.coalesce(F.sum(size).over(before), F.lit(0)),
            row: F.col(base) + F.row_number().over(order) - 1,
        }
    )
    placed = placed.withColumn(
        group_start, F.when(F.col(big), F.col(start)).otherwise(F.min(start).over(W.partitionBy(part, h, salt)))
    ).withColumn("shard", _shard_of(F.col(group_start), total, shards))
    first = placed.groupBy("shard").agg(F.min(row).alias(base))  # one row per shard
    out = placed.drop(base).join(F.broadcast(first), "shard")
    return out.select(*[quoted(c) for c in df.columns], F.col("shard"), (F.col(row) - F.col(base)).cast("bigint").alias("slot"))


def _shard_of(start: Column, total: int, shards: int) -> Column:
    if not total:
        return F.lit(0)
    exact = F.floor(start.cast("decimal(38,0)") * F.lit(shards) / F.lit(total).cast("decimal(38,0)"))
    return F.least(exact, F.lit(shards - 1)).cast("int")
