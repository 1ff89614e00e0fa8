"""Structured Streaming jobs: landing, last-write-wins repair, rolling day counts.

All three read a file source (Kafka when its connector is on the classpath:
swap ``readStream.text(path)`` for ``format('kafka')`` + ``value``), keep
their progress in a checkpoint under the shared folder, and run as repeated
``availableNow`` triggers — a scheduled incremental job that processes what
has arrived since the last run, then stops.

* ST1 ``landing_stream``: raw lines -> contract rules -> the batch landing's write.
* ST2 lateness: ``ingest_ts - event_ts`` beyond the accepted window is a row
  flag (``too_late``), kept and counted — a watermark alone only bounds state.
* ST3 ``repair_stream``: last write wins. Built-in streaming dedup keeps the
  *first* copy, so each micro-batch instead (1) writes its rows to ``raw``
  partitioned by ``(event_date, batch_id)`` — a replayed batch overwrites its
  own partitions — and (2) rebuilds the silver partitions of the event dates it
  touched from all raw rows of those dates with the batch dedup (W1). Both
  steps recompute rather than add, so a replay is harmless.
* ST4 ``daily_counts_stream``: day counts per campaign grain, rebuilt the same way for
  the dates a batch touches, so every day is present and late rows correct it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from slotwise.functions.contract import BEACON_SCHEMA, LATE_WINDOW_HOURS, SILVER_COLUMNS
from slotwise.operators import landing, silver
from slotwise.plans.flow import drop_folder, drop_partition, table_exists
from slotwise.session import configure

DT_FROM_PATH = r"dt=([0-9]{4}-[0-9]{2}-[0-9]{2})"
ARRIVAL_SCHEMA = T.StructType([*BEACON_SCHEMA.fields, T.StructField("dt", T.DateType())])


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` run to end; raise what ended it."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise exc
    return query


# --- ST1 -----------------------------------------------------------------------------


def landing_stream(spark: SparkSession, drops: str, landed_path: str, checkpoint: str) -> StreamingQuery:
    """Validate every newly arrived drop line and write it to ``landed`` (one run).

    Each micro-batch goes through the batch landing's own write: partitions
    ``(dt, src)``, overwritten as a whole. Batch and stream can fill one table,
    a re-landed drop replaces its rows, and a replayed batch changes nothing.
    """
    configure(spark)
    lines = spark.readStream.text(drops).select(
        F.col("value"),
        F.regexp_extract(F.col("_metadata.file_path"), DT_FROM_PATH, 1).cast("date").alias("dt"),
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("src"),
    )

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        landed = landing.classify(batch, landed_at=F.date_format(F.current_timestamp(), landing.TS_TEXT))
        landing.replace_drops(landed, landed_path)

    query = (
        lines.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return finish(query)


# --- ST2 / ST3 -------------------------------------------------------------------------


def lateness(df: DataFrame, hours: int = LATE_WINDOW_HOURS) -> DataFrame:
    """ST2: flag rows that arrived more than ``hours`` after the event."""
    limit = F.expr(f"INTERVAL {int(hours)} HOURS")
    return df.withColumn("too_late", (F.col("ingest_ts") - F.col("event_ts")) > limit)


def too_late(spark: SparkSession, raw_path: str) -> DataFrame:
    """ST2: every received copy that arrived beyond the accepted lateness."""
    return spark.read.parquet(raw_path).where(F.col("too_late"))


def _receive(spark: SparkSession, raw_path: str, batch: DataFrame, batch_id: int) -> list[str]:
    """Write a batch to ``raw`` (``event_date, batch_id``); returns every event date it can change.

    These are the batch's own dates and the dates of other copies of its events:
    a copy under another date competes with them. The copies of such events are
    appended to ``<raw>_moved``. One hash aggregate over the received ids finds the events;
    their copies are looked up only if there are any.
    """
    typed = lateness(silver.conform(batch))
    seen = Observation(f"batch_{batch_id}")
    (
        typed.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .observe(seen, F.collect_set("event_date").alias("dates"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "batch_id")
        .parquet(raw_path)
    )
    own = {str(d) for d in (seen.get.get("dates") or []) if d is not None}
    if not own:
        return []
    raw = spark.read.parquet(raw_path)
    spread, moved = Observation(f"spread_{batch_id}"), Observation(f"moved_{batch_id}")
    path = f"{raw_path}_spread-{batch_id}"
    events = spread_events(raw, batch_id).observe(spread, F.count(F.lit(1)).alias("n"))
    events.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    dates: set[str] = set()
    if spread.get.get("n"):
        copies = raw.select("event_id", "event_date").join(spark.read.schema("event_id string").parquet(path), "event_id", "left_semi")
        found = copies.distinct().observe(moved, F.collect_set("event_date").alias("dates"))
        found.write.mode("append").parquet(f"{raw_path}_moved")
        dates = {str(d) for d in (moved.get.get("dates") or [])}
    drop_folder(spark, path)
    return sorted(own | dates)


def spread_events(raw: DataFrame, batch_id: int) -> DataFrame:
    """``event_id`` of the batch's events whose received copies carry different event dates (none counts as one)."""
    each = raw.groupBy("event_id").agg(
        F.min("event_date").alias("lo"),
        F.max("event_date").alias("hi"),
        F.count_if(F.col("event_date").isNull()).alias("undated"),
        F.count_if(F.col("batch_id") == batch_id).alias("own"),
    )
    return each.where("event_id IS NOT NULL AND own > 0 AND (lo <> hi OR (undated > 0 AND lo IS NOT NULL))").select("event_id")


def _current(spark: SparkSession, raw_path: str, dates: list[str]) -> DataFrame:
    """The winning copies whose event date is one of ``dates``, out of all copies received."""
    wanted = F.col("event_date").isin([F.lit(d).cast("date") for d in dates])
    raw = spark.read.parquet(raw_path)
    scope = raw.where(wanted)
    if table_exists(spark, f"{raw_path}_moved"):
        moved = spark.read.schema("event_id string, event_date date").parquet(f"{raw_path}_moved").select("event_id").distinct()
        scope = scope.unionByName(raw.where(~wanted).join(moved, "event_id", "left_semi").select(*raw.columns))
    best = silver.keep_contract_types(silver.dedup_window(scope, by=("event_id",)))
    return best.where(wanted)


def replace_dates(spark: SparkSession, rows: DataFrame, path: str, dates: list[str]) -> None:
    """Overwrite the partitions of ``dates``; a date left without rows loses its partition."""
    made = Observation("dates")
    (
        rows.observe(made, F.collect_set("event_date").alias("dates"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )
    for gone in sorted(set(dates) - {str(d) for d in (made.get.get("dates") or [])}):
        drop_partition(spark, path, "event_date", gone)


def _rebuild(spark: SparkSession, raw_path: str, silver_path: str):
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        dates = _receive(spark, raw_path, batch, batch_id)
        if dates:
            replace_dates(spark, _current(spark, raw_path, dates).select(*SILVER_COLUMNS, "too_late"), silver_path, dates)

    return each_batch


def repair_stream(spark: SparkSession, bronze: str, raw_path: str, silver_path: str, checkpoint: str) -> StreamingQuery:
    """ST3 (one run): last-write-wins silver kept current from a stream of beacons."""
    configure(spark)
    stream = spark.readStream.schema(ARRIVAL_SCHEMA).parquet(bronze)
    query = (
        stream.writeStream.foreachBatch(_rebuild(spark, raw_path, silver_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return finish(query)


# --- ST4 -------------------------------------------------------------------------------


def daily_counts(rows: DataFrame, day: Column | str = "event_date") -> DataFrame:
    """Counts per event date (or window) and campaign grain of deduplicated rows."""
    is_type = lambda t: F.col("event_type") == t
    return rows.groupBy(day, "campaign_id", "market", "platform", "break_type").agg(
        F.count_if(is_type("ad_request")).alias("requests"),
        F.count_if(is_type("ad_impression")).alias("impressions"),
        F.count_if(is_type("ad_click")).alias("clicks"),
        F.count_if(is_type("ad_error")).alias("errors"),
        F.count_if(is_type("ad_quartile") & (F.col("quartile") == 100)).alias("completions"),
    )


def daily_counts_stream(spark: SparkSession, bronze: str, raw_path: str, out_path: str, checkpoint: str) -> StreamingQuery:
    """ST4 (one run): day counts kept current; every touched day is counted anew from all its rows.

    Nothing is dropped for lateness and no day waits for a watermark: a late row
    recomputes its day. The partial aggregates and the dedup's partial group limit
    run before each shuffle, so a hot event or campaign does not meet in one task.
    """
    configure(spark)
    stream = spark.readStream.schema(ARRIVAL_SCHEMA).parquet(bronze)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        dates = _receive(spark, raw_path, batch, batch_id)
        if dates:
            replace_dates(spark, daily_counts(_current(spark, raw_path, dates)), out_path, dates)

    query = (
        stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    return finish(query)


# --- arrivals for tests and the catalog --------------------------------------------------


def arrival_chunks(rows: DataFrame, chunks: int) -> list[list[str]]:
    """Arrival days (``dt``) in order, split into ``chunks`` contiguous runs."""
    dts = sorted(str(r[0]) for r in rows.select("dt").distinct().collect())
    size = max(1, -(-len(dts) // max(1, chunks)))
    return [dts[i : i + size] for i in range(0, len(dts), size)]


def arrive(rows: DataFrame, folder: str, dts: list[str]) -> None:
    """Drop the beacons of some arrival days into a stream's source folder."""
    day = rows.where(F.col("dt").isin([F.lit(d).cast("date") for d in dts]))
    day.write.mode("append").parquet(folder)
