"""Structured Streaming jobs that keep state: last write wins, closed days, the lateness split.

* ST3 ``lww_stream``: the winner of each event is a streaming aggregate,
  ``max(struct(order, row))`` per event, so a copy is compared with state and not
  with the received history. Each micro-batch reads its own changes and the change log
  of the event dates it touches, nothing else.
* ST4 ``closed_days_stream``: event-time windows in append mode. A day is written
  once, when the watermark has passed its end, and never changed.
* ST2 ``lateness_split_stream``: both sides of the lateness rule from one pass over a batch.

All use checkpoints in the shared folder and ``availableNow`` runs. What a batch
writes goes to partitions of its own, so a replayed batch overwrites itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from slotwise.functions.contract import LATE_WINDOW_HOURS, SILVER_COLUMNS
from slotwise.operators import silver
from slotwise.session import configure
from slotwise.streaming.jobs import ARRIVAL_SCHEMA, daily_counts, finish, lateness, replace_dates

#: Hours of arrivals that share one state group besides the lateness window, and of watermark delay.
EPOCH_HOURS, DELAY_HOURS = 144, 24


def arrivals(spark: SparkSession, bronze: str, files_per_batch: int | None = None) -> DataFrame:
    """The stream of beacons of a folder, at most ``files_per_batch`` new files in a micro-batch."""
    reader = spark.readStream.schema(ARRIVAL_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(bronze)


def _run(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    return finish(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


# --- ST3 -------------------------------------------------------------------------------


@dataclass(frozen=True)
class BatchFigures:
    """What one micro-batch changed and read."""

    batch_id: int
    changes: int
    read: int
    dates: tuple[str, ...]


def winners(stream: DataFrame, late_hours: int = LATE_WINDOW_HOURS, epoch_hours: int = EPOCH_HOURS, delay_hours: int = DELAY_HOURS) -> DataFrame:
    """``event_id, winner, dates`` as a stateful aggregate (update mode): the winning row, and every date its copies carried.

    State is grouped by event and by overlapping windows of arrival time: one every
    ``epoch_hours``, each ``late_hours`` longer, so any two copies that arrive within
    ``late_hours`` of each other meet in one of them. A window's state goes when the
    watermark on the arrival time passes its end, so state holds about an epoch of events,
    not all of them. The winner order is that of the batch dedup (W1).
    """
    typed = lateness(silver.conform(stream)).selectExpr("*", f"{silver.row_tie(('event_id',))} AS {silver.TIE}")
    order = ["ingest_ts", "is_late", silver.TIE]
    rest = [c for c in [*SILVER_COLUMNS, "too_late"] if c not in ("event_id", *order)]
    epoch = F.window("arrived", f"{epoch_hours + late_hours} hours", f"{epoch_hours} hours")
    seen = typed.withColumn("arrived", F.col("ingest_ts")).withWatermark("arrived", f"{delay_hours} hours")
    return seen.groupBy(epoch, "event_id").agg(
        F.max(F.struct(*order, *rest)).alias("winner"), F.collect_set("event_date").alias("dates")
    )


def _log(batch: DataFrame, batch_id: int) -> DataFrame:
    """A change per date that the event's copies carry: the winning row, ``gone`` on the dates where it is not."""
    rows = batch.select("event_id", "winner.*", F.explode("dates").alias("day")).drop(silver.TIE)
    return rows.withColumns({"gone": F.col("day") != F.col("event_date"), "batch_id": F.lit(batch_id).cast("bigint")})


def _standing(changes: DataFrame) -> DataFrame:
    """The current rows of the logged dates: each event's best change, unless it is gone from the date."""
    best = silver.dedup_window(changes, by=("day", "event_id")).where("NOT gone")
    return silver.keep_contract_types(best).select(*SILVER_COLUMNS, "too_late")


def lww_stream(
    spark: SparkSession,
    bronze: str,
    root: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    report: Callable[[BatchFigures], None] | None = None,
) -> StreamingQuery:
    """ST3 (one run): last-write-wins silver at ``<root>/silver``, kept current from streaming state.

    A micro-batch writes the changed winners to ``<root>/changes`` (partitions ``day,
    batch_id``) and rebuilds the silver of these days from the days' own changes. A copy that
    arrives later than the lateness window is compared through its day's log, so
    it is not lost either; only a copy that is both later than that and
    carries another event date than the copies before leaves those dates as they
    are (the batch flow's re-run settles it). Rows behind the watermark, stamped more than the
    delay before others that were already read, are for the batch flow as well.
    """
    configure(spark)
    log = f"{root}/changes"

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        made, read = Observation(f"changes_{batch_id}"), Observation(f"read_{batch_id}")
        rows = _log(batch, batch_id).observe(made, F.collect_set("day").alias("days"), F.count(F.lit(1)).alias("n"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(log)
        days = sorted(str(d) for d in (made.get.get("days") or []) if d is not None)
        if not days:
            return
        wanted = F.col("day").isin([F.lit(d).cast("date") for d in days])
        changes = spark.read.parquet(log).where(wanted).observe(read, F.count(F.lit(1)).alias("n"))
        replace_dates(spark, _standing(changes), f"{root}/silver", days)
        if report:
            report(BatchFigures(batch_id, made.get["n"], read.get["n"], tuple(days)))

    stream = winners(arrivals(spark, bronze, files_per_batch))
    return _run(stream.writeStream.outputMode("update").foreachBatch(each_batch), checkpoint)


# --- ST4 -------------------------------------------------------------------------------


def closed_days_stream(spark: SparkSession, bronze: str, out: str, checkpoint: str, late_hours: int = LATE_WINDOW_HOURS, files_per_batch: int | None = None) -> StreamingQuery:
    """ST4 (one run): counts of the days that are closed, appended once per day.

    Copies of an event count once (the first one received: copies share type and grain), and
    a day is closed when the newest event time seen is ``late_hours`` past its end. State holds
    the open days' counts and the ids of the lateness window. A row of a closed day is
    dropped by rule; ``daily_counts_stream`` is the job that corrects days instead.
    """
    configure(spark)
    once = silver.conform(arrivals(spark, bronze, files_per_batch)).withWatermark("event_ts", f"{late_hours} hours")
    once = silver.keep_contract_types(once.dropDuplicatesWithinWatermark(["event_id"]))
    counts = daily_counts(once.drop("event_date"), day=F.window("event_ts", "1 day"))
    rows = counts.withColumn("event_date", F.to_date("window.start")).drop("window")
    return _run(rows.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint)


# --- ST2 -------------------------------------------------------------------------------

ON_TIME, TOO_LATE = "on_time", "too_late"


def lateness_split_stream(spark: SparkSession, bronze: str, received: str, checkpoint: str, late_hours: int = LATE_WINDOW_HOURS, files_per_batch: int | None = None) -> StreamingQuery:
    """ST2 (one run): every received row to its side of the lateness rule, in one write per micro-batch.

    ``received`` is partitioned by ``side, event_date, batch_id``; ``side_of`` reads one
    side with partition pruning. A row stamped exactly ``late_hours`` after its event is on time.
    """
    configure(spark)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        flagged = lateness(silver.conform(batch), late_hours)
        sides = flagged.withColumns(
            {"side": F.when(F.col("too_late"), TOO_LATE).otherwise(ON_TIME), "batch_id": F.lit(batch_id).cast("bigint")}
        ).drop("too_late", "dt")
        (
            sides.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("side", "event_date", "batch_id")
            .parquet(received)
        )

    return _run(arrivals(spark, bronze, files_per_batch).writeStream.foreachBatch(each_batch), checkpoint)


def side_of(spark: SparkSession, received: str, side: str) -> DataFrame:
    """The rows on one side of the lateness rule."""
    return spark.read.parquet(received).where(F.col("side") == side).drop("side", "batch_id")
