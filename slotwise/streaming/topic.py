"""A topic as a stream source: records with offsets, read at a bounded rate, landed exactly once.

A topic is a sequence of records ``key, value, timestamp``. Here it is a folder
of record files; the file source keeps the offsets in the checkpoint, hands
out at most ``files_per_batch`` files a micro-batch and hands the same ones out
again when a batch did not commit. With the Kafka connector on the class path the same
job reads ``kafka_options``: its records carry the same three columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slotwise.operators import landing
from slotwise.session import configure
from slotwise.streaming.jobs import finish

RECORD_SCHEMA = "key string, value string, timestamp timestamp"
#: Tasks that a day's records of one batch are dealt to, and so the files it lands in at most.
TASKS_PER_DAY = 32
ROW_GROUP_BYTES = 16 * 1024 * 1024


def kafka_options(servers: str, topic: str, records_per_batch: int) -> dict[str, str]:
    """Reader options that make a Kafka topic the source of ``land_topic`` (``source='kafka'``)."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(records_per_batch),
        "failOnDataLoss": "true",
    }


def publish(records: DataFrame, topic: str) -> None:
    """Append records ``key, value, timestamp`` to a topic folder, in row groups that the readers of a large file can share."""
    records.select("key", "value", "timestamp").write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).parquet(topic)


def records(spark: SparkSession, topic: str = "", files_per_batch: int = 1, source: str = "parquet", options: dict[str, str] | None = None) -> DataFrame:
    """The topic as a stream of ``key, value, timestamp``, at most ``files_per_batch`` files (or as ``options`` say) a batch."""
    reader = spark.readStream.format(source).options(**(options or {}))
    if source == "parquet":
        reader = reader.schema(RECORD_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(topic) if topic else reader.load()
    return stream.select(F.col("key").cast("string"), F.col("value").cast("string"), F.col("timestamp").cast("timestamp"))


def land_topic(
    spark: SparkSession, stream: DataFrame, landed_path: str, checkpoint: str, after_write: Callable[[int], None] | None = None
) -> StreamingQuery:
    """S14 (one run): every new record of a topic through the landing contract.

    A record lands under the UTC day of its timestamp and ``src = batch-<id>``, so a
    batch that is replayed, because a run ended between its write and its commit,
    replaces its own partitions: nothing is lost and nothing repeats. ``after_write`` is called
    between the two. A batch may come as one file or one topic partition, so its
    records are dealt by day and value before the contract reads them.
    """
    configure(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        lines = batch.select(F.col("value"), F.to_date("timestamp").alias("dt"), F.lit(f"batch-{batch_id}").alias("src"))
        lines = lines.repartition(tasks, "dt", F.pmod(F.xxhash64("value"), F.lit(TASKS_PER_DAY)))
        landed = landing.classify(lines, landed_at=F.date_format(F.current_timestamp(), landing.TS_TEXT))
        landing.replace_drops(landed, landed_path)
        if after_write:
            after_write(batch_id)

    query = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return finish(query)
