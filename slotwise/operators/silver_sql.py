"""The silver step as Spark SQL over a temp view.

For users who run SQL. The statement is generated from the contract and from the
pieces ``operators.silver`` is made of, so both routes hold one set of rules. JSON
numbers are read as text and coerced in SQL, so ``2.0`` and ``100.0`` are the
integers they are for the DataFrame route.

``build_silver_sql`` first looks for event ids that come more than once, which
moves one number per row. If they are few, only their rows are moved and ranked;
a row that is alone is its event's last copy and goes to silver from where it is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from slotwise.functions.contract import BEACON_SCHEMA, EVENT_TYPES, SILVER_COLUMNS
from slotwise.operators.silver import TIE, WINNER_ORDER_SQL, row_tie, whole_number_sql
from slotwise.session import configure

#: The bronze files as text; only the flag is typed by the reader.
FILE_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType if isinstance(f.dataType, T.BooleanType) else T.StringType()) for f in BEACON_SCHEMA.fields]
)


def _typed(field: T.StructField) -> str:
    """One contract column from its received form: instants, whole numbers, defaults."""
    name, kind = field.name, field.dataType
    if name == "ingest_ts":
        value = "coalesce(CAST(ingest_ts AS TIMESTAMP), CAST(event_ts AS TIMESTAMP))"
    elif isinstance(kind, T.TimestampType):
        value = f"CAST({name} AS TIMESTAMP)"
    elif isinstance(kind, (T.IntegerType, T.LongType)):
        value = whole_number_sql(name, kind.simpleString())
        value = f"coalesce({value}, 0)" if name == "slot_index" else value
    elif isinstance(kind, T.BooleanType):
        value = f"coalesce({name}, false)"
    else:
        value = name
    return f"{value} AS {name}"


#: Up to this many repeated events are ranked apart from the others: their hashes go to every task.
MOST_REPEATS = 1_000_000
TYPED = ", ".join(_typed(f) for f in BEACON_SCHEMA.fields)
TYPES = ", ".join(f"'{t}'" for t in EVENT_TYPES)


def silver_statement(view: str) -> str:
    """Typed rows of ``view``, the winner of each event, contract event types only."""
    place = f"row_number() OVER (PARTITION BY event_id ORDER BY {WINNER_ORDER_SQL})"
    return (
        f"SELECT {', '.join(SILVER_COLUMNS)} FROM ("
        f" SELECT *, {place} AS place, to_date(event_ts) AS event_date FROM ("
        f" SELECT *, {row_tie(('event_id',))} AS {TIE} FROM (SELECT {TYPED} FROM {view})))"
        f" WHERE place = 1 AND event_type IN ({TYPES})"
    )


def repeats_statement(view: str) -> str:
    """Hashes of the event ids that come more than once (null is an id, as it is for the ranking).

    Ids that share a hash only add rows to the ranking, which goes by the id itself.
    """
    return f"SELECT xxhash64(event_id) AS id_hash FROM {view} GROUP BY xxhash64(event_id) HAVING count(*) > 1"


def few_repeats_statement(view: str, repeats: str) -> str:
    """The rows of ``silver_statement``, where the view ``repeats`` holds the hashes of all repeated ids.

    Only rows of repeated ids and of foreign types are moved and ranked. The types are compared as a
    computed value: as a filter of the JSON reader they would meet the first of a line's double keys, not the last.
    """
    ranked = f"(r.id_hash IS NOT NULL OR coalesce(b.event_type, '') NOT IN ({TYPES}))"
    rows = f"SELECT /*+ BROADCAST(r) */ b.* FROM {view} b LEFT JOIN {repeats} r ON xxhash64(b.event_id) = r.id_hash"
    return (
        f"SELECT {', '.join(SILVER_COLUMNS)} FROM (SELECT *, to_date(event_ts) AS event_date FROM (SELECT {TYPED} FROM ({rows} WHERE NOT {ranked})))"
        f" UNION ALL {silver_statement(f'({rows} WHERE {ranked})')}"
    )


def silver_from_view(spark: SparkSession, view: str) -> DataFrame:
    configure(spark)
    return spark.sql(silver_statement(view))


@contextmanager
def _many_read_tasks(spark: SparkSession) -> Iterator[None]:
    """Small files are spread over as many tasks as there are shuffle partitions: a few compressed ones hold much text."""
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def build_silver_sql(spark: SparkSession, bronze_path: str, silver_path: str, view: str = "bronze_ad_events") -> None:
    """S4 + K5: bronze JSON (explicit schema) -> temp view -> SQL -> whole-path overwrite."""
    configure(spark)
    spark.read.schema(FILE_SCHEMA).json(bronze_path).createOrReplaceTempView(view)
    with _many_read_tasks(spark):
        repeats = spark.sql(repeats_statement(view)).persist()
        repeats.createOrReplaceTempView(f"{view}_repeats")
        try:
            if repeats.count() <= MOST_REPEATS:
                rows = spark.sql(few_repeats_statement(view, f"{view}_repeats"))
            else:
                repeats.unpersist()
                rows = silver_from_view(spark, view)
            rows.write.mode("overwrite").parquet(silver_path)
        finally:
            repeats.unpersist()
            spark.catalog.dropTempView(f"{view}_repeats")
