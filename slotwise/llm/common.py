"""Small helpers used by several operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.session import scratch_path, ship_package


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back.

    This cuts the lineage: later stages depend on files that every executor can
    reach. The schema is handed over, so an empty table reads back as well.
    """
    ship_package(df.sparkSession)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that ``df`` does not use yet (case ignored)."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """A top-level column, also when its name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def arrow_map(df: DataFrame, schema: str, make: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """``mapInArrow`` over columns as Python lists.

    ``make()`` runs once per task and returns ``columns -> columns``; its state
    (models, caches) lives as long as the task. Batches stay as Spark cut them.
    """
    ship_package(df.sparkSession)
    target = df.sparkSession.createDataFrame([], schema).schema
    fields = pa.schema([(f.name, _arrow_type(f.dataType)) for f in target.fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            got = each({n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)})
            yield pa.record_batch([pa.array(got[f.name], f.type) for f in fields], schema=fields)

    return df.mapInArrow(run, target)


#: Bytes of rows that travel to a Python worker at once, so that a batch of long texts stays small.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes too (Spark's default bounds their rows only), unless the session does so itself."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def with_fields(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` followed by the fields of ``ddl``."""
    return T.StructType(df.schema.fields + T.StructType.fromDDL(ddl).fields)


def _arrow_type(t) -> pa.DataType:
    plain = {
        T.LongType: pa.int64(),
        T.IntegerType: pa.int32(),
        T.DoubleType: pa.float64(),
        T.FloatType: pa.float32(),
        T.StringType: pa.string(),
        T.BinaryType: pa.binary(),
        T.BooleanType: pa.bool_(),
    }
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    return plain[type(t)]


def runs_of(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[list[list]]:
    """Columns of each run of rows that agree in the first ``keys`` columns, across batch borders.

    The input must arrive sorted (or at least gathered) by those columns; one run
    is held at a time.
    """
    held: list[list] = []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        if not columns or not columns[0]:
            continue
        n, at = len(columns[0]), 0
        for i in range(1, n + 1):
            if i < n and all(columns[k][i] == columns[k][i - 1] for k in range(keys)):
                continue
            part = [c[at:i] for c in columns]
            if held and all(held[k][0] == part[k][0] for k in range(keys)):
                for old, new in zip(held, part):
                    old += new
            else:
                if held:
                    yield held
                held = part
            at = i
    if held:
        yield held
