"""Raw drop -> one ``landed`` table (bronze rows and quarantine rows together).

A drop file is read as text lines; each non-blank line is validated by the
contract projection and kept with its raw text, its rule ids and the parsed
contract columns. One table partitioned by ``(dt, src)`` holds both classes,
so re-landing a corrected drop replaces its old quarantine rows too (dynamic
partition overwrite touches only that drop's partition). Bronze and
quarantine are filtered views of it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.contract import BEACON_SCHEMA
from slotwise.functions.validation import validate

TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
#: Characters that make a line blank: a line of only these is skipped, not quarantined.
BLANKS = " \t\n\r\f\v"


def read_drop(spark: SparkSession, path: str, dt: str | None = None) -> DataFrame:
    """Lines of one or more drop files, with the file stem as ``src``."""
    df = spark.read.text(path).select(
        F.col("value"),
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("src"),
    )
    if dt is not None:
        df = df.withColumn("dt", F.lit(dt).cast("date"))
    return df


def classify(lines: DataFrame, landed_at: _dt.datetime | Column | None = None, strict_timestamps: bool = False) -> DataFrame:
    """Trim, skip blank lines, validate; keep raw text, rule ids, parsed columns.

    Columns other than ``value`` pass through (``dt``, ``src``, ids). ``landed_at``
    stamps a missing ``ingest_ts`` (V17); pass it explicitly for repeatable runs.
    """
    if landed_at is None:
        stamp = F.date_format(F.current_timestamp(), TS_TEXT)
    elif isinstance(landed_at, Column):
        stamp = landed_at
    else:
        stamp = F.lit(landed_at.astimezone(_dt.timezone.utc).isoformat())
    passthrough = [c for c in lines.columns if c != "value"]
    trimmed = lines.select(*passthrough, F.btrim(F.col("value"), F.lit(BLANKS)).alias("value")).where(F.col("value") != "")
    checked = validate(trimmed, "value", strict_timestamps)
    ok = F.size("errors") == 0
    names = [f.name for f in BEACON_SCHEMA.fields]
    landed = checked.select(
        *passthrough,
        "value",
        "errors",
        F.when(ok, "ok").otherwise("bad").alias("status"),
        F.when(~ok, F.array_join("errors", "; ")).alias("error"),
        *[F.when(ok, F.col(n)).alias(n) for n in names],
    )
    return landed.withColumn(
        "ingest_ts", F.when(F.col("status") == "ok", F.coalesce(F.col("ingest_ts"), stamp))
    )


def bronze(landed: DataFrame) -> DataFrame:
    """Valid rows in contract shape (timestamps still text) plus partition columns."""
    tail = [c for c in ("dt", "src") if c in landed.columns]
    return landed.where(F.col("status") == "ok").select(*[f.name for f in BEACON_SCHEMA.fields], *tail)


def quarantine(landed: DataFrame) -> DataFrame:
    """K2: ``raw, error`` for every rejected line (other carried columns kept)."""
    names = {f.name for f in BEACON_SCHEMA.fields} | {"value", "errors", "status", "error"}
    tail = [c for c in landed.columns if c not in names]
    return landed.where(F.col("status") == "bad").select(F.col("value").alias("raw"), "error", *tail)


def replace_drops(landed: DataFrame, landed_path: str) -> None:
    """Write classified lines, replacing exactly the ``(dt, src)`` partitions they belong to.

    No repartition by (dt, src): one drop may hold a third of the day, and every
    input split writing its own files keeps that drop spread out.
    """
    (
        landed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "src")
        .parquet(landed_path)
    )


def land(lines: DataFrame, landed_path: str, landed_at: _dt.datetime | None = None, strict_timestamps: bool = False) -> tuple[int, int]:
    """K1-K3 + V19: write the classified lines, replacing only the ``(dt, src)``
    partitions present in ``lines``; return ``(n_ok, n_bad)`` observed on that
    same write (no second scan). The counts sit on the write's result stage, so
    a retried task (lost executor) is counted once."""
    landed = classify(lines, landed_at, strict_timestamps)
    obs = Observation("landing")
    observed = landed.observe(
        obs,
        F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") == "bad").alias("n_bad"),
    )
    replace_drops(observed, landed_path)
    got = obs.get
    return int(got.get("n_ok", 0) or 0), int(got.get("n_bad", 0) or 0)
