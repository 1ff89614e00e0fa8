"""Bronze -> silver: typing, defaults, last-write-wins dedup, event-type filter.

Dedup is the one wide step: rows meet their copies by hashing ``event_id``
(one exchange). Both forms below pre-reduce before that exchange — the window
form gets a partial ``WindowGroupLimit`` and the aggregate form a partial
``max`` — so a hot event id never ships more than one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.contract import BEACON_SCHEMA, EVENT_TYPES, REQUIRED, SILVER_COLUMNS


class ContractError(ValueError):
    """Input does not carry the columns the contract requires."""


def check_required(df: DataFrame) -> DataFrame:
    """Fail (without running a job) when a required column is missing."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ContractError(f"input lacks contract columns: {missing}")
    return df


def _timestamp_sql(df: DataFrame, name: str) -> str:
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampType):
        return f"`{name}`"
    if isinstance(dtype, T.TimestampNTZType):
        return f"CAST(`{name}` AS TIMESTAMP)"
    # ANSI on: unparsable text raises instead of turning into null
    return f"to_timestamp(CAST(`{name}` AS STRING))"


def whole_number_sql(name: str, to: str) -> str:
    """Text to a whole number, exactly: '12.0' is 12, '9007199254740993' stays itself, all else is null."""
    number = f"try_cast(`{name}` AS DECIMAL(38, 10))"
    return f"CASE WHEN {number} = floor({number}) THEN try_cast({number} AS {to}) END"


def _integer_sql(df: DataFrame, name: str, to: str) -> str:
    """P7 by the column's type: integers are cast, doubles tested for a fraction, text read as a decimal."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return f"CAST(`{name}` AS {to})"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return f"CASE WHEN `{name}` = floor(`{name}`) THEN try_cast(`{name}` AS {to}) END"
    return whole_number_sql(name, to)


def conform(df: DataFrame) -> DataFrame:
    """Typed timestamps, UTC event_date, defaults, numeric coercion.

    Optional columns that are absent get their default; the output has the
    beacon schema plus ``event_date`` (and keeps any extra columns such as ``dt``).
    Written as SQL expression text (one JVM parse, not a Column per operator).
    """
    check_required(df)
    cols = set(df.columns)
    event_ts = _timestamp_sql(df, "event_ts")
    exprs = {
        "event_ts": event_ts,
        "ingest_ts": f"coalesce({_timestamp_sql(df, 'ingest_ts')}, {event_ts})" if "ingest_ts" in cols else event_ts,
        "slot_index": f"coalesce({_integer_sql(df, 'slot_index', 'INT')}, 0)" if "slot_index" in cols else "0",
        "is_late": "coalesce(CAST(is_late AS BOOLEAN), false)" if "is_late" in cols else "false",
    }
    for name, to in (("quartile", "INT"), ("bid_floor_micros", "BIGINT"), ("clearing_price_micros", "BIGINT")):
        exprs[name] = _integer_sql(df, name, to) if name in cols else "NULL"
    out = []
    for f in BEACON_SCHEMA.fields:
        e = exprs.get(f.name, f"`{f.name}`" if f.name in cols else "NULL")
        out.append(f"CAST({e} AS {f.dataType.simpleString()}) AS {f.name}")
    beacon = {f.name for f in BEACON_SCHEMA.fields}
    extra = [f"`{c}`" for c in df.columns if c not in beacon and c != "event_date"]
    # The UTC calendar date of the instant (session time zone is UTC)
    return df.selectExpr(*out, *extra).selectExpr("*", "to_date(event_ts) AS event_date")


TIE = "__tie"


def _tie_columns(by: Sequence[str]) -> list[str]:
    return [c for c in SILVER_COLUMNS if c not in ("ingest_ts", "is_late", "event_date") and c not in by]


def row_tie(by: Sequence[str]) -> str:
    """One 64-bit digest of the rest of the row, the last tie-breaker (SQL text).

    It is computed before the exchange and replaces the row's columns in the
    sort key, so columns the caller does not use are pruned below the shuffle.
    Null flags are hashed too (a null contributes nothing to ``xxhash64``).
    """
    cols = _tie_columns(by)
    return "xxhash64(" + ", ".join([f"`{c}`" for c in cols] + [f"`{c}` IS NULL" for c in cols]) + ")"


# Latest ingest wins (null loses); ties go to the late copy, then to the
# larger row digest — a deterministic total order, whatever the input order.
WINNER_ORDER_SQL = f"ingest_ts DESC NULLS LAST, is_late DESC NULLS LAST, {TIE} DESC"


def _winner_fields(by: Sequence[str]) -> list[str]:
    return ["ingest_ts", "is_late", TIE]


def dedup_window(df: DataFrame, by: Sequence[str] = ("event_id",)) -> DataFrame:
    """``row_number() = 1`` per key under the winner order."""
    keys = ", ".join(f"`{k}`" for k in by)
    rank = f"row_number() OVER (PARTITION BY {keys} ORDER BY {WINNER_ORDER_SQL}) AS __rn"
    ranked = df.selectExpr("*", f"{row_tie(by)} AS {TIE}").selectExpr("*", rank)
    return ranked.where("__rn = 1").drop("__rn", TIE)


def dedup_max(df: DataFrame, by: Sequence[str] = ("event_id",)) -> DataFrame:
    """W2 alternative: ``max(struct(ingest_ts, is_late, digest, row...))`` per key.

    Struct comparison is field by field with nulls smallest, which is exactly
    the winner order (each field descending, nulls last). The struct carries the
    whole row, so this form cannot prune columns below its exchange.
    """
    fields = _winner_fields(by)
    carried = [c for c in df.columns if c not in fields and c not in by]
    agg = df.selectExpr("*", f"{row_tie(by)} AS {TIE}").groupBy(*by).agg(F.max(F.struct(*fields, *carried)).alias("__w"))
    return agg.select(*by, *[F.col("__w")[c].alias(c) for c in fields + carried if c != TIE])


def keep_contract_types(df: DataFrame) -> DataFrame:
    """event-type filter, applied after dedup (a bad-typed latest copy drops the event)."""
    return df.where("event_type IN (" + ", ".join(f"'{t}'" for t in EVENT_TYPES) + ")")


def silver(df: DataFrame, by: Sequence[str] = ("dt", "event_id"), method: str = "window") -> DataFrame:
    """Typed, deduplicated silver rows: the 20 silver columns plus ``dt`` when present.

    ``by`` = ``("dt", "event_id")`` dedups inside each arrival partition (one
    silver run per day); ``("event_id",)`` dedups across partitions (W3).
    """
    typed = conform(df)
    dedup = dedup_window if method == "window" else dedup_max
    kept = keep_contract_types(dedup(typed, by))
    tail = ["dt"] if "dt" in df.columns else []
    return kept.select(*SILVER_COLUMNS, *tail)


def staging(silver_scan: DataFrame) -> DataFrame:
    """Staging projection over all silver partitions (drops ``dt``)."""
    casts = {"event_ts": "timestamp", "ingest_ts": "timestamp", "event_date": "date"}
    return silver_scan.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in SILVER_COLUMNS])
