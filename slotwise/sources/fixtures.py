"""Beacons derived from the provided ``events`` table (FIXTURES.md §2, §4).

Each ``events`` row is one ad slot. It expands into its beacons with a per-row
generator (``inline`` over a filtered array of structs): a narrow, map-only
transformation — no join, no shuffle — so it scales with the input files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.contract import BEACON_SCHEMA


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one provided table, dealt over the session's shuffle partitions.

    The provided tables have one row group, so no split size spreads them; the
    same exchange runs at every size. Rows are dealt by their numbers and instants: dealing
    them in turn would make Spark sort each split first, in the one task that reads it.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    by = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType))]
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *by)


# The mapping is written as SQL expression text: it is parsed once on the JVM
# instead of being assembled from thousands of Column calls.
SLOT_SQL = (
    "event_id AS e",
    "user_id AS u",
    "CAST(FLOOR(event_id / 3) AS BIGINT) AS p",
    "CAST(ts AS TIMESTAMP) AS event_ts",
    "CAST(ROUND(value * 10000) AS BIGINT) + 80000 AS floor_micros",
    "(event_id * 13 + user_id) % 100 AS q",
)
SLOT_ATTRS_SQL = (
    "*",
    "CASE WHEN p % 20 < 5 THEN 'preroll' WHEN p % 20 < 17 THEN 'midroll' ELSE 'postroll' END AS break_type",
    "CASE p % 4 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' WHEN 2 THEN 'web' ELSE 'tv' END AS platform",
    "CASE WHEN p % 10 < 7 THEN 'IN' WHEN p % 10 = 7 THEN 'US' WHEN p % 10 = 8 THEN 'GB' ELSE 'AE' END AS market",
)
FILLED_SQL = "(e * 37 + u) % 100 < CASE break_type WHEN 'preroll' THEN 92 WHEN 'midroll' THEN 78 ELSE 85 END"

# one struct per beacon kind: (kind, event_type, quartile, keep-condition)
KINDS_SQL = """inline(filter(array(
    named_struct('kind', 'req',  'event_type', 'ad_request',    'quartile', CAST(NULL AS INT), 'keep', true),
    named_struct('kind', 'err',  'event_type', 'ad_error',      'quartile', CAST(NULL AS INT), 'keep', NOT filled),
    named_struct('kind', 'imp',  'event_type', 'ad_impression', 'quartile', CAST(NULL AS INT), 'keep', filled),
    named_struct('kind', 'late', 'event_type', 'ad_impression', 'quartile', CAST(NULL AS INT),
                 'keep', filled AND e % 50 = 0),
    named_struct('kind', 'clk',  'event_type', 'ad_click',      'quartile', CAST(NULL AS INT),
                 'keep', filled AND platform <> 'tv' AND e % 23 = 0),
    named_struct('kind', 'q25',  'event_type', 'ad_quartile',   'quartile', 25,  'keep', filled),
    named_struct('kind', 'q50',  'event_type', 'ad_quartile',   'quartile', 50,  'keep', filled AND q >= 18),
    named_struct('kind', 'q75',  'event_type', 'ad_quartile',   'quartile', 75,  'keep', filled AND q >= 35),
    named_struct('kind', 'q100', 'event_type', 'ad_quartile',   'quartile', 100, 'keep', filled AND q >= 48)
  ), k -> k.keep))"""

BEACON_SQL = (
    "concat('bcn-', CASE WHEN kind = 'late' THEN 'imp' ELSE kind END, '-', CAST(e AS STRING)) AS event_id",
    "event_type",
    "event_ts",
    "CASE WHEN kind = 'late' THEN event_ts + INTERVAL 12 HOURS ELSE event_ts END AS ingest_ts",
    "concat('sess_', CAST(u AS STRING)) AS session_id",
    "concat('cnt_', CAST(p % 40 AS STRING)) AS content_id",
    "concat('pod_', CAST(p AS STRING)) AS pod_id",
    "CAST(e % 3 AS INT) AS slot_index",
    "break_type",
    "platform",
    "market",
    "concat('cmp_', CAST(p % 7 AS STRING)) AS campaign_id",
    "CASE WHEN kind NOT IN ('req', 'err') THEN concat('cr_', CAST(p % 7 AS STRING)) END AS creative_id",
    "CASE WHEN kind NOT IN ('req', 'err') THEN concat('adv_', CAST(p % 7 AS STRING)) END AS advertiser_id",
    "CAST(quartile AS INT) AS quartile",
    "CASE WHEN kind = 'err' THEN element_at(array('NO_AD', 'TIMEOUT', 'VAST_ERROR'), CAST(e % 3 AS INT) + 1) END"
    " AS error_code",
    "CAST(CASE WHEN kind = 'req' THEN floor_micros END AS BIGINT) AS bid_floor_micros",
    "CAST(CASE WHEN kind = 'imp' THEN floor_micros + (e % 7) * 1000 WHEN kind = 'late' THEN floor_micros + 500 END"
    " AS BIGINT) AS clearing_price_micros",
    "kind = 'late' AS is_late",
)


def _slot_columns(events: DataFrame) -> DataFrame:
    """One row per slot with its derived attributes (FIXTURES.md §2)."""
    return events.selectExpr(*SLOT_SQL).selectExpr(*SLOT_ATTRS_SQL).selectExpr("*", f"{FILLED_SQL} AS filled")


def beacons_from_events(events: DataFrame) -> DataFrame:
    """Typed beacons (contract columns + arrival partition ``dt``)."""
    kinds = _slot_columns(events).selectExpr("*", KINDS_SQL)
    out = kinds.selectExpr(*BEACON_SQL)
    return out.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in BEACON_SCHEMA.fields], "CAST(ingest_ts AS DATE) AS dt")


def beacons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return beacons_from_events(read_table(spark, sf_dir, "events"))


# ---------------------------------------------------------------------------
# Variations of the beacons for rules that the plain mapping does not reach.
# ---------------------------------------------------------------------------

#: The slot number that every beacon's id ends in.
SLOT_NO_SQL = "CAST(regexp_extract(event_id, '([0-9]+)$', 1) AS BIGINT)"
STRAGGLER_HOURS = 40


def with_stragglers(rows: DataFrame) -> DataFrame:
    """Beacons plus a third kind of copy: some impressions come once more ``STRAGGLER_HOURS`` after their event.

    The copies are beyond the accepted lateness and carry a price of their own, so
    a rule that mixes them up with other copies shows in the revenue.
    """
    again = rows.where(f"event_type = 'ad_impression' AND NOT is_late AND {SLOT_NO_SQL} % 120 = 60").withColumns(
        {
            "ingest_ts": F.expr(f"event_ts + INTERVAL {STRAGGLER_HOURS} HOURS"),
            "clearing_price_micros": F.col("clearing_price_micros") + 900,
            "is_late": F.lit(True),
        }
    )
    return rows.unionByName(again.withColumn("dt", F.to_date("ingest_ts")))


def with_moved(rows: DataFrame) -> DataFrame:
    """Beacons plus copies of some impressions that arrive 20 hours later and date the event a day earlier."""
    again = rows.where(f"event_type = 'ad_impression' AND NOT is_late AND {SLOT_NO_SQL} % 90 = 7").withColumns(
        {
            "event_ts": F.expr("event_ts - INTERVAL 1 DAY"),
            "ingest_ts": F.expr("ingest_ts + INTERVAL 20 HOURS"),
            "clearing_price_micros": F.col("clearing_price_micros") + 300,
        }
    )
    return rows.unionByName(again.withColumn("dt", F.to_date("ingest_ts")))


def with_odd_days(rows: DataFrame) -> DataFrame:
    """Beacons whose days break the gate's rules, by day of the month of the event.

    4: negative prices; 6: no requests (so no fill rates); 8: every impression once more
    under another id; 10: one impression in twenty.
    """
    odd = rows.withColumns(
        {
            "day_no": F.dayofmonth("event_ts"),
            "imp": F.col("event_type") == "ad_impression",
        }
    )
    odd = odd.where("NOT (day_no = 6 AND event_type = 'ad_request')").where(f"NOT (day_no = 10 AND imp AND {SLOT_NO_SQL} % 20 <> 0)")
    odd = odd.withColumn("clearing_price_micros", F.expr("CASE WHEN day_no = 4 THEN -clearing_price_micros ELSE clearing_price_micros END"))
    ids = F.when(F.col("day_no") == 8, F.when(F.col("imp"), F.array("event_id", F.concat(F.lit("x"), "event_id"))))
    odd = odd.withColumn("event_id", F.explode(F.coalesce(ids, F.array("event_id"))))
    return odd.drop("day_no", "imp")


def with_gaps(rows: DataFrame) -> DataFrame:
    """Beacons with null markets in some pods, and quartiles below 100 of a campaign that has nothing else."""
    slot = F.expr(SLOT_NO_SQL)
    quiet = (F.col("event_type") == "ad_quartile") & (F.col("quartile") < 100) & (slot % 13 == 5)
    return rows.withColumns(
        {
            "campaign_id": F.when(quiet, F.concat(F.lit("cmp_quiet_"), (slot % 3).cast("string"))).otherwise(F.col("campaign_id")),
            "market": F.when(slot % 17 != 4, F.col("market")),
        }
    )


def as_text(rows: DataFrame) -> DataFrame:
    """Beacons as a text source delivers them: numbers and instants as strings, defaults left out, some junk.

    Instants are written with an offset, ``ingest_ts`` and ``is_late`` only on late copies.
    By slot number: slot 0 of 4 has no ``slot_index``, the others write it with a fraction part of zero; of 5
    prices one is 2^53 + 1, one ends in ``.0``, one is no number, one has a fraction; a quartile of 11 has a type outside the contract.
    """
    slot = F.expr(SLOT_NO_SQL)
    price = F.col("clearing_price_micros").cast("string")
    priced = F.col("clearing_price_micros").isNotNull()
    foreign = (F.col("quartile") == 25) & (slot % 11 == 0)

    def written(name: str):
        return F.date_format(F.expr(f"{name} + INTERVAL '05:30' HOUR TO MINUTE"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:30'")

    return rows.withColumns(
        {
            "event_ts": written("event_ts"),
            "ingest_ts": F.when(F.col("is_late"), written("ingest_ts")),
            "is_late": F.when(F.col("is_late"), True),
            "slot_index": F.when(slot % 4 != 0, F.concat(F.col("slot_index").cast("string"), F.lit(".0"))),
            "quartile": F.col("quartile").cast("string"),
            "bid_floor_micros": F.col("bid_floor_micros").cast("string"),
            "clearing_price_micros": F.when(priced & (slot % 5 == 0), "9007199254740993")
            .when(priced & (slot % 5 == 1), F.concat(price, F.lit(".0")))
            .when(priced & (slot % 5 == 2), "n/a")
            .when(priced & (slot % 5 == 3), F.concat(price, F.lit(".5")))
            .otherwise(price),
            "event_type": F.when(foreign, "ad_heartbeat").otherwise(F.col("event_type")),
        }
    )


# ---------------------------------------------------------------------------
# Raw drop lines: request beacons as JSON text with one defect per `e % 40`.
# ---------------------------------------------------------------------------

TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def _q(x: Column) -> Column:
    return F.concat(F.lit('"'), x, F.lit('"'))


def request_json(s: DataFrame) -> Column:
    """One request beacon as compact JSON text (keys in contract order)."""
    ts = F.date_format(F.col("event_ts"), TS_TEXT)
    p = F.col("p")
    parts = [
        ("event_id", _q(F.concat(F.lit("bcn-req-"), F.col("e").cast("string")))),
        ("event_type", F.lit('"ad_request"')),
        ("event_ts", _q(ts)),
        ("ingest_ts", _q(ts)),
        ("session_id", _q(F.concat(F.lit("sess_"), F.col("u").cast("string")))),
        ("content_id", _q(F.concat(F.lit("cnt_"), (p % 40).cast("string")))),
        ("pod_id", _q(F.concat(F.lit("pod_"), p.cast("string")))),
        ("slot_index", (F.col("e") % 3).cast("string")),
        ("break_type", _q(F.col("break_type"))),
        ("platform", _q(F.col("platform"))),
        ("market", _q(F.col("market"))),
        ("campaign_id", _q(F.concat(F.lit("cmp_"), (p % 7).cast("string")))),
        ("creative_id", F.lit("null")),
        ("advertiser_id", F.lit("null")),
        ("quartile", F.lit("null")),
        ("error_code", F.lit("null")),
        ("bid_floor_micros", F.col("floor_micros").cast("string")),
        ("clearing_price_micros", F.lit("null")),
        ("is_late", F.lit("false")),
    ]
    pieces: list[Column] = [F.lit("{")]
    for i, (key, val) in enumerate(parts):
        pieces += [F.lit(("," if i else "") + f'"{key}":'), val]
    pieces.append(F.lit("}"))
    return F.concat(*pieces)


# The defect applied to a request line, by `e % 40`, as
# (form, argument) on the clean JSON text; see `defect_rewrite`.
DEFECTS = (
    ("cut_last_char", None),
    ("whole_line", "[1,2]"),
    ("whole_line", "5"),
    ("replace", ('"event_type":"ad_request"', '"event_type":"ad_weird"')),
    ("drop_key", "campaign_id"),
    ("extra_key", '"zz":1'),
    ("set", ("slot_index", '"1"')),
    ("set", ("slot_index", "true")),
    ("set", ("slot_index", "1.5")),
    ("set", ("slot_index", "null")),
    ("set", ("slot_index", "-1")),
    ("set", ("event_id", '"short"')),
    ("set", ("event_id", "12345678")),
    ("set", ("campaign_id", "null")),
    ("set", ("ingest_ts", "null")),
    ("set", ("creative_id", '{"a":1}')),
    ("set", ("market", '"IND"')),
    ("set", ("quartile", "30")),
    ("set", ("bid_floor_micros", "-5")),
    ("set", ("bid_floor_micros", "1000000000000000000000000000000")),
    ("set", ("is_late", '"true"')),
    ("set", ("is_late", "null")),
    ("set", ("break_type", '"bumper"')),
    ("set", ("platform", '"roku"')),
    ("extra_key", '"market":"US"'),
    ("whole_line", "   "),
    ("set", ("slot_index", "1.0")),
    ("set", ("quartile", "25.0")),
    ("set", ("quartile", "100")),
    ("drop_key", "ingest_ts"),
    ("drop_key", "is_late"),
    ("set", ("event_ts", '"garbage"')),
    ("set", ("error_code", '"TIMEOUT"')),
)

# Expected landing outcome per defect number (None = blank line,
# skipped). Numbers 33..39 carry no defect and land ok.
DEFECT_OUTCOME = (
    ("bad", "V1"),
    ("bad", "V2"),
    ("bad", "V2"),
    ("bad", "V8"),
    ("bad", "V3"),
    ("bad", "V4"),
    ("bad", "V6"),
    ("bad", "V6"),
    ("bad", "V6"),
    ("bad", "V6"),
    ("bad", "V14"),
    ("bad", "V12"),
    ("bad", "V5"),
    ("bad", "V5"),
    ("bad", "V5"),
    ("bad", "V5"),
    ("bad", "V13"),
    ("bad", "V11"),
    ("bad", "V15"),
    ("bad", "V6"),
    ("bad", "V7"),
    ("bad", "V7"),
    ("bad", "V9"),
    ("bad", "V10"),
    ("bad", "V1"),
    None,
    ("ok", None),
    ("ok", None),
    ("ok", None),
    ("ok", None),
    ("ok", None),
    ("ok", None),
    ("ok", None),
)
DEFECT_MODULUS = 40


def _value_pattern(key: str) -> str:
    # a JSON scalar after `"key":` in our compact lines: string, null or number
    return f'"{key}":("[^"]*"|null|true|false|-?[0-9.eE+]+)'


def _java_replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def defect_rewrite(defect: tuple) -> tuple[str, str]:
    """A defect as one (regex, replacement) pair on the clean line."""
    form, arg = defect
    if form == "cut_last_char":
        return ".$", ""
    if form == "whole_line":
        return "^.*$", _java_replacement(arg)
    if form == "replace":
        return _re_quote(arg[0]), _java_replacement(arg[1])
    if form == "drop_key":
        # remove `,"key":value` (no key is first, event_id is never dropped)
        return "," + _value_pattern(arg), ""
    if form == "extra_key":
        return "}$", _java_replacement("," + arg + "}")
    if form == "set":
        key, val = arg
        return _value_pattern(key), _java_replacement(f'"{key}":' + val)
    raise ValueError(form)


def _re_quote(text: str) -> str:
    import re

    return re.escape(text)


def drop_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request beacons as raw JSON lines with injected defects.

    Columns: ``e`` (slot number, kept for checking), ``dt``, ``src`` (drop file
    stem), ``value`` (the raw line). Derived row by row from ``events``: the
    defect of a row is looked up by ``e % 40`` in a literal array of
    (regex, replacement) pairs and applied with one ``regexp_replace``.
    """
    s = _slot_columns(read_table(spark, sf_dir, "events"))
    rewrites = [defect_rewrite(d) for d in DEFECTS]
    patterns = F.array(*[F.lit(p) for p, _ in rewrites])
    replacements = F.array(*[F.lit(r) for _, r in rewrites])
    d = (F.col("e") % DEFECT_MODULUS).cast("int")
    s = s.select("e", "event_ts", d.alias("__d"), request_json(s).alias("__base"))
    has_defect = F.col("__d") < len(DEFECTS)
    line = F.when(
        has_defect,
        F.regexp_replace(
            F.col("__base"), F.element_at(patterns, F.col("__d") + 1), F.element_at(replacements, F.col("__d") + 1)
        ),
    ).otherwise(F.col("__base"))
    return s.select(
        F.col("e"),
        F.to_date(F.col("event_ts")).alias("dt"),
        F.concat(F.lit("drop-"), (F.col("e") % 4).cast("string")).alias("src"),
        line.alias("value"),
    )
