"""The beacon contract as Column rules over one raw JSON line.

The line is parsed once into a VARIANT; each rule is a JVM-side expression on
it, so validation is a projection inside whole-stage codegen (no UDF). A row
collects the id of every rule it breaks; it is valid iff the list is empty.
Absent and null are different: a key that is absent gives SQL NULL from
``try_variant_get``, a JSON null gives the variant type ``VOID``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.contract import (
    ALLOWED_KEYS,
    BREAK_TYPES,
    EVENT_ID_MIN_LENGTH,
    EVENT_TYPES,
    FIELDS,
    MARKET_LENGTH,
    PLATFORMS,
    QUARTILES,
    REQUIRED,
)

INT_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")


def parsed(line: Column) -> Column:
    """VARIANT of the line, null when it is not valid JSON (duplicate keys included)."""
    return F.try_parse_json(line)


# The rules are SQL expression text over staged helper columns: the JVM parses
# them in a few calls instead of Python assembling thousands of Column objects.
V, KEYS = "__v", "__keys"
INTEGER_FIELDS = tuple(name for name, kind in FIELDS if kind.startswith("integer"))
CHECKED_TEXT = ("event_id", "event_type", "event_ts", "ingest_ts", "break_type", "platform", "market")


def _get(name: str, to: str) -> str:
    return f"try_variant_get({V}, '$.{name}', '{to}')"


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _stage_parse(df: DataFrame, line: str) -> DataFrame:
    # Parsed once; later stages read the variant column instead of re-parsing the
    # text. The keys come from the variant too (NULL when it is not an object).
    parsed_df = df.selectExpr("*", f"try_parse_json({line}) AS {V}")
    return parsed_df.selectExpr("*", f"map_keys(try_variant_get({V}, '$', 'map<string,variant>')) AS {KEYS}")


#: Integer columns stored as 32 bits; the others as 64.
INT_COLUMNS = ("slot_index", "quartile")


def _stage_types(df: DataFrame) -> DataFrame:
    """Per key: variant type name (NULL absent, 'VOID' null), and the numeric /
    text values the rules compare."""
    exprs = [f"schema_of_variant({_get(name, 'variant')}) AS __t_{name}" for name, _ in FIELDS]
    exprs += [f"{_get(name, 'double')} AS __d_{name}" for name in INTEGER_FIELDS]
    exprs += [f"{_get(name, 'decimal(38,10)')} AS __x_{name}" for name in INTEGER_FIELDS]
    exprs += [f"{_get(name, 'bigint')} AS __l_{name}" for name in INTEGER_FIELDS]
    exprs += [f"{_get(name, 'string')} AS __s_{name}" for name in CHECKED_TEXT]
    return df.selectExpr("*", *exprs)


def _is_integer(name: str) -> str:
    """JSON-Schema integer: a number with no fraction (1.0 counts) that fits the column's type.

    Decimals are tested as decimals: a double would drop the fraction of a large one.
    """
    t = f"__t_{name}"
    whole = (
        f"({t} IN ({_sql_list(INT_TYPES)})"
        f" OR ({t} LIKE 'DECIMAL%' AND __x_{name} = floor(__x_{name}))"
        f" OR ({t} IN ('DOUBLE', 'FLOAT') AND __d_{name} = floor(__d_{name})))"
    )
    fits = f"__l_{name} BETWEEN {-(2**31)} AND {2**31 - 1}" if name in INT_COLUMNS else f"__l_{name} IS NOT NULL"
    return f"({whole} AND {fits})"


def rule_sql(strict_timestamps: bool = False) -> list[tuple[str, str]]:
    """(rule id, SQL condition that is true when the rule is broken). ``__keys`` is
    NULL for a non-object, so V2 reads "parsed but not an object"."""

    def present(name: str) -> str:
        return f"__t_{name} IS NOT NULL"

    def string(name: str) -> str:
        return f"__t_{name} = 'STRING'"

    wrong_string, wrong_integer = [], []
    for name, kind in FIELDS:
        if kind == "string":
            wrong_string.append(f"({present(name)} AND __t_{name} <> 'STRING')")
        elif kind == "string?":
            wrong_string.append(f"({present(name)} AND __t_{name} NOT IN ('STRING', 'VOID'))")
        elif kind == "integer":
            wrong_integer.append(f"({present(name)} AND NOT {_is_integer(name)})")
        elif kind == "integer?":
            wrong_integer.append(f"({present(name)} AND __t_{name} <> 'VOID' AND NOT {_is_integer(name)})")

    def enum_bad(name: str, allowed) -> str:
        return f"({string(name)} AND __s_{name} NOT IN ({_sql_list(allowed)}))"

    rules = [
        ("V1", f"{V} IS NULL"),
        ("V2", f"{V} IS NOT NULL AND {KEYS} IS NULL"),
        ("V3", f"size(array_except(array({_sql_list(REQUIRED)}), {KEYS})) > 0"),
        ("V4", f"size(array_except({KEYS}, array({_sql_list(ALLOWED_KEYS)}))) > 0"),
        ("V5", " OR ".join(wrong_string)),
        ("V6", " OR ".join(wrong_integer)),
        ("V7", f"({present('is_late')} AND __t_is_late <> 'BOOLEAN')"),
        ("V8", enum_bad("event_type", EVENT_TYPES)),
        ("V9", enum_bad("break_type", BREAK_TYPES)),
        ("V10", enum_bad("platform", PLATFORMS)),
        ("V11", f"({_is_integer('quartile')} AND __l_quartile NOT IN ({_sql_list(QUARTILES)}))"),
        ("V12", f"({string('event_id')} AND char_length(__s_event_id) < {EVENT_ID_MIN_LENGTH})"),
        ("V13", f"({string('market')} AND char_length(__s_market) <> {MARKET_LENGTH})"),
        ("V14", f"({_is_integer('slot_index')} AND __l_slot_index < 0)"),
        (
            "V15",
            f"({_is_integer('bid_floor_micros')} AND __l_bid_floor_micros < 0)"
            f" OR ({_is_integer('clearing_price_micros')} AND __l_clearing_price_micros < 0)",
        ),
    ]
    if strict_timestamps:
        bad = [f"({string(n)} AND try_to_timestamp(__s_{n}) IS NULL)" for n in ("event_ts", "ingest_ts")]
        rules.append(("V16", " OR ".join(bad)))
    # V3-V16 only speak about objects; a non-object reports V1 or V2 alone
    is_object = f"({V} IS NOT NULL AND {KEYS} IS NOT NULL)"
    return [(rid, cond if rid in ("V1", "V2") else f"{is_object} AND ({cond})") for rid, cond in rules]


def validate(df: DataFrame, line: str = "value", strict_timestamps: bool = False) -> DataFrame:
    """Add ``errors array<string>`` (rule ids broken by the line, empty = valid)
    and the contract fields read from the line (timestamps as received text).
    Other columns pass through."""
    staged = _stage_types(_stage_parse(df, line))
    # concat_ws skips nulls and stays in generated code (a lambda filter would not)
    checks = ", ".join(f"CASE WHEN coalesce({cond}, false) THEN '{rid}' END" for rid, cond in rule_sql(strict_timestamps))
    text = f"concat_ws(',', {checks})"
    errors = f"CASE WHEN {text} = '' THEN CAST(array() AS array<string>) ELSE split({text}, ',') END"
    # The rule list comes out of a one-row-per-input generator: a later filter on
    # it (e.g. quarantine = non-empty) cannot be pushed below the generator, so
    # the rules are evaluated once instead of being copied into that filter.
    with_errors = staged.selectExpr("*", f"inline(array(named_struct('errors', {errors})))")
    fields = []
    for name, kind in FIELDS:
        if kind.startswith("string"):
            fields.append(f"{_get(name, 'string')} AS {name}")
        elif kind.startswith("integer"):
            fields.append(f"{_get(name, 'int' if name in INT_COLUMNS else 'bigint')} AS {name}")
        else:
            fields.append(f"{_get(name, 'boolean')} AS {name}")
    keep = [f"`{c}`" for c in df.columns if c not in {n for n, _ in FIELDS}]
    return with_errors.selectExpr(*keep, "errors", *fields)
