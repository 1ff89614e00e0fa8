"""Display formatting for the report tables (percent, fixed decimals, flags).

Numbers are printed from an exact integer: the value is first scaled to its
stored precision (rates and money carry at most 6 decimals) and rounded to a
long, then rounded half-up to the shown decimals in integer arithmetic. That
avoids the binary-double tie cases (``293.455`` to 2 places) on which engines
and languages disagree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the placeholder shown for a missing number
MISSING = "—"
STORED_SCALE = 6


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fixed(x: Column, decimals: int, shift: int = 0, scale: int = STORED_SCALE) -> Column:
    """``x * 10**shift`` printed with ``decimals`` places, half-up, no grouping."""
    n = F.round(x.cast("double") * (10 ** scale)).cast("bigint")  # x at its stored precision, exact
    drop = scale - shift - decimals  # digits to round away
    if drop < 0:
        raise ValueError("more decimals than the stored precision")
    step = 10**drop
    mag = F.abs(n)
    q = F.floor((mag + step // 2) / step).cast("bigint") if drop else mag
    unit = 10**decimals
    whole = F.floor(q / unit).cast("bigint").cast("string") if decimals else q.cast("string")
    text = F.concat(whole, F.lit("."), F.lpad((q % unit).cast("string"), decimals, "0")) if decimals else whole
    return F.when(n < 0, F.concat(F.lit("-"), text)).otherwise(text)


def pct(x: Column | str) -> Column:
    """0.808333 -> '80.8%'; null -> '—'."""
    return F.coalesce(F.concat(_fixed(_col(x), 1, shift=2), F.lit("%")), F.lit(MISSING))


def num(x: Column | str, decimals: int = 2) -> Column:
    """Fixed decimals, null -> '—'."""
    return F.coalesce(_fixed(_col(x), decimals), F.lit(MISSING))


def short_id(x: Column | str, length: int = 14) -> Column:
    return F.substring(_col(x).cast("string"), 1, length)


def yes_no(x: Column | str) -> Column:
    x = _col(x)
    return F.when(x.cast("boolean"), F.lit("yes")).otherwise(F.lit("no"))
