"""Money and rate expressions (integer micros until gold, rounding as SQL does)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.functions.contract import MICROS_PER_UNIT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up_sql(num: str, den: str, scale: int) -> str:
    """``round(num / den, scale)`` half-up on the exact rational, as SQL text.

    For integers with ``den > 0``: q = (2·|num|·10^s + den) div (2·den), given the
    sign of ``num``, is the numerator rounded half away from zero, and q / 10^s is
    one IEEE division of exact integers. The products are decimals of 38 digits,
    so no amount that fits a long overflows them. Rounding the binary double
    instead (x·10^s, then round) gives engine-dependent answers on decimal ties
    such as 626.08625.
    """
    k = 10**scale
    n, d = f"CAST({num} AS DECIMAL(20, 0))", f"CAST({den} AS DECIMAL(20, 0))"
    q = f"(abs({n}) * CAST({2 * k} AS DECIMAL(10, 0)) + {d}) DIV ({d} * CAST(2 AS DECIMAL(1, 0)))"
    return f"CAST(sign({n}) * ({q}) AS DOUBLE) / {k}"


def rate_sql(num: str, den: str, scale: int = 6) -> str:
    """X2 ``safe_rate``: null unless den > 0, else the half-up ratio."""
    return f"CASE WHEN {den} > 0 THEN {half_up_sql(num, den, scale)} END"


def currency_sql(micros: str) -> str:
    """Currency units from integer micros (exact to 6 decimals by construction)."""
    return f"CAST({micros} AS DOUBLE) / {MICROS_PER_UNIT}"


def ecpm_sql(revenue_micros: str, impressions: str) -> str:
    """Revenue per thousand impressions, 4 decimals; null without impressions.
    (revenue_micros / 10^6) / impressions * 1000 = revenue_micros / (impressions * 1000)."""
    return f"CASE WHEN {impressions} > 0 THEN {half_up_sql(revenue_micros, f'({impressions}) * 1000', 4)} END"


def micros_to_currency(micros: str) -> Column:
    return F.expr(currency_sql(micros))


def safe_rate(num: str, den: str, scale: int = 6) -> Column:
    """num / den rounded half-up to ``scale`` places; null when den <= 0."""
    return F.expr(rate_sql(num, den, scale))


def ecpm(revenue_micros: str, impressions: str) -> Column:
    return F.expr(ecpm_sql(revenue_micros, impressions))


def raw_fill_rate(impressions: Column | str, requests: Column | str) -> Column:
    """Unrounded impressions / requests (the JVM job's variant)."""
    imp, req = _col(impressions), _col(requests)
    return F.when(req > 0, imp.cast("double") / req)


def raw_ecpm(revenue_micros: Column | str, impressions: Column | str) -> Column:
    """Unrounded (revenue / 1e6) / impressions * 1000 (the JVM job's variant)."""
    rev, imp = _col(revenue_micros), _col(impressions)
    return F.when(imp > 0, rev.cast("double") / 1000000.0 / imp * 1000.0)


def ratio_of_sums(num: str, den: str, scale: int = 4) -> Column:
    """round(sum(num) / max(sum(den), 1), scale), half-up — the day summary fill rate."""
    return F.expr(half_up_sql(f"sum({num})", f"greatest(sum({den}), 1)", scale))
