"""Column helpers for the scalar semantics the operators need."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec, functions as F

from ..fixed_values import NULL_KEY_PART, SEASON_MONTHS
from .rules import set_map


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- casts -----------------------------------------------------------------------
def safe_decimal(col: Column | str, precision: int, scale: int) -> Column:
    """Typed number, NULL when the text does not parse or does not fit."""
    return _c(col).try_cast(f"decimal({precision},{scale})")


def safe_int(col: Column | str) -> Column:
    """Integer from text; fractional text is rounded half up ('12.7' gives 13)."""
    return F.round(_c(col).try_cast("decimal(28,10)"), 0).try_cast("int")


# ---- arithmetic ------------------------------------------------------------------
def safe_divide(n: Column | str, d: Column | str) -> Column:
    """Ratio as DOUBLE, NULL for a zero or NULL denominator."""
    return F.try_divide(_c(n).cast("double"), _c(d).cast("double"))


def cents_to_dollars(col: Column | str) -> Column:
    return _c(col) / F.lit(100.0)


def clamp(col: Column, low=0.0, high=100.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), col))


def exact_ratio(n: Column | str, d: Column | str, places: int = 2, scale: int = 1) -> Column:
    """Rounded ratio of two decimals or integers; stays decimal, so ties round half up."""
    return F.round(F.try_divide(_c(n), _c(d)) * scale, places)


def margin_percent(price: Column | str, cost: Column | str) -> Column:
    p, k = _c(price), _c(cost)
    return exact_ratio(p - k, p, 2, 100)


def mean(col: Column | str) -> Column:
    """Average as exact sum over count: no float accumulation for decimals and integers."""
    return F.try_divide(F.sum(_c(col)).cast("double"), F.count(_c(col)))


def mean_over(col: Column | str, w: WindowSpec) -> Column:
    return F.try_divide(F.sum(_c(col)).over(w).cast("double"), F.count(_c(col)).over(w))


# ---- dates -----------------------------------------------------------------------
def parse_month_first(col: Column | str) -> Column:
    """Date from 'MM-dd-yy' text; years 69–99 belong to the last century, 4-digit years fail."""
    day = F.try_to_timestamp(_c(col), F.lit("MM-dd-yy")).cast("date")
    return F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)


def day_of_week0(col: Column | str) -> Column:
    """Sunday = 0 … Saturday = 6."""
    return F.dayofweek(_c(col)) - 1


def month_diff(start: Column | str, end: Column | str) -> Column:
    """Number of month boundaries between two dates."""
    s, e = _c(start), _c(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))


def months_back(day: Column, n: int) -> Column:
    return F.trunc(F.add_months(day, -n), "month")


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Number of hour boundaries between two timestamps."""
    def hour(c):
        return F.unix_timestamp(F.date_trunc("hour", _c(c).try_cast("timestamp")))
    return ((hour(end) - hour(start)) / 3600).cast("bigint")


def year_month(col: Column | str) -> Column:
    return F.date_format(_c(col), "yyyy-MM")


def season_of(month: Column) -> Column:
    return set_map(month, SEASON_MONTHS)


def business_days(start: Column | str, end: Column | str) -> Column:
    """Monday–Friday days in [start, end), in closed form (no row or array per day)."""
    def upto(c):
        # days since Monday 1970-01-05
        k = F.datediff(_c(c), F.lit("1970-01-05").cast("date"))
        return F.floor(k / 7) * 5 + F.least(F.pmod(k, F.lit(7)), F.lit(5))
    return (upto(end) - upto(start)).cast("bigint")


# ---- text and keys ---------------------------------------------------------------
def concat_skip_nulls(*cols: Column | str) -> Column:
    return F.concat_ws("", *[_c(c).cast("string") for c in cols])


def row_hash(*cols: Column | str) -> Column:
    """MD5 of the concatenated texts, NULL counting as empty."""
    return F.md5(concat_skip_nulls(*cols))


def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_KEY_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
