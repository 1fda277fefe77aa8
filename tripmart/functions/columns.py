"""Scalar and aggregate column helpers.

Every helper returns a ``Column`` made of built-in functions, so plans stay
inside whole-stage codegen. Decimal arithmetic is kept exact where the
reference relies on exact ``NUMERIC`` maths (trap T1: ``round(avg(dec), 2)``
double-rounds in Spark because ``avg`` of a decimal has scale 6).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "col_of", "to_int", "minutes_between", "date_key", "year_month", "day_of_week",
    "exact_mean", "exact_mean_scaled", "percent_of", "ratio_percent",
    "case_order", "time_block", "nulls_to_none", "dec", "ntz_lit",
]

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(value: str | int, precision: int = 38, scale: int | None = None) -> Column:
    """Exact decimal literal."""
    d = Decimal(str(value))
    if scale is None:
        scale = max(0, -d.as_tuple().exponent)
    return F.lit(d).cast(T.DecimalType(precision, scale))


def ntz_lit(value) -> Column:
    """TIMESTAMP_NTZ literal from a naive datetime, independent of time zones."""
    return F.to_timestamp_ntz(F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")))


def to_int(c, source_type: T.DataType | None = None) -> Column:
    """``::int`` with Postgres rounding: fractional values round half to even.

    Spark's cast truncates (2.5 -> 2, 3.5 -> 3, 1.7 -> 1); ``rint`` first gives
    2, 4, 2. Integral and string inputs cast directly.
    """
    c = col_of(c)
    if source_type is not None and isinstance(source_type, _INTEGRAL):
        return c.cast("int")
    return F.rint(c.cast("double")).cast("int")


def minutes_between(start: str, end: str) -> Column:
    """epoch(end - start) / 60.0 as an exact decimal (scale 10)."""
    return F.expr(f"timestampdiff(MICROSECOND, `{start}`, `{end}`) / 60000000.0")


def date_key(c) -> Column:
    """yyyyMMdd as int, by arithmetic on the parts (no text is formatted per row)."""
    c = col_of(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def year_month(c) -> Column:
    return F.date_format(col_of(c), "yyyy-MM")


def day_of_week(c) -> Column:
    """0 = Sunday ... 6 = Saturday (EXTRACT(DOW))."""
    return F.dayofweek(col_of(c)) - 1


def exact_mean(c, scale: int = 2) -> Column:
    """ROUND(AVG(x), scale) with exact decimal maths: round(sum/count)."""
    c = col_of(c)
    return F.round(F.sum(c) / F.count(c), scale)


def exact_mean_scaled(c, factor: int, scale: int = 2) -> Column:
    """ROUND(AVG(x) * factor, scale), exact."""
    c = col_of(c)
    return F.round(F.sum(c) * F.lit(factor) / F.count(c), scale)


def percent_of(part, whole, scale: int = 2) -> Column:
    """ROUND(100.0 * part / whole, scale) in exact decimal maths."""
    part, whole = col_of(part), col_of(whole)
    return F.round(
        part.cast("decimal(20,0)") * dec("100.0", 4, 1) / F.nullif(whole, F.lit(0)).cast("decimal(20,0)"),
        scale)


def ratio_percent(num, den, scale: int = 2) -> Column:
    """ROUND(num / NULLIF(den, 0) * 100, scale) in exact decimal maths."""
    num, den = col_of(num), col_of(den)
    return F.round(num * F.lit(100) / F.nullif(den, F.lit(0)), scale)


def case_order(c, ordered_values: list[str], else_rank: int | None = None) -> Column:
    """Position of ``c`` in ``ordered_values`` (1-based) for ORDER BY CASE."""
    c = col_of(c)
    expr = None
    for i, v in enumerate(ordered_values, start=1):
        expr = F.when(c == v, F.lit(i)) if expr is None else expr.when(c == v, F.lit(i))
    if else_rank is not None:
        expr = expr.otherwise(F.lit(else_rank))
    return expr


def time_block(hour_col, blocks, else_label: str) -> Column:
    h = col_of(hour_col)
    expr = None
    for lo, hi, label in blocks:
        cond = h.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(else_label))


def nulls_to_none(c, tokens: list[str]) -> Column:
    """Map pandas' default NA strings to NULL (``nullValue`` takes one token)."""
    c = col_of(c)
    return F.when(c.isNull() | c.isin(tokens), F.lit(None).cast("string")).otherwise(c)
