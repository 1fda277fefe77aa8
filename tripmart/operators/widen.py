"""Types that hold the values of two others (K1).

The order is int -> bigint -> decimal -> double, and string for what has no
number or time in common. ``widen`` also tells whether every value of both
types is kept exactly: whole numbers in wider ones, up to 32 bits in doubles,
decimals in decimals with room for both sides of the point. A 64-bit number
beside a double is not, nor is the type of what becomes text, so these are only
ever cast on reading.
"""

from __future__ import annotations

from pyspark.sql import types as T

#: Decimal digits that hold any value of a whole-number type.
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
WHOLE = tuple(DIGITS)
FLOATING = (T.FloatType, T.DoubleType)


def widen(a: T.DataType, b: T.DataType) -> tuple[T.DataType, bool]:
    """The common type of two, and whether it keeps all their values exactly."""
    if a == b or isinstance(b, T.NullType):
        return a, True
    if isinstance(a, T.NullType):
        return b, True
    if isinstance(a, WHOLE) and isinstance(b, WHOLE):
        return max(a, b, key=lambda t: DIGITS[type(t)]), True
    for x, y in ((a, b), (b, a)):
        if isinstance(x, FLOATING) and isinstance(y, FLOATING):
            return T.DoubleType(), True
        if isinstance(x, FLOATING) and isinstance(y, WHOLE):
            return T.DoubleType(), not isinstance(y, T.LongType)
        if isinstance(x, FLOATING) and isinstance(y, T.DecimalType):
            return T.DoubleType(), y.precision <= 15
        if isinstance(x, T.DecimalType) and isinstance(y, (T.DecimalType, *WHOLE)):
            left, scale = _sides(x), _sides(y)
            whole, part = max(left[0], scale[0]), max(left[1], scale[1])
            return (T.DecimalType(whole + part, part), True) if whole + part <= 38 else (T.DoubleType(), False)
        if isinstance(x, T.DateType) and isinstance(y, (T.TimestampNTZType, T.TimestampType)):
            return y, True
    return T.StringType(), False


def _sides(t: T.DataType) -> tuple[int, int]:
    return (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (DIGITS[type(t)], 0)


def merge(a: T.StructType, b: T.StructType) -> tuple[T.StructType, bool]:
    """The columns of both (names do not tell case), of widened types, and whether all values are kept exactly."""
    out = {f.name.lower(): f for f in a.fields}
    exact = True
    for f in b.fields:
        have = out.get(f.name.lower())
        kind, same = widen(have.dataType, f.dataType) if have else (f.dataType, True)
        exact &= same
        out[f.name.lower()] = T.StructField(have.name if have else f.name, kind)
    return T.StructType(list(out.values())), exact
