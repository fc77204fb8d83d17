"""One type for a column whose type changed between runs.

Whole numbers widen to the larger of the two, whole numbers and floating ones to double,
decimals to the decimal that holds both (double beyond 38 digits), dates and timestamps to
timestamp, structs and arrays member by member; any other pair becomes text, nested values
as JSON text. Widening never depends on the order of the runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_WHOLE_DIGITS = [3, 5, 10, 19]
_FLOATING = [T.FloatType(), T.DoubleType()]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that takes the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if {type(a), type(b)} <= {T.DateType, T.TimestampType}:
        return T.TimestampType()
    numbers = [x for x in (a, b) if isinstance(x, T.NumericType)]
    if len(numbers) < 2:
        return T.StringType()
    if a in _FLOATING or b in _FLOATING:
        return T.DoubleType()
    scales = [x.scale if isinstance(x, T.DecimalType) else 0 for x in (a, b)]
    wholes = [x.precision - x.scale if isinstance(x, T.DecimalType) else _WHOLE_DIGITS[_WHOLE.index(x)] for x in (a, b)]
    digits = max(wholes) + max(scales)
    return T.DecimalType(digits, max(scales)) if digits <= 38 else T.DoubleType()


def merged(schemas: list[T.StructType]) -> T.StructType:
    """All members in order of first appearance, each of the widest of its types."""
    found: dict[str, list[T.DataType]] = {}
    for field in (f for s in schemas for f in s):
        found.setdefault(field.name, []).append(field.dataType)
    return T.StructType([T.StructField(n, reduce(wider, kinds)) for n, kinds in found.items()])


def widened(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """The value as the wider type; a null stays null, a missing member is null."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        kinds = {f.name: f.dataType for f in have}
        members = [(widened(value.getField(f.name), kinds[f.name], f.dataType) if f.name in kinds
                    else F.lit(None).cast(f.dataType)).alias(f.name) for f in want]
        return F.when(value.isNotNull(), F.struct(*members))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: widened(x, have.elementType, want.elementType))
    if isinstance(have, T.StructType | T.ArrayType | T.MapType):
        return F.to_json(value, {"ignoreNullFields": "false"})
    return value.cast(want)
