"""A lattice of column types, and the type of a set of VARIANT records as its join.

Every value has a kind (``BIGINT``, ``OBJECT``, ...). The join of the kinds seen at one place is
the narrowest type that holds them all: ``VOID`` is below everything, integers are below doubles,
and kinds that meet nowhere else meet in the top type (VARIANT). Objects and arrays are joined
member by member. The places are found by exploding the records level by level, so a member's
name is data here, never text to be parsed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: kinds and the types that hold them; fractions are doubles
SCALARS: dict[str, T.DataType] = {
    "BOOLEAN": T.BooleanType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "DECIMAL": T.DoubleType(),
    "STRING": T.StringType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(), "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "BINARY": T.BinaryType(),
}
NUMBERS = {"BIGINT", "DOUBLE", "FLOAT", "DECIMAL"}

#: a place in a record: the member names on the way to it, null for an element of an array
Place = tuple


def kind_of(v: Column) -> Column:
    """The kind of a VARIANT value, without the types of what it holds."""
    return F.regexp_extract(F.schema_of_variant(v), "\\A[A-Z_]+", 0)


def places(records: DataFrame, record: Column) -> dict[Place, set[str]]:
    """The kinds seen at every place of the records: one aggregate for each level of nesting.

    The driver gets one row per distinct place and kind, which is the size of the schema.
    """
    spark = records.sparkSession
    found: dict[Place, set[str]] = {(): {"OBJECT"}}
    level = records.select(F.array().cast("array<string>").alias("path"), record.alias("v"))
    while True:
        inner = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()).alias("x")).select(
            F.concat("path", F.array(F.col("x.key"))).alias("path"), F.col("x.value").alias("v"))
        inner = inner.withColumn("kind", kind_of(F.col("v")))
        rows = inner.groupBy("path", "kind").count().collect()
        for r in rows:
            found.setdefault(tuple(r.path), set()).add(r.kind)
        if not any(r.kind in ("OBJECT", "ARRAY") for r in rows):
            return found
        level = inner.where(F.col("kind").isin("OBJECT", "ARRAY")).select("path", "v")


def joined(kinds: set[str]) -> str | None:
    """The join of some kinds: one of them, ``VOID``, or None where they only meet in the top type."""
    kinds = kinds - {"VOID"}
    if not kinds:
        return "VOID"
    if len(kinds) == 1:
        return next(iter(kinds))
    if kinds <= NUMBERS:
        return "DOUBLE"
    return None


def type_at(found: dict[Place, set[str]], place: Place = ()) -> T.DataType:
    """The type of what stands at a place. Nothing but nulls, and objects without members, are text."""
    below: dict[Place, list[str | None]] = {}
    for p in found:
        if p:
            below.setdefault(p[:-1], []).append(p[-1])

    def build(at: Place) -> T.DataType:
        kind = joined(found[at])
        if kind is None:
            return T.VariantType()
        if kind == "OBJECT":
            names = sorted(n for n in below.get(at, []) if n is not None)
            fields = [T.StructField(n, build((*at, n))) for n in names]
            return T.StructType(fields) if fields or not at else T.StringType()
        if kind == "ARRAY":
            return T.ArrayType(build((*at, None)) if None in below.get(at, []) else T.StringType())
        return SCALARS.get(kind, T.StringType())

    return build(place)


def ddl(t: T.DataType) -> str:
    """The type as DDL text with every name quoted, whatever its characters."""
    if isinstance(t, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {ddl(f.dataType)}" for f in t.fields) + ">"
    if isinstance(t, T.ArrayType):
        return f"array<{ddl(t.elementType)}>"
    return t.simpleString()


#: widening of landed columns: numbers up to double, dates up to timestamps, all else meets in text
_WIDER = (("tinyint", "smallint", "int", "bigint", "double"), ("float", "double"), ("date", "timestamp"), ("timestamp_ntz", "timestamp"))


def widened(a: str, b: str) -> str:
    """The narrowest type name that holds both (``string`` where nothing narrower does)."""
    if a == b or b == "void":
        return a
    if a == "void":
        return b
    for chain in _WIDER:
        if a in chain and b in chain:
            return chain[max(chain.index(a), chain.index(b))]
    decimals = [re.fullmatch(r"decimal\((\d+),(\d+)\)", x) for x in (a, b)]
    if all(decimals):
        whole = max(int(m[1]) - int(m[2]) for m in decimals)
        scale = max(int(m[2]) for m in decimals)
        return f"decimal({whole + scale},{scale})" if whole + scale <= 38 else "double"
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    if all(m or x in numbers for m, x in zip(decimals, (a, b), strict=True)):
        return "double"
    return "string"
