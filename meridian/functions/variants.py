"""JSON document helpers over VARIANT values (E11 type tests)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LEADING_BLANKS = "\\A[ \\t\\r\\n]*"


def json_kind(body: Column, parsed: Column) -> Column:
    """'object' / 'array' / 'scalar' for a JSON text (NULL when it does not parse).

    For valid JSON the first non-blank character decides the kind, so this never walks
    the document (``schema_of_variant`` would compute the type of every member).
    """
    return (F.when(parsed.isNull(), F.lit(None).cast("string"))
            .when(body.rlike(_LEADING_BLANKS + "\\{"), F.lit("object"))
            .when(body.rlike(_LEADING_BLANKS + "\\["), F.lit("array"))
            .otherwise(F.lit("scalar")))


def is_object(v: Column) -> Column:
    """Type test for a (small) variant value such as one record or one array element."""
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))


def str_member(v: Column, name: str) -> Column:
    """A member only when it is a JSON string (numbers are not coerced), else NULL."""
    m = F.try_variant_get(v, f"$['{name}']", "variant")
    return F.when(F.schema_of_variant(m) == "STRING", F.try_variant_get(m, "$", "string"))
