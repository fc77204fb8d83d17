"""Named column rules used by declarative models: rule name -> expression builder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from meridian.functions.casts import blank_to_null, lenient_int, trimmed, y_only, yes_no

RULES: dict[str, Callable[[Column], Column]] = {
    "copy": lambda c: c,
    "trim": trimmed,
    "blank_to_null": blank_to_null,
    "int": lenient_int,
    "yes_no": yes_no,
    "y_only": y_only,
}


def apply_rule(rule: str, raw: str) -> Column:
    return RULES[rule](F.col(raw))
