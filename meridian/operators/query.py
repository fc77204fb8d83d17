"""Clause pass-through (F1-F5): the query clauses of a paged catalog API, applied to a
DataFrame so Catalyst can push the projection and predicate into the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def clauses(
    df: DataFrame,
    *,
    select: list[str] | None = None,
    where: str | None = None,
    order: str | None = None,
    limit: int | None = None,
    offset: int | None = None,
    q: str | None = None,
) -> DataFrame:
    """F1 ``$select`` (SQL expressions), F2 ``$where``, F3 ``$order``, F4 ``$limit``/``$offset``,
    F5 ``$q`` (case-insensitive substring over every string column).

    ``offset``/``limit`` without ``order`` are not stable, as with the original service.
    """
    out = df
    if q is not None:
        needle = q.lower()
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
        cond = F.lit(False)
        for c in cols:
            cond = cond | F.coalesce(F.lower(F.col(c)).contains(needle), F.lit(False))
        out = out.where(cond)
    if where is not None:
        out = out.where(F.expr(where))
    if select is not None:
        out = out.selectExpr(*select)
    if order is not None:
        out = out.orderBy(*[_sort_key(o) for o in _split_order(order)])
    if offset:
        out = out.offset(offset)
    if limit is not None:
        out = out.limit(limit)
    return out


def _sort_key(term: str):
    """``expr [ASC|DESC] [NULLS FIRST|LAST]`` -> a sort column."""
    words = term.strip().split()
    upper = [w.upper() for w in words]
    nulls = None
    if len(upper) >= 2 and upper[-2] == "NULLS":
        nulls = upper[-1]
        words, upper = words[:-2], upper[:-2]
    desc = False
    if upper and upper[-1] in ("ASC", "DESC"):
        desc = upper[-1] == "DESC"
        words = words[:-1]
    c = F.expr(" ".join(words))
    if desc:
        return c.desc_nulls_first() if nulls == "FIRST" else c.desc_nulls_last() if nulls == "LAST" else c.desc()
    return c.asc_nulls_last() if nulls == "LAST" else c.asc_nulls_first() if nulls == "FIRST" else c.asc()


def _split_order(order: str) -> list[str]:
    parts, depth, cur = [], 0, ""
    for ch in order:
        depth += ch == "("
        depth -= ch == ")"
        if ch == "," and depth == 0:
            parts.append(cur)
            cur = ""
        else:
            cur += ch
    return [p for p in [*parts, cur] if p.strip()]
