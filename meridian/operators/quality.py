"""Declarative data tests (Q1-Q6): each returns failing rows; zero rows means pass.

``run_tests`` evaluates a whole test suite in one aggregate pass over one scan; the
only shuffle is the grouping that ``unique`` needs, and it is partially aggregated
on the map side, so a hot key costs one row per map task, not one task per key.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.text import matches


@dataclass(frozen=True)
class DataTest:
    """One declared test. ``kind`` is one of not_null, unique, regex, range, expression."""

    name: str
    kind: str
    column: str | None = None
    params: dict = field(default_factory=dict)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Q2: duplicated non-null values with their counts (``unique_field``, ``n_records``)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def match_regex(df: DataFrame, column: str, regex: str) -> DataFrame:
    """Q3: non-null values that do not match; NULL passes."""
    return df.where(_regex_fails(column, regex))


def accepted_range(
    df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True
) -> DataFrame:
    """Q4: values outside the (optionally open-ended) range; NULL passes."""
    return df.where(_range_fails(column, min_value, max_value, inclusive))


def expression_is_true(df: DataFrame, expression: str) -> DataFrame:
    """Q5: rows where the SQL expression is false (NULL passes, as in ``where not (...)``)."""
    return df.where(~F.expr(expression))


def _regex_fails(column: str, regex: str) -> Column:
    return ~matches(F.col(column), regex)


def _range_fails(column: str, min_value, max_value, inclusive: bool) -> Column:
    c = F.col(column)
    conds = []
    if min_value is not None:
        conds.append(c >= min_value if inclusive else c > min_value)
    if max_value is not None:
        conds.append(c <= max_value if inclusive else c < max_value)
    ok = F.lit(True)
    for cond in conds:
        ok = ok & cond
    return ~ok


def failure_condition(test: DataTest) -> Column:
    """Row-level failure predicate (NULL counts as pass, as in ``where``)."""
    p = test.params
    if test.kind == "not_null":
        return F.col(test.column).isNull()
    if test.kind == "regex":
        return _regex_fails(test.column, p["regex"])
    if test.kind == "range":
        return _range_fails(test.column, p.get("min_value"), p.get("max_value"), p.get("inclusive", True))
    if test.kind == "expression":
        return ~F.expr(p["expression"])
    raise ValueError(f"not a row-level test kind: {test.kind}")


def failing_rows(df: DataFrame, test: DataTest) -> DataFrame:
    """Dispatch one test to its failing-rows query."""
    if test.kind == "unique":
        return unique(df, test.column)
    return df.where(failure_condition(test))


def run_tests(df: DataFrame, tests: list[DataTest]) -> DataFrame:
    """Q6: one row per test, ``(test_name, failures)``, from one pass over ``df``.

    Row-level tests become ``count_if`` aggregates. The first ``unique`` test is folded
    into the same job: group by its column (partial aggregation on the map side), carry
    the row-level partial counts, then a second tiny aggregate adds them up and counts
    groups with more than one row. Further ``unique`` tests on other columns add one
    grouping each.
    """
    row_tests = [t for t in tests if t.kind != "unique"]
    uniq = [t for t in tests if t.kind == "unique"]
    parts: list[DataFrame] = []

    def flag(t: DataTest) -> Column:
        return F.count_if(F.coalesce(failure_condition(t), F.lit(False)))

    if uniq:
        first = uniq[0]
        key = F.col(first.column)
        grouped = df.groupBy(key.alias("_k")).agg(
            F.count(F.lit(1)).alias("_n"), *[flag(t).alias(f"_f{i}") for i, t in enumerate(row_tests)]
        )
        totals = grouped.agg(
            F.count_if(F.col("_k").isNotNull() & (F.col("_n") > 1)).alias("_u0"),
            *[F.sum(f"_f{i}").alias(f"_f{i}") for i in range(len(row_tests))],
        )
        names = [(first.name, "_u0")] + [(t.name, f"_f{i}") for i, t in enumerate(row_tests)]
        parts.append(_unpivot(totals, names))
        for j, t in enumerate(uniq[1:], start=1):
            g = df.where(F.col(t.column).isNotNull()).groupBy(t.column).agg(F.count(F.lit(1)).alias("_n"))
            agg = g.agg(F.count_if(F.col("_n") > 1).alias(f"_u{j}"))
            parts.append(_unpivot(agg, [(t.name, f"_u{j}")]))
    else:
        totals = df.agg(*[flag(t).alias(f"_f{i}") for i, t in enumerate(row_tests)])
        parts.append(_unpivot(totals, [(t.name, f"_f{i}") for i, t in enumerate(row_tests)]))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _unpivot(one_row: DataFrame, names: list[tuple[str, str]]) -> DataFrame:
    pairs = ", ".join(f"'{n}', coalesce(cast({c} as bigint), 0L)" for n, c in names)
    return one_row.selectExpr(f"stack({len(names)}, {pairs}) as (test_name, failures)")


# The data tests declared on the hospital staging model.
HOSPITAL_TESTS: list[DataTest] = [
    DataTest("not_null_facility_id", "not_null", "facility_id"),
    DataTest("unique_facility_id", "unique", "facility_id"),
    DataTest("not_null_zip5", "not_null", "zip5"),
    DataTest("match_regex_zip5", "regex", "zip5", {"regex": "^\\d{5}$"}),
    DataTest(
        "accepted_range_hospital_overall_rating",
        "range",
        "hospital_overall_rating",
        {"min_value": 1, "max_value": 5, "inclusive": True},
    ),
    DataTest(
        "expression_is_true_mort_counts",
        "expression",
        None,
        {
            "expression": "count_of_facility_mort_measures <= mort_group_measure_count"
            " or count_of_facility_mort_measures is null"
            " or mort_group_measure_count is null"
        },
    ),
]
