"""Staging model and data tests on a hospital-shaped raw table (E1-E5 F10 F11 Q1-Q6), and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions.casts import blank_to_null, lenient_int, y_only, yes_no
from meridian.operators import quality
from meridian.operators.conform import HOSPITAL_COLUMNS, conform_hospitals
from meridian.plans import fixtures
from meridian.plans.registry import query
from meridian.sources.tables import register


def _oracle_rule(rule: str, raw: str) -> str:
    return {
        "copy": raw,
        "trim": f"trim({raw})",
        "blank_to_null": f"nullif(trim({raw}), '')",
        "int": f"try_cast({raw} AS INTEGER)",
        "yes_no": f"CASE WHEN {raw} = 'Yes' THEN true WHEN {raw} = 'No' THEN false END",
        "y_only": f"CASE WHEN {raw} = 'Y' THEN true END",
    }[rule]


def _oracle_staging(raw_sql: str) -> str:
    cols = ",\n  ".join(f"{_oracle_rule(rule, raw)} AS {out}" for out, raw, rule in HOSPITAL_COLUMNS)
    return f"WITH source AS ({raw_sql}),\nstaged AS (SELECT\n  {cols}\nFROM source)\n"


def facilities(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    register(spark, sf_dir, "supplier", "nation")
    return conform_hospitals(spark.sql(fixtures.raw_facilities(dirty)))


@query("conform_facilities", _oracle_staging(fixtures.raw_facilities()) + "SELECT * FROM staged")
def q_conform_facilities(spark, sf_dir):
    return facilities(spark, sf_dir)


@query(
    "safe_int_cast",
    f"SELECT l_orderkey, l_linenumber, v_text, try_cast(v_text AS INTEGER) AS v_int FROM ({fixtures.int_text()}) t",
)
def q_safe_int_cast(spark, sf_dir):
    register(spark, sf_dir, "lineitem")
    return spark.sql(fixtures.int_text()).withColumn("v_int", lenient_int("v_text"))


@query(
    "blank_to_null",
    f"SELECT o_orderkey, priority_raw, nullif(trim(priority_raw), '') AS priority FROM ({fixtures.padded_priority()}) t",
)
def q_blank_to_null(spark, sf_dir):
    register(spark, sf_dir, "orders")
    return spark.sql(fixtures.padded_priority()).withColumn("priority", blank_to_null("priority_raw"))


@query(
    "flag_yes_no",
    "SELECT o_orderkey, status_raw, CASE WHEN status_raw = 'Yes' THEN true WHEN status_raw = 'No' THEN false END"
    f" AS is_flagged FROM ({fixtures.status_flags()}) t",
)
def q_flag_yes_no(spark, sf_dir):
    register(spark, sf_dir, "orders")
    return spark.sql(fixtures.status_flags()).withColumn("is_flagged", yes_no("status_raw"))


@query(
    "flag_y_only",
    f"SELECT p_partkey, flag_raw, CASE WHEN flag_raw = 'Y' THEN true END AS is_flagged FROM ({fixtures.brand_flags()}) t",
)
def q_flag_y_only(spark, sf_dir):
    register(spark, sf_dir, "part")
    return spark.sql(fixtures.brand_flags()).withColumn("is_flagged", y_only("flag_raw"))


@query(
    "dq_not_null",
    _oracle_staging(fixtures.raw_facilities(True))
    + "SELECT 'not_null_facility_id' AS test_name, facility_id, city FROM staged WHERE facility_id IS NULL\n"
    "UNION ALL SELECT 'not_null_zip5' AS test_name, facility_id, city FROM staged WHERE zip5 IS NULL",
)
def q_dq_not_null(spark, sf_dir):
    staged = facilities(spark, sf_dir, dirty=True).select("facility_id", "zip5", "city")
    a = quality.not_null(staged, "facility_id").select(F.lit("not_null_facility_id").alias("test_name"), "facility_id", "city")
    b = quality.not_null(staged, "zip5").select(F.lit("not_null_zip5").alias("test_name"), "facility_id", "city")
    return a.unionByName(b)


@query(
    "dq_unique",
    "SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem "
    "WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1",
)
def q_dq_unique(spark, sf_dir):
    register(spark, sf_dir, "lineitem")
    return quality.unique(spark.table("lineitem"), "l_orderkey")


@query(
    "dq_regex",
    f"SELECT c_custkey, zip5 FROM ({fixtures.zip_text()}) t WHERE NOT regexp_matches(zip5, '^\\d{{5}}$')",
)
def q_dq_regex(spark, sf_dir):
    register(spark, sf_dir, "customer")
    return quality.match_regex(spark.sql(fixtures.zip_text()), "zip5", "^\\d{5}$")


@query("dq_range", "SELECT p_partkey, p_size FROM part WHERE NOT (p_size >= 1 AND p_size <= 40)")
def q_dq_range(spark, sf_dir):
    register(spark, sf_dir, "part")
    return quality.accepted_range(spark.table("part"), "p_size", 1, 40).select("p_partkey", "p_size")


_TAX_EXPR = "l_discount <= l_tax or l_discount is null or l_tax is null"


@query(
    "dq_expression",
    f"SELECT l_orderkey, l_linenumber FROM ({fixtures.nullable_tax()}) t WHERE NOT ({_TAX_EXPR})",
)
def q_dq_expression(spark, sf_dir):
    register(spark, sf_dir, "lineitem")
    return quality.expression_is_true(spark.sql(fixtures.nullable_tax()), _TAX_EXPR).select(
        "l_orderkey", "l_linenumber"
    )


def _oracle_report() -> str:
    mort = quality.HOSPITAL_TESTS[-1].params["expression"]
    return _oracle_staging(fixtures.raw_facilities(True)) + (
        "SELECT 'not_null_facility_id' AS test_name, count(*) AS failures FROM staged WHERE facility_id IS NULL\n"
        "UNION ALL SELECT 'unique_facility_id', count(*) FROM (SELECT facility_id FROM staged "
        "WHERE facility_id IS NOT NULL GROUP BY facility_id HAVING count(*) > 1) u\n"
        "UNION ALL SELECT 'not_null_zip5', count(*) FROM staged WHERE zip5 IS NULL\n"
        "UNION ALL SELECT 'match_regex_zip5', count(*) FROM staged WHERE NOT regexp_matches(zip5, '^\\d{5}$')\n"
        "UNION ALL SELECT 'accepted_range_hospital_overall_rating', count(*) FROM staged "
        "WHERE NOT (hospital_overall_rating >= 1 AND hospital_overall_rating <= 5)\n"
        f"UNION ALL SELECT 'expression_is_true_mort_counts', count(*) FROM staged WHERE NOT ({mort})"
    )


@query("dq_report", _oracle_report())
def q_dq_report(spark, sf_dir):
    return quality.run_tests(facilities(spark, sf_dir, dirty=True), quality.HOSPITAL_TESTS)


# ---------------------------------------------------------------- flagship


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conform the raw hospital table, land it as a run, read all runs back, run the data tests."""
    import uuid

    from meridian.session import fresh_path
    from meridian.sinks.landing import land
    from meridian.sources.raw import read_runs

    register(spark, sf_dir, "supplier", "nation")
    root = fresh_path(spark, "raw")
    raw = spark.sql(fixtures.raw_facilities(dirty=True))
    land(raw, root, "cms_hospital_general_information", f"run-{uuid.uuid4().hex[:8]}")
    staged = conform_hospitals(read_runs(spark, root, "cms_hospital_general_information"))
    return quality.run_tests(staged, quality.HOSPITAL_TESTS)
