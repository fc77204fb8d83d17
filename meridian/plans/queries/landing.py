"""Landing, reading back, models, bulk CSV, spreadsheets and streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from meridian.operators import providers as prov
from meridian.plans import derived, fixtures, models
from meridian.plans.queries.providers import _SEARCH
from meridian.plans.queries.staging import _oracle_staging, facilities
from meridian.plans.registry import ORACLES, query
from meridian.session import fresh_path
from meridian.sinks import landing
from meridian.sources import bulk_csv, raw, sheets
from meridian.sources.tables import register
from meridian.sources.tables import table as driver_table

_CUST = "cms_customers"


def _land_customer_runs(spark, sf_dir):
    """Customer split by key parity into run-a / run-b in one write job; run-c has no rows,
    so the guard leaves nothing of it."""
    root = fresh_path(spark, "raw")
    cust = driver_table(spark, sf_dir, "customer")
    runs = cust.withColumn("_run", F.when(F.col("c_custkey") % 2 == 0, "run-a").otherwise("run-b"))
    landing.land_runs(runs, root, _CUST, "_run", expected_runs=["run-a", "run-b", "run-c"])
    return root


@query("land_two_runs", "SELECT * FROM customer")
def q_land_two_runs(spark, sf_dir):
    root = _land_customer_runs(spark, sf_dir)
    return raw.read_runs(spark, root, _CUST)


@query(
    "runs_type_drift",
    "SELECT CAST(c_custkey AS BIGINT) AS id, CASE WHEN c_custkey % 3 = 2 THEN NULL "
    "WHEN c_custkey % 3 = 1 THEN c_nationkey + 0.5 ELSE CAST(c_nationkey AS DOUBLE) END AS amount, "
    "CASE c_custkey % 3 WHEN 0 THEN CAST(c_nationkey AS VARCHAR) WHEN 1 THEN c_name "
    "ELSE CASE WHEN c_nationkey > 9 THEN 'true' ELSE 'false' END END AS code FROM customer",
)
def q_runs_type_drift(spark, sf_dir):
    """Three runs of one asset; every column changed its type between them, one was missing once."""
    root = fresh_path(spark, "raw")
    cust = driver_table(spark, sf_dir, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    runs = [cust.where(key % 3 == 0).select(key.cast("int").alias("id"), nation.cast("int").alias("amount"), nation.cast("int").alias("code")),
            cust.where(key % 3 == 1).select(key.cast("bigint").alias("id"), (nation + F.lit(0.5)).cast("double").alias("amount"),
                                            F.col("c_name").alias("code")),
            cust.where(key % 3 == 2).select(key.cast("int").alias("id"),
                                            (nation > 9).alias("code"))]
    for i, run in enumerate(runs):
        landing.land(run, root, _CUST, f"run-{i}", record_metrics=False)
    return raw.read_runs(spark, root, _CUST)


@query(
    "landing_metrics",
    f"SELECT '{_CUST}' AS asset, 'run-a' AS run_id, count(*) AS row_count, 5 AS column_count "
    "FROM customer WHERE c_custkey % 2 = 0\n"
    f"UNION ALL SELECT '{_CUST}', 'run-b', count(*), 5 FROM customer WHERE c_custkey % 2 = 1",
)
def q_landing_metrics(spark, sf_dir):
    root = _land_customer_runs(spark, sf_dir)
    return landing.read_metrics(spark, root).select("asset", "run_id", "row_count", "column_count")


@query(
    "empty_guard",
    "SELECT concat('seg-', lower(c_mktsegment)) AS run_id, count(*) AS row_count FROM customer GROUP BY c_mktsegment",
)
def q_empty_guard(spark, sf_dir):
    """K4: one run per market segment plus a requested segment with no rows, landed in one
    job; only runs with rows are published."""
    root = fresh_path(spark, "raw")
    cust = driver_table(spark, sf_dir, "customer")
    runs = cust.withColumn("_run", F.concat(F.lit("seg-"), F.lower("c_mktsegment")))
    _, empty = landing.land_runs(runs, root, "cms_segments", "_run", expected_runs=["seg-none"])
    if empty != ["seg-none"]:
        raise RuntimeError(f"unexpected empty runs: {empty}")
    back = raw.read_runs(spark, root, "cms_segments", with_run_id=True)
    return back.groupBy(F.col("_run_id").alias("run_id")).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "external_views",
    "SELECT c_mktsegment, count(*) AS n_customers, CAST(sum(c_nationkey) AS BIGINT) AS nation_sum "
    "FROM customer GROUP BY c_mktsegment",
)
def q_external_views(spark, sf_dir):
    """Landed runs registered as a named source and queried by name in SQL."""
    root = _land_customer_runs(spark, sf_dir)
    raw.register_source(spark, root, _CUST)
    return spark.sql(
        f"SELECT c_mktsegment, count(*) AS n_customers, CAST(sum(c_nationkey) AS BIGINT) AS nation_sum "
        f"FROM {_CUST} GROUP BY c_mktsegment"
    )


@query(
    "mart_table",
    _oracle_staging(fixtures.raw_facilities()) + "SELECT state, count(*) AS n_facilities, "
    "count(hospital_overall_rating) AS n_rated, count(*) FILTER (WHERE emergency_services) AS n_emergency "
    "FROM staged GROUP BY state",
)
def q_mart_table(spark, sf_dir):
    """K8/K9: staging (view) -> mart aggregate saved as a table in its own schema -> read back."""
    staged = models.view(facilities(spark, sf_dir), "stg_hospital_general_information")
    mart = models.ephemeral(staged).groupBy("state").agg(
        F.count(F.lit(1)).alias("n_facilities"),
        F.count("hospital_overall_rating").alias("n_rated"),
        F.count_if(F.col("emergency_services")).alias("n_emergency"),
    )
    schema = f"marts_{uuid.uuid4().hex[:8]}"
    return models.table(mart, schema, "facilities_by_state")


@query(
    "bulk_csv_roundtrip",
    "SELECT lpad(CAST(o_orderkey AS VARCHAR), 11, '0') AS order_ref, o_custkey, o_totalprice, o_orderstatus, "
    "CAST(o_orderdate AS DATE) AS order_date FROM orders",
)
def q_bulk_csv_roundtrip(spark, sf_dir):
    """Orders written as CSV, loaded with type inference, landed, read back."""
    src = fresh_path(spark, "csv")
    orders = driver_table(spark, sf_dir, "orders")
    orders.select(
        F.lpad(F.col("o_orderkey").cast("string"), 11, "0").alias("order_ref"), "o_custkey", "o_totalprice",
        "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
    ).write.option("header", True).csv(src)
    root = fresh_path(spark, "raw")
    bulk_csv.bulk_load(spark, src, root, "cms_orders_csv", "run-1")
    return raw.read_runs(spark, root, "cms_orders_csv")


@query("csv_multiline", fixtures.noted_parts())
def q_csv_multiline(spark, sf_dir):
    """Values that span lines, written as CSV and read back by tasks that each cut a part of a file."""
    src = fresh_path(spark, "csv")
    register(spark, sf_dir, "part")
    # the writer trims values unless told not to
    spark.sql(fixtures.noted_parts()).write.option("header", True).option("escape", '"').option("ignoreTrailingWhiteSpace", False).csv(src)
    return bulk_csv.read_typed_csv(spark, src)


@query(
    "sheet_roundtrip",
    'SELECT CAST(n_nationkey AS VARCHAR) AS "Nation Key", n_name AS "Nation Name", '
    'CAST(n_regionkey AS VARCHAR) AS "Region Key", r_name AS "Region Name" '
    "FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def q_sheet_roundtrip(spark, sf_dir):
    """Zipped workbooks -> text columns named by the header row -> landed run -> read back."""
    table_df = sheets.read_sheets(spark, derived.sheet_archives(spark, sf_dir))
    root = fresh_path(spark, "raw")
    landing.land(table_df, root, "cms_nation_sheets", "run-1")
    return raw.read_runs(spark, root, "cms_nation_sheets")


@query(
    "providers_landed",
    _SEARCH + "SELECT state, number, 2 AS n_addresses, state AS location_state, "
    "CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END AS n_taxonomies FROM c",
)
def q_providers_landed(spark, sf_dir):
    """Nested provider rows landed as nested Parquet columns and read back."""
    found = prov.search_pages(derived.provider_pages(spark, sf_dir))
    root = fresh_path(spark, "raw")
    landing.land(found.drop("record", "pos"), root, "cms_nppes_providers", "run-1")
    back = raw.read_runs(spark, root, "cms_nppes_providers")
    return back.select(
        F.col("dataset").alias("state"), "number", F.size("addresses").alias("n_addresses"),
        F.col("addresses")[0]["state"].alias("location_state"), F.size("taxonomies").alias("n_taxonomies"))


@query("csv_stream_land", ORACLES["bulk_csv_roundtrip"])
def q_csv_stream_land(spark, sf_dir):
    """K2 as a stream: CSV files in a drop folder landed micro-batch by micro-batch."""
    from meridian.streaming.drop_folder import land_csv_stream

    src = fresh_path(spark, "drop")
    driver_table(spark, sf_dir, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 11, "0").alias("order_ref"), "o_custkey", "o_totalprice",
        "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
    ).repartition(4).write.option("header", True).csv(src)
    root = fresh_path(spark, "raw")
    land_csv_stream(spark, src, "order_ref string, o_custkey bigint, o_totalprice double, o_orderstatus string, "
                    "order_date date", root, "cms_orders_stream", max_files_per_trigger=2)
    return raw.read_runs(spark, root, "cms_orders_stream")


@query(
    "sheet_archive_errors",
    "SELECT concat('mem://sheets/region_', CAST(r AS VARCHAR), '.zip') AS path, "
    "CASE r WHEN 0 THEN 'no_xlsx_member' WHEN 1 THEN 'several_xlsx_members' ELSE 'no_header_row' END AS error "
    "FROM (SELECT DISTINCT n_regionkey AS r FROM nation JOIN region ON n_regionkey = r_regionkey) t WHERE r IN (0, 1, 2)",
)
def q_sheet_archive_errors(spark, sf_dir):
    """Per-archive errors (member count, header row) as a report."""
    return sheets.archive_errors(sheets.sheet_rows(derived.sheet_archives(spark, sf_dir, broken=True)))
