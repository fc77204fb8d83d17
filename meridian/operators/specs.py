"""Dataset specs as a DataFrame: I1 scan, V1/V2 rules, I13/R10 routing, K6 load plan,
K10 source registration and V9 sync check.

Specs are a small table (one row per dataset); rule and route tables are fixed-size
lookups and are broadcast by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPEC_SCHEMA = (
    "pos bigint, key string, source string, description string, group_name string, "
    "dataset_id string, domain string, path string, year int"
)
DEFAULT_DOMAIN = "data.cms.gov"

# The closed set of sources.
SOURCES = (
    "socrata",
    "healthcare_gov",
    "dkan_provider_data",
    "dkan_data_api_bulk",
    "dkan_medicaid_bulk",
    "dkan_open_payments_bulk",
    "dkan_healthcare_gov_zip",
)

# Per source, fields that must be truthy and fields that must be unset.
FIELD_RULES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "socrata": (("dataset_id",), ("path", "year")),
    "healthcare_gov": (("path",), ("dataset_id", "year")),
    "dkan_provider_data": (("dataset_id",), ("path", "year")),
    "dkan_data_api_bulk": (("dataset_id",), ("path",)),
    "dkan_medicaid_bulk": (("dataset_id",), ("path", "year")),
    "dkan_open_payments_bulk": (("dataset_id",), ("path", "year")),
    "dkan_healthcare_gov_zip": (("dataset_id",), ("path", "year")),
}

# Loader and host per source; URL templates of the resolved entry point.
ROUTES: dict[str, tuple[str, str | None]] = {
    "socrata": ("json_pages", None),  # host is https://<domain>
    "healthcare_gov": ("static_json", "https://www.healthcare.gov"),
    "dkan_provider_data": ("json_pages", "https://data.cms.gov"),
    "dkan_data_api_bulk": ("bulk_csv", "https://data.cms.gov"),
    "dkan_medicaid_bulk": ("bulk_csv", "https://data.medicaid.gov"),
    "dkan_open_payments_bulk": ("bulk_csv", "https://openpaymentsdata.cms.gov"),
    "dkan_healthcare_gov_zip": ("zipped_sheet", "https://data.healthcare.gov"),
}
URL_TEMPLATES: dict[str, str] = {
    "socrata": "{host}/resource/{dataset_id}.json",
    "healthcare_gov": "{host}{path}",
    "dkan_provider_data": "{host}/provider-data/api/1/metastore/schemas/dataset/items/{dataset_id}",
    "dkan_data_api_bulk": "{host}/data.json",
    "dkan_medicaid_bulk": "{host}/api/1/metastore/schemas/dataset/items/{dataset_id}",
    "dkan_open_payments_bulk": "{host}/api/1/metastore/schemas/dataset/items/{dataset_id}",
    "dkan_healthcare_gov_zip": "{host}/api/1/metastore/schemas/dataset/items/{dataset_id}",
}
ASSET_PREFIX = "cms_"


def scan_specs(specs: DataFrame) -> DataFrame:
    """Specs in file order (``pos``) with defaults applied."""
    return specs.select(
        "pos", "key", "source", "description", "group_name", "dataset_id",
        F.coalesce("domain", F.lit(DEFAULT_DOMAIN)).alias("domain"), "path", "year",
    )


def specs_from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """I1 for a parsed spec file (a few dozen rows): unknown keys are rejected (V2)."""
    allowed = {"key", "source", "description", "group", "dataset_id", "domain", "path", "year"}
    for i, r in enumerate(rows):
        extra = set(r) - allowed
        if extra:
            raise ValueError(f"spec {i}: unknown fields {sorted(extra)}")
    data = [
        (i, r.get("key"), r.get("source"), r.get("description"), r.get("group"), r.get("dataset_id"),
         r.get("domain"), r.get("path"), r.get("year"))
        for i, r in enumerate(rows)
    ]
    return scan_specs(spark.createDataFrame(data, SPEC_SCHEMA))


def load_spec_file(spark: SparkSession, path: str) -> DataFrame:
    """A TOML spec file (``[[dataset]]`` tables) -> specs in file order.

    The file is a few dozen rows and is parsed on the driver with the standard library;
    a missing ``dataset`` array gives zero rows, a non-array raises ``TypeError``.
    """
    import tomllib

    # read by Spark, so that the file may lie in any store
    text = "\n".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())
    tables = tomllib.loads(text).get("dataset", [])
    if type(tables) is not list:
        raise TypeError(f"dataset must be written as [[dataset]] tables in {path}")
    return specs_from_rows(spark, tables)


def _rules(spark: SparkSession) -> DataFrame:
    rows = [(src, f, "required") for src, (req, _) in FIELD_RULES.items() for f in req]
    rows += [(src, f, "forbidden") for src, (_, forb) in FIELD_RULES.items() for f in forb]
    return F.broadcast(spark.createDataFrame(rows, "source string, field string, rule string"))


def rule_violations(specs: DataFrame) -> DataFrame:
    """V1+V2: ``(key, source, field, kind)`` for every broken rule.

    required = truthy (non-NULL, non-empty, non-zero); forbidden = must be NULL.
    Unknown sources and duplicated keys are reported too. All violations are listed
    (the original stops at the first).
    """
    spark = specs.sparkSession
    fields = specs.selectExpr(
        "key", "source",
        "stack(3, 'dataset_id', dataset_id IS NULL, dataset_id IS NULL OR dataset_id = '', "
        "'path', path IS NULL, path IS NULL OR path = '', "
        "'year', year IS NULL, year IS NULL OR year = 0) AS (field, is_null, falsy)",
    )
    broken = fields.join(_rules(spark), ["source", "field"]).where(
        ((F.col("rule") == "required") & F.col("falsy")) | ((F.col("rule") == "forbidden") & ~F.col("is_null"))
    ).select("key", "source", "field", F.col("rule").alias("kind"))
    unknown = specs.where(~F.col("source").isin(*SOURCES) | F.col("source").isNull()).select(
        "key", "source", F.lit("source").alias("field"), F.lit("unknown_source").alias("kind"))
    dup_keys = specs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    dups = specs.join(dup_keys, "key", "left_semi").select(
        "key", "source", F.lit("key").alias("field"), F.lit("duplicate_key").alias("kind"))
    return broken.unionByName(unknown).unionByName(dups)


def routes(spark: SparkSession, only: tuple[str, ...] | None = None) -> DataFrame:
    rows = [(s, loader, host) for s, (loader, host) in ROUTES.items() if only is None or s in only]
    return F.broadcast(spark.createDataFrame(rows, "source string, loader string, host string"))


def routed(specs: DataFrame, only: tuple[str, ...] | None = None) -> DataFrame:
    """Specs with a reader for their source, with loader and host."""
    r = routes(specs.sparkSession, only)
    out = specs.join(r, "source")
    host = F.coalesce(F.col("host"), F.concat(F.lit("https://"), F.coalesce("domain", F.lit(DEFAULT_DOMAIN))))
    return out.withColumn("host", host)


def unrouted(specs: DataFrame, only: tuple[str, ...] | None = None) -> DataFrame:
    """Specs skipped (not failed) because no reader handles their source."""
    return specs.join(routes(specs.sparkSession, only), "source", "left_anti")


def load_plan(specs: DataFrame, prefix: str = ASSET_PREFIX) -> DataFrame:
    """One load per valid, routed spec: target name, group, reader and entry URL."""
    bad = rule_violations(specs).select("key").distinct()
    ok = routed(specs.join(bad, "key", "left_anti"))
    url = F.lit(None).cast("string")
    for source, tmpl in URL_TEMPLATES.items():
        url = F.when(F.col("source") == source, _template(tmpl)).otherwise(url)
    return ok.select(
        "pos", "key", F.concat(F.lit(prefix), F.col("key")).alias("asset_name"), "group_name", "description",
        "source", "loader", url.alias("entry_url"),
    )


def _template(tmpl: str):
    """``{host}/x/{dataset_id}`` -> concat(host, '/x/', dataset_id)."""
    parts, rest = [], tmpl
    while rest:
        i = rest.find("{")
        if i < 0:
            parts.append(F.lit(rest))
            break
        if i:
            parts.append(F.lit(rest[:i]))
        j = rest.index("}", i)
        parts.append(F.col(rest[i + 1:j]))
        rest = rest[j + 1:]
    return F.concat(*parts)


#: positions numbered together by one task
BLOCK = 4096


def source_table(specs: DataFrame, extras: DataFrame, prefix: str = ASSET_PREFIX) -> DataFrame:
    """Every spec as a named source ``(seq, name, description)`` in file order, with each
    extra ``(name, description, after_key)`` placed right after its anchor spec; an extra
    without an anchor fails."""
    base = specs.select(F.col("pos"), F.lit(0).alias("is_extra"),
                        F.concat(F.lit(prefix), F.col("key")).alias("name"), "description")
    anchored = extras.join(specs.select(F.col("key").alias("after_key"), F.col("pos").alias("_at")), "after_key", "left").select(
        F.coalesce("_at", F.raise_error(F.concat(F.lit("no spec has the key "), "after_key")).cast("int")).alias("pos"),
        F.lit(1).alias("is_extra"), "name", "description")
    both = base.select(F.col("pos").cast("int").alias("pos"), "is_extra", "name", "description").unionByName(anchored)
    # numbered inside blocks of positions, which hold at most BLOCK specs and their extras, on top of
    # the rows of the blocks before: only one row a block passes through an ordering without a key
    both = both.withColumn("_block", F.floor(F.col("pos") / BLOCK))
    before = F.sum("n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    bases = both.groupBy("_block").agg(F.count("*").alias("n")).select("_block", F.coalesce(before, F.lit(0)).alias("_base"))
    local = F.row_number().over(Window.partitionBy("_block").orderBy("pos", "is_extra", "name"))
    seq = (F.col("_base") + F.col("_local") - 1).cast("int")
    return both.withColumn("_local", local).join(bases, "_block").select(
        seq.alias("seq"), "pos", "is_extra", "name", "description")


def unknown_anchors(specs: DataFrame, extras: DataFrame) -> DataFrame:
    """K10 error: extras whose anchor key is not a spec."""
    return extras.join(specs.select(F.col("key").alias("after_key")), "after_key", "left_anti")


def sources_diff(declared: DataFrame, expected: DataFrame) -> DataFrame:
    """V9: ``(name, description, problem)`` differences in both directions (multiset)."""
    e = expected.select("name", "description")
    d = declared.select("name", "description")
    return e.exceptAll(d).withColumn("problem", F.lit("missing_from_sources")).unionByName(
        d.exceptAll(e).withColumn("problem", F.lit("not_in_registry")))
