"""Provider registry scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.operators import providers as prov
from meridian.operators import records as rec
from meridian.plans import derived, fixtures
from meridian.plans.registry import query
from meridian.sources.tables import register


def _provider_variants(spark, sf_dir):
    return derived.provider_records(spark, sf_dir).select("c_custkey", F.parse_json("body").alias("record"))


def _typed_providers(spark, sf_dir):
    return rec.providers(_provider_variants(spark, sf_dir), "record")


_PROV = f"WITH p AS ({fixtures.provider_rows()})\n"


@query(
    "providers_nested",
    _PROV + "SELECT c_custkey, number, enumeration_type, last_name, organization_name, 2 AS n_addresses, "
    "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS taxonomy, "
    "concat('{\"other_names\":[{\"name\":\"', c_name, '\"}]}') AS _extra "
    "FROM p WHERE enumeration_type = 'NPI-2' AND (state = 'S03' OR mail_state = 'S03')",
)
def q_providers_nested(spark, sf_dir):
    found = prov.search_filter(_typed_providers(spark, sf_dir), state="S03", enumeration_type="NPI-2")
    return found.select(
        "c_custkey", "number", "enumeration_type", F.col("basic.last_name").alias("last_name"),
        F.col("basic.organization_name").alias("organization_name"), F.size("addresses").alias("n_addresses"),
        F.get(F.col("taxonomies"), 0)["desc"].alias("taxonomy"), "_extra",
    )


_SEARCH = (
    _PROV.rstrip("\n") + ",\nf AS (SELECT *, row_number() OVER (PARTITION BY state ORDER BY c_custkey) - 1 AS rk "
    "FROM p WHERE enumeration_type = 'NPI-2' AND number IS NOT NULL),\nc AS (SELECT * FROM f WHERE rk < 1200)\n"
)


@query("provider_search", _SEARCH + "SELECT state, number, organization_name FROM c")
def q_provider_search(spark, sf_dir):
    found = prov.search_pages(derived.provider_pages(spark, sf_dir))
    return found.select(F.col("dataset").alias("state"), "number", F.col("basic.organization_name").alias("organization_name"))


@query("provider_sweep_counts", _SEARCH + "SELECT state, count(*) AS n_rows FROM c GROUP BY state")
def q_provider_sweep_counts(spark, sf_dir):
    found = prov.search_pages(derived.provider_pages(spark, sf_dir))
    return prov.sweep_counts(found).withColumnRenamed("dataset", "state")


@query(
    "sweep_states",
    _SEARCH + "SELECT t.state, count(c.number) AS n_rows FROM (SELECT concat('S', lpad(CAST(n_nationkey + 3 AS VARCHAR), 2, '0')) AS state "
    "FROM nation) t LEFT JOIN c ON c.state = t.state GROUP BY t.state",
)
def q_sweep_states(spark, sf_dir):
    """A sweep driven by a list of states, some of them without providers; providers of other states are not read."""
    states = [f"S{i + 3:02d}" for i in range(25)]
    found = prov.sweep(derived.provider_pages(spark, sf_dir), states)
    return prov.sweep_counts(found, queries=prov.state_table(spark, states)).withColumnRenamed("dataset", "state")


@query(
    "provider_lookup",
    f"WITH r AS ({fixtures.npi_requests()}),\np AS ({fixtures.provider_rows()})\n"
    "SELECT r.o_orderkey, r.npi, regexp_matches(r.npi, '^[0-9]{10}$') AS valid, "
    "CASE WHEN regexp_matches(r.npi, '^[0-9]{10}$') THEN p.number IS NOT NULL END AS found, p.last_name "
    "FROM r LEFT JOIN p ON r.npi = p.number AND regexp_matches(r.npi, '^[0-9]{10}$')",
)
def q_provider_lookup(spark, sf_dir):
    register(spark, sf_dir, "orders")
    ids = spark.sql(fixtures.npi_requests())
    out = prov.lookup(ids, "npi", _typed_providers(spark, sf_dir), ["c_custkey"])
    return out.select("o_orderkey", "npi", "valid", "found", F.col("p.basic.last_name").alias("last_name"))


_HOT_IDS = ("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '0000000007' WHEN o_orderkey % 7 = 0 THEN NULL "
            "WHEN o_orderkey % 11 = 0 THEN 'none' ELSE lpad(CAST(o_custkey * 2 AS {text}), 10, '0') END AS npi FROM orders")


@query(
    "provider_lookup_hot",
    f"WITH r AS ({_HOT_IDS.format(text='VARCHAR')}),\np AS ({fixtures.provider_rows()})\n"
    "SELECT r.o_orderkey, r.npi, coalesce(length(r.npi) = 10, false) AS valid, "
    "CASE WHEN length(r.npi) = 10 THEN p.number IS NOT NULL END AS found, p.last_name FROM r LEFT JOIN p ON r.npi = p.number",
)
def q_provider_lookup_hot(spark, sf_dir):
    """I5 where one id holds a third of all rows, and others are missing, malformed or unknown."""
    register(spark, sf_dir, "orders")
    out = prov.lookup(spark.sql(_HOT_IDS.format(text="STRING")), "npi", _typed_providers(spark, sf_dir), ["c_custkey"])
    return out.select("o_orderkey", "npi", "valid", "found", F.col("p.basic.last_name").alias("last_name"))


@query(
    "provider_violations",
    _PROV + "SELECT c_custkey, 'number_missing' AS violation FROM p WHERE number IS NULL\n"
    "UNION ALL SELECT c_custkey, 'enumeration_type_invalid' AS violation FROM p "
    "WHERE enumeration_type NOT IN ('NPI-1', 'NPI-2')",
)
def q_provider_violations(spark, sf_dir):
    return rec.provider_violations(_provider_variants(spark, sf_dir), ["c_custkey"])


@query(
    "providers_extras",
    _PROV + "SELECT c_custkey, '{\"authorized_official_last_name\":\"' || last_name || '\"}' AS basic_extra, "
    "'{\"fax_number\":\"' || postal_code || '\"}' AS address_extra, "
    "CASE WHEN c_custkey % 10 <> 0 THEN '{\"taxonomy_group\":\"g' || c_custkey % 3 || '\"}' END AS taxonomy_extra FROM p",
)
def q_providers_extras(spark, sf_dir):
    """Members no schema names survive on every level."""
    p = _typed_providers(spark, sf_dir)
    return p.select("c_custkey", F.col("basic._extra").alias("basic_extra"), F.get("addresses", F.lit(0))["_extra"].alias("address_extra"),
                    F.get("taxonomies", F.lit(0))["_extra"].alias("taxonomy_extra"))
