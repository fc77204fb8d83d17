"""Catalog and metastore resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.operators import catalog as cat
from meridian.operators import resolution as res
from meridian.plans import derived, fixtures
from meridian.plans.registry import query
from meridian.sources.tables import register

_DISTS = f"WITH d AS ({fixtures.part_distributions()}),\n"
_IDENT = "concat('https://data.example.org/data-api/v1/dataset/', ds, '/data-viewer')"
_CSV = (
    _DISTS + "c AS (SELECT ds, ds_num, p_partkey, url, try_cast(substr(temporal, 1, 4) AS INTEGER) AS year FROM d "
    "WHERE ds_num % 9 <> 4 AND media_type = 'text/csv' AND length(url) > 0 "
    "AND regexp_matches(temporal, '^[0-9]{4}'))"
)


def _catalog_csv(spark, sf_dir):
    entries = cat.catalog_entries(derived.catalog_docs(spark, sf_dir))
    return cat.csv_distributions(cat.distributions(entries, ["doc_seq", "pos", "identifier"]))


@query(
    "catalog_latest",
    _CSV + ",\nr AS (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY year DESC, p_partkey DESC) AS rn FROM c)\n"
    f"SELECT {_IDENT} AS identifier, year, url FROM r WHERE rn = 1",
)
def q_catalog_latest(spark, sf_dir):
    return cat.latest_csv(_catalog_csv(spark, sf_dir), ["doc_seq", "pos", "identifier"]).select(
        "identifier", "year", "url")


# first catalog entry (shard descending, then id ascending) whose id starts with the requested id
_MATCH = (
    "m AS (SELECT q.key, q.dataset_id, q.year, d2.ds, row_number() OVER (PARTITION BY q.key "
    "ORDER BY CAST(floor(d2.ds_num / 10) AS BIGINT) DESC, d2.ds_num) AS rn FROM q "
    "JOIN (SELECT DISTINCT ds, ds_num FROM d) d2 ON starts_with(d2.ds, q.dataset_id))"
)


def _year_matches(spark, sf_dir):
    register(spark, sf_dir, "nation")
    reqs = spark.sql(fixtures.year_requests())
    entries = cat.catalog_entries(derived.catalog_docs(spark, sf_dir))
    matched = cat.match_specs(reqs.select("key", "dataset_id"), entries)
    csv = cat.csv_distributions(cat.distributions(entries, ["doc_seq", "pos", "identifier"]))
    csv_k = csv.join(matched.select("key", "doc_seq", "pos"), ["doc_seq", "pos"])
    req_k = reqs.join(matched.select("key"), "key", "left_semi").select("key", "year")
    return reqs, matched, csv_k, req_k


@query(
    "catalog_by_year",
    _CSV + f",\nq AS ({fixtures.year_requests()}),\n" + _MATCH + ",\n"
    "h AS (SELECT m.key, c.year, c.url, row_number() OVER (PARTITION BY m.key ORDER BY c.p_partkey DESC) AS rn "
    "FROM m JOIN c ON c.ds = m.ds AND c.year = m.year WHERE m.rn = 1)\n"
    "SELECT key, year, url FROM h WHERE rn = 1",
)
def q_catalog_by_year(spark, sf_dir):
    _, _, csv_k, req_k = _year_matches(spark, sf_dir)
    return cat.csv_for_year(csv_k, req_k, ["key"]).select("key", "year", "url")


@query(
    "catalog_missing_year",
    _CSV + f",\nq AS ({fixtures.year_requests()}),\n" + _MATCH + ",\n"
    "mm AS (SELECT * FROM m WHERE rn = 1),\n"
    "av AS (SELECT mm.key, array_to_string(list_sort(list_distinct(list(c.year))), ',') AS available "
    "FROM mm JOIN c ON c.ds = mm.ds GROUP BY mm.key)\n"
    "SELECT mm.key, mm.year, coalesce(av.available, '') AS available FROM mm LEFT JOIN av ON av.key = mm.key "
    "WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.ds = mm.ds AND c.year = mm.year)",
)
def q_catalog_missing_year(spark, sf_dir):
    _, _, csv_k, req_k = _year_matches(spark, sf_dir)
    return cat.missing_years(csv_k, req_k, ["key"]).select("key", "year", "available")


@query(
    "spec_match",
    f"WITH d AS ({fixtures.part_distributions()}),\n"
    f"q AS (SELECT key, dataset_id, year FROM ({fixtures.specs()}) s WHERE length(dataset_id) > 0),\n" + _MATCH +
    f"\nSELECT m.key, m.dataset_id, {_IDENT} AS identifier FROM m WHERE rn = 1",
)
def q_spec_match(spark, sf_dir):
    """Specs matched to catalog entries by identifier substring, first match wins."""
    register(spark, sf_dir, "supplier")
    specs = spark.sql(fixtures.specs()).where(F.length("dataset_id") > 0).select("key", "dataset_id")
    entries = cat.catalog_entries(derived.catalog_docs(spark, sf_dir))
    return cat.match_specs(specs, entries).select("key", "dataset_id", "identifier")


@query(
    "catalog_first_url",
    _DISTS + "e AS (SELECT * FROM d WHERE ds_num % 9 <> 4 AND length(url) > 0)\n"
    "SELECT ds AS dataset_id, arg_min(url, p_partkey) AS url FROM e GROUP BY ds",
)
def q_catalog_first_url(spark, sf_dir):
    return cat.first_url(derived.metastore_docs(spark, sf_dir))


@query(
    "catalog_first_zip",
    _DISTS + "e AS (SELECT * FROM d WHERE ds_num % 9 <> 4 AND length(url) > 0 AND "
    "(coalesce(lower(format) = 'zip', false) OR coalesce(contains(lower(media_type), 'zip'), false)))\n"
    "SELECT ds AS dataset_id, arg_min(url, p_partkey) AS url FROM e GROUP BY ds",
)
def q_catalog_first_zip(spark, sf_dir):
    return cat.first_zip(derived.metastore_docs(spark, sf_dir))


@query(
    "catalog_live_id",
    _DISTS.replace(",\n", "\n") + "SELECT ds AS dataset_id, CASE WHEN ds_num % 9 IN (4, 5, 6) THEN NULL "
    "ELSE concat('dist-', CAST(min(p_partkey) AS VARCHAR)) END AS live_id, CASE ds_num % 9 WHEN 4 THEN "
    "'no_distributions' WHEN 5 THEN 'first_not_object' WHEN 6 THEN 'identifier_missing' ELSE 'ok' END AS status "
    "FROM d GROUP BY ds, ds_num",
)
def q_catalog_live_id(spark, sf_dir):
    return cat.live_ids(derived.metastore_docs(spark, sf_dir))


@query(
    "catalog_shape_errors",
    "SELECT DISTINCT p_partkey // 1000 AS doc_seq, CASE (p_partkey // 1000) % 3 WHEN 0 THEN 'catalog_not_object' "
    "ELSE 'dataset_not_list' END AS error FROM part WHERE (p_partkey // 1000) % 3 IN (0, 1)",
)
def q_catalog_shape_errors(spark, sf_dir):
    """R1 errors: catalog payloads that are not objects or whose ``dataset`` is not a list."""
    return cat.catalog_errors(derived.malformed_catalogs(spark, sf_dir))


@query(
    "spec_unmatched",
    f"WITH d AS ({fixtures.part_distributions()}),\n"
    f"q AS (SELECT key, dataset_id FROM ({fixtures.specs()}) s WHERE length(dataset_id) > 0)\n"
    "SELECT key, dataset_id FROM q WHERE NOT EXISTS (SELECT 1 FROM d WHERE starts_with(d.ds, q.dataset_id))",
)
def q_spec_unmatched(spark, sf_dir):
    """R2 errors: specs whose dataset id matches no catalog entry."""
    register(spark, sf_dir, "supplier")
    specs = spark.sql(fixtures.specs()).where(F.length("dataset_id") > 0).select("key", "dataset_id")
    entries = cat.catalog_entries(derived.catalog_docs(spark, sf_dir))
    return cat.unmatched_specs(specs, cat.match_specs(specs, entries))


@query(
    "catalog_statuses",
    _CSV + f",\nq AS ({fixtures.year_requests()}),\n" + _MATCH + ",\n"
    "mm AS (SELECT * FROM m WHERE rn = 1),\n"
    "av AS (SELECT mm.key, array_to_string(list_sort(list_distinct(list(c.year))), ',') AS available "
    "FROM mm JOIN c ON c.ds = mm.ds GROUP BY mm.key),\n"
    "h AS (SELECT mm.key, arg_max(c.url, c.p_partkey) AS url FROM mm JOIN c ON c.ds = mm.ds AND c.year = mm.year GROUP BY mm.key)\n"
    f"SELECT q.key, q.dataset_id, CASE WHEN mm.key IS NOT NULL THEN {_IDENT} END AS identifier, CASE WHEN h.key IS NOT NULL THEN q.year END AS year, h.url, "
    "coalesce(av.available, '') AS available, CASE WHEN mm.key IS NULL THEN 'dataset_not_found' WHEN av.key IS NULL THEN 'no_csv' "
    "WHEN h.key IS NULL THEN 'year_missing' ELSE 'ok' END AS status "
    "FROM q LEFT JOIN mm ON mm.key = q.key LEFT JOIN av ON av.key = q.key LEFT JOIN h ON h.key = q.key",
)
def q_catalog_statuses(spark, sf_dir):
    """One row per requested dataset and year: the CSV, or the first step that fails."""
    register(spark, sf_dir, "nation")
    return res.catalog_statuses(spark.sql(fixtures.year_requests()), derived.catalog_docs(spark, sf_dir))


@query(
    "metastore_statuses",
    _DISTS + "u AS (SELECT ds, arg_min(url, p_partkey) AS url FROM d WHERE ds_num % 9 <> 4 AND length(url) > 0 GROUP BY ds),\n"
    "z AS (SELECT ds, arg_min(url, p_partkey) AS url FROM d WHERE ds_num % 9 <> 4 AND length(url) > 0 AND "
    "(coalesce(lower(format) = 'zip', false) OR coalesce(contains(lower(media_type), 'zip'), false)) GROUP BY ds)\n"
    "SELECT a.ds AS dataset_id, u.url AS csv_url, CASE WHEN u.url IS NULL THEN 'no_url' ELSE 'ok' END AS csv_status, "
    "z.url AS zip_url, CASE WHEN z.url IS NULL THEN 'no_zip' ELSE 'ok' END AS zip_status "
    "FROM (SELECT DISTINCT ds FROM d) a LEFT JOIN u ON u.ds = a.ds LEFT JOIN z ON z.ds = a.ds",
)
def q_metastore_statuses(spark, sf_dir):
    """One row per metastore document: its first URL and first ZIP, or why there is none."""
    return res.metastore_statuses(derived.metastore_docs(spark, sf_dir)).drop("live_id", "live_status")


# the rules of V1 written out: what each source needs and forbids
_VALID = (
    "CASE source WHEN 'healthcare_gov' THEN coalesce(path, '') <> '' AND dataset_id IS NULL AND year IS NULL "
    "WHEN 'dkan_data_api_bulk' THEN coalesce(dataset_id, '') <> '' AND path IS NULL WHEN 'ftp_mirror' THEN false "
    "ELSE coalesce(dataset_id, '') <> '' AND path IS NULL AND year IS NULL END"
)


@query(
    "load_resolution",
    _CSV + f",\ns AS (SELECT *, {_VALID} AS good FROM ({fixtures.specs()}) x),\n"
    "q AS (SELECT key, dataset_id, year FROM s WHERE good AND source = 'dkan_data_api_bulk'),\n" + _MATCH + ",\n"
    "mm AS (SELECT * FROM m WHERE rn = 1),\n"
    "h AS (SELECT mm.key, arg_max(c.url, CAST(c.year AS BIGINT) * 10000000 + c.p_partkey) AS url, arg_max(c.year, CAST(c.year AS BIGINT) * 10000000 + c.p_partkey) AS year "
    "FROM mm JOIN c ON c.ds = mm.ds AND (mm.year IS NULL OR c.year = mm.year) GROUP BY mm.key),\n"
    "av AS (SELECT DISTINCT mm.key FROM mm JOIN c ON c.ds = mm.ds),\n"
    "u AS (SELECT ds, arg_min(url, p_partkey) AS url FROM d WHERE ds_num % 9 <> 4 AND length(url) > 0 GROUP BY ds),\n"
    "z AS (SELECT ds, arg_min(url, p_partkey) AS url FROM d WHERE ds_num % 9 <> 4 AND length(url) > 0 AND "
    "(coalesce(lower(format) = 'zip', false) OR coalesce(contains(lower(media_type), 'zip'), false)) GROUP BY ds),\n"
    "l AS (SELECT ds, ds_num, min(p_partkey) AS p FROM d GROUP BY ds, ds_num)\n"
    "SELECT s.key, CASE WHEN NOT good THEN 'invalid' WHEN source = 'dkan_data_api_bulk' THEN CASE WHEN mm.key IS NULL THEN 'dataset_not_found' "
    "WHEN av.key IS NULL THEN 'no_csv' WHEN h.key IS NULL THEN 'year_missing' ELSE 'ok' END "
    "WHEN source IN ('socrata', 'healthcare_gov') THEN 'ok' WHEN l.ds IS NULL THEN 'metastore_missing' "
    "WHEN source = 'dkan_provider_data' THEN CASE l.ds_num % 9 WHEN 4 THEN 'no_distributions' WHEN 5 THEN 'first_not_object' "
    "WHEN 6 THEN 'identifier_missing' ELSE 'ok' END WHEN source = 'dkan_healthcare_gov_zip' THEN CASE WHEN z.url IS NULL THEN 'no_zip' ELSE 'ok' END "
    "WHEN u.url IS NULL THEN 'no_url' ELSE 'ok' END AS status, "
    "CASE WHEN NOT good THEN NULL WHEN source = 'socrata' THEN concat('https://', coalesce(domain, 'data.cms.gov'), '/resource/', s.dataset_id, '.json') "
    "WHEN source = 'healthcare_gov' THEN concat('https://www.healthcare.gov', s.path) WHEN source = 'dkan_data_api_bulk' THEN h.url "
    "WHEN source = 'dkan_provider_data' THEN CASE WHEN l.ds_num % 9 NOT IN (4, 5, 6) THEN "
    "concat('https://data.cms.gov/provider-data/api/1/metastore/schemas/dataset/items/', s.dataset_id) END "
    "WHEN source = 'dkan_healthcare_gov_zip' THEN z.url ELSE u.url END AS url, "
    "CASE WHEN good AND source = 'dkan_provider_data' AND l.ds_num % 9 NOT IN (4, 5, 6) THEN concat('dist-', CAST(l.p AS VARCHAR)) END AS live_id, "
    "h.year FROM s LEFT JOIN mm ON mm.key = s.key LEFT JOIN h ON h.key = s.key LEFT JOIN av ON av.key = s.key "
    "LEFT JOIN l ON l.ds = s.dataset_id LEFT JOIN u ON u.ds = s.dataset_id LEFT JOIN z ON z.ds = s.dataset_id",
)
def q_load_resolution(spark, sf_dir):
    """K6: every spec resolved to its address in one job, with a status each."""
    register(spark, sf_dir, "supplier")
    found = res.resolve(spark.sql(fixtures.specs()), derived.catalog_docs(spark, sf_dir), derived.metastore_docs(spark, sf_dir))
    return found.select("key", "status", "url", "live_id", "year")
