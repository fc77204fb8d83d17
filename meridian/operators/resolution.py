"""Resolution of dataset specs to what they load (R1 R2 R5 R6 R7 R8, K6), with a status for each.

Nothing vanishes: every requested dataset gives one row that holds the resolved value or the
first step that failed. The steps are ordered, and the state of all of them comes out of the same
aggregate as the value, so a status costs no further join or scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.variants import is_object, json_kind, str_member
from meridian.operators import catalog as cat
from meridian.operators import specs as sp

# Status codes, in the order in which the steps can fail.
OK = "ok"
ID_MISSING = "dataset_id_missing"
NOT_FOUND, NO_CSV, YEAR_MISSING = "dataset_not_found", "no_csv", "year_missing"  # after the shape errors of R1
NO_METASTORE, NOT_LIST, NO_URL, NO_ZIP = "metastore_missing", "distribution_not_list", "no_url", "no_zip"


def catalog_statuses(specs: DataFrame, catalog_docs: DataFrame) -> DataFrame:
    """R1+R2+R5: ``key, dataset_id, identifier, year, url, available, status`` of every spec
    ``(key, dataset_id, year)``; ``year`` is the resolved one, ``available`` lists all years with a CSV.

    Documents are read in ``doc_seq`` order: one of the wrong shape fails the specs that no earlier document matches.
    """
    entries = cat.catalog_entries(catalog_docs)
    matched = cat.match_specs(specs.where(F.length("dataset_id") > 0), entries)
    csv = cat.csv_distributions(cat.distributions(entries, ["doc_seq", "pos"])).select("doc_seq", "pos", "dpos", "year", "url")
    broken = cat.catalog_errors(catalog_docs).agg(F.min(F.struct("doc_seq", "error")).alias("e")).first()["e"]
    asked = specs.select("key", "dataset_id", F.col("year").alias("_asked"))
    rows = asked.join(matched, ["key", "dataset_id"], "left").join(csv, ["doc_seq", "pos"], "left")
    fits = F.col("year").isNotNull() & (F.col("_asked").isNull() | (F.col("year") == F.col("_asked")))
    found = rows.groupBy("key", "dataset_id", "_asked").agg(
        F.first("doc_seq").alias("_doc"), F.first("identifier").alias("identifier"),
        F.max_by(F.when(fits, F.struct("year", "url")), F.when(fits, F.struct("year", "dpos"))).alias("_best"),
        F.sort_array(F.collect_set("year")).alias("_years"))
    status = F.when(F.coalesce(F.length("dataset_id"), F.lit(0)) == 0, ID_MISSING)
    if broken is not None:
        status = status.when(F.col("_doc").isNull() | (F.col("_doc") > broken.doc_seq), broken.error)
    status = (status.when(F.col("_doc").isNull(), NOT_FOUND).when(F.size("_years") == 0, NO_CSV)
              .when(F.col("_best").isNull(), YEAR_MISSING).otherwise(OK))
    found = found.withColumn("status", status)
    ok = F.col("status") == OK
    return found.select("key", "dataset_id", "identifier", F.when(ok, F.col("_best.year")).alias("year"),
                        F.when(ok, F.col("_best.url")).alias("url"),
                        F.array_join(F.transform("_years", lambda y: y.cast("string")), ",").alias("available"), "status")


def metastore_statuses(metastore: DataFrame) -> DataFrame:
    """R6+R7+R8: one row per metastore document ``(dataset_id, body)``: the first distribution with a URL, the
    first ZIP with a URL and the live id, each with its status. No shuffle: a document's list is searched in place."""
    docs = metastore.select("dataset_id", "body", F.try_parse_json("body").alias("_v"))
    docs = docs.select("dataset_id", "_v", json_kind(F.col("body"), F.col("_v")).alias("_kind"),
                       F.try_variant_get("_v", "$.distribution", "variant").alias("_d"),
                       F.try_variant_get("_v", "$.distribution", "array<variant>").alias("_list"))
    docs = docs.select("dataset_id", "_kind", "_d", "_list", F.transform(F.filter("_list", is_object), lambda d: F.struct(
        str_member(d, "downloadURL").alias("url"), str_member(d, "mediaType").alias("media"), str_member(d, "format").alias("format"))).alias("_all"))
    docs = docs.select("dataset_id", "_kind", "_d", "_list", F.filter("_all", lambda d: F.length(d["url"]) > 0).alias("_urls"))
    shape = F.when(F.coalesce(F.col("_kind") != "object", F.lit(True)), cat.NOT_OBJECT).when(
        F.col("_d").isNotNull() & F.col("_list").isNull(), NOT_LIST)
    zips = F.filter("_urls", lambda d: cat.is_zip(d["media"], d["format"]))
    found = docs.select("dataset_id", shape.alias("_shape"), F.get(F.col("_urls"), 0)["url"].alias("csv_url"), F.get(zips, 0)["url"].alias("zip_url"))

    def status(url: str, missing: str) -> Column:
        return F.coalesce("_shape", F.when(F.col(url).isNull(), missing).otherwise(OK))

    found = found.select("dataset_id", "csv_url", status("csv_url", NO_URL).alias("csv_status"),
                         "zip_url", status("zip_url", NO_ZIP).alias("zip_status"))
    live = cat.live_ids(metastore).select("dataset_id", "live_id", F.col("status").alias("live_status"))
    return found.join(live, "dataset_id")


def resolve(specs: DataFrame, catalog_docs: DataFrame, metastore: DataFrame, only: tuple[str, ...] | None = None,
            prefix: str = sp.ASSET_PREFIX) -> DataFrame:
    """K6: every spec with what it loads: ``pos, key, asset_name, group_name, description, source, loader, url, live_id,
    year, status, detail``.

    ``status``: ``invalid`` (it breaks V1 or V2; ``detail`` lists the rules), ``unrouted`` (no reader handles its
    source), the first resolution step that failed, or ``ok``.
    """
    broken = sp.rule_violations(specs).groupBy("key").agg(
        F.array_join(F.sort_array(F.collect_set(F.concat_ws(" ", "kind", "field"))), ", ").alias("_broken"))
    checked = specs.join(broken, "key", "left").select(specs["*"], "_broken")
    good = checked.where("_broken is null").drop("_broken")
    routed = sp.load_plan(good, prefix) if only is None else sp.load_plan(good.where(F.col("source").isin(*only)), prefix)
    by_catalog = catalog_statuses(good.where("source = 'dkan_data_api_bulk'").select("key", "dataset_id", "year"), catalog_docs).select(
        "key", F.col("url").alias("_c_url"), F.col("year").alias("_c_year"), F.col("status").alias("_c_status"), "available")
    by_store = metastore_statuses(metastore)
    rows = (checked.select("pos", "key", "source", "group_name", "description", "dataset_id", "_broken")
            .join(routed.select(F.col("pos"), "key", "asset_name", "loader", "entry_url"), ["pos", "key"], "left")
            .join(by_catalog, "key", "left").join(by_store, "dataset_id", "left"))

    def stored(name: str) -> Column:
        return F.coalesce(f"{name}_status", F.lit(NO_METASTORE))

    source = F.col("source")
    bulk, zipped, live, listed = (source.isin("dkan_medicaid_bulk", "dkan_open_payments_bulk"), source == "dkan_healthcare_gov_zip",
                                  source == "dkan_provider_data", source == "dkan_data_api_bulk")
    status = (F.when(F.col("_broken").isNotNull(), "invalid").when(F.col("loader").isNull(), "unrouted")
              .when(listed, F.col("_c_status")).when(bulk, stored("csv")).when(zipped, stored("zip")).when(live, stored("live")).otherwise(OK))
    url = F.when(listed, F.col("_c_url")).when(bulk, F.col("csv_url")).when(zipped, F.col("zip_url")).otherwise(F.col("entry_url"))
    detail = F.when(F.col("status") == "invalid", F.col("_broken")).when(
        F.col("status") == YEAR_MISSING, F.concat(F.lit("available: "), "available"))
    ok = F.col("status") == OK
    rows = rows.withColumn("status", status).withColumn("url", F.when(ok, url))
    return rows.select("pos", "key", F.concat(F.lit(prefix), "key").alias("asset_name"), "group_name", "description", "source", "loader",
                       "url", F.when(ok & live, F.col("live_id")).alias("live_id"), F.col("_c_year").alias("year"), "status", detail.alias("detail"))
