"""Distribution resolution over stored catalog documents.

Catalog documents (DCAT ``{"dataset": [...]}``) and per-dataset metastore documents
are VARIANT-parsed and exploded with their array positions, because "first" and
"last" in the original readers mean array order. Every resolution is an aggregate
(``min_by`` / ``max_by``), so all datasets resolve in one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.joins import measured
from meridian.functions.text import year_prefix
from meridian.functions.variants import is_object as _is_obj
from meridian.functions.variants import json_kind, str_member

# Fixed values used by the resolvers.
CSV_MEDIA_TYPE = "text/csv"
DATASET_ID_NEEDLE = "/data-api/v1/dataset/"

# Live-id status codes.
LIVE_OK = "ok"
NO_DISTRIBUTIONS = "no_distributions"
FIRST_NOT_OBJECT = "first_not_object"
IDENTIFIER_MISSING = "identifier_missing"
NOT_OBJECT = "metastore_not_object"


def _array_member(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$['{name}']", "array<variant>")


def catalog_entries(catalog_docs: DataFrame) -> DataFrame:
    """``(doc_seq, pos, identifier, entry)`` per object entry of ``dataset``; catalog order
    is ``(doc_seq, pos)``. Non-object entries are skipped; a missing ``dataset`` is empty.
    Shape errors go to ``catalog_errors``.
    """
    docs = catalog_docs.select("doc_seq", "body", F.try_parse_json(F.col("body")).alias("_v"))
    arr = F.coalesce(_array_member(F.col("_v"), "dataset"), F.array().cast("array<variant>"))
    is_doc = json_kind(F.col("body"), F.col("_v")) == "object"
    ex = docs.where(is_doc).select("doc_seq", F.posexplode(arr).alias("pos", "entry"))
    return ex.where(_is_obj(F.col("entry"))).select(
        "doc_seq", "pos", str_member(F.col("entry"), "identifier").alias("identifier"), "entry")


def catalog_errors(catalog_docs: DataFrame) -> DataFrame:
    """R1 errors: payload not an object, or ``dataset`` present but not a list."""
    docs = catalog_docs.select("doc_seq", "body", F.try_parse_json(F.col("body")).alias("_v"))
    v = F.col("_v")
    is_doc = F.coalesce(json_kind(F.col("body"), v) == "object", F.lit(False))
    not_list = (_array_member(v, "dataset").isNull()
                & F.try_variant_get(v, "$.dataset", "variant").isNotNull())
    err = (F.when(~is_doc, F.lit("catalog_not_object"))
           .when(not_list, F.lit("dataset_not_list")))
    return docs.select("doc_seq", err.alias("error")).where(F.col("error").isNotNull())


def distributions(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Object entries of ``distribution`` with their position ``dpos`` (non-objects skipped)."""
    arr = F.coalesce(_array_member(F.col("entry"), "distribution"), F.array().cast("array<variant>"))
    ex = entries.select(*keys, F.posexplode(arr).alias("dpos", "dist"))
    d = F.col("dist")
    return ex.where(_is_obj(d)).select(
        *keys, "dpos",
        str_member(d, "mediaType").alias("media_type"),
        str_member(d, "format").alias("format"),
        str_member(d, "downloadURL").alias("url"),
        str_member(d, "temporal").alias("temporal"),
    )


def csv_distributions(dists: DataFrame) -> DataFrame:
    """R3+R4: exact CSV media type, non-empty URL, temporal starting with a 4-digit year."""
    return (dists.withColumn("year", year_prefix(F.col("temporal")))
            .where((F.col("media_type") == CSV_MEDIA_TYPE) & (F.length("url") > 0) & F.col("year").isNotNull()))


def latest_csv(csv: DataFrame, keys: list[str]) -> DataFrame:
    """R5 (no year): newest year; among duplicate years the last in catalog order wins."""
    best = F.max_by(F.struct("year", "url"), F.struct("year", "dpos"))
    return csv.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.year", "_b.url")


def csv_for_year(csv: DataFrame, requests: DataFrame, keys: list[str]) -> DataFrame:
    """R5 (explicit year): ``requests`` has ``keys`` + ``year``; last match in catalog order."""
    hit = csv.join(requests, [*keys, "year"], "left_semi")
    return hit.groupBy(*keys, "year").agg(F.max_by("url", "dpos").alias("url"))


def missing_years(csv: DataFrame, requests: DataFrame, keys: list[str]) -> DataFrame:
    """R5 errors: requested years with no CSV, listing the sorted available years."""
    avail = csv.groupBy(*keys).agg(F.sort_array(F.collect_set("year")).alias("available"))
    missing = requests.join(csv.select(*keys, "year").distinct(), [*keys, "year"], "left_anti")
    return missing.join(avail, keys, "left").select(
        *keys, "year", F.coalesce(F.concat_ws(",", F.transform("available", lambda y: y.cast("string"))),
                                  F.lit("")).alias("available"))


def is_zip(media_type: Column, fmt: Column) -> Column:
    """``lower(format) = 'zip'`` or ``lower(mediaType)`` contains ``zip`` (non-strings are NULL)."""
    return F.coalesce(F.lower(fmt) == "zip", F.lit(False)) | F.coalesce(F.lower(media_type).contains("zip"), F.lit(False))


def metastore_distributions(metastore: DataFrame) -> DataFrame:
    """Bare metastore documents ``(dataset_id, body)`` -> object distributions with ``dpos``."""
    docs = metastore.select("dataset_id", "body", F.try_parse_json(F.col("body")).alias("entry"))
    entries = docs.where(json_kind(F.col("body"), F.col("entry")) == "object").select("dataset_id", "entry")
    return distributions(entries, ["dataset_id"])


def first_url(metastore: DataFrame) -> DataFrame:
    """First distribution with a non-empty string URL, format ignored."""
    d = metastore_distributions(metastore).where(F.length("url") > 0)
    return d.groupBy("dataset_id").agg(F.min_by("url", "dpos").alias("url"))


def first_zip(metastore: DataFrame) -> DataFrame:
    """First ZIP distribution (R9) with a non-empty string URL."""
    d = metastore_distributions(metastore).where((F.length("url") > 0) & is_zip(F.col("media_type"), F.col("format")))
    return d.groupBy("dataset_id").agg(F.min_by("url", "dpos").alias("url"))


def live_ids(metastore: DataFrame) -> DataFrame:
    """``distribution[0].identifier`` with a status per dataset (no exceptions, one row each).

    Intermediate values are staged as columns so each is computed once per row (a single
    nested expression would re-expand the parse for every reference).
    """
    v = metastore.select("dataset_id", "body", F.try_parse_json(F.col("body")).alias("_v"))
    v = v.select("dataset_id", "_v", json_kind(F.col("body"), F.col("_v")).alias("_kind"),
                 F.try_variant_get(F.col("_v"), "$.distribution", "array<variant>").alias("_arr"))
    v = v.select("dataset_id", "_kind", "_arr", F.try_element_at(F.col("_arr"), F.lit(1)).alias("_first"))
    v = v.select("dataset_id", "_kind", "_arr", "_first", str_member(F.col("_first"), "identifier").alias("_ident"))
    arr, first, ident = F.col("_arr"), F.col("_first"), F.col("_ident")
    status = (F.when(F.coalesce(F.col("_kind") != "object", F.lit(True)), F.lit(NOT_OBJECT))
              .when(arr.isNull() | (F.size(arr) == 0), F.lit(NO_DISTRIBUTIONS))
              .when(~_is_obj(first), F.lit(FIRST_NOT_OBJECT))
              .when(ident.isNull() | (ident == ""), F.lit(IDENTIFIER_MISSING))
              .otherwise(F.lit(LIVE_OK)))
    out = v.select("dataset_id", "_ident", status.alias("status"))
    return out.select("dataset_id", F.when(F.col("status") == LIVE_OK, F.col("_ident")).alias("live_id"), "status")


def match_specs(specs: DataFrame, entries: DataFrame) -> DataFrame:
    """R2: each spec's first catalog entry whose identifier contains
    ``/data-api/v1/dataset/<dataset_id>`` (substring, so an id that is a prefix of
    another also matches).

    Exact and without a theta join: a needle matches exactly when ``dataset_id``
    equals a prefix of the text after some occurrence of the marker, so each entry
    emits the prefixes of that text whose length some spec id has, and the match is an
    equi-join on them. Entries are reduced to the first one of each id that is asked for before
    specs meet them, so that rows grow with entries and specs, not with their product.
    """
    lengths = sorted(r.n for r in specs.select(F.length("dataset_id").alias("n")).where("n > 0").distinct().collect())
    wanted = F.array(*(F.lit(n) for n in lengths)).cast("array<int>")
    _parts = F.split(F.col("identifier"), DATASET_ID_NEEDLE)
    segs = F.slice(_parts, F.lit(2), F.size(_parts))
    per_seg = entries.where(F.col("identifier").contains(DATASET_ID_NEEDLE)).select(
        "doc_seq", "pos", "identifier", F.explode(segs).alias("_tail"))
    prefixes = per_seg.select(
        "doc_seq", "pos", "identifier",
        F.explode(F.transform(F.filter(wanted, lambda n: n <= F.length("_tail")),
                              lambda n: F.substring(F.col("_tail"), F.lit(1), n))).alias("dataset_id"),
    )
    asked = measured(specs.select("dataset_id").distinct(), "spec-ids")
    first = F.min_by(F.struct("doc_seq", "pos", "identifier"), F.struct("doc_seq", "pos"))
    found = measured(prefixes.join(asked, "dataset_id", "left_semi").groupBy("dataset_id").agg(first.alias("_m")), "spec-entries")
    return specs.select("key", "dataset_id").distinct().join(found, "dataset_id").select(
        "key", "dataset_id", F.col("_m.doc_seq").alias("doc_seq"), F.col("_m.pos").alias("pos"),
        F.col("_m.identifier").alias("identifier"))


def unmatched_specs(specs: DataFrame, matched: DataFrame) -> DataFrame:
    """R2 errors: specs whose id matches no catalog entry (``key, dataset_id``)."""
    return specs.select("key", "dataset_id").join(matched.select("key"), "key", "left_anti")
