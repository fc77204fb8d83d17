"""Paged and static response scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.joins import measured
from meridian.functions.ranking import first_n
from meridian.functions.text import path_stem
from meridian.operators import catalog as cat
from meridian.operators import pages as pg
from meridian.operators import records as rec
from meridian.plans import derived
from meridian.plans.registry import query
from meridian.sources.tables import table


def _event_cols(df: DataFrame) -> DataFrame:
    r = F.col("record")
    return df.select(
        F.col("dataset").alias("event_type"),
        F.col("offset").alias("page_offset"),
        F.variant_get(r, "$.event_id", "bigint").alias("event_id"),
        F.variant_get(r, "$.user_id", "bigint").alias("user_id"),
    )


_RANKED = (
    "WITH r AS (SELECT event_id, event_type, user_id, value, props, "
    "row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS rk FROM events)"
)
_TRUNCATED = (
    _RANKED + ",\np AS (SELECT event_type, CAST(floor(rk / 50) AS BIGINT) * 50 AS page_offset, event_id, user_id, "
    "value, props FROM r WHERE event_id % 97 <> 0),\n"
    "n AS (SELECT event_type, page_offset, count(*) AS n FROM p GROUP BY event_type, page_offset),\n"
    "s AS (SELECT event_type, min(page_offset) AS stop_at FROM n WHERE n < 50 GROUP BY event_type),\n"
    "kept AS (SELECT p.* FROM p LEFT JOIN s ON p.event_type = s.event_type "
    "WHERE s.stop_at IS NULL OR p.page_offset <= s.stop_at)\n"
)


@query("pages_truncate", _TRUNCATED + "SELECT event_type, page_offset, event_id, user_id FROM kept")
def q_pages_truncate(spark, sf_dir):
    pages = derived.event_pages(spark, sf_dir, batch=50, drop_every=97).select("dataset", "offset", "body")
    return _event_cols(pg.read_paged(pages, "array", batch=50))


_CAPPED = (
    _RANKED + ",\nc AS (SELECT event_type, event_id FROM r WHERE rk < 1200)\n"
)


@query("pages_cap", _CAPPED + "SELECT event_type, event_id FROM c")
def q_pages_cap(spark, sf_dir):
    pages = derived.event_pages(spark, sf_dir, batch=200, drop_every=None).select("dataset", "offset", "body")
    out = _event_cols(pg.read_paged(pages, "array", batch=200, max_skip=1000))
    return out.select("event_type", "event_id")


@query("sweep_counts", _CAPPED + "SELECT event_type, count(*) AS n_rows FROM c GROUP BY event_type")
def q_sweep_counts(spark, sf_dir):
    """Per-scan row counts of a capped sweep (one aggregate over the flattened rows)."""
    return q_pages_cap(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "page_holes",
    _RANKED + ",\np AS (SELECT DISTINCT event_type, CAST(floor(rk / 50) AS BIGINT) AS pg FROM r),\n"
    "present AS (SELECT event_type, pg FROM p WHERE pg % 13 <> 7),\n"
    "lst AS (SELECT event_type, max(pg) AS last_pg FROM present GROUP BY event_type),\n"
    "ex AS (SELECT event_type, unnest(generate_series(0, last_pg)) AS pg FROM lst)\n"
    "SELECT ex.event_type, ex.pg * 50 AS missing_offset FROM ex WHERE NOT EXISTS "
    "(SELECT 1 FROM present q WHERE q.event_type = ex.event_type AND q.pg = ex.pg)",
)
def q_page_holes(spark, sf_dir):
    pages = derived.event_pages(spark, sf_dir, batch=50, drop_every=None, hole_every=13)
    return pg.page_holes(pages, batch=50).select(F.col("dataset").alias("event_type"), "missing_offset")


@query(
    "page_sequence_errors",
    "WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),\n"
    "e AS (SELECT event_type, CAST(floor((n - 1) / 50) AS BIGINT) AS last_pg, n FROM c)\n"
    "SELECT event_type, CASE WHEN last_pg > 7 THEN 'page_missing' ELSE 'unterminated' END AS sequence_error, "
    "CASE WHEN last_pg >= 7 THEN 350 ELSE n END AS error_at FROM e WHERE last_pg >= 7 OR n % 50 = 0",
)
def q_page_sequence_errors(spark, sf_dir):
    """Datasets whose stored pages have a hole or no end, as a report instead of a failed read."""
    pages = derived.event_pages(spark, sf_dir, batch=50, drop_every=None, hole_every=13)
    return pg.sequence_errors(pages, "array", batch=50).withColumnRenamed("dataset", "event_type")


@query(
    "socrata_dataset",
    "SELECT event_type, event_id, user_id, value, props FROM events",
)
def q_socrata_dataset(spark, sf_dir):
    """I2 end to end: bare-array pages -> validate -> truncate -> flatten -> inferred table."""
    pages = derived.event_pages(spark, sf_dir, batch=50, drop_every=None).select("dataset", "offset", "body")
    records = pg.read_paged(pages, "array", batch=50)
    table = rec.to_table(records, "record")
    return table.select("event_type", "event_id", "user_id", "value", "props")


def _conv_docs(spark, sf_dir):
    docs = derived.conversation_pack(spark, sf_dir)
    return docs.select(F.col("path").alias("dataset"), F.lit(0).cast("bigint").alias("offset"), "body",
                       "conv_id", "chunk", "path")


@query(
    "envelope_rows",
    "SELECT conv_id, turn, role FROM conversations WHERE conv_id % 50 <> 0",
)
def q_envelope_rows(spark, sf_dir):
    """Static documents, bare or wrapped under the path stem; junk dropped."""
    parsed = pg.parse_pages(_conv_docs(spark, sf_dir), "static", stem=path_stem(F.col("path")))
    good = parsed.where(F.col("page_error").isNull())
    flat = pg.flatten(good, keep=["conv_id"])
    r = F.col("record")
    return flat.select("conv_id", F.variant_get(r, "$.turn", "bigint").alias("turn"),
                       F.variant_get(r, "$.role", "string").alias("role"))


_DOCS = "WITH d AS (SELECT DISTINCT conv_id, CAST(floor(turn / 8) AS BIGINT) AS chunk FROM conversations)\n"


@query(
    "strict_page_errors",
    _DOCS + "SELECT * FROM (\n"
    "SELECT 'array' AS envelope, conv_id, chunk, CASE WHEN conv_id % 50 = 0 OR conv_id % 2 = 1 "
    "THEN 'page_not_array' WHEN conv_id % 5 = 0 THEN 'row_not_object' END AS page_error FROM d\n"
    "UNION ALL SELECT 'results', conv_id, chunk, CASE WHEN conv_id % 2 = 0 AND conv_id % 50 <> 0 "
    "THEN 'page_not_object' END FROM d\n"
    "UNION ALL SELECT 'static', conv_id, chunk, CASE WHEN conv_id % 50 = 0 THEN 'inner_not_list' END FROM d\n"
    ") x WHERE page_error IS NOT NULL",
)
def q_strict_page_errors(spark, sf_dir):
    """Page-shape violations per envelope, as a report instead of an exception."""
    docs = _conv_docs(spark, sf_dir)
    out = None
    for env in ("array", "results", "static"):
        stem = path_stem(F.col("path")) if env == "static" else None
        bad = pg.parse_pages(docs, env, stem).where(F.col("page_error").isNotNull())
        part = bad.select(F.lit(env).alias("envelope"), "conv_id", "chunk", "page_error")
        out = part if out is None else out.unionByName(part)
    return out


@query("dkan_dataset", _RANKED + " SELECT event_type, CAST(floor(rk / 50) AS BIGINT) * 50 AS page_offset, event_id, user_id FROM r")
def q_dkan_dataset(spark, sf_dir):
    """Resolve each dataset's live distribution (R7), then page its datastore."""
    meta, pages = derived.datastore_fixture(spark, sf_dir)
    live = cat.live_ids(meta).where(F.col("status") == cat.LIVE_OK)
    mine = pages.join(measured(live.select(F.col("live_id").alias("dataset"), "dataset_id"), "live-ids"), "dataset")
    flat = pg.read_paged(mine, "results", batch=50, keep=["dataset_id"])
    return _event_cols(flat.drop("dataset").withColumnRenamed("dataset_id", "dataset"))


@query("cap_rows", _CAPPED + "SELECT event_type, event_id FROM c")
def q_cap_rows(spark, sf_dir):
    """P2 in row form: the first 1,200 events per event_type by id (salted two-stage top-n)."""
    ev = table(spark, sf_dir, "events").select("event_type", "event_id")
    return first_n(ev, ["event_type"], ["event_id"], 1200).select("event_type", "event_id")
