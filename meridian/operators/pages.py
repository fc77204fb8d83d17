"""Stored response pages as DataFrames: validate (V3-V6, F8, F9), truncate (P1, P2),
find holes (P5), unwrap envelopes (D2) and flatten to records (D1).

A pages frame has one row per stored response: ``dataset`` (which scan), ``offset``
(the page's first row), ``body`` (JSON text). Pages are the unit of parallelism; all
per-dataset decisions are aggregates over pages (one row per page, map-side combined),
never windows over exploded records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.joins import measured
from meridian.functions.variants import json_kind

# Envelopes: "array" = bare JSON array of objects (paged catalog API, strict);
# "results" = object whose "results" member (default empty) is an array of objects
# (datastore and provider search APIs, strict); "static" = bare array, or object whose
# member named after the path stem is the array (missing -> empty); non-objects dropped.
ENVELOPES = ("array", "results", "static")

# Page-level error kinds reported by validation.
MALFORMED = "malformed_json"
PAGE_NOT_ARRAY = "page_not_array"
PAGE_NOT_OBJECT = "page_not_object"
RESULTS_NOT_LIST = "results_not_list"
ROW_NOT_OBJECT = "row_not_object"
INNER_NOT_LIST = "inner_not_list"
NOT_LIST_OR_OBJECT = "payload_not_list_or_object"

# Sequence-level error kinds (a strict read fails on them).
OFF_GRID = "off_grid_page"
PAGE_MISSING = "page_missing"
UNTERMINATED = "unterminated"


def _as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _any_non_object(arr: Column) -> Column:
    return F.exists(arr, lambda x: ~F.startswith(F.schema_of_variant(x), F.lit("OBJECT")))


def _only_objects(arr: Column) -> Column:
    return F.filter(arr, lambda x: F.startswith(F.schema_of_variant(x), F.lit("OBJECT")))


def parse_pages(pages: DataFrame, envelope: str, stem: Column | None = None) -> DataFrame:
    """Adds ``rows`` (array<variant> of records), ``n`` (record count) and ``page_error``.

    ``stem`` is the envelope key for the "static" envelope (E8, path stem). Values are
    staged as columns (parse once, extract the record array once); the page's JSON kind
    comes from its first non-blank character, which is exact for valid JSON and avoids
    walking the whole page for its type. Member checks only run on the error path.
    """
    if envelope not in ENVELOPES:
        raise ValueError(f"unknown envelope {envelope!r}")
    cols = pages.columns
    df = pages.select(*cols, F.try_parse_json(F.col("body")).alias("_v"))
    kind = json_kind(F.col("body"), F.col("_v"))
    extra = []
    if envelope == "static":
        if stem is None:
            raise ValueError("the static envelope needs the stem column")
        extra = [F.concat(F.lit("$['"), stem, F.lit("']")).alias("_path")]
    df = df.select(*cols, "_v", kind.alias("_kind"), *extra)
    v, k = F.col("_v"), F.col("_kind")
    if envelope == "array":
        df = df.select(*cols, "_v", "_kind", F.when(k == "array", _as_array(v)).alias("_arr"))
        arr = F.col("_arr")
        err = (F.when(v.isNull(), F.lit(MALFORMED))
               .when(k != "array", F.lit(PAGE_NOT_ARRAY))
               .when(_any_non_object(arr), F.lit(ROW_NOT_OBJECT)))
        rows = arr
    elif envelope == "results":
        df = df.select(*cols, "_v", "_kind",
                       F.when(k == "object", F.try_variant_get(v, "$.results", "array<variant>")).alias("_arr"))
        arr = F.col("_arr")
        present = F.try_variant_get(v, "$.results", "variant").isNotNull()
        err = (F.when(v.isNull(), F.lit(MALFORMED))
               .when(k != "object", F.lit(PAGE_NOT_OBJECT))
               .when(arr.isNull() & present, F.lit(RESULTS_NOT_LIST))
               .when(_any_non_object(F.coalesce(arr, F.array().cast("array<variant>"))), F.lit(ROW_NOT_OBJECT)))
        rows = F.coalesce(arr, F.array().cast("array<variant>"))
    else:
        member = F.expr("try_variant_get(_v, _path, 'array<variant>')")
        df = df.select(*cols, "_v", "_kind", "_path",
                       F.when(k == "array", _as_array(v)).when(k == "object", member).alias("_arr"))
        arr = F.col("_arr")
        present = F.expr("try_variant_get(_v, _path, 'variant')").isNotNull()
        err = (F.when(v.isNull(), F.lit(MALFORMED))
               .when(k == "array", F.lit(None))
               .when(k != "object", F.lit(NOT_LIST_OR_OBJECT))
               .when(arr.isNull() & present, F.lit(INNER_NOT_LIST)))
        rows = _only_objects(F.coalesce(arr, F.array().cast("array<variant>")))
    out = df.select(*cols, err.cast("string").alias("page_error"), "_arr")
    out = out.select(*cols, "page_error", F.when(F.col("page_error").isNull(), rows).alias("rows"))
    return out.withColumn("n", F.size(F.col("rows")))


def validate_pages(pages: DataFrame, envelope: str, stem: Column | None = None) -> DataFrame:
    """Violations report: ``(dataset, offset, page_error)`` for every bad page."""
    return (
        parse_pages(pages, envelope, stem)
        .where(F.col("page_error").isNotNull())
        .select("dataset", "offset", "page_error")
    )


def cap_pages(pages: DataFrame, max_skip: int) -> DataFrame:
    """Only pages whose skip (offset) is at most ``max_skip`` are reachable."""
    return pages.where(F.col("offset") <= max_skip)


def first_missing(pages: DataFrame, batch: int) -> DataFrame:
    """Per dataset, the first page offset (0, b, 2b, ...) absent from the store.

    Self anti join on (dataset, offset + b): keyed by page, so no dataset-sized task.
    """
    present = pages.select("dataset", "offset").where(F.col("offset") % batch == 0).distinct()
    nxt = present.select("dataset", (F.col("offset") + batch).alias("offset"))
    gaps = nxt.join(present, ["dataset", "offset"], "left_anti")
    zero = present.groupBy("dataset").agg(F.min("offset").alias("_lo")).where(F.col("_lo") > 0)
    starts = gaps.unionByName(zero.select("dataset", F.lit(0).cast("bigint").alias("offset")))
    return starts.groupBy("dataset").agg(F.min("offset").alias("missing_at"))


def stop_bounds(summary: DataFrame, batch: int, max_skip: int | None = None) -> DataFrame:
    """Per dataset: ``stop_at`` (first short or bad page), ``missing_at`` (first absent page) and
    ``sequence_error, error_at``: a page off the grid of offsets; a page that is absent while later
    ones are stored; a sequence whose last stored page is full (its end was not stored), unless the
    cap on offsets ends it.

    ``summary`` has ``dataset, offset, n, page_error`` - one small row per page. All are
    aggregates (partial aggregation, one row per dataset), never windows over records.
    """
    on_grid = F.col("offset") % batch == 0
    short = (F.col("page_error").isNotNull()) | (F.col("n") < batch)
    stops = summary.groupBy("dataset").agg(
        F.min(F.when(on_grid & short, F.col("offset"))).alias("stop_at"),
        F.max(F.when(on_grid, F.col("offset"))).alias("_last"),
        F.min(F.when(~on_grid, F.col("offset"))).alias("_off"))
    bounds = stops.join(first_missing(summary, batch), "dataset", "left")
    ended = F.col("stop_at").isNotNull() & (F.col("missing_at").isNull() | (F.col("stop_at") < F.col("missing_at")))
    capped = F.lit(False) if max_skip is None else F.coalesce(F.col("missing_at") > max_skip, F.lit(False))
    error = (F.when(F.col("_off").isNotNull(), F.lit(OFF_GRID)).when(ended, F.lit(None))
             .when(F.col("_last") > F.col("missing_at"), F.lit(PAGE_MISSING)).when(capped, F.lit(None))
             .otherwise(F.lit(UNTERMINATED)))
    bounds = bounds.select("dataset", "stop_at", "missing_at", error.cast("string").alias("sequence_error"), "_off")
    return bounds.select("dataset", "stop_at", "missing_at", "sequence_error",
                         F.when(F.col("sequence_error").isNotNull(), F.coalesce("_off", "missing_at")).alias("error_at"))


def sequence_errors(pages: DataFrame, envelope: str, batch: int, max_skip: int | None = None) -> DataFrame:
    """Report of the datasets a strict read fails on: ``(dataset, sequence_error, error_at)``."""
    if max_skip is not None:
        pages = cap_pages(pages, max_skip)
    summary = parse_pages(pages, envelope).select("dataset", "offset", "n", "page_error")
    bounds = stop_bounds(summary, batch, max_skip)
    return bounds.where(F.col("sequence_error").isNotNull()).select("dataset", "sequence_error", "error_at")


def _kept(df: DataFrame, bounds: DataFrame, batch: int, fail: bool = False) -> DataFrame:
    """Join the per-dataset bounds back to the pages and keep those that are read. The bounds are
    one row per dataset, written first: while they are small the pages are filtered in place and
    no body is moved. ``fail`` raises when a dataset's sequence is broken."""
    keep = (F.col("offset") % batch == 0) & (F.col("stop_at").isNull() | (F.col("offset") <= F.col("stop_at"))) & (
        F.col("missing_at").isNull() | (F.col("offset") < F.col("missing_at"))
    )
    joined = df.join(measured(bounds, "page-bounds"), "dataset", "left")
    if fail:
        message = F.concat(F.lit("broken page sequence: "), F.col("sequence_error"), F.lit(" in "), F.col("dataset"),
                           F.lit(" at offset "), F.col("error_at").cast("string"))
        keep = F.when(F.col("sequence_error").isNotNull(), F.raise_error(message).cast("boolean")).otherwise(keep)
    return joined.where(keep).drop("stop_at", "missing_at", "sequence_error", "error_at")


def truncate(parsed: DataFrame, batch: int) -> DataFrame:
    """P1 on parsed pages: keep pages in offset order up to and including the first short
    (or bad) page, and before the first missing page. Later pages are never read."""
    return _kept(parsed, stop_bounds(parsed.select("dataset", "offset", "n", "page_error"), batch), batch)


def strict(kept: DataFrame) -> DataFrame:
    """a bad page that would be read fails the job, as the paged readers do."""
    msg = F.concat(F.lit("bad page: "), F.col("page_error"), F.lit(" in "), F.col("dataset"),
                   F.lit(" at offset "), F.col("offset").cast("string"))
    return kept.withColumn(
        "rows", F.when(F.col("page_error").isNull(), F.col("rows")).otherwise(F.raise_error(msg).cast("array<variant>"))
    )


def flatten(kept: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per record: ``dataset, offset, pos, record`` (+ any ``keep`` columns).

    ``posexplode_outer`` + a null filter instead of ``posexplode``: the optimizer infers a
    ``size(rows) > 0`` filter from a plain explode and may push it (and with it the strict
    page check) below the truncation join, which would fail on pages never read.
    """
    extra = keep or []
    out = kept.select("dataset", "offset", *extra, F.posexplode_outer("rows").alias("pos", "record"))
    return out.where(F.col("pos").isNotNull())


def read_paged(pages: DataFrame, envelope: str, batch: int, max_skip: int | None = None,
               mode: str = "strict", stem: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """A paged scan over stored pages: (P2) -> validate -> P1 -> strict check -> D1.

    ``strict`` fails on bad pages that would be read and on broken sequences (see
    ``stop_bounds``); the other modes read what the bounds allow.

    Bodies are parsed once for the small per-page summary (count, error) and once more
    only for the pages that survive truncation.
    """
    if max_skip is not None:
        pages = cap_pages(pages, max_skip)
    summary = parse_pages(pages, envelope, stem).select("dataset", "offset", "n", "page_error")
    bounds = stop_bounds(summary, batch, max_skip)
    kept = parse_pages(_kept(pages, bounds, batch, fail=mode == "strict"), envelope, stem)
    if mode == "strict":
        kept = strict(kept)
    elif mode == "lenient":
        kept = kept.where(F.col("page_error").isNull())
    return flatten(kept, keep)


def page_holes(pages: DataFrame, batch: int, chunk: int = 4096) -> DataFrame:
    """P5: expected offsets 0, b, 2b, ... up to each dataset's last page that are missing.

    Expected offsets are generated in chunks of at most ``chunk`` pages per row, so a
    dataset with billions of pages still spreads across tasks.
    """
    present = pages.select("dataset", "offset").where(F.col("offset") % batch == 0)
    last = present.groupBy("dataset").agg(F.expr(f"max(offset) div {batch}").alias("_last"))
    chunks = last.select("dataset", "_last", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                                   F.expr(f"_last div {chunk}"))).alias("_c"))
    lo = F.col("_c") * chunk
    hi = F.least(F.col("_last"), lo + chunk - 1)
    expected = chunks.repartition("dataset", "_c").select(
        "dataset", F.explode(F.sequence(lo, hi)).alias("_i")).select("dataset", (F.col("_i") * batch).alias("offset"))
    return expected.join(present, ["dataset", "offset"], "left_anti").withColumnRenamed("offset", "missing_offset")
