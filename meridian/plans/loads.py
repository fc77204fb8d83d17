"""Run the loads of a set of specs (K6) against a store of fetched responses.

All specs are resolved in one job (``operators/resolution.py``); what resolves is landed, several
datasets at a time, each as its own guarded run, and every spec gets a final row.

Store layout (what a fetcher leaves behind):
  ``<store>/_catalog/*.json``         catalog documents, in the order of their names
  ``<store>/_metastore/<id>.json``    metastore documents, named by dataset id
  ``<store>/<key>/pages/``            Parquet ``(dataset, offset, body)`` for paged JSON sources
  ``<store>/<key>/*.json``            static JSON documents
  ``<store>/<key>/<file>``            the resolved CSV or ZIP, named like the end of its URL
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.functions.text import path_stem
from meridian.operators import pages as pg
from meridian.operators import records as rec
from meridian.operators import resolution as res
from meridian.sinks import landing
from meridian.sources import bulk_csv, json_elements, sheets, static_json

# Page envelope and page size per paged source.
PAGED = {"socrata": ("array", 1000), "dkan_provider_data": ("results", 1000)}
RESULT = ("key string, asset_name string, status string, row_count bigint, column_count int, source_url string, message string")


def stored_documents(spark: SparkSession, store: str) -> tuple[DataFrame, DataFrame]:
    """``(doc_seq, body)`` of the catalog and ``(dataset_id, body)`` of the metastore; either may be absent."""
    found = []
    for name in ("_catalog", "_metastore"):
        pattern = f"{store.rstrip('/')}/{name}/*.json"
        fs, path = landing._fs(spark, pattern)
        docs = static_json.read_documents(spark, pattern) if fs.globStatus(path) else spark.createDataFrame([], "path string, body string")
        found.append(docs)
    # a row number over the document names only; there are a few of them
    names = found[0].select("path").withColumn("doc_seq", F.row_number().over(Window.orderBy("path")).cast("bigint"))
    return (found[0].join(names, "path").select("doc_seq", "body"),
            found[1].select(path_stem(F.col("path")).alias("dataset_id"), "body"))


def read_source(spark: SparkSession, row, store: str) -> DataFrame:
    """The landed shape of one resolved dataset, read from the store."""
    base = f"{store.rstrip('/')}/{row['key']}"
    loader, source = row["loader"], row["source"]
    if loader == "json_pages":
        envelope, batch = PAGED[source]
        pages = spark.read.parquet(f"{base}/pages")
        if row["live_id"] is not None:
            pages = pages.where(F.col("dataset") == row["live_id"])
        return rec.to_table(pg.read_paged(pages, envelope, batch), "record")
    if loader == "static_json":
        return rec.to_table(json_elements.document_records(spark, f"{base}/*.json"), "record")
    name = row["url"].split("?")[0].rstrip("/").rsplit("/", 1)[-1]
    if loader == "bulk_csv":
        return bulk_csv.read_typed_csv(spark, f"{base}/{name}")
    if loader == "zipped_sheet":
        return sheets.read_sheets(spark, sheets.read_archive_files(spark, f"{base}/{name}"))
    raise ValueError(f"no reader for loader {loader!r}")


def run_all(spark: SparkSession, specs: DataFrame, store: str, root: str, run_id: str, at_once: int = 4,
            only: tuple[str, ...] | None = None) -> DataFrame:
    """Resolve every spec, then land what resolves (K1/K4/K5), ``at_once`` datasets at a time in
    scheduler pools of their own. One row per spec: ``status`` is ``landed``, ``failed`` (``message`` says why: a
    resolution step or an error of the load), ``invalid`` or ``unrouted``. A failed dataset does not stop the others."""
    catalog, metastore = stored_documents(spark, store)
    plan = res.resolve(specs, catalog, metastore, only).orderBy("pos").collect()  # one narrow row per spec

    done: list[landing.RunMetrics] = []

    def load(place: int, row) -> tuple:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"load-{place % at_once}")
        try:
            m = landing.land(read_source(spark, row, store), root, row["asset_name"], run_id, source_url=row["url"],
                             record_metrics=False)
        except (PySparkException, Py4JJavaError, landing.EmptyExtractError, ValueError, RuntimeError) as e:  # errors of the data and of its store
            return row["key"], row["asset_name"], "failed", None, None, row["url"], f"{type(e).__name__}: {e}"
        done.append(m)
        return row["key"], row["asset_name"], "landed", m.row_count, m.column_count, row["url"], None

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = {row["pos"]: pool.submit(inheritable_thread_target(spark)(load), i, row)
                   for i, row in enumerate(plan) if row["status"] == res.OK}
        out = []
        for row in plan:
            if row["pos"] in running:
                out.append(running[row["pos"]].result())
                continue
            final = row["status"] if row["status"] in ("invalid", "unrouted") else "failed"
            message = row["detail"] if final == "invalid" else " ".join(x for x in (row["status"], row["detail"]) if x)
            out.append((row["key"], row["asset_name"], final, None, None, None, message if final != "unrouted" else None))
    if done:  # recorded together: appends of several writers to one folder disturb each other
        landing.append_metrics(spark, root, done)
    return spark.createDataFrame(out, RESULT)
