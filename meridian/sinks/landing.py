"""Landing runs as Parquet: K1 layout, K4 empty-extract guard, K5 run metrics, I12 counts.

Layout: ``<root>/<asset>/<run_id>.parquet`` (a Spark output folder). Runs accumulate and
are read together by glob. A run is first written under ``<root>/_staging/`` with the
row count observed in the same pass (no second scan); it is published by a rename only
when it has rows, otherwise the staging output is removed and the load fails. Task
retries and lost executors are covered by Spark's output commit protocol.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

STAGING = "_staging"
METRICS = "_metrics"


class EmptyExtractError(RuntimeError):
    """Raised when a load produced zero rows; nothing is left behind."""


@dataclass(frozen=True)
class RunMetrics:
    asset: str
    run_id: str
    path: str
    row_count: int
    column_count: int
    source_url: str | None = None


def run_path(root: str, asset: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/{asset}/{run_id}.parquet"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _delete(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, True)


def _publish(spark: SparkSession, src: str, dst: str) -> None:
    """Move a finished staging output to its final place (same run id overwrites)."""
    jvm = spark.sparkContext._jvm
    fs, hsrc = _fs(spark, src)
    hdst = jvm.org.apache.hadoop.fs.Path(dst)
    fs.mkdirs(hdst.getParent())
    aside = None
    if fs.exists(hdst):  # the old run goes last, so that a crash in between never loses both
        aside = jvm.org.apache.hadoop.fs.Path(f"{dst}.old-{uuid.uuid4().hex}")
        if not fs.rename(hdst, aside):
            raise RuntimeError(f"could not move {dst} aside")
    if not fs.rename(hsrc, hdst):
        if aside is not None:
            fs.rename(aside, hdst)
        raise RuntimeError(f"could not publish {src} -> {dst}")
    if aside is not None:
        fs.delete(aside, True)


def land(
    df: DataFrame,
    root: str,
    asset: str,
    run_id: str,
    source_url: str | None = None,
    record_metrics: bool = True,
) -> RunMetrics:
    """K1+K4+K5: write one run, guard against empty extracts, record metrics."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"land() takes a DataFrame, got {type(df).__name__}")
    spark = df.sparkSession
    staging = run_path(f"{root.rstrip('/')}/{STAGING}/{uuid.uuid4().hex}", asset, run_id)
    final = run_path(root, asset, run_id)
    obs = Observation(f"land_{asset}_{run_id}".replace("-", "_"))
    df.observe(obs, F.count(F.lit(1)).alias("row_count")).write.mode("overwrite").parquet(staging)
    rows = int(obs.get.get("row_count", 0) or 0)
    if rows == 0:
        _delete(spark, staging)
        raise EmptyExtractError(f"run {run_id} of {asset} holds no rows and is not landed")
    _publish(spark, staging, final)
    metrics = RunMetrics(asset, run_id, final, rows, len(df.columns), source_url)
    if record_metrics:
        append_metrics(spark, root, [metrics])
    return metrics


def append_metrics(spark: SparkSession, root: str, metrics: list[RunMetrics]) -> None:
    """K5: append run metrics to ``<root>/_metrics`` (one small Parquet file per call)."""
    schema = ("asset string, run_id string, path string, row_count bigint, column_count int, source_url string, "
              "recorded_at double")
    rows = [asdict(m) | {"recorded_at": time.time()} for m in metrics]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{METRICS}")


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """One row per landed run: of a run landed again, the latest record."""
    latest = spark.read.parquet(f"{root.rstrip('/')}/{METRICS}")
    values = [c for c in latest.columns if c not in ("asset", "run_id", "recorded_at")]
    kept = latest.groupBy("asset", "run_id").agg(F.max_by(F.struct(*values), "recorded_at").alias("m"))
    return kept.select("asset", "run_id", "m.*")


def count_landed(spark: SparkSession, path: str) -> int:
    """Row count of a landed run read back (empty read schema, footer-only)."""
    return spark.read.parquet(path).count()


def land_runs(
    df: DataFrame,
    root: str,
    asset: str,
    run_col: str,
    expected_runs: list[str] | None = None,
    source_url: str | None = None,
) -> tuple[list[RunMetrics], list[str]]:
    """K1+K4+K5 for many runs at once: one write job partitioned by ``run_col``.

    Every run is written under one staging folder in a single pass; per-run row counts
    come from a footer-only read of what was written; each non-empty run is published by
    rename to ``<root>/<asset>/<run_id>.parquet``. Returns the metrics of the published
    runs and the ``expected_runs`` that had no rows (nothing of them is left behind).
    """
    spark = df.sparkSession
    staging = f"{root.rstrip('/')}/{STAGING}/{asset}/_batch-{uuid.uuid4().hex}"
    data_cols = [c for c in df.columns if c != run_col]
    df.select(*data_cols, F.col(run_col).cast("string").alias("_run")).write.mode("overwrite").partitionBy(
        "_run").parquet(staging)
    schema = df.select(*data_cols).schema.add("_run", "string")
    written = spark.read.schema(schema).option("basePath", staging).parquet(staging)
    run_dir = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]+$", 1)
    counts = written.groupBy("_run", run_dir.alias("dir")).agg(F.count(F.lit(1)).alias("n")).collect()
    metrics = []
    for row in sorted(counts, key=lambda r: r["_run"]):
        final = run_path(root, asset, row["_run"])
        _publish(spark, unquote(row["dir"]), final)  # file paths are URIs; the folder name is decoded
        metrics.append(RunMetrics(asset, row["_run"], final, int(row["n"]), len(data_cols), source_url))
    _delete(spark, staging)
    if metrics:
        append_metrics(spark, root, metrics)
    landed = {m.run_id for m in metrics}
    empty = [r for r in (expected_runs or []) if r not in landed]
    return metrics, empty
