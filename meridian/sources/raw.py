"""Reading landed runs: I9 (all runs of an asset), D7 (runs concatenated), I10 (named sources)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meridian.sources.widening import merged, widened


def read_runs(spark: SparkSession, root: str, asset: str, with_run_id: bool = False) -> DataFrame:
    """Every run of ``asset`` read together by glob, with the union of their columns
    (absent ones are NULL). No run -> PATH_NOT_FOUND error.

    A column whose type changed between runs gets the wider type (``widening.wider``): runs of
    equal schema are read together, so the plan grows with the schemas that ever occurred, not
    with the runs. ``with_run_id`` adds the run id taken from the file path (our extension).
    """
    glob = f"{root.rstrip('/')}/{asset}/*.parquet"
    try:
        df = spark.read.option("mergeSchema", True).parquet(glob)
    except Exception as e:  # noqa: BLE001 - only the one condition below is handled
        if "CANNOT_MERGE" not in str(e):
            raise
    else:
        return _with_run(df) if with_run_id else df
    shapes: dict[str, tuple[StructType, list[str]]] = {}
    for path in _runs(spark, glob):
        schema = spark.read.option("mergeSchema", True).parquet(path).schema
        shapes.setdefault(schema.json(), (schema, []))[1].append(path)
    target = merged([schema for schema, _ in shapes.values()])
    parts = []
    for schema, paths in shapes.values():
        have = {f.name: f.dataType for f in schema}
        part = spark.read.schema(schema).parquet(*paths)
        cols = [(widened(_named(f.name), have[f.name], f.dataType) if f.name in have
                 else F.lit(None).cast(f.dataType)).alias(f.name) for f in target]
        parts.append(part.select(*cols, *([_run_id()] if with_run_id else [])))
    return reduce(DataFrame.unionByName, parts)


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _run_id() -> Column:
    # file paths are URIs: percent-decode (keeping a literal '+', which url_decode reads as space)
    name = F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)\\.parquet/[^/]*$", 1)
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("_run_id")


def _with_run(df: DataFrame) -> DataFrame:
    return df.withColumn("_run_id", _run_id())


def _runs(spark: SparkSession, glob: str) -> list[str]:
    """The folders of the runs, by name."""
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found)


def latest_run_only(df_with_run_id: DataFrame, run_order: DataFrame) -> DataFrame:
    """Our extension (not in the reference): keep rows of the newest run only.

    ``run_order`` is a small ``(_run_id, run_seq)`` table (one row per run, e.g. from the
    metrics table); the newest run is found with one aggregate and joined back.
    """
    newest = run_order.agg(F.max_by("_run_id", "run_seq").alias("_run_id"))
    return df_with_run_id.join(F.broadcast(newest), "_run_id", "left_semi")


def register_source(spark: SparkSession, root: str, name: str, asset: str | None = None) -> DataFrame:
    """A named source ``name`` over ``{root}/{asset}/*.parquet`` as a temp view."""
    df = read_runs(spark, root, asset or name)
    df.createOrReplaceTempView(name)
    return df
