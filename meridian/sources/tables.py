"""Driver tables as temp views (lazy parquet scans; pruning and pushdown stay with Catalyst)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Register the named driver tables (all when none given) as temp views."""
    for name in names or TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
