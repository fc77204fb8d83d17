"""Model materializations (K7 view, K8 ephemeral, K9 table) and named raw sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meridian.session import shared_dir


def view(df: DataFrame, name: str) -> DataFrame:
    """K7: a lazy temp view; conforming happens at read time, nothing is copied."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def ephemeral(df: DataFrame) -> DataFrame:
    """K8: an inlined fragment is just a DataFrame passed on (Catalyst inlines it)."""
    return df


def table(df: DataFrame, schema: str, name: str, location: str | None = None) -> DataFrame:
    """K9: a materialized table in its own schema (database), stored under the shared dir.

    The table is external (explicit path), so a rebuild overwrites its files even when the
    catalog is a fresh session's (no persistent metastore) and the files already exist.
    """
    spark: SparkSession = df.sparkSession
    where = location or f"{shared_dir(spark)}/warehouse/{schema}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}` LOCATION '{where}'")
    df.write.mode("overwrite").format("parquet").option("path", f"{where}/{name}").saveAsTable(f"`{schema}`.`{name}`")
    return spark.table(f"`{schema}`.`{name}`")
