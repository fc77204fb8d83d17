"""Joins against small per-key tables that stay balanced when one key is hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.session import fresh_path


def measured(df: DataFrame, label: str) -> DataFrame:
    """Write a small per-key table to the shared folder and read it back: its size in bytes is
    then known when the plan is made, so a join broadcasts it below Spark's threshold (the big
    side stays where it is) and shuffles both sides above it."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], how: str, spread: Column,
                salts: int = 32) -> DataFrame:
    """Exact equi-join of ``big`` with a small per-key table, spreading each key over ``salts``.

    ``small`` rows are replicated once per salt (``salts`` x its size); ``big`` rows get the
    salt ``pmod(hash(spread), salts)``. A key holding a third of ``big`` then lands in
    ``salts`` tasks instead of one, with or without AQE. ``how`` is inner, left, left_semi
    or left_anti (each big row meets exactly one replica of its key).
    """
    salted_big = big.withColumn("_salt", F.pmod(F.hash(spread), F.lit(salts)))
    salted_small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_big.join(salted_small, [*keys, "_salt"], how).drop("_salt")
