"""Skew-safe numbering and per-group limits.

A plain ``row_number() over (partition by g order by k)`` sends every row of a group to
one task; with one group holding a third of the data that task is the whole job. These
helpers split each group across key-range buckets (or hash salts) first and only move
small per-bucket summaries through the per-group step.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: cells of a level of the histogram beyond those that its rows need
CELLS = 4096


def _cells(df: DataFrame, ranges: list[tuple[float, float, int]], limit: float) -> list[tuple[float, float, int]]:
    """``(lowest, highest, rows)`` of the cells with rows that the ``ranges`` (disjoint, in order) of the key ``_k`` are cut
    into: equal parts of a range, four for each ``limit`` of its rows and some more while ranges are few."""
    spare = CELLS // len(ranges)
    table = [(i + 1.0, lo, hi, 4 * math.ceil(n / limit) + spare) for i, (lo, hi, n) in enumerate(ranges)]
    small = F.broadcast(df.sparkSession.createDataFrame(table, "_i double, _lo double, _hi double, _fan long"))
    starts = Bucketizer(splits=[float("-inf"), *(lo for lo, _, _ in ranges), float("inf")], inputCol="_k", outputCol="_i")
    found = starts.transform(df).join(small, "_i").where(F.col("_k") <= F.col("_hi"))
    # quarters: a range of the widest doubles has no finite length
    part = F.try_divide(F.col("_k") / 4 - F.col("_lo") / 4, F.col("_hi") / 4 - F.col("_lo") / 4) * F.col("_fan")
    cells = found.groupBy("_i", F.least(F.floor(F.coalesce(part, F.lit(0.0))), F.col("_fan") - 1).alias("_c")).agg(
        F.min("_k").alias("lo"), F.max("_k").alias("hi"), F.count(F.lit(1)).alias("n"))
    return [(r.lo, r.hi, r.n) for r in cells.select("lo", "hi", "n").collect()]


def split_points(df: DataFrame, order_col: str, buckets: int) -> list[float]:
    """Points that split the finite values of a numeric column into at most ``2 * buckets`` ranges of at most ``rows / buckets``
    rows each (but for rows of one value, which stay together), by a histogram of several levels.

    The first level cuts the whole range into equal cells; every cell with more than ``rows / buckets`` rows is
    cut again, until none is left that can be: two or three levels unless the keys are very unevenly spread. Fewer
    than ``buckets`` cells are ever cut, so a level has some ``5 * buckets + CELLS`` cells at most, which is what
    the driver holds. The points depend on the rows alone, not on how they are split among tasks.
    """
    keys = df.select(F.col(order_col).cast("double").alias("_k")).where(F.abs("_k") < float("inf"))
    lo, hi, n = keys.agg(F.min("_k"), F.max("_k"), F.count(F.lit(1))).first()
    if buckets < 2 or n < 2 or lo == hi:
        return []
    limit = n / buckets
    done, heavy = [], [(lo, hi, n)]
    while heavy:
        cells = _cells(keys, heavy, limit)
        again = {c for c in cells if c[2] > limit and c[0] < c[1]} - set(heavy)  # a cell that stays as it was is cut no more
        done += [c for c in cells if c not in again]
        heavy = sorted(again)
    points, rows = [], 0.0
    for low, _, count in sorted(done):
        if rows and rows + count > limit:
            points.append(low)
            rows = 0
        rows += count
    return points


def row_index(
    df: DataFrame, group_cols: list[str], order_col: str, out: str = "row_idx", buckets: int | None = None
) -> DataFrame:
    """0-based position of each row within its group by the numeric ``order_col``
    (unique within a group).

    1. split the order key into ranges of nearly equal rows (``split_points``; the bucket is a
       deterministic expression, so recomputed tasks agree with each other), so a hot group
       spans many buckets, none with more than ``1 / buckets`` of all rows;
    2. count rows per (group, bucket) - a table of at most buckets x groups rows;
    3. prefix-sum those counts per group to get each bucket's base offset;
    4. number rows inside each (group, bucket) and add the base.
    """
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = split_points(df, order_col, n)
    if bounds:
        # binary search over the split points, JVM side: O(log buckets) per row
        splits = [float("-inf"), *bounds, float("inf")]
        keyed = Bucketizer(splits=splits, inputCol=order_col, outputCol="_b", handleInvalid="keep").transform(df)
        keyed = keyed.withColumn("_bucket", F.col("_b").cast("int")).drop("_b")
    else:
        keyed = df.withColumn("_bucket", F.lit(0))
    counts = keyed.groupBy(*group_cols, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*group_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*group_cols, "_bucket", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_base"))
    local = Window.partitionBy(*group_cols, "_bucket").orderBy(order_col)
    numbered = keyed.withColumn("_local", F.row_number().over(local) - 1)
    return (
        numbered.join(bases, [*group_cols, "_bucket"])
        .withColumn(out, (F.col("_base") + F.col("_local")).cast("bigint"))
        .drop("_bucket", "_base", "_local")
    )


def first_n(df: DataFrame, group_cols: list[str], order_cols: list[str], n: int, salts: int = 64) -> DataFrame:
    """Rows ranked 1..n per group by ``order_cols`` (ties broken by ``order_cols`` only).

    Stage 1 keeps the first n per (group, hash salt) - a hot group is spread over
    ``salts`` tasks; stage 2 ranks at most ``salts * n`` survivors per group.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in order_cols]), F.lit(salts))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order_cols)
    stage1 = df.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= n)
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return (
        stage1.withColumn("_rn", F.row_number().over(w2))
        .where(F.col("_rn") <= n)
        .drop("_salt", "_r1")
    )
