import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from meridian.functions.ranking import first_n, row_index, split_points
from tests.conftest import SMALL


def test_row_index_matches_row_number(spark):
    ev = spark.read.parquet(f"{SMALL}/events.parquet").select("event_id", "event_type")
    got = row_index(ev, ["event_type"], "event_id", "rk", buckets=5)
    want = ev.withColumn("rk2", F.row_number().over(Window.partitionBy("event_type").orderBy("event_id")) - 1)
    assert got.join(want, ["event_id", "event_type"]).where("rk <> rk2").count() == 0
    assert got.count() == ev.count()


def test_row_index_hot_group(spark):
    # one group holds every row: it is still numbered densely from 0
    df = spark.range(0, 5000).withColumn("g", F.lit("hot"))
    got = row_index(df, ["g"], "id", "rk", buckets=8)
    assert got.where("rk <> id").count() == 0


def test_first_n(spark):
    ev = spark.read.parquet(f"{SMALL}/events.parquet").select("event_id", "event_type")
    got = first_n(ev, ["event_type"], ["event_id"], 7, salts=4)
    want = ev.withColumn("r", F.row_number().over(Window.partitionBy("event_type").orderBy("event_id"))).where("r <= 7")
    assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in want.collect())


def test_split_points_bound_every_bucket(spark):
    n, buckets = 200_000, 1000
    # a third of the keys close together, a third spread over many powers, the rest equal steps apart
    key = F.expr("case when id % 3 = 0 then 5.0D + id * 1e-9D when id % 3 = 1 then pow(2, (id - 100000) / 3000.0D) else id * 1000.0D end")
    df = spark.range(n).select(key.alias("k"))
    points = split_points(df, "k", buckets)
    keys = np.array([r.k for r in df.collect()])
    counts = np.bincount(np.searchsorted(points, keys, side="right"))
    assert counts.max() <= n / buckets and len(counts) <= 2 * buckets


def test_split_points_of_degenerate_keys(spark):
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (3.0,), (3.0,)], "k double")
    assert split_points(odd, "k", 10) == [] and split_points(odd.limit(0), "k", 10) == []
    wide = spark.createDataFrame([(-1.7e308,), (0.0,), (5e-324,), (1e-320,), (1.7e308,)], "k double")
    assert set(split_points(wide, "k", 5)) <= {0.0, 5e-324, 1e-320, 1.7e308}
