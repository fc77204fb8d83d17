from pyspark.sql import functions as F

from meridian.functions.joins import measured, salted_join


def test_salted_join_is_exact_for_each_join_type(spark):
    big = spark.range(0, 3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
                                      F.col("id"))
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("k3", 3)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(tuple(r) for r in big.join(small, ["k"], how).collect())
        got = sorted(tuple(r) for r in salted_join(big, small, ["k"], how, spread=F.col("id"), salts=8).collect())
        assert got == want, how


def test_salted_join_spreads_a_hot_key(spark):
    big = spark.range(0, 4000).select(F.lit("hot").alias("k"), "id")
    small = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = salted_join(big, small, ["k"], "inner", spread=F.col("id"), salts=8)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and max(sizes) < 4000


def test_measured_table_is_broadcast_while_small(spark):
    small = measured(spark.range(10).toDF("k"), "test-measured")
    plan = spark.range(1000).toDF("k").join(small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and small.count() == 10
