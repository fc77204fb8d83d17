from pyspark.sql import functions as F

from meridian.plans import models


def test_view_ephemeral_and_table(spark):
    df = spark.createDataFrame([("CA", 1), ("CA", 2), ("TX", 3)], "state string, n int")
    v = models.view(df, "stg_models_test")
    assert spark.sql("select sum(n) from stg_models_test").first()[0] == 6
    mart = models.ephemeral(v).groupBy("state").agg(F.sum("n").alias("total"))
    t = models.table(mart, "marts_models_test", "by_state")
    assert sorted(tuple(r) for r in spark.table("marts_models_test.by_state").collect()) == [("CA", 3), ("TX", 3)]
    assert t.count() == 2
    models.table(mart.where("state = 'TX'"), "marts_models_test", "by_state")  # overwrite in place
    assert spark.table("marts_models_test.by_state").count() == 1
