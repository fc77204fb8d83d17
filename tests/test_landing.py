import os

import pytest
from pyspark.errors import AnalysisException

from meridian.sinks import landing
from meridian.sources import raw


def _local(p):
    return p.replace("file:", "")


def test_layout_round_trip_and_metrics(spark, tmp_root):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a bigint, b string")
    m = landing.land(df, tmp_root, "cms_t", "run-1", source_url="https://example.org/x.csv")
    assert m.path == f"{tmp_root}/cms_t/run-1.parquet" and m.row_count == 2 and m.column_count == 2
    assert os.path.isdir(_local(m.path))
    assert sorted(tuple(r) for r in raw.read_runs(spark, tmp_root, "cms_t").collect()) == [(1, "x"), (2, "y")]
    met = landing.read_metrics(spark, tmp_root).collect()
    assert [(r.asset, r.run_id, r.row_count, r.source_url) for r in met] == [
        ("cms_t", "run-1", 2, "https://example.org/x.csv")]
    assert landing.count_landed(spark, m.path) == 2


def test_runs_accumulate_and_same_run_overwrites(spark, tmp_root):
    df = spark.createDataFrame([(1,)], "a bigint")
    landing.land(df, tmp_root, "cms_t", "run-1")
    landing.land(df, tmp_root, "cms_t", "run-2")
    landing.land(df, tmp_root, "cms_t", "run-2")
    runs = raw.read_runs(spark, tmp_root, "cms_t", with_run_id=True)
    assert sorted(r._run_id for r in runs.collect()) == ["run-1", "run-2"]


def test_empty_guard_leaves_nothing(spark, tmp_root):
    df = spark.createDataFrame([], "a bigint")
    with pytest.raises(landing.EmptyExtractError):
        landing.land(df, tmp_root, "cms_t", "run-1")
    assert not os.path.exists(_local(f"{tmp_root}/cms_t/run-1.parquet"))
    assert not os.path.exists(_local(f"{tmp_root}/_staging/cms_t/run-1.parquet"))


def test_missing_asset_raises(spark, tmp_root):
    with pytest.raises(AnalysisException):
        raw.read_runs(spark, tmp_root, "cms_nothing").collect()


def test_named_source_view(spark, tmp_root):
    landing.land(spark.createDataFrame([(1,), (2,)], "a bigint"), tmp_root, "cms_v", "r1")
    raw.register_source(spark, tmp_root, "cms_v")
    assert spark.sql("select sum(a) from cms_v").first()[0] == 3


def test_latest_run_only(spark, tmp_root):
    landing.land(spark.createDataFrame([(1,)], "a bigint"), tmp_root, "cms_l", "r1")
    landing.land(spark.createDataFrame([(2,)], "a bigint"), tmp_root, "cms_l", "r2")
    runs = raw.read_runs(spark, tmp_root, "cms_l", with_run_id=True)
    order = spark.createDataFrame([("r1", 1), ("r2", 2)], "_run_id string, run_seq int")
    assert [r.a for r in raw.latest_run_only(runs, order).collect()] == [2]


def test_land_runs_one_job(spark, tmp_root):
    from pyspark.sql import functions as F

    df = spark.range(0, 100).select(F.col("id"), F.when(F.col("id") < 30, "run a").otherwise("run-b").alias("r"))
    metrics, empty = landing.land_runs(df, tmp_root, "cms_multi", "r", expected_runs=["run a", "run-b", "run-c"])
    assert [(m.run_id, m.row_count, m.column_count) for m in metrics] == [("run a", 30, 1), ("run-b", 70, 1)]
    assert empty == ["run-c"]
    back = raw.read_runs(spark, tmp_root, "cms_multi", with_run_id=True)
    assert sorted((r._run_id, r.n) for r in back.groupBy("_run_id").agg(F.count("*").alias("n")).collect()) == [
        ("run a", 30), ("run-b", 70)]
    assert not os.path.exists(_local(f"{tmp_root}/_staging/cms_multi")) or not any(
        n.startswith("_batch") for n in os.listdir(_local(f"{tmp_root}/_staging/cms_multi")))
    assert sorted(r.run_id for r in landing.read_metrics(spark, tmp_root).collect()) == ["run a", "run-b"]


def test_non_table_is_rejected(tmp_root):
    with pytest.raises(TypeError):
        landing.land([{"a": 1}], tmp_root, "cms_t", "run-1")


def test_runs_with_different_columns_read_as_their_union(spark, tmp_root):
    landing.land(spark.createDataFrame([(1, "x")], "a int, b string"), tmp_root, "drift", "r1")
    landing.land(spark.createDataFrame([(2, "y", 3.5)], "a int, b string, c double"), tmp_root, "drift", "r2")
    rows = raw.read_runs(spark, tmp_root, "drift").orderBy("a").collect()
    assert [(r.a, r.b, r.c) for r in rows] == [(1, "x", None), (2, "y", 3.5)]


def test_landing_a_run_again_replaces_it_and_its_metrics(spark, tmp_root):
    for n in (3, 5):
        landing.land(spark.range(n), tmp_root, "again", "r1")
    assert raw.read_runs(spark, tmp_root, "again").count() == 5
    assert [(r.run_id, r.row_count) for r in landing.read_metrics(spark, tmp_root).where("asset = 'again'").collect()] == [("r1", 5)]


def test_types_that_change_between_runs_are_widened(spark, tmp_root):
    runs = {"a": "select 1 as n, cast(1 as decimal(5,2)) as d, named_struct('x', 1) as s, array(1) as l, 1 as t, date'2024-01-02' as w",
            "b": "select 5000000000L as n, 7 as d, named_struct('x', 'q', 'y', 2) as s, array(2.5D) as l, map('k', 1) as t, "
                 "timestamp'2024-01-02 03:04:05' as w, 'new' as `odd.name`",
            "c": "select 2.5D as n, cast(null as decimal(5,2)) as d, cast(null as struct<x: int>) as s, array(3) as l, true as t, "
                 "date'2024-01-03' as w"}
    for run, sql in runs.items():
        landing.land(spark.sql(sql), tmp_root, "cms_w", run)
    got = raw.read_runs(spark, tmp_root, "cms_w", with_run_id=True)
    assert got.drop("_run_id").schema.simpleString() == (
        "struct<n:double,d:decimal(12,2),s:struct<x:string,y:int>,l:array<double>,t:string,w:timestamp,odd.name:string>")
    rows = {r._run_id: r for r in got.collect()}
    assert [rows[k].n for k in "abc"] == [1.0, 5e9, 2.5] and [rows[k].t for k in "abc"] == ["1", '{"k":1}', "true"]
    assert rows["a"].s == ("1", None) and rows["b"].s == ("q", 2) and rows["c"].s is None
    assert [rows[k].l for k in "abc"] == [[1.0], [2.5], [3.0]] and float(rows["b"].d) == 7.0 and rows["b"]["odd.name"] == "new"


def test_widening_does_not_depend_on_the_order():
    from itertools import permutations

    from pyspark.sql import types as T

    from meridian.sources.widening import wider

    kinds = [T.IntegerType(), T.LongType(), T.DoubleType(), T.DecimalType(38, 10), T.StringType(), T.BooleanType(), T.DateType(), T.NullType()]
    assert all(wider(a, b) == wider(b, a) for a, b in permutations(kinds, 2))
    assert wider(T.LongType(), T.DecimalType(38, 30)) == T.DoubleType() and wider(T.BooleanType(), T.LongType()) == T.StringType()
