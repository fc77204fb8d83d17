from meridian.operators import quality as q


def _df(spark):
    rows = [("a", "12345", 3, 8, 5), ("b", None, 6, 8, 9), ("b", "1234", None, None, 2), (None, "12345\n", 0, 8, None)]
    return spark.createDataFrame(rows, "id string, zip5 string, rating int, grp int, cnt int")


def test_row_tests(spark):
    df = _df(spark)
    assert q.not_null(df, "zip5").count() == 1
    assert q.not_null(df, "id").count() == 1
    assert q.match_regex(df, "zip5", "^\\d{5}$").count() == 2  # short and trailing newline; NULL passes
    assert q.accepted_range(df, "rating", 1, 5).count() == 2  # 6 and 0; NULL passes
    assert q.accepted_range(df, "rating", min_value=1).count() == 1  # open upper bound
    assert q.expression_is_true(df, "cnt <= grp or cnt is null or grp is null").count() == 1


def test_unique_ignores_nulls(spark):
    rows = q.unique(_df(spark), "id").collect()
    assert [(r.unique_field, r.n_records) for r in rows] == [("b", 2)]


def test_report_matches_individual_tests(spark):
    df = _df(spark)
    tests = [
        q.DataTest("nn_id", "not_null", "id"),
        q.DataTest("u_id", "unique", "id"),
        q.DataTest("nn_zip", "not_null", "zip5"),
        q.DataTest("re_zip", "regex", "zip5", {"regex": "^\\d{5}$"}),
        q.DataTest("rng", "range", "rating", {"min_value": 1, "max_value": 5}),
        q.DataTest("expr", "expression", None, {"expression": "cnt <= grp or cnt is null or grp is null"}),
        q.DataTest("u_zip", "unique", "zip5"),
    ]
    report = {r.test_name: r.failures for r in q.run_tests(df, tests).collect()}
    single = {t.name: q.failing_rows(df, t).count() for t in tests}
    assert report == single
    assert report == {"nn_id": 1, "u_id": 1, "nn_zip": 1, "re_zip": 2, "rng": 2, "expr": 1, "u_zip": 0}


def test_report_without_unique(spark):
    df = _df(spark)
    out = q.run_tests(df, [q.DataTest("nn", "not_null", "zip5")]).collect()
    assert [(r.test_name, r.failures) for r in out] == [("nn", 1)]
