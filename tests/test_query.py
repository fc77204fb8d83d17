from meridian.operators.query import clauses


def _df(spark):
    rows = [(1, "Alpha", "x"), (2, "beta", None), (3, "GAMMA", "alphabet"), (4, "delta", "y")]
    return spark.createDataFrame(rows, "id int, name string, note string")


def test_select_where_order_limit_offset(spark):
    out = clauses(_df(spark), select=["id", "upper(name) AS name_u"], where="id > 1", order="id DESC",
                  limit=2, offset=1)
    assert [tuple(r) for r in out.collect()] == [(3, "GAMMA"), (2, "BETA")]


def test_order_nulls_and_multi_key(spark):
    out = clauses(_df(spark), select=["id", "note"], order="note ASC NULLS LAST, id")
    assert [r.id for r in out.collect()] == [3, 1, 4, 2]


def test_q_is_case_insensitive_over_text_columns(spark):
    assert sorted(r.id for r in clauses(_df(spark), q="ALPHA").collect()) == [1, 3]
    assert clauses(_df(spark), q="zzz").count() == 0
