import zlib

from meridian.llm import quality_cotrain as Q

SMALL = "/root/testdata/sf0.01"


def _labels(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, quality int, text string")


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.quality for r in labels.collect()}
    train = labels.where("crc32(cast(doc_id as string)) % 5 <> 0")
    got = {r.doc_id: r for r in Q.classify(spark, docs, train).collect()}
    assert len(got) == docs.count()
    held = [i for i in known if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum(got[i].accepted == bool(known[i]) for i in held)
    good = [i for i in held if known[i] == 1]
    assert right >= 0.95 * len(held) and sum(got[i].accepted for i in good) >= 0.97 * len(good)
    assert all(0 <= x <= 1 for r in got.values() for x in (r.score, r.text_score, r.meta_score))


def test_nulls_ties_repeats_and_clashing_columns(spark, docs_of, prose):
    docs = []
    for i in range(80):
        w = prose(60, seed=i)
        docs.append((i, " ".join(w) if i % 2 else " ".join(x.upper() + "!!" for x in w[:5] * 12), "en", f"s{i % 4}", 300))
    docs += [(200, None, None, None, None), (201, "", "en", "s1", 0), (None, docs[1][1], "en", "s1", 5), (1, docs[1][1], "en", "s1", 300),
             (202, "word " * 100_000, "en", "s1", 500_000)]
    labels = [(i, i % 2) for i in range(60)] + [(1, 1), (2, 1), (2, 1), (None, 1), (5, None), (999, 0)]
    rows = Q.classify(spark, docs_of(docs), _labels(spark, labels)).collect()
    assert len(rows) == len(docs) and all(r.accepted is not None for r in rows)
    by = {r.doc_id: r for r in rows}
    assert sum(by[i].accepted == bool(i % 2) for i in range(60, 80)) >= 18
    assert len({r.score for r in rows if r.doc_id == 1}) == 1


def test_without_both_classes_all_stay(spark, docs_of):
    docs = docs_of([(1, "a"), (2, None)])
    assert [(r.score, r.accepted) for r in Q.classify(spark, docs, _labels(spark, [])).collect()] == [(1.0, True)] * 2
    assert all(r.accepted for r in Q.classify(spark, docs, _labels(spark, [(1, 1)])).collect())
    assert Q.classify(spark, docs_of([]), _labels(spark, [(1, 1), (2, 0)])).count() == 0


def test_views_see_only_their_side():
    assert Q.meta_view("a", "en", 5) != Q.meta_view("b", "en", 5) and len(Q.meta_view(None, None, None)) == 3 + Q.SOURCES + Q.LANGUAGES
    assert Q.text_view(None) == Q.text_view("") and len(Q.text_view("A b!!")) == 13


def test_a_repeated_id_is_one_row_of_the_sample(spark, docs_of):
    docs = docs_of([(1, f"text {i}") for i in range(500)] + [(2, "b"), (3, "c")])
    rows = Q._sample(spark, docs, _labels(spark, [(1, 1), (2, 0)]), Q.F.col("quality") == 1).collect()
    assert sorted((r.doc_id, r.label) for r in rows if r.label is not None) == [(1, 1.0), (2, 0.0)] and len(rows) == 3


def test_every_document_is_fitted_on(spark, docs_of):
    n = 50_000  # more than any bound on labelled or other documents that fitting ever had
    docs = spark.range(2 * n).selectExpr("id as doc_id", "concat('t', id) as text", "'en' as lang", "'s' as source", "3L as n_chars")
    labels = spark.range(n).selectExpr("id as doc_id", "id % 2 as quality")
    rows = Q._sample(spark, docs, labels, Q.F.col("quality"))
    got = rows.groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in got} == {None: n, 0.0: n // 2, 1.0: n // 2}


def test_threshold_is_the_exact_rank(spark):
    values = spark.range(200_001).selectExpr("pmod(id * 7919, 200001) / 200001 as x")
    assert Q._lowest(values, 0.003) == 600 / 200_001  # the 601st: 600.003 values are too few
    assert Q._lowest(spark.sql("select 0.5D as x union all select 0.5D union all select 0.25D"), 0.5) == 0.5
    assert Q._lowest(spark.sql("select 0.5D as x"), 0.003) == 0.5
