import zlib

import numpy as np
from pyspark.sql import functions as F

from meridian.llm import toxicity as T

SMALL = "/root/testdata/sf0.1"


def _labels(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, toxic int, text string, score int")


def _plain_grams(text):
    """n-grams of every word with its spaces: an independent count."""
    return sum(max(len(f" {w} ") - k + 1, 0) for w in text.lower().split() for k in T.ORDERS)


def test_grams_stay_within_words():
    for text in ("a", "ab", "abc def", "Ünï  code\n\twörds", "x" * 500, "🤦 漢字 " * 40):
        assert len(T.grams(text)) == _plain_grams(text), text
    assert (T.grams("Same  TEXT") == T.grams("same\ntext")).all()
    assert not set(T.grams("abcdef")) - set(T.grams("abcdef other words"))
    assert len(T.grams(None)) == len(T.grams("")) == len(T.grams(" \n")) == 0
    assert T.grams("any text of words").max() < 1 << T.SPACE


def test_ratios_against_plain_counts(spark, prose):
    rows = [(float(i % 3 == 0), " ".join(prose(12, seed=i) + (["badword"] if i % 3 == 0 else []))) for i in range(60)]
    got = T.ratios(spark.createDataFrame(rows, "label double, text string"), 1 << T.SPACE)
    p, q = {}, {}
    for label, text in rows:
        for b in set(T.grams(text).tolist()):
            side = p if label else q
            side[b] = side.get(b, 0) + 1
    seen = p.keys() | q.keys()
    sums = sum(p.get(b, 0) + T.ALPHA for b in seen), sum(q.get(b, 0) + T.ALPHA for b in seen)
    want = {b: np.log((p.get(b, 0) + T.ALPHA) / sums[0] / ((q.get(b, 0) + T.ALPHA) / sums[1])) for b in seen
            if p.get(b, 0) + q.get(b, 0) >= T.MIN_DOCS}
    assert got.keys() == want.keys() and all(abs(got[b] - want[b]) < 1e-9 for b in got)
    top = T.ratios(spark.createDataFrame(rows, "label double, text string"), 5)
    assert set(top) <= set(T.grams("badword").tolist())


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in T.score(spark, docs, labels).collect()}
    assert len(got) == docs.count()
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(got[r.doc_id].held_out for r in held)
    toxic = [got[r.doc_id].score for r in held if r.toxic]
    clean = [got[r.doc_id].score for r in held if not r.toxic]
    ranked = np.mean([(np.array(clean) < s).mean() for s in toxic])
    assert ranked >= 0.97
    assert np.mean([s >= 0.3 for s in toxic]) >= 0.8 and np.mean([s >= 0.3 for s in clean]) <= 0.02
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_held_out_labels_are_never_learned(spark, docs_of, prose):
    docs = docs_of([(i, " ".join(prose(30, seed=i) + (["vileword"] if i % 2 else []))) for i in range(200)])
    truth = [(i, i % 2) for i in range(200)]
    lies = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in truth]
    a = {r.doc_id: r.score for r in T.score(spark, docs, _labels(spark, truth)).collect()}
    assert a == {r.doc_id: r.score for r in T.score(spark, docs, _labels(spark, lies)).collect()}
    assert sum((a[i] >= 0.3) == bool(y) for i, y in truth) >= 180


def test_nulls_ties_repeats_and_clashing_columns(spark, docs_of, prose):
    rows = [(i, " ".join(prose(20, seed=i) + (["vileword"] if i % 2 else []))) for i in range(100)]
    rows += [(200, None), (201, ""), (None, "vileword of no id"), (1, "second text of an id"), (203, "word " * 200_000 + "vileword")]
    labels = [(i, i % 2) for i in range(100)] + [(2, 1), (3, None), (None, 1), (999, 1), (200, 0), (7, 1)]
    got = T.score(spark, docs_of(rows), _labels(spark, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[200].score == by[201].score and not by[None].held_out and by[None].predicted == 1 and by[203].predicted == 1


def test_without_both_classes_every_score_is_zero(spark, docs_of):
    docs = docs_of([(1, "a"), (2, None)])
    assert [(r.score, r.predicted) for r in T.score(spark, docs, _labels(spark, [])).collect()] == [(0.0, 0)] * 2
    assert all(r.score == 0 for r in T.score(spark, docs, _labels(spark, [(1, 1)])).collect())
    assert T.score(spark, docs_of([]), _labels(spark, [(1, 1), (2, 0)])).count() == 0


def test_sample_is_bounded_by_ids(spark, docs_of, prose):
    docs = docs_of([(i % 50, " ".join(prose(5, seed=i))) for i in range(500)])
    rows = T.sample(spark, docs, _labels(spark, [(i, i % 2) for i in range(50)]), F.col("toxic"))
    assert rows.count() == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(50))
