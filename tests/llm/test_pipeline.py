"""The corpus pipeline, stage by stage against plain versions."""

import corpus_pipeline as pipeline
from meridian.llm import quality_cotrain
from tests.conftest import SMALL
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard_join import brute as classes
from tests.llm.test_packing import _invariants
from tests.llm.test_pii import base

import duckdb
import pytest


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage returned, rows as plain tuples."""
    from meridian.llm.common import written
    from meridian.sources.tables import table

    docs = table(spark, SMALL, "documents")
    out = [("documents", docs, docs.collect())]
    for name, stage in pipeline.STAGES:
        docs = written(spark, stage(spark, docs, SMALL), f"test-{name}")
        out.append((name, docs, docs.collect()))
    return out


def test_stages_and_columns(steps):
    assert [n for n, _ in pipeline.STAGES] == [n for n, _, _ in steps[1:]]
    assert all(df.columns == pipeline.COLUMNS for _, df, _ in steps[1:-1])


def test_quality_stage_keeps_what_the_classifier_accepts(spark, steps):
    # how good the classifier is, test_quality_cotrain says on more rows
    con = duckdb.connect()
    good = {r[0] for r in con.execute(f"SELECT doc_id FROM '{SMALL}/labels.parquet' WHERE quality = 1").fetchall()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    scored = quality_cotrain.classify(spark, steps[0][1], labels).collect()
    kept = {r.doc_id for r in steps[1][2]}
    assert kept == {r.doc_id for r in scored if r.accepted}
    assert len(good - kept) <= 0.03 * len(good)


def test_near_duplicate_stage(steps):
    rows = [(r.doc_id, r.text) for r in steps[1][2]]
    want = sorted(d for d, _, c in classes(rows) if d == c)
    assert sorted(repr(r.doc_id) for r in steps[2][2]) == want and len(want) < len(rows)


def test_decontamination_stage(steps):
    con = duckdb.connect()
    items = con.execute(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    want = sorted(r.doc_id for r in steps[2][2] if not contaminated(r.text, items)[4])
    assert sorted(r.doc_id for r in steps[3][2]) == want


def test_personal_data_stage(steps):
    before = {r.doc_id: r for r in steps[3][2]}
    assert {r.doc_id for r in steps[4][2]} == set(before)
    for r in steps[4][2]:
        old = before[r.doc_id]
        assert not base(r.text) and (r.lang, r.source) == (old.lang, old.source)
        if not base(old.text) and "[" not in r.text:
            assert r.text == old.text and r.n_chars == old.n_chars
        else:
            assert r.n_chars == len(r.text)


def test_packing_stage(steps):
    _invariants(steps[5][2])
    got = {}
    for r in steps[5][2]:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {r.doc_id: len((r.text or "").encode().split()) for r in steps[4][2]}


def test_repeated_rows_nulls_and_empty_input(spark, docs_of, prose):
    a, b = " ".join(prose(40, seed=1)), " ".join(prose(40, seed=2))
    docs = docs_of([(1, a), (1, a), (2, a + " end"), (1, b), (None, None), (None, None), (4, ""), (5, b.upper()), (None, "x y z")])
    kept = pipeline.near_duplicate_stage(spark, docs, SMALL).collect()
    assert sorted((repr(r.doc_id), r.text) for r in kept if r.text) == sorted([("1", a), ("1", b), ("None", "x y z")])
    assert sum(not r.text for r in kept) == 3
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0).select(*pipeline.COLUMNS), SMALL).count() == 0
    clean = pipeline.personal_data_stage(spark, docs_of([(1, None), (2, "m a@b.co"), (3, "plain")]), SMALL).collect()
    assert sorted((r.doc_id, r.text) for r in clean) == [(1, None), (2, "m [EMAIL]"), (3, "plain")]
