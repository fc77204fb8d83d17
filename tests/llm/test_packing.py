import random

from pyspark.sql import functions as F

from meridian.llm import packing as P


def _invariants(pieces, capacities=P.CAPACITIES):
    bins = {}
    for r in pieces:
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    for rows in bins.values():
        rows.sort(key=lambda r: r.slot)
        at = 0
        for k, r in enumerate(rows):
            assert r.slot == k and r.at == at
            at += r.length
        assert {r.filled for r in rows} == {at}
        assert {r.capacity for r in rows} == {min(c for c in capacities if c >= at)}
    return bins


def test_pieces_cover_documents(spark, docs_of):
    rng = random.Random(4)
    docs = [(i, "w " * rng.choice([1, 3, 50, 400, 511, 512, 513, 3000, 8192, 8193, 20_000])) for i in range(80)]
    docs += [(90, None), (91, ""), (92, " \t\n "), (None, "a b c"), (5, docs[5][1]), (93, "x y z")]
    rows = P.best_fit(docs_of(docs), shard_pieces=40).collect()
    _invariants(rows)
    want = sorted((repr(d), len((t or "").encode().split())) for d, t in docs)
    by = {}
    for r in rows:
        by.setdefault(repr(r.doc_id), []).append((r.start, r.length))
    assert sorted((d, sum(n for _, n in v)) for d, v in by.items()) == sorted(
        (d, sum(n for e, n in want if e == d)) for d in {d for d, _ in want})
    for d, n in want:
        if d != "5":
            at = 0
            for start, length in sorted(by[d]):
                assert start == at
                at += length
            assert at == n
    assert [r.bin_id for r in rows if r.doc_id in (90, 91, 92)] == [None] * 3


def test_bins_are_well_filled_and_cheaper_than_one_size(spark):
    rng = random.Random(1)
    lengths = [min(8192, int(rng.lognormvariate(5.5, 1.2)) + 1) for _ in range(3000)]
    placed = P.pack(lengths)
    bins = {b: c for b, c, _ in placed}
    cost = sum(P.sequence_cost(c) for c in bins.values())
    assert sum(lengths) / sum(bins.values()) > 0.97
    assert cost < sum(P.sequence_cost(c) for c in {b: c for b, c, _ in P.pack(lengths, (8192,))}.values())
    assert cost < sum(P.sequence_cost(min(c for c in P.CAPACITIES if c >= n)) for n in lengths)


def test_best_fit_choice_and_downsizing():
    # 5 opens a bin of 8, 4 another; 3 fits the room of 3 best
    assert P.pack([5, 4, 3], (8,)) == [(0, 8, 0), (1, 8, 0), (0, 8, 5)]
    assert P.pack([2], (4, 8)) == [(0, 4, 0)]
    assert P.pack([], (4, 8)) == []


def test_ties_hot_ids_and_empty_table(spark, docs_of):
    rows = P.best_fit(docs_of([(7, "a b c d")] * 200), shard_pieces=50).collect()
    assert len(rows) == 200 and len({r.bin_id.split("-")[0] for r in rows}) == 4
    _invariants(rows)
    assert P.best_fit(docs_of([])).count() == 0


def test_word_count(spark, docs_of):
    texts = [None, "", "  a ", "a\tb\x0bc\n\nd", "  é", "x" * 100_000]
    rows = docs_of(list(enumerate(texts))).select("doc_id", P.word_count(F.col("text")).alias("n")).collect()
    assert {r.doc_id: r.n for r in rows} == {i: len((t or "").encode().split()) for i, t in enumerate(texts)}
