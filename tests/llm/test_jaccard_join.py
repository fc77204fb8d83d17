import random
import re

import numpy as np
import pyarrow as pa
import pytest

from meridian.llm import jaccard_join as J
from meridian.llm.components import components


def _set(text):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    sets = [_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((repr(d), len(s), repr(low.get(find(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(docs, sets)))


def _check(spark, docs_of, docs):
    got = J.jaccard_join(spark, docs_of(docs)).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id)) for r in got) == brute(docs)


def _near(words, changes, rng):
    w = list(words)
    for _ in range(changes):
        i = rng.randrange(len(w))
        w[i:i + rng.randrange(2)] = [f"n{rng.randrange(1000)}"] * rng.randrange(1, 3)
    return w


@pytest.mark.parametrize("rounds", [1, 0])
def test_against_brute_force(spark, docs_of, prose, rounds, monkeypatch):
    monkeypatch.setattr(J, "ROUNDS", rounds)  # 0: the completing round alone finds everything
    rng = random.Random(5)
    docs, common = [], prose(40, seed=999)
    for i in range(140):
        n = rng.choice([1, 3, 4, 5, 7, 8, 9, 12, 20, 60, 200])
        base = prose(n, seed=rng.randrange(25) * 1000 + n)  # bases repeat
        w = _near(base, rng.choice([0, 0, 1, 1, 2, 4, 9]), rng)
        if rng.random() < 0.3:
            w += common
        docs.append((i, " ".join(w)))
    docs += [(3, docs[3][1]), (None, docs[4][1]), (None, None), (700, ""), (701, " \t\n"), (702, docs[9][1].upper())]
    _check(spark, docs_of, docs)


def test_one_large_group_and_a_chain(spark, docs_of, prose):
    rng = random.Random(8)
    base = prose(150, seed=77)
    docs = [(1000 - i, " ".join(_near(base, 2, rng))) for i in range(80)]
    docs += [(2000 + i, " ".join(prose(100, seed=5)[i * 3:] + prose(60, seed=6)[:i * 3])) for i in range(18)]
    _check(spark, docs_of, docs)


def test_boundary_similarity_long_texts_and_empty_table(spark, docs_of):
    a = [f"a{i}" for i in range(7)]  # 3 shingles; one more word gives 4: exactly 0.75
    docs = [(1, " ".join(a)), (2, " ".join([*a, "b"])), (3, " ".join([*a, "b", "c", "d"]))]
    _check(spark, docs_of, docs)
    long = [f"w{i}" for i in range(60_000)]
    _check(spark, docs_of, [(1, " ".join(long)), (2, " ".join(long[:50_000])), (3, " ".join(long[:30_000])), (4, "x " * 99_999)])
    _check(spark, docs_of, [])


def test_shared_entries_do_not_depend_on_batches():
    rng = np.random.default_rng(4)
    for trial in range(300):
        rows = sorted((int(h), int(s), int(i) % 2, int(i)) for h, s, i in rng.integers(0, [4, 2, 6], (rng.integers(0, 30), 3)))
        lists = {}
        for h, s, n, i in rows:
            lists.setdefault((h, s), []).append(i)
        batches, at = [], 0
        while at < len(rows):
            size = int(rng.integers(1, 6))
            part = rows[at:at + size]
            at += size
            batches.append(pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int32()),
                 pa.array([r[3] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.int32()),
                 pa.array([0] * len(part), pa.int32())], names=["h", "salt", "sid", "n", "pos"]))
        got = [(h, i, n) for b in J._shared(iter(batches)) for h, i, n, _ in zip(*(c.to_pylist() for c in b.columns))]
        assert sorted(got) == sorted((h, i, n) for h, s, n, i in set(rows) if s > 0 or len(set(lists[h, s])) > 1), trial


def test_dealt_lists_lose_nothing(spark, docs_of, prose, monkeypatch):
    monkeypatch.setattr(J, "SUBLIST", 3)
    rng = random.Random(2)
    base = prose(60, seed=1)
    _check(spark, docs_of, [(i, " ".join(_near(base, rng.choice([1, 3]), rng))) for i in range(60)])


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(7, 7), (9, 8)]
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    assert got == {x: find(x) for x in root}
    assert components(spark, spark.createDataFrame([], "u long, v long")).count() == 0


def test_cost_chooses_the_boundary():
    few = {10: 100, 40: 100}
    assert J.boundary(few, scan=0.0) == J.BOUNDARIES[0]
    assert J.boundary(few, scan=1000.0) > 40


def test_bitmaps_never_rule_out_a_link(spark):
    rng = np.random.default_rng(4)
    rows, linked = [], {}
    for k in range(300):
        n = int(rng.integers(3, 700)) if k % 20 else 9000
        a = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        lost, new = (int(rng.integers(0, n // 3 + 1)) for _ in range(2))
        b = np.concatenate([a[lost:], rng.integers(0, 2 ** 63, new).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        common = len(np.intersect1d(a, b))
        linked[2 * k] = 100 * common >= 75 * (len(a) + len(b) - common)
        rows += [(2 * k, len(a), J.parity(a)), (2 * k + 1, len(b), J.parity(b))]
    bits = spark.createDataFrame(rows, "sid long, n long, bits array<long>")
    pairs = spark.createDataFrame([(u, u + 1) for u in linked], "u long, v long")
    kept = {r.u for r in J._possible(pairs, bits).collect()}
    assert all(u in kept for u, yes in linked.items() if yes)
    apart = [u for u, yes in linked.items() if not yes]
    assert len(apart) > 50 and len([u for u in apart if u in kept]) < len(apart)
