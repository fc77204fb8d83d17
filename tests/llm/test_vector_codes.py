import hashlib
import math
import random

import numpy as np
import pytest

from meridian.llm import vector_codes as V

SHAPE = "vec_id long, embedding array<float>, label int, code string, error int, v string"


def _plain_version(rows, parts=8, entries=16, rounds=6):
    """Python integers only."""
    kept = [(i, [math.floor(4096 * x) for x in e], l) for i, e, l in rows if e and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = [near(c[p], books[p])[1] for c in cut]
            for k in range(len(books[p])):
                got = [c[p] for c, m in zip(cut, mine, strict=True) if m == k]
                if got:
                    books[p][k] = [sum(col) // len(got) for col in zip(*got, strict=True)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, l), e in zip(kept, errors, strict=True):
        by_label[l] = by_label.get(l, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{k:02x}" for _, k in f), e, by_label[l], digest)
                  for (i, _, l), f, e in zip(kept, found, errors, strict=True))


def _got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SHAPE).repartition(3)
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in V.compress(spark, df).collect())


def _f32(x):
    return float(np.float32(x))


def test_against_python_integers(spark):
    rng = random.Random(2)
    rows = [(i * 3, [_f32(rng.gauss(0, 1)) for _ in range(32)], rng.choice([None, 1, 2])) for i in range(150)]
    rows += [(5, None, 1), (6, [], 1), (7, [1.0] * 31 + [None], 1), (8, [float("nan")] * 32, 2), (9, [float("inf")] + [0.0] * 31, 2)]
    rows += [rows[0], (rows[1][0], rows[2][1], 1), (None, rows[4][1], None)]
    assert _got(spark, rows) == _plain_version(rows)


def test_ties_few_vectors_and_empty(spark):
    same = [(i, [0.5] * 8, 1) for i in range(20)]
    assert _got(spark, same) == _plain_version(same) and {r[1] for r in _got(spark, same)} == {"00" * 8}
    few = [(3, [1.0, -1.0] * 8, None), (1, [2.0, -2.5] * 8, None), (2, [0.0] * 16, 4)]
    assert _got(spark, few) == _plain_version(few)
    assert _got(spark, []) == [] and _got(spark, [(1, None, 1)]) == []


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    top = V.largest(16) / 4096
    rows = [(i, [_f32(rng.uniform(-0.99, 0.99) * top) for _ in range(16)], i % 2) for i in range(60)]
    assert _got(spark, rows) == _plain_version(rows)


def test_vectors_that_cannot_be_coded_are_dropped(spark):
    good = [(i, [float(i)] * 8, 1) for i in range(5)]
    bad = [(10, [1.0] * 16, 1), (0, [1.0] * 9, 1), (11, [3e38] * 8, 1)]
    assert _got(spark, good + bad) == _plain_version(good)
    with pytest.raises(ValueError):
        V.compress(spark, spark.createDataFrame([], SHAPE), entries=257)


@pytest.mark.parametrize("size", [10, 2 ** 20, 2 ** 26, 2 ** 27])
def test_products_are_exact_beyond_53_bits(size):
    rng = np.random.default_rng(size)
    x, e = rng.integers(-size, size + 1, (8, 50, 8)), rng.integers(-size, size + 1, (8, 16, 8))
    want = np.einsum("prw,pew->pre", x.astype(object), e.astype(object))
    assert (V.exact_dots(x, e) == want).all()
    bits = V.limb_bits(8)
    for y in (x, e):
        pieces = V.limbs(y, bits)
        assert all(abs(p).max() < 2 ** bits for p in pieces) and 8 * (2 ** bits - 1) ** 2 < 2 ** 53
        assert (sum(p.astype(np.int64) << (bits * i) for i, p in enumerate(pieces)) == y).all()
