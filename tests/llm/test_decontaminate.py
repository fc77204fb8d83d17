import hashlib
import random
import re

import numpy as np

from meridian.llm import decontaminate as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(text, items):
    w, hit, found = _words(text), set(), set()
    for item, t in items:
        v = _words(t)
        n = min(13, len(v))
        grams = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for p in range(len(w) - n + 1) if n else []:
            if tuple(w[p:p + n]) in grams:
                hit |= set(range(p, p + n))
                found.add(item)
    ids = ",".join(sorted(str(i) for i in found if i is not None))
    return len(w), len(hit), len(found - {None}), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def _check(spark, docs_of, docs, items):
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, fp string")
    got = D.decontaminate(spark, docs_of(docs), bench).collect()
    want = sorted((repr(i), *brute(t, items)) for i, t in docs)
    assert sorted((repr(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == want
    for r in got:
        assert sum(s.end - s.start for s in r.spans or []) == r.n_hit


def test_against_brute_force(spark, docs_of, prose):
    rng = random.Random(3)
    items = [(i, " ".join(prose(rng.choice([1, 2, 5, 12, 13, 14, 30, 60]), seed=100 + i))) for i in range(25)]
    items += [(40, items[6][1]), (41, items[7][1].upper() + "!"), (None, items[8][1]), (42, None), (43, "..."), (6, items[6][1])]
    docs = []
    for i in range(150):
        w = prose(rng.choice([0, 3, 12, 13, 40, 300]), seed=i)
        for _ in range(rng.randrange(3)):
            v = _words(rng.choice(items)[1])
            a = rng.randrange(len(v) + 1)
            at = rng.randrange(len(w) + 1)
            w[at:at] = v[a:a + rng.choice([5, 12, 13, 20, 60])]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w)))
    docs += [(0, docs[0][1]), (None, docs[5][1]), (None, None), (900, ""), (901, "a " * 50_000 + items[9][1])]
    _check(spark, docs_of, docs, items)


def test_repeated_words_and_empty_tables(spark, docs_of):
    items = [(1, "x " * 20), (2, "x y " * 10)]
    _check(spark, docs_of, [(1, "x " * 40), (2, "y x " * 9), (3, "x " * 12), (4, "x " * 13)], items)
    _check(spark, docs_of, [], items)
    _check(spark, docs_of, [(1, "a b"), (2, None)], [])


def test_winnowing_meets_in_every_window():
    rng = np.random.default_rng(1)
    for _ in range(200):
        grams = rng.integers(0, 9, rng.integers(0, 40)).astype(np.uint64)
        at = set(D.winnow(grams).tolist())
        for i in range(len(grams) - D.SPAN + 1):
            window = grams[i:i + D.SPAN]
            rightmost = i + D.SPAN - 1 - int(window[::-1].argmin())
            assert rightmost in at
