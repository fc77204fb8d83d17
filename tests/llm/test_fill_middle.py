import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from meridian.llm import fill_middle as M


def _plain_version(doc_id, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def _texts():
    rng = random.Random(5)
    letters = "ab \n<>PSM/é߀漢🤦́\U0010ffff\x00"
    out = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 7, 8, 9, 31, 200]))) for _ in range(300)]
    return [*out, None, "", " ", "🤦" * 9, "a<P>b", "<S>", "x<M", "<", "é", "<<S", "漢" * 50_000, "z" * 1_000_000]


def test_against_plain_version_and_back(spark, docs_of):
    texts = _texts()
    rows = [*enumerate(texts), (7, texts[7]), (7, "other text"), (None, "no id at all"), (2 ** 62, "far id")]
    made = M.fill_middle(docs_of(rows))
    got = made.withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    want = sorted((str(i), t or "", *map(str, _plain_version(i, t))) for i, t in rows)
    assert sorted((str(r.doc_id), r.back, str(r.n), r.form, str(r.prefix_chars), str(r.middle_chars), r.output) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_parameters_and_empty_table(spark, docs_of):
    docs = docs_of([(i, "some words here") for i in range(50)])
    assert {r.form for r in M.fill_middle(docs, plain=0, suffix_first=100).collect()} == {"spm"}
    assert {r.form for r in M.fill_middle(docs, plain=100).collect()} == {"plain"}
    assert M.fill_middle(docs).collect() != M.fill_middle(docs, seed=2).collect()
    assert M.fill_middle(docs_of([])).count() == 0


def test_rank_and_select_at_every_place():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aé漢🤦") for _ in range(rng.randint(0, 40))).encode() for _ in range(60)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ends = M.ending_marks(data, bounds)
    sums = np.concatenate([[0], np.cumsum(np.bitwise_count(ends), dtype=np.int64)])
    stops = [i + 1 for i in range(len(data)) if i + 1 == len(data) or data[i + 1] & 0xC0 != 0x80]
    assert M.select(ends, sums, np.arange(1, len(stops) + 1)).tolist() == stops
    assert M.rank(ends, sums, np.arange(len(data) + 1)).tolist() == [sum(s <= b for s in stops) for b in range(len(data) + 1)]


def test_sliced_batches_and_stray_bytes():
    texts = pa.array(["skip", "né", None, "漢字"]).slice(1)
    h = np.array([2, 0, 1]), np.array([1, 0, 5])
    n, cuts, raw, at = M.cut_batch(texts, *h)
    assert n.tolist() == [2, 0, 2] and cuts.tolist() == [[1, 0, 1], [2, 0, 2]]
    assert raw == ["né".encode(), b"", "漢字".encode()] and at == [(1, 3), (0, 0), (3, 6)]
    odd = pa.Array.from_buffers(pa.string(), 2, pa.array([b"ab", b"\x80\x80c"], pa.binary()).buffers())
    assert M.cut_batch(odd, np.array([0, 0]), np.array([0, 1]))[0].tolist() == [2, 2]
    assert M.cut_batch(pa.array([], pa.string()), np.array([], np.int64), np.array([], np.int64))[2] == []


def test_stray_bytes_come_through(spark, docs_of):
    docs = docs_of([(i, "x") for i in range(30)]).withColumn("text", F.unhex(F.lit("61FF8062")).cast("string"))
    made = M.fill_middle(docs)
    back = made.select(F.hex(M.restored(F.col("output"), F.col("form"))).alias("x"), "form").collect()
    assert len(back) == 30 and {r.x for r in back if r.form == "plain"} <= {"61FF8062"}
