"""Benchmark decontamination by winnowing.

Both sides keep the minimum ``GRAM``-word hash of every ``WINDOW - GRAM + 1`` consecutive
grams, so any ``WINDOW`` consecutive words that both sides share leave a common
fingerprint. Document fingerprints are first tested against a fixed-size Bloom bitmap of
the benchmark's, then joined with them, and every joined hit is extended word by word
inside its context; only runs of a whole window count. Items of fewer than ``WINDOW``
words are one window each and use a fingerprint of the whole item.

Defined results: a null or wordless text has no words, no hits and is clean; repeated rows
get equal results; null item ids hit but are not listed; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import digest16, gram_hashes, mix64, signed, utf8_values, word_hashes, written

WINDOW = 13
GRAM = 7
SPAN = WINDOW - GRAM + 1
#: words kept around a fingerprint: every window that holds the gram lies inside
REACH = WINDOW - GRAM
CONTEXT = REACH + WINDOW
#: bits of the Bloom bitmap (fixed, so the broadcast is 512 KiB at any size)
BLOOM_BITS = 1 << 22

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))

_DOC_SCHEMA = "key long, digest binary, n_words long, hits array<struct<fp: long, win: int, pos: long, ctx: binary>>"
_HIT = pa.struct([("fp", pa.int64()), ("win", pa.int32()), ("pos", pa.int64()), ("ctx", pa.binary())])


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def winnow(grams: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Positions of the rightmost minimum of every ``span`` consecutive grams."""
    if not len(grams):
        return np.empty(0, dtype=np.int64)
    if len(grams) <= span:
        return np.array([len(grams) - 1 - int(grams[::-1].argmin())], dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams, span)
    return np.unique(np.arange(len(view)) + span - 1 - view[:, ::-1].argmin(axis=1))


def _contexts(hashes: np.ndarray, at: np.ndarray, outside: int) -> np.ndarray:
    padded = np.full(len(hashes) + 2 * CONTEXT, outside, dtype=np.uint64)
    padded[CONTEXT:CONTEXT + len(hashes)] = hashes
    return padded[(at + CONTEXT - REACH)[:, None] + np.arange(CONTEXT)[None, :]]


def _whole(hashes: np.ndarray, length: int) -> np.ndarray:
    return mix64(gram_hashes(hashes, length) + np.uint64(length))


def _bits(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return fps % np.uint64(BLOOM_BITS), (fps >> np.uint64(32)) % np.uint64(BLOOM_BITS)


def item_fingerprints(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per fingerprint of every item: ``item_id, fp, win, ctx``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fps, wins, ctxs = [], [], [], []
            for item, text in zip(batch.column(0).to_pylist(), utf8_values(batch.column(1)), strict=True):
                hashes = word_hashes(words(text or b""))
                if not len(hashes):
                    continue
                if len(hashes) < WINDOW:
                    win, at, found = len(hashes), np.zeros(1, dtype=np.int64), _whole(hashes, len(hashes))
                else:
                    grams = gram_hashes(hashes, GRAM)
                    win, at = WINDOW, winnow(grams)
                    found = grams[at]
                ctx = _contexts(hashes, at, outside=1)
                ids += [item] * len(at)
                fps += signed(found).tolist()
                wins += [win] * len(at)
                ctxs += [row.tobytes() for row in ctx]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, type=batch.schema.field(0).type), pa.array(fps, pa.int64()),
                 pa.array(wins, pa.int32()), pa.array(ctxs, pa.binary())], names=["item_id", "fp", "win", "ctx"])

    source = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    kind = source.schema["item_id"].dataType.simpleString()
    return source.mapInArrow(run, f"item_id {kind}, fp long, win int, ctx binary")


def _bloom(fingerprints: DataFrame) -> np.ndarray:
    """The bitmap of all fingerprints: at most ``BLOOM_BITS / 64`` long values reach the driver."""
    low = F.pmod(F.col("lo"), F.lit(BLOOM_BITS))
    high = F.pmod(F.col("hi"), F.lit(BLOOM_BITS))
    cells = (fingerprints.select(F.col("fp").alias("lo"), F.shiftrightunsigned("fp", 32).alias("hi"))
             .select(F.explode(F.array(low, high)).alias("bit"))
             .groupBy(F.shiftright("bit", 6).alias("cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask")))
    out = np.zeros(BLOOM_BITS // 64, dtype=np.uint64)
    for cell, mask in cells.collect():
        out[cell] = np.uint64(mask & 0xFFFFFFFFFFFFFFFF)
    return out


def _doc_rows(docs: DataFrame, bitmap, lengths: list[int]) -> DataFrame:
    """Per document: digest of its words, word count and the fingerprints the bitmap lets pass."""

    def known(fps: np.ndarray, bits: np.ndarray) -> np.ndarray:
        first, second = _bits(fps)
        six, low = np.uint64(6), np.uint64(63)
        return ((bits[first >> six] >> (first & low)) & (bits[second >> six] >> (second & low)) & np.uint64(1)) == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            digests, counts, hits = [], [], []
            for text in utf8_values(batch.column(2)):
                tokens = words(text or b"")
                hashes = word_hashes(tokens)
                rows: list[dict] = []
                probes = [(win, _whole(hashes, win), None) for win in lengths]
                grams = gram_hashes(hashes, GRAM)
                if len(hashes) >= WINDOW:
                    probes.append((WINDOW, grams, winnow(grams)))
                for win, fps, at in probes:
                    at = np.arange(len(fps)) if at is None else at
                    at = at[known(fps[at], bits)]
                    if len(at):
                        ctx = _contexts(hashes, at, outside=0)
                        rows += [{"fp": f, "win": win, "pos": p, "ctx": c.tobytes()}
                                 for f, p, c in zip(signed(fps[at]).tolist(), at.tolist(), ctx, strict=True)]
                digests.append(digest16(b" ".join(tokens)))
                counts.append(len(tokens))
                hits.append(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(counts, pa.int64()),
                 pa.array(hits, pa.list_(_HIT))], names=["doc_id", "key", "digest", "n_words", "hits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("key"), "text").mapInArrow(run, f"doc_id {kind}, {_DOC_SCHEMA}")


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grow each joined hit to the left and right while the words agree; keep whole windows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        win = batch.column("win").to_numpy(zero_copy_only=False)
        pos = batch.column("pos").to_numpy(zero_copy_only=False)
        sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint64).reshape(-1, CONTEXT)
                 for c in ("ctx", "item_ctx")]
        same = sides[0] == sides[1]
        left = np.cumprod(same[:, REACH - 1::-1], axis=1).sum(axis=1)
        right = np.cumprod(same[:, REACH:], axis=1).sum(axis=1)
        short = win < WINDOW
        left = np.where(short, 0, left)
        right = np.where(short, np.minimum(right, win), right)
        core = np.where(short, win, GRAM)
        keep = (right >= core) & (left + right >= win)
        index = pa.array(np.flatnonzero(keep))
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest").take(index), batch.column("item_id").take(index),
             pa.array((pos - left)[keep], pa.int64()), pa.array((pos + right)[keep], pa.int64())],
            names=["digest", "item_id", "start", "end"])


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: ``doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated, spans``.

    ``key`` is the text's xxhash64, ``spans`` are the merged word ranges (end exclusive) covered by benchmark windows.
    """
    items = written(spark, item_fingerprints(benchmark), "decontam-items")
    lengths = sorted(r.win for r in items.select("win").distinct().collect() if r.win < WINDOW)
    bitmap = spark.sparkContext.broadcast(_bloom(items))
    rows = written(spark, _doc_rows(docs, bitmap, lengths), "decontam-docs")

    # copies of a text share one digest: each text is looked up once
    found = (rows.where(F.size("hits") > 0)
             .select("digest", F.explode("hits").alias("h"))
             .select("digest", "h.fp", "h.win", "h.pos", "h.ctx").dropDuplicates(["digest", "win", "pos"]))
    matched = (found.join(items.select("item_id", "fp", "win", F.col("ctx").alias("item_ctx")).distinct(),
                          ["fp", "win"])
               .select("digest", "item_id", "win", "pos", "ctx", "item_ctx"))
    kind = items.schema["item_id"].dataType.simpleString()
    extended = matched.mapInArrow(_extend, f"digest binary, item_id {kind}, start long, end long")
    extended = written(spark, extended, "decontam-hits")

    spans = (extended.groupBy("digest", "start").agg(F.max("end").alias("end"))
             .groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("s")))
    merged = F.aggregate(
        "s", F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                     F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"),
                                      F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(x))))
    spans = spans.select("digest", merged.alias("spans"))
    listed = (extended.where(F.col("item_id").isNotNull()).select("digest", F.col("item_id").cast("string").alias("i"))
              .distinct().groupBy("digest").agg(F.array_sort(F.collect_list("i")).alias("items")))
    result = spans.join(listed, "digest", "left")
    n_hit = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]),
                       F.lit(0).cast("long"))
    items_list = F.coalesce("items", F.expr("cast(array() as array<string>)"))
    return (rows.select("doc_id", "key", "digest", "n_words").join(result, "digest", "left")
            .select("doc_id", "key", "n_words", n_hit.alias("n_hit"), items_list.alias("items"), "spans")
            .select("doc_id", "key", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
                    "spans"))
