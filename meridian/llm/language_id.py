"""Language identification with language-bitmask n-gram filters.

Training counts character trigrams per language over all labelled training texts. A
language contains a trigram if the trigram's relative frequency there is at least
``MIN_SHARE`` of its highest among the languages (and it was seen ``MIN_COUNT`` times and
is at least ``MIN_RATE`` of the language's trigrams, so that a language contains 1 / ``MIN_RATE``
at most, however long its texts).
All languages share one bit-sliced Bloom filter: each slot holds a bitmask of languages (63
to a word, as many words as needed), and the conjunction of a trigram's ``PROBES`` slots is
the set of languages that contain it. The filter has ``PROBES`` slots for each trigram of the
largest language at least (a false-positive rate of 0.16 at most), never less than ``SLOTS``.
A text's popcount per language is corrected for that language's false-positive rate; the
highest decides.

Defined results: null texts and texts without a letter are ``und`` with score 0; with
letters but no trigram known beyond chance the language with most training trigrams is given
with score 0; without any training language everything is ``und``; ties go to the smaller language
value; a null id is neither held out nor learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import mix64, signed, written

GRAM = 3
#: slots of the filter at least
SLOTS = 1 << 20
PROBES = 4
MIN_COUNT = 3
MIN_SHARE = 0.3
MIN_RATE = 2.0 ** -22
#: trigrams a task holds per language before it passes its counts on
TASK_GRAMS = 1 << 18
#: languages of one word of a slot's mask
WORD_LANGUAGES = 63


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def folded(text: str | None) -> np.ndarray:
    """Lower-cased code points with runs of non-letters as one space, a space at both ends."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    padded = np.full(len(points) + 2, 32, dtype=np.uint64)
    padded[1:-1] = np.where(_letters()[points], points, 32)
    return padded[np.r_[True, (padded[1:] != 32) | (padded[:-1] != 32)]]


def trigrams(points: np.ndarray) -> np.ndarray:
    if len(points) < GRAM:
        return np.empty(0, dtype=np.uint64)
    return points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]


def slots(grams: np.ndarray, size: int = SLOTS) -> Iterator[np.ndarray]:
    """The ``PROBES`` slots of each trigram (double hashing) in a filter of ``size`` slots, a power of two."""
    h = mix64(grams + np.uint64(1))
    step = h >> np.uint64(32) | np.uint64(1)
    for j in range(PROBES):
        yield (h + np.uint64(j) * step) & np.uint64(size - 1)


def _counts(train: DataFrame) -> DataFrame:
    """``lang, gram, c``: trigram counts, summed within each task first."""

    def out(lang: str, h: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(h), pa.string()), pa.array(signed(h)),
                                           pa.array(c.astype(np.int64))], names=["lang", "gram", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(lang, []).append(trigrams(folded(text)))
            for lang, parts in found.items():
                h, c = np.unique(np.concatenate(parts), return_counts=True)
                old_h, old_c = held.get(lang, (h[:0], c[:0]))
                both, at = np.unique(np.concatenate([old_h, h]), return_inverse=True)
                total = np.bincount(at, weights=np.concatenate([old_c, c]), minlength=len(both)).astype(np.int64)
                if len(both) > TASK_GRAMS:
                    yield out(lang, both, total)
                    both, total = both[:0], total[:0]
                held[lang] = both, total
        for lang, (h, c) in held.items():
            yield out(lang, h, c)

    partial = train.select("lang", "text").mapInArrow(run, "lang string, gram long, c long")
    return partial.groupBy("lang", "gram").agg(F.sum("c").alias("c"))


def fit(spark: SparkSession, train: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, int]:
    """Languages (in order), the bit-sliced filter (slots by words), the false-positive rate per
    language and the place of the language with most trigrams.

    The driver receives one row per language and at most one mask for each slot and word.
    """
    counts = written(spark, _counts(train), "lang-counts")
    totals = counts.groupBy("lang").agg(F.sum("c").alias("total")).orderBy("lang").collect()
    langs = [r.lang for r in totals]
    if not langs:
        return langs, np.zeros((SLOTS, 1), dtype=np.uint64), np.zeros(0), 0
    place = F.element_at(F.create_map(*[F.lit(v) for i, r in enumerate(totals) for v in (r.lang, i)]), F.col("lang"))
    total = F.element_at(F.create_map(*[F.lit(v) for r in totals for v in (r.lang, float(r.total))]), F.col("lang"))
    rated = counts.select("gram", "c", place.alias("place"), (F.col("c") / total).alias("rate"))
    high = rated.groupBy("gram").agg(F.max("rate").alias("high"))
    admitted = written(spark, rated.join(high, "gram").where(
        (F.col("c") >= MIN_COUNT) & (F.col("rate") >= MIN_RATE) & (F.col("rate") >= MIN_SHARE * F.col("high")))
        .select("gram", "place"), "lang-grams")
    most = admitted.groupBy("place").count().agg(F.max("count")).first()[0] or 0
    size = max(SLOTS, 1 << (PROBES * most - 1).bit_length() if most else 1)
    masks = (admitted.groupBy("gram", F.expr(f"place div {WORD_LANGUAGES}").cast("int").alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, place % {WORD_LANGUAGES})")).alias("mask")))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in slots(grams, size):
                yield pa.RecordBatch.from_arrays([pa.array(signed(at)), batch.column(1), batch.column(2)],
                                                 names=["slot", "word", "mask"])

    cells = masks.mapInArrow(spread, "slot long, word int, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
    got = cells.toArrow()
    table = np.zeros((size, -(-len(langs) // WORD_LANGUAGES)), dtype=np.uint64)
    table[got.column("slot").to_numpy(), got.column("word").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
    fill = np.array([float(_bits(table, i).mean()) for i in range(len(langs))])
    return langs, table, fill ** PROBES, max(range(len(langs)), key=lambda i: totals[i].total)


def _bits(masks: np.ndarray, place: int) -> np.ndarray:
    """The bit of one language in masks of one or more words."""
    return masks[:, place // WORD_LANGUAGES] >> np.uint64(place % WORD_LANGUAGES) & np.uint64(1)


def classify(points: np.ndarray, table: np.ndarray, miss: np.ndarray) -> np.ndarray:
    """Corrected popcount per language of one folded text."""
    table = table.reshape(len(table), -1)
    grams = trigrams(points)
    mask = np.full((len(grams), table.shape[1]), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in slots(grams, len(table)):
        mask &= table[at]
    hits = np.array([int(_bits(mask, i).sum()) for i in range(len(miss))], dtype=float)
    return np.maximum(0.0, (hits - len(grams) * miss) / (1 - np.minimum(miss, 0.999999)))


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, held_out, lang_pred, score``; held-out rows and labels are never learned from."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    train = docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    model = spark.sparkContext.broadcast(fit(spark, train.select("lang", "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, slots_, rates, most = model.value
        for batch in batches:
            preds, scores = [], []
            for text in batch.column(2).to_pylist():
                points = folded(text)
                if not names or len(points) < 2 or not (points != 32).any():
                    preds.append("und")
                    scores.append(0.0)
                    continue
                found = classify(points, slots_, rates)
                total = found.sum()
                best = int(found.argmax()) if total else most
                preds.append(names[best])
                scores.append(float(found[best] / total) if total else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(preds, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double"))
