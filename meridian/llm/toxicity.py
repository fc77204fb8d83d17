"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is lower-cased and its white space folded; its features are the character n-grams of
``ORDERS`` that do not run across a space, each present or absent, hashed into ``SPACE``
buckets. From the labelled texts each bucket gets the ratio ``log((p/|p|) / (q/|q|))`` of its smoothed
document counts among toxic and other texts; the ``FEATURES`` buckets that tell the classes
apart best (chi-square over the counts) are kept, and a logistic model with an L2 penalty is
fitted to their presences times their ratios. A score is the model's chance of label 1.

Only fitting uses a sample: the labelled documents outside the held-out fold, ``max_labelled``
of them at most in the mean, drawn by a hash of the id, one text each. Every document is
scored, on its whole text; scoring sums one fixed table of weights and sees nothing but the text.

Defined results: null and empty texts have no features and score the model's base chance; an
id labelled more than once counts as its majority (a tie is toxic), null labels and ids do
not count; an id with several texts is learned with the smallest one; a null id is not held out; without labels of both
classes every score is 0; repeated rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import mix64, written

ORDERS = range(3, 10)
SPACE = 22  # bits of a bucket
FEATURES = 1 << 12
MAX_LABELLED = 20_000
#: smoothing of the counts; documents a bucket must occur in
ALPHA, MIN_DOCS = 1.0, 3
THRESHOLD = 0.3
PENALTY = 1e-3
#: the fold that is never learned from
FOLDS, HELD_OUT = 4, 2
#: tasks that read the bounded sample
TASKS = 4
_BASE = np.uint64(0x9E3779B97F4A7C15)


def grams(text: str | None) -> np.ndarray:
    """Buckets of the n-grams of a text, with repetitions; a space stands before and after every word."""
    words = (text or "").lower().split()
    if not words:
        return np.empty(0, dtype=np.int64)
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    spaces = np.cumsum(points == 32)
    out, rolled = [], points
    for k in range(2, max(ORDERS) + 1):
        rolled = rolled[:-1] * _BASE + points[k - 1:]
        if k in ORDERS:
            inner = spaces[k - 2:len(rolled) + k - 2] - spaces[:len(rolled)]  # spaces at places 1 to k - 2 of each n-gram
            out.append(mix64(rolled[inner == 0] + np.uint64(k)))
        if len(rolled) < 2:
            break
    return (np.concatenate(out) >> np.uint64(64 - SPACE)).astype(np.int64)


def _held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: Column, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``label, text`` of the documents learned from, one row an id; ids are drawn before any text is read."""
    known = labels.where(label.isNotNull() & F.col("doc_id").isNotNull() & ~_held_out()).groupBy("doc_id").agg(
        (F.avg(label.cast("double")) >= 0.5).cast("double").alias("label"))
    known = written(spark, known, "toxicity-labels")
    share = int((1 << 32) * min(1.0, max_labelled / max(known.count(), 1)))
    drawn = written(spark, known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < share), "toxicity-drawn")
    # about max_labelled narrow rows: safe to broadcast
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return written(spark, one.select("label", "text").repartition(TASKS), "toxicity-sample")


def ratios(rows: DataFrame, features: int) -> dict[int, float]:
    """Log-count ratios of the buckets that tell the classes apart best (at most ``features``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 1 << SPACE), dtype=np.int32)
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[int(label), np.unique(grams(text))] += 1
        seen = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(held[1, seen], pa.int64()), pa.array(held[0, seen], pa.int64())],
                                         names=["bucket", "p", "q"])

    counts = rows.mapInArrow(run, "bucket long, p long, q long").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    counts = written(rows.sparkSession, counts, "toxicity-counts")
    n = rows.agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q")).first()
    total = counts.agg(F.sum(F.col("p") + ALPHA).alias("p"), F.sum(F.col("q") + ALPHA).alias("q")).first()
    p, q = F.col("p"), F.col("q")
    of_p, of_q, all_ = p / n.p, q / n.q, (p + q) / (n.p + n.q)
    told = (of_p - of_q) * (of_p - of_q) / (all_ * (1 - all_) + 1e-12)
    best = (counts.where(p + q >= MIN_DOCS)
            .select("bucket", F.log((p + ALPHA) / total.p / ((q + ALPHA) / total.q)).alias("r"), told.alias("t"))
            .orderBy(F.desc("t"), "bucket").limit(features))
    return {r.bucket: r.r for r in best.collect()}


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: Column,
        max_labelled: int = MAX_LABELLED) -> tuple[np.ndarray, float] | None:
    """The weight of every bucket and the intercept; None without labels of both classes."""
    rows = sample(spark, docs, labels, label, max_labelled)
    if rows.select("label").distinct().count() < 2:
        return None
    scaled = ratios(rows, FEATURES)
    buckets = np.array(sorted(scaled), dtype=np.int64)
    scale = np.array([scaled[b] for b in buckets.tolist()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.intersect1d(grams(t), buckets, return_indices=True)[2] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["label", "at"])

    vector = F.udf(lambda at: Vectors.sparse(len(buckets), at, scale[at]), VectorUDT())
    train = rows.mapInArrow(run, "label double, at array<int>").select("label", vector("at").alias("features"))
    train = train.persist()
    model = LogisticRegression(maxIter=60, regParam=PENALTY, standardization=False, tol=1e-6).fit(train)
    train.unpersist()
    weights = np.zeros(1 << SPACE, dtype=np.float32)
    weights[buckets] = model.coefficients.toArray() * scale
    return weights, float(model.intercept)


def chance(text: str | None, weights: np.ndarray, intercept: float) -> float:
    found = grams(text)
    z = intercept + float(weights[np.unique(found[weights[found] != 0])].sum(dtype=np.float64))
    return 1 / (1 + math.exp(-max(min(z, 500.0), -500.0)))


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: Column | None = None,
          threshold: float = THRESHOLD, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; ``label`` defaults to ``toxic``."""
    model = spark.sparkContext.broadcast(fit(spark, docs, labels, F.col("toxic") if label is None else label, max_labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            scores = [0.0] * len(texts) if fitted is None else [chance(t, *fitted) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", _held_out().alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int")
