"""Quality classifier by co-training.

Two logistic models look at different views of a document: one at statistics of its text,
one at its metadata (source, language, stated length), which never reads the text. Both
start from the labelled documents. In every round each model scores the unlabelled
documents and hands its confident pseudo-labels to the other. At the end each view is
calibrated (Platt scaling) on a fold of labelled documents that no round has seen, a last
logistic model combines the calibrated views, and the threshold is the highest one up to
0.5 that keeps ``KEEP`` of that fold's good documents.

Models, calibration and threshold come from all documents: every labelled one is fitted on or
calibrates, every other one is in the pool, and every document is scored, on its whole text. The
statistics of a text are counted once for fitting and written (13 numbers a document, no texts);
rounds are expressions over that table.

Defined results: a null text counts as empty; null metadata is a value of its own; several
labels of one id count as their majority (a tie is good); documents with one id are one row of the
fit; without labels of both classes
in both folds every document is accepted with score 1; repeated rows get equal scores.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions.ranking import row_index
from meridian.llm.common import written

ROUNDS = 3
CONFIDENT = 0.98
KEEP = 0.997
SOURCES, LANGUAGES = 16, 8
#: labelled documents whose id's checksum modulo 4 is 1 only calibrate
FOLDS, CALIBRATION = 4, 1


def text_view(text: str | None) -> list[float]:
    """Statistics of the text: vocabulary, repetition, character classes and line structure."""
    text = text or ""
    tokens = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n, m = max(len(text), 1), max(len(tokens), 1)
    counts = Counter(tokens)
    grams = len(set(zip(tokens, tokens[1:], tokens[2:], strict=False))) / max(len(tokens) - 2, 1)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ascii_counts = np.bincount(np.minimum(points, 128), minlength=129)
    upper, lower = int(ascii_counts[65:91].sum()), int(ascii_counts[97:123].sum())
    marks = int(ascii_counts[33:48].sum() + ascii_counts[58:65].sum() + ascii_counts[91:97].sum() + ascii_counts[123:127].sum())
    return [len(counts) / m, max(counts.values(), default=0) / m, min(grams, 1.0), min(sum(map(len, tokens)) / m, 40.0),
            upper / max(upper + lower, 1), int(ascii_counts[48:58].sum()) / n, int(ascii_counts[33]) / n,
            int(ascii_counts[124]) / n, marks / n, int(ascii_counts[128]) / n, 1 - len(set(lines)) / max(len(lines), 1),
            min(len(lines) / m, 1.0), sum(1 for t in tokens if len(t) <= 3) / m]


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    """Stated length and hashed one-hot source and language."""
    size = math.log1p(max(n_chars or 0, 0))
    out = [size, size * size / 10, float(n_chars is None)] + [0.0] * (SOURCES + LANGUAGES)
    out[3 + zlib.crc32(repr(source).encode()) % SOURCES] = 1.0
    out[3 + SOURCES + zlib.crc32(repr(lang).encode()) % LANGUAGES] = 1.0
    return out


def _views(docs: DataFrame) -> DataFrame:
    """``doc_id, text_view, meta_view`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, source, lang, size = (batch.column(n).to_pylist() for n in ("text", "source", "lang", "n_chars"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(text_view, text), pa.list_(pa.float64())),
                 pa.array(map(meta_view, source, lang, size), pa.list_(pa.float64()))],
                names=["doc_id", "text_view", "meta_view"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, text_view array<double>, meta_view array<double>")


def _fit(rows: DataFrame, view: str, label: str) -> tuple[list[float], float]:
    """Weights and intercept of a logistic model; rows without the label are left out."""
    train = rows.where(F.col(label).isNotNull()).select(array_to_vector(view).alias("features"), F.col(label).alias("label"))
    model = LogisticRegression(maxIter=50, regParam=1e-4, tol=1e-7).fit(train)
    return [float(w) for w in model.coefficients], float(model.intercept)


def _margin(view: str, model: tuple[list[float], float]) -> Column:
    weights, intercept = model
    products = F.zip_with(view, F.array(*(F.lit(w) for w in weights)), lambda x, w: x * w)
    return F.aggregate(products, F.lit(intercept), lambda a, x: a + x)


def _chance(margin: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(margin, F.lit(500.0)), F.lit(-500.0))))


def _sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: Column) -> DataFrame:
    """The rows of the fit: every document with an id, its views and its label, if it has one. Views are taken before anything
    is grouped or joined, so no text moves."""
    known = labels.where(label.isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg(label.cast("double")) >= 0.5).cast("double").alias("label"))
    chosen = docs.where("doc_id is not null").select("doc_id", "text", "source", "lang", "n_chars")
    # one row an id, however often an id repeats (the smallest)
    single = _views(chosen).groupBy("doc_id").agg(F.min(F.struct("text_view", "meta_view")).alias("r"))
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS == CALIBRATION
    rows = single.join(known, "doc_id", "left").select("doc_id", "label", "r.*")
    return written(spark, rows.select("*", (fold & F.col("label").isNotNull()).alias("calibrates")), "cotrain-rows")


def _lowest(values: DataFrame, share: float) -> float:
    """The smallest value of the one column that at least ``share`` of the values do not exceed (exact: by rank)."""
    (name,) = values.columns
    rank = max(math.ceil(share * values.count()), 1) - 1
    return row_index(values, [], name, "rank").where(F.col("rank") == rank).first()[name]


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: Column) -> dict | None:
    """The fitted views, their calibration, the combination and the threshold; None without both classes."""
    rows = _sample(spark, docs, labels, label)
    classes = {(r.calibrates, r.label) for r in rows.where("label is not null").select("calibrates", "label").distinct().collect()}
    if len(classes) < 4:
        return None
    rows = rows.select("*", *(F.when(~F.col("calibrates"), F.col("label")).alias(n) for n in ("for_text", "for_meta")))
    for _ in range(ROUNDS):
        text, meta = _fit(rows, "text_view", "for_text"), _fit(rows, "meta_view", "for_meta")
        free = F.col("label").isNull()
        sure = {n: F.when(_chance(_margin(v, m)) >= CONFIDENT, 1.0).when(_chance(_margin(v, m)) <= 1 - CONFIDENT, 0.0)
                for n, v, m in (("for_meta", "text_view", text), ("for_text", "meta_view", meta))}
        # each view's confident labels go to the other; a label given once stays until the giver is sure of the opposite
        rows = rows.select("doc_id", "label", "text_view", "meta_view", "calibrates",
                           *(F.coalesce(F.when(free, sure[n]), F.col(n)).alias(n) for n in ("for_text", "for_meta")))
    text, meta = _fit(rows, "text_view", "for_text"), _fit(rows, "meta_view", "for_meta")
    held = written(spark, rows.where("calibrates").select(
        "label", F.array(_margin("text_view", text)).alias("t"), F.array(_margin("meta_view", meta)).alias("m")), "cotrain-held")
    scales = {v: _fit(held, v, "label") for v in ("t", "m")}
    both = held.select("label", F.array(_margin("t", scales["t"]), _margin("m", scales["m"])).alias("z"))
    mix = _fit(both, "z", "label")
    low = _lowest(written(spark, both.where("label = 1").select(_chance(_margin("z", mix)).alias("chance")), "cotrain-good"), 1 - KEEP)
    return {"text": text, "meta": meta, "t": scales["t"], "m": scales["m"], "mix": mix, "threshold": min(0.5, low)}


def _logistic(z: float) -> float:
    return 1 / (1 + math.exp(-max(min(z, 500.0), -500.0)))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: Column | None = None,
             keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, ``score, text_score, meta_score`` (calibrated chances of good quality) and ``accepted``."""
    model = fit(spark, docs, labels, F.col("quality") if label is None else label)
    view_cols = ["text", "source", "lang", "n_chars"]
    names = [*keep, "score", "text_score", "meta_score", "accepted"]

    def dot(view: Sequence[float], fitted: tuple[list[float], float]) -> float:
        return sum(x * w for x, w in zip(view, fitted[0], strict=True)) + fitted[1]

    def scored(text, source, lang, size) -> tuple[float, float, float, bool]:
        if model is None:
            return 1.0, 1.0, 1.0, True
        t = dot([dot(text_view(text), model["text"])], model["t"])
        m = dot([dot(meta_view(source, lang, size), model["meta"])], model["m"])
        score = _logistic(dot([t, m], model["mix"]))
        return score, _logistic(t), _logistic(m), score >= model["threshold"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = list(map(scored, *(batch.column(f"_{n}").to_pylist() for n in view_cols)))
            extra = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.float64()] * 3 + [pa.bool_()], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), *extra], names=names)

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    shape = ", ".join([*kinds, "score double, text_score double, meta_score double, accepted boolean"])
    return docs.select(*keep, *(F.col(n).alias(f"_{n}") for n in view_cols)).mapInArrow(run, shape)
