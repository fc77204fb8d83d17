"""Vector code compression: product quantisation in exact integer arithmetic.

Components become integers (floor of ``SCALE`` times the value). Each of ``PARTS`` equal parts
of a vector is coded by its nearest entry of that part's codebook. Distances are
``|x|^2 - 2 x.c + |c|^2`` with the products ``x.c`` of a whole batch from float64 matrix
products, made exact by limbs: an integer is split into pieces of ``b`` bits with
``2 b + log2(part width) <= 53``, so every product of two limb matrices stays below 2^53 in
any order of summation; the pieces are put together again in int64, and the first minimum
names the entry. Results therefore do not depend on the machine, the split or the order of rows.

A round is one narrow pass over the kept vectors (each task returns sums and counts per
entry) and a sum of those few rows; the codebooks, ``PARTS * ENTRIES`` entries, are all that
passes the driver. The integer vectors are written once and read by every pass.

Defined results: vectors that are null or empty, hold null or non-finite components, differ
in length from the kept vector with the smallest id, cannot be cut into equal parts, or hold
an integer beyond ``largest(dim)`` (a squared distance might pass 63 bits then) are dropped;
with fewer than ``ENTRIES`` kept vectors the codebooks have as many entries; equal ids come in
the order of their vectors, null ids last; a label's error beyond 63 bits is null; repeated rows get
equal codes; an empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions.joins import measured
from meridian.llm.common import written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6


def largest(dim: int) -> int:
    """Integers up to this size keep the sum of ``dim`` squared differences below 2^63."""
    return min(math.isqrt((2 ** 63 - 1) // (4 * dim)), 2 ** 31 - 1)


def limb_bits(width: int) -> int:
    """Bits of a limb so that ``width`` products of two limbs add up below 2^53."""
    return (53 - max(width - 1, 0).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 pieces, lowest first, with ``sum(piece * 2^(bits * i)) == x``; the last one carries the sign."""
    out = []
    while x.size and max(int(x.max()), -int(x.min())) >= 1 << bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def exact_dots(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """``parts, rows, entries`` of integer dot products of ``parts, rows, width`` and ``parts, entries, width``."""
    bits = limb_bits(x.shape[2])
    out = np.zeros((x.shape[0], x.shape[1], entries.shape[1]), dtype=np.int64)
    right = [np.ascontiguousarray(e.transpose(0, 2, 1)) for e in limbs(entries, bits)]
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(right):
            out += np.matmul(a, b).astype(np.int64) << np.int64(bits * (i + j))
    return out


def assign(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``parts, rows``: the first nearest entry of every part and its squared distance."""
    d = (x * x).sum(axis=2)[:, :, None] - 2 * exact_dots(x, entries) + (entries * entries).sum(axis=2)[:, None, :]
    nearest = d.argmin(axis=2)
    return nearest, np.take_along_axis(d, nearest[:, :, None], axis=2)[:, :, 0]


def _cut(column: pa.Array, parts: int) -> np.ndarray:
    """``parts, rows, width`` of a batch of equally long integer vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), parts, -1).transpose(1, 0, 2)


#: vectors worked on at once inside a task
_BLOCK = 4096


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BLOCK):
            yield batch.slice(at, _BLOCK)


def kept_vectors(vectors: DataFrame, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v``: the vectors that can be coded, as integers."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.where(e.isNotNull() & (F.size(e) > 0) & (F.size(e) % parts == 0) & finite)
    first = good.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(1)
    head = first.select(F.size("embedding")).first()
    dim = head[0] if head else parts
    whole = F.transform(e, lambda x: F.floor(x.cast("double") * float(scale)))
    sized = good.where(F.size(e) == dim).select("vec_id", "label", e)
    fits = F.forall(e, lambda x: F.abs(x.cast("double") * float(scale)) < float(largest(dim)))
    return sized.where(fits).select("vec_id", "label", whole.cast("array<int>").alias("v"))


def _first_entries(kept: DataFrame, parts: int, entries: int) -> np.ndarray:
    rows = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    width = len(rows[0].v) // parts if rows else 0
    return np.array([r.v for r in rows], dtype=np.int64).reshape(len(rows), parts, width).transpose(1, 0, 2)


def _refined(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every entry replaced by the floored mean of the parts nearest to it."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in _blocks(batches):
            x = _cut(batch.column(0), parts)
            slot = (assign(x, books)[0] + entries * np.arange(parts)[:, None]).ravel()
            for i, column in enumerate(x.reshape(-1, width).T):  # a block's float64 sums stay below 2^53, so they are exact
                sums[:, i] += np.bincount(slot, column, parts * entries).astype(np.int64)
            counts += np.bincount(slot, minlength=parts * entries)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(counts[used], pa.int64()), pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
            names=["slot", "c", "s"])

    partial = kept.select("v").mapInArrow(run, "slot long, c long, s array<long>")
    total = [F.sum(F.col("s")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(width)]
    out = books.copy()
    for r in partial.groupBy("slot").agg(F.sum("c").alias("c"), *total).collect():
        out[r.slot // entries, r.slot % entries] = [int(r[f"s{i}"]) // r.c for i in range(width)]
    return out


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """``parts, entries, width``: the codebooks after ``rounds`` rounds over all kept vectors."""
    books = _first_entries(kept, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = _refined(kept, books)
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error``: two hex digits for each part and the squared distance to the coded vector."""
    parts = books.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            nearest, far = assign(_cut(batch.column(2), parts), books)
            codes = [bytes(row).hex() for row in nearest.T.astype(np.uint8).tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(far.sum(axis=0), pa.int64())],
                names=["vec_id", "label", "code", "error"])

    kinds = {c: kept.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return kept.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(spark: SparkSession, vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every kept vector (up to 256 entries a codebook)."""
    if not 0 < entries <= 256:
        raise ValueError("codes have two hex digits: 1 to 256 entries")
    kept = written(spark, kept_vectors(vectors, parts), "codes-kept")
    books = fit(kept, parts, entries, rounds)
    coded = written(spark, encode(kept, books), "codes-coded")
    # one row per label, summed within tasks first; written so that its size is known before it is joined back
    totals = measured(coded.groupBy("label").agg(F.expr("try_sum(error)").alias("label_error"))
                      .withColumnRenamed("label", "_label"), "codes-labels")
    return coded.join(totals, F.expr("label <=> _label")).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
