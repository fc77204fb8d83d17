"""Fill-in-middle transformation over UTF-8 words.

A batch of texts is one run of UTF-8 bytes, viewed as little-endian 64-bit words. Plain word
arithmetic marks the last byte of every code point (a byte whose successor does not continue
it), ``bitwise_count`` counts the marks of each word and a running sum ranks them. The byte
where the k-th code point ends is then found by a binary search of the running sums for its
word and by a select inside that word (prefix sums of the marks by one multiplication, and a
count of the bytes that stay below k). No text is decoded; cuts of a whole batch are looked
up at once, so a long text costs its bytes and nothing per code point.

Two cuts, the form and its order come from the SHA-256 of ``seed:doc_id``, so a row's result
depends on its id and text alone, wherever and however often it is computed.

Defined results: a null text counts as empty; an empty text, or one that holds a sentinel,
stays plain; a null id is drawn as the word ``null``; repeated rows get equal results; stray
continuation bytes belong to the code point before them in the same text; an empty table
gives no rows; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: sentinels of the output format
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: shares in percent: texts left plain, and suffix-first ones among the others
PLAIN, SUFFIX_FIRST = 10, 20

_U = np.uint64
_HIGH, _ONES = _U(0x8080808080808080), _U(0x0101010101010101)


def ending_marks(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words whose byte tops are set where a code point ends; one spare word follows.

    ``bounds`` are the byte offsets of the texts in ``data``; every text that is not empty ends a code point.
    """
    words = np.zeros(len(data) // 8 + 2, dtype="<u8")
    words.view(np.uint8)[:len(data)] = data
    starts = ~(words & ~(words << _U(1))) & _HIGH  # tops of bytes other than 10xxxxxx
    ends = starts >> _U(8)
    ends[:-1] |= starts[1:] << _U(56)
    last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
    np.bitwise_or.at(ends, last >> 3, _U(0x80) << (8 * (last & 7)).astype(_U))
    ends[len(data) >> 3] &= (_U(1) << _U(8 * (len(data) & 7))) - _U(1)
    ends[(len(data) >> 3) + 1:] = 0
    return ends


def rank(ends: np.ndarray, sums: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points that end before the byte offsets ``at``; ``sums`` are the marks before each word."""
    below = (_U(1) << (8 * (at & 7)).astype(_U)) - _U(1)
    return sums[at >> 3] + np.bitwise_count(ends[at >> 3] & below)


def select(ends: np.ndarray, sums: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The byte offset after the k-th code point (k from 1)."""
    word = np.searchsorted(sums[1:], k, side="left")
    left = (k - sums[word]).astype(_U)
    before = (ends[word] >> _U(7)) * _ONES  # byte j: marks in bytes 0 to j
    reached = (before + (_U(0x80) - left) * _ONES) & _HIGH
    return word * 8 + 9 - np.bitwise_count(reached)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column (nulls are empty) and the offsets of its texts."""
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).fill_null(b"")
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def cut_batch(column: pa.Array, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes], list[tuple[int, int]]]:
    """Per text: its code points, the two cuts in code points (smaller first), its bytes and the cuts in bytes."""
    data, bounds = _bytes_of(column)
    ends = ending_marks(data, bounds)
    sums = np.concatenate([[0], np.cumsum(np.bitwise_count(ends), dtype=np.int64)])
    base = rank(ends, sums, bounds)
    n = np.diff(base)
    cuts = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0)
    at = np.broadcast_to(bounds[:-1], cuts.shape).copy()
    inside = cuts > 0
    at[inside] = select(ends, sums, (base[:-1] + cuts)[inside])
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return n, cuts, texts, list(zip(*(at - bounds[:-1]).tolist(), strict=True))


def fill_middle(docs: DataFrame, seed: int = 1, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``doc_id, n, form (plain, psm or spm), prefix_chars, middle_chars, output`` of every document."""
    text = F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    drawn = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    keeps = (text == "") | (drawn[2] % 100 >= 100 - plain)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        keeps = keeps | F.contains(text, F.lit(sentinel))
    form = F.when(keeps, "plain").when(drawn[3] % 100 < suffix_first, "spm").otherwise("psm")
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def put(form: str, text: bytes, a: int, b: int) -> bytes:
        if form == "plain":
            return text
        if form == "psm":
            return b"".join((p, text[:a], s, text[b:], m, text[a:b]))
        return b"".join((s, text[b:], p, text[:a], m, text[a:b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
            n, cuts, texts, at = cut_batch(batch.column(1), h1, h2)
            forms = batch.column(4).to_pylist()
            whole = np.fromiter((f == "plain" for f in forms), bool, len(forms))
            out = [put(f, t, a, b) for f, t, (a, b) in zip(forms, texts, at, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), batch.column(4), pa.array(cuts[0], pa.int64(), mask=whole),
                 pa.array(cuts[1] - cuts[0], pa.int64(), mask=whole), _as_text(out)],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", drawn[0].alias("h1"), drawn[1].alias("h2"), form.alias("form")).mapInArrow(
        run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def _as_text(values: list[bytes]) -> pa.Array:
    """The bytes as a text column, unchecked, so that odd bytes come back as they were."""
    column = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(column), column.buffers(), offset=column.offset)


def restored(output: Column, form: Column) -> Column:
    """The text rebuilt from a form and its output alone: sentinels cannot occur inside the parts."""
    def after(sentinel: str) -> Column:  # nothing but the middle follows its sentinel
        return F.substring_index(output, sentinel, -1)

    def between(first: str, second: str) -> Column:
        return F.substring_index(F.substring_index(output, first, -1), second, 1)

    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
