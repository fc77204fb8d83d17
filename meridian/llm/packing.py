"""Variable-capacity best-fit packing of documents into training sequences.

A document longer than the largest permitted length is cut into pieces of that length.
Pieces are dealt into shards of about ``SHARD_PIECES`` (only lengths move, never texts) and
each shard is packed longest first: a piece goes to the open bin it fills best; if none
fits, a bin opens whose permitted length costs least per token it can still be filled
with. At the end every bin shrinks to the smallest permitted length that holds its
contents. The cost of a sequence of length c is ``FIXED + c + QUADRATIC * c * c``.

Defined results: null, empty or wordless texts have no tokens and take no place (one row
with a null bin); repeated rows are packed separately; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import written

CAPACITIES = (512, 1024, 2048, 4096, 8192)
SHARD_PIECES = 50_000
FIXED = 16.0
QUADRATIC = 1 / 65536

_OUT = "bin_id string, capacity long, filled long, slot long, at long, piece long, start long, length long"


def word_count(text: Column) -> Column:
    """Words (runs of anything but ASCII white space); the default token count."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    trimmed = F.trim(trimmed)
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1).cast("long")


def sequence_cost(capacity: int) -> float:
    return FIXED + capacity + QUADRATIC * capacity * capacity


def pack(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES) -> list[tuple[int, int, int]]:
    """``(bin, final capacity, offset)`` of each length; every length must fit the largest capacity."""
    sizes = sorted(capacities)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    rest = sum(lengths)
    free: list[tuple[int, int]] = []  # (room left, bin), sorted
    filled: list[int] = []
    place: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in order:
        need = lengths[i]
        at = bisect_left(free, (need, -1))
        if at < len(free):
            room, bin_no = free.pop(at)
        else:
            # least cost per token that the bin can still get
            room = min((c for c in sizes if c >= need), key=lambda c: (sequence_cost(c) / min(c, max(rest, need)), c))
            bin_no = len(filled)
            filled.append(0)
        place[i] = bin_no, filled[bin_no]
        filled[bin_no] += need
        rest -= need
        if room > need:
            insort(free, (room - need, bin_no))
    final = [sizes[bisect_left(sizes, f)] for f in filled]
    return [(b, final[b], at) for b, at in place]


def best_fit(docs: DataFrame, tokens: Column | None = None, capacities: Sequence[int] = CAPACITIES,
             shard_pieces: int = SHARD_PIECES, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per piece: the ``keep`` columns, ``bin_id, capacity, filled, slot, at, piece, start, length``.

    ``start`` and ``length`` are token ranges of the document, ``at`` the offset in the bin,
    ``slot`` the order in the bin.
    """
    largest = max(capacities)
    count = word_count(F.col("text")) if tokens is None else tokens
    # written: the texts are read and counted once, everything below works on the lengths
    sized = written(docs.sparkSession, docs.select(*keep, F.coalesce(count, F.lit(0)).cast("long").alias("_n")), "pack-lengths")
    pieces = sized.where("_n > 0").select(
        *keep, "_n", F.posexplode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / largest) * largest,
                                             F.lit(largest).cast("long"))).alias("piece", "start"))
    pieces = pieces.select(*keep, F.col("piece").cast("long").alias("piece"), "start",
                           F.least(F.lit(largest), F.col("_n") - F.col("start")).cast("long").alias("length"))
    total = sized.agg(F.sum(F.ceil(F.col("_n") / largest))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_pieces))
    # dealt by row, so that no id or length can gather in one shard
    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([*keep, "start", "length"], kind="stable", na_position="first").reset_index(drop=True)
        placed = pack(rows["length"].tolist(), capacities)
        rows["bin_id"] = [f"{key[0]}-{b}" for b, _, _ in placed]
        rows["capacity"] = [c for _, c, _ in placed]
        rows["at"] = [a for _, _, a in placed]
        rows["filled"] = rows.groupby("bin_id")["length"].transform("sum")
        rows["slot"] = rows.groupby("bin_id")["at"].rank(method="first").astype("int64") - 1
        return rows[names]

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep]
    names = [*keep, *(f.split()[0] for f in _OUT.split(", "))]
    packed = dealt.groupBy("_shard").applyInPandas(run, ", ".join([*kinds, _OUT]))
    none = [F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in _OUT.split(", ")[:5]]
    empty = sized.where("_n = 0").select(*keep, *none, *(F.lit(0).cast("long").alias(c) for c in ("piece", "start", "length")))
    return packed.unionByName(empty)
