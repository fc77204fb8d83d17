"""CSV files as records, cut in parallel even where quoted values span lines.

Whether a line break ends a record depends on every quote before it, so a split in the middle of
a file does not know its own start. A split is therefore read twice. First it reports where
it ends if it starts outside, and if it starts inside, a quoted value: a map of two states to
two states, one row per split. Composing these maps along each file (a window over splits, not
lines) gives every split's true start. Then each split cuts its lines into records; what
crosses a border is put out as pieces, at most two a split, that are joined by their place.
Lines without quotes pass whole batches at a time; fields are parsed elsewhere, by ``from_csv``.

A quote opens a value only where a field begins, and closes it only before a delimiter or the
end of the line; elsewhere (inch marks, doubled quotes) it is text. Records end at ``\\n``
or ``\\r\\n``; blank lines between records are none; a value that never closes runs to the end
of its file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: what a piece is to its record: the last lines of one begun before, lines without either end, the first lines
ENDS, WITHIN, BEGINS = 0, 1, 2


class _Quotes:
    """The state after a line: inside a quoted value (true) or not."""

    def __init__(self, sep: str):
        s = re.escape(sep)
        self._closed = re.compile(rf'(\A|{s})"(?:[^"]|"")*+"(?={s}|\r?\Z)')
        self._opens = re.compile(rf'(?:\A|{s})"')
        self._closes = re.compile(rf'(?:[^"]|"")*+"(?={s}|\r?\Z)')

    def after(self, line: str, inside: bool) -> bool:
        if inside:
            end = self._closes.match(line)
            if end is None:
                return True
            line = line[end.end():]
        return self._opens.search(self._closed.sub(r"\1", line)) is not None


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file (as a hash) and the start of its split; line ends of ``\\r\\n`` keep their ``\\r``."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """Lines of one split at a time, in order: ``(file, start)`` and some of its lines."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield (int(file[a]), int(start[a])), batch.column(0).slice(a, b - a)


def _quoted(lines: pa.Array) -> np.ndarray:
    return pc.match_substring(lines, '"').to_numpy(zero_copy_only=False).astype(bool)


def split_maps(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``file, start, outside, inside``: the state at the end of each split for either state at its start."""
    quotes = _Quotes(sep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: dict[tuple[int, int], list[bool]] = {}
        for split, lines in _runs(batches):
            state = done.setdefault(split, [False, True])
            for line in lines.filter(pa.array(_quoted(lines))).to_pylist():
                state[:] = [quotes.after(line, s) for s in state]
        rows = [(*k, *v) for k, v in done.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i < 2 else pa.bool_()) for i in range(4)],
                                         names=["file", "start", "outside", "inside"])

    return _lines(spark, path).mapInArrow(run, "file long, start long, outside boolean, inside boolean")


def started_inside(maps: DataFrame) -> DataFrame:
    """``file, start`` of the splits that begin inside a quoted value.

    A map is the identity, a swap, or constant; the state before a split is the value of the last constant
    map before it (outside, without one), swapped once for each swap since.
    """
    order = Window.partitionBy("file").orderBy("start")
    constant = F.col("outside") == F.col("inside")
    swap = (F.col("outside") & ~F.col("inside")).cast("int")
    summed = maps.withColumn("swaps", F.sum(swap).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(constant, F.struct("outside", "swaps")), ignorenulls=True)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    states = summed.select("file", "start", last.over(before).alias("last"), F.last("swaps").over(before).alias("n"))
    base = F.coalesce(F.col("last.outside").cast("int"), F.lit(0))
    odd = (base + F.coalesce("n", F.lit(0)) - F.coalesce("last.swaps", F.lit(0))) % 2
    return states.where(odd != 0).select("file", "start")


def records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``file, record, header``: the records of every file, its first one marked; line breaks inside values are kept."""
    # one narrow row for each split that begins inside a value, as the driver already holds one for every split
    inside = {(r.file, r.start) for r in started_inside(split_maps(spark, path, sep)).collect()}
    known = spark.sparkContext.broadcast(inside)
    quotes = _Quotes(sep)
    names = ["file", "start", "piece", "record", "header"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, begun, first = None, [], False, False

        def rows(found: list[tuple[int | None, str, bool]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([split[0]] * len(found), pa.int64()), pa.array([split[1]] * len(found), pa.int64()),
                 pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.string()),
                 pa.array([f[2] for f in found], pa.bool_())], names=names)

        def rest() -> list[tuple[int | None, str, bool]]:
            """The open lines at the end of a split."""
            return [(BEGINS if begun else WITHIN, "\n".join(held), first)] if held else []

        state = False
        for key, lines in _runs(batches):
            if key != split:
                if split is not None and (last := rest()):
                    yield rows(last)
                split, held = key, []
                state = key in known.value
                begun = not state  # whether the record that is open began in this split
                first = key[1] == 0
            marked = _quoted(lines)
            if not state and not first and not marked.any():
                kept = lines.filter(pc.not_equal(pc.utf8_trim_whitespace(lines), ""))
                n = len(kept)
                yield pa.RecordBatch.from_arrays([pa.array([split[0]] * n, pa.int64()), pa.array([split[1]] * n, pa.int64()),
                                                  pa.nulls(n, pa.int32()), kept, pa.array([False] * n, pa.bool_())], names=names)
                continue
            found: list[tuple[int | None, str, bool]] = []
            for line, has in zip(lines.to_pylist(), marked.tolist(), strict=True):
                if not state and not has and not line.strip():
                    continue
                held.append(line)
                if has:
                    state = quotes.after(line, state)
                if not state:
                    found.append((None if begun else ENDS, "\n".join(held), first and begun))
                    first = first and not begun
                    held, begun = [], True
            if found:
                yield rows(found)
        if split is not None and (last := rest()):
            yield rows(last)

    cut = _lines(spark, path).mapInArrow(run, "file long, start long, piece int, record string, header boolean")
    whole = cut.where("piece is null").select("file", "record", "header")
    # pieces: one record begins at each BEGINS and takes all pieces up to the next
    pieces = cut.where("piece is not null")
    ordered = Window.partitionBy("file").orderBy("start", "piece")
    begun = F.sum((F.col("piece") == BEGINS).cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    joined = (pieces.withColumn("n", begun).groupBy("file", "n")
              .agg(F.array_sort(F.collect_list(F.struct("start", "piece", "record"))).alias("p"), F.max("header").alias("header"))
              .select("file", F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"), "header"))
    return whole.unionByName(joined)
