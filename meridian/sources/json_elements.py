"""Records of JSON documents of any size (I6), cut in parallel.

A document is read as pieces that end at a closing brace, so that the text source splits it among tasks
although it may be a single line. As in ``csv_records`` a split does not know its own start, and is read
twice: first it reports, for a start outside and for one inside a string, how it ends, how many
containers it closes that it did not open, and how many it leaves open (with the kinds of the lowest two). These
few numbers a split, composed along each file, give every split's true start. Then each split cuts its text:

* elements of the document's array (the root, or the arrays that are members of a root object) become rows;
  one that crosses a border becomes pieces, at most two a split, that are joined by their place;
* all other text is the document's frame, in which each such array holds four numbers instead: the places of
  its two brackets. The frame is parsed as JSON like any document, and so is every element: a
  document is valid if its frame and all its elements are.

Only a frame, or one element, has to fit a VARIANT; the number of elements and the size of the file do not matter.

Defined results: an empty file is malformed; elements that are no objects are dropped (after they were checked); a member
of the stem's name that is no array is an error, a missing one means no records; a repeated member is malformed; text after the document's end is
ignored, as it is by the parser of small documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meridian.functions.joins import measured
from meridian.functions.text import path_stem
from meridian.functions.variants import json_kind
from meridian.operators.pages import INNER_NOT_LIST, MALFORMED, NOT_LIST_OR_OBJECT
from meridian.session import fresh_path

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|["\[\]{},]', re.S)
_CLOSE = re.compile(r'(?:[^"\\]|\\.)*+"', re.S)
#: what a row of the cut is: a whole element, the parts of one that crosses a border, a part of the frame
WHOLE, ENDS, WITHIN, BEGINS, FRAME = range(5)
_CUT = "file long, start long, seq long, piece int, first boolean, last boolean, value string"


class _Open:
    """Open containers: how many, and the kinds of the lowest two; ``closed`` counts closers without an opener."""

    def __init__(self, depth: int = 0, kinds: str = ""):
        self.depth, self.kinds, self.closed = depth, kinds, 0

    def push(self, kind: str) -> None:
        if self.depth < 2:
            self.kinds += kind
        self.depth += 1

    def pop(self) -> None:
        if self.depth:
            self.depth -= 1
            self.kinds = self.kinds[:self.depth]
        else:
            self.closed += 1

    def then(self, closed: int, depth: int, kinds: str) -> None:
        """What a split does that closes ``closed`` containers and leaves ``depth`` open."""
        self.depth = max(0, self.depth - closed)
        self.kinds = (self.kinds[:self.depth] + kinds)[:2]
        self.depth += depth

    def cut_level(self) -> int:
        """The depth whose elements are cut, inside an array that is; 0 elsewhere."""
        level = 1 if self.kinds[:1] == "[" else 2
        return level if self.kinds[level - 1:level] == "[" else 0


def _pieces(spark: SparkSession, pattern: str) -> DataFrame:
    return spark.read.option("lineSep", "}").text(pattern).select(
        F.col("value").cast("binary").alias("value"), F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bytes]]:
    for batch in batches:
        yield from zip(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True),
                       batch.column(0).to_pylist(), strict=True)


def _tokens(text: str, inside: bool) -> Iterator[tuple[str, int]]:
    """Brackets, commas and unclosed quotes of a piece with their ends; nothing inside strings."""
    at = 0
    if inside:
        end = _CLOSE.match(text)
        if end is None:
            yield '"', len(text)
            return
        at = end.end()
    for found in _TOKEN.finditer(text, at):
        token = found.group()
        if token == '"':
            yield token, len(text)
            return
        if len(token) == 1:
            yield token, found.end()


def split_ends(spark: SparkSession, pattern: str) -> DataFrame:
    """One row a split: its bytes, and for a start outside (0) and inside (1) a string where it ends."""
    kinds = ["inside boolean", "closed long", "depth long", "kinds string"]
    schema = "file long, start long, bytes long, " + ", ".join(f"{k.split()[0]}{i} {k.split()[1]}" for i in (0, 1) for k in kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: dict[tuple[int, int], list] = {}
        for split, raw in _read(batches):
            state = done.setdefault(split, [0, [False, _Open()], [True, _Open()]])
            state[0] += len(raw) + 1
            text = raw.decode("utf-8", "replace") + "}"
            for ends in state[1:]:
                inside = ends[0]
                ends[0] = False
                for token, _ in _tokens(text, inside):
                    if token == '"':
                        ends[0] = True
                    elif token in "[{":
                        ends[1].push(token)
                    elif token in "]}":
                        ends[1].pop()
        rows = [(*k, n, *(x for i, o in ends for x in (i, o.closed, o.depth, o.kinds))) for k, (n, *ends) in done.items()]
        types = [pa.int64(), pa.int64(), pa.int64(), *[pa.bool_(), pa.int64(), pa.int64(), pa.string()] * 2]
        names = [c.split()[0] for c in schema.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return _pieces(spark, pattern).mapInArrow(run, schema)


def split_starts(ends: list, sizes: dict[int, int]) -> dict[tuple[int, int], tuple[bool, int, str, bool]]:
    """``(inside, depth, kinds, open_end)`` at the start of every split; ``open_end`` marks the split whose last
    piece ends with its file and not at a brace."""
    out, read = {}, {}
    inside, stack, file, last = False, _Open(), None, {}
    for r in sorted(ends, key=lambda r: (r.file, r.start)):
        if r.file != file:
            inside, stack, file = False, _Open(), r.file
        out[r.file, r.start] = (inside, stack.depth, stack.kinds, False)
        last[r.file] = r.start
        read[r.file] = read.get(r.file, 0) + r.bytes
        if inside:
            stack.then(r.closed1, r.depth1, r.kinds1)
            inside = r.inside1
        else:
            stack.then(r.closed0, r.depth0, r.kinds0)
            inside = r.inside0
    for f, start in last.items():
        out[f, start] = (*out[f, start][:3], read[f] > sizes[f])
    return out


class _Cutter:
    """Cuts the text of one split."""

    def __init__(self, split: tuple[int, int], inside: bool, depth: int, kinds: str):
        self.split, self.inside, self.open = split, inside, _Open(depth, kinds)
        self.begun = self.first = False  # whether the open element began in this split, and is its array's first
        self.seq, self.held, self.frame, self.rows = 0, [], [], []

    def _out(self, piece: int, last: bool) -> None:
        self.seq += 1
        self.rows.append((*self.split, self.seq, piece, self.first, last, "".join(self.held)))
        self.held.clear()

    def add(self, text: str) -> None:
        at, inside, self.inside = 0, self.inside, False
        for token, end in _tokens(text, inside):
            if token == '"':
                self.inside = True
                break
            level, depth = self.open.cut_level(), self.open.depth
            if token in "[{":
                self.open.push(token)
                if not level and self.open.cut_level():
                    self.seq += 1
                    self.frame.append(text[at:end] + f"{self.split[1]},{self.seq},")
                    at, self.begun, self.first = end, True, True
            elif token == ",":
                if level and depth == level:
                    self.held.append(text[at:end - 1])
                    self._out(WHOLE if self.begun else ENDS, False)
                    at, self.begun, self.first = end, True, False
            else:
                if level and depth == level:
                    self.held.append(text[at:end - 1])
                    self._out(WHOLE if self.begun else ENDS, True)
                    self.seq += 1
                    self.frame.append(f"{self.split[1]},{self.seq}")
                    at, self.begun, self.first = end - 1, False, False
                self.open.pop()
        (self.held if self.open.cut_level() else self.frame).append(text[at:])

    def end(self) -> None:
        if self.open.cut_level():
            self._out(BEGINS if self.begun else WITHIN, False)
        self.first = False
        self.held = self.frame
        self._out(FRAME, False)


def _cut(spark: SparkSession, pattern: str, starts: dict) -> DataFrame:
    known = spark.sparkContext.broadcast(starts)  # a few numbers a split
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
    names = [c.split()[0] for c in _CUT.split(", ")]

    def rows(cutter: _Cutter) -> pa.RecordBatch:
        found, cutter.rows = cutter.rows, []
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate(types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, waiting, open_end = None, "", False

        def finish() -> pa.RecordBatch:
            cutter.add(waiting if open_end else waiting + "}")
            cutter.end()
            return rows(cutter)

        for split, raw in _read(batches):
            text = raw.decode("utf-8", "replace")
            if cutter is None or split != cutter.split:
                if cutter is not None:
                    yield finish()
                inside, depth, kinds, open_end = known.value[split]
                cutter = _Cutter(split, inside, depth, kinds)
            else:
                cutter.add(waiting + "}")
                if len(cutter.rows) >= 4096:
                    yield rows(cutter)
            waiting = text
        if cutter is not None:
            yield finish()

    return _pieces(spark, pattern).mapInArrow(run, _CUT)


def _joined(pieces: DataFrame) -> DataFrame:
    """Elements that cross borders. A split puts out at most one part that ends an element begun before it, and one
    that begins an element; a part belongs to the last beginning before it. One row or two a split take part."""
    order = Window.partitionBy("file").orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, 0)
    n = F.sum((F.col("piece") == BEGINS).cast("int")).over(order)
    parts = F.array_sort(F.collect_list(F.struct("start", "seq", "value")))
    return pieces.withColumn("n", n).groupBy("file", "n").agg(
        parts.alias("p"), F.max("first").alias("first"), F.max("last").alias("last")).select(
        "file", F.get("p", F.lit(0))["start"].alias("start"), F.get("p", F.lit(0))["seq"].alias("seq"), "first", "last",
        F.array_join(F.transform("p", lambda x: x["value"]), "").alias("value"))


def cut_documents(spark: SparkSession, pattern: str) -> tuple[DataFrame, DataFrame]:
    """``(file, path, page_error, lo, hi)`` per document, and ``(file, place, record, bad)`` per element, any kind, of
    every array that is cut; ``bad`` where it is no JSON. Both are read from written tables."""
    listing = spark.read.format("binaryFile").load(pattern)
    uri = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
    files = measured(listing.select(uri.alias("uri"), F.xxhash64("_metadata.file_path").alias("file"), "length"), "json-files")
    # one row a file, as the driver lists them anyway; files without a byte are listed but never read
    sizes = {r.uri: (r.file, r.length) for r in files.collect()}
    empty = {re.sub("^file:/+", "file:/", u) for u in listing.inputFiles()} - set(sizes)
    sizes = dict(sizes.values())
    files = files.select("uri", "file").unionByName(spark.createDataFrame([(u, None) for u in sorted(empty)], "uri string, file long"))
    files = files.select(F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B"))).alias("path"), "file")
    starts = split_starts(split_ends(spark, pattern).collect(), sizes)
    path = fresh_path(spark, "json-cut")
    _cut(spark, pattern, starts).write.parquet(path)
    cut = spark.read.schema(_CUT).parquet(path)

    whole = cut.where(F.col("piece") == WHOLE).select("file", "start", "seq", "first", "last", "value")
    crossing = _joined(cut.where(F.col("piece").isin(ENDS, WITHIN, BEGINS)))
    elements = whole.unionByName(crossing).where(~(F.col("first") & F.col("last") & F.col("value").rlike(r"\A[ \t\r\n]*\z")))
    # in brackets, as a text is parsed up to the end of its first value
    elements = elements.select("file", F.struct("start", "seq").alias("place"),
                               F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]"))).alias("_v"),
                               F.col("value").rlike(r"\A[ \t\r\n]*\z").alias("blank"))
    elements = elements.select("file", "place", F.try_variant_get("_v", "$[0]", "variant").alias("record"),
                               (F.col("_v").isNull() | F.col("blank")).alias("bad"))

    frames = cut.where(F.col("piece") == FRAME).groupBy("file").agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("p"))
    frames = frames.select("file", F.array_join(F.transform("p", lambda x: x["value"]), "").alias("body"))
    broken = elements.where("bad").select("file").distinct().withColumn("broken", F.lit(True))
    docs = files.join(frames, "file", "left").join(broken, "file", "left")
    docs = docs.select("file", "path", "body", "broken", F.try_parse_json("body").alias("_v"),
                       F.concat(F.lit("$['"), path_stem(F.col("path")), F.lit("']")).alias("_path"))
    docs = docs.select("*", json_kind(F.col("body"), F.col("_v")).alias("_kind"))
    bounds = F.when(F.col("_kind") == "array", F.try_variant_get("_v", "$", "array<bigint>")).when(
        F.col("_kind") == "object", F.expr("try_variant_get(_v, _path, 'array<bigint>')"))
    docs = docs.select("*", bounds.alias("b"))
    present = F.expr("try_variant_get(_v, _path, 'variant')").isNotNull()
    error = (F.when(F.col("_v").isNull() | F.col("broken"), F.lit(MALFORMED)).when(F.col("_kind") == "scalar", F.lit(NOT_LIST_OR_OBJECT))
             .when((F.col("_kind") == "object") & F.col("b").isNull() & present, F.lit(INNER_NOT_LIST)))

    def place(i: int):
        return F.struct(F.get("b", F.lit(i)).alias("start"), F.get("b", F.lit(i + 1)).alias("seq"))

    docs = measured(docs.select("file", "path", error.cast("string").alias("page_error"), place(0).alias("lo"), place(2).alias("hi")),
                    "json-documents")
    return docs, elements


def document_records(spark: SparkSession, pattern: str, mode: str = "strict") -> DataFrame:
    """I6/V6/D2/F8 for documents of any size: ``path, place, record`` of every object in a document's array, ``place``
    in the order of the document. A bad document fails (strict) or is skipped (lenient)."""
    docs, elements = cut_documents(spark, pattern)
    if mode == "strict":
        bad = docs.where("page_error is not null").orderBy("path").limit(1).collect()
        if bad:
            raise ValueError(f"bad page: {bad[0].page_error} in {bad[0].path}")
    good = docs.where("page_error is null").select("file", "path", "lo", "hi")
    kept = elements.join(good, "file").where((F.col("place") > F.col("lo")) & (F.col("place") < F.col("hi")))
    return kept.where(F.startswith(F.schema_of_variant("record"), F.lit("OBJECT"))).select("path", "place", "record")
