"""WARC archives: write, index, read back by coalesced byte ranges.

``write_archives`` stores one uncompressed WARC/1.1 record per row. Rows with equal
payloads are found by SHA-1 (pre-aggregated, so a hot payload is one row per map task):
the one with the largest id becomes a ``response``, the others ``revisit`` records without
a body. Spark's text writer produces the files (its commit protocol drops the output of
lost attempts); the record separator is the line separator.

``index_archives`` scans every archive once and returns offset, length, URL and digest per
record; ``read_records`` reads selected index rows: sorted by file and offset, neighbouring
ranges joined into one read, digests verified.

Defined results: a null payload is empty; a null url writes no target header; a null id is
never chosen while another copy has one, and is read back as null; rows that tie on the
largest id of a payload are all responses; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import written
from meridian.session import fresh_path

SEPARATOR = "\r\n\r\n"
#: bytes of one scan of an archive while indexing, and of one coalesced read at most
#: (a longer record is read alone)
SCAN_BYTES = 4 << 20
READ_BYTES = 4 << 20
#: ranges this close are read together
GAP_BYTES = 64 << 10
#: index rows of one file whose offsets share a block are read by one task
BLOCK_BYTES = 32 << 20

_BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
_INDEX = ("file string, offset long, length long, url string, digest string, record_type string, "
          "record_id long, refers_to long, payload_bytes long")
_RECORD = ("record_id long, url string, record_type string, refers_to long, payload_bytes long, "
           "payload_digest string, payload binary, file string, offset long, length long")


def sha1_base32(text: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a text column's UTF-8 bytes (built-in functions only)."""
    digits = F.sha1(text.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digits, at, size), 16, 32), width, "0")
             for at, size, width in ((1, 15, 12), (16, 15, 12), (31, 10, 8))]
    return F.translate(F.concat(*parts), *_BASE32)


def _header(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))


def record_text(id_col: str = "id") -> Column:
    """The whole record as text; expects columns id, url, payload, digest, refers_to, is_response."""
    number = F.col(id_col).cast("string")
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(SEPARATOR))
    body = F.when(F.col("is_response"), F.concat(http, F.col("payload"))).otherwise(F.lit(""))
    kind = F.when(F.col("is_response"), F.lit("response")).otherwise(F.lit("revisit"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _header("WARC-Type", kind),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:record:"), number, F.lit(">"))),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Payload-Length", F.octet_length("payload").cast("string")),
        _header("WARC-Refers-To", F.concat(F.lit("<urn:record:"), F.col("refers_to").cast("string"), F.lit(">"))),
        _header("WARC-Profile", F.when(~F.col("is_response"), F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"))
    return F.concat(head, F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit(SEPARATOR), body)


def write_archives(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_revisit_bytes: int = 0) -> str:
    """Write one record per row under the shared folder; returns the archive folder.

    Payloads of fewer than ``min_revisit_bytes`` bytes are always stored whole.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    keyed = rows.withColumn("digest", sha1_base32(F.col("payload")))
    copies = (keyed.where(F.octet_length("payload") >= min_revisit_bytes)
              .groupBy("digest").agg(F.max("id").alias("first_id"), F.count("*").alias("copies"))
              .where("copies > 1").select("digest", "first_id"))
    # written, so that the join below has an exchange on both sides and a hot digest can be split
    copies = written(spark, copies, "warc-copies")
    joined = keyed.join(copies, "digest", "left").withColumn(
        "is_response", F.col("first_id").isNull() | F.coalesce(F.col("id") == F.col("first_id"), F.lit(False)))
    joined = joined.withColumn("refers_to", F.when(~F.col("is_response"), F.col("first_id")))
    path = fresh_path(spark, "warc")
    joined.select(record_text().alias("value")).write.option("lineSep", SEPARATOR).text(path)
    return path


def _open(uri: str) -> pa.NativeFile:
    store, path = pafs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


def _parse_head(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.decode("utf-8").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _number(value: str | None) -> int | None:
    text = (value or "").removeprefix("<urn:record:").removesuffix(">")
    return int(text) if text.lstrip("-").isdigit() else None


def _scan(uri: str) -> Iterator[tuple[int, int, dict[str, str]]]:
    """Offset, length and headers of every record of one archive; bodies are skipped over."""
    end = SEPARATOR.encode()
    with _open(uri) as source:
        size, at, buffer, start = source.size(), 0, b"", 0
        while at < size:
            cut = buffer.find(end, at - start) if start <= at < start + len(buffer) else -1
            want = SCAN_BYTES
            while cut < 0:
                start, buffer = at, source.read_at(min(want, size - at), at)
                cut = buffer.find(end)
                if cut < 0 and at + want >= size:
                    raise ValueError(f"{uri}: record at {at} has no end of header")
                want *= 2
            fields = _parse_head(buffer[at - start:cut])
            length = start + cut - at + len(end) + int(fields["content-length"]) + len(end)
            yield at, length, fields
            at += length


def index_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, offset, length, url, digest and the record's own headers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _INDEX.split(", ")]
        types = [pa.string() if f.endswith("string") else pa.int64() for f in _INDEX.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows: list[tuple] = []
                for at, length, head in _scan(uri):
                    rows.append((uri, at, length, head.get("warc-target-uri"),
                                 head.get("warc-payload-digest", "").removeprefix("sha1:"), head.get("warc-type"),
                                 _number(head.get("warc-record-id")), _number(head.get("warc-refers-to")),
                                 int(head.get("warc-payload-length", "0"))))
                    if len(rows) >= 4096:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    # the listing reads no content; files are dealt out one by one, whatever their count
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path")
    return written(spark, files.repartition(max(1, files.count())).mapInArrow(run, _INDEX), "warc-index")


def read_records(index: DataFrame, payloads: bool = True, verify: bool = True) -> DataFrame:
    """Read the selected index rows. Every task gets blocks of files sorted by offset, joins
    ranges at most ``GAP_BYTES`` apart into reads of up to ``READ_BYTES`` and cuts the records out.

    ``payloads=False`` leaves the payload column null (the bytes are still read and verified).
    """
    names = [f.split()[0] for f in _RECORD.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]]
             for f in _RECORD.split(", ")]

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        uri, found, low, high = None, [], 0, 0
        for batch in batches:
            for f, at, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if f != uri or at > high + GAP_BYTES or at + length - low > READ_BYTES:
                    if found:
                        yield uri, found
                    uri, found, low, high = f, [], at, at
                found.append((at, length))
                high = max(high, at + length)
        if found:
            yield uri, found

    def cut(uri: str, at: int, raw: bytes) -> tuple:
        end = SEPARATOR.encode()
        head, _, body = raw[:-len(end)].partition(end)
        fields = _parse_head(head)
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        kind, size, payload = fields.get("warc-type"), int(fields.get("warc-payload-length", "0")), None
        if kind == "response":
            payload = body.partition(end)[2]
            size = len(payload)
            if verify:
                seen = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if seen != digest:
                    raise ValueError(f"{uri}@{at}: payload digest {seen} is not {digest}")
        return (_number(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind,
                _number(fields.get("warc-refers-to")), size, digest, payload if payloads else None,
                uri, at, len(raw))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, source, rows, held = None, None, [], 0
        for name, found in ranges(batches):
            if name != uri:
                if source is not None:
                    source.close()
                uri, source = name, _open(name)
            low = found[0][0]
            block = source.read_at(max(a + n for a, n in found) - low, low)
            rows += [cut(uri, at, block[at - low:at - low + length]) for at, length in found]
            held += len(block)
            if len(rows) >= 4096 or held >= READ_BYTES:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        if source is not None:
            source.close()

    total = index.agg(F.sum("length")).first()[0] or 0
    block = F.floor(F.col("offset") / BLOCK_BYTES)
    return (index.select("file", "offset", "length").repartition(2 * (total // BLOCK_BYTES + 1), "file", block)
            .sortWithinPartitions("file", "offset").mapInArrow(run, _RECORD))
