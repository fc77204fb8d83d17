import base64
import hashlib

from meridian.llm import warc

SCHEMA = "page_id long, url string, html string, id long, digest string, payload string, first_id int"


def _digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _run(spark, rows, **options):
    pages = spark.createDataFrame([(*r, 7, "clash", "clash", 1) for r in rows], SCHEMA)
    return warc.index_archives(spark, warc.write_archives(spark, pages, **options))


def test_round_trip(spark):
    big = "é<p>\r\n\r\nWARC/1.1\r\n" * 400_000  # longer than one scan, and holds separators
    rows = [(1, "http://a/1", "same"), (5, "http://a/5", "same"), (3, None, "same"), (2, "u\r\nX: y", None),
            (4, "http://a/4", ""), (6, "http://b/6", big), (None, "http://n", "same"), (8, "http://a/8", "päge")]
    index = _run(spark, rows)
    got = {r.record_id: r for r in warc.read_records(index).collect()}
    assert len(got) == len(rows)
    last = {}
    for i, _, html in rows:
        data = (html or "").encode()
        last[data] = max(last.get(data, -1), i if i is not None else -1)
    for i, url, html in rows:
        data, r = (html or "").encode(), got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(data), _digest(data))
        if last[data] == i:
            assert r.record_type == "response" and r.refers_to is None and bytes(r.payload) == data
        else:
            assert r.record_type == "revisit" and r.refers_to == last[data] and r.payload is None
        assert r.url == (None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"))


def test_index_points_at_records(spark):
    index = _run(spark, [(i, f"http://h/{i}", "x" * i) for i in range(50)])
    rows = index.collect()
    assert len(rows) == 50
    for r in rows:
        with warc._open(r.file) as f:
            raw = f.read_at(r.length, r.offset)
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and r.url.encode() in raw
    some = warc.read_records(index.where("record_id % 7 = 0"))
    assert sorted(r.record_id for r in some.collect()) == [i for i in range(50) if i % 7 == 0]


def test_repeated_rows_small_payloads_and_empty_table(spark):
    index = _run(spark, [(1, "u", "dup"), (1, "u", "dup"), (0, "v", "dup")])
    kinds = sorted((r.record_id, r.record_type, r.refers_to) for r in warc.read_records(index).collect())
    assert kinds == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]
    index = _run(spark, [(1, "u", "dup"), (2, "u", "dup")], min_revisit_bytes=4)
    assert {r.record_type for r in warc.read_records(index).collect()} == {"response"}
    assert warc.read_records(_run(spark, [])).count() == 0


def test_damage_is_found(spark):
    import pytest

    index = _run(spark, [(1, "u", "payload")])
    from pyspark.sql import functions as F

    broken = index.withColumn("offset", F.col("offset") + 0).withColumn("length", F.col("length") - 1)
    with pytest.raises(Exception, match="payload digest"):
        warc.read_records(broken).collect()
