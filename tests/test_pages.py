import json

import pytest
from pyspark.sql import functions as F

from meridian.functions.text import path_stem
from meridian.operators import pages as pg


def _pages(spark, items):
    """items: (dataset, offset, python payload or raw text)."""
    rows = [(d, o, p if isinstance(p, str) else json.dumps(p)) for d, o, p in items]
    return spark.createDataFrame(rows, "dataset string, offset bigint, body string")



def _flat_ids(df):
    return [r.id for r in df.select(F.variant_get("record", "$.id", "string").alias("id")).orderBy("offset", "pos").collect()]


def test_array_pages_stop_on_short_page(spark):
    pages = _pages(spark, [("a", 0, [{"id": "1"}, {"id": "2"}]), ("a", 2, [{"id": "3"}]), ("a", 4, [{"id": "4"}, {"id": "5"}])])
    assert _flat_ids(pg.read_paged(pages, "array", batch=2)) == ["1", "2", "3"]


def test_array_pages_stop_on_empty_page(spark):
    pages = _pages(spark, [("a", 0, [{"id": "1"}, {"id": "2"}]), ("a", 2, []), ("a", 4, [{"id": "9"}])])
    assert _flat_ids(pg.read_paged(pages, "array", batch=2)) == ["1", "2"]


def test_text_values_are_kept(spark):
    pages = _pages(spark, [("drugs", 0, [{"brnd_name": "A", "tot_spndng_2022": "123.45"}])])
    rec = pg.read_paged(pages, "array", batch=1000).select(F.variant_get("record", "$.tot_spndng_2022", "string")).first()[0]
    assert rec == "123.45"


def test_bad_array_pages_rejected(spark):
    for body in ({"not": "a list"}, ["just", "strings"]):
        pages = _pages(spark, [("a", 0, body)])
        with pytest.raises(Exception, match="bad page"):
            pg.read_paged(pages, "array", batch=2).collect()


def test_bad_page_after_stop_is_never_read(spark):
    pages = _pages(spark, [("a", 0, [{"id": "1"}]), ("a", 2, "not json at all")])
    assert _flat_ids(pg.read_paged(pages, "array", batch=2)) == ["1"]


def test_results_envelope_and_leading_zeros(spark):
    pages = _pages(spark, [("h", 0, {"results": [{"facility_id": "010001"}, {"facility_id": "010002"}]})])
    got = pg.read_paged(pages, "results", batch=1000).select(F.variant_get("record", "$.facility_id", "string")).collect()
    assert sorted(r[0] for r in got) == ["010001", "010002"]


def test_results_envelope_errors_and_empty(spark):
    assert pg.read_paged(_pages(spark, [("h", 0, {"results": []})]), "results", batch=2).count() == 0
    assert pg.read_paged(_pages(spark, [("h", 0, {"other": 1})]), "results", batch=2).count() == 0
    report = pg.validate_pages(_pages(spark, [("a", 0, [1]), ("b", 0, {"results": ["x"]}),
                                              ("c", 0, {"results": {"a": 1}}), ("d", 0, {"results": None})]), "results")
    assert {(r.dataset, r.page_error) for r in report.collect()} == {
        ("a", "page_not_object"), ("b", "row_not_object"), ("c", "results_not_list"), ("d", "results_not_list")}


def test_search_cap_reachable_rows(spark):
    # endless full pages of 200: skip <= 1000 means 6 pages, 1,200 rows
    pages = _pages(spark, [("q", o, {"results": [{"id": str(o + i)} for i in range(200)]}) for o in range(0, 3000, 200)])
    assert pg.read_paged(pages, "results", batch=200, max_skip=1000).count() == 1200


def test_missing_page_stops_read_and_is_reported(spark):
    pages = _pages(spark, [("a", 0, [{"id": "1"}, {"id": "2"}]), ("a", 4, [{"id": "5"}, {"id": "6"}]), ("a", 6, [{"id": "7"}])])
    assert _flat_ids(pg.read_paged(pages, "array", batch=2, mode="lenient")) == ["1", "2"]
    with pytest.raises(Exception, match="page_missing in a at offset 2"):
        pg.read_paged(pages, "array", batch=2).collect()
    holes = pg.page_holes(pages, batch=2).collect()
    assert [(r.dataset, r.missing_offset) for r in holes] == [("a", 2)]


def test_page_holes_many_chunks(spark):
    present = [("a", o, [{"id": "x"}]) for o in range(0, 100) if o % 7 != 3]
    holes = pg.page_holes(_pages(spark, present), batch=1, chunk=8)
    assert sorted(r.missing_offset for r in holes.collect()) == [o for o in range(0, 100) if o % 7 == 3]


def _static(spark, path, payload):
    df = spark.createDataFrame([(path, 0, payload if isinstance(payload, str) else json.dumps(payload), path)],
                               "dataset string, offset bigint, body string, path string")
    return pg.parse_pages(df, "static", stem=path_stem(F.col("path")))


def test_static_envelopes(spark):
    bare = _static(spark, "/api/glossary.json", [{"title": "a"}, {"title": "b"}])
    wrapped = _static(spark, "/api/glossary.json", {"glossary": [{"title": "c"}]})
    junk = _static(spark, "/api/articles.json", [{"title": "ok"}, "junk", 5])
    missing = _static(spark, "/api/glossary.json", {"other": [{"title": "x"}]})
    assert pg.flatten(bare).count() == 2
    assert pg.flatten(wrapped).count() == 1
    assert pg.flatten(junk).count() == 1
    assert pg.flatten(missing).count() == 0


def test_static_errors(spark):
    assert _static(spark, "/api/glossary.json", "\"a string\"").first().page_error == "payload_not_list_or_object"
    assert _static(spark, "/api/glossary.json", {"glossary": "nope"}).first().page_error == "inner_not_list"


def test_broken_sequences_fail_a_strict_read(spark):
    full, short = [{"id": "1"}, {"id": "2"}], [{"id": "3"}]
    cases = {"off_grid_page in a at offset 3": [("a", 0, full), ("a", 2, short), ("a", 3, short)],
             "unterminated in b at offset 4": [("b", 0, full), ("b", 2, full)],
             "page_missing in c at offset 0": [("c", 2, full), ("c", 4, short)]}
    for message, rows in cases.items():
        with pytest.raises(Exception, match=message):
            pg.read_paged(_pages(spark, rows), "array", batch=2).collect()
    every = _pages(spark, [r for rows in cases.values() for r in rows] + [("d", 0, full), ("d", 2, short), ("d", 8, full)])
    report = {tuple(r) for r in pg.sequence_errors(every, "array", batch=2).collect()}
    assert report == {("a", "off_grid_page", 3), ("b", "unterminated", 4), ("c", "page_missing", 0)}
    # pages after the first short one are never read
    ended = _pages(spark, [("d", 0, full), ("d", 2, short), ("d", 8, full)])
    assert _flat_ids(pg.read_paged(ended, "array", batch=2)) == ["1", "2", "3"]
