import json

from meridian.operators import resolution as res

ID = "https://data.cms.gov/data-api/v1/dataset/{}/data-viewer"


def _csv(year, url="u"):
    return {"mediaType": "text/csv", "downloadURL": url, "temporal": f"{year}-01-01/{year}-12-31"}


def _statuses(spark, docs, specs):
    catalog = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "doc_seq bigint, body string")
    asked = spark.createDataFrame(specs, "key string, dataset_id string, year int")
    return {r.key: r for r in res.catalog_statuses(asked, catalog).collect()}


def test_every_spec_gets_the_first_step_that_fails(spark):
    doc = {"dataset": [{"identifier": ID.format("a"), "distribution": [_csv(2022, "a22"), _csv(2023, "a23"), _csv(2023, "a23b")]},
                       {"identifier": ID.format("b"), "distribution": [{"mediaType": "application/pdf"}]}, {"identifier": ID.format("c")}, 7]}
    got = _statuses(spark, [doc], [("new", "a", None), ("old", "a", 2022), ("not", "a", 1990), ("pdf", "b", None), ("bare", "c", 2020),
                                   ("lost", "zzz", None), ("null", None, None), ("empty", "", 2022)])
    assert {k: (r.status, r.year, r.url) for k, r in got.items()} == {
        "new": ("ok", 2023, "a23b"), "old": ("ok", 2022, "a22"), "not": ("year_missing", None, None), "pdf": ("no_csv", None, None),
        "bare": ("no_csv", None, None), "lost": ("dataset_not_found", None, None), "null": ("dataset_id_missing", None, None),
        "empty": ("dataset_id_missing", None, None)}
    assert got["not"].available == "2022,2023" and got["pdf"].available == ""


def test_broken_documents_fail_what_no_earlier_one_matches(spark):
    good = {"dataset": [{"identifier": ID.format("a"), "distribution": [_csv(2022)]}]}
    late = {"dataset": [{"identifier": ID.format("b"), "distribution": [_csv(2022)]}]}
    specs = [("a", "a", None), ("b", "b", None), ("c", "c", None)]
    assert {k: r.status for k, r in _statuses(spark, [good, {"dataset": {}}, late], specs).items()} == {
        "a": "ok", "b": "dataset_not_list", "c": "dataset_not_list"}
    assert {r.status for r in _statuses(spark, ["not json", good], specs).values()} == {"catalog_not_object"}
    assert {k: r.status for k, r in _statuses(spark, [good, late], specs).items()} == {"a": "ok", "b": "ok", "c": "dataset_not_found"}
    assert {r.status for r in _statuses(spark, [], specs).values()} == {"dataset_not_found"}


def test_metastore_documents_never_vanish(spark):
    docs = {"ok": {"distribution": [5, {"downloadURL": ""}, {"downloadURL": "u", "format": "Zip"}, {"downloadURL": "v"}]},
            "csv": {"distribution": [{"downloadURL": "v", "format": 3}]}, "none": {"distribution": []}, "absent": {},
            "object": {"distribution": {"downloadURL": "x"}}, "null": {"distribution": None}, "array": [1], "text": "x", "broken": None}
    rows = [(k, "{" if v is None else json.dumps(v)) for k, v in docs.items()]
    got = {r.dataset_id: r for r in res.metastore_statuses(spark.createDataFrame(rows, "dataset_id string, body string")).collect()}
    assert {k: (r.csv_status, r.csv_url, r.zip_status, r.zip_url) for k, r in got.items()} == {
        "ok": ("ok", "u", "ok", "u"), "csv": ("ok", "v", "no_zip", None), "none": ("no_url", None, "no_zip", None),
        "absent": ("no_url", None, "no_zip", None), "object": ("distribution_not_list", None, "distribution_not_list", None),
        "null": ("distribution_not_list", None, "distribution_not_list", None), "array": ("metastore_not_object", None, "metastore_not_object", None),
        "text": ("metastore_not_object", None, "metastore_not_object", None), "broken": ("metastore_not_object", None, "metastore_not_object", None)}
