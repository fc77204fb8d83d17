import json

from meridian.operators import catalog as cat

NEEDLE = "https://data.cms.gov/data-api/v1/dataset/{}/data-viewer"


def _dist(year, url="u", media="text/csv", **kw):
    d = {"mediaType": media, "downloadURL": url, "temporal": f"{year}-01-01/{year}-12-31"} if year else {
        "mediaType": media, "downloadURL": url}
    d.update(kw)
    return d


def _catalog(spark, datasets, doc_seq=0):
    return spark.createDataFrame([(doc_seq, json.dumps({"dataset": datasets}))], "doc_seq bigint, body string")


def _csv(spark, datasets):
    entries = cat.catalog_entries(_catalog(spark, datasets))
    return cat.csv_distributions(cat.distributions(entries, ["doc_seq", "pos", "identifier"]))


def test_latest_and_explicit_year(spark):
    ds = [{"identifier": NEEDLE.format("abc"), "distribution": [_dist(2023, "u23"), _dist(2024, "u24")]}]
    keys = ["doc_seq", "pos", "identifier"]
    csv = _csv(spark, ds)
    assert [(r.year, r.url) for r in cat.latest_csv(csv, keys).collect()] == [(2024, "u24")]
    req = spark.createDataFrame([(0, 0, NEEDLE.format("abc"), 2023)], "doc_seq bigint, pos int, identifier string, year int")
    assert [r.url for r in cat.csv_for_year(csv, req, keys).collect()] == ["u23"]


def test_duplicate_year_last_wins_and_noise_skipped(spark):
    dists = [_dist(2024, "first"), _dist(2024, "second"), _dist(2025, "pdf", media="application/pdf"),
             _dist(2026, None), _dist(None, "no-year"), {"mediaType": "text/csv", "downloadURL": "x", "temporal": "n/a"},
             "not an object", _dist(2026, "")]
    csv = _csv(spark, [{"identifier": NEEDLE.format("d"), "distribution": dists}])
    assert [(r.year, r.url) for r in cat.latest_csv(csv, ["identifier"]).collect()] == [(2024, "second")]


def test_missing_year_lists_available(spark):
    csv = _csv(spark, [{"identifier": "i", "distribution": [_dist(2024), _dist(2022), _dist(2024)]}])
    req = spark.createDataFrame([("i", 2030)], "identifier string, year int")
    out = cat.missing_years(csv, req, ["identifier"]).collect()
    assert [(r.year, r.available) for r in out] == [(2030, "2022,2024")]


def test_catalog_errors(spark):
    docs = spark.createDataFrame([(0, "[1,2]"), (1, json.dumps({"dataset": {"a": 1}})), (2, json.dumps({}))],
                                 "doc_seq bigint, body string")
    assert {(r.doc_seq, r.error) for r in cat.catalog_errors(docs).collect()} == {
        (0, "catalog_not_object"), (1, "dataset_not_list")}
    assert cat.catalog_entries(docs).count() == 0


def test_spec_match_prefix_collision_first_in_order(spark):
    entries = cat.catalog_entries(_catalog(spark, [
        {"identifier": NEEDLE.format("10")}, {"identifier": NEEDLE.format("1")}, 7, {"identifier": 5},
        {"identifier": NEEDLE.format("2")},
    ]))
    specs = spark.createDataFrame([("k1", "1"), ("k2", "2"), ("k3", "3")], "key string, dataset_id string")
    matched = cat.match_specs(specs, entries)
    got = {r.key: r.identifier for r in matched.collect()}
    assert got == {"k1": NEEDLE.format("10"), "k2": NEEDLE.format("2")}
    assert [(r.key, r.dataset_id) for r in cat.unmatched_specs(specs, matched).collect()] == [("k3", "3")]


def _meta(spark, docs):
    return spark.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v)) for k, v in docs.items()],
                                 "dataset_id string, body string")


def test_first_url_format_ignored(spark):
    meta = _meta(spark, {
        "a": {"distribution": [{"format": "csv", "downloadURL": "ua"}]},
        "b": {"distribution": [{"format": "csv"}]},
        "c": {"distribution": [{"format": "pdf"}, {"format": "xls", "downloadURL": "uc"}]},
    })
    assert {r.dataset_id: r.url for r in cat.first_url(meta).collect()} == {"a": "ua", "c": "uc"}


def test_first_zip(spark):
    meta = _meta(spark, {
        "fmt": {"distribution": [{"format": "zip", "downloadURL": "u1"}]},
        "media": {"distribution": [{"mediaType": "application/zip", "downloadURL": "u2"}]},
        "later": {"distribution": [{"format": "pdf", "downloadURL": "p"}, {"format": "ZIP", "downloadURL": "u3"}]},
        "none": {"distribution": [{"format": "csv", "downloadURL": "c"}]},
        "nourl": {"distribution": [{"format": "zip"}]},
        "nonstr": {"distribution": [{"format": 5, "mediaType": ["zip"], "downloadURL": "x"}]},
    })
    assert {r.dataset_id: r.url for r in cat.first_zip(meta).collect()} == {"fmt": "u1", "media": "u2", "later": "u3"}


def test_live_ids(spark):
    meta = _meta(spark, {
        "ok": {"identifier": "ok", "distribution": [{"identifier": "live"}, {"identifier": "old"}]},
        "none": {"distribution": []},
        "absent": {"identifier": "x"},
        "first_str": {"distribution": ["x", {"identifier": "y"}]},
        "no_id": {"distribution": [{"title": "t"}]},
        "num_id": {"distribution": [{"identifier": 5}]},
        "array": [1, 2],
    })
    got = {r.dataset_id: (r.live_id, r.status) for r in cat.live_ids(meta).collect()}
    assert got == {
        "ok": ("live", "ok"), "none": (None, "no_distributions"), "absent": (None, "no_distributions"),
        "first_str": (None, "first_not_object"), "no_id": (None, "identifier_missing"),
        "num_id": (None, "identifier_missing"), "array": (None, "metastore_not_object"),
    }


def test_specs_meet_only_the_first_entry_of_their_id(spark):
    # 20,000 specs of one id and 20,000 entries that it matches: 400 million pairs if all of them were joined
    entries = spark.range(20_000).selectExpr("id as doc_seq", "0 as pos", f"'{NEEDLE.format('1')}' as identifier")
    specs = spark.range(20_000).selectExpr("concat('k', id) as key", "'1' as dataset_id")
    specs = specs.unionByName(specs.limit(5)).unionByName(spark.sql("select 'none' as key, '2' as dataset_id"))
    got = cat.match_specs(specs, entries)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")  # nothing is grouped after the join with the specs
    rows = got.collect()
    assert len(rows) == 20_000 and {(r.doc_seq, r.pos, r.dataset_id) for r in rows} == {(0, 0, "1")}
