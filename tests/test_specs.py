import pytest

from meridian.operators import specs as sp


def _specs(spark, rows):
    return sp.specs_from_rows(spark, rows)


def _row(key, source, **kw):
    return {"key": key, "source": source, "description": f"d {key}", "group": "g", **kw}


def test_defaults_and_order(spark):
    df = _specs(spark, [_row("a", "socrata", dataset_id="x"), _row("b", "healthcare_gov", path="/api/g.json")])
    rows = df.orderBy("pos").collect()
    assert [(r.pos, r.key, r.domain) for r in rows] == [(0, "a", "data.cms.gov"), (1, "b", "data.cms.gov")]


def test_unknown_fields_rejected(spark):
    with pytest.raises(ValueError, match="unknown fields"):
        _specs(spark, [_row("a", "socrata", dataset_id="x", surprise=1)])


def test_empty_spec_file(spark):
    assert _specs(spark, []).count() == 0


@pytest.mark.parametrize(
    "row, expected",
    [
        (_row("s1", "socrata"), {("dataset_id", "required")}),
        (_row("s2", "socrata", dataset_id="x", path="/p"), {("path", "forbidden")}),
        (_row("s3", "socrata", dataset_id="x", year=2024), {("year", "forbidden")}),
        (_row("h1", "healthcare_gov"), {("path", "required")}),
        (_row("h2", "healthcare_gov", path="/p", dataset_id=""), {("dataset_id", "forbidden")}),
        (_row("p1", "dkan_provider_data", dataset_id=""), {("dataset_id", "required")}),
        (_row("b1", "dkan_data_api_bulk", dataset_id="x", year=2024), set()),
        (_row("b2", "dkan_data_api_bulk", dataset_id="x", path="/p"), {("path", "forbidden")}),
        (_row("m1", "dkan_medicaid_bulk", dataset_id="x", year=2023), {("year", "forbidden")}),
        (_row("o1", "dkan_open_payments_bulk"), {("dataset_id", "required")}),
        (_row("z1", "dkan_healthcare_gov_zip", dataset_id="x", path="/p"), {("path", "forbidden")}),
        (_row("u1", "ftp"), {("source", "unknown_source")}),
    ],
)
def test_rules(spark, row, expected):
    got = {(r.field, r.kind) for r in sp.rule_violations(_specs(spark, [row])).collect()}
    assert got == expected


def test_duplicate_keys(spark):
    df = _specs(spark, [_row("a", "socrata", dataset_id="x"), _row("a", "socrata", dataset_id="y")])
    assert {(r.key, r.kind) for r in sp.rule_violations(df).collect()} == {("a", "duplicate_key")}


def test_routing_and_plan(spark):
    df = _specs(spark, [
        _row("a", "socrata", dataset_id="mhdd-npjx", domain="data.medicaid.gov"),
        _row("b", "healthcare_gov", path="/api/glossary.json"),
        _row("c", "dkan_healthcare_gov_zip", dataset_id="u-1"),
        _row("d", "ftp", dataset_id="x"),
        _row("e", "socrata"),
    ])
    assert [r.key for r in sp.unrouted(df).collect()] == ["d"]
    only_json = {r.key for r in sp.routed(df, only=("socrata", "healthcare_gov")).collect()}
    assert only_json == {"a", "b", "e"}
    plan = {r.key: (r.asset_name, r.loader, r.entry_url) for r in sp.load_plan(df).collect()}
    assert plan == {
        "a": ("cms_a", "json_pages", "https://data.medicaid.gov/resource/mhdd-npjx.json"),
        "b": ("cms_b", "static_json", "https://www.healthcare.gov/api/glossary.json"),
        "c": ("cms_c", "zipped_sheet", "https://data.healthcare.gov/api/1/metastore/schemas/dataset/items/u-1"),
    }


def test_sources_table_and_sync(spark):
    df = _specs(spark, [_row("a", "socrata", dataset_id="x"), _row("b", "healthcare_gov", path="/p")])
    extras = spark.createDataFrame([("cms_extra", "extra", "a"), ("cms_lost", "lost", "zz")],
                                   "name string, description string, after_key string")
    with pytest.raises(Exception, match="no spec has the key zz"):
        sp.source_table(df, extras).collect()
    assert [r.name for r in sp.unknown_anchors(df, extras).collect()] == ["cms_lost"]
    extras = extras.where("after_key = 'a'")
    table = sp.source_table(df, extras).orderBy("seq").collect()
    assert [(r.seq, r.name) for r in table] == [(0, "cms_a"), (1, "cms_extra"), (2, "cms_b")]
    declared = spark.createDataFrame([("cms_a", "d a"), ("cms_extra", "extra"), ("cms_old", "x")],
                                     "name string, description string")
    diff = {(r.name, r.problem) for r in sp.sources_diff(declared, sp.source_table(df, extras)).collect()}
    assert diff == {("cms_b", "missing_from_sources"), ("cms_old", "not_in_registry")}


def test_spec_file_variants(spark, tmp_root):
    import os

    d = tmp_root.replace("file:", "")
    os.makedirs(d, exist_ok=True)
    one = f"{d}/one.toml"
    with open(one, "w") as fh:
        fh.write('[[dataset]]\nkey = "a"\nsource = "socrata"\ndescription = "d"\ngroup = "g"\ndataset_id = "x"\nyear = 2024\n')
    empty = f"{d}/empty.toml"
    with open(empty, "w") as fh:
        fh.write("")
    bad = f"{d}/bad.toml"
    with open(bad, "w") as fh:
        fh.write('dataset = "nope"\n')
    rows = sp.load_spec_file(spark, one).collect()
    assert [(r.key, r.year, r.domain) for r in rows] == [("a", 2024, "data.cms.gov")]
    assert sp.load_spec_file(spark, empty).count() == 0
    with pytest.raises(TypeError):
        sp.load_spec_file(spark, bad)


@pytest.mark.parametrize("text", ['dataset = ""', "dataset = 0", "dataset = false", "[dataset]"])
def test_spec_file_of_another_shape_fails(spark, tmp_path, text):
    (tmp_path / "s.toml").write_text(text)
    with pytest.raises(TypeError):
        sp.load_spec_file(spark, str(tmp_path / "s.toml"))
