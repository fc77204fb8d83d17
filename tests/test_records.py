import pytest
import json

from pyspark.sql import functions as F

from meridian.operators import records as rec


def _records(spark, items):
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "i int, body string")
    return df.select("i", F.parse_json("body").alias("record"))


def test_union_vs_first_schema(spark):
    df = _records(spark, [{"a": 1, "s": {"x": 1}}, {"a": 2, "b": "late", "s": {"y": "z"}}])
    union = rec.to_table(df, "record", keep=["i"]).orderBy("i").collect()
    assert [(r.a, r.b) for r in union] == [(1, None), (2, "late")]
    assert union[1].s.y == "z" and union[0].s.x == 1  # nested members are unioned
    first = rec.to_table(df, "record", mode="first", order_cols=["i"], keep=["i"])
    assert first.columns == ["i", "a", "s"]


def test_fractions_are_doubles_and_mixed_types_text(spark):
    df = _records(spark, [{"v": 1.5, "m": 1}, {"v": 2, "m": "x"}])
    out = rec.to_table(df, "record", keep=["i"]).orderBy("i")
    assert dict(out.dtypes)["v"] == "double"
    assert [(r.v, r.m) for r in out.collect()] == [(1.5, "1"), (2.0, "x")]


def test_typed_with_extras(spark):
    df = _records(spark, [{"title": "t", "slug": "s", "content": "c", "lang": "en"}, {"title": "u"}])
    out = rec.typed(df, "record", rec.GLOSSARY_SCHEMA).orderBy("i").collect()
    assert [(r.title, r.slug, r._extra) for r in out] == [("t", "s", '{"lang":"en"}'), ("u", None, None)]


def test_provider_nested_typing_and_violations(spark):
    good = {"other": 1, "enumeration_type": "NPI-2", "number": "7000000019",
            "taxonomies": [{"primary": True, "license": "L-5"}, {"desc": "Dentist"}],
            "addresses": [{"state": "OR", "country_code": "US"}], "basic": {"organization_name": "Clinic Nine"}}
    bare = {"number": "1", "enumeration_type": "NPI-3"}
    nonum = {"enumeration_type": "NPI-2"}
    p = rec.providers(_records(spark, [good, bare, nonum]))
    rows = p.orderBy("i").collect()
    assert rows[0].addresses[0].state == "OR" and rows[0].taxonomies[0].primary is True
    assert rows[0]._extra == '{"other":1}'
    assert rows[1].addresses == [] and rows[1].taxonomies == []
    v = {(r.i, r.violation) for r in rec.provider_violations(_records(spark, [good, bare, nonum]), ["i"]).collect()}
    assert v == {(1, "enumeration_type_invalid"), (2, "number_missing")}


def test_provider_extras_on_every_level_and_no_coercion(spark):
    deep = {"number": "7", "basic": {"status": "A", "authorized_official_last_name": "Q"},
            "addresses": [{"state": "OR", "fax_number": "9"}, {"state": "WA"}], "taxonomies": [{"code": "c", "taxonomy_group": "g"}]}
    row = rec.providers(_records(spark, [deep])).first()
    assert row.basic._extra == '{"authorized_official_last_name":"Q"}' and row._extra is None
    assert [a._extra for a in row.addresses] == ['{"fax_number":"9"}', None] and row.taxonomies[0]._extra == '{"taxonomy_group":"g"}'
    bad = [{"number": 123}, {"number": "1", "addresses": "x"}, {"number": "1", "taxonomies": [{"primary": "maybe"}]},
           {"number": "1", "basic": {"status": 4}}, {"number": "1", "basic": []}, {"number": "1", "addresses": [3]}, {"number": None}]
    found = {(r.i, r.violation) for r in rec.provider_violations(_records(spark, bad), ["i"]).collect()}
    assert found == {(0, "number_type"), (1, "addresses_type"), (2, "primary_type"), (3, "text_type"), (4, "basic_type"),
                     (5, "addresses_type"), (6, "number_missing")}
    for one in bad:
        with pytest.raises(Exception, match="invalid provider"):
            rec.valid_providers(_records(spark, [one])).collect()
    assert rec.valid_providers(_records(spark, [deep, {"number": "1", "enumeration_type": None}])).count() == 2


def test_member_names_are_data(spark):
    items = [{":@x": 1, "rate, pct": 1.5, "it's": "a", "VOID": None, "STRING": True, "a\"b'c": 3, "q?": [1, 2.5], "x[0]": {"in: ner": {"y`z": 1}}, "": 7},
             {":@x": 2, "VOID": None, "x[0]": {"in: ner": {"y`z": None, "OBJECT<a: BIGINT>": [{"p, q": "t"}]}}, "back\\slash": "b", "dot.ted": 4}]
    df = _records(spark, items)
    out = rec.to_table(df, "record", keep=["i"]).orderBy("i")
    assert set(out.columns) == {"i", *items[0], *items[1]}
    one, two = (r.asDict(recursive=True) for r in out.collect())
    assert one[":@x"] == 1 and one["rate, pct"] == 1.5 and one["it's"] == "a" and one["VOID"] is None and one["STRING"] is True
    assert one["a\"b'c"] == 3 and one["q?"] == [1.0, 2.5] and one[""] == 7 and two["back\\slash"] == "b" and two["dot.ted"] == 4
    assert one["x[0]"]["in: ner"]["y`z"] == 1 and two["x[0]"]["in: ner"]["OBJECT<a: BIGINT>"] == [{"p, q": "t"}]
    again = rec.to_table(df, "record", schema=rec.infer_schema(df))
    assert sorted(again.columns) == sorted([*{**items[0], **items[1]}])


def test_lattice_joins(spark):
    cases = [([1, None], "bigint"), ([1, 2.5], "double"), ([None], "string"), ([True, None], "boolean"), ([1, "x"], "string"),
             ([[1], [2.5]], "array<double>"), ([[], [None]], "array<string>"), ([[]], "array<string>"), ([{}], "string"),
             ([{"a": 1}, [1]], "string"), ([[{"a": 1}], [{"b": "t"}]], "array<struct<`a`: bigint, `b`: string>>"),
             ([{"a": [[1], [2]]}], "struct<`a`: array<array<bigint>>>"), ([{"m": 1}, {"m": "x"}], "struct<`m`: variant>"),
             ([2 ** 70, 1], "double")]
    for values, want in cases:
        assert rec.infer_schema(_records(spark, [{"v": v} for v in values])) == f"struct<`v`: {want}>", values
    assert rec.infer_schema(_records(spark, [5, "x", [1]])) == "struct<>"
    assert rec.to_table(_records(spark, [5]), "record", keep=["i"]).columns == ["i"]


def test_widening_of_landed_types():
    from meridian.functions.lattice import widened

    pairs = {("int", "bigint"): "bigint", ("bigint", "double"): "double", ("float", "bigint"): "double", ("date", "timestamp"): "timestamp",
             ("string", "int"): "string", ("boolean", "int"): "string", ("decimal(10,2)", "decimal(12,4)"): "decimal(12,4)",
             ("decimal(10,2)", "int"): "double", ("void", "date"): "date", ("date", "int"): "string"}
    assert all(widened(a, b) == t and widened(b, a) == t for (a, b), t in pairs.items())


def test_list_elements_are_cast_once(spark):
    df = _records(spark, [{"number": "1", "addresses": [{"city": "a", "x": 1}, 5, None], "taxonomies": "none"}])
    out = rec.providers(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # an element was cast again for every one of its fields
    assert plan.lower().count("as struct<address_purpose") == 1 and plan.lower().count("as struct<code") == 1
    row = out.first()
    assert [a and (a.city, a["_extra"]) for a in row.addresses] == [("a", '{"x":1}'), None, None] and row.taxonomies == []


def test_member_kinds_are_read_once(spark):
    df = _records(spark, [{"a": "t"}, {"a": None}, {}, {"a": 5}, {"a": {"b": 1}}, {"a": [1]}, {"a": True}])
    member = F.try_variant_get("record", "$.a", "variant")
    out = df.select("i", rec._is(member, "STRING").alias("text"), rec._is(member, "OBJECT", "ARRAY").alias("nested"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("$.a") == 2  # once for each question
    assert [(r.text, r.nested) for r in out.orderBy("i").collect()] == [
        (True, False), (True, True), (True, True), (False, False), (False, True), (False, True), (False, False)]
