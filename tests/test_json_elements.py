import json
import random

import pytest

from meridian.operators import pages as pg
from meridian.sources import json_elements, static_json


def _write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8", newline="")


def _got(spark, pattern):
    rows = json_elements.document_records(spark, pattern, "lenient").selectExpr("path", "place", "to_json(record) as r").collect()
    out: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.path, r.place.start, r.place.seq)):
        out.setdefault(r.path.rsplit("/", 1)[-1], []).append(json.loads(r.r))
    return out


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def _value(rnd, depth=0):
    kind = rnd.randrange(8 if depth < 3 else 5)
    if kind < 2:
        return rnd.randrange(10**6)
    if kind < 5:
        return "".join(rnd.choice('ab,:{}[]"\\\n é𝄞') for _ in range(rnd.randrange(60)))
    if kind < 7:
        return {f"k{i}": _value(rnd, depth + 1) for i in range(rnd.randrange(4))}
    return [_value(rnd, depth + 1) for _ in range(rnd.randrange(4))]


def test_any_split_gives_all_records(spark, tmp_path, small_splits):
    rnd = random.Random(5)
    want = {}
    for i in range(14):
        records = [{"id": j, "v": _value(rnd)} if rnd.random() < 0.9 else _value(rnd, 3) for j in range(rnd.choice([0, 1, 40]))]
        doc = records if i % 2 else {"a": _value(rnd), f"doc{i}": records, "other": [{"x": 1}], "z": _value(rnd)}
        text = json.dumps(doc, ensure_ascii=bool(i % 3), indent=[None, 1][i % 2])
        _write(tmp_path, f"doc{i}.json", text + ["", "\n", " "][i % 3])
        kept = [r for r in records if isinstance(r, dict)]
        if kept:
            want[f"doc{i}.json"] = kept
    assert _got(spark, f"{tmp_path}/*.json") == want


def test_errors_as_for_small_documents(spark, tmp_path, small_splits):
    bad = {"cut": '[{"a": 1}, {"b": 2', "comma": '[{"a": 1},]', "gap": '[{"a": 1},,{"b": 2}]', "empty": "", "text": '"x"',
           "inner": '{"inner": {"a": 1}}', "space": '[{"a": 1} {"b": 2}]', "kinds": '[{"a": 1}}', "open": '{"open": [{"a": 1}]',
           "element": '[{"a": tru}]', "member": '{"member": [{"a": 1}], "x": }', "string": '[{"a": "b}]'}
    good = {"none": "[]", "missing": '{"x": [1]}', "blank": "[ \n]", "wrapped": '{"wrapped": []}\n', "ok": '{"ok":[{"a":"}"}]}',
            "after": '[{"a": 1}]]', "nulls": '[null, {"a": null}, null]'}
    for name, text in (bad | good).items():
        _write(tmp_path, f"{name}.json", text)
    docs, _ = json_elements.cut_documents(spark, f"{tmp_path}/*.json")
    got = {r.path.rsplit("/", 1)[-1][:-5]: r.page_error for r in docs.collect()}
    whole = pg.parse_pages(static_json.read_documents(spark, f"{tmp_path}/*.json"), "static", json_elements.path_stem(pg.F.col("path")))
    want = {r.path.rsplit("/", 1)[-1][:-5]: r.page_error for r in whole.select("path", "page_error").collect()}
    assert got == want | {"empty": pg.MALFORMED}
    assert {k for k, v in got.items() if v} == set(bad)
    with pytest.raises(ValueError, match="bad page"):
        json_elements.document_records(spark, f"{tmp_path}/*.json")


def test_one_line_document_is_read_by_many_tasks(spark, tmp_path):
    n = 60_000
    with open(tmp_path / "big.json", "w") as out:
        out.write('{"big":[' + ",".join(f'{{"id":{i},"text":"{"x{" * 300}"}}' for i in range(n)) + "]}")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        assert json_elements._pieces(spark, f"{tmp_path}/big.json").rdd.getNumPartitions() >= 8
        got = json_elements.document_records(spark, f"{tmp_path}/big.json")
        row = got.selectExpr("variant_get(record, '$.id', 'bigint') as id").selectExpr("count(*) n", "sum(id) s").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (row.n, row.s) == (n, n * (n - 1) // 2)
