"""Every registered query of the subpackage over the smallest driver tables, against its SQL where there is one."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.test_entry import _bag, con  # noqa: F401

NAMES = sorted(n for n in entry.LLM_QUERIES if n != "pipeline")


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in NAMES) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(entry.LLM_ORACLES))
def test_query_matches_oracle(spark, con, name):  # noqa: F811
    df = entry.queries()[name](spark, SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(cols, cur.fetchall())


@pytest.mark.parametrize("name", [n for n in NAMES if n not in entry.LLM_ORACLES])
def test_query_covers_its_table(spark, name):
    table = "pages" if name.startswith(("op1_", "op8_")) else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    df = entry.queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BatchEvalPython" not in plan
    ids = {r[0] for r in df.select(key).collect()}
    assert ids == {r[0] for r in spark.read.parquet(f"{SMALL}/{table}.parquet").select(key).collect()}


def test_warc_query_against_brute_force(spark):
    import base64
    import hashlib

    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    data = {p.page_id: (p.html or "").encode() for p in pages}
    last = {}
    for i in sorted(data):
        last[data[i]] = i
    want = sorted((i, len(d), base64.b32encode(hashlib.sha1(d).digest()).decode(), "response" if last[d] == i else "revisit",
                   str(None if last[d] == i else last[d])) for i, d in data.items())
    got = entry.queries()["op1_warc"](spark, SMALL).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == want
