"""Record typing and schema inference (D3 D4 I6a I6b) and clause pass-through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.functions.text import path_stem
from meridian.operators import pages as pg
from meridian.operators import query as qop
from meridian.operators import records as rec
from meridian.plans import derived, fixtures
from meridian.plans.registry import query
from meridian.sources import json_elements
from meridian.sources.tables import register


def _late_records(spark, sf_dir):
    register(spark, sf_dir, "events")
    return spark.sql(fixtures.late_props()).select("event_id", F.parse_json("body").alias("record"))


@query(
    "union_schema",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, "
    "CASE WHEN event_id % 1000 = 999 THEN concat('v', CAST(event_id AS VARCHAR)) END AS late FROM events",
)
def q_union_schema(spark, sf_dir):
    return rec.to_table(_late_records(spark, sf_dir), "record", mode="union", keep=["event_id"])


@query("first_schema", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def q_first_schema(spark, sf_dir):
    return rec.to_table(_late_records(spark, sf_dir), "record", mode="first", order_cols=["event_id"],
                        keep=["event_id"])


@query(
    "odd_member_names",
    "SELECT c_custkey AS id, c_custkey % 7 + 0.5::DOUBLE AS rate, concat('v', CAST(c_custkey % 3 AS VARCHAR)) AS its, "
    "CASE WHEN c_custkey % 5 = 0 THEN true END AS flag, "
    "CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE 'text' END AS mixed, c_custkey AS nested_id, "
    "CAST(c_custkey % 11 AS BIGINT) AS second FROM customer",
)
def q_odd_member_names(spark, sf_dir):
    """D3: inferred tables of records whose member names hold colons, commas, quotes, backticks and type names."""
    register(spark, sf_dir, "customer")
    records = spark.sql(fixtures.odd_records()).select(F.parse_json("body").alias("record"))
    found = rec.to_table(records, "record")
    return found.selectExpr("`:@id` AS id", "`rate, pct` AS rate", "`it's <b>: x` AS its", "`VOID` AS flag", "`mixed?` AS mixed",
                            "`a``b`.`x: y` AS nested_id", "`a``b`.`q, r`[1] AS second")


def _static_records(docs: DataFrame) -> DataFrame:
    pages = docs.select(F.col("path").alias("dataset"), F.col("shard").alias("offset"), "body", "path")
    parsed = pg.parse_pages(pages, "static", stem=path_stem(F.col("path")))
    return pg.flatten(pg.strict(parsed))


@query(
    "typed_glossary",
    "SELECT concat('doc-', CAST(doc_id AS VARCHAR)) AS slug, concat('Term ', CAST(doc_id AS VARCHAR)) AS title, "
    "text AS content, CAST(json_object('lang', lang, 'source', source) AS VARCHAR) AS _extra FROM documents",
)
def q_typed_glossary(spark, sf_dir):
    typed = rec.typed(_static_records(derived.glossary_docs(spark, sf_dir)).select("record"), "record",
                      rec.GLOSSARY_SCHEMA)
    return typed.select("slug", "title", "content", "_extra")


@query(
    "typed_articles",
    "SELECT concat('page-', CAST(page_id AS VARCHAR)) AS slug, concat('Page ', CAST(page_id AS VARCHAR)) AS title, "
    "url, html AS content, concat('2024-01-', lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0')) AS date, "
    "CAST(json_object('views', page_id % 100) AS VARCHAR) AS _extra FROM pages",
)
def q_typed_articles(spark, sf_dir):
    typed = rec.typed(_static_records(derived.article_docs(spark, sf_dir)).select("record"), "record",
                      rec.ARTICLE_SCHEMA)
    return typed.select("slug", "title", "url", "content", "date", "_extra")


@query("large_documents", "SELECT event_id, user_id, event_type, value, props FROM events")
def q_large_documents(spark, sf_dir):
    """Documents of half a million records each, cut into their records by many tasks."""
    found = json_elements.document_records(spark, derived.event_documents(spark, sf_dir))
    member = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}
    return found.select(*(F.variant_get("record", f"$.{k}", t).alias(k) for k, t in member.items()))


@query(
    "record_project",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' "
    "ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 OFFSET 50",
)
def q_record_project(spark, sf_dir):
    register(spark, sf_dir, "orders")
    return qop.clauses(spark.table("orders"), select=["o_orderkey", "o_custkey", "o_totalprice"],
                       where="o_orderstatus = 'F'", order="o_totalprice DESC, o_orderkey", limit=100, offset=50)


@query(
    "text_search",
    "SELECT doc_id, lang, source FROM documents WHERE contains(lower(text), 'ouai') "
    "OR contains(lower(lang), 'ouai') OR contains(lower(source), 'ouai')",
)
def q_text_search(spark, sf_dir):
    register(spark, sf_dir, "documents")
    return qop.clauses(spark.table("documents"), q="ouai").select("doc_id", "lang", "source")
