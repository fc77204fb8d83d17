"""Corpus pipeline over ``documents``: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm import decontaminate, jaccard_join, packing, pii, quality_cotrain
from meridian.llm.common import written
from meridian.sources.tables import table

#: the stages fit models, so no SQL gives their rows; tests compare them with plain versions
ORACLE_SQL = None

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    scored = quality_cotrain.classify(spark, docs, table(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.where("accepted").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents stays: the one with the smallest id.

    Documents without words are linked with nothing and stay. Of rows that repeat that id with
    one shingle set, one stays.
    """
    classes = jaccard_join.jaccard_join(spark, docs)
    classes = written(spark, classes, "pipeline-classes")
    first = (classes.where("n_shingles > 0 and doc_id <=> component_id").groupBy("doc_id", "sid")
             .agg(F.min("key").alias("_key"), F.count("*").alias("rows"))
             .select(F.col("doc_id").alias("_id"), "_key", (F.col("rows") > 1).alias("_repeats")))
    wordless = classes.where("n_shingles = 0").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"),
                                                      F.lit(False).alias("_repeats")).distinct()
    kept = written(spark, first.unionByName(wordless), "pipeline-kept")
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("_hash")).join(
        kept, F.expr("doc_id <=> _id and _hash = _key"))
    once = rows.where("not _repeats").select(*COLUMNS)
    if not kept.where("_repeats").limit(1).count():
        return once
    return once.unionByName(rows.where("_repeats").dropDuplicates(["doc_id", "_hash"]).select(*COLUMNS))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items contaminate go."""
    found = decontaminate.decontaminate(spark, docs, table(spark, sf_dir, "benchmark"))
    bad = found.where("contaminated").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    bad = written(spark, bad, "pipeline-bad")  # its size is known to the plan: small, it is broadcast and no text moves
    return docs.join(bad, F.expr("doc_id <=> _id and xxhash64(text) = _key"), "left_anti").select(*COLUMNS)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; the stated length follows the text."""
    found = pii.detect(spark, docs.withColumn("_null", F.col("text").isNull()), keep=["doc_id", "lang", "source", "n_chars", "_null"])
    text = F.when(F.size("found") > 0, pii.redacted(F.col("text"), F.col("found"))).otherwise(F.col("text"))
    rows = found.select("doc_id", F.when(~F.col("_null"), text).alias("text"), "lang", "source", "n_chars",
                        (F.size("found") > 0).alias("_hit"))
    return rows.select("doc_id", "text", "lang", "source",
                       F.when(F.col("_hit"), F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece of a document with its bin, place and token range."""
    return packing.best_fit(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents`` one after another."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
