"""Static JSON documents from storage (I6): one document per file, read whole.

Each file is one response (a bare array, or an object wrapping the array under the
file's stem); files are read in parallel, one row per file. Documents too large for one value are
cut into their records by ``json_elements``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions.text import path_stem
from meridian.operators import pages as pg


def read_documents(spark: SparkSession, pattern: str) -> DataFrame:
    """``(path, body)`` per file via the text source in whole-file mode."""
    # file paths are URIs: percent-decode (keeping a literal '+', which url_decode reads as space)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return spark.read.text(pattern, wholetext=True).select(path.alias("path"), F.col("value").alias("body"))


def static_records(docs: DataFrame, mode: str = "strict") -> DataFrame:
    """Records of every document; non-objects dropped; a document whose wrapped
    member is not a list fails (strict) or is skipped (lenient)."""
    pages = docs.select(F.col("path").alias("dataset"), F.lit(0).cast("bigint").alias("offset"), "body", "path")
    parsed = pg.parse_pages(pages, "static", stem=path_stem(F.col("path")))
    parsed = pg.strict(parsed) if mode == "strict" else parsed.where(F.col("page_error").isNull())
    return pg.flatten(parsed, keep=["path"]).drop("dataset", "offset")
