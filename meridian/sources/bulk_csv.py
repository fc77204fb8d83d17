"""Bulk CSV scan and landing (I7, K2) with full-scan type inference.

Files are cut into records in parallel (``csv_records``, also where quoted values span lines),
``from_csv`` parses each record to text columns, and the text is written once. Inference is one pass over that
text: every value becomes a mask of the types it fits, and one ``bit_and`` per column keeps
the types that fit all of them, so the plan does not grow with the columns; ``try_cast`` applies the result.
Inference rules (fixed values): a column is BOOLEAN if every non-empty value is
true/false, BIGINT if every value is an integer without a leading zero, DOUBLE if every
value is a decimal or exponent number without a leading zero, DATE for yyyy-MM-dd or
month-first M/d/yyyy, TIMESTAMP for yyyy-MM-dd HH:mm:ss[.f], else text. Leading zeros
keep identifiers text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.functions.joins import measured
from meridian.functions.lattice import ddl
from meridian.sinks.landing import RunMetrics, land
from meridian.sources import csv_records

MALFORMED = "_malformed_record"

# Inference patterns, tried in this order.
_INT = "\\A[+-]?(0|[1-9][0-9]*)\\z"
_DOUBLE = "\\A[+-]?(0|[1-9][0-9]*)?(\\.[0-9]*)?([eE][+-]?[0-9]+)?\\z"
_DATE = "\\A[0-9]{4}-[0-9]{2}-[0-9]{2}\\z"
_TS = "\\A[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]+)?\\z"
_DATE_US = "\\A[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\\z"
US_DATE_FORMAT = "M/d/yyyy"
TYPE_ORDER = ("boolean", "bigint", "double", "date", "date_us", "timestamp")


# Delimiters tried when none is given, in order of preference on ties.
DELIMITERS = (",", "\t", ";", "|")


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """The candidate delimiter that occurs most often (outside quotes) in the header line."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return ","
    header = first[0][0] or ""
    unquoted = "".join(part for i, part in enumerate(header.split('"')) if i % 2 == 0)
    counts = [(unquoted.count(d), -i, d) for i, d in enumerate(DELIMITERS)]
    best = max(counts)
    return best[2] if best[0] > 0 else ","


def _header(spark: SparkSession, path: str, sep: str) -> list[str]:
    """Column names: the header record of the first file, empty and repeated names as Spark's reader makes them."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("sep", sep).csv(path).columns


def _scan(spark: SparkSession, path: str, sep: str | None) -> DataFrame:
    """All columns as text, ``MALFORMED`` (the record, where its number of fields is not the header's) and the file's hash."""
    sep = sep or sniff_delimiter(spark, path)
    names = _header(spark, path, sep)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    shape = ddl(schema.add(MALFORMED, T.StringType()))[len("struct<"):-1].replace("`: ", "` ")
    options = {"sep": sep, "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": MALFORMED}
    # values keep their line breaks; the one that ends the record goes
    record = F.regexp_replace("record", "\r\\z", "")
    rows = csv_records.records(spark, path, sep).where("not header").select("file", F.from_csv(record, shape, options).alias("_r"))
    return rows.select("file", *(F.col("_r").getField(n).alias(n) for n in [*names, MALFORMED]))


def malformed_rows(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Records with more or fewer fields than the header: ``path, record, first_field``."""
    rows = _scan(spark, path, sep)
    bad = rows.where(F.col(f"`{MALFORMED}`").isNotNull()).select(
        F.col("file").alias("_file"), F.col(MALFORMED).alias("record"), _named(rows.columns[1]).alias("first_field"))
    files = spark.read.text(path).select(F.col("_metadata.file_path").alias("path")).distinct()
    return bad.join(files, F.xxhash64("path") == F.col("_file")).select("path", "record", "first_field")


def read_csv_text(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """I7 scan: header row, RFC 4180 quotes, every column as text; a record with more or fewer
    fields than the header fails the read (``malformed_rows`` lists them). Files are split across
    tasks whatever their values hold. ``sep=None`` sniffs the delimiter from the header line.
    """
    rows = _scan(spark, path, sep)
    fail = F.raise_error(F.concat(F.lit("malformed CSV record: "), F.col(MALFORMED))).cast("boolean")
    return rows.where(F.when(F.col(MALFORMED).isNull(), F.lit(True)).otherwise(fail)).drop(MALFORMED, "file")


def _mask(c: Column) -> Column:
    """The types that a value fits, as bits in the order of ``TYPE_ORDER``. The patterns exclude each other, but for integers."""
    def bits(*types: str) -> Column:
        return F.lit(sum(1 << TYPE_ORDER.index(t) for t in types))

    return (F.when(F.lower(c).isin("true", "false"), bits("boolean"))
            .when(c.rlike(_INT) & c.try_cast("bigint").isNotNull(), bits("bigint", "double"))
            .when(c.rlike(_DOUBLE) & c.rlike("[0-9]") & c.try_cast("double").isNotNull(), bits("double"))
            .when(c.rlike(_DATE) & c.try_cast("date").isNotNull(), bits("date"))
            .when(c.rlike(_DATE_US) & _us_date(c).isNotNull(), bits("date_us"))
            .when(c.rlike(_TS) & c.try_cast("timestamp").isNotNull(), bits("timestamp")).otherwise(F.lit(0)))


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _us_date(c: Column) -> Column:
    return F.call_function("try_to_date", c, F.lit(US_DATE_FORMAT))


def infer_types(df: DataFrame) -> dict[str, str]:
    """One pass over all values, one aggregate: per column, the first type that every non-empty value fits."""
    names = df.columns
    values = df.select(F.posexplode(F.array(*(_named(n) for n in names))).alias("i", "v")).where("v <> ''")
    fits = {r.i: r.m for r in values.groupBy("i").agg(F.bit_and(_mask(F.col("v"))).alias("m")).collect()}
    return {n: next((t for k, t in enumerate(TYPE_ORDER) if fits.get(i, 0) >> k & 1), "string") for i, n in enumerate(names)}


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    cols = []
    for name in df.columns:
        c = _named(name)
        t = types.get(name, "string")
        if t == "string":
            val = c
        elif t == "date_us":
            val = _us_date(F.nullif(c, F.lit("")))
        else:
            val = F.nullif(c, F.lit("")).try_cast(t)
        cols.append(val.alias(name))
    return df.select(*cols)


def read_typed_csv(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """The files parsed once to text, which is written; types are inferred from and applied to that."""
    raw = read_csv_text(spark, path, sep)
    text = measured(raw.toDF(*(f"c{i}" for i in range(len(raw.columns)))), "csv-text").toDF(*raw.columns)
    return apply_types(text, infer_types(text))


def bulk_load(spark: SparkSession, csv_path: str, root: str, asset: str, run_id: str,
              source_url: str | None = None) -> RunMetrics:
    """K2: CSV -> typed -> landed run (empty guard and metrics included)."""
    return land(read_typed_csv(spark, csv_path), root, asset, run_id, source_url=source_url or csv_path)
