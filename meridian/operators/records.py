"""Records to tables: D3 (inferred schema), D4 (typed nested struct with extras), D5, V7.

Records arrive as a VARIANT column. Inference is one aggregate over (member path, kind) pairs for
each level of nesting, joined by the lattice of ``functions/lattice.py``; typing is a per-row cast.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.functions import lattice

# Typed record schemas (field name and type, in declaration order).
GLOSSARY_SCHEMA = "struct<title:string, slug:string, content:string>"
ARTICLE_SCHEMA = "struct<title:string, slug:string, url:string, content:string, date:string>"
ADDRESS_FIELDS = [
    "address_purpose", "address_type", "address_1", "address_2", "city", "state",
    "postal_code", "country_code", "telephone_number",
]
TAXONOMY_SCHEMA = "struct<code:string, desc:string, primary:boolean, state:string, license:string>"
BASIC_FIELDS = [
    "first_name", "last_name", "organization_name", "credential", "sole_proprietor", "gender",
    "enumeration_date", "last_updated", "status",
]
BASIC_SCHEMA = f"struct<{', '.join(f + ':string' for f in BASIC_FIELDS)}>"
ADDRESS_SCHEMA = f"struct<{', '.join(f + ':string' for f in ADDRESS_FIELDS)}>"
PROVIDER_SCHEMA = (
    f"struct<number:string, enumeration_type:string, basic:{BASIC_SCHEMA}, addresses:array<{ADDRESS_SCHEMA}>, "
    f"taxonomies:array<{TAXONOMY_SCHEMA}>>"
)
#: what is cast in one piece; the lists are cast element by element
PROVIDER_MEMBERS = f"struct<number:string, enumeration_type:string, basic:{BASIC_SCHEMA}>"
ENUMERATION_TYPES = ("NPI-1", "NPI-2")


def _top_fields(schema: str) -> list[str]:
    """Top-level field names of a ``struct<...>`` type string."""
    return T.DataType.fromDDL(schema).names


def with_extras(record: Column, schema: str) -> Column:
    """JSON text of the members not in ``schema`` (extras are kept, as ``extra="allow"``)."""
    return _extras(record.cast("map<string,variant>"), schema)


def _extras(members: Column, schema: str) -> Column:
    names = _top_fields(schema)
    rest = F.map_filter(members, lambda k, v: ~k.isin(*names))
    # bound to a variable: the members are read once, not for the test and again for the text
    return F.get(F.transform(F.array(rest), lambda m: F.when(F.size(m) > 0, F.to_json(m))), F.lit(0))


def typed(records: DataFrame, record_col: str, schema: str, keep_extra: bool = True) -> DataFrame:
    """Cast each record to ``schema``; missing members -> NULL, extras -> ``_extra`` JSON."""
    rec = F.col(record_col)
    cols = [c for c in records.columns if c != record_col]
    out = records.select(*cols, rec.try_cast(schema).alias("_t"), *(
        [with_extras(rec, schema).alias("_extra")] if keep_extra else []))
    return out.select(*cols, "_t.*", *(["_extra"] if keep_extra else []))


def infer_type(records: DataFrame, record_col: str = "record", mode: str = "union",
               order_cols: list[str] | None = None) -> T.StructType:
    """D3: the table type of a set of records (non-objects do not count), see ``infer_schema``."""
    rec = F.col(record_col)
    objects = records.where(F.startswith(F.schema_of_variant(rec), F.lit("OBJECT")))
    whole = lattice.type_at(lattice.places(objects, rec))
    fields = [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.VariantType) else f.dataType) for f in whole.fields]
    if mode == "first":
        if not order_cols:
            raise ValueError("mode='first' needs order_cols")
        first = objects.agg(F.to_json(F.min_by(rec, F.struct(*order_cols))).alias("j")).first()["j"]
        wanted = set(json.loads(first or "{}"))
        fields = [f for f in fields if f.name in wanted]
    return T.StructType(fields)


def infer_schema(records: DataFrame, record_col: str = "record", mode: str = "union",
                 order_cols: list[str] | None = None) -> str:
    """D3: the table schema of a set of records as DDL text.

    ``union``: every member seen in any record (our default). ``first``: only the
    members of the first record in ``order_cols`` order, as columnar libraries do when
    they take the column set from the first row (nested members are still unioned).
    Mixed top-level types are text; members may have any name.
    """
    return lattice.ddl(infer_type(records, record_col, mode, order_cols))


def to_table(records: DataFrame, record_col: str = "record", schema: str | None = None,
             mode: str = "union", order_cols: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """D3: records -> columns. Top-level mixed types are kept as JSON text."""
    found = T.DataType.fromDDL(schema) if schema else infer_type(records, record_col, mode, order_cols)
    rec = F.col(record_col)
    cols = []
    for field in found.fields:
        member = _member(rec, field.name)
        if isinstance(field.dataType, T.StringType):
            # strings stay raw; JSON null is NULL; numbers/objects in a text column render as JSON
            kind = F.schema_of_variant(member)
            val = (F.when(kind == "VOID", F.lit(None).cast("string"))
                   .when(kind == "STRING", F.try_variant_get(member, "$", "string"))
                   .otherwise(F.to_json(member)))
        else:
            val = F.try_variant_get(member, "$", lattice.ddl(field.dataType))
        cols.append(val.alias(field.name))
    return records.select(*(keep or []), *cols)


#: characters that a path step cannot quote
_UNQUOTABLE = re.compile(r"['\"?\\\[\]]")


def _member(record: Column, name: str) -> Column:
    """One member of a record: by path, or through a map of its members where a path cannot spell the name."""
    if name and not _UNQUOTABLE.search(name):
        return F.try_variant_get(record, f"$['{name}']", "variant")
    return F.try_element_at(record.cast("map<string,variant>"), F.lit(name))


def _nested_extra(parent: Column, schema: str) -> Column:
    """Extras of one nested member; a member that is no object has none."""
    return _extras(parent.try_cast("map<string,variant>"), schema)


def providers(records: DataFrame, record_col: str = "record") -> DataFrame:
    """D4 for provider records: nested struct, empty-list defaults, extras of every level in an
    ``_extra`` member of that level (JSON text). Every element of a list is cast once: fields are taken from the
    cast value, as ``withField`` on the cast itself would repeat it for each field."""
    rec = F.col(record_col)
    cols = [c for c in records.columns if c != record_col]
    lists = {"addresses": ADDRESS_SCHEMA, "taxonomies": TAXONOMY_SCHEMA}
    staged = records.select(
        *cols, rec.try_cast(PROVIDER_MEMBERS).alias("_t"), with_extras(rec, PROVIDER_SCHEMA).alias("_extra"),
        F.try_variant_get(rec, "$.basic", "variant").alias("_b"),
        *(F.try_variant_get(rec, f"$.{n}", "array<variant>").alias(f"_{n}") for n in lists))

    def listed(name: str, schema: str) -> Column:
        cast = F.transform(f"_{name}", lambda v: F.struct(v.try_cast(schema).alias("t"), _nested_extra(v, schema).alias("e")))
        return F.coalesce(F.transform(cast, lambda x: x["t"].withField("_extra", x["e"])),
                          F.array().cast(f"array<{schema[:-1]}, _extra:string>>"))

    basic = F.when(F.col("_t.basic").isNotNull(), F.col("_t.basic").withField("_extra", _nested_extra(F.col("_b"), BASIC_SCHEMA)))
    return staged.select(*cols, "_t.number", "_t.enumeration_type", basic.alias("basic"),
                         *(listed(n, schema).alias(n) for n, schema in lists.items()), "_extra")


def _is(v: Column, *kinds: str) -> Column:
    """Whether a member is absent, JSON null or of one of the kinds."""
    return F.coalesce(F.schema_of_variant(v).rlike(f"\\A(VOID\\z|{'|'.join(kinds)})"), F.lit(True))


def _texts_are_strings(parent: Column, names: list[str]) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & _is(F.try_variant_get(parent, f"$.{name}", "variant"), "STRING")
    return out


def record_violations(record: Column) -> Column:
    """V7 on the record itself (array of codes): ``number`` is a required text, ``enumeration_type``
    one of two values, every declared member of its type; nothing is coerced."""
    def member(name: str) -> Column:
        return F.try_variant_get(record, f"$.{name}", "variant")

    def elements(name: str) -> Column:
        return F.coalesce(F.try_variant_get(record, f"$.{name}", "array<variant>"), F.array().cast("array<variant>"))

    number, kind, basic = member("number"), member("enumeration_type"), member("basic")
    objects = {n: F.forall(elements(n), lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))) & _is(member(n), "ARRAY")
               for n in ("addresses", "taxonomies")}
    flags = F.forall(elements("taxonomies"), lambda v: _is(F.try_variant_get(v, "$.primary", "variant"), "BOOLEAN"))
    texts = (_texts_are_strings(basic, BASIC_FIELDS) & F.forall(elements("addresses"), lambda v: _texts_are_strings(v, ADDRESS_FIELDS))
             & F.forall(elements("taxonomies"), lambda v: _texts_are_strings(v, ["code", "desc", "state", "license"])))
    value = F.try_variant_get(record, "$.enumeration_type", "string")
    return F.array_compact(F.array(
        F.when(number.isNull() | (F.schema_of_variant(number) == "VOID"), "number_missing").when(~_is(number, "STRING"), "number_type"),
        F.when(~_is(kind, "STRING") | (value.isNotNull() & ~value.isin(*ENUMERATION_TYPES)), "enumeration_type_invalid"),
        F.when(~_is(basic, "OBJECT"), "basic_type"), F.when(~objects["addresses"], "addresses_type"),
        F.when(~objects["taxonomies"], "taxonomies_type"), F.when(~flags, "primary_type"), F.when(~texts, "text_type")))


def provider_violations(records: DataFrame, key_cols: list[str], record_col: str = "record") -> DataFrame:
    """V7 as a report: one row per violation."""
    out = records.select(*key_cols, record_violations(F.col(record_col)).alias("_v"))
    # an inner explode would infer a filter and evaluate every rule twice
    return out.select(*key_cols, F.explode_outer("_v").alias("violation")).where("violation is not null")


def valid_providers(records: DataFrame, record_col: str = "record") -> DataFrame:
    """V7 as a check: a record with a violation fails the job."""
    found = record_violations(F.col(record_col))
    message = F.concat(F.lit("invalid provider: "), F.array_join(found, ", "), F.lit(" in "), F.to_json(F.col(record_col)))
    checked = F.when(F.size(found) == 0, F.col(record_col)).otherwise(F.raise_error(message).cast("variant"))
    return records.withColumn(record_col, checked)
