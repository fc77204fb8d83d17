"""Stored-response fixtures derived from the driver tables with DataFrame jobs.

These stand in for the HTTP responses the original readers fetch: each one is a
Spark job over the driver tables, so its size grows with them. Every page/document
groups a bounded number of rows (a page of ``batch`` rows, a chunk of turns), so no
task or group ever holds an unbounded set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.functions.ranking import row_index
from meridian.session import fresh_path
from meridian.sources.tables import table


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a fixture once to the shared folder and scan it back, as stored responses are
    read in real use (and so that every branch of a plan reads the same files)."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)

EVENT_FIELDS = ["event_id", "user_id", "event_type", "value", "props"]


def ranked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their 0-based rank inside event_type by event_id (skew-safe numbering)."""
    ev = table(spark, sf_dir, "events").select(*EVENT_FIELDS)
    return row_index(ev, ["event_type"], "event_id", "rk")


def event_pages(
    spark: SparkSession,
    sf_dir: str,
    batch: int = 50,
    drop_every: int | None = 97,
    envelope: str = "array",
    hole_every: int | None = None,
    dataset_prefix: str = "",
) -> DataFrame:
    """``(dataset, offset, n, body)`` pages of ``batch`` events per event_type.

    Every ``drop_every``-th event (by id) is removed after paging, so short pages appear
    mid-sequence; with ``hole_every`` pages whose index mod ``hole_every`` is 7 are not
    stored at all.
    """
    ev = ranked_events(spark, sf_dir).withColumn("offset", (F.floor(F.col("rk") / batch) * batch).cast("bigint"))
    if drop_every:
        ev = ev.where(F.col("event_id") % drop_every != 0)
    if hole_every:
        ev = ev.where((F.col("offset") / batch).cast("bigint") % hole_every != 7)
    recs = F.array_sort(F.collect_list(F.struct(*EVENT_FIELDS)))
    pages = ev.groupBy(F.concat(F.lit(dataset_prefix), F.col("event_type")).alias("dataset"), "offset").agg(
        recs.alias("recs")
    )
    body = F.to_json("recs") if envelope == "array" else F.to_json(F.struct(F.col("recs").alias("results")))
    pages = pages.select("dataset", "offset", F.size("recs").alias("n"), body.alias("body"))
    if not drop_every and not hole_every:
        pages = pages.unionByName(_closing_pages(pages, batch, "[]" if envelope == "array" else '{"results":[]}'))
    return stored(pages, "event-pages")


def event_documents(spark: SparkSession, sf_dir: str, per_doc: int = 500_000) -> str:
    """Large static documents, as a pattern of files: ``per_doc`` events each, one bare array a file that holds the events by id and a
    null at its end. Their number grows with the events, their size does not depend on a task's memory."""
    ev = table(spark, sf_dir, "events").select(F.expr(f"event_id div {per_doc}").alias("part"), "event_id",
                                               F.to_json(F.struct(*EVENT_FIELDS)).alias("value"))
    parts = ev.select("part").distinct()
    lines = (ev.select("part", "event_id", F.concat("value", F.lit(",")).alias("value"))
             .unionByName(parts.select("part", F.lit(-1).cast("bigint").alias("event_id"), F.lit("[").alias("value")))
             .unionByName(parts.select("part", F.lit(2**63 - 1).alias("event_id"), F.lit("null]").alias("value"))))
    path = fresh_path(spark, "event-documents")
    (lines.repartition("part").sortWithinPartitions("part", "event_id").select("part", "value")
     .write.partitionBy("part").text(path))
    return f"{path}/part=*/*.txt"


def _closing_pages(pages: DataFrame, batch: int, body: str) -> DataFrame:
    """The empty page that ends a sequence whose last page is full."""
    last = pages.groupBy("dataset").agg(F.max_by("n", "offset").alias("n"), F.max("offset").alias("offset"))
    return last.where(F.col("n") == batch).select(
        "dataset", (F.col("offset") + batch).alias("offset"), F.lit(0).alias("n"), F.lit(body).alias("body"))


def conversation_pack(spark: SparkSession, sf_dir: str, chunk: int = 8) -> DataFrame:
    """One static JSON document per (conv_id, turn chunk): ``(path, stem, conv_id, chunk, body)``.

    Even conv_id: bare array; odd: object wrapping the array under the path stem.
    Every 5th conversation also carries the scalars 42 and "junk"; every 50th is
    malformed (its stem member is a string, not an array).
    """
    conv = table(spark, sf_dir, "conversations").withColumn("chunk", (F.col("turn") / chunk).cast("bigint"))
    stem = F.concat(F.lit("conv_"), F.col("conv_id").cast("string"), F.lit("_"), F.col("chunk").cast("string"))
    docs = conv.groupBy("conv_id", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("recs")
    ).withColumn("stem", stem)
    arr = F.to_json("recs")
    junk_arr = F.concat(F.expr("substr(to_json(recs), 1, length(to_json(recs)) - 1)"), F.lit(', 42, "junk"]'))
    inner = F.when(F.col("conv_id") % 5 == 0, junk_arr).otherwise(arr)
    wrapped = F.concat(F.lit('{"'), F.col("stem"), F.lit('": '), inner, F.lit(', "meta": {"n": 1}}'))
    bad = F.concat(F.lit('{"'), F.col("stem"), F.lit('": "not a list"}'))
    body = (
        F.when(F.col("conv_id") % 50 == 0, bad)
        .when(F.col("conv_id") % 2 == 0, inner)
        .otherwise(wrapped)
    )
    path = F.concat(F.lit("/api/"), F.col("stem"), F.lit(".json"))
    return stored(docs.select(path.alias("path"), "stem", "conv_id", "chunk", body.alias("body")), "conv-docs")


# Identifier template of catalog entries built by the fixtures.
CATALOG_IDENTIFIER = "https://data.example.org/data-api/v1/dataset/{ds}/data-viewer"


def _dist_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per dataset: the distribution list as JSON text, in partkey order (<= 100 per dataset).

    ds mod 9 = 4: empty list; = 5: a leading non-object entry; = 6: first entry has no identifier.
    """
    from meridian.plans import fixtures

    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    d = spark.sql(fixtures.part_distributions())
    dist = F.struct(
        F.col("identifier"), F.col("title"), F.col("media_type").alias("mediaType"), "format",
        F.col("url").alias("downloadURL"), "temporal",
    )
    lists = d.groupBy("ds_num", "ds").agg(F.array_sort(F.collect_list(F.struct("p_partkey", dist.alias("d")))).alias("l"))
    items = F.transform("l", lambda x, i: F.when(
        (F.col("ds_num") % 9 == 6) & (i == 0), x["d"].withField("identifier", F.lit(None).cast("string"))
    ).otherwise(x["d"]))
    text = F.to_json(items)
    text = (F.when(F.col("ds_num") % 9 == 4, F.lit("[]"))
            .when(F.col("ds_num") % 9 == 5, F.concat(F.lit('["x",'), F.substring(text, F.lit(2), F.length(text))))
            .otherwise(text))
    return lists.select("ds_num", "ds", text.alias("dist_json"))


def metastore_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bare metastore documents ``(dataset_id, body)``, one per dataset."""
    lists = _dist_lists(spark, sf_dir)
    body = F.concat(F.lit('{"identifier":"'), F.col("ds"), F.lit('","title":"Dataset '), F.col("ds"),
                    F.lit('","distribution":'), F.col("dist_json"), F.lit("}"))
    return stored(lists.select(F.col("ds").alias("dataset_id"), body.alias("body")), "metastore")


def catalog_docs(spark: SparkSession, sf_dir: str, per_doc: int = 10) -> DataFrame:
    """DCAT catalog shards ``(doc_seq, body)``: ``per_doc`` datasets each (plus a junk scalar).

    Catalog order is descending shard then ascending dataset, so ``1`` meets ``10``..``19`` first.
    """
    lists = _dist_lists(spark, sf_dir)
    ident = F.concat(F.lit("https://data.example.org/data-api/v1/dataset/"), F.col("ds"), F.lit("/data-viewer"))
    entry = F.concat(F.lit('{"identifier":"'), ident, F.lit('","title":"Dataset '), F.col("ds"),
                     F.lit('","distribution":'), F.col("dist_json"), F.lit("}"))
    shard = (F.col("ds_num") / per_doc).cast("bigint")
    docs = lists.groupBy(shard.alias("doc")).agg(F.array_sort(F.collect_list(F.struct("ds_num", entry.alias("e")))).alias("es"))
    body = F.concat(F.lit('{"dataset":['), F.array_join(F.transform("es", lambda x: x["e"]), ","), F.lit(",7]}"))
    return stored(docs.select((-F.col("doc")).alias("doc_seq"), body.alias("body")), "catalog")


def provider_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One provider JSON record per customer: ``(c_custkey, state, enumeration_type, body)``.

    number = custkey zero-padded to 10 (missing when custkey mod 97 = 5); enumeration type
    cycles NPI-1 / NPI-2 with an invalid value when custkey mod 31 = 2; two addresses
    (location in the customer's nation, mailing in another); taxonomies from the market
    segment (empty when custkey mod 10 = 0); an extra member ``other_names``.
    """
    from meridian.plans import fixtures

    for t in ("customer", "nation"):
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    # a table may be one file of one row group, which one task would write as one file, for one task to read
    rows = spark.sql(fixtures.provider_rows()).repartition("c_custkey", "c_name")
    return stored(rows.select(
        "c_custkey", "state", "enumeration_type", F.col("number").isNotNull().alias("has_number"),
        F.to_json(F.struct(
            F.col("number"), F.col("enumeration_type"),
            F.struct("first_name", "last_name", "organization_name", "status",
                     F.col("last_name").alias("authorized_official_last_name")).alias("basic"),
            F.array(
                F.struct(F.lit("LOCATION").alias("address_purpose"), F.col("address_1"), F.col("city"),
                         F.col("state"), F.col("postal_code"), F.col("postal_code").alias("fax_number")),
                F.struct(F.lit("MAILING").alias("address_purpose"), F.col("address_1"), F.col("mail_city").alias("city"),
                         F.col("mail_state").alias("state"), F.col("postal_code"),
                         F.lit(None).cast("string").alias("fax_number")),
            ).alias("addresses"),
            F.when(F.col("c_custkey") % 10 == 0, F.array().cast("array<struct<code:string,desc:string,primary:boolean,taxonomy_group:string>>"))
            .otherwise(F.array(F.struct(F.col("tax_code").alias("code"), F.col("c_mktsegment").alias("desc"),
                                        F.lit(True).alias("primary"),
                                        F.concat(F.lit("g"), (F.col("c_custkey") % 3).cast("string")).alias("taxonomy_group")
                                        ))).alias("taxonomies"),
            F.array(F.struct(F.col("c_name").alias("name"))).alias("other_names"),
        )).alias("body"),
    ), "provider-records")


def provider_pages(spark: SparkSession, sf_dir: str, page_size: int = 200) -> DataFrame:
    """Search responses of a state sweep restricted to NPI-2: ``(dataset=state, offset, body)``."""
    recs = provider_records(spark, sf_dir).where((F.col("enumeration_type") == "NPI-2") & F.col("has_number"))
    ranked = row_index(recs, ["state"], "c_custkey", "rk").withColumn(
        "offset", (F.floor(F.col("rk") / page_size) * page_size).cast("bigint"))
    pages = ranked.groupBy(F.col("state").alias("dataset"), "offset").agg(
        F.array_sort(F.collect_list(F.struct("c_custkey", "body"))).alias("recs"))
    body = F.concat(F.lit('{"result_count":'), F.size("recs").cast("string"), F.lit(',"results":['),
                    F.array_join(F.transform("recs", lambda x: x["body"]), ","), F.lit("]}"))
    pages = pages.select("dataset", "offset", F.size("recs").alias("n"), body.alias("body"))
    closing = _closing_pages(pages, page_size, '{"result_count":0,"results":[]}')
    return stored(pages.unionByName(closing).select("dataset", "offset", "body"), "provider-pages")


def glossary_docs(spark: SparkSession, sf_dir: str, per_doc: int = 16) -> DataFrame:
    """Static glossary documents ``(path, shard, body)`` from documents: ``per_doc`` terms each,
    even shards bare arrays, odd shards wrapped under the path stem ``glossary``."""
    d = table(spark, sf_dir, "documents")
    term = F.struct(
        F.concat(F.lit("Term "), F.col("doc_id").cast("string")).alias("title"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("slug"),
        F.col("text").alias("content"), "lang", "source",
    )
    shard = (F.col("doc_id") / per_doc).cast("bigint")
    docs = d.groupBy(shard.alias("shard")).agg(F.array_sort(F.collect_list(F.struct("doc_id", term.alias("t")))).alias("ts"))
    arr = F.to_json(F.transform("ts", lambda x: x["t"]))
    body = F.when(F.col("shard") % 2 == 0, arr).otherwise(F.concat(F.lit('{"glossary":'), arr, F.lit("}")))
    return stored(docs.select(F.lit("/api/glossary.json").alias("path"), "shard", body.alias("body")), "glossary")


def article_docs(spark: SparkSession, sf_dir: str, per_doc: int = 16) -> DataFrame:
    """Static article documents from pages, wrapped under ``articles`` on odd shards."""
    p = table(spark, sf_dir, "pages")
    art = F.struct(
        F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("title"),
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("slug"),
        "url", F.col("html").alias("content"),
        F.concat(F.lit("2024-01-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")).alias("date"),
        (F.col("page_id") % 100).alias("views"),
    )
    shard = (F.col("page_id") / per_doc).cast("bigint")
    docs = p.groupBy(shard.alias("shard")).agg(F.array_sort(F.collect_list(F.struct("page_id", art.alias("a")))).alias("xs"))
    arr = F.to_json(F.transform("xs", lambda x: x["a"]))
    body = F.when(F.col("shard") % 2 == 0, arr).otherwise(F.concat(F.lit('{"articles":'), arr, F.lit("}")))
    return stored(docs.select(F.lit("/api/articles.json").alias("path"), "shard", body.alias("body")), "articles")


def datastore_fixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Metastore documents per event type (live distribution first, a stale one second) and the
    datastore pages of both distributions (``{"results": [...]}``)."""
    types = table(spark, sf_dir, "events").select("event_type").distinct()
    body = F.concat(F.lit('{"identifier":"'), F.col("event_type"), F.lit('","title":"Events '), F.col("event_type"),
                    F.lit('","distribution":[{"identifier":"live-'), F.col("event_type"),
                    F.lit('"},{"identifier":"old-'), F.col("event_type"), F.lit('"}]}'))
    meta = stored(types.select(F.col("event_type").alias("dataset_id"), body.alias("body")), "metastore")
    live = event_pages(spark, sf_dir, batch=50, drop_every=None, envelope="results", dataset_prefix="live-")
    # a stale distribution: the live pages' first page, plus one bad page, under the old id
    old = live.where(F.col("offset") <= 50).select(
        F.concat(F.lit("old-"), F.expr("substr(dataset, 6)")).alias("dataset"), "offset",
        F.when(F.col("offset") == 0, F.col("body")).otherwise(F.lit("[1, 2]")).alias("body"))
    return meta, live.select("dataset", "offset", "body").unionByName(old)


# ---------------------------------------------------------------- spreadsheet archives

_CT = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>'
)
_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
    'officeDocument" Target="xl/workbook.xml"/></Relationships>'
)
_WB = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
    'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
    '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'
)
_WB_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
    'worksheet" Target="worksheets/sheet1.xml"/></Relationships>'
)


def xlsx_bytes(rows: list[tuple[int, list[str | None]]]) -> bytes:
    """A minimal workbook (inline-string cells) holding ``(row_no, cells)`` rows."""
    import io
    import zipfile
    from xml.sax.saxutils import escape

    body = []
    for r, cells in rows:
        cs = "".join(
            f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
            if v is not None else "<c/>" for v in cells
        )
        body.append(f'<row r="{r}">{cs}</row>')
    sheet = (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
        + "".join(body) + "</sheetData></worksheet>"
    )
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _CT)
        z.writestr("_rels/.rels", _RELS)
        z.writestr("xl/workbook.xml", _WB)
        z.writestr("xl/_rels/workbook.xml.rels", _WB_RELS)
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return buf.getvalue()


def zip_archive(members: dict[str, bytes]) -> bytes:
    import io
    import zipfile

    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    return buf.getvalue()


SHEET_HEADER = ["Nation Key", "Nation Name", "Region Key", "Region Name"]


def _region_archive(broken: bool):
    """Build one region's archive; with ``broken``, regions 0, 1 and 2 get a bad archive
    (no sheet member, two sheet members, no header row)."""

    def build(pdf):
        import pandas as pd

        pdf = pdf.sort_values("n_nationkey")
        region = str(pdf["r_name"].iloc[0])
        key = int(pdf["n_regionkey"].iloc[0])
        rows = [(1, [f"{len(pdf)} nations in {region}"]), (2, list(SHEET_HEADER))]
        for i, rec in enumerate(pdf.itertuples(index=False), start=3):
            rows.append((i, [str(rec.n_nationkey), rec.n_name, str(rec.n_regionkey), rec.r_name]))
        rows.append((len(rows) + 2, ["Source: derived from the nation table"]))  # after one empty row
        book = f"landscape_{region.lower()}.XLSX"
        members = {book: xlsx_bytes(rows), "readme.txt": b"fixture"}
        if broken and key == 0:
            members = {"readme.txt": b"fixture"}
        elif broken and key == 1:
            members[f"copy_of_{book}"] = members[book]
        elif broken and key == 2:
            members[book] = xlsx_bytes([r for r in rows if r[0] != 2])
        return pd.DataFrame([(f"mem://sheets/region_{key}.zip", zip_archive(members))], columns=["path", "content"])

    return build


def sheet_archives(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """One zipped workbook per region (title row, header row, nations, empty row, footnote),
    built by a Spark job as ``(path, content)`` rows."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return stored(nations.select("n_nationkey", "n_name", "n_regionkey", "r_name").groupBy("n_regionkey").applyInPandas(
        _region_archive(broken), "path string, content binary"), "archives")


def malformed_catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog shards with shape errors, one per 1,000 parts: shard mod 3 = 0 is an array payload,
    = 1 has a non-list ``dataset``, = 2 is a well-formed empty catalog."""
    shards = table(spark, sf_dir, "part").select(F.expr("p_partkey div 1000").alias("doc_seq")).distinct()
    body = (F.when(F.col("doc_seq") % 3 == 0, F.lit('[{"dataset": []}]'))
            .when(F.col("doc_seq") % 3 == 1, F.lit('{"dataset": {"identifier": "x"}}'))
            .otherwise(F.lit('{"dataset": []}')))
    return stored(shards.select("doc_seq", body.alias("body")), "catalog-bad")
