"""Registered queries of this subpackage and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm import decontaminate as decontam
from meridian.llm import chat_tools, fill_middle, html_diff, jaccard_join, language_id, packing, pii, quality_cotrain
from meridian.llm import quality_rules, toxicity, vector_codes, warc
from meridian.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return wrap


@_query("op1_warc")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    records = warc.read_records(warc.index_archives(spark, warc.write_archives(spark, pages)), payloads=False)
    return records.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          "refers_to")


#: the argument schema of the tool that exchanges are read as
REPLY_SCHEMA = {"type": "object", "required": ["prompt", "turn"], "additionalProperties": False,
                "properties": {"prompt": {"type": "string", "minLength": 1, "maxLength": 400},
                               "turn": {"type": "integer", "minimum": 0}}}

_CHAT_SQL = r"""
WITH m AS (SELECT conv_id, turn, role, text, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS key,
             CAST(conv_id AS VARCHAR) || '-' || CAST(turn - 1 AS VARCHAR) AS before FROM conversations),
r AS (SELECT conv_id, turn, role, text, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
        CASE role WHEN 'user' THEN key WHEN 'assistant' THEN before END AS id FROM m),
c AS (SELECT id, min(turn) AS call_turn FROM r WHERE kind = 'call' GROUP BY id),
s AS (SELECT id, min(turn) AS result_turn FROM r WHERE kind = 'result' GROUP BY id)
SELECT r.conv_id, r.turn, r.kind, r.id,
  CASE WHEN kind = 'message' THEN NULL WHEN call_turn IS NULL THEN 'unlinked'
       WHEN turn <> CASE kind WHEN 'call' THEN call_turn ELSE result_turn END THEN 'duplicate'
       WHEN result_turn IS NULL THEN 'unlinked' ELSE 'linked' END AS status,
  CASE WHEN kind = 'call' THEN coalesce(length(text) BETWEEN 1 AND 400, FALSE) END AS valid,
  r.turn AS order_turn,
  CASE kind
    WHEN 'call' THEN '{"role":' || to_json(role) || ',"tool_call":{"arguments":{"prompt":' || to_json(text) || ',"turn":' || turn
      || '},"id":' || to_json(r.id) || ',"name":"reply"}}'
    WHEN 'result' THEN '{"content":' || to_json(text) || ',"role":' || to_json(role) || ',"tool_call_id":' || to_json(r.id) || '}'
    ELSE '{"content":' || to_json(text) || ',"role":' || to_json(role) || '}' END AS json
FROM r LEFT JOIN c ON c.id = r.id LEFT JOIN s ON s.id = r.id
"""


@_query("op2_chat_tools", _CHAT_SQL)
def op2_chat_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = chat_tools.from_exchanges(table(spark, sf_dir, "conversations"))
    linked = chat_tools.link_tools(spark, messages, {"reply": REPLY_SCHEMA})
    return linked.select("conv_id", "turn", "kind", "id", "status", "valid", "order_turn", "json")


@_query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(spark, table(spark, sf_dir, "documents"))


@_query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"))


_JACCARD_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + least(5, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (g)
      WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT c.u, c.v FROM c JOIN n nu ON nu.doc_id = c.u JOIN n nv ON nv.doc_id = c.v
      WHERE 100 * c.c >= 75 * (nu.n + nv.n - c.c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.v FROM reach r JOIN e ON r.y = e.u)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.y AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) r ON r.x = d.doc_id
"""


@_query("op4_jaccard_join", _JACCARD_SQL)
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(spark, table(spark, sf_dir, "documents")).drop("sid", "key")


_DECONTAM_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS win, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
wins AS (SELECT DISTINCT win FROM bw),
dw AS (SELECT doc_id, win, p, array_to_string(w[p:p + win - 1], ' ') AS g
       FROM (SELECT doc_id, w, win, unnest(range(1, len(w) - win + 2)) AS p FROM d, wins WHERE len(w) >= win)),
h AS (SELECT dw.doc_id, dw.win, dw.p, bw.item_id FROM dw JOIN bw USING (win, g)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(range(p, p + win)) AS q FROM (SELECT DISTINCT doc_id, win, p FROM h)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS s
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(it.s, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""


@_query("op6_decontaminate", _DECONTAM_SQL)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@_query("op8_html_diff")
def op8_html_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_diff.extract(spark, table(spark, sf_dir, "pages"))


_RULES_SQL = r"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT doc_id, lang, text, w, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS up,
        length(text) - length(regexp_replace(text, '\p{L}', '', 'g')) AS le,
        length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS di FROM d),
li AS (SELECT doc_id, l, count(*) AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id, l),
dl AS (SELECT doc_id, CAST(sum(c - 1) AS BIGINT) AS n_dup_lines FROM li GROUP BY doc_id),
tri AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) > 2)),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
rw AS (SELECT doc_id, count(DISTINCT q) AS n_repeat_words
       FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM rep) GROUP BY doc_id),
wl AS (SELECT doc_id, lang, unnest(w) AS word FROM d),
vocab AS (SELECT lang, word, count(*) AS c FROM wl WHERE length(word) <= 4 GROUP BY lang, word),
top AS (SELECT lang, word, c FROM vocab QUALIFY row_number() OVER (PARTITION BY lang ORDER BY c DESC, word) <= 16),
ch AS (SELECT doc_id, lang, unnest([le - up, up, di, length(text) - word_chars, word_chars - le - di]) AS v,
         unnest([0, 1, 2, 3, 4]) AS k, length(text) AS n FROM b),
rc AS (SELECT lang, k, sum(v) AS v, sum(sum(v)) OVER (PARTITION BY lang) AS n FROM ch GROUP BY lang, k),
cd AS (SELECT doc_id, any_value(p.n) AS n_chars, sum(CASE WHEN p.v > 0 THEN p.v / p.n * log2((p.v / p.n) / ((p.v / p.n + q.v / q.n) / 2)) ELSE 0 END
             + CASE WHEN q.v > 0 THEN q.v / q.n * log2((q.v / q.n) / ((p.v / p.n + q.v / q.n) / 2)) ELSE 0 END) / 2 AS j
       FROM ch p JOIN rc q ON p.lang IS NOT DISTINCT FROM q.lang AND p.k = q.k WHERE p.n > 0 GROUP BY doc_id),
hit AS (SELECT wl.doc_id, wl.word, count(*) AS v FROM wl JOIN top ON wl.lang IS NOT DISTINCT FROM top.lang AND wl.word = top.word
        GROUP BY wl.doc_id, wl.word),
lw AS (SELECT lang, sum(n_words) AS n FROM b GROUP BY lang),
hw AS (SELECT b.doc_id, coalesce(hit.v, 0) AS v, b.n_words AS n, top.c AS qv, lw.n AS qn
       FROM b JOIN top ON b.lang IS NOT DISTINCT FROM top.lang JOIN lw ON b.lang IS NOT DISTINCT FROM lw.lang
       LEFT JOIN hit ON hit.doc_id = b.doc_id AND hit.word = top.word WHERE b.n_words > 0),
hx AS (SELECT * FROM hw UNION ALL SELECT doc_id, any_value(n) - sum(v), any_value(n), any_value(qn) - sum(qv), any_value(qn) FROM hw GROUP BY doc_id),
wd AS (SELECT doc_id, sum(CASE WHEN v > 0 THEN v / n * log2((v / n) / ((v / n + qv / qn) / 2)) ELSE 0 END
             + CASE WHEN qv > 0 THEN qv / qn * log2((qv / qn) / ((v / n + qv / qn) / 2)) ELSE 0 END) / 2 AS j FROM hx GROUP BY doc_id),
r AS (SELECT b.doc_id, n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(n_chars >= 400 AND sqrt(greatest(cd.j, 0)) > 0.30, FALSE)
        OR coalesce(n_words >= 100 AND sqrt(greatest(wd.j, 0)) > 0.30, FALSE) AS diverges
      FROM b LEFT JOIN dl ON dl.doc_id = b.doc_id LEFT JOIN rw ON rw.doc_id = b.doc_id
      LEFT JOIN cd ON cd.doc_id = b.doc_id LEFT JOIN wd ON wd.doc_id = b.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR diverges) AS kept FROM r
"""


@_query("op9_quality_rules", _RULES_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


@_query("op7_pii")
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(spark, table(spark, sf_dir, "documents")).drop("text", "found")


@_query("op10_quality_cotrain")
def op10_quality_cotrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cotrain.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op11_toxicity")
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _codes_sql() -> str:
    """The rounds as a chain of tables: ``b<i>`` the codebooks before round i, ``a<i>`` the entry of every part."""
    steps = []
    for i in range(vector_codes.ROUNDS + 1):
        steps.append(f"""n{i} AS MATERIALIZED (SELECT x.r, x.part, b.entry, CAST(sum((x.v - b.v) * (x.v - b.v)) AS BIGINT) AS d
  FROM x JOIN b{i} b USING (part, pos) GROUP BY ALL),
a{i} AS MATERIALIZED (SELECT r, part, arg_min(entry, d * 16 + entry) AS entry, min(d) AS d FROM n{i} GROUP BY ALL)""")
        if i < vector_codes.ROUNDS:
            steps.append(f"""m{i} AS MATERIALIZED (SELECT part, entry, pos, CAST(sum(v) AS BIGINT) AS s, count(*) AS c
  FROM x JOIN a{i} USING (r, part) GROUP BY ALL),
b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce((s - ((s % c) + c) % c) // c, b.v) AS v
  FROM b{i} b LEFT JOIN m{i} USING (part, entry, pos))""")
    last = vector_codes.ROUNDS
    return """
WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, embedding AS e
  FROM embeddings WHERE len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS MATERIALIZED (SELECT r, (p - 1) // (len(e) // 8) AS part, (p - 1) % (len(e) // 8) AS pos,
  CAST(floor(4096 * CAST(e[p] AS DOUBLE)) AS BIGINT) AS v FROM (SELECT r, e, unnest(range(1, len(e) + 1)) AS p FROM k)),
b0 AS MATERIALIZED (SELECT part, r AS entry, pos, v FROM x WHERE r < 16),
""" + ",\n".join(steps) + f""",
o AS (SELECT k.vec_id, k.label, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{last} JOIN k USING (r) GROUP BY r, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{last}) AS codebooks_sha256 FROM o
"""


@_query("op12_vector_codes", _codes_sql())
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(spark, table(spark, sf_dir, "embeddings")).drop("label")


_MIDDLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS s FROM documents),
h AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || s[1:8] AS BIGINT) % (length(t) + 1) AS c1, CAST('0x' || s[9:16] AS BIGINT) % (length(t) + 1) AS c2,
        CAST('0x' || s[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || s[25:32] AS BIGINT) % 100 AS h4 FROM d),
f AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
             WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || t[1:a] || '<S>' || t[b + 1:] || '<M>' || substring(t, a + 1, b - a)
    ELSE '<S>' || t[b + 1:] || '<P>' || t[1:a] || '<M>' || substring(t, a + 1, b - a) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM f
"""


@_query("op13_fill_middle", _MIDDLE_SQL)
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
