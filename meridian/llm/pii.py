"""Personal data: base rules, then candidate gradient boosting (built-in and Spark ML functions only).

Base spans are the leftmost non-overlapping matches of one pattern per kind that pass its
check. High-recall generators propose further, overlapping spans (a card or phone number
inside a run of digits that the base rule rejects as a whole, spelled-out addresses).
Boosted trees score every candidate on its format and on the characters around it. They
learn from all documents: candidates equal to a base span are positive, candidates equal
to a rejected match, or that touch no match of their kind, are negative; those inside a
rejected match carry no label. Since features are small integers, the training table is one
row per distinct feature vector with its count. The fitted trees become one SQL expression
that runs over the candidates inside each row. Per kind the threshold is the lowest score
whose accepted labelled candidates reach ``PRECISION``.

Base spans always stay; an accepted candidate is added where no span of its kind that
starts before it, or scores higher, overlaps it. Positions are code points, end exclusive.

The patterns are the contract's with possessive quantifiers and anchored starts, which
match the same spans without recursion or repeated scans of long runs.

Defined results: a null text is empty and has no spans; without labelled candidates of
both classes no span is added; repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import written

KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # a run has to hold 16 digits to count, so shorter ones are not matched at all
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
              r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++"),
    "ip": r"(?<![0-9])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{4,7}(?![0-9])",
    "phone": (r"(?:\+[0-9]{1,3}[\x20.-]?)?(?<![0-9])\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{4}(?![0-9])"),
}
PRECISION = 0.98
ROUNDS, DEPTH = 12, 4
FEATURES = ("kind", "digits", "chars", "groups", "luhn", "octets", "plus", "paren", "before", "after", "lead")
_SPAN = "array<struct<s: int, e: int, m: string>>"


def spans_of(pattern: str, needed: Column) -> Column:
    """Spans ``s, e, m`` of the matches in ``text``: lengths of the pieces between and of the matches add up."""
    found = F.regexp_extract_all("text", F.lit(f"({pattern})"), 1)
    pieces = F.zip_with(found, F.split("text", pattern, -1), lambda m, p: F.struct(m.alias("m"), F.length(p).alias("p")))
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_SPAN})").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        low = acc["at"] + x["p"]
        high = low + F.length(x["m"])
        grown = F.struct(high.alias("at"), F.concat(acc["out"], F.array(F.struct(
            low.alias("s"), high.alias("e"), x["m"].alias("m")))).alias("out"))
        return F.when(x["m"].isNull(), acc).otherwise(grown)

    return F.when(needed, F.aggregate(pieces, start, add, lambda acc: acc["out"])).otherwise(
        F.expr(f"cast(array() as {_SPAN})"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def luhn(m: Column) -> Column:
    """Whether the digits of a match of at most 19 digits pass the Luhn check."""
    d = F.reverse(_digits(m))

    def add(acc: Column, x: Column) -> Column:
        return acc + F.when(x >= 10, x - 9).otherwise(x)

    doubled = F.transform(F.filter(F.split(d, ""), lambda c: c != ""), lambda c, i: c.cast("int") * (1 + i % 2))
    return F.aggregate(doubled, F.lit(0), add) % 10 == 0


def octets(m: Column) -> Column:
    return m.rlike(r"\A(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|\z)){4}\z")


def valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "email":
        return m.isNotNull()
    if kind == "ip":
        return octets(m)
    return n.between(8, 15) if kind == "phone" else F.when(n.between(16, 19), luhn(m)).otherwise(F.lit(False))


def _passing(kind: str) -> Column:
    return F.filter(f"chain_{kind}", lambda x: valid(kind, x["m"]))


def _of_kind(kind: int, spans: str) -> Column:
    return F.transform(spans, lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def _side(c: Column) -> Column:
    """Class of a neighbouring character: none or white space 0, digit 1, letter 2, anything else 3."""
    return (F.when(F.coalesce(c, F.lit("")).rlike(r"\A\s?\z"), 0).when(c.rlike(r"\A[0-9]"), 1)
            .when(c.rlike(r"\A\p{L}"), 2).otherwise(3))


def _key(x: Column) -> Column:
    """One long for a span, so that looking a span up among others stays cheap in texts with many."""
    return x["s"].cast("long") * (1 << 31) + x["e"]


def _candidates(kind: str) -> Column:
    def described(x: Column) -> Column:
        m, d = x["m"], _digits(x["m"])
        small = F.length(d) <= 19
        inside = F.exists(f"chain_{kind}", lambda c: (c["s"] <= x["s"]) & (x["e"] <= c["e"]) & ~valid(kind, c["m"])
                          & ((c["s"] != x["s"]) | (c["e"] != x["e"])))
        equal = F.array_contains(f"keys_{kind}", _key(x))
        return F.struct(
            x["s"].alias("s"), x["e"].alias("e"), F.lit(KINDS.index(kind)).alias("kind"),
            F.least(F.length(d), F.lit(24)).alias("digits"), F.least(F.length(m), F.lit(40)).alias("chars"),
            F.least(F.size(F.split(F.regexp_replace(m, "[^0-9]+", " "), " ")), F.lit(9)).alias("groups"),
            F.when(small & (F.length(d) >= 8) & luhn(m), 1).otherwise(0).alias("luhn"),
            F.when(octets(m), 1).otherwise(0).alias("octets"),
            F.when(m.startswith("+"), 1).otherwise(0).alias("plus"), F.when(m.contains("("), 1).otherwise(0).alias("paren"),
            _side(F.when(x["s"] > 0, F.substring("text", x["s"], F.lit(1)))).alias("before"),
            _side(F.substring("text", x["e"] + 1, F.lit(1))).alias("after"),
            F.coalesce(F.substring(d, 1, 1).try_cast("int"), F.lit(0)).alias("lead"),
            F.when(equal, 1.0).when(~inside, 0.0).alias("label"))

    # a candidate that overlaps a base span without being one is no candidate
    return F.transform(F.filter(f"gen_{kind}", lambda x: F.array_contains(f"keys_{kind}", _key(x)) | ~F.exists(
        f"base_{kind}", lambda c: (c["s"] < x["e"]) & (x["s"] < c["e"]))), described)


def with_candidates(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns, ``text``, the base spans per kind and all candidates with features and labels."""
    step = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    step = step.select(*keep, "text", F.col("text").rlike("[0-9]").alias("_digit"),
                       F.col("text").rlike(r"@|[(\[]at[)\]]").alias("_at"), F.contains("text", F.lit("+")).alias("_plus"))
    needs = {"email": F.col("_at"), "ip": F.col("_digit") & F.contains("text", F.lit(".")), "card": F.col("_digit"),
             "phone": F.col("_digit") & F.col("_plus")}
    step = step.select(*keep, "text", *(spans_of(BASE[k], needs[k]).alias(f"chain_{k}") for k in KINDS),
                       *(spans_of(GENERATORS[k], needs[k] if k != "phone" else F.col("_digit")).alias(f"gen_{k}") for k in KINDS))
    step = step.select("*", *(_passing(k).alias(f"base_{k}") for k in KINDS))
    step = step.select("*", *(F.transform(f"base_{k}", _key).alias(f"keys_{k}") for k in KINDS))
    return step.select(*keep, "text", *(f"base_{k}" for k in KINDS), F.concat(*(_candidates(k) for k in KINDS)).alias("candidates"))


def _tree(node) -> str:
    """One fitted tree as nested CASE over the features of ``x``."""
    if node.getClass().getSimpleName() == "LeafNode":
        return repr(float(node.prediction()))
    split = node.split()
    return (f"(case when x.{FEATURES[split.featureIndex()]} <= {float(split.threshold())!r} "
            f"then {_tree(node.leftChild())} else {_tree(node.rightChild())} end)")


def fit(spark: SparkSession, candidates: DataFrame) -> tuple[str | None, dict[str, float]]:
    """The score (0 to 1) of a candidate ``x`` as SQL text, and the threshold per kind.

    ``candidates`` has a ``candidates`` array column; the training table has one row per
    distinct feature vector and label.
    """
    # explode_outer: an inner explode would push a filter, and with it all patterns, below the projection
    rows = (candidates.select(F.explode_outer("candidates").alias("x")).where("x is not null and x.label is not null")
            .groupBy(*(F.col(f"x.{f}").alias(f) for f in FEATURES), F.col("x.label").alias("label"))
            .agg(F.count("*").cast("double").alias("weight")))
    rows = written(spark, rows, "pii-training")
    if rows.select("label").distinct().count() < 2:
        return None, {}
    ordered = rows.coalesce(1).sortWithinPartitions(*FEATURES, "label")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(ordered)
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, weightCol="weight", seed=7,
                          maxBins=64).fit(vectors)
    trees = [f"{float(w)!r} * {_tree(t._java_obj.rootNode())}"
             for t, w in zip(model.trees, model.treeWeights, strict=True)]
    score = f"(1 / (1 + exp(-2 * ({' + '.join(trees)}))))"
    scored = (rows.select("weight", "label", "kind", F.struct(*FEATURES).alias("x"))
              .select("kind", F.round(F.floor(F.expr(score) * 100) / 100, 2).alias("score"), "label", "weight")
              .groupBy("kind", "score").agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("hits"))
              .orderBy("kind", F.desc("score")).collect())
    limits = {}
    for i, kind in enumerate(KINDS):
        limits[kind] = 2.0  # never reached: without a labelled positive of the kind nothing is added
        n = hits = 0.0
        for r in scored:
            if r.kind == i:
                n, hits = n + r.n, hits + r.hits
                if hits and hits >= PRECISION * n:
                    limits[kind] = r.score
    return score, limits


def _added(score: str | None, limits: dict[str, float]) -> Column:
    """Accepted candidates that are not base spans, without overlaps inside a kind."""
    if score is None:
        return F.expr("cast(array() as array<struct<kind: int, s: int, e: int, score: double>>)")
    limit = "case x.kind " + " ".join(f"when {i} then {limits[k]!r}" for i, k in enumerate(KINDS)) + " end"
    return F.expr(f"""filter(transform(filter(candidates, x -> x.label is null or x.label = 0),
        x -> struct(x.kind as kind, x.s as s, x.e as e, {score} as score, {limit} as least)), y -> y.score >= y.least)""")


def detect(spark: SparkSession, docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default ``doc_id``), ``text``, the four counts, ``base_sha256``, ``spans`` and
    ``found`` (array of ``kind, s, e`` in the order of ``spans``)."""
    keep = keep or ["doc_id"]
    step = with_candidates(docs, keep)
    score, limits = fit(spark, step)
    base = F.concat(*(_of_kind(i, f"base_{k}") for i, k in enumerate(KINDS)))
    step = step.select(*keep, "text", base.alias("base"), _added(score, limits).alias("more"))
    # generators of a kind never overlap themselves, so only base spans could overlap, and those were left out
    found = F.array_sort(F.concat("base", F.transform("more", lambda x: F.struct(
        x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))))

    def listed(spans: str) -> Column:
        names = F.array(*(F.lit(k) for k in KINDS))
        return F.array_join(F.transform(F.col(spans), lambda x: F.concat_ws(
            ":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")

    step = step.select(*keep, "text", "base", found.alias("found"))

    def counted(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return step.select(
        *keep, "text", *(counted(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        F.sha2(listed("base"), 256).alias("base_sha256"), listed("found").alias("spans"), "found")


def redacted(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    ordered = F.array_sort(F.transform(found, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))

    def add(acc: Column, x: Column) -> Column:
        open_ = x["s"] >= acc["at"]
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.get(names, x["kind"]))
        return F.struct(F.when(open_, piece).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], x["e"]).alias("at"))

    return F.aggregate(ordered, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), add,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
