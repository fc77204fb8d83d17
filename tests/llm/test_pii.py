import hashlib
import random
import re

from pyspark.sql import functions as F

from meridian.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and _luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def base(text):
    return [(k, m.start(), m.end()) for k in pii.KINDS for m in re.finditer(PLAIN[k], text or "") if _valid(k, m.group())]


def _check(spark, df):
    rows = pii.detect(spark, df).collect()
    for r in rows:
        want = base(r.text)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest(), r.text[:200]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[0] == k for w in want) for k in pii.KINDS]
        spans = [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        assert set(want) <= set(spans) and spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), x[1]))
        for k in pii.KINDS:
            own = [x for x in spans if x[0] == k]
            assert all(a[2] <= b[1] for a, b in zip(own, own[1:]))
    return {r.doc_id: r for r in rows}


def test_base_spans_against_brute_force(spark, docs_of):
    rng = random.Random(6)
    parts = ["a@b.co", "x_y%z@m-1.ex.org", "a@b.c_d@e.f", "@", "a@b", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "007.0.0.255", "1.2.3",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "12 34", "4111111111111111", "41111111111111111111", "+1 (212) 555-0100",
             "+44 20 7946 0958", "+1", "+1 ", "+12345678901234567", "é", "😀", " ", "-", ".", "7", "word", "\n", "--", "  "]
    docs = [(i, "".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(25)))) for i in range(700)]
    docs += [(900, None), (901, ""), (0, docs[0][1]), (None, docs[1][1])]
    _check(spark, docs_of(docs))


def test_trees_add_what_the_base_rule_rejects_as_a_whole(spark, docs_of):
    rng = random.Random(3)

    def card(ok=True):
        head = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(head + d for d in "0123456789" if _luhn(head + d) == ok)

    def phone():
        return f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"

    docs = [(i, f"say {card()} and {phone()} from 10.2.3.{i % 200} ok {card(False)} id {rng.randrange(10**9, 10**10)} x") for i in range(300)]
    docs += [(1000, f"both {phone()} {card()} here"), (1001, f"two {card()} {card()} cards")]
    text = dict(docs)
    got = _check(spark, docs_of(docs))
    added = [text[1000][int(s):int(e)] for _, s, e in (x.split(":") for x in got[1000].spans.split(","))]
    assert len(added) == 2 and base(text[1000]) == []
    assert got[1001].spans.count("card:") == 2 and got[1001].n_card == 0
    assert all(got[i].spans.count(":") == 2 * len(base(text[i])) for i in range(300))


def test_very_long_runs_do_not_recurse(spark, docs_of):
    docs = [(1, "a" * 200_000), (2, "1 " * 20_000), (3, "1" * 100_000), (4, "+1" + " " * 100_000), (5, "a.b@" * 2_000),
            (6, "9." * 4_000), (7, "x@" + "y." * 20_000 + "z"), (8, "+1 2" * 2_000)]
    _check(spark, docs_of(docs))


def test_one_class_or_no_rows_adds_nothing(spark, docs_of):
    assert pii.detect(spark, docs_of([])).count() == 0
    got = _check(spark, docs_of([(1, "a@b.co"), (2, "nothing")]))
    assert got[1].spans == "email:0:6" and got[2].spans == ""


def test_redaction(spark, docs_of):
    df = pii.detect(spark, docs_of([(1, "é a@b.co, 1.2.3.4!"), (2, ""), (3, "clean")]))
    out = {r.doc_id: r.t for r in df.select("doc_id", pii.redacted(F.col("text"), F.col("found")).alias("t")).collect()}
    assert out == {1: "é [EMAIL], [IP]!", 2: "", 3: "clean"}
    overlap = spark.sql("select 'abcdefgh' as text, array(named_struct('kind', 3, 's', 1, 'e', 5), named_struct('kind', 2, 's', 3, 'e', 6)) as found")
    assert overlap.select(pii.redacted(F.col("text"), F.col("found"))).first()[0] == "a[PHONE]gh"


def test_plan_is_native(spark, docs_of):
    plan = pii.detect(spark, docs_of([(1, "a@b.co")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
