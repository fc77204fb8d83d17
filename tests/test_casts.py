import duckdb
from pyspark.sql import functions as F

from meridian.functions.casts import blank_to_null, lenient_int, trimmed, y_only, yes_no
from meridian.functions.text import end_anchored, path_stem, year_prefix

PROBES = [
    "4.6", "2.5", "-2.5", "0.5", "5.", ".5", "1e2", "1e-2", "1.5e1", "1_000", "007", "+5", "-0", "\t5\n", " 7 ",
    "2147483647.4", "0x1F", "2147483647.5", "3000000000", "1e10", "NaN", "inf", "true", "1,000", "1_", "_1",
    "1__0", "4 5", "", "Not Available", "٣", "0b101", "0o17", "-0x1F", "0X1f", "1E2", "  -3.5  ", "1.5_0",
    "1_0.5", "1e1_0", "1e0_1", "0x", "0xG", "1.2.3", "--1", "+-1", "1e+2", "5 ", "\r9\r", "\x0b8", "\x1f5",
    "\x005", "1e", "e1", ".", "-", "+", "0x7FFFFFFF", "0x80000000", "-.5", "-0.49", "0_1", "00_1", "0x1_F",
    " 0x1F ", "0B11", "0b2", "1_e2", "1e_2", "0000000000000000000000000005", "99999999999999999999999", "5d",
    "Infinity", "-inf", " 0x1F", "\t0b11", "0x1F\t", "0e73", "-0e999", "0e32767", "0e32768", "5e-32768",
    "5e-32769", "45e4.", "1e2..", "1.e2.", "1e2. ", "1.5.", "0x1F.", "0x" + "F" * 40, "0b" + "1" * 80,
    "0.4999999999999999999999", "-0.4999999999999999999999 ", "0.5000000000000000000001",
    "1.4999999999999999999999999999999999999999999", "2.49999999999999999999",
]


def test_lenient_int_matches_duckdb_try_cast(spark):
    con = duckdb.connect()
    want = [con.execute("select try_cast(? as int)", [p]).fetchone()[0] for p in PROBES]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in PROBES], "v string").select(lenient_int("v")).collect()]
    assert [(p, w) for p, w, g in zip(PROBES, want, got) if w != g] == []


def test_lenient_int_fuzz_matches_duckdb(spark):
    import random

    rng = random.Random(20261203)
    alphabet = list("0123456789") * 4 + list("+-._eExXbB \t\n") + ["0x", "0b", "1e", ".5", "_0", "\u0663", "a", "f"]
    probes = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(0, 16))) for _ in range(4000)})
    con = duckdb.connect()
    want = [con.execute("select try_cast(? as int)", [p]).fetchone()[0] for p in probes]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in probes], "v string").select(lenient_int("v")).collect()]
    assert [(p, w, g) for p, w, g in zip(probes, want, got) if w != g] == []


def test_lenient_int_decides_halves_on_any_number_of_digits(spark):
    import random

    rng = random.Random(11)
    probes = ["4." + "9" * 40 + "e-1", "49e-2", "45e-2", "5e-1", "-5e-1", "214748364.75e1", "-214748364.85e1", "-214748364.84e1",
              "9223372036854775807e-10", "9223372036854775808e-10", "-9223372036854775808e-10", "0." + "0" * 37 + "5e38", ".e1"]
    while len(probes) < 3000:
        whole = "".join(rng.choice("0123456789") for _ in range(rng.choice([0, 1, 2, 5, 9, 10, 15])))
        part = "".join(rng.choice("0459") for _ in range(rng.choice([0, 1, 3, 20, 40])))
        probes.append(rng.choice(["", "-", "+"]) + whole + rng.choice(["." + part, ""]) + rng.choice(
            ["", "", f"e{rng.randint(-25, 12)}", "e-1", "e1", "e+2."]))
    con = duckdb.connect()
    want = [con.execute("select try_cast(? as int)", [p]).fetchone()[0] for p in probes]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in probes], "v string").select(lenient_int("v")).collect()]
    assert [(p, w, g) for p, w, g in zip(probes, want, got) if w != g] == []


def test_lenient_int_null_input(spark):
    assert spark.sql("select cast(null as string) v").select(lenient_int("v")).first()[0] is None


def test_trim_keeps_tabs_and_blank_to_null(spark):
    df = spark.createDataFrame([("  a ",), ("\tb ",), ("   ",), ("",), (None,)], "v string")
    rows = df.select(trimmed("v").alias("t"), blank_to_null("v").alias("b")).collect()
    assert [r.t for r in rows] == ["a", "\tb", "", "", None]
    assert [r.b for r in rows] == ["a", "\tb", None, None, None]


def test_flags(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("yes",), ("Y",), ("",), (None,)], "v string")
    rows = df.select(yes_no("v").alias("a"), y_only("v").alias("b")).collect()
    assert [r.a for r in rows] == [True, False, None, None, None, None]
    assert [r.b for r in rows] == [None, None, None, True, None, None]


def test_end_anchor_rejects_trailing_newline(spark):
    assert end_anchored("^\\d{5}$") == "\\A\\d{5}\\z"
    df = spark.createDataFrame([("12345",), ("12345\n",), ("1234",)], "z string")
    got = [r[0] for r in df.select(F.col("z").rlike(end_anchored("^\\d{5}$"))).collect()]
    assert got == [True, False, False]


def test_year_prefix_and_path_stem(spark):
    df = spark.createDataFrame([("2023-01-01/2023-12-31", "/api/glossary.json"), ("n/a", "/api/articles"),
                                ("20", "a.b.json"), (None, "/x/y.tar.gz")], "t string, p string")
    rows = df.select(year_prefix(F.col("t")).alias("y"), path_stem(F.col("p")).alias("s")).collect()
    assert [r.y for r in rows] == [2023, None, None, None]
    assert [r.s for r in rows] == ["glossary", "articles", "a.b", "y.tar"]


def test_trim_and_blank_match_duckdb(spark):
    import random

    rng = random.Random(5)
    alphabet = list("ab1 ") + ["\t", "\n", "\r", " ", " ", "　", " ", "​", "\u0085", "﻿"]
    probes = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6))) for _ in range(3000)})
    con = duckdb.connect()
    want = [con.execute("select trim(?), nullif(trim(?), '')", [p, p]).fetchone() for p in probes]
    got = [tuple(r) for r in spark.createDataFrame([(p,) for p in probes], "v string").select(
        trimmed("v"), blank_to_null("v")).collect()]
    assert [(p, w, g) for p, w, g in zip(probes, want, got) if w != g] == []


def test_path_stem_matches_posix_paths(spark):
    from pathlib import PurePosixPath

    cases = ["/api/glossary.json", "/api/articles", "a.b.json", "/x/y.tar.gz", "/api/.hidden", ".a.b", "..x",
             "a.", "/api/x/", "/", "", "a..", "/p/q.r/s", "noext"]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in cases], "p string").select(path_stem(F.col("p"))).collect()]
    assert got == [PurePosixPath(c).stem for c in cases]
