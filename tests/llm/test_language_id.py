import zlib

import numpy as np

from meridian.llm import language_id as L

WORDS = {"aa": "bala bolo kala kolo mala molo", "bb": "strengt pfchtz grunds schwert krist", "cc": "éçoi aiéau oireau tionè èment"}


def _docs(n):
    out = []
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        w = WORDS[lang].split()
        out.append((i, " ".join(w[(i * 7 + j * j) % len(w)] for j in range(3 + i % 9)), lang, "s", 1))
    return out


def _held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy_and_null_rules(spark, docs_of):
    docs = _docs(120) + [(500, None, "aa", "s", 0), (501, "", "aa", "s", 0), (502, "12 !? 7", None, "s", 0),
                         (503, "ŵŷẑ", "bb", "s", 1), (None, "bala bolo", "aa", "s", 1), (504, "kolo " * 30_000, None, "s", 1)]
    docs.append(docs[0])
    got = L.identify(spark, docs_of(docs)).collect()
    assert len(got) == len(docs)
    by = {r.doc_id: r for r in got}
    for i, _, lang, _, _ in docs[:120]:
        assert by[i].held_out == _held(i)
        assert by[i].lang_pred == lang and 0 < by[i].score <= 1
    for i in (500, 501, 502):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[503].lang_pred in WORDS and by[503].score == 0.0
    assert by[None].held_out is False and by[None].lang_pred == "aa"
    assert by[504].lang_pred == "aa"


def test_held_out_labels_are_never_learned_from(spark, docs_of):
    docs = _docs(60)
    wrong = [(i, t, "zz" if _held(i) else lang, s, n) for i, t, lang, s, n in docs]
    one = sorted(map(tuple, L.identify(spark, docs_of(docs)).collect()))
    assert one == sorted(map(tuple, L.identify(spark, docs_of(wrong)).collect()))


def test_empty_table_and_no_languages(spark, docs_of):
    assert L.identify(spark, docs_of([])).count() == 0
    rows = L.identify(spark, docs_of([(1, "bala", None, "s", 4)])).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)]


def test_filter_returns_all_languages_of_a_trigram():
    grams = [L.trigrams(L.folded(w)) for w in ("bala kala", "kala zulu")]
    table = np.zeros(L.SLOTS, dtype=np.uint64)
    for i, g in enumerate(grams):
        for at in L.slots(g):
            table[at] |= np.uint64(1 << i)
    found = [L.classify(L.folded(t), table, np.zeros(2)).tolist() for t in ("kala", "bala", "zulu")]
    assert found[0][0] == found[0][1] > 0 and found[1][0] > found[1][1] and found[2][1] > found[2][0]


def test_popcounts_are_corrected_for_false_positives():
    table = np.zeros(L.SLOTS, dtype=np.uint64)
    table[:] = 2  # the second language's filter is full: each hit is expected by chance
    assert L.classify(L.folded("bala kala"), table, np.array([0.0, 1.0])).tolist() == [0.0, 0.0]


def test_driver_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = L.identify(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got) > 0


def test_more_languages_than_one_mask_word_holds(spark, docs_of):
    word = lambda k: chr(0x4E00 + 3 * k) + chr(0x4E01 + 3 * k) + chr(0x4E02 + 3 * k)
    docs = [(100 * k + j, " ".join([word(k)] * 5), f"l{k:03}", "s", 1) for k in range(130) for j in range(8)]
    got = L.identify(spark, docs_of(docs)).collect()
    assert len(got) == len(docs) and all(r.lang_pred == f"l{r.doc_id // 100:03}" and r.score == 1 for r in got)


def test_text_without_known_trigrams_gets_the_language_with_most(spark, docs_of):
    docs = [(i, "bala bolo", "aa", "s", 1) for i in range(8)] + [(i, "pfchtz grunds " * 9, "bb", "s", 1) for i in range(20, 28)]
    got = {r.doc_id: r for r in L.identify(spark, docs_of([*docs, (50, "ŵŷẑ", None, "s", 1)])).collect()}
    assert (got[50].lang_pred, got[50].score) == ("bb", 0.0)


def test_filter_grows_with_the_trigrams_of_a_language(spark):
    # a language of 1.2 million trigrams, each seen three times
    points = np.random.default_rng(5).integers(0x4E00, 0x9F00, 1_200_000)
    wide, narrow = "".join(map(chr, points)), "bala bolo kala kolo mala molo"
    train = spark.createDataFrame([("zh", wide)] * 3 + [("aa", narrow)] * 3, "lang string, text string")
    langs, table, miss = L.fit(spark, train)[:3]
    assert langs == ["aa", "zh"] and miss.max() < 0.2
    found = L.classify(L.folded(wide[5000:5200]), table, miss)
    assert found[1] > 190 and found[0] == 0
    assert L.classify(L.folded(narrow), table, miss).argmax() == 0
