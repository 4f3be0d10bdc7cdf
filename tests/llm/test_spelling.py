"""Spelling variants against SQL, all pairs, and odd tables."""
import itertools
import random

import compare
from halocline.llm import spelling

SF = "/root/testdata/sf0.001"


def floats(df):
    return df.astype({c: "float64" for c in df if str(df[c].dtype).lower().startswith(("int", "float"))})


def one_edit(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    x, y = sorted((x, y), key=len)
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def test_sql(spark):
    got = floats(spelling.op11_spelling_variants(spark, SF).toPandas())
    want = floats(compare.connect(SF).execute(spelling.SQL).df())
    assert len(want) > 1000 and want["form"].notna().any() and compare.difference(got, want) is None


def check_pairs(spark, words, **kw):
    df = spark.createDataFrame([(w, i + 2) for i, w in enumerate(words)], "word string, n long")
    got = [tuple(sorted((r.x, r.y))) for r in spelling.near_words(df, **kw).collect()]
    want = {tuple(sorted(p)) for p in itertools.combinations(words, 2) if one_edit(*p)}
    assert len(got) == len(set(got)) and set(got) == want
    return want


def test_every_pair_once(spark):
    rng = random.Random(3)
    words = list(dict.fromkeys("".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(700)))
    assert len(check_pairs(spark, words)) > 400


def test_hot_chunks_are_halved_again(spark):
    """All words share a prefix or a suffix, so that keys are hot down to single places."""
    rng = random.Random(4)
    tails = {"".join(rng.choice("ab") for _ in range(n)) for n in (4, 5, 5, 6) for _ in range(60)}
    words = sorted({"interna" + t for t in tails} | {t + "tionally" for t in tails})
    assert len(check_pairs(spark, words, most_pairs=4)) > 300


def test_short_words_and_repeated_letters(spark):
    words = ["a", "b", "ab", "aa", "aaa", "aab", "baa", "aba", "abab", "baba", "bbbb"]
    check_pairs(spark, words, least=1)
    check_pairs(spark, words, least=1, most_pairs=1)


def test_chain_of_forms_and_ties(spark):
    counts = {"abcdefgh": 4000, "abcdefg": 300, "abcdefx": 300, "abcdef": 20, "abcde": 2, "zzzzzzz": 9}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r.word: r for r in spelling.roots(spelling.forms(words, spelling.near_words(words, least=5))).collect()}
    assert got["abcdef"].form == "abcdefg" and got["abcdef"].n_near == 3 and got["abcdef"].form_n == 300
    assert got["abcde"].root == "abcdefgh" and got["abcdefx"].root == "abcdefx"  # 300 is under ten times 300
    assert got["zzzzzzz"].form is None and got["zzzzzzz"].n_near == 0 and got["zzzzzzz"].root == "zzzzzzz"


def test_odd_rows(spark, make_docs):
    long = "Wörterbuch " * 30_000
    docs = make_docs([(1, None), (2, ""), (3, " 1234567 "), (None, "Straßenbahn ÀÉÎÕÜÿa"), (None, "Straßenbahn"), (4, long), (4, long)])
    got = {r.word: r.n for r in spelling.variants(docs).collect()}
    assert got == {"wörterbuch": 60_000, "straßenbahn": 2}  # upper-case letters beyond A-Z stay as they are
    assert spelling.variants(docs.limit(0)).count() == 0
    damaged = spelling.variants(docs, damage=1, rare=1).collect()
    # "ÀÉÎÕÜÿa" has seven letters, so six are left of it
    assert sum(r.n for r in damaged) == 60_002 and all(r.word not in got for r in damaged)
