"""Spelling variants: words one edit apart, found by asymmetric chunks, and the frequent form of each.

A word x gives two disjoint chunks, its left and its right half.  One inserted, deleted
or replaced code point leaves one of them whole, so a word y one edit away holds it as
the positional gram that starts at the same place or one further on.  The longer word
of a pair gives the grams, for each length that x may have; a pair of equal length meets
once.  Pairs that meet are verified: their edit distance must be one.

A chunk that many words share is not joined.  There the edit lies in the other half,
the *region*, so the region is halved in turn and what is kept grows to three quarters
of the word, and so on: each round splits only the keys whose pairs exceed MOST_PAIRS,
until a region is a single place, where nearly every pair is a link.  A pair with its
first difference at place p meets in the one region that holds p, so it is counted once.

Defined results: a null text has no words; a null id stands as an empty string in the
hash that selects occurrences; repeated rows count as often as they occur; words shorter
than ``least`` or rarer than ``rare`` are no words; a word without a near word has 0, null
form, and itself as root.  Ties between forms go to the smallest in code-point order.
Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from halocline.llm.crc import TABLE, crc32_sql
from halocline.llm.shared import forget, lower_ascii, read, stored

#: Letters of a run: A-Z, a-z and the code points 00C0 to 00FF.
LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST, RARE, DAMAGE, RATIO = 7, 2, 31, 10
#: Pairs of a chunk and a gram under one key beyond which the key's region is halved again.
MOST_PAIRS = 1024


def word_counts(docs: DataFrame, least: int = LEAST, rare: int = RARE, damage: int | None = None) -> DataFrame:
    """``word, n`` of the maximal letter runs of all texts, A-Z lower-cased.

    With ``damage`` one in so many occurrences, chosen by a hash of id and word, loses a code point.
    A run shorter than ``least`` is no word before or after that, so it is left out in the scan.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))).alias("word"))
    words = runs.select("doc_id", lower_ascii(F.col("word")).alias("word"))
    if damage:
        code = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
        words = words.select("word", code.alias("h")).select("h", "word", (F.col("h") % F.char_length("word")).cast("int").alias("at"))
        words = words.select(F.when(F.col("h") % damage == 0, F.concat(
            F.expr("left(word, at)"), F.expr("substr(word, at + 2)"))).otherwise(F.col("word")).alias("word"))
        words = words.where(F.char_length("word") >= least)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= rare)


def _halved(rows: DataFrame) -> DataFrame:
    """Both halves of every row's region ``[a, b)``, places of the shorter word, with the key of what is kept."""
    mid = F.expr("a + (b - a) div 2")
    halves = F.explode(F.array(F.struct(mid.alias("a"), F.col("b").alias("b")), F.struct(F.col("a").alias("a"), mid.alias("b"))))
    cut = rows.withColumn("half", halves).select("word", "n", "size", "longer", "half.a", "half.b")
    return cut.withColumn("key", F.xxhash64(
        "size", "a", "b", F.expr("left(word, a)"), F.expr("substr(word, b + longer + 1)")))


def _meetings(rows: DataFrame) -> DataFrame:
    """Pairs of words under one key that are one edit apart, each in the one region of its first difference."""
    # a row with longer = 0 is a chunk; every row is a gram, of a word as long or one longer
    x, y = rows.where("longer = 0").alias("x"), rows.alias("y")
    met = x.join(y, F.expr(
        "x.key = y.key and x.size = y.size and x.a = y.a and x.b = y.b and (y.longer = 1 or x.word < y.word) "
        "and levenshtein(x.word, y.word, 1) = 1 and left(x.word, x.a) = left(y.word, x.a) "
        "and (x.b = x.size or left(x.word, x.b) <> left(y.word, x.b))"))
    return met.select(F.col("x.word").alias("x"), F.col("x.n").alias("x_n"), F.col("y.word").alias("y"), F.col("y.n").alias("y_n"))


def near_words(words: DataFrame, least: int = LEAST, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """``x, x_n, y, y_n``: every unordered pair of ``word, n`` rows (distinct words) that are one edit apart, once."""
    size = F.char_length("word")
    lengths = F.explode(F.array(F.lit(0), F.lit(1)))
    rows = words.select("word", "n", lengths.alias("longer")).withColumn("size", size - F.col("longer"))
    rows = rows.where((F.col("size") >= least) & (F.col("size") > 0)).withColumn("a", F.lit(0)).withColumn("b", F.col("size"))
    found: list[DataFrame] = []
    while True:
        rows = stored(_halved(rows), "spelling-keys")
        grams = F.count("*")
        chunks = F.sum(F.when(F.col("longer") == 0, 1).otherwise(0))
        hot = rows.groupBy("key").agg(chunks.alias("c"), grams.alias("g"), F.max(F.expr("b - a")).alias("wide"))
        hot = stored(hot.where((F.col("c") * F.col("g") > most_pairs) & (F.col("wide") > 1)).select("key"), "spelling-hot")
        if hot.isEmpty():
            found.append(_meetings(rows))
            break
        # a hot key holds at least 32 rows, so the list of them is small beside the rows
        found.append(_meetings(rows.join(hot, "key", "left_anti")))
        rows = rows.join(hot, "key", "left_semi")
    return reduce(DataFrame.union, found)


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n`` of every word: its near words counted, and the largest if at least ``ratio`` times n."""
    sides = F.explode(F.array(
        F.struct(F.col("x").alias("word"), F.struct((-F.col("y_n")).alias("n"), F.col("y").alias("w")).alias("other")),
        F.struct(F.col("y").alias("word"), F.struct((-F.col("x_n")).alias("n"), F.col("x").alias("w")).alias("other"))))
    near = pairs.select(sides.alias("s")).select("s.*").groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    joined = words.join(near, "word", "left")
    large = -F.col("best.n") >= ratio * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, F.col("best.w")).alias("form"), F.when(large, -F.col("best.n")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """Adds ``root``, the last of the chain of forms from a word.

    Each step multiplies n, so a chain has at most 63 steps and pointer doubling at most six rounds.
    """
    links = stored(formed.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ends = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = stored(links.join(ends, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        forget(links)
        links = after.select("word", "root")
        if after.where("moved").isEmpty():
            break
    return formed.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, least: int = LEAST, rare: int = RARE, damage: int | None = None, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the texts of ``docs`` (doc_id, text)."""
    words = stored(word_counts(docs, least, rare, damage), "spelling-words")
    return roots(stored(forms(words, near_words(words, least), ratio), "spelling-forms"))


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Words of all ``documents``, one occurrence in 31 damaged, with their forms and roots."""
    return variants(read(spark, sf_dir, "documents"), damage=DAMAGE).select("word", "form", "root", "n", "n_near", "form_n")


SQL = f"""
WITH RECURSIVE t AS MATERIALIZED (SELECT {TABLE} AS t),
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
l AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n FROM r GROUP BY ALL),
h AS (SELECT w, n, {crc32_sql("id || ':' || w", "t.t")} AS h FROM l, t WHERE length(w) >= {LEAST}),
d AS (SELECT CASE WHEN h % {DAMAGE} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM d WHERE length(word) >= {LEAST} GROUP BY word HAVING sum(n) >= {RARE}),
v AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM v a JOIN v b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
  UNION
  SELECT DISTINCT a.word, a.n, b.word, b.n FROM v a JOIN w b ON a.cut = b.word
  UNION
  SELECT DISTINCT b.word, b.n, a.word, a.n FROM v a JOIN w b ON a.cut = b.word),
best AS (SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near,
  row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS k FROM p),
f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= {RATIO} * w.n THEN other END AS form,
    CASE WHEN m >= {RATIO} * w.n THEN m END AS form_n
  FROM w LEFT JOIN best ON w.word = best.word AND k = 1),
c AS (
  SELECT word, word AS root, 0 AS step FROM f
  UNION ALL
  SELECT c.word, f.form, step + 1 FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, arg_max(c.root, c.step) AS root, f.n, f.n_near, f.form_n
FROM f JOIN c ON c.word = f.word GROUP BY ALL"""
