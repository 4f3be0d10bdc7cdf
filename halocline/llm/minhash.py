"""Document fingerprints: one-permutation MinHash, densified, a few low bits of each bin.  Column expressions only.

Every word is hashed once and every shingle of ``k`` words once.  The top bits of a shingle's
hash choose one of BINS bins, and a bin keeps its smallest hash: one pass instead of one
for each of many permutations.  An empty bin borrows from another one: every bin has a fixed
order of preference over all bins (ROUNDS drawn places, then the rest by a hash of both
places) and takes the first that is not empty.  The order depends on the place alone, so
two texts borrow alike, and a borrowed bin agrees with the probability of a filled one.

Of each bin the low BITS bits of a hash of (kept value, place) are stored, packed into 64-bit
numbers.  Unlike sets agree in one bin of 2**BITS by chance; ``likeness`` takes that out:
(share - 2**-BITS) / (1 - 2**-BITS), held between 0 and 1.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  Defined results: a text of fewer words
than a shingle is one shingle; a null, empty or blank text has a null packed fingerprint and an
empty string, is like another such text with 1 and like others with 0; equal texts have
equal fingerprints.  ``with_next`` orders rows by (id, hash of the text, text), null
ids first, so repeated ids follow one another; the last is followed by the first, and a single row by
itself.  Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from halocline.llm.shared import lower_ascii, mix, read

SHINGLE, BINS, BITS, ROUNDS = 5, 256, 4, 8
#: Rows of a range of ids, and the number of ranges beyond which they grow instead.
ROWS_IN_RANGE, MOST_RANGES = 8_192, 65_536
SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _literal(values: Iterable[object], kind: str) -> Column:
    """A constant array."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def shingle_hashes(text: Column, k: int = SHINGLE) -> Column:
    """``array<long>``: a hash of every k successive words, with repeats."""
    words = F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")
    none = F.array().cast("array<long>")
    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) == 0, none).when(
        F.size(h) < k, F.array(F.xxhash64(h))).otherwise(F.transform(
            F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))))


def _preferred(turn: int) -> Column:
    """For each bin the one it looks at in this round."""
    place = np.arange(BINS, dtype=np.uint64) + np.uint64(turn * BINS)
    return _literal((mix(place) % np.uint64(BINS)).tolist(), "int")


def bins(hashes: Column) -> Column:
    """BINS values, none empty, of the hashes of a text; null of no hashes."""
    shift = 63 - (BINS - 1).bit_length()

    def place(x: Column) -> Column:
        return F.shiftright(x, shift).cast("int")

    def gaps(n: Column) -> Column:
        return F.array_repeat(F.lit(None).cast("long"), n.cast("int"))

    def least(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (place(x) != place(F.get(s, i - 1))))

    def spread(f: Column) -> Column:
        before = F.transform(f, lambda x, j: F.concat(
            gaps(place(x) - F.when(j > 0, place(F.get(f, j - 1)) + 1).otherwise(0)), F.array(x)))
        return F.concat(F.flatten(before), gaps(BINS - 1 - place(F.get(f, F.size(f) - 1))))

    def tried(values: Column, own: Column, at: Column) -> Column:
        return F.transform(values, lambda v, i: F.coalesce(v, F.get(own, F.get(at, i))))

    def borrowed(f: Column) -> Column:
        def fill(own: Column) -> Column:
            full = own
            for turn in range(ROUNDS):
                full = tried(full, own, _preferred(turn))
            return F.transform(full, lambda v, i: F.coalesce(v, F.array_min(F.transform(
                f, lambda x: F.struct(F.xxhash64(i, place(x)).alias("order"), x.alias("x"))))["x"]))
        return _let(spread(f), fill)

    # sorted, the hashes of a bin stand together, its smallest first
    ordered = F.sort_array(F.transform(hashes, lambda h: F.shiftrightunsigned(h, 1)))
    return _let(_let(ordered, least), lambda f: F.when(F.size(f) > 0, borrowed(f)))


def packed(text: Column, k: int = SHINGLE) -> Column:
    """The fingerprint: ``array<long>`` of BINS * BITS bits."""
    each = 64 // BITS
    digits = F.transform(bins(shingle_hashes(text, k)), lambda x, i: F.xxhash64(x, i).bitwiseAND(F.lit((1 << BITS) - 1).cast("long")))
    return _let(digits, lambda d: F.when(d.isNotNull(), F.transform(F.sequence(F.lit(0), F.lit(BINS // each - 1)), lambda w: F.aggregate(
        F.slice(d, w * each + 1, each), F.lit(0).cast("long"), lambda acc, v: F.shiftleft(acc, BITS).bitwiseOR(v)))))


def text_of(fingerprint: Column) -> Column:
    """A packed fingerprint in hex digits; empty for none."""
    return F.coalesce(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingles of two packed fingerprints."""
    ones = F.lit(sum(1 << i for i in range(0, 64, BITS))).cast("long")

    def unlike(x: Column, y: Column) -> Column:
        bits = reduce(lambda z, s: z.bitwiseOR(F.shiftrightunsigned(z, s)), [1 << i for i in range((BITS - 1).bit_length())], x.bitwiseXOR(y))
        return F.bit_count(bits.bitwiseAND(ones))

    differ = F.aggregate(F.zip_with(a, b, unlike), F.lit(0), lambda acc, n: acc + n)
    chance = 2.0 ** -BITS
    share = (1.0 - differ / F.lit(float(BINS)) - chance) / (1.0 - chance)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), share))


def _bucketed(docs: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id, text, u, h`` with ``bucket``: ranges of the order (doc_id, u, h, text), of about equal numbers of rows.

    Bounds are approximate quantiles of the ids, a range for every ROWS_IN_RANGE rows.  An id that
    fills several ranges, or a missing one, is split further by the hash of its text.
    """
    parts = min(max(docs.count() // ROWS_IN_RANGE, 2), MOST_RANGES)
    at = _literal([i / parts for i in range(1, parts)], "double")
    found = docs.agg(F.percentile_approx("doc_id", at, F.lit(max(10_000, 10 * parts)))).first()[0] or []
    often = sorted(Counter(found or [0]).items())
    bounds = [b for b, _ in often]
    group = int(len(bounds) ** 0.5) + 1
    every, some = _literal(bounds, "long"), _literal(bounds[::group], "long")

    def upto(a: Column) -> Column:
        return F.size(F.filter(a, lambda b: b <= F.col("doc_id")))

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("u", F.shiftrightunsigned("h", 33))
    rows = rows.withColumn("coarse", upto(some))
    rows = rows.withColumn("base", F.when(F.col("coarse") > 0, (F.col("coarse") - 1) * group + upto(
        F.slice(every, (F.col("coarse") - 1) * group + 1, group))).otherwise(0))
    own = F.get(every, F.col("base") - 1) == F.col("doc_id")
    times = F.coalesce(F.get(_literal([n for _, n in often], "long"), F.col("base") - 1), F.lit(0))
    sub = F.when(F.col("doc_id").isNull(), F.shiftright(F.col("u") * parts, 31)) \
        .when(own, F.shiftright(F.col("u") * times, 31)).otherwise(times)
    base = F.when(F.col("doc_id").isNull(), 0).otherwise(F.col("base") + 1)
    return rows.select("doc_id", "text", "u", "h", (base * (parts + 1) + sub).cast("long").alias("bucket")), parts


def with_next(docs: DataFrame, fingerprint: Callable[[Column], Column] = packed) -> DataFrame:
    """``doc_id, text, own, next_text, next_own``: every row with the fingerprints of its text and of the next row's.

    One shuffle by ranges; the first row of each range goes to the last one of the range before.
    """
    rows, parts = _bucketed(docs)
    order = [F.asc_nulls_first("doc_id"), F.asc("u"), F.asc("h"), F.asc("text")]
    back = [F.desc_nulls_last("doc_id"), F.desc("u"), F.desc("h"), F.desc("text")]
    along, against = Window.partitionBy("bucket").orderBy(*order), Window.partitionBy("bucket").orderBy(*back)
    inner = rows.withColumn("own", fingerprint(F.col("text"))).repartition(parts, "bucket")
    inner = inner.withColumn("next_text", F.lead("text").over(along)).withColumn("next_own", F.lead("own").over(along))
    inner = inner.where(F.col("next_text").isNotNull()).select("doc_id", "text", "own", "next_text", "next_own")
    used = sorted(r.bucket for r in rows.select("bucket").distinct().collect())
    spark = docs.sparkSession
    follows = spark.createDataFrame(list(zip(used, used[1:] + used[:1])), "bucket long, following long")
    first = rows.withColumn("k", F.row_number().over(along)).where("k = 1").select(F.col("bucket").alias("following"), F.col("text").alias("next_text"))
    last = rows.withColumn("k", F.row_number().over(against)).where("k = 1").select("doc_id", "text", "bucket")
    # one row for each range: as many as partitions
    outer = last.join(F.broadcast(follows), "bucket").join(first, "following")
    outer = outer.select("doc_id", "text", fingerprint(F.col("text")).alias("own"), "next_text",
                         fingerprint(F.col("next_text")).alias("next_own"))
    return inner.union(outer)


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all ``documents`` and of their texts with the second half taken from the next document."""
    rows = with_next(read(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = rows.withColumn("n_chars", F.char_length("text"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.left("text", F.col("n_chars") - half), F.left("next_text", half)))
    rows = rows.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       "own", "next_own", packed(F.col("edited")).alias("new"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", text_of(F.col("own")).alias("fingerprint"),
        text_of(F.col("new")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("new")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"))
