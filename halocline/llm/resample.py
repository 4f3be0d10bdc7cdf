"""Target-distribution importance resampling: draw the documents whose words look most like a target's.

*Weights.*  A text's features are its runs of one to ``longest`` words, hashed into buckets.
The counts of the corpus and of the target give every bucket a gain, the logarithm of the
ratio of its smoothed shares.  The gains are one array of a fixed number of buckets; a
document's weight is the floored mean of the gains at its own buckets.

*Draw.*  Gumbel noise from a hash of the id is added to the weight, so the highest scores
are a draw without replacement.  The k-th composite key (score, then id) is found by a
distributed quickselect: a few random keys of what remains are pivots, one scan counts the
rows below, at and above each, and only the rows between two pivots are written for the next
round.  Nothing is sorted until the winners are known; they alone are range-sorted, and a
rank is the place within a range plus the sizes of the ranges before it.

Defined results: a null text has no features, weight 0, and is not drawn; a null id is
hashed as an empty string and comes after every id among equal scores; repeated rows are
drawn and ranked one by one; an empty target or corpus gives gains from the smoothing alone; an
empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from halocline.llm.crc import TABLE, crc32_sql
from halocline.llm.shared import forget, lower_ascii, read, stored

BUCKETS, SEED, LEAST_WORDS, PERCENT = 10_000, 2024, 20, 10
#: What separates words, once A-Z are lower-cased: all ASCII but digits and a-z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Pivot keys of a round.
PIVOTS = 8
#: The order of the draw: highest score first, then smallest id, null ids last.
KEY = ("minus", "no_id", "id")


def feature_buckets(text: Column, buckets: int = BUCKETS, longest: int = 1) -> Column:
    """The bucket of every feature of a text, repeats included, after the number of its words: ``array<int>``."""
    words = F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")

    def hashed(features: Column) -> Column:
        return F.transform(features, lambda w: (F.crc32(w.cast("binary")) % buckets).cast("int"))

    def all_runs(w: Column) -> Column:
        out = [F.array(F.size(w)), hashed(w)]
        for k in range(2, longest + 1):
            out.append(hashed(runs(w, k)))
        return F.concat(*out)

    def runs(w: Column, k: int) -> Column:
        starts = F.when(F.size(w) >= k, F.sequence(F.lit(1), F.size(w) - (k - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, k), " "))

    # the words are bound as a variable, so the text is split once
    return F.transform(F.array(words), all_runs)[0]


def _counts(featured: DataFrame) -> DataFrame:
    return featured.select(F.explode(F.slice("buckets", 2, F.greatest(F.size("buckets") - 1, F.lit(0)))).alias("bucket")) \
        .groupBy("bucket").agg(F.count("*").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket, from frames with a column of ``feature_buckets``; as many numbers as buckets."""
    spark: SparkSession = corpus.sparkSession
    both = _counts(corpus).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).union(
        _counts(target).select("bucket", F.lit(0).cast("long"), F.col("n")))
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
    seen = both.union(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
    total_s, total_t = sum(r.s for r in seen), sum(r.t for r in seen)
    top, bottom = float(total_s + buckets), float(total_t + buckets)
    return [math.floor(1000 * math.log((r.t + 1) * top / ((r.s + 1) * bottom))) for r in sorted(seen)]


def scored(featured: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of ``doc_id, buckets`` rows."""
    table = F.split(F.lit(",".join(map(str, gain))), ",").cast("array<bigint>")
    n = (F.size("buckets") - 1).cast("long")
    total = F.aggregate(F.slice("buckets", 2, F.greatest(n.cast("int"), F.lit(0))), F.lit(0).cast("long"),
                        lambda acc, b: acc + F.get(table, b))
    rows = featured.select("doc_id", F.col("buckets")[0].cast("long").alias("n_words"), n.alias("n_features"), total.alias("total"))
    weight = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(0).cast("long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    return rows.select("doc_id", "n_words", "n_features", weight.alias("weight"), (weight + noise).alias("score"))


def keyed(rows: DataFrame) -> DataFrame:
    """Adds the columns KEY, whose ascending order is the order of the draw."""
    return rows.withColumn("minus", -F.col("score")).withColumn("no_id", F.col("doc_id").isNull()) \
        .withColumn("id", F.coalesce(F.col("doc_id"), F.lit(0)).cast("long"))


def _key() -> Column:
    return F.struct(*KEY)


def _literal(pivot: tuple) -> Column:
    minus, no_id, i = pivot
    return F.struct(F.lit(minus).cast("long").alias("minus"), F.lit(no_id).alias("no_id"), F.lit(i).cast("long").alias("id"))


def kth_key(rows: DataFrame, k: int, pivots: int = PIVOTS) -> tuple | None:
    """The k-th smallest key (from 1) of rows with the columns KEY, or None if there are fewer."""
    left, turn = rows.select(*KEY), 0
    while True:
        turn += 1
        drawn = left.orderBy(F.xxhash64(*KEY, F.lit(turn)), *KEY).limit(pivots).collect()
        chosen = sorted({tuple(r) for r in drawn})
        if not chosen:
            return None
        counts = left.agg(*[F.count(F.when(c, 1)) for p in chosen for c in (_key() < _literal(p), _key() == _literal(p))]).first()
        low = high = None
        skipped = 0
        for p, below, equal in zip(chosen, counts[::2], counts[1::2], strict=True):
            if below >= k:
                high = p
                break
            if below + equal >= k:
                if turn > 1:
                    forget(left)
                return p
            low, skipped = p, below + equal
        between = left
        if low is not None:
            between = between.where(_key() > _literal(low))
        if high is not None:
            between = between.where(_key() < _literal(high))
        between = stored(between, "resample-rest")
        if turn > 1:
            forget(left)
        left, k = between, k - skipped


def ranked(winners: DataFrame) -> DataFrame:
    """Adds ``rank`` (1, 2, 3... in the order of KEY) without bringing the rows together."""
    ordered = winners.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("_at", F.monotonically_increasing_id())
    ordered = stored(ordered, "resample-winners")
    part = F.shiftright("_at", 33)
    sizes = dict(ordered.groupBy(part.cast("int").alias("part")).count().collect())
    before, total = [], 0
    for p in range(max(sizes, default=0) + 1):
        before.append(total)
        total += sizes.get(p, 0)
    offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    return ordered.withColumn("rank", F.get(offsets, part.cast("int")) + F.expr("_at & 8589934591") + 1).drop("_at")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
              buckets: int = BUCKETS, longest: int = 1, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs`` (doc_id, text); rank is null if not drawn.

    ``percent`` of the documents with ``least_words`` words or more are drawn, rounded down.
    """
    source = stored(docs.select("doc_id", feature_buckets(F.col("text"), buckets, longest).alias("buckets")), "resample-features")
    aim = target.select(feature_buckets(F.col("text"), buckets, longest).alias("buckets"))
    rows = stored(keyed(scored(source, gains(source, aim, buckets), seed)), "resample-scores")
    forget(source)
    may = rows.where(F.col("n_words") >= least_words)
    k = may.count() * percent // 100
    last = kth_key(may, k) if k else None
    out = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if last is None:
        return rows.select(*out, none)
    wins = (F.col("n_words") >= least_words) & (_key() <= _literal(last))
    # rows equal to the last key, beyond the number to draw, are in the ranking but not drawn
    drawn = ranked(rows.where(wins)).withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return drawn.select(*out, "rank").union(rows.where(~wins).select(*out, none))


def op12_importance_resampling(spark, sf_dir: str) -> DataFrame:
    """A tenth of all ``documents``, drawn towards the words of ``benchmark``."""
    return resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _words_sql(table: str, row: str) -> str:
    return (f"SELECT {row}, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            f"'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS w FROM {table}")


SQL = f"""
WITH c AS MATERIALIZED (SELECT {TABLE} AS t),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
dw AS MATERIALIZED (SELECT r, w, count(*) AS n FROM ({_words_sql("d", "r")}) GROUP BY ALL),
bw AS (SELECT w, count(*) AS n FROM ({_words_sql("benchmark", "item_id")}) GROUP BY w),
v AS MATERIALIZED (SELECT w, {crc32_sql("w", "c.t")} % {BUCKETS} AS b FROM (SELECT w FROM dw UNION SELECT w FROM bw), c),
s AS (SELECT b, sum(n) AS s FROM dw JOIN v USING (w) GROUP BY b),
t AS (SELECT b, sum(n) AS t FROM bw JOIN v USING (w) GROUP BY b),
z AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS ss, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS tt),
g AS (SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (ss + {BUCKETS})
    / ((coalesce(s, 0) + 1)::DOUBLE * (tt + {BUCKETS}))))::BIGINT AS gain
  FROM (SELECT DISTINCT b FROM v) LEFT JOIN s USING (b) LEFT JOIN t USING (b), z),
m AS (SELECT r, sum(n)::BIGINT AS n, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM dw JOIN v USING (w) JOIN g USING (b) GROUP BY r),
x AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN m USING (r)),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS k,
    count(*) OVER (PARTITION BY n_features >= {LEAST_WORDS}) AS total FROM x)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= {LEAST_WORDS} AND k <= {PERCENT} * total // 100 THEN k END AS rank
FROM o"""
