"""Importance resampling against SQL, a sorted list, and odd tables."""
import hashlib
import math
import random
import re
import zlib

import compare
from pyspark.sql import functions as F
from halocline.llm import resample

SF = "/root/testdata/sf0.001"


def floats(df):
    return df.astype({c: "float64" for c in df if str(df[c].dtype).lower().startswith(("int", "float"))})


def test_sql(spark):
    got = floats(resample.op12_importance_resampling(spark, SF).toPandas())
    want = floats(compare.connect(SF).execute(resample.SQL).df())
    assert want["rank"].notna().sum() >= 10 and compare.difference(got, want) is None


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, percent, least, buckets, longest, seed):
    def count(texts):
        out = [0] * buckets
        for t in texts:
            for f in features(t, longest)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = count(x for _, x in docs), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for d, text in docs:
        words, fs = features(text, longest)
        w = math.floor(sum(gain[zlib.crc32(f.encode()) % buckets] for f in fs) / len(fs)) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(words), len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    may = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    k = len(may) * percent // 100
    out = [(r[0], *r[2:], i + 1 if i < k else None) for i, r in enumerate(may)]
    return sorted(out + [(r[0], *r[2:], None) for r in rows if r[1] < least], key=str)


def test_brute_force_with_odd_rows(spark, make_docs, words):
    rng = random.Random(1)
    texts = [" ".join(words(rng.randint(0, 40))) for _ in range(150)]
    docs = [(i % 90, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "a " * 30)] + [(7, None), (8, ""), (9, "ÉTÉ x9-Y " * 4000)]
    docs += [(1000, "same words " * 12)] * 9
    target = [texts[3], None, "", "Same-Words"]
    df = make_docs(docs).drop("n_chars").withColumn("score", F.lit(1)).withColumn("buckets", F.lit("x"))
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for longest, percent in ((1, 10), (3, 35), (2, 100), (1, 0)):
        got = resample.resampled(df, aim, percent, 20, 97, longest, 5).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(docs, target, percent, 20, 97, longest, 5)
    assert resample.resampled(df.limit(0), aim).count() == 0
    assert resample.resampled(df, aim.limit(0)).count() == len(docs)


def test_kth_key_is_that_of_a_sorted_list(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(40)]), rng.choice([-5, 0, 0, 0, 3, 10**12])) for _ in range(500)]
    df = resample.keyed(spark.createDataFrame(rows, "doc_id long, score long")).cache()
    order = sorted((-s, d is None, d or 0) for d, s in rows)
    for k in (1, 2, 77, 250, 499, 500):
        assert resample.kth_key(df, k, pivots=3) == order[k - 1]
    assert resample.kth_key(df, 501) is None
