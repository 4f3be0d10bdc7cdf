"""Fingerprints against a plain Python version, true similarities, and odd tables."""
import hashlib
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from halocline.llm import minhash
from halocline.llm.shared import mix

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def fold(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<Q", v & MASK), h)
    return h


def fold_int(values):
    """Of 32-bit places, which Spark hashes as four bytes."""
    h = 42
    for v in values:
        h = spark_int(v, h)
    return h


def spark_int(v, seed):
    return xxhash.xxh64_intdigest(struct.pack("<I", v & 0xFFFFFFFF), seed)


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    return [fold(h[i:i + k]) for i in range(len(h) - k + 1)] if len(h) >= k else [fold(h)] if h else []


def brute(text):
    n, bits, rounds = minhash.BINS, minhash.BITS, minhash.ROUNDS
    own = {}
    for x in (h >> 1 for h in shingles(text)):
        b = x >> (63 - 8)
        own[b] = min(own.get(b, x), x)
    if not own:
        return ""
    out = []
    for i in range(n):
        tries = [i, *(int(mix(np.array([t * n + i], np.uint64))[0]) % n for t in range(rounds))]
        at = next((b for b in tries if b in own), None)
        if at is None:
            at = min(own, key=lambda b: signed(fold_int([i, b])))
        out.append(f"{spark_int(i, fold([own[at]])) % (1 << bits):x}")
    return "".join(out)


def like(a, b):
    if not a or not b:
        return float(a == b)
    p, c = sum(x == y for x, y in zip(a, b, strict=True)) / minhash.BINS, 2.0 ** -minhash.BITS
    return max(0.0, (p - c) / (1 - c))


def check(rows, docs):
    """``docs`` in the order of the operator."""
    texts = [t or "" for _, t in docs]
    want = []
    for i, (d, _) in enumerate(docs):
        t, after = texts[i], texts[(i + 1) % len(docs)]
        half = len(t) // 2
        new = t[:len(t) - half] + after[:half]
        a, b, c = brute(t), brute(new), brute(after)
        want.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), a, b, round(like(a, b), 9), round(like(a, c), 9)))
    got = [(*tuple(r)[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_query_is_the_plain_version(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    check(minhash.op13_fingerprints(spark, SF).collect(), docs)


@pytest.mark.parametrize("size", [1000, 11, 2])
def test_next_rows_with_odd_ids(spark, make_docs, words, monkeypatch, size):
    monkeypatch.setattr(minhash, "ROWS_IN_RANGE", size)
    rng = random.Random(9)
    rows = [(rng.choice([None, 3, *range(30)]) if i % 3 else 3, " ".join(words(rng.randint(0, 9)))) for i in range(90)]
    rows += [(5, None), (6, ""), (3, "same"), (3, "same"), (10**15, "x " * 20_000), (-10**15, "ÉA b")]

    def order(r):
        h = xxhash.xxh64_intdigest((r[1] or "").encode(), 42)
        return (r[0] is not None, r[0] or 0, h >> 33, signed(h))

    got = minhash.with_next(make_docs(rows)).select("doc_id", "text", "next_text").collect()
    texts = [(d, t or "") for d, t in sorted(rows, key=order)]
    want = [(d, t, texts[(i + 1) % len(texts)][1]) for i, (d, t) in enumerate(texts)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert minhash.with_next(make_docs(rows[:1])).select("next_text").first()[0] == rows[0][1]
    assert minhash.with_next(make_docs(rows).limit(0)).count() == 0


def test_likeness_is_near_the_similarity(spark, words):
    rng = random.Random(2)
    rows, truth = [], []
    for n in (3, 12, 60, 300, 1500):
        for share in (0.0, 0.3, 0.6, 0.9, 1.0):
            for _ in range(12):
                a = words(n)
                b = a[:int(n * share)] + words(n - int(n * share))
                rng.shuffle(rows)
                x, y = set(shingles(" ".join(a))), set(shingles(" ".join(b)))
                truth.append((" ".join(a), " ".join(b), len(x & y) / len(x | y)))
    df = spark.createDataFrame(truth, "a string, b string, j double")
    error = df.select((minhash.likeness(minhash.packed(F.col("a")), minhash.packed(F.col("b"))) - F.col("j")).alias("e")).toPandas()["e"]
    assert error.abs().max() < 0.2 and error.abs().mean() < 0.03 and abs(error.mean()) < 0.01


def test_blank_and_equal_texts(spark):
    df = spark.createDataFrame([(None, ""), (" \t", None), ("a", "A"), ("a", ""), ("one two", "two one")], "a string, b string")
    got = [r[0] for r in df.select(minhash.likeness(minhash.packed(F.col("a")), minhash.packed(F.col("b")))).collect()]
    assert got[:4] == [1.0, 1.0, 1.0, 0.0] and got[4] < 0.2
    assert df.select(minhash.text_of(minhash.packed(F.col("a")))).first()[0] == ""
