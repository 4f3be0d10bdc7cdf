import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import compare
from halocline.llm import ann, components, jaccard, neardup, passages, shared
from halocline.llm.hnsw import Hnsw

SF = "/root/testdata/sf0.001"


def classes(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(80), 100 + rng.randrange(80)) for _ in range(60)] + [(500, 500 + i) for i in range(40)]
    got = components.connected(spark.createDataFrame(pairs + [(7, 7), (None, 3)], "a long, b long")).toPandas()
    want = classes([p for p in pairs if p[0] != p[1]], {x for p in pairs for x in p})
    found = dict(zip(got.node, got.component, strict=True))
    assert len(found) == len(got) and found == {n: c for n, c in want.items() if n in found}
    assert all(c == n for n, c in want.items() if n not in found)


def shingle_set(text, k):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset([tuple(w)] if 0 < len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def brute_jaccard(rows, k, p, q):
    sets = {d: shingle_set(t, k) for d, t in rows if d is not None}
    ids = [d for d in sets if sets[d]]
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if q * len(sets[a] & sets[b]) >= p * len(sets[a] | sets[b])]
    return {d: len(s) for d, s in sets.items()}, classes(pairs, sets)


@pytest.mark.parametrize(("block", "k", "share"), [(512, 3, (9, 10)), (4, 3, (9, 10)), (512, 5, (4, 5)), (3, 5, (4, 5))])
def test_jaccard_by_brute_force(spark, make_docs, words, monkeypatch, block, k, share):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(block + k)
    rows = [(1000, None), (1001, ""), (1002, " \n "), (1003, "One Two"), (1004, "one\ttwo"), (1005, "one two three"), (1006, "ONE two  three")]
    for family in range(12):
        base = words(rng.choice([4, 12, 30, 80, 300]))
        for i in range(12):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 8])):
                at = rng.randrange(len(own))
                if rng.random() < 0.5:
                    own[at] = rng.choice(words(3))
                else:
                    own.insert(at, words(1)[0])
            rows.append((family * 20 + i, " ".join(own)))
    rows += [(300, rows[20][1]), (None, "one two three"), (None, "x")]
    got = jaccard.components(make_docs(rows), k, share).toPandas()
    assert len(got) == len(rows)
    sizes, comp = brute_jaccard(rows, k, *share)
    own = got.dropna(subset=["doc_id"]).set_index("doc_id")
    assert own.n_shingles.to_dict() == sizes and own.component_id.astype(int).to_dict() == comp


def test_jaccard_sql(spark):
    got = jaccard.op4_ngram_jaccard(spark, SF).toPandas()
    assert compare.difference(got, compare.connect(SF).execute(jaccard.SQL).df()) is None


def test_jaccard_edges(spark, make_docs):
    assert jaccard.components(make_docs([])).count() == 0
    got = jaccard.components(make_docs([(1, "a b c d"), (1, "a b c d"), (2, "A b C d")])).toPandas()
    assert got.component_id.tolist() == [1, 1, 1] and got.n_shingles.tolist() == [2, 2, 2]


def test_word_hashes(monkeypatch):
    """One hash for each word, equal for equal words only, wherever pieces end."""
    rng = random.Random(9)
    pool = ["".join(rng.choice("abcÄß日.!1") for _ in range(rng.randrange(1, 30))) for _ in range(20_000)]
    text = " ".join(pool) + "\n\t A\x0bB\x0c\r" + "x" * 5000 + " " + "\u00a0nbsp"
    words = text.encode().lower().split()
    whole = shared.word_hashes(text)
    assert len(whole) == len(words) and len(set(whole.tolist())) == len(set(words))
    assert len({(w, h) for w, h in zip(words, whole.tolist(), strict=True)}) == len(set(words))
    monkeypatch.setattr(shared, "PIECE_BYTES", 64)
    assert (shared.word_hashes(text) == whole).all()
    assert len(shared.word_hashes("")) == len(shared.word_hashes(" \n ")) == 0


def test_signatures_of_just_similar_sets():
    """At 0.9 every such pair shares one; at 0.8 nearly all do."""
    rng = np.random.default_rng(2)

    def fresh(n):
        return rng.integers(0, 1 << 63, n).astype(np.uint64)

    met = {(9, 10): [], (4, 5): []}
    for share, found in met.items():
        p, q = share
        for n in [*range(1, 60), *[100, 130, 200, 333, 1000] * 8]:
            for gone in range(0, n, max(1, n // 50)):
                a = np.unique(fresh(n))
                most = ((n - gone) * q - p * n) // p  # new ones that the threshold leaves room for
                if most < 0:
                    break
                b = np.unique(np.r_[a[gone:], fresh(int(most))])
                same = len(np.intersect1d(a, b))
                if q * same >= p * (len(a) + len(b) - same) and not np.array_equal(a, b):
                    found.append((n, np.intersect1d(jaccard.signatures(a, share), jaccard.signatures(b, share)).size > 0))
    assert all(ok for _, ok in met[9, 10])
    assert np.mean([ok for _, ok in met[4, 5]]) >= 0.97
    assert np.mean([ok for n, ok in met[4, 5] if n >= 100]) >= 0.995


def test_passages(spark, make_docs, words):
    passage, short = words(70), words(30)
    rng = random.Random(1)

    def edited(share):
        return [words(1)[0] if rng.random() < share else w for w in passage]

    rows = [(i, " ".join(words(100) + (passage if i < 10 else edited(0.04)) + words(80))) for i in range(20)]
    rows += [(i, " ".join(words(200))) for i in range(20, 50)]
    rows += [(i, " ".join(words(90) + short + words(90))) for i in range(50, 58)]
    rows += [(60, None), (61, ""), (62, "one two"), (None, " ".join(passage)), (63, "the " * 300), (64, "the " * 300)]
    df = make_docs(rows)
    got = passages.repeats(df).toPandas()
    assert set(got.doc_id) == {*range(1, 20), 64} and (got.doc_id > got.source_doc_id).all()
    own = got[got.doc_id < 10]
    assert (own.start_word == 100).all() and (own.end_word == 170).all() and (own.similarity == 1).all()
    kept = passages.without_repeats(df, passages.repeats(df)).toPandas()
    assert list(kept.columns) == df.columns and len(kept) == len(rows)
    copy = make_docs([(1, " ".join(passage)), (2, " ".join(passage))])
    assert passages.without_repeats(copy, passages.repeats(copy)).toPandas().doc_id.tolist() == [1]  # 2 was nothing but a repetition
    text = dict(zip(kept.doc_id, kept.text, strict=True))
    assert " ".join(passage) in text[0] and " ".join(passage[:10]) not in text[5]
    assert text[5].split() == rows[5][1].split()[:100] + rows[5][1].split()[170:]
    assert all(text[i] == rows[i][1] for i in range(20, 58))
    assert passages.repeats(make_docs([])).count() == 0 and passages.without_repeats(make_docs([]), passages.repeats(make_docs([]))).count() == 0


def test_every_passage_of_a_chain(spark, make_docs, words):
    """Each of several passages that a document shares in order with its source, whatever lies between them."""
    parts = {0: (60, 60), 1: (60, 60), 2: (20, 60), 3: (60, 20, 60), 4: (50, 37), 5: (55, 55, 55)}
    gap = {0: 300, 1: 40, 2: 45, 3: 60, 4: 24, 5: 26}
    rows, want = [], set()
    for n, sizes in parts.items():
        shared = [words(size) for size in sizes]
        for doc in (10 * n, 10 * n + 1):
            text = words(15)
            for size, part in zip(sizes, shared, strict=True):
                if doc % 10 and size >= 50:
                    want.add((doc, doc - 1, len(text), len(text) + size))
                text += part + words(gap[n])
            rows.append((doc, " ".join(text)))
    got = passages.repeats(make_docs(rows)).toPandas()
    assert {(r.doc_id, r.source_doc_id) for r in got.itertuples()} == {(d, s) for d, s, _, _ in want}
    for doc, source, start, end in want:  # by chance a word beside a passage may agree too
        near = got[(got.doc_id == doc) & ((got.start_word - start).abs() <= 1) & ((got.end_word - end).abs() <= 1)]
        assert len(near) == 1 and near.source_doc_id.item() == source, (doc, start, end)
    assert len(got) == len(want)


def test_passage_whose_parts_are_in_earlier_documents(spark, make_docs, words):
    """The first holders of all its seeds share too little each; later holders, the tenth too, share all of it."""
    halves, thirds, tail = [words(30), words(30)], [words(20) for _ in range(3)], words(60)
    alone = [(i, " ".join(words(40) + part + words(40))) for i, part in enumerate(halves + thirds, 1)]
    often = [(i, " ".join(words(30) + thirds[i % 3] + words(30))) for i in range(10, 40)]
    # the last 30 of 90 words are in an earlier document than the first 60
    longer = [(6, " ".join(words(30) + tail)), (7, " ".join(words(30) + halves[1] + words(9)))]
    lines = words(30)
    longer.insert(0, (5 + 60, " ".join(words(20) + lines + words(20))))
    covered = words(60)  # every one of its k-mers is in an earlier document
    alone += [(8, " ".join(words(40) + covered[:35] + words(40))), (9, " ".join(words(40) + covered[25:] + words(40)))]
    whole = [(70, halves[0] + halves[1]), (71, sum(thirds, [])), (72, tail + lines), (73, covered)]
    rows = alone + often + longer
    want = {}
    for doc, part in whole:
        rows += [(doc, " ".join(words(25) + part + words(25))), (doc + 10, " ".join(words(12) + part + words(8)))]
        want[doc + 10] = (12, 12 + len(part))
    got = passages.repeats(make_docs(rows)).toPandas()
    for doc, (start, end) in want.items():
        own = got[(got.doc_id == doc) & (got.source_doc_id == doc - 10)]
        assert ((own.start_word - start).abs() <= 1).any() and ((own.end_word - end).abs() <= 1).any(), (doc, own)
    assert set(got.doc_id) == {72, *want}


def test_common_seed_within_a_batch(spark, make_docs, words):
    passage = words(60)
    rows = [(i, " ".join(words(40) + passage + words(20))) for i in range(200)]
    got = passages.repeats(make_docs(rows).repartition(2)).toPandas()
    assert set(got.doc_id) == set(range(1, 200))
    assert passages.repeats(make_docs([(5, rows[0][1]), (5, rows[1][1])])).count() == 0  # one id, one document


def test_chains_by_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(30):
        n = int(rng.integers(2, 40))
        x, y = rng.integers(0, 60, n), rng.integers(0, 60, n)
        found = passages.chains(x, y)
        assert sorted(i for c in found for i in c) == list(range(n))
        for c in found:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:]))
        order = sorted(range(n), key=lambda i: (x[i], y[i]))
        best = {}
        for i in order:
            before = [best[j] - passages.GAP * (x[i] - x[j] + y[i] - y[j]) for j in best if x[j] < x[i] and y[j] < y[i]]
            best[i] = passages.K + max([0, *before])
        c = found[0]
        score = passages.K * len(c) - passages.GAP * (x[c[-1]] - x[c[0]] + y[c[-1]] - y[c[0]])
        assert np.isclose(score, max(best.values()))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, copies long, part int")


def test_graph_recall():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 24))
    x[:200] = x[0] + 0.05 * rng.normal(size=(200, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, _ = Hnsw(x).search(x[::30], 96)
    true = np.argsort(-(x[::30] @ x.T), axis=1)[:, :5]
    assert np.mean([len(set(t) & set(g)) / 5 for t, g in zip(true, ids, strict=True)]) >= 0.95


@pytest.mark.parametrize("shard", [8192, 150])
def test_near_duplicates(spark, shard):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(1200, 16)).astype(np.float32)
    v[100:400] = v[100] + 0.04 * rng.normal(size=(300, 16))
    v[400:420] = v[400]
    v[420] = 3 * v[400]
    label = [int(i % 7 == 0) for i in range(1200)]
    rows = [(i, v[i].tolist(), label[i], 9, 9) for i in range(1200)]
    odd = [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] + [1.0] * 15, 0), (2003, [None] + [1.0] * 15, 0),
           (2004, v[3].tolist(), None), (2005, [1.0, 2.0], 0), (2006, [2.0, 4.0], 0), (2007, [], 0), (2008, [float("inf")] * 16, 0)]
    rows += [(*r, 9, 9) for r in odd] + [(None, v[3].tolist(), 0, 9, 9)]
    got = neardup.components(vectors(spark, rows), shard=shard).toPandas()
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    s = (u @ u.T >= 0.98) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(s, False)
    n = dict(enumerate(s.sum(axis=1))) | {r[0]: 0 for r in odd} | {2005: 1, 2006: 1}
    comp = classes([*zip(*np.nonzero(s), strict=True), (2005, 2006)], n)
    own = got.dropna(subset=["vec_id"]).set_index("vec_id")
    assert own.n_links.to_dict() == n and own.component_id.astype(int).to_dict() == comp
    assert (own.kept == (own.index == own.component_id)).all() and len(got) == len(rows)
    assert neardup.components(vectors(spark, [])).count() == 0


def test_near_duplicates_sql(spark):
    got = neardup.op9_near_duplicates(spark, SF).toPandas()
    assert compare.difference(got, compare.connect(SF).execute(neardup.SQL).df()) is None


def brute_nearest(rows, asks, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, v in ok:
        if asks(i):
            near = {j: max(float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w))) for jj, w in ok if jj == j and len(w) == len(v))
                    for j, w in ok if j != i and len(w) == len(v)}
            out[i] = sorted(near.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


def test_nearest_exact_when_small(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 8)).astype(np.float32)
    v[50:90] = v[50]
    rows = [(i, v[i].tolist()) for i in range(300)] + [(400, None), (450, [0.0] * 8), (500, [1.0, 2.0]), (501, [2.0, 1.0]),
                                                       (550, [float("nan")] * 8), (None, v[0].tolist())]
    df = vectors(spark, [(i, e, 0, 1, 1) for i, e in rows])
    got = ann.search(df, F.col("vec_id") % 50 == 0).toPandas().sort_values(["query_id", "rank"])
    want = brute_nearest(rows, lambda i: i % 50 == 0, 5)
    assert set(got.query_id) == {q for q, n in want.items() if n}
    for q, own in got.groupby("query_id"):
        assert own["rank"].tolist() == list(range(1, len(own) + 1))
        assert own.vec_id.tolist() == [j for j, _ in want[q]] and np.allclose(own.score, [s for _, s in want[q]], atol=1e-12)
    assert ann.search(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_nearest_recall_over_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 400)
    monkeypatch.setattr(ann, "CELL_ROWS", 150)
    monkeypatch.setattr(ann, "CELL_QUERIES", 20)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    v = (centres[rng.integers(0, 40, 4000)] + 0.4 * rng.normal(size=(4000, 16))).astype(np.float32)
    v[10:1300] = v[10]  # a third of all rows are one vector
    got = ann.search(vectors(spark, [(i, v[i].tolist(), 0, 1, 1) for i in range(4000)]), F.col("vec_id") % 50 == 0).toPandas()
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    hits = total = 0
    for q in range(0, 4000, 50):
        s = u.astype(float) @ u[q].astype(float)
        s[q] = -2
        kth = np.sort(s)[-5]
        own = got[got.query_id == q]
        assert len(own) == 5
        hits += (s[own.vec_id] >= kth - 1e-9).sum()
        total += 5
    assert hits / total >= 0.9
    own = got[got.query_id == 50].sort_values("rank")
    assert own.vec_id.tolist() == [10, 11, 12, 13, 14]


def test_pipeline(spark):
    """Stages in order, each on what the one before kept, held against plain versions."""
    import corpus_pipeline as c
    from halocline.llm import quality, langid
    from halocline.llm.shared import read, stored
    docs = read(spark, SF, "documents")
    names = [n for n, _ in c.STAGES]
    assert len(names) == 5 and c.ORACLE_SQL is None
    frames = []
    for i, (_, stage) in enumerate(c.STAGES):
        frames.append(docs.toPandas())
        docs = stored(stage(spark, docs, SF), "t")
        if i < 4:
            assert docs.columns == list(frames[0].columns)
    frames.append(docs.toPandas())
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").quality
    good = frames[0].doc_id.map(labels)
    kept = frames[0].doc_id.isin(frames[1].doc_id)
    assert kept[good == 1].mean() > 0.97 and kept[good == 0].mean() < 0.1
    assert len(frames[2]) >= 0.99 * len(frames[1])
    _, comp = brute_jaccard(list(zip(frames[2].doc_id, frames[2].text, strict=True)), 5, 4, 5)
    assert sorted(frames[3].doc_id) == sorted(set(comp.values()))
    cut = frames[4].set_index("doc_id").text
    before = frames[3].set_index("doc_id").text
    assert set(cut.index) <= set(before.index) and all(len(cut[i]) <= len(before[i]) for i in cut.index)
    assert set(frames[5].doc_id) == set(frames[4].doc_id)
    assert len(quality.NAMES) == 13 and langid.ORDER == 4


def test_words_across_pieces(monkeypatch):
    """A word's hash does not depend on where pieces are cut, and long words need no larger tables."""
    from halocline.llm import shared
    rng = random.Random(6)
    texts = ["".join(rng.choice("aB \n\té") for _ in range(n)) for n in (0, 1, 7, 64, 500)] + ["x" * 300, " " * 40, "ab " * 50, "a" * 64 + " b"]
    whole = [shared.word_hashes(t) for t in texts]
    monkeypatch.setattr(shared, "PIECE_BYTES", 8)
    shared._powers.cache_clear()
    try:
        for t, h in zip(texts, whole, strict=True):
            assert len(h) == len(re.findall(r"[^\x20\x09-\x0D]+", t)) and np.array_equal(shared.word_hashes(t), h)
    finally:
        shared._powers.cache_clear()


def test_nearest_orders_ties_by_id(spark):
    """200 multiples of one vector by powers of two: every cosine is 1, so the smallest ids win."""
    v = [0.3, -0.7, 0.2, 0.9]
    rows = [(i, [x * 2.0 ** (i - 100) for x in v]) for i in range(200)] + [(i, [1.0, float(i), 0.5, 0.1]) for i in range(200, 260)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, F.col("vec_id") % 50 == 0).where("query_id < 200").collect()
    for q in (0, 50, 100, 150):
        assert sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q) == list(enumerate([i for i in range(7) if i != q][:5], 1))


def test_run_in_many_documents(spark, make_docs, words, monkeypatch):
    """A line of 40 words in every document: passages that hold it are found, without a row for each pair of documents."""
    line, more, edited = words(40), words(20), words(15)
    rows = [(i, " ".join(words(30) + line + words(30))) for i in range(300)]
    exact, near = line + more, line + words(1) + edited
    rows += [(i, " ".join(words(20 + i % 7) + exact + words(9))) for i in (301, 302)]
    rows += [(303, " ".join(words(20) + near + words(9))), (304, " ".join(words(31) + line + words(1) + edited + words(9)))]
    rows += [(305, " ".join(words(20) + line + edited + words(9)))]  # the word between is missing
    counts, real = {}, passages.stored

    def counted(df, name):
        out = real(df, name)
        counts[name] = max(counts.get(name, 0), out.count())
        return out

    monkeypatch.setattr(passages, "stored", counted)
    got = passages.repeats(make_docs(rows)).toPandas()
    assert {(r.doc_id, r.source_doc_id) for r in got.itertuples()} >= {(302, 301), (304, 303), (305, 303)}
    assert set(got.doc_id) == {302, 304, 305}
    assert max(counts.values()) < 30 * len(rows), counts


def test_every_exact_passage_is_covered(spark, make_docs, words):
    """Documents dealt from a few lines: of each 50 words that an earlier document has, a run of 36 is in passages."""
    rng = random.Random(3)
    lines = [words(n) for n in (3, 12, 25, 37, 41, 49, 50, 58)]
    texts = [sum(([*rng.choice(lines), *words(rng.choice((0, 0, 0, 2)))] for _ in range(rng.randrange(3, 9))), []) for _ in range(60)]
    got = passages.repeats(make_docs([(i, " ".join(t)) for i, t in enumerate(texts)])).toPandas()
    seen = set()
    for doc, t in enumerate(texts):
        covered = np.zeros(len(t), bool)
        for r in got[got.doc_id == doc].itertuples():
            covered[r.start_word:r.end_word] = True
            assert r.source_doc_id < doc and r.end_word - r.start_word >= 50
        windows = [tuple(t[i:i + 50]) for i in range(len(t) - 49)]
        for i, w in enumerate(windows):
            assert w not in seen or covered[i:i + 50].sum() >= 36, (doc, i)
        seen.update(windows)


def test_texts_of_holders_only(spark, make_docs, words, monkeypatch):
    """After the first matches only the texts of documents that hold an open run are read and exchanged again."""
    line, edited = words(40), words(15)
    rows = [(i, " ".join(words(90))) for i in range(100)]
    rows += [(i, " ".join(words(30) + line + words(30))) for i in range(100, 120)]
    rows += [(120 + i, " ".join(words(20 + i) + line + words(1) + edited + words(9))) for i in (1, 2)]
    texts, real = [], passages._passages

    def counted(docs, *args, **more):
        texts.append(docs.count())
        return real(docs, *args, **more)

    monkeypatch.setattr(passages, "_passages", counted)
    got = passages.repeats(make_docs(rows)).toPandas()
    assert {(r.doc_id, r.source_doc_id) for r in got.itertuples()} == {(122, 121)}
    assert texts[0] == len(rows) and len(texts) == 3 and max(texts[1:]) <= 22, texts


@pytest.mark.parametrize("n_docs", [4, 60])
def test_runs_beside_seeds_by_brute_force(n_docs):
    """Each run is matched with the first document that has it and a seed beside it, in a row for each place it meets and each open key."""
    rng = np.random.default_rng(n_docs)
    far, rows = 38, []
    for doc in range(n_docs):
        for start in (0, 200):
            same = doc % 3 == 0  # equal seeds all along, as a repeated word gives
            rows += [(doc, 1, p, 0, 70 if same else 10 * int(rng.integers(1, 5)), False) for p in range(start, start + 150, 1 if same else 4)]
        rows += [(doc, 2, p, p + 36, 100 + int(rng.integers(0, 2)), bool(doc and rng.integers(0, 2))) for p in range(45, 60, 5)]
    rows.sort()
    kinds = ("long", "int", "int", "int", "long", "bool")
    types = {"long": pa.int64(), "int": pa.int32(), "bool": pa.bool_()}
    batch = pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], list("abcdef"))
    found = pa.Table.from_batches(passages._contexts(passages.K, far)(iter([batch])))
    ordered = found.sort_by([("hash", "ascending"), ("doc", "ascending"), ("pos", "ascending")]).combine_chunks().to_batches()
    met = pa.Table.from_batches(passages._matched(iter(ordered)))
    keys, n_keys = {}, set()
    for doc in range(n_docs):
        seeds = [(p, h) for d, kind, p, _, h, _ in rows if d == doc and kind == 1]
        for _, _, start, stop, run, wanted in (r for r in rows if r[0] == doc and r[1] == 2):
            for p, h in seeds:
                for side, low, high in ((1, start - far - passages.K, start - 1), (2, stop - passages.K + 1, stop + far)):
                    if low <= p <= high:
                        keys.setdefault((run, h, side), []).append((doc, start, wanted))
                        n_keys.add((run, h, side, doc, start))
    want = {(d, p, *min(own)[:2]) for own in keys.values() for d, p, wanted in own if wanted and d != min(own)[0]}
    got = met.select(["doc", "pos", "source", "at"]).to_pylist()
    assert {tuple(r.values()) for r in got} == want
    assert found.num_rows <= len(n_keys) and len(got) <= len(n_keys)
    if n_docs > 8:  # most keys are met within the batch: a row for each place met, and the firsts
        assert found.num_rows <= len(want) + 3 * len(keys)
