import zlib

import numpy as np
import pandas as pd

from halocline.llm import langid, quality

SF = "/root/testdata/sf0.01"
ODD = [None, "", "   \n\t ", "a", "1234 !!", "\x02\x02 z", "日本語", "x" * 3000, "word " * 4000]


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_quality_held_out(spark):
    got = quality.op7_quality(spark, SF).toPandas()
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert sorted(got.doc_id) == sorted(docs.doc_id) and (got.held_out == got.doc_id.map(held)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    m = got.merge(labels, on="doc_id")
    assert (m[m.held_out].predicted == m[m.held_out].quality).mean() >= 0.95


def test_quality_does_not_see_held_out_labels(spark, make_docs):
    rows = [(i, f"plain words of text number {i} go on") if i % 2 else (i, "bad### bad$$$ " * 9) for i in range(120)]
    df = make_docs(rows)
    true = spark.createDataFrame([(i, i % 2, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    lies = spark.createDataFrame([(i, 1 - i % 2 if held(i) else i % 2, 0) for i in range(120)], true.schema)
    x = quality.features(df)
    a, b = (quality.scored(x, quality.fit(x, y)).toPandas().set_index("doc_id").score for y in (true, lies))
    assert np.allclose(a, b.loc[a.index]) and ((a >= 0.5) == (a.index % 2 == 1)).all()


def test_quality_odd_rows(spark, make_docs):
    df = make_docs([(i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (3, "a")])
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (7, None, 0), (None, 1, 0), (8, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    x = quality.features(df)
    got = quality.scored(x, quality.fit(x, labels)).toPandas()
    assert len(got) == len(ODD) + 2 and got.score.between(0, 1).all()
    none = quality.fit(x, labels.limit(0))
    assert set(quality.scored(x, none).toPandas().score) == {0.5}
    assert quality.keep_good(df, none).columns == df.columns and quality.keep_good(df.limit(0), none).count() == 0


def test_quality_is_the_discriminant(spark):
    """The scores follow the densities written out plainly."""
    rng = np.random.default_rng(0)
    k = len(quality.NAMES)
    x0, x1 = rng.normal(0, 1, (400, k)), rng.normal(1, 2, (300, k))
    ids = [i for i in range(2000) if not held(i)][:700]
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in zip(ids, np.r_[x0, x1], strict=True)], "doc_id long, x array<double>")
    labels = spark.createDataFrame([(i, int(n >= 400)) for n, i in enumerate(ids)], "doc_id long, quality int")
    model = quality.fit(rows, labels)
    pooled = (np.cov(x0.T) * 399 + np.cov(x1.T) * 299) / 700
    scale = np.sqrt(np.diag(pooled))
    parts = []
    for x in (x0, x1):
        s = (0.9 * np.cov(x.T) + 0.1 * pooled) / np.outer(scale, scale)
        s = 0.99 * s + 0.01 * np.eye(k) * np.trace(s) / k
        d = (np.r_[x0, x1] - x.mean(axis=0)) / scale
        parts.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) - 0.5 * np.linalg.slogdet(s)[1])
    assert np.allclose(model.difference(np.r_[x0, x1]), parts[1] - parts[0], atol=1e-6)


def test_language_held_out(spark):
    got = langid.op6_language(spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert sorted(got.doc_id) == sorted(docs.doc_id) and (got.held_out == got.doc_id.map(held)).all()
    m = got.merge(docs, on="doc_id")
    assert (m[m.held_out].lang_pred == m[m.held_out].lang).mean() >= 0.99
    assert got.score.between(0, 1).all() and got.rejected.mean() < 0.01


def test_language_odd_rows(spark, make_docs):
    rows = [(i, "the cat sat on the mat and ate " * 3, "en") for i in range(20)] + [(i, "der hund und die katze sind nicht da " * 3, "de") for i in range(20, 40)]
    df = make_docs(rows + [(40 + i, t, None) for i, t in enumerate(ODD)] + [(None, "the cat", "xx"), (1, "der hund", None)])
    got = langid.predictions(df, langid.fit(df)).toPandas()
    assert len(got) == df.count() and set(got.lang_pred) <= {"en", "de", "und"}
    by = got.dropna(subset=["doc_id"]).drop_duplicates("doc_id").set_index("doc_id")
    assert (by.loc[range(2, 20)].lang_pred == "en").all() and (by.loc[range(20, 40)].lang_pred == "de").all()
    for i, t in enumerate(ODD):
        letterless = not any(c.isalpha() for c in t or "")
        assert (by.loc[40 + i].lang_pred == "und") == letterless and (not letterless or by.loc[40 + i].rejected)
    empty = langid.fit(df.limit(0))
    assert set(langid.predictions(df, empty).toPandas().lang_pred) == {"und"}
    assert langid.keep_known(df, langid.fit(df)).columns == df.columns


def test_language_rejection(spark, make_docs):
    """Ambiguous texts, a language never learnt and random letters are rejected; clean texts of learnt languages stay."""
    rng = np.random.default_rng(3)
    vocabulary = {lang: ["".join(rng.choice(list(own), rng.integers(2, 8))) for _ in range(300)]
                  for lang, own in (("aa", "abcdefghij"), ("bb", "fghijklmno"), ("unlearnt", "pqrstuvwxyz"))}

    def text(lang, n=60):
        return " ".join(rng.choice(vocabulary[lang], n))

    learnt = [(i, text("aa" if i % 2 else "bb"), "aa" if i % 2 else "bb") for i in range(400)]
    clean = [(1000 + i, text("aa" if i % 2 else "bb")) for i in range(100)]
    foreign = [(2000 + i, text("unlearnt")) for i in range(50)]
    noise = [(3000 + i, " ".join("".join(rng.choice(list("abcdefghijklmno"), 5)) for _ in range(60))) for i in range(50)]
    models = langid.fit(make_docs(learnt))
    got = langid.predictions(make_docs(clean + foreign + noise), models).toPandas().set_index("doc_id")
    assert got.loc[[r[0] for r in clean]].rejected.mean() <= 0.05
    assert got.loc[[r[0] for r in foreign + noise]].rejected.all()
    kept = langid.keep_known(make_docs(clean + foreign + noise), models).toPandas()
    assert set(kept.doc_id) == set(got.index[~got.rejected])
    assert models.shift < 0  # without a margin a text counts as ambiguous


def test_language_keeps_rare_grams(spark, monkeypatch):
    """With more n-grams than are broadcast, results are those of models that hold them all."""
    rng = np.random.default_rng(11)
    letters = {"aa": "abcdefghij", "bb": "cdefghijkl"}

    def text(lang, n):
        return " ".join("".join(rng.choice(list(letters[lang]), rng.integers(2, 9))) for _ in range(n))

    rows = [(i, text("aa" if i % 2 else "bb", 1 + i % 15), "aa" if i % 2 else "bb") for i in range(300)]
    rows += [(1000 + i, t, None) for i, t in enumerate(ODD)] + [(None, "abc def"), (5, "fgh abc zzz"), (5, "fgh abc zzz")]
    docs = spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "keep") for r in rows], "doc_id long, text string, lang string, _uid string")

    def found():
        models = langid.fit(docs)
        key = ["doc_id", "lang_pred", "score"]
        kept = langid.keep_known(docs, models)
        assert kept.columns == docs.columns
        return models, langid.predictions(docs, models).toPandas().sort_values(key), sorted(map(str, kept.collect()))

    whole, a, kept_a = found()
    assert whole.tables is None
    for most in (500, 0):  # some n-grams are broadcast, or none
        monkeypatch.setattr(langid, "MOST_GRAMS", most)
        models, b, kept_b = found()
        assert models.tables and len(models.logp[-1]) * 2 <= most and (len(models.logp[-1]) > 0) == (most > 0)
        assert len(a) == len(b) == len(rows) and kept_a == kept_b
        for c in ("doc_id", "lang_pred", "rejected", "held_out"):
            assert a[c].fillna(-1).tolist() == b[c].fillna(-1).tolist()
        assert np.allclose(a.score, b.score, atol=1e-4)
        assert np.isclose(models.slope, whole.slope, rtol=1e-3) and np.allclose(models.worst, whole.worst, rtol=1e-4)


def test_language_found_is_written(spark, make_docs, monkeypatch):
    """Kept documents carry the language found, not a missing or wrong one, with arrays and with tables."""
    rows = [(i, "the cat sat on the mat and ate " * 3, "en") for i in range(40)] + [(i, "der hund und die katze sind nicht da " * 3, "de") for i in range(40, 80)]
    learnt = make_docs(rows)
    odd = [(100, "the cat and the mat", None), (101, "der hund ist nicht da", None), (102, "the cat sat on the mat", "de"), (103, "der hund und die katze", "en"),
           (103, "the mat and the cat", "en"), (None, "der hund und der hund", None), (104, "123", "en"), (105, None, "de")]
    docs = make_docs(odd)
    want = {t: "de" if t.startswith("der") else "en" for _, t, _ in odd[:6]}
    for most in (langid.MOST_GRAMS, 0):
        monkeypatch.setattr(langid, "MOST_GRAMS", most)
        models = langid.fit(learnt)
        kept = langid.keep_known(docs, models)
        assert kept.schema == docs.schema and {r.text: r.lang for r in kept.collect()} == want
        others = [c for c in docs.columns if c != "lang"]
        assert sorted(map(str, kept.select(others).collect())) == sorted(map(str, docs.where("doc_id is null or doc_id < 104").select(others).collect()))
        bare = langid.keep_known(docs.drop("lang"), models)
        assert bare.columns == [*others, "lang"] and {r.text: r.lang for r in bare.collect()} == want


def test_kneser_ney_by_dictionaries():
    """Log probabilities against a plain recursive version; they sum to one over the alphabet."""
    texts = {"a": "abra cadabra abra", "b": "banana bandana"}
    counts: dict[str, dict[str, int]] = {}
    arrays: list[tuple[int, int, int]] = []
    for n, (lang, text) in enumerate(texts.items()):
        g, _, _ = langid.grams([text])
        keys, c = np.unique(g, return_counts=True)
        counts[lang] = {"".join(chr((int(k) >> (16 * (3 - i))) & 0xFFFF) for i in range(4)): int(v) for k, v in zip(keys, c, strict=True)}
        arrays += [(n, int(k), int(v)) for k, v in zip(keys, c, strict=True)]
    lang, gram, n = (np.array(x) for x in zip(*arrays, strict=True))
    models = langid.compile_models(["a", "b"], lang, gram.astype(np.uint64), n)
    alphabet = sorted({k[-1] for t in counts.values() for k in t})

    def p(table, gram):
        if not gram:
            return 1 / (len(alphabet) + 1)
        if len(gram) < 4:
            longer = table["up"]
        c = table["c"].get(len(gram))
        total = sum(v for k, v in c.items() if k[:-1] == gram[:-1])
        kinds = sum(1 for k in c if k[:-1] == gram[:-1])
        if not total:
            return p(table, gram[1:])
        return max(c.get(gram, 0) - 0.75, 0) / total + 0.75 * kinds / total * p(table, gram[1:])

    for i, name in enumerate(texts):
        c = {4: counts[name]}
        for order in (3, 2, 1):
            c[order] = {}
            for k in c[order + 1]:
                c[order][k[1:]] = c[order].get(k[1:], 0) + 1
        table = {"c": c, "up": None}
        probe = [*counts["a"], *counts["b"], "zzzz", "abrz", "xabr"]
        packed = np.array([sum(ord(ch) << (16 * (3 - j)) for j, ch in enumerate(g)) for g in probe], np.uint64)
        got = models.log_probability(packed)[:, i]
        assert np.allclose(got, [np.log(p(table, g)) for g in probe], atol=1e-5)


def test_hash_array():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 62, 5000).astype(np.uint64))
    table = langid.HashArray(keys)
    at = table.find(keys)
    assert (keys[table.order][at] == keys).all()
    assert (table.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()
