"""Language identification by interpolated Kneser-Ney character models.

Counts of every character n-gram of the highest order are taken over all training
texts by partial sums; lower orders follow from them as continuation counts.  A model
is a set of sorted hash arrays, one for each order, with the log probability of each
n-gram in every language, smoothing included, so a position costs one search unless
its n-gram is new.  Of more n-grams than MOST_GRAMS only the most frequent are held as
arrays, with the same log probabilities; the others of a text are looked up by joins with
the counts, so no n-gram is dropped.  The language of least cross-entropy per character wins.  A score is
calibrated on a bounded sample of training texts (CALIBRATION_ROWS), and so are the
bounds beyond which a document is rejected.

Defined results: null texts and texts without a letter are ``und`` with score 0 and
rejected; ties go to the language first in the alphabet; rows with null ids are never
learnt from; with no language to learn everything is ``und``.  Repeated rows count
each.  ``keep_known`` writes the language found into ``lang``, whatever the row had there,
and adds that column where it is missing; other columns it passes through.  They are
ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from halocline.llm.shared import fresh, held_out, mix, read, stored, text_slices

ORDER = 4
BITS = 16
DISCOUNT = 0.75
#: Counts of the highest order that are compiled into arrays; beyond it only the most frequent are broadcast, the rest is joined.
MOST_GRAMS = 2_000_000
CALIBRATION_ROWS = 20_000
#: A text is accepted if its language is right with at least this probability.
ACCEPT = 0.5
#: Share of well-recognised calibration texts that a language's bound on the cross-entropy may reject.
TAIL = 0.001
#: The bound lies at least so many standard deviations above the mean: a high quantile of few texts is only their largest.
DEVIATIONS = 4.0
#: Shorter texts are not rejected for their cross-entropy, which says little there.
LEAST_LETTERS = 20
SPACE, PAD = 32, 2
#: Characters whose n-grams are held as arrays at once.
PIECE_CHARS = 400_000
_table: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point its lower-case letter in 16 bits, or a space; the padding stands for itself."""
    if not _table:
        table = np.full(0x110000, SPACE, np.uint16)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = ord(c.lower()[0])
                table[i] = low if low < 0xFFFF else (low * 40503 & 0x3FFF) + 0xC000
        table[PAD] = PAD
        _table.append(table)
    return _table[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed n-grams of all texts one after another, the number of the text of each, and letters in each text."""
    pad = chr(PAD) * (ORDER - 1)
    joined = "".join([f"{pad}{t} " for t in texts])
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(texts)), [len(t) + ORDER for t in texts])
    c = letters()[code]
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != SPACE) | (c[:-1] != SPACE)
    c, text = c[keep].astype(np.uint64), text[keep]
    n_letters = np.bincount(text[(c != SPACE) & (c != PAD)], minlength=len(texts))
    g = c.copy()
    for back in range(1, ORDER):
        g[back:] |= c[:-back] << np.uint64(BITS * back)
    good = np.zeros(len(g), bool)
    good[ORDER - 1:] = (text[ORDER - 1:] == text[:len(text) - ORDER + 1]) & (c[ORDER - 1:] != PAD)
    return g[good], text[good], n_letters


def counts(df: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all rows of ``lang, text``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(back, weights=np.concatenate([n for _, n in parts])).astype(np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, n = merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            for part, texts in text_slices(batch, 1, PIECE_CHARS):
                langs = part.column(0).to_pylist()
                g, text, _ = grams(texts)
                own = np.array(langs, object)
                for lang in set(langs):
                    chosen = g[(own == lang)[text]]
                    if len(chosen):
                        k, n = np.unique(chosen, return_counts=True)
                        held.setdefault(lang, []).append((k, n))
                        size += len(k)
                if size > 1_000_000:
                    for lang in held:
                        held[lang] = [merged(held[lang])]
                    size = sum(len(x[0][0]) for x in held.values())
                    if size > 500_000:
                        yield from flush()
                        size = 0
        yield from flush()

    return df.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class HashArray:
    """Sorted hashes with an index by their leading bits; finds the places of many keys at once."""

    def __init__(self, keys: np.ndarray):
        h = mix(keys)
        self.order = np.argsort(h)
        self.hashes = np.append(h[self.order], np.uint64(0xFFFFFFFFFFFFFFFF))
        bits = max(1, int(len(keys) * 2).bit_length())
        self.shift = np.uint64(64 - bits)
        self.starts = np.searchsorted(self.hashes[:-1], np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key in hash order, or -1."""
        h = mix(keys)
        at = self.starts[(h >> self.shift).astype(np.int64)]
        value = self.hashes[at]
        todo = np.flatnonzero(value < h)
        while len(todo):
            at[todo] += 1
            todo = todo[self.hashes[at[todo]] < h[todo]]
        hit = (self.hashes[at] == h) & (at < len(self.hashes) - 1)
        return np.where(hit, at, -1)


@dataclass
class Models:
    """For every order from 1: n-grams with log probabilities, and contexts with log weights of the order below."""

    langs: list[str]
    grams: list[HashArray]
    logp: list[np.ndarray]
    contexts: list[HashArray]
    logw: list[np.ndarray]
    base: np.ndarray
    slope: float = 4.0
    shift: float = 0.0
    worst: np.ndarray | None = None
    #: Beyond MOST_GRAMS: for every order from 1 the counts and contexts of all n-grams; the arrays hold the highest order alone.
    tables: list[tuple[DataFrame, DataFrame]] | None = None

    def log_probability(self, g: np.ndarray, order: int = ORDER) -> np.ndarray:
        """(n-grams, languages); lower orders only for n-grams that no language has seen."""
        if order == 0:
            return np.broadcast_to(self.base, (len(g), len(self.langs)))
        mask = np.uint64((1 << (BITS * order)) - 1 & 0xFFFFFFFFFFFFFFFF)
        at = self.grams[order - 1].find(g & mask)
        out = self.logp[order - 1][at]
        new = np.flatnonzero(at < 0)
        if len(new):
            rest = g[new]
            context = self.contexts[order - 1].find((rest & mask) >> np.uint64(BITS))
            weight = np.where((context >= 0)[:, None], self.logw[order - 1][context], 0)
            out[new] = weight + self.log_probability(rest, order - 1)
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy of each text in each language, and the letters of each text."""
        g, text, n_letters = grams(texts)
        total = np.zeros((len(texts), len(self.langs)))
        if len(g):
            lp = self.log_probability(g)
            first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            total[text[first]] = np.add.reduceat(lp, first, axis=0, dtype=np.float64)
        n = np.bincount(text, minlength=len(texts))
        return -total / np.maximum(n, 1)[:, None], n_letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        return self.decide(*self.entropies(texts))

    def decide(self, h: np.ndarray, n: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection from cross-entropies and letters."""
        best = h.argmin(axis=1)
        least = h[np.arange(len(h)), best]
        s = 1 / (1 + np.exp(-np.clip(self.slope * _margin(h) + self.shift, -60, 60)))
        worst = self.worst[best] if self.worst is not None else np.inf
        rejected = (n == 0) | (least > worst) & (n >= LEAST_LETTERS) | (s < ACCEPT)
        return [self.langs[i] if k else "und" for i, k in zip(best, n, strict=True)], np.where(n > 0, s, 0), rejected


def _margin(h: np.ndarray) -> np.ndarray:
    if h.shape[1] < 2:
        return np.full(len(h), 1.0)
    two = np.partition(h, 1, axis=1)[:, :2]
    return two[:, 1] - two[:, 0]


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k, back = np.unique(keys, return_inverse=True)
    return k, np.bincount(back, weights=values, minlength=len(k))


def compile_models(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Models:
    """Interpolated Kneser-Ney from counts of the highest order."""
    one = np.uint64(BITS)
    alphabet = max(len(np.unique(gram & np.uint64(0xFFFF))), 1) + 1
    own: list[list[dict]] = []
    for i in range(len(langs)):
        keys, value = gram[lang == i], n[lang == i].astype(float)
        tables: list[dict] = []
        for order in range(ORDER, 0, -1):
            keys, value = _sums(keys, value)
            ctx, total = _sums(keys >> one, value)
            kinds = _sums(keys >> one, np.ones(len(keys)))[1]
            tables.append({"keys": keys, "value": value, "ctx": ctx, "total": total, "kinds": kinds})
            # continuation counts of the order below: distinct characters before each of its n-grams
            keys = keys & np.uint64((1 << (BITS * (order - 1))) - 1)
            value = np.ones(len(keys))
        own.append(tables[::-1])
    base = np.full(len(langs), -np.log(alphabet))
    found = Models(langs, [], [], [], [], base)
    for order in range(1, ORDER + 1):
        t = [own[i][order - 1] for i in range(len(langs))]
        keys = np.unique(np.concatenate([x["keys"] for x in t]))
        ctx = np.unique(np.concatenate([x["ctx"] for x in t]))
        lower = np.exp(found.log_probability(keys, order - 1)) if order > 1 else np.exp(np.broadcast_to(base, (len(keys), len(langs))))
        logw = np.zeros((len(ctx), len(langs)))
        p = np.empty((len(keys), len(langs)))
        for i, x in enumerate(t):
            weight = np.ones(len(ctx))
            total = np.ones(len(ctx))
            at = np.searchsorted(ctx, x["ctx"])
            total[at] = x["total"]
            weight[at] = DISCOUNT * x["kinds"] / x["total"]
            logw[:, i] = np.log(weight)
            value = np.zeros(len(keys))
            value[np.searchsorted(keys, x["keys"])] = x["value"]
            of = np.searchsorted(ctx, keys >> one)
            p[:, i] = np.maximum(value - DISCOUNT, 0) / total[of] + weight[of] * lower[:, i]
        g, c = HashArray(keys), HashArray(ctx)
        found.grams.append(g)
        found.logp.append(np.log(p)[g.order].astype(np.float32))
        found.contexts.append(c)
        found.logw.append(logw[c.order].astype(np.float32))
    return found


def fit(docs: DataFrame) -> Models:
    """Models of every non-null ``lang`` of the rows that may be learnt from."""
    training = docs.select("doc_id", "lang", "text").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    table = stored(counts(training), "language-counts")
    size, highest = table.agg(F.count("*"), F.max("n")).first()
    if size > MOST_GRAMS:
        models = _spread(table, highest)
    else:
        rows = table.toPandas()
        langs = sorted(rows["lang"].unique())
        models = compile_models(langs, np.searchsorted(np.array(langs, object), rows["lang"].to_numpy(object)),
                                rows["gram"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)) if langs \
            else Models([], [], [], [], [], np.empty(0))
    if models.langs:
        _calibrate(models, training)
    return models


def _spread(table: DataFrame, highest: int) -> Models:
    """Models whose counts stay tables; the arrays hold the exact log probabilities of the most frequent n-grams."""
    langs = sorted(r[0] for r in table.select("lang").distinct().collect())
    number = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int") - 1
    own = stored(table.select(number.alias("lang"), "gram", F.col("n").alias("value")), "language-order")
    alphabet = own.select(F.col("gram").bitwiseAND(0xFFFF)).distinct().count() + 1
    tables = []
    for order in range(ORDER, 0, -1):
        context = own.groupBy("lang", F.shiftrightunsigned("gram", BITS).alias("ctx")).agg(
            F.sum("value").alias("total"), F.count("*").alias("kinds"))
        tables.append((own, stored(context, "language-contexts")))
        if order > 1:  # continuation counts
            own = stored(own.groupBy("lang", F.col("gram").bitwiseAND((1 << (BITS * (order - 1))) - 1).alias("gram")).agg(
                F.count("*").alias("value")), "language-order")
    found = Models(langs, [], [], [], [], np.full(len(langs), -np.log(alphabet)), tables=tables[::-1])
    least = 2
    while least <= highest:
        frequent = table.where(F.col("n") >= least).select("gram").distinct()
        if frequent.count() * len(langs) <= MOST_GRAMS:
            break
        least *= 2
    rows = _log_probabilities(table.where(F.col("n") >= least).select("gram").distinct(), found).toPandas().sort_values(["gram", "lang"])
    keys = HashArray(rows["gram"].to_numpy(np.int64)[::len(langs)].view(np.uint64))
    found.grams.append(keys)
    found.logp.append(rows["logp"].to_numpy(np.float32).reshape(-1, len(langs))[keys.order])
    return found


def _log_probabilities(wanted: DataFrame, models: Models) -> DataFrame:
    """``gram, lang, logp`` of distinct n-grams in every language, by number, from the tables."""
    rows = wanted.select("gram", F.explode(F.sequence(F.lit(0), F.lit(len(models.langs) - 1))).alias("lang"),
                         F.lit(float(np.exp(models.base[0]))).alias("p"))
    for order, (own, context) in enumerate(models.tables, 1):
        part = F.col("gram") if order == ORDER else F.col("gram").bitwiseAND((1 << (BITS * order)) - 1)
        rows = rows.withColumn("_g", part).withColumn("ctx", F.shiftrightunsigned("_g", BITS))
        rows = rows.join(own.withColumnRenamed("gram", "_g"), ["lang", "_g"], "left").join(context, ["lang", "ctx"], "left")
        p = F.greatest(F.coalesce("value", F.lit(0)) - F.lit(DISCOUNT), F.lit(0e0)) + DISCOUNT * F.col("kinds") * F.col("p")
        rows = rows.select("gram", "lang", F.when(F.col("total").isNull(), F.col("p")).otherwise(p / F.col("total")).alias("p"))
    return rows.select("gram", "lang", F.log("p").cast("float").alias("logp"))


def _entropies(df: DataFrame, models: Models) -> DataFrame:
    """``uid, h, letters`` of every row ``uid, text``: cross-entropies of models with tables; ``uid`` is unique."""
    shared = df.sparkSession.sparkContext.broadcast(replace(models, tables=None))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part, texts in text_slices(batch, 1, PIECE_CHARS):
                uid = np.asarray(part.column(0))
                g, text, letters = grams(texts)
                at = m.grams[-1].find(g)
                known = at >= 0
                total = np.stack([np.bincount(text[known], weights=own[at[known]], minlength=len(texts)) for own in m.logp[-1].T], axis=1)
                n = np.bincount(text, minlength=len(texts))
                pairs, many = np.unique(np.stack([text[~known].astype(np.uint64), g[~known]], axis=1), axis=0, return_counts=True)
                none, some = len(pairs), len(texts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.r_[uid, uid[pairs[:, 0].astype(np.int64)]]),
                    pa.array(np.r_[np.zeros(some, np.int64), pairs[:, 1].view(np.int64)], mask=np.arange(some + none) < some),
                    pa.array(np.r_[n, many].astype(np.int64)),
                    pa.array(np.r_[letters, np.zeros(none)].astype(np.int64)),
                    pa.array([*total.tolist(), *[None] * none], pa.list_(pa.float64()))], ["uid", "gram", "n", "letters", "total"])

    found = stored(df.select("uid", "text").mapInArrow(run, "uid long, gram long, n long, letters long, total array<double>"), "language-sums")
    rest = found.where("gram is not null").select("uid", "gram", "n")
    sums = rest.join(_log_probabilities(rest.select("gram").distinct(), models), "gram").groupBy("uid", "lang").agg(
        F.sum(F.col("n") * F.col("logp").cast("double")).alias("s")).groupBy("uid").agg(
            F.array_sort(F.collect_list(F.struct("lang", "s"))).alias("rest"))  # an entry for each language
    h = F.transform("total", lambda x, i: -(x + F.coalesce(F.col("rest")[i]["s"], F.lit(0e0))) / F.greatest(F.col("n"), F.lit(1)))
    return found.where("gram is null").drop("gram").join(sums, "uid", "left").select("uid", h.alias("h"), "letters")


def _calibrate(models: Models, training: DataFrame) -> None:
    """Slope and shift of P(right | margin), and each language's largest plausible cross-entropy."""
    total = max(training.count(), 1)
    share = min(1.0, CALIBRATION_ROWS / total)
    picked = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30))
    shared = training.sparkSession.sparkContext.broadcast(replace(models, tables=None))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part, texts in text_slices(batch, 1, PIECE_CHARS):
                h, n = m.entropies(texts)
                best = h.argmin(axis=1)
                right = np.array([m.langs[i] == x for i, x in zip(best, part.column(0).to_pylist(), strict=True)])
                use = n > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best[use], pa.int32()), pa.array(h.min(axis=1)[use]), pa.array(_margin(h)[use]), pa.array(right[use])],
                    ["best", "least", "margin", "right"])

    if models.tables:
        chosen = stored(training.where(picked).select(F.monotonically_increasing_id().alias("uid"), "lang", "text"), "language-calibration")
        known = chosen.select("uid", "lang").join(_entropies(chosen, models).where("letters > 0"), "uid").toPandas()
        h = np.array(known["h"].tolist()).reshape(len(known), len(models.langs))
        rows = pd.DataFrame({"best": h.argmin(axis=1), "least": h.min(axis=1), "margin": _margin(h),
                             "right": np.array(models.langs, object)[h.argmin(axis=1)] == known["lang"].to_numpy(object)})
    else:
        rows = training.where(picked).select("lang", "text").mapInArrow(run, "best int, least double, margin double, right boolean").toPandas()
    shared.destroy()
    if rows.empty:
        return
    x, y = rows["margin"].to_numpy(), rows["right"].to_numpy(float)
    # errors at no margin, and a right text at the typical margin, keep the fit finite where every text is recognised
    x, y = np.append(x, [0.0, 0.0, np.median(x)]), np.append(y, [0.0, 0.0, 1.0])
    a = np.array([4.0, 0.0])
    z = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ a, -60, 60)))
        grad = z.T @ (p - y) + 0.01 * np.array([a[0], a[1]])
        hess = (z * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ z + 0.01 * np.eye(2)
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a = a - step
        if np.abs(step).max() < 1e-8:
            break
    models.slope, models.shift = float(a[0]), float(a[1])
    worst = np.full(len(models.langs), np.inf)
    good = rows[rows["right"]]
    for i in range(len(models.langs)):
        own = good.loc[good["best"] == i, "least"].to_numpy()
        if len(own) >= 20:
            worst[i] = max(np.quantile(own, 1 - TAIL), own.mean() + DEVIATIONS * own.std())
    models.worst = worst


def _decided(docs: DataFrame, models: Models) -> DataFrame:
    """``uid, lang_pred, score, rejected`` of every row ``uid, text`` by models with tables."""
    shared = docs.sparkSession.sparkContext.broadcast(replace(models, tables=None))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, len(shared.value.langs))
            lang, score, rejected = shared.value.decide(h, np.asarray(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                                             ["uid", "lang_pred", "score", "rejected"])

    return _entropies(docs, models).mapInArrow(run, "uid long, lang_pred string, score double, rejected boolean")


def predictions(docs: DataFrame, models: Models) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` for every whole text."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    columns = ("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
    if models.tables:
        marked = stored(docs.withColumn("uid", F.monotonically_increasing_id()), "language-documents")
        return marked.select("uid", "doc_id").join(_decided(marked, models), "uid").select(*columns)
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, 1, PIECE_CHARS):
                lang, score, rejected = shared.value.predict(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                                                 ["doc_id", "lang_pred", "score", "rejected"])

    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean").select(*columns)


def keep_known(docs: DataFrame, models: Models) -> DataFrame:
    """The documents that are not rejected, with the language found in ``lang`` and all their other columns."""
    if "lang" not in docs.columns:
        docs = docs.withColumn("lang", F.lit(None).cast("string"))
    if models.tables:
        uid, found = fresh(docs, "_uid"), fresh(docs, "_lang")
        marked = stored(docs.withColumn(uid, F.monotonically_increasing_id()), "language-documents")
        known = _decided(marked.select(F.col(uid).alias("uid"), "text"), models).where("not rejected").select(
            F.col("uid").alias(uid), F.col("lang_pred").alias(found))
        return marked.join(known, uid).select(*(F.col(found).alias(c) if c == "lang" else c for c in docs.columns))
    at, own, shared = docs.columns.index("text"), docs.columns.index("lang"), docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, at, PIECE_CHARS):
                lang, _, rejected = shared.value.predict(texts)
                field = part.schema.field(own)
                yield part.set_column(own, field, pa.array(lang, field.type)).filter(pa.array(~rejected))

    return docs.mapInArrow(run, docs.schema)


def op6_language(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predictions(docs, fit(docs))
