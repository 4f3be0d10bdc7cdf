"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Class means and covariances come from sums over all labelled training rows.  Each
covariance is shrunk towards the pooled one and towards its own mean variance; its
inverse Cholesky factor is kept, so a score is two triangular products.  The difference
of log densities is calibrated by a logistic fit to its histogram over all training rows.

Defined results: null and empty texts have the statistics of an empty text and get a
score like any other; a document that is repeated is scored each time and counts each
time; of several labels of an id the smallest counts, null labels and ids never do;
with fewer than two classes every score is the smoothed share of label 1.  Other
columns are passed through by ``keep_good`` and ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from halocline.llm.shared import columns_of, held_out, read, stored, text_slices

NAMES = ("words", "word_length", "upper", "symbols", "digits", "lone", "distinct", "repeats", "pairs", "entropy",
         "lines", "tails", "commonest")
#: Weight of the pooled covariance, and of the mean variance, in a class covariance.
TO_POOLED, TO_SPHERE = 0.1, 0.01
ACCEPT = 0.3
BINS = 400

_KIND = np.zeros(256, np.int8)  # of a byte: 1 upper, 2 lower or part of a longer character, 3 digit, 4 space, 5 stop, 6 other
_KIND[:] = 6
_KIND[65:91], _KIND[97:123], _KIND[128:], _KIND[48:58] = 1, 2, 2, 3
for _c in b" \t\n\r\x0b\x0c":
    _KIND[_c] = 4
for _c in b".,;:'\"?-":
    _KIND[_c] = 5


def statistics(text: str) -> list[float]:
    """Transformed statistics of one whole text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=7)
    letters, size = kinds[1] + kinds[2], max(len(data), 1)
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:])))
    again = sum(map(eq, words, words[1:]))
    p = counts[counts > 0] / size
    lone = sum(1 for w in words if len(w) == 1 and _KIND[w[0]] == 6)
    tails = sum(1 for w in words if _KIND[w[-1]] == 6)
    m = max(n, 1)
    root = np.sqrt
    return [
        np.log1p(n), np.log((kinds.sum() - kinds[4] + 1) / m), root(kinds[1] / max(letters, 1)), root(kinds[6] / size),
        root(kinds[3] / size), root(lone / m), np.log((distinct + 1) / (m + 1)), root(again / m),
        np.log((pairs + 1) / (m + 1)), float(-(p * np.log(p)).sum()) if len(data) else 0.0,
        np.log1p(counts[10]) - np.log1p(n), root(tails / m), root(counts[33:].max() / size)]


def features(df: DataFrame) -> DataFrame:
    """``doc_id, x`` with the statistics of every whole text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in columns_of(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))], ["doc_id", "x"])

    return df.select(df["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log determinants of classes 0 and 1, and the calibration."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, without priors."""
        parts = []
        for c in (0, 1):
            z = (x - self.means[c]) @ self.factors[c].T
            parts.append(self.offsets[c] - 0.5 * (z * z).sum(axis=1))
        return parts[1] - parts[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * squashed(self.difference(x)) + self.shift, -60, 60)))


def squashed(d: np.ndarray) -> np.ndarray:
    """Differences grow with squares; their signed roots spread evenly."""
    return np.sign(d) * np.sqrt(np.abs(d))


def training_rows(x: DataFrame, labels: DataFrame) -> DataFrame:
    """``x, y`` of the rows that may be learnt from."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("y"))
    return x.where(~held_out(F.col("doc_id"))).join(known, "doc_id").select("x", "y")


def fit(x: DataFrame, labels: DataFrame) -> Discriminant:
    """Fitted by two passes of sums over all training rows; the driver gets a row for each class and bin."""
    rows = stored(training_rows(x, labels), "quality-rows")
    k = len(NAMES)
    sums = rows.groupBy("y").agg(
        F.count("*").alias("n"), *(F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(k)),
        *(F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"s{i}_{j}") for i in range(k) for j in range(i, k))).collect()
    by = {r["y"]: r for r in sums}
    if len(by) < 2:
        ones, total = (by[1]["n"] if 1 in by else 0), sum(r["n"] for r in sums)
        empty = np.zeros((2, k))
        return Discriminant(empty, np.zeros((2, k, k)), np.zeros(2), constant=(ones + 1) / (total + 2))
    means, scatter, n = np.zeros((2, k)), np.zeros((2, k, k)), np.zeros(2)
    for c in (0, 1):
        n[c] = by[c]["n"]
        means[c] = [by[c][f"s{i}"] / n[c] for i in range(k)]
        for i in range(k):
            for j in range(i, k):
                scatter[c, i, j] = scatter[c, j, i] = by[c][f"s{i}_{j}"] - n[c] * means[c, i] * means[c, j]
    pooled = scatter.sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    factors, offsets = np.zeros((2, k, k)), np.zeros(2)
    for c in (0, 1):
        own = scatter[c] / max(n[c] - 1, 1)
        s = ((1 - TO_POOLED) * own + TO_POOLED * pooled) / np.outer(scale, scale)
        s = (1 - TO_SPHERE) * s + TO_SPHERE * np.eye(k) * max(np.trace(s) / k, 1e-3)
        factors[c] = np.linalg.inv(np.linalg.cholesky(s)) / scale
        offsets[c] = -0.5 * np.linalg.slogdet(s)[1]
    model = Discriminant(means, factors, offsets)
    slope, shift = _calibrated(rows, model)
    return Discriminant(means, factors, offsets, slope, shift)


def _calibrated(rows: DataFrame, model: Discriminant) -> tuple[float, float]:
    """Slope and shift of the logistic fit to (squashed difference, label), from a histogram of all training rows."""
    reach = 40.0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = squashed(model.difference(_matrix(batch.column(0))))
                b = np.clip(((d + reach) * (BINS / (2 * reach))).astype(int), 0, BINS - 1)
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), batch.column(1).cast(pa.int32())], ["b", "y"])

    found = rows.mapInArrow(run, "b int, y int").groupBy("b", "y").count().collect()
    d = np.array([(r["b"] + 0.5) * (2 * reach / BINS) - reach for r in found])
    y, w = np.array([float(r["y"]) for r in found]), np.array([float(r["count"]) for r in found])
    a = np.array([1.0, 0.0])
    z = np.stack([d, np.ones_like(d)], axis=1)
    for _ in range(50):  # Newton with a little ridge on the slope, which bounds it where classes part
        p = 1 / (1 + np.exp(-np.clip(z @ a, -60, 60)))
        grad = z.T @ (w * (p - y)) + np.array([0.5 * (a[0] - 1), 0.0])
        hess = (z * (w * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ z + np.diag([0.5, 1e-6])
        step = np.linalg.solve(hess, grad)
        a = a - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a[0], 1e-3)), float(a[1])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(NAMES))


def scored(x: DataFrame, model: Discriminant) -> DataFrame:
    """``doc_id, held_out, score, predicted``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(_matrix(batch.column(1))) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= ACCEPT).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    return x.mapInArrow(run, "doc_id long, score double, predicted int").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, model: Discriminant, accept: float = ACCEPT) -> DataFrame:
    """The documents that the model accepts, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, at):
                yield part.filter(pa.array(model.score(np.array([statistics(t) for t in texts])) >= accept))

    return docs.mapInArrow(run, docs.schema)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    x = stored(features(read(spark, sf_dir, "documents")), "quality-features")
    return scored(x, fit(x, read(spark, sf_dir, "labels")))


