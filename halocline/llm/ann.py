"""Approximate nearest neighbours over learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts; a small classifier
learns the parts and sends every row to its most probable part.  A query goes to
several most probable parts, as many as an audit on the sample needs to find RECALL of
the true neighbours, and the rows there are ranked by exact cosine.

Equal vectors are one candidate with its smallest ids, so a frequent vector is no hot
part.  Parts and queries are dealt to cells of bounded size.  Few rows are one part,
which is an exact search.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and null ids, take no part; vectors of different length are not compared; lengths
other than that of most rows are one part each; a repeated id is one candidate with
its best score; ties go to the smaller id.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from halocline.llm.shared import read, stored
from halocline.llm.vectors import cosine_pairs, matrix, unit, usable

#: Rows that the graph and the classifier are fitted on, at most.
SAMPLE = 8192
PART_ROWS, MOST_PARTS = 2048, 256
NEIGHBOURS, HIDDEN, EPOCHS = 10, 96, 30
RECALL = 0.96
#: Rows of queries, and of candidates, in a cell.
CELL_QUERIES, CELL_ROWS = 20_000, 100_000
BATCH = 256


def neighbour_graph(u: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The k nearest of each row of the sample, in blocks."""
    out = np.empty((len(u), min(k, len(u) - 1)), np.int64)
    for at in range(0, len(u), 512):
        s = u[at:at + 512] @ u.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 512] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
    return out


def balanced_parts(u: np.ndarray, near: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Parts of about equal size that cut few edges: halved along main directions, then improved by moves with room."""
    part = np.zeros(len(u), np.int64)
    todo = [(np.arange(len(u)), 0, parts)]
    while todo:
        rows, first, n = todo.pop()
        if n == 1:
            part[rows] = first
            continue
        own = u[rows] - u[rows].mean(axis=0)
        direction = np.linalg.eigh(own.T @ own)[1][:, -1]
        order = rows[np.argsort(own @ direction, kind="stable")]
        at = len(rows) * (n // 2) // n
        todo += [(order[:at], first, n // 2), (order[at:], first + n // 2, n - n // 2)]
    room = int(np.ceil(len(u) / parts * 1.05))
    size = np.bincount(part, minlength=parts)
    back = [[] for _ in range(len(u))]
    for i, row in enumerate(near.tolist()):
        for j in row:
            back[j].append(i)
    every = [np.array(a + b) for a, b in zip(near.tolist(), back, strict=True)]
    for _ in range(rounds):
        votes = np.zeros((len(u), parts), np.int32)
        for i, row in enumerate(every):
            votes[i] = np.bincount(part[row], minlength=parts)
        here = votes[np.arange(len(u)), part]
        gain = votes.max(axis=1) - here
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            to = int(votes[i].argmax())
            if size[to] < room and size[part[i]] > 1:
                size[part[i]] -= 1
                size[to] += 1
                part[i] = to
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A classifier with one hidden layer, and how many parts a query goes to."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def order(self, u: np.ndarray, n: int) -> np.ndarray:
        """The n most probable parts of each row, most probable first."""
        z = np.maximum(u @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        return np.argsort(-z, axis=1, kind="stable")[:, :n]


def trained(u: np.ndarray, near: np.ndarray, part: np.ndarray, parts: int, seed: int = 0) -> Router:
    """Learns each row's share of parts among itself and its neighbours."""
    rng = np.random.default_rng(seed)
    d = u.shape[1]
    target = np.zeros((len(u), parts), np.float32)
    for column in (np.arange(len(u))[:, None], near):
        np.add.at(target, (np.repeat(np.arange(len(u)), column.shape[1]), part[column].ravel()), 1)
    target /= target.sum(axis=1, keepdims=True)
    weights = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)).astype(np.float32) * np.sqrt(d / 4), np.zeros(HIDDEN, np.float32),
               rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)).astype(np.float32), np.zeros(parts, np.float32)]
    m, v, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    x = u.astype(np.float32)
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at:at + BATCH]
            h = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            z = h @ weights[2] + weights[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            dz = (p - target[rows]) / len(rows)
            dh = (dz @ weights[2].T) * (h > 0)
            step += 1
            for i, g in enumerate((x[rows].T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                weights[i] -= 0.003 * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return Router(*weights)


def fit(sample: np.ndarray, parts: int, k: int) -> Router:
    """Fits the parts and the router, and finds how many parts an audited query needs.

    A part of the sample is kept from the fit and audited: its true neighbours in the fitted rows
    must lie in the probed parts for RECALL of them.
    """
    u = unit(sample).astype(np.float32)
    kept = max(1, len(u) // 8)
    audit, rows = u[:kept], u[kept:]
    near = neighbour_graph(rows)
    router = trained(rows, near, balanced_parts(rows, near, parts), parts)
    home = router.order(rows, 1)[:, 0]
    true = np.concatenate([np.argpartition(-(audit[at:at + 512] @ rows.T), k - 1, axis=1)[:, :k] for at in range(0, kept, 512)])
    asked = router.order(audit, parts)
    place = np.argmax(asked[:, None, :] == home[true][:, :, None], axis=2)  # rank of each neighbour's part
    share = np.cumsum(np.bincount(place.ravel(), minlength=parts)) / place.size
    router.probes = int(np.searchsorted(share, RECALL)) + 1 if share[-1] >= RECALL else parts
    return router


def _routed(router, names: list[str], at: int, probes: int | None):
    """Adds the parts of each row: its own, or those a query goes to."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = router.value
        for batch in batches:
            if batch.num_rows:
                parts = r.order(unit(matrix(batch.column(at))).astype(np.float32), probes or 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(parts.astype(np.int32)), pa.list_(pa.int32()))], [*names, "parts"])

    return run


#: Bound on the difference between a product of unit vectors and the exact measure.
ROUNDING = 1e-9
#: Pairs measured at once.
PAIRS = 65_536


def _ranked(k: int):
    """Rows sorted by cell, queries first: each query's nearest candidates of the cell."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = None
        held: list[pa.RecordBatch] = []
        state: dict = {}

        def begin() -> None:
            table = pa.Table.from_batches(held)
            held.clear()
            v = matrix(table.column("v").combine_chunks())
            state.update(v=v, u=unit(v), id=np.asarray(table.column("id")), rest=[])

        def add(part: pa.RecordBatch) -> None:
            for low in range(0, part.num_rows, 4096):
                block = part.slice(low, 4096)
                v, ids = matrix(block.column(4)), np.asarray(block.column(2))
                u = unit(v)
                for at in range(0, len(state["id"]), 512):
                    s = state["u"][at:at + 512] @ u.T
                    last = s.shape[1] - min(k + 1, s.shape[1])
                    # all that may tie with the last one kept: its product less what rounding can make of it
                    q, c = np.nonzero(s >= np.partition(s, last, axis=1)[:, last:last + 1] - ROUNDING)
                    for low_pair in range(0, len(q), PAIRS):
                        qs, cs = q[low_pair:low_pair + PAIRS] + at, c[low_pair:low_pair + PAIRS]
                        # the sum in double precision over the original vectors decides, not the product above
                        state["rest"].append((qs, ids[cs], cosine_pairs(state["v"][qs], v[cs])))
                        if len(q) > PAIRS:
                            shrink()
                shrink()

        def shrink() -> None:
            q, vec, score = (np.concatenate([r[i] for r in state["rest"]]) for i in range(3))
            order = np.lexsort((vec, -score, q))
            q, vec, score = q[order], vec[order], score[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            keep = place < k + 1
            state["rest"] = [(q[keep], vec[keep], score[keep])]

        def result() -> pa.RecordBatch:
            if not state or not state["rest"]:
                e = pa.array([], pa.int64())
                return pa.RecordBatch.from_arrays([e, e, pa.array([], pa.float64())], ["query_id", "rep", "score"])
            q, vec, score = state["rest"][0]
            return pa.RecordBatch.from_arrays([pa.array(state["id"][q]), pa.array(vec), pa.array(score)], ["query_id", "rep", "score"])

        for batch in batches:
            c, kind = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            cut = np.flatnonzero((c[1:] != c[:-1]) | (kind[1:] != kind[:-1])) + 1
            for b, e in zip(np.r_[0, cut], np.r_[cut, len(c)], strict=True):
                if b == e:
                    continue
                if c[b] != cell:
                    if state:
                        yield result()
                    state.clear()
                    held.clear()
                    cell = c[b]
                if kind[b] == 0:
                    held.append(batch.slice(b, e - b))
                else:
                    if held:
                        begin()
                    if state:
                        add(batch.slice(b, e - b))
        if state:
            yield result()

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 5, sample: int = SAMPLE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest other rows found for each row where ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("v"),
                          is_query.alias("asks")).where(usable(F.col("v")) & F.col("vec_id").isNotNull())
    # equal vectors once, with the ids that any query can need; ranks are cut before the shuffle
    first = Window.partitionBy("vector").orderBy("vec_id")
    rows = stored(rows.withColumn("vector", F.sha2(F.to_json("v"), 256)).withColumn("dim", F.size("v")), "ann-rows")
    few = rows.select("vec_id", "vector").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    ids = few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    reps = stored(rows.groupBy("vector", "dim").agg(F.min("vec_id").alias("id"), F.first("v").alias("v")).join(ids, "vector"), "ann-reps")
    main = reps.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if main is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = main
    parts = max(1, min(MOST_PARTS, n // PART_ROWS))
    share = min(1.0, sample / n)
    chosen = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30))
    queries = rows.where("asks").select("vec_id", "v", "dim").dropDuplicates(["vec_id", "v"])
    own = reps.select("id", "v", "dim")
    probes = 1
    if parts > 1:
        got = reps.where((F.col("dim") == dim) & chosen).select("id", "v").orderBy("id").toArrow()
        v = matrix(got.column("v").combine_chunks())
        order = np.random.default_rng(0).permutation(len(v))
        router = fit(v[order], parts, min(k, max(1, len(v) // 2)))
        probes = router.probes
        shared = spark.sparkContext.broadcast(router)
        one = F.array(F.col("dim") * 0)
        own = own.where(F.col("dim") == dim).mapInArrow(_routed(shared, own.columns, 1, 1), "id long, v array<double>, dim int, parts array<int>") \
            .union(own.where(F.col("dim") != dim).withColumn("parts", one))
        queries = queries.where(F.col("dim") == dim).mapInArrow(
            _routed(shared, queries.columns, 1, probes), "vec_id long, v array<double>, dim int, parts array<int>").union(
                queries.where(F.col("dim") != dim).withColumn("parts", one))
    else:
        own, queries = (x.withColumn("parts", F.array(F.lit(0))) for x in (own, queries))
    own = stored(own.withColumn("part", F.col("parts")[0]).drop("parts"), "ann-index")
    queries = stored(queries.withColumn("part", F.explode("parts")).drop("parts"), "ann-queries")
    cells = own.groupBy("dim", "part").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("salts")).join(
        queries.groupBy("dim", "part").agg(F.ceil(F.count("*") / CELL_QUERIES).cast("int").alias("chunks")), ["dim", "part"])
    number = lambda id, n: F.pmod(F.xxhash64(id), F.col(n)).cast("int")
    a = own.join(cells, ["dim", "part"]).select("dim", "part", number("id", "salts").alias("salt"),
                                                F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("kind"), "id", "v")
    q = queries.join(cells, ["dim", "part"]).select("dim", "part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                                                    number("vec_id", "chunks").alias("chunk"), F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "v")
    both = q.unionByName(a).select(F.xxhash64("dim", "part", "salt", "chunk").alias("cell"), "kind", "id", "dim", "v")
    near = both.repartition("cell").sortWithinPartitions("cell", "kind").mapInArrow(_ranked(k), "query_id long, rep long, score double")
    # every cell gives k + 1 classes of equal vectors, each of at most k + 1 ids; the best k other rows are among them
    best = near.join(reps.select(F.col("id").alias("rep"), "ids"), "rep").select("query_id", "score", F.explode("ids").alias("vec_id")) \
        .where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_nearest(spark, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
