"""Embedding near-duplicates: a small-world graph for each shard, every shard queried, cosine verified, components.

Equal vectors of a label are one row with a count.  A label's vectors are dealt to
shards of about SHARD rows; each shard builds its graph, and every vector of the label
queries every shard.  A query whose whole beam is linked widens its beam until it is
not, and a shard's queries begin with a wider beam until an audit, which compares a
sample of them with all vectors of the shard, finds every link; a beam that would touch
most of the shard is an exact scan.  Links are verified in double precision on the original
vectors.  A task returns a count for each query and the links that join something
new, so rows do not grow with the pairs of a group.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing; vectors of different length
are not compared; a null id is kept as a row that links with nothing; repeated ids are
rows of one node, which is no link to itself.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from halocline.llm.components import connected
from halocline.llm.hnsw import M_BASE, Hnsw
from halocline.llm.shared import read, stored
from halocline.llm.vectors import cosine_pairs, matrix, unit, usable

COSINE = 0.98
SHARD = 8192
EF, BLOCK = 32, 256
#: Of a shard's queries, those audited: at least this many, and one in so many.
AUDIT_LEAST, AUDIT_EVERY = 32, 64
#: Single precision may err by less than this.
SLACK = 1e-5

FOUND = "kind int, a long, b long"


def _scan(x: np.ndarray, q: np.ndarray, least: float) -> list[np.ndarray]:
    """All vectors at ``least`` or nearer of each query."""
    return [np.flatnonzero(row >= least) for row in q @ x.T]


def near_lists(graph: Hnsw, q: np.ndarray, ef: int, least: float) -> list[np.ndarray]:
    """Vectors at ``least`` or nearer of each query; beams widen while they are full of such vectors.

    A beam as wide as half the shard, or a widened one that would touch about as many vectors as
    the shard has, is an exact scan.
    """
    n, found, first = len(graph.x), [np.empty(0, np.int64)] * len(q), ef
    todo = np.arange(len(q))
    while len(todo):
        wide = []
        step = max(8, min(BLOCK, (1 << 22) // max(n, 1)))
        for at in range(0, len(todo), step):
            own = todo[at:at + step]
            if 2 * ef >= n or ef > first and 2 * M_BASE * ef >= n:
                for i, hit in zip(own, _scan(graph.x, q[own], least), strict=True):
                    found[i] = hit
                continue
            ids, sims = graph.search(q[own], ef)
            hit = (sims >= least) & (ids >= 0)
            for i, row, h in zip(own, ids, hit, strict=True):
                found[i] = row[h]
            if ids.shape[1] == ef:
                wide.append(own[hit.all(axis=1)])
        todo = np.concatenate(wide) if wide else np.empty(0, np.int64)
        ef *= 4
    return found


def audited_lists(graph: Hnsw, q: np.ndarray, least: float, ef: int = EF) -> list[np.ndarray]:
    """``near_lists`` with the least beam for which the audited queries miss nothing."""
    every = min(AUDIT_EVERY, max(1, len(q) // AUDIT_LEAST))
    sample = np.arange(0, len(q), every)
    exact = [h for at in range(0, len(sample), BLOCK) for h in _scan(graph.x, q[sample[at:at + BLOCK]], least)]
    while True:
        found = near_lists(graph, q[sample], ef, least)
        if 2 * ef >= len(graph.x) or all(len(np.setdiff1d(e, f)) == 0 for e, f in zip(exact, found, strict=True)):
            return near_lists(graph, q, ef, least)
        ef *= 2


def _linked(cosine: float):
    """Rows sorted by shard, its own vectors first: (shard, other, rep, copies, vector)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        own: list[pa.RecordBatch] = []
        state: dict = {}

        def build() -> None:
            table = pa.Table.from_batches(own)
            v = matrix(table.column("v").combine_chunks())
            u = unit(v)
            state.update(v=v, graph=Hnsw(u), rep=np.asarray(table.column("rep")), copies=np.asarray(table.column("copies")))
            state["u"] = state["graph"].x
            own.clear()

        def links(rep: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
            u = unit(v).astype(np.float32)
            hits = audited_lists(state["graph"], u, cosine - SLACK)
            left = np.repeat(np.arange(len(rep)), [len(h) for h in hits])
            right = np.concatenate(hits) if hits else np.empty(0, np.int64)
            keep = state["rep"][right] != rep[left]
            left, right = left[keep], right[keep]
            good = np.ones(len(left), bool)
            for at in range(0, len(left), 100_000):
                s = slice(at, at + 100_000)
                good[s] = cosine_pairs(v[left[s]], state["v"][right[s]]) >= cosine
            left, right = left[good], right[good]
            count = np.bincount(left, weights=state["copies"][right], minlength=len(rep)).astype(np.int64)
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while (p := parent.setdefault(x, x)) != x:
                    parent[x] = x = parent.setdefault(p, p)
                return x

            for a, b in zip(rep[left].tolist(), state["rep"][right].tolist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            joined = np.array([(x, root(x)) for x in parent if root(x) != x], np.int64).reshape(-1, 2)
            some = count > 0
            return pa.RecordBatch.from_arrays(
                [pa.array(np.r_[np.zeros(some.sum(), np.int32), np.ones(len(joined), np.int32)]),
                 pa.array(np.r_[rep[some], joined[:, 0]]), pa.array(np.r_[count[some], joined[:, 1]])], ["kind", "a", "b"])

        for batch in batches:
            shard, other = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            cut = np.flatnonzero((shard[1:] != shard[:-1]) | (other[1:] != other[:-1])) + 1
            for b, e in zip(np.r_[0, cut], np.r_[cut, len(shard)], strict=True):
                if b == e:
                    continue
                part = batch.slice(b, e - b)
                if other[b] == 0:
                    if own and shard[b] != key:
                        own.clear()
                    key = shard[b]
                    own.append(part)
                else:
                    if own:
                        build()
                    yield links(np.asarray(part.column(2)), matrix(part.column(4)))

    return run


def components(df: DataFrame, cosine: float = COSINE, shard: int = SHARD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row."""
    rows = stored(df.select(df["vec_id"].cast("long").alias("vec_id"), df["label"], df["embedding"].cast("array<double>").alias("v"))
                  .withColumn("ok", usable(F.col("v")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()), "vectors")
    good = rows.where("ok").select("vec_id", "label", "v", F.sha2(F.to_json("v"), 256).alias("vector"))
    reps = stored(good.groupBy("label", "vector").agg(
        F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies"), F.first("v").alias("v")), "vector-classes")
    group = ["label", F.size("v").alias("dim")]
    shards = reps.groupBy(*group).agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    placed = reps.withColumn("dim", F.size("v")).join(shards, ["label", "dim"])
    own = placed.select(F.struct("label", "dim", F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int").alias("s")).alias("at"),
                        F.lit(0).alias("other"), "rep", "copies", "v")
    asked = placed.select("label", "dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("s"), "rep", "copies", "v").select(
        F.struct("label", "dim", "s").alias("at"), F.lit(1).alias("other"), "rep", "copies", "v")
    both = own.union(asked).select(F.xxhash64("at").alias("shard"), "other", "rep", "copies", "v")
    found = stored(both.repartition("shard").sortWithinPartitions("shard", "other", "rep").mapInArrow(_linked(cosine), FOUND), "vector-links")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("others"))
    component = connected(found.where("kind = 1").select("a", "b"), "vector-components").withColumnRenamed("node", "rep")
    classes = reps.drop("v").join(counts, "rep", "left").join(component, "rep", "left")
    of = good.select("vec_id", "label", "vector").distinct().join(classes, ["label", "vector"]).groupBy("vec_id").agg(
        F.sum(F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"), F.min(F.coalesce("component", "rep")).alias("c"))
    return rows.select("vec_id", "ok").join(of, "vec_id", "left").select(
        "vec_id", F.when(F.col("ok"), F.coalesce("n", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("ok"), F.coalesce("c", "vec_id")).otherwise(F.col("vec_id")).alias("component_id")).withColumn(
            "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op9_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return components(read(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
g AS (SELECT vec_id, label, e FROM v WHERE len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
r(node, reached) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT c.node AS vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, c.node = c.component_id AS kept
FROM c LEFT JOIN n ON n.a = c.node"""
