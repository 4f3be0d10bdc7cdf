"""Connected components by alternating star contractions, all steps as joins and aggregates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from halocline.llm.shared import forget, stored

EDGES = "a long, b long"


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a batch's edges, the ones that join something not yet joined in this batch."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent.setdefault(p, p)
            return x

        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        pairs = [(x, root(x)) for x in parent if root(x) != x]
        ids = np.array(pairs, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(ids[:, 0]), pa.array(ids[:, 1])], ["a", "b"])


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; the component is its smallest node.

    Edges with a null or with equal ends join nothing.  Each round links the larger
    neighbours of a node, then the smaller ones, to its smallest neighbour; rounds
    grow with the logarithm of a component's diameter.  A hub is aggregated before
    its shuffle, and the join on it is one that adaptive execution can split.
    """
    edges = edges.where("a <> b").mapInArrow(_forest, EDGES)
    now = stored(edges.distinct(), name)
    before = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # ``large`` has one row for each node and smaller end; link them all to the smallest end
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        after = stored(small, name)
        sums = [x.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first() for x in (now, after)] if before is None \
            else [before, after.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()]
        forget(now)
        now, before = after, sums[1]
        if sums[0] == sums[1]:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
