"""Token-id output: best-fit-decreasing packing with a segment tree over free capacity, and packed id matrices.

Every task packs its own documents in groups of a bounded number of tokens, so no
row is shuffled and no group grows with the data; only the last sequences of a group
are less than full.  Documents longer than a sequence are cut without loss: a first
piece takes the remainder, the others fill sequences of their own.

Defined results: null and empty texts are the end id alone; repeated rows and ids are
packed each; an empty table gives no sequence.  Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from halocline.llm.shared import columns_of, read, shared_path
from halocline.llm.tokens import cuts, token_ids

CAPACITY = 2048
#: Tokens that a task packs together (about 16 MB of ids).
GROUP_TOKENS = 4_000_000
#: Sequences that leave a task at once.
BATCH_ROWS = 64

PACKED = ("sequence_id long, doc_ids array<long>, pieces array<int>, starts array<long>, cu_seqlens array<int>, "
          "position_resets array<int>, n_tokens int, input_ids binary")
MATRICES = ("first_sequence long, n_rows int, capacity int, matrix binary, doc_ids array<array<long>>, pieces array<array<int>>, "
            "starts array<array<long>>, cu_seqlens array<array<int>>, position_resets array<array<int>>")
LISTS = {"doc_ids": pa.int64(), "pieces": pa.int32(), "starts": pa.int64(), "cu_seqlens": pa.int32(), "position_resets": pa.int32()}


class CapacityTree:
    """A segment tree over free capacities 0..capacity: how many open sequences have each."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, free: int, by: int) -> None:
        i = free + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, sequence: int, free: int) -> None:
        self.open[free].append(sequence)
        self._add(free, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The open sequence of least free capacity that is at least ``length``, and that capacity."""
        i = length + self.leaves
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):  # up, until a right sibling has something
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:  # down to its leftmost leaf
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        free = i - self.leaves
        self._add(free, -1)
        return self.open[free].pop(), free


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Item numbers of each sequence, in order of placement."""
    tree, packed = CapacityTree(capacity), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        length = lengths[item]
        if (found := tree.take(length)) is None:
            sequence, free = len(packed), capacity
            packed.append([])
        else:
            sequence, free = found
        packed[sequence].append(item)
        if free > length:
            tree.put(sequence, free - length)
    return packed


def packed_rows(df: DataFrame, capacity: int = CAPACITY, ranks: str | None = None, end_id: int = 0) -> DataFrame:
    """A row for each packed sequence: its ids (little-endian 32-bit), cumulative lengths and position resets.

    ``position_resets`` are the places where positions start again at 0, which is at
    every piece.  ``sequence_id`` is the task number with a running number behind it.
    """
    return df.select(df["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(_packed(capacity, ranks, end_id), PACKED)


def _packed(capacity: int, ranks: str | None = None, end_id: int = 0):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 33
        group: list[tuple[int, int, int, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal group, size
            packed = best_fit_decreasing([len(x[3]) for x in group], capacity)
            for low in range(0, len(packed), BATCH_ROWS):
                yield rows_of(packed[low:low + BATCH_ROWS])
            group, size = [], 0

        def rows_of(packed: list[list[int]]) -> pa.RecordBatch:
            nonlocal number
            rows: list[list] = [[] for _ in range(8)]
            for sequence in packed:
                own = [group[i] for i in sequence]
                ids = np.concatenate([x[3] for x in own])
                ends = np.cumsum([len(x[3]) for x in own]).tolist()
                for column, value in zip(rows, (
                        number, [x[0] for x in own], [x[1] for x in own], [x[2] for x in own], [0, *ends],
                        [0, *ends[:-1]], len(ids), ids.tobytes()), strict=True):
                    column.append(value)
                number += 1
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()),
                     pa.list_(pa.int32()), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows, kinds, strict=True)],
                                              [c.split()[0] for c in PACKED.split(", ")])

        for batch, texts in columns_of(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids = token_ids(text, ranks, end_id)
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    group.append((doc_id, piece, start, ids[start:start + length]))
                size += len(ids)
                if size >= GROUP_TOKENS:
                    yield from flush()
        if group:
            yield from flush()

    return run


def write_matrices(packed: DataFrame, path: str, capacity: int = CAPACITY, rows: int = BATCH_ROWS, pad_id: int = 0) -> None:
    """Parquet of id matrices: up to ``rows`` sequences in a row, padded to (n_rows, capacity) little-endian 32-bit ids.

    Beside each matrix stand the pieces, cumulative lengths and position resets of its sequences.
    """
    packed.select("sequence_id", "input_ids", *LISTS).mapInArrow(_matrices(capacity, rows, pad_id), MATRICES).write.parquet(path)


def pack_matrices(df: DataFrame, path: str, capacity: int = CAPACITY, ranks: str | None = None, end_id: int = 0,
                  rows: int = BATCH_ROWS, pad_id: int = 0) -> None:
    """``write_matrices`` of ``packed_rows`` in one Python worker of a task, so that no sequence is copied to another."""
    pack, fill = _packed(capacity, ranks, end_id), _matrices(capacity, rows, pad_id)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fill(b.select(["sequence_id", "input_ids", *LISTS]) for b in pack(batches))

    df.select(df["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, MATRICES).write.parquet(path)


def _matrices(capacity: int, rows: int, pad_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = np.asarray(batch.column(0))
            # the sequences of a matrix follow one another without a gap
            breaks = np.flatnonzero(np.diff(number) != 1) + 1
            for low, high in zip(np.r_[0, breaks], np.r_[breaks, len(number)], strict=True):
                for at in range(low, high, rows):
                    own = batch.slice(at, min(rows, high - at))
                    matrix = np.full((own.num_rows, capacity), pad_id, "<u4")
                    for i, ids in enumerate(own.column(1)):
                        ids = np.frombuffer(ids.as_buffer(), "<u4")
                        matrix[i, :len(ids)] = ids
                    yield pa.RecordBatch.from_arrays(
                        [own.column(0).slice(0, 1), pa.array([len(matrix)], pa.int32()), pa.array([capacity], pa.int32()),
                         pa.array([matrix.tobytes()], pa.binary()),
                         *[pa.array([own.column(2 + j).to_pylist()], pa.list_(pa.list_(kind))) for j, kind in enumerate(LISTS.values())]],
                        [c.split()[0] for c in MATRICES.split(", ")])

    return run


def read_matrices(spark: SparkSession, path: str) -> DataFrame:
    """A row for each sequence of written matrices, like those of ``packed_rows`` but with a CRC-32 of its ids.

    The ids are cut out of the matrix inside its row, so the matrix is not copied for every sequence.
    """
    rows = spark.read.parquet(path)
    width = F.col("capacity") * 4
    # bound as a variable: named as a column, the matrix would be copied out of its row for every sequence
    crc = F.transform(F.array("matrix"), lambda m: F.transform(
        F.col("cu_seqlens"), lambda c, i: F.crc32(F.substr(m, i * width + 1, F.element_at(c, -1) * 4))))[0]
    names = ["doc_ids", "pieces", "starts", "cu_seqlens", "position_resets"]
    each = F.posexplode(F.arrays_zip(*names, crc.alias("ids_crc32"))).alias("at", "own")
    out = rows.select("first_sequence", each).select("first_sequence", "at", "own.*")
    return out.select((F.col("first_sequence") + F.col("at")).alias("sequence_id"), *names,
                      F.element_at("cu_seqlens", -1).alias("n_tokens"), "ids_crc32")


def op3_packed_ids(spark, sf_dir: str) -> DataFrame:
    """Every packed sequence of ``documents``, read back from the matrices it was written to."""
    path = shared_path(spark, "packed-matrices")
    pack_matrices(read(spark, sf_dir, "documents"), path)
    return read_matrices(spark, path)


def piece_digest(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4", copy=False).tobytes())
