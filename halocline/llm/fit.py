"""Best-fit packing in bulk-synchronous rounds over range-sorted documents and gaps.

A round sorts what is unplaced and what is free together by size.  A sweep over each
range matches a gap with the largest documents that fit and are not yet taken, which
are the ones last seen; several documents of about one size may share a gap.  What a
range leaves over meets across ranges by rank: the ranges' counts, a row each, decide
which rank of one range belongs to which rank of another, and a join carries it out.
Gaps shrink and the next round begins.  A gap that no document fits is closed; documents
that no gap fits open the sequences they need at least.  A filled gap is at most half
of what it was, so rounds grow with the logarithm of the capacity.

Only ids and lengths take part.  Once fewer than LAST documents are unplaced, one task
sweeps them to the end: its size is bounded by that constant.

Defined results: null and empty texts have the end id alone; repeated rows and null ids
are packed each; an empty table gives no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from halocline.llm.shared import columns_of, read, stored
from halocline.llm.tokens import cuts, token_ids

CAPACITY = 2048
LAST = 50_000
#: Rows of documents and gaps in a range.
RANGE_ROWS = 200_000

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(df: DataFrame, capacity: int = CAPACITY, ranks: str | None = None, end_id: int = 0) -> DataFrame:
    """A row for each piece of each document; ``uid`` numbers the pieces."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        uid = TaskContext.get().partitionId() << 33
        for batch, texts in columns_of(batches):
            rows: list[list] = [[] for _ in range(6)]
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids = token_ids(text, ranks, end_id)
                for piece, (start, length) in enumerate(cuts(len(ids), capacity)):
                    crc = zlib.crc32(ids[start:start + length].tobytes())
                    for column, value in zip(rows, (uid, doc_id, piece, start, length, crc), strict=True):
                        column.append(value)
                    uid += 1
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows, kinds, strict=True)],
                                             [c.split()[0] for c in PIECES.split(", ")])

    return df.select(df["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


SWEPT = "kind int, uid long, size long, free long, seq long, at long, range int, rank long"
MATCH, ITEM, GAP = 0, 1, 2


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)],
                                      [c.split()[0] for c in SWEPT.split(", ")])


def _sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Successor matching in one sorted range; rows: size, kind, id, used (of a gap's sequence)."""
    from pyspark import TaskContext
    me = TaskContext.get().partitionId()
    waiting: list[tuple[int, int]] = []
    gaps = 0
    for batch in batches:
        out = []
        for size, kind, uid, used in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if kind == ITEM:
                waiting.append((size, uid))
            elif waiting:
                free = size
                for _ in range(size // waiting[-1][0]):
                    if not waiting:
                        break
                    length, item = waiting.pop()
                    out.append((MATCH, item, length, None, uid, used, None, None))
                    used, free = used + length, free - length
                out.append((GAP, uid, free, used, None, None, None, None))  # rank null: goes on, unless full
            else:
                out.append((GAP, uid, size, used, None, None, me, gaps))
                gaps += 1
        yield _batch(out)
    for at in range(0, len(waiting), 10_000):
        yield _batch([(ITEM, uid, size, None, None, None, me, at + i)
                      for i, (size, uid) in enumerate(waiting[at:at + 10_000])])


def _across(counts: list) -> list[tuple[int, int, int, int, int, int, int]]:
    """Which ranks of waiting documents meet which ranks of gaps: (item range, lowest and highest rank, gap range,
    first gap rank, documents for each gap, longest of them).  ``counts``: a row for each range."""
    stack, found = [], []
    for r in sorted(counts, key=lambda r: r["range"]):
        gap, left = 0, r["gaps"] or 0
        while left and stack:
            source, n, longest = stack.pop()
            each = max(1, (r["least"] or 1) // longest)
            take = min(n, left * each)
            found.append((source, n - take, n - 1, r["range"], gap, each, longest))
            used = -(-take // each)
            gap, left = gap + used, left - used
            if n > take:
                stack.append((source, n - take, longest))
        if r["items"]:
            stack.append((r["range"], r["items"], r["longest"]))
    return found


def _finish(capacity: int):
    """The last documents, swept to the end in one task: best fit in order of falling length."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps: list[tuple[int, int]] = []  # (free, sequence), sorted
        items: list[tuple[int, int]] = []
        for batch in batches:
            for size, kind, uid, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (items if kind == ITEM else gaps).append((size, uid))
        gaps.sort()
        out = []
        for length, uid in sorted(items, key=lambda x: (-x[0], x[1])):
            at = bisect_left(gaps, (length, -1))
            free, seq = gaps.pop(at) if at < len(gaps) else (capacity, uid)
            out.append((MATCH, uid, length, None, seq, capacity - free, None, None))
            if free > length:
                insort(gaps, (free - length, seq))
        yield _batch(out)

    return run


def packed(df: DataFrame, capacity: int = CAPACITY, ranks: str | None = None, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece."""
    cut = stored(pieces(df, capacity, ranks, end_id), "pieces")
    full = cut.where(F.col("length") == capacity).select("uid", F.col("uid").alias("seq"), F.lit(0).cast("long").alias("at"))
    items = cut.where(F.col("length") < capacity).select("uid", F.col("length").alias("size"))
    gaps = None
    placed = [full]
    while True:
        n, total, large = items.agg(F.count("*"), F.sum("size"), F.count_if(F.col("size") * 2 > capacity)).first()
        gap_rows = gaps.count() if gaps is not None else 0
        if not n:
            break
        one = items.select("size", F.lit(ITEM).alias("kind"), "uid", F.lit(0).cast("long").alias("used"))
        if n <= LAST and gap_rows <= 4 * LAST:
            if gaps is not None:
                one = one.unionByName(gaps.select("size", F.lit(GAP).alias("kind"), "uid", "used"))
            end = stored(one.repartition(1).mapInArrow(_finish(capacity), SWEPT), "fit-last")
            placed.append(end.select("uid", "seq", "at"))
            break
        if not gap_rows:
            opened = _largest(items, max(large, -(-total // capacity)), len(placed))
            # an opener is a gap of what it leaves; the rest waits for it
            new = stored(items.join(opened.withColumnRenamed("uid", "o"), F.col("uid") == F.col("o"), "left")
                         .select("uid", "size", F.col("o").isNotNull().alias("opens")), "fit-open")
            placed.append(new.where("opens").select("uid", F.col("uid").alias("seq"), F.lit(0).cast("long").alias("at")))
            gaps = new.where("opens").select("uid", (capacity - F.col("size")).alias("size"), F.col("size").alias("used")) \
                .where("size > 0")
            items = new.where("not opens").select("uid", "size")
            continue
        ranges = -(-(n + gap_rows) // RANGE_ROWS)
        both = one.unionByName(gaps.select("size", F.lit(GAP).alias("kind"), "uid", "used"))
        swept = stored(both.repartitionByRange(ranges, "size", "kind", "uid").sortWithinPartitions("size", "kind", "uid")
                       .mapInArrow(_sweep, SWEPT), "fit-sweep")
        placed.append(swept.where(F.col("kind") == MATCH).select("uid", "seq", "at"))
        items = swept.where(F.col("kind") == ITEM).select("uid", "size")
        gaps = swept.where((F.col("kind") == GAP) & F.col("range").isNull() & (F.col("size") > 0)).select(
            "uid", "size", F.col("free").alias("used"))
        meet = _across(swept.where("range is not null").groupBy("range").agg(
            F.count_if(F.col("kind") == ITEM).alias("items"), F.count_if(F.col("kind") == GAP).alias("gaps"),
            F.max(F.when(F.col("kind") == ITEM, F.col("size"))).alias("longest"),
            F.min(F.when(F.col("kind") == GAP, F.col("size"))).alias("least")).collect())
        if meet:
            matched = stored(_meet(swept, meet), "fit-across")
            placed.append(matched.select("uid", "seq", "at"))
            items = items.join(matched.select("uid"), "uid", "left_anti")
            gaps = gaps.unionByName(matched.groupBy("seq").agg(
                F.min("gap").alias("gap"), F.sum("length").alias("length"), F.min("used").alias("used")).select(
                    F.col("seq").alias("uid"), (F.col("gap") - F.col("length")).alias("size"),
                    (F.col("used") + F.col("length")).alias("used")).where("size > 0"))
    places = placed[0]
    for p in placed[1:]:
        places = places.unionByName(p)
    return cut.join(places, "uid").select("doc_id", "piece", "start", "length", "ids_crc32",
                                          F.col("seq").alias("sequence_id"), F.col("at").alias("offset"))


def _largest(items: DataFrame, count: int, seed: int) -> DataFrame:
    """Ids of about the ``count`` largest documents.

    Sizes are at most the capacity, so their histogram is small.  Of the documents of the
    least size wanted, a hashed share is taken, so that no task has to order equal sizes.
    """
    need, border, share = count, 0, 1.0
    for size, n in items.groupBy("size").count().orderBy(F.desc("size")).collect():
        border, share = size, min(1.0, need / n)
        need -= n
        if need <= 0:
            break
    picked = F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)
    return items.where((F.col("size") > border) | (F.col("size") == border) & picked).select("uid")


def _meet(swept: DataFrame, meet: list[tuple]) -> DataFrame:
    """Left-over documents placed into left-over gaps of other ranges by rank; ``meet`` has at most two rows a range."""
    spark = swept.sparkSession
    rows = spark.createDataFrame(meet, "source int, low long, high long, target int, first long, each long, longest long")
    items = swept.where((F.col("kind") == ITEM) & F.col("range").isNotNull()).select("uid", "size", "range", "rank")
    plan = items.join(F.broadcast(rows), (F.col("range") == F.col("source")) & F.col("rank").between(F.col("low"), F.col("high")))
    plan = plan.select("uid", F.col("size").alias("length"), "target",
                       (F.col("first") + F.floor((F.col("high") - F.col("rank")) / F.col("each"))).alias("place"),
                       ((F.col("high") - F.col("rank")) % F.col("each")).alias("slot"))
    gaps = swept.where((F.col("kind") == GAP) & F.col("range").isNotNull()).select(
        F.col("uid").alias("seq"), F.col("size").alias("gap"), F.col("free").alias("used"),
        F.col("range").alias("target"), F.col("rank").alias("place"))
    # at most a sequence's capacity of documents meet in a gap
    before = Window.partitionBy("seq").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return plan.join(gaps, ["target", "place"]).withColumn(
        "at", F.col("used") + F.coalesce(F.sum("length").over(before), F.lit(0))).select(
            "uid", "length", "seq", "gap", "used", "at")


def op8_best_fit(spark, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))
