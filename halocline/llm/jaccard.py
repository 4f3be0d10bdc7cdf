"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, then sorted-array intersection.

A document's set holds the hashes of its distinct word shingles.  Equal sets are one
class, found by a fingerprint and represented by its smallest id.

*Families.*  Linked sets differ in few shingles, so of more parts than that, into which
a hash deals the shingles, some agree as a whole.  Sets are dealt by (size band, part,
hash of the part); those that meet anywhere form a family, and links lie within a
family.  Parts of fewer than two shingles say little; up to the spare number of parts
are left out, and a set with more of those deals them too, so no link is lost:
agreeing parts outnumber the spare ones, and agreeing parts are equally weak on both
sides.  This is exact while parts keep about PART shingles, which holds at similarities
from about 0.88 up.  Below that, parts of PART shingles (LESS in small sets) are dealt
without that guarantee: at 0.8, the worst case, a part of a large set still agrees with
probability 0.3, so of 100 shingles or more fewer than one pair in 200 has none, and
of 200 or more fewer than one in 10,000; a test measures it.

*Tiles.*  A family is cut into size bands and hashed blocks; two blocks of one band or
of neighbouring bands make a tile, the only place where their sets are compared.
Within a tile the differing bits of two parity bitmaps bound the overlap from above,
and only pairs that may reach the threshold are intersected.  Pairs whose link is
implied by links already found are skipped, so a dense group costs links, not pairs.

Defined results: null, empty and blank texts have no shingles and link with nothing;
a text with fewer words than a shingle is one shingle; a null id is kept as a row that
links with nothing; repeated ids are rows of one node.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from halocline.llm.components import EDGES, connected
from halocline.llm.shared import columns_of, mix, read, shingles, stored, word_hashes

WORDS_IN_SHINGLE, SHARE = 3, (9, 10)
BAND_GROWTH = 1.25
#: Sets in a block of a family; a tile compares two blocks.
BLOCK = 512
BITMAP_WORDS = 16
#: Shingles in a part where differences leave fewer in an exact one; in sets of fewer than SMALL shingles, LESS.
PART, LESS, SMALL = 6, 3, 120


@lru_cache(maxsize=None)
def band_edges(limit: int = 1 << 40) -> np.ndarray:
    edges = [1]
    while edges[-1] < limit:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_GROWTH)))
    return np.array(edges, np.int64)


def most_different(band: int, share: tuple[int, int]) -> int:
    """Shingles in which two linked sets of at most the band's sizes can differ."""
    largest = int(band_edges()[band + 1]) - 1
    p, q = share
    return 2 * largest * (q - p) // (q + p)


def parts_of(band: int, share: tuple[int, int]) -> tuple[int, int]:
    """Parts that a band deals its sets into, and how many of them a set may leave out; -1: all weak ones."""
    h = most_different(band, share)
    spare = 1 + h // 12
    largest = int(band_edges()[band + 1]) - 1
    part = PART if largest >= SMALL else LESS
    if (h + 1 + spare) * part <= largest or largest < 8 * LESS:
        return h + 1 + spare, spare
    return largest // part, -1


def tiles_of(size: int, share: tuple[int, int]) -> list[int]:
    """The bands in which a set of this size can be the smaller or larger of two linked sets."""
    p, q = share
    edges = band_edges()
    own = int(np.searchsorted(edges, size, "right")) - 1
    found, band = [], own
    while band == own or int(edges[band]) * p <= size * q:
        if most_different(band, share):
            found.append(band)
        band += 1
    return found


def signatures(s: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Hashes of the parts that a set deals, for every band that it takes part in."""
    out = []
    for band in tiles_of(len(s), share):
        k, spare = parts_of(band, share)
        part = ((s >> np.uint64(20)) % np.uint64(k)).astype(np.int64)
        count = np.bincount(part, minlength=k)
        order = np.argsort(part, kind="stable")
        total = np.zeros(k, np.uint64)
        filled = np.flatnonzero(count)
        with np.errstate(over="ignore"):
            if len(filled):
                total[filled] = np.add.reduceat(mix(s[order]), np.r_[0, np.cumsum(count[filled])[:-1]])
            key = mix(total ^ mix(np.arange(k, dtype=np.uint64) + np.uint64((band + 1) << 32)))
        weak = count < 2
        out.append(key if 0 <= spare < weak.sum() else key[~weak])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def set_of(text: str, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(shingles(word_hashes(text), k))


def _fingerprint(s: np.ndarray) -> tuple[int, int, int]:
    with np.errstate(over="ignore"):
        a, b = (int(mix(s ^ np.uint64(x)).sum(dtype=np.uint64)) for x in (0, 0x5851F42D4C957F2D))
    return len(s), a, b


def _sets(k: int):
    """``doc_id, n_shingles, f1, f2`` of every document."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in columns_of(batches):
            n, a, b = zip(*(_fingerprint(set_of(t, k)) for t in texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), *(pa.array(np.array(f, np.uint64).view(np.int64)) for f in (a, b))],
                ["doc_id", "n_shingles", "f1", "f2"])

    return run


def _dealt(k: int, share: tuple[int, int]):
    """``sig, doc``: the signatures of every set, of equal sets of a batch once."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in columns_of(batches):
            seen, sigs, docs = set(), [], []
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                s = set_of(text, k)
                if len(s) and (f := _fingerprint(s)) not in seen:
                    seen.add(f)
                    sigs.append(signatures(s, share).view(np.int64))
                    docs.append(np.full(len(sigs[-1]), doc, np.int64))
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs)), pa.array(np.concatenate(docs))], ["sig", "doc"])

    return run


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (sig, doc): an edge from the first document of a signature to each other one."""
    last_sig, last_doc = None, 0
    for batch in batches:
        sig, doc = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        if not len(sig):
            continue
        head = np.r_[sig[0] != last_sig if last_sig is not None else True, sig[1:] != sig[:-1]]
        at = np.maximum.accumulate(np.where(head, np.arange(len(sig)), -1))
        centre = np.where(at >= 0, doc[np.maximum(at, 0)], last_doc)
        last_sig, last_doc = sig[-1], centre[-1]
        edge = centre != doc
        pairs = np.unique(np.stack([centre[edge], doc[edge]], axis=1), axis=0) if edge.any() else np.empty((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def linked(a: np.ndarray, b: np.ndarray, share: tuple[int, int]) -> bool:
    """Exact test of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    same = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return same * (share[0] + share[1]) >= share[0] * (len(a) + len(b))


def bitmap(s: np.ndarray) -> np.ndarray:
    """Parity bitmap: differing bits never outnumber differing shingles."""
    bits = np.bincount((s & np.uint64(64 * BITMAP_WORDS - 1)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def tile_links(doc: list[int], side: list[int], sets: list[np.ndarray], share: tuple[int, int]) -> list[tuple[int, int]]:
    """Links that connect all linked sets of a tile.  side 0: compared with all; sides 1 and 2: with each other."""
    m = len(doc)
    p, q = share
    size = np.array([len(s) for s in sets], np.int64)
    bits = np.stack([bitmap(s) for s in sets])
    part = np.array(side)
    root = np.arange(m)
    found = []
    order = np.lexsort((np.array(doc), size))
    size, bits, part = size[order], bits[order], part[order]
    own = [sets[i] for i in order]
    for i in range(m - 1):
        last = np.searchsorted(size, size[i] * q // p, "right")
        rest = np.arange(i + 1, last)
        rest = rest[(root[rest] != root[i]) & ((part[rest] == 0) | (part[rest] != part[i]))]
        if not len(rest):
            continue
        differ = np.bitwise_count(bits[rest] ^ bits[i]).sum(axis=1, dtype=np.int64)
        both = size[rest] + size[i]
        # the overlap is at most (both - differ) / 2
        for j in rest[(both - differ) * (p + q) >= 2 * p * both]:
            if root[j] != root[i] and linked(own[i], own[j], share):
                found.append((doc[order[i]], doc[order[j]]))
                root[root == root[j]] = root[i]
    return found


def _verify(share: tuple[int, int]):
    """Rows sorted by tile, each with its side and set; a tile has at most two blocks of sets."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, doc, side, sets = None, [], [], []

        def links() -> pa.RecordBatch:
            pairs = tile_links(doc, side, sets, share) if len(doc) > 1 else []
            a, b = zip(*pairs, strict=True) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for t, d, s, h in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3), strict=True):
                if t != tile:
                    if doc:
                        yield links()
                    tile, doc, side, sets = t, [], [], []
                doc.append(d)
                side.append(s)
                sets.append(np.frombuffer(h.as_buffer(), np.uint64))
        if doc:
            yield links()

    return run


def _arrays(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in columns_of(batches):
            sets = [set_of(t, k).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sets, pa.binary())], ["family", "band", "doc", "s"])

    return run


def _tiled(family: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Adds ``band`` to families of several sets; one of at most BLOCK sets is a single tile, in band 0."""
    sized = family.groupBy("family").agg(F.count("*").alias("members")).where("members > 1")
    p, q = share
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / float(np.log(q / p)) * (1 - 1e-12)).cast("int")
    return family.join(sized, "family").withColumn("band", F.when(F.col("members") <= BLOCK, F.lit(0)).otherwise(band))


def components(docs: DataFrame, k: int = WORDS_IN_SHINGLE, share: tuple[int, int] = SHARE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row; sets link at a Jaccard similarity of ``share`` or more."""
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    sets = stored(docs.mapInArrow(_sets(k), "doc_id long, n_shingles long, f1 long, f2 long"), "jaccard-sets")
    real = sets.where("n_shingles > 0 and doc_id is not null")
    # a repeated id with several texts has several classes, which its rows join
    classes = stored(real.groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep")), "jaccard-classes")
    dealt = docs.where("doc_id is not null").mapInArrow(_dealt(k, share), "sig long, doc long")
    met = dealt.repartition("sig").sortWithinPartitions("sig", "doc").mapInArrow(_stars, EDGES)
    # whichever copy dealt the signatures, its representative belongs to the family
    copies = real.join(classes, ["n_shingles", "f1", "f2"]).select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).where("a <> b")
    family = stored(connected(met.union(copies), "jaccard-families").select(
        F.col("node").alias("rep"), F.col("component").alias("family")), "jaccard-family")
    members = _tiled(classes.select("rep", "n_shingles").join(family, "rep").groupBy("rep", "family").agg(
        F.max("n_shingles").alias("n_shingles")), share)
    # the texts of representatives that have a family, once each
    chosen = docs.join(members.select(F.col("rep").alias("doc_id"), "family", "band"), "doc_id").select(
        "family", "band", F.col("doc_id").alias("doc"), "text")
    arrays = stored(chosen.mapInArrow(_arrays(k), "family long, band int, doc long, s binary"), "jaccard-arrays")
    blocks = arrays.groupBy("family", "band").agg(F.count("*").alias("n")).withColumn(
        "blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    near = blocks.select("family", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    under = blocks.select("family", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    counts = blocks.join(near, ["family", "band"], "left").join(under, ["family", "band"], "left").na.fill(0, ["above", "below"])
    at = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    placed = arrays.join(counts.drop("n"), ["family", "band"]).withColumn("at", at)
    none = F.array().cast("array<struct<low:int,i:int,high:int,j:int,side:int>>")
    inside = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(
        F.col("band").alias("low"), F.least(x, F.col("at")).alias("i"), F.col("band").alias("high"),
        F.greatest(x, F.col("at")).alias("j"),
        F.when(x == F.col("at"), 0).when(F.col("at") < x, 1).otherwise(2).alias("side")))
    up = F.when(F.col("above") > 0, F.transform(F.sequence(F.lit(0), F.col("above") - 1), lambda x: F.struct(
        F.col("band").alias("low"), F.col("at").alias("i"), (F.col("band") + 1).alias("high"), x.alias("j"), F.lit(1).alias("side")))).otherwise(none)
    down = F.when(F.col("below") > 0, F.transform(F.sequence(F.lit(0), F.col("below") - 1), lambda x: F.struct(
        (F.col("band") - 1).alias("low"), x.alias("i"), F.col("band").alias("high"), F.col("at").alias("j"), F.lit(2).alias("side")))).otherwise(none)
    spread = placed.withColumn("t", F.explode(F.concat(inside, up, down))).select(
        F.xxhash64("family", "t.low", "t.i", "t.high", "t.j").alias("tile"), "doc", F.col("t.side").alias("side"), "s")
    links = spread.repartition("tile").sortWithinPartitions("tile", "doc").mapInArrow(_verify(share), EDGES)
    # rows of one class, and links between classes
    own = connected(links, "jaccard-links")
    reps = sets.join(classes, ["n_shingles", "f1", "f2"], "left").join(
        own.withColumnRenamed("node", "rep"), "rep", "left")
    return reps.select("doc_id", "n_shingles", F.when(
        (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "rep")).otherwise(F.col("doc_id")).alias("component_id"))


def op4_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return components(read(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] FOR i IN range(1, len(ws) - 1)]) END) AS sh FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM (s JOIN n USING (doc_id)) a JOIN (s JOIN n USING (doc_id)) b
    ON a.sh = b.sh AND a.doc_id < b.doc_id AND 9 * a.n <= 10 * b.n AND 9 * b.n <= 10 * a.n GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 190 * c >= 90 * (x.n + y.n)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, reached) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.node, e.b FROM r JOIN e ON r.reached = e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT node AS doc_id, min(reached) AS c FROM r GROUP BY node) m USING (doc_id)"""
