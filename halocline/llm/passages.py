"""Fuzzy passages that repeat across documents: k-mer seeds, collinear chains, alignment.

*Seeds.*  Word k-mers are thinned by winnowing: of every WINDOW successive k-mers the
least hash is a seed, so each common run of WINDOW + K - 1 words shares one.  A seed is
matched with the first document that holds it, which is the one of least id, so matches
are as many as seeds and never pairs of a group.  A seed that many documents of a batch
share is matched within the batch first, and only the batch's first one is shuffled.
Runs of shared seeds as long as every exact passage of LEAST words has one are keys too.
Around a run that no passage holds yet every window of LEAST words is a key, so an exact
passage is found whatever the first holders of its single seeds are.  A run that is open
after that has fewer exact words; it is matched with the first document that has it and
one more of the shared seeds beside it.  So keys are as many as windows or seeds, however many
documents hold a run.

*Chains.*  The matches of a document with one earlier document are chained by score:
each match adds K, each word between two matches takes GAP on either side.  Best
predecessors come from a Fenwick tree of prefix maxima over the other document's
positions.

*Alignment.*  A chain is aligned from its first match outwards in both directions, then
from its first match that this leaves unexplained, and so on to its end.  A passage is
reported if it has at least LEAST words and SHARE of them agree; an alignment of which too
few agree is split at its longest gap and its parts are tried.

Defined results: null, empty and short texts have no passages; ids that are null take
no part; rows that share an id count as one document and are never matched with each
other; passages repeated within one document only are not reported.  Other columns are
ignored by ``repeats`` and kept by ``without_repeats``.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from halocline.llm.shared import columns_of, forget, fresh, mix, read, shingles, stored, text_slices, word_hashes

K, WINDOW = 5, 8
LEAST, SHARE = 50, 0.8
GAP = 0.08
#: Words that an alignment may skip on either side before the next agreeing words.
SKIP = 24
BLOCK = 128
#: Documents of a batch that share a seed before it is matched within the batch.
COMMON = 8
_STEP = 0x9E3779B97F4A7C15

MATCHES = "hash long, doc long, pos int, source long, at int"
WINDOWS = MATCHES + ", wanted boolean"
RUNS = "hash long, doc long, pos int, stop int, open boolean"
CHAINS = "doc long, source long, x0 int, x1 int, y0 int, y1 int, matches binary"
PASSAGES = ("doc_id long, source_doc_id long, start_word int, end_word int, source_start int, source_end int, "
            "matched int, similarity double")


def winnow(h: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least hash of every window, each once; of fewer hashes, of all."""
    if len(h) == 0:
        return np.empty(0, np.int64)
    if len(h) <= window:
        return np.array([int(h.argmin())])
    views = np.lib.stride_tricks.sliding_window_view(h, window)
    return np.unique(views.argmin(axis=1) + np.arange(len(views)))


def _seeds(k: int, window: int, least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in columns_of(batches):
            hashes, docs, places = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                own = word_hashes(text)
                if len(own) < least:
                    continue
                h = shingles(own, k)
                at = winnow(h, window)
                hashes.append(h[at].view(np.int64))
                docs.append(np.full(len(at), doc, np.int64))
                places.append(at.astype(np.int32))
            if hashes:
                yield _met_in_batch(np.concatenate(hashes), np.concatenate(docs), np.concatenate(places))

    return run


def _met_in_batch(h: np.ndarray, d: np.ndarray, p: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    """Rows of MATCHES and further columns; a hash of more than COMMON documents is matched with the first of them."""
    order = np.lexsort((p, d, h))
    h, d, p = h[order], d[order], p[order]
    head = np.r_[True, h[1:] != h[:-1]]
    group = np.cumsum(head) - 1
    begin = np.flatnonzero(head)
    n_docs = np.add.reduceat(np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])].astype(int), begin)
    source, at = d[begin][group], p[begin][group]
    local = (n_docs[group] > COMMON) & (d != source)
    return pa.RecordBatch.from_arrays(
        [pa.array(h), pa.array(d), pa.array(p), pa.array(source, pa.int64(), mask=~local), pa.array(at, pa.int32(), mask=~local),
         *(pa.array(x[order]) for x in more.values())], ["hash", "doc", "pos", "source", "at", *more])


def _matched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (hash, doc, pos): each seed of another document than the first is matched with the first.

    Of rows with a sixth column only those where it is true are matched; the others may be matched with.
    """
    last, doc0, pos0 = None, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        h, d, p = (np.asarray(batch.column(i)) for i in range(3))
        done = np.asarray(batch.column(3).is_valid())
        source = np.asarray(batch.column(3).fill_null(0)).copy()
        at = np.asarray(batch.column(4).fill_null(0)).copy()
        mine = np.flatnonzero(~done)
        if len(mine):
            hm, dm, pm = h[mine], d[mine], p[mine]
            head = np.r_[last is None or hm[0] != last, hm[1:] != hm[:-1]]
            first = np.maximum.accumulate(np.where(head, np.arange(len(hm)), -1))
            known = first >= 0
            source[mine] = np.where(known, dm[np.maximum(first, 0)], doc0)
            at[mine] = np.where(known, pm[np.maximum(first, 0)], pos0)
            last, doc0, pos0 = hm[-1], source[mine][-1], at[mine][-1]
        keep = source != d
        if batch.num_columns > 5:
            keep &= np.asarray(batch.column(5))
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (h, d, p, source, at)], ["hash", "doc", "pos", "source", "at"])


class PrefixMaximum:
    """A Fenwick tree: the best (value, item) among ranks up to a given one."""

    def __init__(self, n: int):
        self.value = [float("-inf")] * (n + 1)
        self.item = [-1] * (n + 1)

    def put(self, rank: int, value: float, item: int) -> None:
        i, n = rank + 1, len(self.value)
        while i < n:
            if value > self.value[i]:
                self.value[i], self.item[i] = value, item
            i += i & -i

    def best(self, rank: int) -> tuple[float, int]:
        """Among ranks below ``rank``."""
        found, item, i = float("-inf"), -1, rank
        while i > 0:
            if self.value[i] > found:
                found, item = self.value[i], self.item[i]
            i -= i & -i
        return found, item


def chains(pos: np.ndarray, at: np.ndarray, k: int = K, gap: float = GAP) -> list[list[int]]:
    """Chains of matches, each rising in both documents, best first; every match is in at most one.

    The score of a chain is k for each match, less ``gap`` for each word advanced beyond a match in either document.
    """
    n = len(pos)
    ranks = np.searchsorted(np.unique(at), at).tolist()
    x, y = pos.tolist(), at.tolist()
    tree = PrefixMaximum(n)
    score, before = [0.0] * n, [-1] * n
    order = sorted(range(n), key=lambda i: (x[i], y[i]))
    i = 0
    while i < n:
        j = i
        while j < n and x[order[j]] == x[order[i]]:  # matches of one position do not follow each other
            m = order[j]
            value, item = tree.best(ranks[m])
            gain = value - gap * (x[m] + y[m])
            score[m], before[m] = (k + gain, item) if gain > 0 else (float(k), -1)
            j += 1
        for m in order[i:j]:
            tree.put(ranks[m], score[m] + gap * (x[m] + y[m]), m)
        i = j
    used, found = [False] * n, []
    for m in sorted(range(n), key=lambda i: (-score[i], x[i], y[i])):
        chain = []
        while m >= 0 and not used[m]:
            used[m] = True
            chain.append(m)
            m = before[m]
        if chain:
            found.append(chain[::-1])
    return found


def _chained(k: int, gap: float, fewest: int = 2):
    """Rows sorted by (doc, source): a document's matches with one other are bounded by the document."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def found() -> list[tuple]:
            p, a = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            if len(p) < fewest:
                return []
            rows = []
            step, rise = np.diff(p), np.diff(a)
            if (step > 0).all() and (step == rise).all() and (step * 2 * gap < k).all():
                ranges = [list(range(len(p)))]  # one diagonal without large gaps is one chain
            else:
                ranges = chains(p, a, k, gap)
            for number, c in enumerate(ranges):
                if len(c) >= fewest or number == 0 and len(p) >= 5:
                    rows.append((*key, int(p[c[0]]), int(p[c[-1]]) + k, int(a[c[0]]), int(a[c[-1]]) + k,
                                 np.stack([p[c], a[c]]).astype(np.int32).tobytes()))
            return rows

        for batch in batches:
            out = []
            if batch.num_rows:
                d, s, p, a = (np.asarray(c) for c in batch.columns)
                cut = np.flatnonzero((d[1:] != d[:-1]) | (s[1:] != s[:-1])) + 1
                for b, e in zip(np.r_[0, cut], np.r_[cut, len(d)], strict=True):
                    own = (int(d[b]), int(s[b]))
                    if own != key:
                        if held:
                            out += found()
                        key, held = own, []
                    held.append((p[b:e], a[b:e]))
            yield _rows(out, CHAINS)
        if held:
            yield _rows(found(), CHAINS)

    return run


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wanted blocks of each document's words, as 32-bit hashes."""
    for batch, texts in columns_of(batches):
        docs, numbers, data = [], [], []
        for doc, wanted, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
            h = (word_hashes(text) >> np.uint64(32)).astype(np.uint32)
            for b in wanted:
                if b * BLOCK < len(h):
                    docs.append(doc)
                    numbers.append(b)
                    data.append(h[b * BLOCK:(b + 1) * BLOCK].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(numbers, pa.int32()), pa.array(data, pa.binary())],
                                         ["of", "block", "words"])


def extend(a: np.ndarray, b: np.ndarray, skip: int = SKIP) -> list[tuple[int, int, int]]:
    """Runs (place in a, place in b, words) that agree when a and b are aligned from their starts; ends where agreement pays most.

    After a disagreement the nearest three (at the end: remaining) agreeing words within ``skip`` words go on.
    """
    x = y = 0
    best, score, runs, kept = 0.0, 0.0, [], 0
    while x < len(a) and y < len(b):
        n = min(len(a) - x, len(b) - y)
        off = a[x:x + n] != b[y:y + n]
        run = int(off.argmax()) if off.any() else n
        if run:
            runs.append((x, y, run))
        x, y, score = x + run, y + run, score + run
        if score > best:
            best, kept = score, len(runs)
        if x >= len(a) or y >= len(b):
            break
        nxt = None
        w = min(skip, len(a) - x, len(b) - y)
        if len(a) - x - 1 >= 3 and len(b) - y - 1 >= 3 and (a[x + 1:x + 4] == b[y + 1:y + 4]).all():
            nxt = (1, 1)
        else:
            left, right = a[x:x + w + 3], b[y:y + w + 3]
            if len(left) >= 3 and len(right) >= 3:
                eq = left[:, None] == right[None, :]
                three = eq[:-2, :-2] & eq[1:-1, 1:-1] & eq[2:, 2:]
                i, j = np.nonzero(three)
                if len(i):
                    at = np.lexsort((i + j, np.maximum(i, j)))[0]
                    nxt = (int(i[at]), int(j[at]))
        if nxt is None:
            break
        x, y = x + nxt[0], y + nxt[1]
        score -= 1.5 * max(nxt)
        if score < best - 2 * skip:
            break
    return runs[:kept]


def align(a: np.ndarray, b: np.ndarray, x: int, y: int, x_from: int = 0, y_from: int = 0) -> list[tuple[int, int, int]]:
    """Runs of a and b that agree around the match at (x, y), in order; none begins before ``x_from`` and ``y_from``."""
    back = extend(a[x_from:x][::-1], b[y_from:y][::-1])
    return [(x - i - n, y - j - n, n) for i, j, n in reversed(back)] + [(x + i, y + j, n) for i, j, n in extend(a[x:], b[y:])]


def accepted(runs: list[tuple[int, int, int]], least: int, share: float) -> list[tuple[int, int, int, int, int]]:
    """Spans in both documents and agreeing words of the passages of an alignment; split at its longest gap while too few agree."""
    found, todo = [], [runs]
    while todo:
        part = todo.pop()
        if not part:
            continue
        (xs, ys, _), (x, y, n) = part[0], part[-1]
        xe, ye, same = x + n, y + n, sum(r[2] for r in part)
        if xe - xs < least:
            continue
        if same >= share * max(xe - xs, ye - ys):
            found.append((xs, xe, ys, ye, same))
            continue
        gaps = [max(q[0] - p[0], q[1] - p[1]) - p[2] for p, q in zip(part, part[1:])]
        cut = int(np.argmax(gaps)) + 1
        todo += [part[cut:], part[:cut]]
    return found


def along(a: np.ndarray, b: np.ndarray, matches: list[tuple[int, int]], least: int, share: float) -> list[tuple[int, int, int, int, int]]:
    """Passages along a chain: aligned anew from each match that no passage and no run before it holds."""
    found, runs, x_from, y_from = [], [], 0, 0
    for x, y in matches:
        at = bisect_right(runs, x, key=lambda r: r[0]) - 1
        if x < x_from or y < y_from or at >= 0 and x < runs[at][0] + runs[at][2] and y - x == runs[at][1] - runs[at][0]:
            continue
        runs = align(a, b, x, y, x_from, y_from)
        own = accepted(runs, least, share)
        if own:
            found += own
            x_from, y_from = own[-1][1], own[-1][3]
    return found


def _aligned(least: int, share: float):
    """Rows sorted by chain, side and block; a chain's blocks and matches are bounded by its two documents."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head, held = None, None, ({}, {}, {})

        def passages() -> list[tuple]:
            if not held[0] or not held[1] or not held[2]:
                return []
            words, base = [], []
            for side in (0, 1):
                low, high = min(held[side]), max(held[side])
                words.append(np.concatenate([np.frombuffer(held[side][b], np.uint32) for b in range(low, high + 1)]))
                base.append(low * BLOCK)
            x, y = np.frombuffer(held[2][0], np.int32).reshape(2, -1) - np.array(base)[:, None]
            return [(*head, xs + base[0], xe + base[0], ys + base[1], ye + base[1], same, same / max(xe - xs, ye - ys))
                    for xs, xe, ys, ye, same in along(*words, list(zip(x.tolist(), y.tolist(), strict=True)), least, share)]

        for batch in batches:
            out = []
            for c, doc, source, side, block, words in zip(*(v.to_pylist() for v in batch.columns), strict=True):
                if c != key:
                    if head:
                        out += passages()
                    key, head, held = c, (doc, source), ({}, {}, {})
                held[side][block] = words
            yield _rows(out, PASSAGES)
        if head:
            yield _rows(passages(), PASSAGES)

    return run


def _runs(k: int, window: int, reach: int):
    """Rows sorted by (doc, kind, pos), a document's passages before its shared seeds: the shortest run of ``reach`` words from each seed.

    Seeds of an exact passage are at most ``window`` words apart.  A run is open if a seed of it is in no passage.
    """
    def found(held: list[list[np.ndarray]]) -> tuple[np.ndarray, ...] | None:
        kind, pos, end, h = (np.concatenate([x[i] for x in held]) for i in range(4))
        own = kind == 1
        p, h, s, e = pos[own].astype(np.int64), h[own].view(np.uint64), pos[~own], end[~own]
        if len(p) == 0 or p[-1] + k - p[0] < reach:
            return None
        free = np.ones(len(p), bool)
        if len(s):
            i = np.searchsorted(s, p, "right") - 1
            free = (i < 0) | (np.maximum.accumulate(e)[i] < p + k)
        last = np.searchsorted(p, p + reach - k)
        broken = np.r_[0, np.cumsum(np.diff(p) > window)]
        at = np.flatnonzero(last < len(p))
        at = at[broken[last[at]] == broken[at]]
        if len(at) == 0:
            return None
        last = last[at]
        with np.errstate(over="ignore"):
            # a sum of mixed (seed, distance from the first seed) over each run
            key = np.zeros(len(at), np.uint64)
            for step in range(int((last - at).max()) + 1):
                i = np.minimum(at + step, last)
                key += np.where(at + step <= last, mix(h[i] + mix((p[i] - p[at]).astype(np.uint64))), np.uint64(0))
        count = np.r_[0, np.cumsum(free)]
        return key.view(np.int64), p[at].astype(np.int32), (p[last] + k).astype(np.int32), count[last + 1] > count[at]

    return _per_document(found, lambda h, d, *rest: pa.RecordBatch.from_arrays([pa.array(x) for x in (h, d, *rest)], _names(RUNS)))


def _per_document(found, batch_of):
    """Applies ``found`` to the columns behind the id of each document's rows, sorted by it; gives keys and what is beside them, or None."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def closed() -> Iterator[tuple]:
            got = found(held) if held else None
            if got:
                yield got[0], np.full(len(got[0]), key, np.int64), *got[1:]

        def rows(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            if parts:
                yield batch_of(*(np.concatenate(x) for x in zip(*parts, strict=True)))

        for batch in batches:
            out = []
            if batch.num_rows:
                d, *rest = (np.asarray(c) for c in batch.columns)
                cut = np.flatnonzero(d[1:] != d[:-1]) + 1
                for b, e in zip(np.r_[0, cut], np.r_[cut, len(d)], strict=True):
                    if d[b] != key:
                        out += closed()
                        key, held = d[b], []
                    held.append([x[b:e] for x in rest])
            yield from rows(out)
        yield from rows(list(closed()))

    return run


def _contexts(k: int, far: int):
    """Rows sorted by (doc, kind, pos), shared seeds before runs: a key of each run with each shared seed beside it, up to ``far`` words off."""
    def found(held: list[list[np.ndarray]]) -> tuple[np.ndarray, ...] | None:
        kind, pos, end, h, wanted = (np.concatenate([x[i] for x in held]) for i in range(5))
        own = kind == 1
        p, seeds = pos[own], h[own].view(np.uint64)
        once = np.r_[True, p[1:] != p[:-1]][:len(p)]  # one that is matched and has been matched with comes twice
        p, seeds = p[once], seeds[once]
        start, stop, runs, wanted = pos[~own], end[~own], h[~own].view(np.uint64), wanted[~own]
        keys, of = [], []
        with np.errstate(over="ignore"):
            for side, low, high in ((1, start - far - k, start - 1), (2, stop - k + 1, stop + far)):
                first, after = np.searchsorted(p, low), np.searchsorted(p, high, "right")
                count = after - first
                run = np.repeat(np.arange(len(runs)), count)
                seed = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + first[run]
                keys.append(mix(runs[run] + mix(seeds[seed] + np.uint64(side))))
                of.append(run)
        of, keys = np.concatenate(of), np.concatenate(keys).view(np.int64)
        if len(of) == 0:
            return None
        order = np.lexsort((start[of], keys))
        of, keys = of[order], keys[order]
        first = np.r_[True, keys[1:] != keys[:-1]]
        # of equal keys that are only to be matched with, the first; a run between equal seeds has one key for them
        need = first | wanted[of] & np.r_[True, start[of][1:] != start[of][:-1]]
        return keys[need], start[of][need], wanted[of][need]

    return _per_document(found, lambda h, d, p, wanted: _met_once(_met_in_batch(h, d, p, wanted=wanted)))


def _to_match(met: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of WINDOWS, sorted by (hash, doc, pos), without those that are only to be matched with and not the first of their hash."""
    h, wanted = np.asarray(met.column(0)), np.asarray(met.column(5))
    return met.filter(pa.array(wanted | np.r_[True, h[1:] != h[:-1]][:len(h)]))


def _met_once(met: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of WINDOWS; of several keys that match a run with one place of a document within the batch, one."""
    met = _to_match(met)
    done = np.flatnonzero(np.asarray(met.column(3).is_valid()))
    columns = [np.asarray(met.column(i).take(pa.array(done))) for i in (1, 2, 3, 4)]
    order = np.lexsort(columns)
    again = np.ones(len(done), bool)
    again[:1] = False
    for c in columns:
        again[1:] &= c[order][1:] == c[order][:-1]
    keep = np.ones(met.num_rows, bool)
    keep[done[order[again]]] = False
    return met.filter(pa.array(keep))


def _shared_seeds(met: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Seeds that several documents have, of all documents or those of ``of``; one that is matched and has been matched with comes twice."""
    own = met.select("doc", "pos", "hash")
    first = met.select(F.col("source").alias("doc"), F.col("at").alias("pos"), "hash")
    if of is not None:
        own, first = (x.join(of, "doc", "left_semi").select("doc", "pos", "hash") for x in (own, first))
    return own.union(first.distinct())


def _shared_runs(met: DataFrame, passages: DataFrame, k: int, window: int, least: int) -> DataFrame:
    """The runs of seeds that a document shares with any other."""
    kinds = _shared_seeds(met).select("doc", F.lit(1).alias("kind"), "pos", F.lit(0).alias("end"), "hash").unionByName(passages.select(
        F.col("doc_id").alias("doc"), F.lit(0).alias("kind"), F.col("start_word").alias("pos"), F.col("end_word").alias("end"), F.lit(0).cast("long").alias("hash")))
    # an exact passage of ``least`` words has seeds within ``window`` k-mers of both its ends
    distinct = kinds.repartition("doc").sortWithinPartitions("doc", "kind", "pos").mapInArrow(_first_of_place, kinds.schema)
    return distinct.mapInArrow(_runs(k, window, max(least - 2 * (window - 1), k)), RUNS)


def _first_of_place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows each seed once: one that is matched and has been matched with comes twice."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        d, kind, p = (np.asarray(batch.column(i)) for i in range(3))
        new = (kind == 0) | np.r_[(d[0], kind[0], p[0]) != last, (d[1:] != d[:-1]) | (kind[1:] != kind[:-1]) | (p[1:] != p[:-1])]
        last = (d[-1], kind[-1], p[-1])
        yield batch.filter(pa.array(new))


def _meet(keys: DataFrame) -> DataFrame:
    """Each key of a document matched with the first document that has it."""
    by = F.when(F.col("source").isNull(), F.col("hash")).otherwise(F.xxhash64("doc", "source"))
    return keys.repartition(by).sortWithinPartitions("hash", "doc", "pos").mapInArrow(_matched, MATCHES)


def _windows(least: int):
    """Hashes of the windows of ``least`` words of a document around its runs; wanted are those around an open one."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in columns_of(batches):
            parts = []
            for doc, runs, text in zip(batch.column(0).to_pylist(), batch.column(1), texts, strict=True):
                own = window_hashes(word_hashes(text), least)
                pos, stop, is_open = (np.asarray(runs.values.field(i)) for i in range(3))
                if len(own) == 0:
                    continue
                # starts of windows that hold a run, counted from both its ends
                low, high = np.clip(stop - least, 0, len(own)), np.clip(pos + 1, 0, len(own))
                low = np.minimum(low, high)
                inside = [np.cumsum(np.bincount(low[x], minlength=len(own) + 1) - np.bincount(high[x], minlength=len(own) + 1))[:-1] > 0
                          for x in (np.ones(len(pos), bool), is_open)]
                at = np.flatnonzero(inside[0])
                at = at[_needed(own[at], at, inside[1][at], least)]
                parts.append((own[at].view(np.int64), np.full(len(at), doc, np.int64), at.astype(np.int32), inside[1][at]))
            if parts:
                h, d, p, wanted = (np.concatenate(x) for x in zip(*parts, strict=True))
                if len(h):
                    yield _to_match(_met_in_batch(h, d, p, wanted=wanted))

    return run


def _needed(keys: np.ndarray, at: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """Of rising places with equal keys: the first, to be matched with, and as many wanted ones as cover the words of them all."""
    order = np.lexsort((at, keys))
    head = np.r_[True, keys[order][1:] != keys[order][:-1]][:len(keys)]
    keep = np.zeros(len(keys), bool)
    keep[order] = head | wanted[order]
    begin = np.flatnonzero(head)
    size = np.diff(np.r_[begin, len(keys)])
    for b, n in zip(begin[size > 1], size[size > 1], strict=True):
        own = order[b:b + n]
        own = own[wanted[own]]
        places, i = at[own], 0
        # from each the farthest that begins where it ends or before
        keep[own[1:]] = False
        while i < len(own) - 1:
            i = max(int(np.searchsorted(places, places[i] + length, "right")) - 1, i + 1)
            keep[own[i]] = True
        keep[order[b]] = True
    return keep


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n successive words from one running sum; none of fewer words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    powers = np.full(len(words), _STEP, np.uint64)
    powers[0] = 1
    with np.errstate(over="ignore"):
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(powers, dtype=np.uint64), dtype=np.uint64)]
        back = np.full(len(words) - n + 1, pow(_STEP, -1, 1 << 64), np.uint64)
        back[0] = 1
        return mix((sums[n:] - sums[:-n]) * np.cumprod(back, dtype=np.uint64))


def _passages(docs: DataFrame, met: DataFrame, k: int, least: int, share: float, fewest: int = 2) -> DataFrame:
    """The passages that matches ``doc, source, pos, at`` lead to."""
    found = met.select("doc", "source", "pos", "at").repartition("doc", "source").sortWithinPartitions("doc", "source", "pos", "at").mapInArrow(
        _chained(k, GAP, fewest), CHAINS)
    chained = stored(found.withColumn("chain", F.monotonically_increasing_id()), "passage-chains")
    reach = least
    low = lambda c: F.greatest(F.floor((F.col(c) - reach) / BLOCK), F.lit(0)).cast("int")
    high = lambda c: F.floor((F.col(c) + reach) / BLOCK).cast("int")
    head = ("chain", "doc", "source")
    wanted = chained.select(*head, F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("doc").alias("of"), F.sequence(low("x0"), high("x1")).alias("b")),
        F.struct(F.lit(1).alias("side"), F.col("source").alias("of"), F.sequence(low("y0"), high("y1")).alias("b")))).alias("w")).select(
            *head, "w.side", "w.of", F.explode("w.b").alias("block"))
    # distinct blocks first, so that a document in many chains is cut once
    per_doc = wanted.select("of", "block").distinct().groupBy("of").agg(F.collect_set("block").alias("wanted"))
    blocks = docs.join(per_doc, docs["doc_id"] == per_doc["of"]).select("of", "wanted", "text").mapInArrow(
        _blocks, "of long, block int, words binary")
    matches = chained.select(*head, F.lit(2).alias("side"), F.lit(0).alias("block"), F.col("matches").alias("words"))
    sides = wanted.join(blocks, ["of", "block"]).select(*head, "side", "block", "words").unionByName(matches)
    aligned = sides.repartition("chain").sortWithinPartitions("chain").mapInArrow(_aligned(least, share), PASSAGES)
    out = stored(_longest(aligned), "passages")
    forget(chained)
    return out


def repeats(docs: DataFrame, k: int = K, window: int = WINDOW, least: int = LEAST, share: float = SHARE) -> DataFrame:
    """A row for each passage of a document that an earlier document has too, with both word spans.

    Passages of one pair that begin or end at one place are reported once, the longest.
    """
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").where("doc_id is not null")
    seeds = docs.mapInArrow(_seeds(k, window, int(least * share)), MATCHES)
    met = stored(_meet(seeds), "passage-matches")
    found = _passages(docs, met, k, least, share)
    runs = stored(_shared_runs(met, found, k, window, least), "passage-runs")
    holders = stored(_holders(runs), "passage-holders")
    forget(runs)
    if holders.isEmpty():
        return found
    spans = holders.groupBy("doc").agg(F.collect_list(F.struct("pos", "stop", "open")).alias("runs"))
    # what follows concerns the holders only, so all texts are not exchanged again
    of = stored(holders.select("doc").distinct(), "passage-documents")
    docs = stored(docs.join(of, docs["doc_id"] == of["doc"], "left_semi"), "passage-texts")
    whole = docs.join(spans, docs["doc_id"] == spans["doc"]).select("doc_id", "runs", "text").mapInArrow(_windows(least), WINDOWS)
    found = stored(_longest(found.unionByName(
        _passages(docs, stored(_meet(whole), "passage-matches"), k, least, share, fewest=1))), "passages")
    # what is still open has too few exact words, but may be part of an edited passage
    held = (holders["doc"] == found["doc_id"]) & (holders["pos"] >= found["start_word"]) & (holders["stop"] <= found["end_word"])
    left = stored(holders.where("open").join(found, held, "left_anti").select("hash", "doc", "pos", F.lit(True).alias("left")), "passage-open")
    if left.isEmpty():
        return found
    holders = stored(holders.join(left.select("hash").distinct(), "hash", "left_semi").join(left, ["hash", "doc", "pos"], "left").withColumn(
        "open", F.col("left").isNotNull()).drop("left"), "passage-holders")
    kinds = _shared_seeds(met, of).select("doc", F.lit(1).alias("kind"), "pos", F.lit(0).alias("end"), "hash", F.lit(False).alias("wanted")).unionByName(
        holders.select("doc", F.lit(2).alias("kind"), "pos", F.col("stop").alias("end"), "hash", F.col("open").alias("wanted")))
    beside = kinds.repartition("doc").sortWithinPartitions("doc", "kind", "pos").mapInArrow(
        _contexts(k, SKIP + least - max(least - 2 * (window - 1), k)), WINDOWS)
    # one run meets a document through several seeds
    again = stored(_meet(beside).select("doc", "source", "pos", "at").distinct(), "passage-matches")
    return _longest(found.unionByName(_passages(docs, again, k, least, share, fewest=1)))


def _holders(runs: DataFrame) -> DataFrame:
    """Runs that are open in a document which is not the first to have them, with those of the documents before it."""
    shared = runs.groupBy("hash").agg(F.min("doc").alias("first"), F.max(F.when(F.col("open"), F.col("doc"))).alias("last")).where("last > first")
    is_open = F.col("open") & (F.col("doc") > F.col("first"))
    return runs.join(shared, "hash").where(is_open | (F.col("doc") < F.col("last"))).select("hash", "doc", "pos", "stop", is_open.alias("open"))


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _longest(passages: DataFrame) -> DataFrame:
    """Of passages of a pair that begin or end at one place, the longest."""
    pair = ["doc_id", "source_doc_id"]
    rest = [c for c in passages.columns if c not in pair]
    best = F.max_by(F.struct(*rest), F.struct(F.col("end_word") - F.col("start_word"), "similarity", "start_word", "source_start"))
    for end in ("start_word", "end_word"):
        passages = passages.groupBy(*pair, end).agg(best.alias("m")).select(*pair, *(F.col(f"m.{c}").alias(c) for c in rest))
    return passages


_WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space that ran between them."""
    data = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(data)]
    kept, at = [], 0
    for start, end in sorted(spans):
        start, end = min(start, len(places)), min(end, len(places))
        if start >= end:
            continue
        kept.append(data[at:max(at, places[start][0])])
        at = max(at, places[end][0] if end < len(places) else len(data))
    kept.append(data[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def without_repeats(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """The documents without their repeated passages; one that consists of them goes; all columns stay.

    A document's spans are bounded by its own length.  ``n_chars``, where there is one, is counted anew.
    """
    key, own = fresh(docs, "_id"), fresh(docs, "_spans")
    spans = passages.groupBy(F.col("doc_id").alias(key)).agg(F.collect_set(F.struct("start_word", "end_word")).alias(own))
    joined = docs.join(spans, docs["doc_id"].cast("long") == spans[key], "left").drop(key)
    at, names = docs.columns.index("text"), docs.columns

    def cut(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        spans = batch.column(batch.num_columns - 1).to_pylist()
        columns, keep = list(batch.columns[:-1]), np.ones(batch.num_rows, bool)
        changed = [i for i, own in enumerate(spans) if own and texts[i]]
        if changed:
            held = columns[at].to_pylist()
            sizes = columns[names.index("n_chars")].to_pylist() if "n_chars" in names else None
            for i in changed:
                held[i] = cut_words(texts[i], [(s["start_word"], s["end_word"]) for s in spans[i]])
                keep[i] = bool(held[i].strip())
                if sizes is not None:
                    sizes[i] = len(held[i])
            columns[at] = pa.array(held, columns[at].type)
            if sizes is not None:
                columns[names.index("n_chars")] = pa.array(sizes, columns[names.index("n_chars")].type)
        return pa.RecordBatch.from_arrays(columns, names).filter(pa.array(keep))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, at):
                yield cut(part, texts)

    return joined.mapInArrow(run, docs.schema)


def op1_passages(spark, sf_dir: str) -> DataFrame:
    return repeats(read(spark, sf_dir, "documents"))
