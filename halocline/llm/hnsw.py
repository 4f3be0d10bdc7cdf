"""A hierarchical navigable small-world graph over unit vectors, built and searched for many queries at once.

Layers are built from the top down.  A layer's nodes come in batches that double in
size; each batch searches what is there, from entries found in the layer above, and
its nodes are linked to diverse near neighbours and back.
"""

from __future__ import annotations

import numpy as np

M, M_BASE, EF_BUILD, BATCH = 12, 24, 48, 512
TOP = 64
EXPAND = 4


class Layer:
    """Nodes of one layer and their neighbour lists (-1: none)."""

    def __init__(self, vectors: np.ndarray, degree: int):
        self.x = vectors
        self.degree = degree
        self.near = np.full((len(vectors), degree), -1, np.int32)

    def search(self, q: np.ndarray, entries: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities), best first, of up to ``ef`` nodes for each query; -1 where there are fewer."""
        n = len(q)
        rows = np.arange(n)[:, None]
        seen = np.zeros((n, len(self.x) + 1), bool)
        ids = entries.astype(np.int64)
        sims = np.where(ids >= 0, np.einsum("bd,bkd->bk", q, self.x[ids]), -np.inf)
        seen[rows, ids] = True
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1)[:, :ef], np.take_along_axis(sims, order, 1)[:, :ef]
        done = ids < 0
        while True:
            open_sims = np.where(done, -np.inf, sims)
            pick = np.argsort(-open_sims, axis=1, kind="stable")[:, :EXPAND]
            live = np.take_along_axis(open_sims, pick, 1) > -np.inf
            active = np.flatnonzero(live.any(axis=1))
            if not len(active):
                return ids, sims
            np.put_along_axis(done, pick, True, 1)
            nodes = np.where(live, np.take_along_axis(ids, pick, 1), -1)[active]
            near = np.where((nodes >= 0)[:, :, None], self.near[nodes], -1).reshape(len(active), -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            at = active[:, None]
            near[seen[at, near]] = -1
            seen[at, near] = True
            seen[:, -1] = False
            new = np.where(near >= 0, np.einsum("bd,bkd->bk", q[active], self.x[near]), -np.inf).astype(np.float32)
            width = ids.shape[1]
            all_ids = np.concatenate([ids[active], near], axis=1)
            all_sims = np.concatenate([sims[active], new], axis=1)
            all_done = np.concatenate([done[active], near < 0], axis=1)
            keep = min(ef, all_ids.shape[1])
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :keep]
            if keep > width:
                grow = ((0, 0), (0, keep - width))
                ids = np.pad(ids, grow, constant_values=-1)
                sims = np.pad(sims, grow, constant_values=-np.inf)
                done = np.pad(done, grow, constant_values=True)
            ids[active, :keep] = np.take_along_axis(all_ids, order, 1)
            sims[active, :keep] = np.take_along_axis(all_sims, order, 1)
            done[active, :keep] = np.take_along_axis(all_done, order, 1)

    def diverse(self, of: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> np.ndarray:
        """Up to ``degree`` of each row's candidates, best first: those nearer to the node than to what is chosen;
        free places go to the best of the rest."""
        n, width = ids.shape
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        chosen = np.zeros((n, width), bool)
        closest = np.full((n, width), -np.inf, np.float32)  # of each candidate to what is chosen
        count = np.zeros(n, int)
        cand = self.x[ids]
        among = np.matmul(cand, cand.transpose(0, 2, 1))
        fits = (ids >= 0) & (ids != of[:, None])
        for c in range(width):
            take = fits[:, c] & (sims[:, c] > closest[:, c]) & (count < self.degree)
            chosen[:, c] = take
            count += take
            np.maximum(closest, among[:, c], out=closest, where=take[:, None])
        rank = np.where(chosen, 0, 1) + np.where((ids < 0) | (ids == of[:, None]), 2, 0)
        order = np.argsort(rank, axis=1, kind="stable")[:, :self.degree]
        out = np.take_along_axis(np.where((ids < 0) | (ids == of[:, None]), -1, ids), order, 1)
        return np.pad(out, ((0, 0), (0, self.degree - out.shape[1])), constant_values=-1)

    def link(self, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        """Links nodes to diverse candidates, and the chosen ones back."""
        out = self.diverse(nodes, ids, sims)
        self.near[nodes] = out
        to, source = out.ravel(), np.repeat(nodes, out.shape[1])
        good = to >= 0
        to, source = to[good], source[good]
        value = np.einsum("kd,kd->k", self.x[to], self.x[source])
        order = np.lexsort((-value, to))
        to, source = to[order], source[order]
        begin = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.empty(0, int)
        place = np.arange(len(to)) - np.repeat(begin, np.diff(np.r_[begin, len(to)]))
        own = to[begin]
        more = np.full((len(own), self.degree), -1, np.int64)
        fits = place < more.shape[1]
        more[np.repeat(np.arange(len(own)), np.diff(np.r_[begin, len(to)]))[fits], place[fits]] = source[fits]
        every = np.concatenate([self.near[own].astype(np.int64), more], axis=1)
        every.sort(axis=1)
        every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
        every = -np.sort(-every, axis=1)  # free places last
        room = (every >= 0).sum(axis=1) <= self.degree
        self.near[own[room]] = every[room, :self.degree]
        own, every = own[~room], every[~room]
        for at in range(0, len(own), BATCH):
            part, near = own[at:at + BATCH], every[at:at + BATCH]
            s = np.where(near >= 0, np.einsum("bd,bkd->bk", self.x[part], self.x[near]), -np.inf)
            self.near[part] = self.diverse(part, near, s)


class Hnsw:
    """The graph of one shard; node numbers are row numbers of ``vectors`` (unit length)."""

    def __init__(self, vectors: np.ndarray, seed: int = 0):
        self.x = np.ascontiguousarray(vectors, np.float32)
        n = len(vectors)
        shuffled = np.random.default_rng(seed).permutation(n)
        sizes = [n]
        while sizes[-1] > TOP:
            sizes.append(max(1, sizes[-1] // M))
        self.members = [shuffled[:s] for s in sizes]  # of each layer, from the base; each holds the one above
        self.layers: list[Layer] = []  # from the top
        for s, level in zip(sizes[::-1], range(len(sizes) - 1, -1, -1), strict=True):
            layer = Layer(self.x[shuffled[:s]], M_BASE if level == 0 else M)
            start = min(s, TOP)
            every = np.broadcast_to(np.arange(start), (start, start))
            layer.link(np.arange(start), every, layer.x[:start] @ layer.x[:start].T)
            self.layers.append(layer)
            while start < s:
                batch = np.arange(start, min(s, start + min(BATCH, start)))
                q = layer.x[batch]
                entries = self._entries(q, len(self.layers) - 1, start)
                ids, sims = layer.search(q, entries, EF_BUILD)
                mates = q @ q.T
                ids = np.concatenate([ids, np.broadcast_to(batch, (len(batch), len(batch)))], axis=1)
                sims = np.concatenate([sims, mates], axis=1)
                best = np.argsort(-sims, axis=1, kind="stable")[:, :EF_BUILD]
                layer.link(batch, np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1))
                start = batch[-1] + 1

    def _entries(self, q: np.ndarray, layers: int, below: int | None = None) -> np.ndarray:
        """Nodes near each query, found through the given number of layers from the top."""
        if layers == 0:
            n = min(TOP, below if below is not None else TOP, len(self.layers[0].x))
            return np.broadcast_to(np.arange(n), (len(q), n))
        entries = np.broadcast_to(np.arange(len(self.layers[0].x)), (len(q), len(self.layers[0].x)))
        for layer in self.layers[:layers]:
            entries = layer.search(q, entries, 8)[0]
        return entries

    def search(self, q: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, similarities) of up to ``ef`` near vectors of each query, best first."""
        q = np.ascontiguousarray(q, np.float32)
        ids, sims = self.layers[-1].search(q, self._entries(q, len(self.layers) - 1), ef)
        return np.where(ids >= 0, self.members[0][ids], -1), sims
