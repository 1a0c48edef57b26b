"""Hierarchical navigable small-world graphs over vectors of length one, searched many at a time."""

from __future__ import annotations

import numpy as np

M, M0, BEAM = 12, 24, 48
_BLOCK = 512


def _dots(vectors: np.ndarray, near: np.ndarray, queries: np.ndarray) -> np.ndarray:
    return np.matmul(vectors[near], queries[:, :, None])[:, :, 0]


def beam_search(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest that each query reaches from its entry, nearest first; -1 for none.

    All queries take a step at a time: each opens the nearest node of its beam not opened so far.
    """
    q = len(queries)
    rows = np.arange(q)
    seen = np.zeros((q, len(vectors)), bool)
    seen[rows, entry] = True
    ids = np.full((q, width), -1, np.int64)
    near = np.full((q, width), -np.inf, np.float32)
    ids[:, 0], near[:, 0] = entry, np.einsum("qd,qd->q", vectors[entry], queries)
    shut = np.ones((q, width), bool)
    shut[:, 0] = False
    while True:
        waiting = np.where(shut, -np.inf, near)
        pick = waiting.argmax(1)
        r = np.flatnonzero(waiting[rows, pick] > -np.inf)
        if not len(r):
            break
        node = ids[r, pick[r]]
        shut[r, pick[r]] = True
        found = links[node]
        new = found >= 0
        found = np.where(new, found, 0)
        new &= ~seen[r[:, None], found]
        at = np.nonzero(new)
        seen[r[at[0]], found[at]] = True
        value = np.where(new, _dots(vectors, found, queries[r]), -np.inf).astype(np.float32)
        every = np.concatenate([near[r], value], 1)
        top = np.argpartition(-every, width - 1, axis=1)[:, :width]
        near[r] = np.take_along_axis(every, top, 1)
        ids[r] = np.take_along_axis(np.concatenate([ids[r], found], 1), top, 1)
        shut[r] = np.take_along_axis(np.concatenate([shut[r], ~new], 1), top, 1)
    order = np.argsort(-near, axis=1, kind="stable")
    near = np.take_along_axis(near, order, 1)
    return np.where(near > -np.inf, np.take_along_axis(ids, order, 1), -1), near


def spread_out(vectors: np.ndarray, found: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of candidates, nearest first, those nearer to the node than to any chosen before; then the rest."""
    between = np.matmul(vectors[found], vectors[found].transpose(0, 2, 1))
    usable = near > -np.inf
    chosen = np.zeros(found.shape, bool)
    for t in range(found.shape[1]):
        closest = np.where(chosen, between[:, t], -np.inf).max(1)
        chosen[:, t] = usable[:, t] & (near[:, t] >= closest) & (chosen.sum(1) < most)
    rank = np.where(usable, np.where(chosen, 0, 1), 2) * found.shape[1] + np.arange(found.shape[1])
    order = np.argsort(rank, axis=1)[:, :most]
    out = np.where(np.take_along_axis(usable, order, 1), np.take_along_axis(found, order, 1), -1)
    if out.shape[1] < most:
        out = np.concatenate([out, np.full((len(out), most - out.shape[1]), -1)], 1)
    return out


class Graph:
    """``links[level][node]``; a node of a level is in all levels below it too."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, links: list[np.ndarray]):
        self.vectors, self.levels, self.links = vectors, levels, links
        self.top = int(levels.argmax()) if len(levels) else 0

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 1) -> Graph:
        """Nodes join in batches of doubling size, from the top level down.

        A batch looks for its neighbours in the graph so far and, exactly, among itself.
        """
        n = len(vectors)
        draws = np.random.default_rng(seed).random(n)
        levels = np.floor(-np.log(np.maximum(draws, 1e-12)) / np.log(M)).astype(np.int64)
        depth = int(levels.max()) + 1 if n else 1
        links = [np.full((n, M0 if k == 0 else M), -1, np.int32) for k in range(depth)]
        graph = cls(vectors, levels, links)
        for level in range(depth - 1, -1, -1):
            nodes = np.flatnonzero(levels >= level)
            nodes = nodes[np.argsort(-levels[nodes], kind="stable")]
            done, size = 0, 256
            while done < len(nodes):
                graph._join(level, nodes[:done], nodes[done : done + size])
                done += size
                size = done
        return graph

    def _join(self, level: int, before: np.ndarray, batch: np.ndarray) -> None:
        links, most = self.links[level], self.links[level].shape[1]
        rows, found, near = [], [], []
        for start in range(0, len(batch), _BLOCK):
            own = batch[start : start + _BLOCK]
            queries = self.vectors[own]
            among = queries @ self.vectors[batch].T
            among[np.arange(len(own)), start + np.arange(len(own))] = -np.inf
            k = min(BEAM, len(batch))
            top = np.argpartition(-among, k - 1, axis=1)[:, :k]
            ids, value = batch[top], np.take_along_axis(among, top, 1)
            if len(before):
                entry = self._descend(queries, level, before[0])
                more, far = beam_search(self.vectors, links, queries, entry, BEAM)
                ids, value = np.concatenate([ids, more], 1), np.concatenate([value, far], 1)
            order = np.argsort(-value, axis=1, kind="stable")[:, :BEAM]
            ids, value = np.take_along_axis(ids, order, 1), np.take_along_axis(value, order, 1)
            chosen = spread_out(self.vectors, np.where(value > -np.inf, ids, 0), value, most)
            rows.append(np.repeat(own, most))
            found.append(chosen.reshape(-1))
        rows, found = np.concatenate(rows), np.concatenate(found)
        rows, found = rows[found >= 0], found[found >= 0]
        links[batch] = -1
        self._add(level, np.concatenate([rows, found]), np.concatenate([found, rows]))

    def _add(self, level: int, rows: np.ndarray, found: np.ndarray) -> None:
        """Links in addition; a node with too many keeps those that are spread out."""
        links = self.links[level]
        most = links.shape[1]
        touched = np.unique(rows)
        old = links[touched]
        rows = np.concatenate([rows, np.repeat(touched, most)])
        found = np.concatenate([found, old.reshape(-1)])
        pair = np.unique(rows[found >= 0] * np.int64(len(self.vectors)) + found[found >= 0])
        rows, found = np.divmod(pair, np.int64(len(self.vectors)))
        near = np.einsum("nd,nd->n", self.vectors[rows], self.vectors[found])
        order = np.lexsort((-near, rows))
        rows, found, near = rows[order], found[order], near[order]
        first = np.searchsorted(rows, touched)
        place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
        keep = place < 3 * most
        rows, found, near, place = rows[keep], found[keep], near[keep], place[keep]
        at = np.searchsorted(touched, rows)
        for start in range(0, len(touched), _BLOCK):
            stop = min(start + _BLOCK, len(touched))
            inside = (at >= start) & (at < stop)
            width = int(place[inside].max()) + 1 if inside.any() else 1
            ids = np.zeros((stop - start, width), np.int64)
            value = np.full((stop - start, width), -np.inf, np.float32)
            ids[at[inside] - start, place[inside]] = found[inside]
            value[at[inside] - start, place[inside]] = near[inside]
            links[touched[start:stop]] = spread_out(self.vectors, ids, value, most)

    def _descend(self, queries: np.ndarray, level: int, top: int) -> np.ndarray:
        """The nearest node above ``level`` for each query, where the search begins."""
        entry = np.full(len(queries), top)
        for k in range(len(self.links) - 1, level, -1):
            ids, _ = beam_search(self.vectors, self.links[k], queries, entry, 1)
            entry = ids[:, 0]
        return entry

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and nearness of the ``width`` best found for each query."""
        width = min(width, len(self.vectors))
        parts = []
        for start in range(0, len(queries), _BLOCK):
            own = queries[start : start + _BLOCK]
            parts.append(beam_search(self.vectors, self.links[0], own, self._descend(own, 0, self.top), width))
        if not parts:
            return np.zeros((0, width), np.int64), np.zeros((0, width), np.float32)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
