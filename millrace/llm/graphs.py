"""Hierarchical navigable small-world graphs over one shard of unit vectors.

Searches and insertions run for a batch of vectors at a time: a step expands the
best open nodes of every beam in the batch with a few array operations.
"""

import io

import numpy as np

#: Neighbours of a node on upper levels (twice as many on the lowest); beam of insertions.
DEGREE, BUILD_BEAM = 16, 64
#: Vectors searched or inserted together.
BATCH = 256


def _spread(near: np.ndarray, sims: np.ndarray, vectors: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's candidates, best first, those nearer to the row than to any kept
    one; free places go to the best of the rest. -1 is no candidate."""
    rows, width = near.shape
    own = vectors[near]
    between = np.matmul(own, own.transpose(0, 2, 1))
    taken = np.zeros((rows, width), bool)
    closest = np.full((rows, width), -np.inf, np.float32)
    for c in range(width):
        good = (near[:, c] >= 0) & (sims[:, c] > closest[:, c]) & (taken.sum(axis=1) < keep)
        taken[:, c] = good
        closest = np.where(good[:, None], np.maximum(closest, between[:, :, c]), closest)
    order = np.argsort(np.where(taken, 0, np.where(near >= 0, 1, 2)), axis=1, kind="stable")[:, :keep]
    chosen = np.take_along_axis(near, order, axis=1)
    if chosen.shape[1] < keep:
        chosen = np.pad(chosen, ((0, 0), (0, keep - chosen.shape[1])), constant_values=-1)
    return chosen


class Graph:
    def __init__(self, vectors: np.ndarray, levels: np.ndarray, links: list[np.ndarray], entry: int) -> None:
        self.vectors, self.levels, self.links, self.entry = vectors, levels, links, entry

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 0) -> "Graph":
        n = len(vectors)
        random = np.random.default_rng(seed)
        levels = (-np.log(1 - random.random(n)) / np.log(DEGREE)).astype(int)
        top = int(levels.max(initial=0))
        links = [np.full((n, DEGREE * (1 if level else 2)), -1, np.int32) for level in range(top + 1)]
        entry = int(np.argmax(levels)) if n else -1
        graph = cls(vectors, levels, links, entry)
        order = np.concatenate([[entry], np.delete(np.arange(n), entry)]) if n else np.arange(0)
        start, size = 1, 1
        while start < n:
            graph._insert(order[start : start + size])
            start, size = start + size, min(2 * size, BATCH)
        return graph

    def _insert(self, new: np.ndarray) -> None:
        queries = self.vectors[new]
        at = np.full(len(new), self.entry)
        among = queries @ queries.T
        np.fill_diagonal(among, -np.inf)
        for level in range(len(self.links) - 1, -1, -1):
            rows = np.flatnonzero(self.levels[new] >= level)
            others = np.flatnonzero(self.levels[new] < level)
            if len(others):
                at[others] = self._beam(queries[others], at[others], 1, level)[0][:, 0]
            if not len(rows):
                continue
            near, sims = self._beam(queries[rows], at[rows], BUILD_BEAM, level)
            at[rows] = near[:, 0]
            # the batch itself is not in the graph yet: its members are candidates too
            peers = among[np.ix_(rows, rows)]
            best = np.argsort(-peers, axis=1)[:, :DEGREE]
            near = np.concatenate([near, new[rows][best]], axis=1)
            sims = np.concatenate([sims, np.take_along_axis(peers, best, axis=1)], axis=1)
            near = np.where(np.isfinite(sims), near, -1)
            order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
            near, sims = np.take_along_axis(near, order, axis=1), np.take_along_axis(sims, order, axis=1)
            chosen = _spread(near, sims, self.vectors, DEGREE)
            self.links[level][new[rows], :DEGREE] = chosen
            self._link_back(level, np.repeat(new[rows], DEGREE), chosen.reshape(-1))

    def _link_back(self, level: int, new: np.ndarray, to: np.ndarray) -> None:
        new, to = new[to >= 0], to[to >= 0]
        order = np.argsort(to, kind="stable")
        new, to = new[order], to[order]
        nodes, first, counts = np.unique(to, return_index=True, return_counts=True)
        links = self.links[level]
        added = np.full((len(nodes), int(counts.max(initial=0))), -1, np.int32)
        added[np.repeat(np.arange(len(nodes)), counts), np.arange(len(to)) - np.repeat(first, counts)] = new
        near = np.sort(np.concatenate([links[nodes], added], axis=1), axis=1)[:, ::-1]
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        for start in range(0, len(nodes), BATCH):
            part, own = near[start : start + BATCH], nodes[start : start + BATCH]
            sims = np.einsum("bcd,bd->bc", self.vectors[part], self.vectors[own])
            sims = np.where(part >= 0, sims, -np.inf)
            order = np.argsort(-sims, axis=1, kind="stable")
            part, sims = np.take_along_axis(part, order, axis=1), np.take_along_axis(sims, order, axis=1)
            width = max(links.shape[1], int((part >= 0).sum(axis=1).max(initial=0)))
            links[own] = _spread(part[:, :width], sims[:, :width], self.vectors, links.shape[1])

    def _beam(self, queries: np.ndarray, at: np.ndarray, beam: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` nodes met from ``at``, best first; -1 where there are fewer."""
        rows = len(queries)
        ids = np.full((rows, beam), -1, np.int64)
        sims = np.full((rows, beam), -np.inf, np.float32)
        done = np.ones((rows, beam), bool)
        ids[:, 0], done[:, 0] = at, False
        sims[:, 0] = np.einsum("bd,bd->b", self.vectors[at], queries)
        seen = np.zeros((rows, len(self.vectors)), bool)
        seen[np.arange(rows), at] = True
        at_once = max(1, beam // 16)
        live = np.arange(rows)
        while len(live):
            waiting = ~done[live]
            rank = np.cumsum(waiting, axis=1)
            chosen = waiting & (rank <= at_once)
            done[live] |= chosen
            slot = np.where(chosen, rank, at_once + 1).argsort(axis=1, kind="stable")[:, :at_once]
            taken = np.take_along_axis(chosen, slot, axis=1)
            expanded = np.where(taken, np.take_along_axis(ids[live], slot, axis=1), -1)
            near = np.where(expanded[:, :, None] >= 0, self.links[level][expanded], -1).reshape(len(live), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near = np.where(seen[live[:, None], near] & (near >= 0), -1, near)
            row, column = np.nonzero(near >= 0)
            seen[live[row], near[row, column]] = True
            found = np.full(near.shape, -np.inf, np.float32)
            found[row, column] = np.einsum("pd,pd->p", self.vectors[near[row, column]], queries[live[row]])
            all_ids = np.concatenate([ids[live], near], axis=1)
            all_sims = np.concatenate([sims[live], found], axis=1)
            all_done = np.concatenate([done[live], near < 0], axis=1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[live] = np.take_along_axis(all_ids, order, axis=1)
            sims[live] = np.take_along_axis(all_sims, order, axis=1)
            done[live] = np.take_along_axis(all_done, order, axis=1)
            live = live[~done[live].all(axis=1)]
        return np.where(np.isfinite(sims), ids, -1), sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``beam`` vectors found for each query, and their cosines."""
        at = np.full(len(queries), self.entry)
        for level in range(len(self.links) - 1, 0, -1):
            at = self._beam(queries, at, 1, level)[0][:, 0]
        return self._beam(queries, at, beam, 0)

    def above(self, queries: np.ndarray, least: float, beam: int):
        """Yields (query rows, ids, cosines) of what is found at ``least`` or more.

        A query whose whole beam is that near is searched again with twice the beam.
        """
        for start in range(0, len(queries), BATCH):
            rows, wide = np.arange(start, min(len(queries), start + BATCH)), beam
            while len(rows):
                wide = min(wide, len(self.vectors))
                step = max(1, BATCH * 256 // max(256, wide))
                full = []
                for part in range(0, len(rows), step):
                    some = rows[part : part + step]
                    ids, sims = self.search(queries[some], wide)
                    more = (sims[:, -1] >= least) & (wide < len(self.vectors))
                    full.append(some[more])
                    row, column = np.nonzero((sims >= least) & ~more[:, None])
                    yield some[row], ids[row, column], sims[row, column]
                rows, wide = np.concatenate(full), 2 * wide

    def to_bytes(self) -> bytes:
        buffer = io.BytesIO()
        parts = {f"links{level}": table for level, table in enumerate(self.links)}
        np.savez(buffer, vectors=self.vectors, levels=self.levels, entry=self.entry, **parts)
        return buffer.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> "Graph":
        parts = np.load(io.BytesIO(data))
        links = [parts[f"links{level}"] for level in range(len(parts.files) - 3)]
        return cls(parts["vectors"], parts["levels"], links, int(parts["entry"]))


def audited_beam(graph: Graph, least: float, beam: int, sample: int, recall: float) -> int:
    """A beam that finds ``recall`` of the near pairs of the sampled vectors.

    The sample, spread evenly over the shard, is compared with every vector by brute
    force; the beam doubles until enough of those pairs are found. A beam as wide as
    the shard that still misses some means that nodes can't be reached: 0.
    """
    n = len(graph.vectors)
    rows = np.unique(np.linspace(0, max(0, n - 1), min(n, sample)).astype(int))
    queries = graph.vectors[rows]
    truth = int((queries @ graph.vectors.T >= least).sum())
    while True:
        found = sum(len(ids) for _, ids, _ in graph.above(queries, least, min(beam, max(1, n))))
        if found >= recall * truth:
            return min(beam, max(1, n))
        if beam >= n:
            return 0
        beam *= 2
