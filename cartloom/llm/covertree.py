"""Cover tree for inner products over a bounded block of vectors, in numpy.

Vectors are augmented by sqrt(M^2 - |x|^2), M the largest norm of the block, so that all have norm M and an inner product
with a query (whose extra component is 0) is fixed by a distance. Level k is a net: centres farther than r / 2^k from each
other that come within r / 2^k of every vector; it contains the net above, and each new centre hangs below the nearest
centre of the level above. A node keeps the true covering radius of what hangs below it. Levels that add no centre are left
out; equal vectors share a leaf.
"""

from __future__ import annotations

import numpy as np

MAX_LEVELS = 48
BATCH = 32
LIMIT = 9.2e18


def _net(distance: np.ndarray, centres: list[int], nearest: np.ndarray, radius: float) -> np.ndarray:
    """Extend ``centres`` until every row has one within ``radius``; ``nearest`` holds distances to the closest one."""
    while True:
        far = int(np.argmax(nearest))
        if nearest[far] <= radius:
            return nearest
        centres.append(far)
        nearest = np.minimum(nearest, distance[far])


class CoverTree:
    """Node arrays: centre row, radius, first child and number of children; children of leaves are places in ``order``."""

    FIELDS = ("vectors", "ids", "labels", "centre", "radius", "first", "count", "leaf", "order")

    def __init__(self, **arrays: np.ndarray):
        for name in self.FIELDS:
            setattr(self, name, arrays[name])
        self.vectors = self.vectors.astype(np.float64)
        norms = np.einsum("ij,ij->i", self.vectors, self.vectors)
        self.most = float(norms.max()) if len(norms) else 0.0

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> CoverTree:
        v = vectors.astype(np.float64)
        n = len(v)
        norms = np.einsum("ij,ij->i", v, v)
        most = norms.max()
        extra = np.sqrt(most - norms)
        distance = np.sqrt(np.maximum(norms[:, None] + norms[None, :] - 2.0 * (v @ v.T) + (extra[:, None] - extra[None, :]) ** 2, 0.0))
        # Equal vectors stand behind the first of them; rounding must not tell them apart, or unequal ones together.
        _, first_of, twin = np.unique(v, axis=0, return_index=True, return_inverse=True) if v.shape[1] else (None, np.zeros(1, int), np.zeros(n, int))
        stand = first_of[np.ravel(twin)]
        root = int(stand[0])
        slack = 1e-4 * np.sqrt(most) + 1e-9
        distinct = np.unique(stand)
        reach = np.zeros(n)
        reach[distinct] = distance[root, distinct]
        centres, nets, nearest = [root], [[root]], reach
        radius = float(nearest.max()) / 2
        for _ in range(MAX_LEVELS):
            if len(centres) == len(distinct) or radius <= slack:
                break
            before = len(centres)
            masked = np.where(np.isin(np.arange(n), distinct), nearest, 0.0)
            nearest = _net(distance, centres, masked, radius)
            if len(centres) > before:
                nets.append(list(centres))
            radius /= 2
        if len(nets) == 1 or len(nets[-1]) < len(distinct):
            nets.append(centres + sorted(set(distinct.tolist()) - set(centres)))
        # Parents of new centres, then who stands above every row at each level.
        owner = [None] * len(nets)
        owner[-1] = stand
        for level in range(len(nets) - 2, -1, -1):
            net = np.array(nets[level])
            up = np.arange(n)
            fresh = np.array(nets[level + 1][len(net):], dtype=int)
            if len(fresh):
                up[fresh] = net[np.argmin(distance[fresh][:, net], axis=1)]
            owner[level] = up[owner[level + 1]]
        centre, radii, first, count, leaf = [], [], [], [], []
        start, order = 0, None
        for level, net in enumerate(nets):
            rows = np.array(net)
            last = level == len(nets) - 1
            if level:
                # Children of one parent stand together, parents in the order of their own level.
                place = np.empty(n, dtype=int)
                place[above_rows] = np.arange(len(above_rows))
                rows = rows[np.argsort(place[owner[level - 1][rows]], kind="stable")]
                counts = np.bincount(place[owner[level - 1][rows]], minlength=len(above_rows))
                count.append(counts)
                first.append(start + np.concatenate([[0], np.cumsum(counts)[:-1]]))
            reach = np.zeros(n)
            np.maximum.at(reach, owner[level], distance[owner[level], np.arange(n)])
            centre.append(rows)
            radii.append(np.where(last, 0.0, reach[rows] * (1 + 1e-6) + slack))
            leaf.append(np.full(len(rows), last))
            start, above_rows = start + len(rows), rows
        place = np.empty(n, dtype=int)
        place[above_rows] = np.arange(len(above_rows))
        order = np.argsort(place[stand], kind="stable")
        counts = np.bincount(place[stand], minlength=len(above_rows))
        count.append(counts)
        first.append(np.concatenate([[0], np.cumsum(counts)[:-1]]))
        join = np.concatenate
        return cls(
            vectors=vectors, ids=ids, labels=labels, centre=join(centre), radius=join(radii), first=join(first), count=join(count),
            leaf=join(leaf), order=order,
        )

    def _below(self, nodes: np.ndarray) -> np.ndarray:
        counts = self.count[nodes]
        shift = np.repeat(self.first[nodes] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        return shift + np.arange(int(counts.sum()))

    def descend(self, query: np.ndarray, wanted: np.ndarray, windows: list[Window]) -> int:
        """Offer the rows flagged in ``wanted`` to the windows, best upper bound first; returns the vectors looked at.

        Nodes whose bounds lie outside every window, or below what a full window already holds, are skipped.
        """
        here = float(query @ query)
        length, slack, looked = np.sqrt(here), 1e-7 * (here + self.most) + 0.01, 0
        nodes, upper, lower = np.array([0]), np.array([np.inf]), np.array([-np.inf])
        high = np.array([w.high for w in windows])
        while len(nodes):
            least = np.array([w.least() for w in windows])
            alive = ((upper[:, None] >= least) & (lower[:, None] <= high)).any(axis=1)
            nodes, upper, lower = nodes[alive], upper[alive], lower[alive]
            if not len(nodes):
                break
            turn = np.argsort(-np.minimum(upper, high.max()), kind="stable")
            now, later = turn[:BATCH], turn[BATCH:]
            below = self._below(nodes[now])
            scores = self.vectors[self.centre[below]] @ query
            looked += len(below)
            ends = self.leaf[below]
            if ends.any():
                leaves = below[ends]
                rows = self.order[self._below(leaves)]
                told = np.repeat(scores[ends], self.count[leaves])
                keep = wanted[rows]
                rows, told = rows[keep], told[keep]
                for w in windows:
                    w.offer(told, self.ids[rows])
            inner = below[~ends]
            s, r = scores[~ends], self.radius[inner]
            away = np.sqrt(np.maximum(here + self.most - 2.0 * s, 0.0))
            up = np.minimum(s + length * r, (here + self.most - np.maximum(away - r, 0.0) ** 2) / 2) + slack
            low = np.maximum(s - length * r, (here + self.most - (away + r) ** 2) / 2) - slack
            nodes = np.concatenate([nodes[later], inner])
            upper, lower = np.concatenate([upper[later], up]), np.concatenate([lower[later], low])
        return looked

    def pack(self) -> dict[str, bytes]:
        """Fields as bytes; vectors in the narrowest type that holds them."""
        size = np.abs(self.vectors).max() if self.vectors.size else 0
        kind = np.int16 if size < 32768 else np.float64
        out = {"vectors": (b"h" if kind is np.int16 else b"d") + self.vectors.astype(kind).tobytes()}
        kinds = dict(ids=np.int64, labels=np.int64, centre=np.int32, radius=np.float64, first=np.int32, count=np.int32, leaf=np.bool_, order=np.int32)
        return out | {name: getattr(self, name).astype(k).tobytes() for name, k in kinds.items()}

    @classmethod
    def unpack(cls, packed: dict[str, bytes], dim: int) -> CoverTree:
        kinds = dict(ids=np.int64, labels=np.int64, centre=np.int32, radius=np.float64, first=np.int32, count=np.int32, leaf=np.bool_, order=np.int32)
        arrays = {name: np.frombuffer(packed[name], dtype=k) for name, k in kinds.items()}
        raw = packed["vectors"]
        kind = np.int16 if raw[:1] == b"h" else np.float64
        arrays["vectors"] = np.frombuffer(raw[1:], dtype=kind).reshape(len(arrays["ids"]), dim)
        return cls(**arrays)


class Window:
    """The first ``k`` (score, id) pairs with low <= score <= high: higher scores first, ties by smaller id."""

    def __init__(self, low: float, high: float, k: int):
        self.low, self.high, self.k = low, high, k
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)

    def least(self) -> float:
        return self.low if len(self.scores) < self.k else max(self.low, self.scores[-1])

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.least()) & (scores <= self.high)
        if not fits.any():
            return
        s, i = np.concatenate([self.scores, scores[fits]]), np.concatenate([self.ids, ids[fits]])
        turn = np.lexsort((i, -s))
        s, i = s[turn], i[turn]
        new = np.ones(len(s), dtype=bool)
        new[1:] = (s[1:] != s[:-1]) | (i[1:] != i[:-1])
        self.scores, self.ids = s[new][: self.k], i[new][: self.k]

    def exact(self) -> np.ndarray:
        return np.clip(self.scores, -LIMIT, LIMIT).astype(np.int64)
