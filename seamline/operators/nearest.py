"""The nearest of a group's segments for many points, by lists for square cells."""

from __future__ import annotations

import numpy as np

#: Distances that are held at once.
AT_ONCE = 1 << 20
_HALF = 1 << 20


class Nearest:
    """Segments (n, 2, 2) in groups. A cell's list has those at most its diagonal farther from its centre than the nearest one,
    so that it holds the nearest segments of each of its points. Lists are made when first asked for and kept."""

    def __init__(self, groups: list[np.ndarray]):
        self.first = np.concatenate([[0], np.cumsum([len(g) for g in groups])]).astype(int)
        all_ = np.concatenate([np.asarray(g, float).reshape(-1, 2, 2) for g in groups])
        self.start, self.run = all_[:, 0], all_[:, 1] - all_[:, 0]
        self.square = np.maximum((self.run * self.run).sum(1), 1e-9)
        spread = [max(float(np.ptp(g.reshape(-1, 2), axis=0).max()), 1e-6) for g in (np.asarray(g, float) for g in groups)]
        self.size = np.array([s / max(np.sqrt(len(g)), 1.0) for s, g in zip(spread, groups, strict=True)])
        self.codes, self.at, self.count, self.flat = np.empty(0, np.int64), np.empty(0, int), np.empty(0, int), np.empty(0, int)

    def away(self, x: np.ndarray, y: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Distances of points to the segments ``k``; all broadcast."""
        ax, ay, dx, dy = self.start[k, 0], self.start[k, 1], self.run[k, 0], self.run[k, 1]
        u = np.clip(((x - ax) * dx + (y - ay) * dy) / self.square[k], 0.0, 1.0)
        ox, oy = x - (ax + u * dx), y - (ay + u * dy)
        return np.sqrt(ox * ox + oy * oy)

    def _learn(self, codes: np.ndarray) -> None:
        flat, count = [self.flat], []
        group, ij = codes >> 42, np.stack([(codes >> 21) & (2 * _HALF - 1), codes & (2 * _HALF - 1)], 1) - _HALF
        for g in np.unique(group):
            mine, k = ij[group == g], np.arange(self.first[g], self.first[g + 1])
            mid, size = (mine + 0.5) * self.size[g], self.size[g]
            step = max(1, AT_ONCE // len(k))
            for i in range(0, len(mid), step):
                far = self.away(mid[i : i + step, :1], mid[i : i + step, 1:], k[None])
                kept = far <= far.min(1, keepdims=True) * (1 + 1e-9) + size * 2**0.5 * (1 + 1e-9)
                count.append(kept.sum(1))
                flat.append(k[np.nonzero(kept)[1]])
        new = np.concatenate(count)
        at = len(self.flat) + np.cumsum(new) - new
        order = np.argsort(np.concatenate([self.codes, codes]), kind="stable")
        self.codes = np.concatenate([self.codes, codes])[order]
        self.at, self.count, self.flat = np.concatenate([self.at, at])[order], np.concatenate([self.count, new])[order], np.concatenate(flat)

    def ask(self, group: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, distance) for each point among its group's; the first segment on ties."""
        pick, best = np.zeros(len(points), int), np.empty(len(points))
        cell = np.floor(points / self.size[group][:, None])
        near = (np.abs(cell) < _HALF - 1).all(1)
        for i in np.flatnonzero(~near):  # beyond the numbers of cells
            k = np.arange(self.first[group[i]], self.first[group[i] + 1])
            far = self.away(points[i, 0], points[i, 1], k)
            pick[i], best[i] = k[far.argmin()], far.min()
        some = np.flatnonzero(near)
        ij = cell[some].astype(np.int64) + _HALF
        code = (group[some].astype(np.int64) << 42) + (ij[:, 0] << 21) + ij[:, 1]
        asked, which = np.unique(code, return_inverse=True)
        fresh = asked[~np.isin(asked, self.codes)]
        if len(fresh):
            self._learn(fresh)
        row = np.searchsorted(self.codes, asked)[which]
        many = self.count[row]
        ends = np.cumsum(many)
        i = 0
        while i < len(some):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + AT_ONCE, "right")))
            n = many[i:j]
            starts = np.cumsum(n) - n
            k = self.flat[np.arange(n.sum()) - np.repeat(starts - self.at[row[i:j]], n)]
            p = np.repeat(points[some[i:j]], n, axis=0)
            far = self.away(p[:, 0], p[:, 1], k)
            least = np.minimum.reduceat(far, starts)
            hit = np.flatnonzero(far == np.repeat(least, n))
            pick[some[i:j]], best[some[i:j]] = k[hit[np.searchsorted(hit, starts)]], least
            i = j
        return pick, best
