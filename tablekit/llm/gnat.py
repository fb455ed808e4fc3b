"""GNAT: a tree over a few points that finds the nearest one to each of many queries, exactly.

A node has split points; every other point goes with the nearest of them. A split point knows the least and the
greatest distance to the points of every branch. A query at distance d from a split point, with its best distance b,
can skip a branch whose range lies wholly outside [d - b, d + b].
"""

from __future__ import annotations

from math import isqrt
from typing import NamedTuple

import numpy as np

SPLITS = 8
#: More than the relative error of a square root, a sum and the conversion from integers together.
_SLACK = 2.0 ** -49


class _Node(NamedTuple):
    splits: list[int]
    low: np.ndarray  # [i, j]: least distance of split i to branch j, split j included; on the diagonal without it
    high: np.ndarray
    branches: list


def _root(square: int) -> float:
    root = isqrt(square)
    return float(root) if root < 10 ** 300 else np.inf


def _roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Square roots rounded down and up, so that no bound is ever tighter than the integers say."""
    if squares.dtype == object:
        down = np.array([_root(int(s)) for s in squares.ravel()]).reshape(squares.shape)
        return np.where(np.isinf(down), 0.0, down * (1 - _SLACK)), (down + 1) * (1 + _SLACK)
    roots = np.sqrt(squares.astype(np.float64))
    return roots * (1 - _SLACK), roots * (1 + _SLACK)


def _squares(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = points - point
    return (gap * gap).sum(axis=-1) if gap.dtype == object else np.einsum("...j,...j->...", gap, gap)


class Gnat:
    """Points are rows of an integer array (64-bit, or Python integers where those could overflow)."""

    def __init__(self, points: np.ndarray):
        self.points = points
        first = {}
        for i, p in enumerate(points.tolist()):
            first.setdefault(tuple(p), i)  # of equal points the lowest index wins every tie
        gaps = _squares(points[:, None, :], points[None, :, :])
        self.root = self._build(np.array(sorted(first.values())), gaps, *_roots(gaps))

    def _build(self, members: np.ndarray, gaps: np.ndarray, downs: np.ndarray, ups: np.ndarray) -> _Node:
        splits, far = [int(members[0])], gaps[members[0], members]
        while len(splits) < min(SPLITS, len(members)):
            splits.append(int(members[int(np.argmax(far))]))  # the point farthest from the splits so far
            far = np.minimum(far, gaps[splits[-1], members])
        rest = members[~np.isin(members, splits)]
        with_split = np.argmin(gaps[np.ix_(rest, splits)], axis=1) if len(rest) else rest
        held = [rest[with_split == j] for j in range(len(splits))]
        low, high = np.full((len(splits),) * 2, np.inf), np.full((len(splits),) * 2, -np.inf)
        for j, t in enumerate(splits):
            branch = np.append(held[j], t)
            low[:, j], high[:, j] = downs[np.ix_(splits, branch)].min(axis=1), ups[np.ix_(splits, branch)].max(axis=1)
            low[j, j], high[j, j] = downs[t, held[j]].min(initial=np.inf), ups[t, held[j]].max(initial=-np.inf)
        return _Node(splits, low, high, [self._build(h, gaps, downs, ups) if len(h) else None for h in held])

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest point and the squared distance, of equal distances the lowest index."""
        top = None if queries.dtype == object or self.points.dtype == object else np.iinfo(np.int64).max
        if top is None:
            queries, points = queries.astype(object), self.points.astype(object)
        else:
            points = self.points
        start = self.root.splits[0]
        state = (queries, points, _squares(queries, points[start]), np.full(len(queries), start))
        self._visit(self.root, np.arange(len(queries)), state)
        return state[3], state[2]

    def _visit(self, node: _Node, rows: np.ndarray, state: tuple) -> None:
        queries, points, best, at = state
        near = queries[rows]
        alive = np.ones((len(rows), len(node.splits)), bool)
        downs, ups = np.zeros(alive.shape), np.zeros(alive.shape)
        closest, order = np.full(len(rows), np.inf), np.zeros(len(rows), int)
        for i, s in enumerate(node.splits):
            on = np.flatnonzero(alive[:, i])
            if not len(on):
                continue
            own = rows[on]
            gap = _squares(near[on], points[s])
            held = best[own]
            better = (gap < held) | ((gap == held) & (s < at[own]))  # integers decide, ties by index
            best[own] = np.where(better, gap, held)
            at[own[better]] = s
            down, up = _roots(gap)
            downs[on, i], ups[on, i] = down, up
            closer = up < closest[on]
            closest[on] = np.where(closer, up, closest[on])
            order[on[closer]] = i
            radius = _roots(best[own])[1]
            alive[on] &= self._reached(node.low[i], node.high[i], down[:, None], up[:, None], radius[:, None])
        for first in (True, False):  # the branch of the closest split sharpens the bound for the others
            for j, branch in enumerate(node.branches):
                if branch is None:
                    continue
                on = np.flatnonzero(alive[:, j] & ((order == j) == first))
                radius = _roots(best[rows[on]])[1]
                on = on[self._reached(node.low[j, j], node.high[j, j], downs[on, j], ups[on, j], radius)]
                if len(on):
                    self._visit(branch, rows[on], state)

    @staticmethod
    def _reached(low, high, down, up, radius):
        """Whether a range may hold a point within ``radius``; only strictly farther ones are ruled out."""
        return (low <= (up + radius) * (1 + _SLACK)) & ((high + radius) * (1 + _SLACK) >= down)
