"""Cover trees of whole-number points, with sums of every subtree from running sums."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 16
_CHUNK = 1 << 15
# Square roots and their sums are right to far fewer than this many parts; a wider margin only descends a little more.
_SLACK = 1e-9


def squared_distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    apart = points - centre
    return np.einsum("ij,ij->i", apart, apart)


def _to_entries(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    apart = points[:, None, :] - entries[None, :, :]
    return np.einsum("ijk,ijk->ij", apart, apart)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, ties to the lower; its squared distance) of every point, exactly, in 64-bit integers."""
    which, far = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
    for at in range(0, len(points), _CHUNK):
        squared = _to_entries(points[at: at + _CHUNK], entries)
        which[at: at + _CHUNK] = squared.argmin(axis=1)
        far[at: at + _CHUNK] = squared.min(axis=1)
    return which, far


def spread(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (many[0] of them), start[1], ... as one array."""
    before = np.cumsum(many) - many
    return np.repeat(start - before, many) + np.arange(int(many.sum()))


@dataclass
class CoverTree:
    """Nodes in breadth-first order; the points of a node's subtree are ``order[start:end]``.

    A node's children have its own centre and others, more than half its radius apart; each point belongs to the nearest
    of them, at no more than half the radius. ``radius2`` is the largest squared distance of a node's points to its centre.
    """

    order: np.ndarray
    centre: np.ndarray
    radius2: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    many: np.ndarray

    def assign(self, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where every point's nearest entry lies: runs (start, end, entry) of whole subtrees, and (place, entry) of single points.

        With r the radius of a node and d the distances of its centre, an entry whose d exceeds the smallest by more than
        2 r is nearest to no point of the subtree. If one entry is left, the subtree is its own; otherwise the search
        goes down, and the points of ambiguous leaves are compared exactly. Points of a radius of nought are all equal.
        """
        runs, singles = [], []
        here = np.zeros(min(1, len(self.centre)), np.int64)
        while len(here):
            squared = _to_entries(points[self.centre[here]], entries)
            best = squared.argmin(axis=1)
            apart = np.sqrt(squared.astype(np.float64))
            near = apart[np.arange(len(here)), best]
            apart[np.arange(len(here)), best] = np.inf
            radius = np.sqrt(self.radius2[here].astype(np.float64))
            sure = (apart.min(axis=1) * (1 - _SLACK) > (near + 2 * radius) * (1 + _SLACK)) | (self.radius2[here] == 0)
            runs.append((self.start[here[sure]], self.end[here[sure]], best[sure]))
            rest = here[~sure]
            leaves = rest[self.many[rest] == 0]
            singles.append(spread(self.start[leaves], self.end[leaves] - self.start[leaves]))
            inner = rest[self.many[rest] > 0]
            here = spread(self.first[inner], self.many[inner])
        place = np.concatenate([np.empty(0, np.int64), *singles])
        start, end, entry = (np.concatenate([np.empty(0, np.int64), *column]) for column in zip(*runs)) if runs else (np.empty(0, np.int64),) * 3
        return start, end, entry, place, nearest(points[self.order[place]], entries)[0]

    def sums(self, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum, number) of the points nearest to each entry; a subtree costs one difference of running sums."""
        total, number = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
        ordered = points[self.order]
        running = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(ordered, axis=0, dtype=np.int64)])
        start, end, entry, place, single = self.assign(points, entries)
        np.add.at(total, entry, running[end] - running[start])
        np.add.at(number, entry, end - start)
        np.add.at(total, single, ordered[place])
        np.add.at(number, single, 1)
        return total, number

    def labels(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """The nearest entry of each point, in the order of ``points``."""
        start, end, entry, place, single = self.assign(points, entries)
        found = np.empty(len(self.order), np.int64)
        found[self.order[spread(start, end - start)]] = np.repeat(entry, end - start)
        found[self.order[place]] = single
        return found


def build(points: np.ndarray, leaf: int = LEAF) -> CoverTree:
    """The cover tree of some points, one level of halved radius below the other; up to ``leaf`` points stay together."""
    order = np.arange(len(points))
    if not len(points):
        none = np.empty(0, np.int64)
        return CoverTree(order, none, none, none, none, none, none)
    centre, start, end, first, many = [0], [0], [len(points)], [0], [0]
    radius2 = [int(squared_distances(points, points[0]).max())]
    at = 0
    while at < len(centre):
        low, high = start[at], end[at]
        if high - low > leaf and radius2[at] > 0:
            ids = order[low:high]
            mine = points[ids]
            centres, owner = [centre[at]], np.zeros(high - low, np.int64)
            gap = squared_distances(mine, points[centre[at]])
            while 4 * int(gap[far := int(gap.argmax())]) > radius2[at]:
                apart = squared_distances(mine, mine[far])
                closer = apart < gap
                owner[closer] = len(centres)
                gap[closer] = apart[closer]
                centres.append(int(ids[far]))
            placed = np.argsort(owner, kind="stable")
            order[low:high] = ids[placed]
            cuts = np.searchsorted(owner[placed], np.arange(len(centres) + 1))
            first[at], many[at] = len(centre), len(centres)
            centre += centres
            start += (low + cuts[:-1]).tolist()
            end += (low + cuts[1:]).tolist()
            radius2 += np.maximum.reduceat(gap[placed], cuts[:-1]).tolist()
            first += [0] * len(centres)
            many += [0] * len(centres)
        at += 1
    return CoverTree(order, *(np.array(column, np.int64) for column in (centre, radius2, start, end, first, many)))
