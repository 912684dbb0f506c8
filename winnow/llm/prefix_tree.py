"""A compact prefix tree (trie) of sorted token sets, searched by overlap.

Sets are stored in one global order, so sets with a common beginning share the
path. A search carries the overlap of the path down: each edge is compared with
the probe once for all sets below it. A subtree is left as soon as the overlap
so far plus the longest possible rest (what is left of the probe, and of the
longest set below) can't reach the overlap that the shortest set below needs.
"""

from __future__ import annotations

import numpy as np


def needed(a: int, b: int, percent: int) -> int:
    """Least intersection of sets of ``a`` and ``b`` with Jaccard similarity of
    ``percent`` hundredths: 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


class PrefixTree:
    """Nodes of a tree over rank arrays. ``sizes`` are the true set sizes; an
    array may leave out tokens that no other set can have."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        # edge label (array, from, to), children, sets that end here, least size, most size and longest rest below
        self.label, self.kids, self.ends, self.low, self.high, self.rest = [(None, 0, 0)], [[]], [[]], [0], [0], [0]
        path, depth_of, last = [0], [0], np.empty(0, np.int64)
        for i in order:
            s = sets[i]
            same = _common(last, s)
            while depth_of[-1] > same:
                node, depth = path.pop(), depth_of.pop()
                if depth_of[-1] < same:
                    middle = self._split(path[-1], node, same - depth_of[-1])
                    path.append(middle)
                    depth_of.append(same)
            if same < len(s):
                path.append(self._add(path[-1], (s, same, len(s))))
                depth_of.append(len(s))
            self.ends[path[-1]].append(i)
            last = s
        self.sizes = sizes
        self._bound(sets)

    def _add(self, parent: int, label: tuple) -> int:
        self.label.append(label)
        self.kids.append([])
        self.ends.append([])
        self.kids[parent].append(len(self.label) - 1)
        return len(self.label) - 1

    def _split(self, parent: int, node: int, at: int) -> int:
        s, a, b = self.label[node]
        self.kids[parent].remove(node)
        middle = self._add(parent, (s, a, a + at))
        self.label[node] = (s, a + at, b)
        self.kids[middle].append(node)
        return middle

    def _bound(self, sets: list[np.ndarray]) -> None:
        n = len(self.label)
        self.low, self.high, self.rest = [0] * n, [0] * n, [0] * n
        stack = [(0, False)]
        while stack:
            node, done = stack.pop()
            if not done:
                stack.append((node, True))
                stack.extend((k, False) for k in self.kids[node])
                continue
            own = [int(self.sizes[i]) for i in self.ends[node]]
            kids = self.kids[node]
            self.low[node] = min(own + [self.low[k] for k in kids], default=0)
            self.high[node] = max(own + [self.high[k] for k in kids], default=0)
            self.rest[node] = max([self.rest[k] + self.label[k][2] - self.label[k][1] for k in kids], default=0)

    def search(self, probe: np.ndarray, size: int, percent: int, ranks: int) -> list[tuple[int, int]]:
        """(set, overlap) of every set that is similar to the probe (ranks in
        order, true size ``size``); ``ranks`` is the number of ranks in use."""
        inside = np.zeros(ranks + 1, np.int32)
        inside[probe] = 1
        left = len(probe) - np.cumsum(inside)  # probe tokens after each rank
        out, stack = [], [(0, 0)]
        while stack:
            node, overlap = stack.pop()
            s, a, b = self.label[node]
            after = len(probe)
            if b > a:
                overlap += int(inside[s[a:b]].sum())
                after = int(left[s[b - 1]])
            if overlap + min(after, self.rest[node]) < needed(size, self.low[node], percent):
                continue
            for i in self.ends[node]:
                if overlap >= needed(size, int(self.sizes[i]), percent):
                    out.append((i, overlap))
            stack.extend((k, overlap) for k in self.kids[node])
        return out


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    if not n:
        return 0
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n
