"""Suffix trees of integer sequences, with longest common extensions in constant time.

The tree is built online in linear time. An Euler tour of it, with range
minima over the string depths it passes, answers how far two suffixes agree:
the depth of their leaves' lowest common ancestor.
"""

from __future__ import annotations

import numpy as np

_BLOCK = 32


class RangeMinima:
    """Minimum of any range, for whole arrays of ranges at once.

    Blocks of 32 keep running minima from both ends, a sparse table covers
    whole blocks; a range inside one block is read through. Memory is about
    three arrays of the input's size.
    """

    def __init__(self, values: np.ndarray):
        n = len(values)
        blocks = -(-n // _BLOCK)
        padded = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        padded[:n] = values
        square = padded.reshape(blocks, _BLOCK)
        self.values = padded
        self.ahead = np.minimum.accumulate(square, axis=1).ravel()
        self.behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [square.min(axis=1)]
        while len(self.table[-1]) > 1 << (len(self.table) - 1):
            row, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(row[:-half], row[half:]))

    def query(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of values[lo..hi], both ends included; lo <= hi."""
        a, b = lo // _BLOCK, hi // _BLOCK
        out = np.minimum(self.behind[lo], self.ahead[hi])
        inside = np.flatnonzero(b - a > 1)
        if len(inside):
            first, count = a[inside] + 1, (b - a)[inside] - 1
            level = np.frexp(count.astype(np.float64))[1] - 1
            for k in np.unique(level):
                at = inside[level == k]
                f, end = first[level == k], (first + count)[level == k]
                row = self.table[k]
                out[at] = np.minimum(out[at], np.minimum(row[f], row[end - (1 << int(k))]))
        same = np.flatnonzero(a == b)
        for k in range(0, len(same), 1 << 15):
            at = same[k: k + (1 << 15)]
            reach = np.minimum(lo[at, None] + np.arange(_BLOCK), hi[at, None])
            out[at] = self.values[reach].min(axis=1)
        return out


class SuffixTree:
    """Tree of all suffixes of ``sequence`` (integers from 1 up) and a last symbol, 0, that is smaller than all.

    ``rank`` orders the suffixes; ``rank_reversed`` orders them by the opposite
    order of symbols, where a prefix still comes before what it begins.
    """

    def __init__(self, sequence: list[int]):
        s = [*sequence, 0]
        self.length = len(sequence)
        self._build(s, max(s) + 1)
        self._tour()

    def _build(self, s: list[int], width: int) -> None:
        n = len(s)
        start, stop, link, kids = [0], [0], [0], {}
        get, node, edge, deep, due = kids.get, 0, 0, 0, 0
        for i, c in enumerate(s):
            due += 1
            made = 0
            while due:
                if not deep:
                    edge = i
                key = node * width + s[edge]
                child = get(key)
                if child is None:
                    kids[key] = len(start)
                    start.append(i)
                    stop.append(n)
                    link.append(0)
                    if made:
                        link[made] = node
                        made = 0
                else:
                    at = start[child]
                    span = stop[child] - at
                    if deep >= span:
                        edge += span
                        deep -= span
                        node = child
                        continue
                    if s[at + deep] == c:
                        deep += 1
                        if made:
                            link[made] = node
                        break
                    fork = len(start)
                    start += (at, i)
                    stop += (at + deep, n)
                    link += (0, 0)
                    kids[key] = fork
                    kids[fork * width + c] = fork + 1
                    start[child] = at + deep
                    kids[fork * width + s[at + deep]] = child
                    if made:
                        link[made] = fork
                    made = fork
                due -= 1
                if node:
                    node = link[node]
                elif deep:
                    deep -= 1
                    edge = i - due + 1
        self.size = len(start)
        self.edge_length = np.array(stop) - np.array(start)
        self.is_leaf = np.array(stop) == n
        self.is_leaf[0] = n == 0
        keys = np.fromiter(kids.keys(), dtype=np.int64, count=len(kids))
        order = np.argsort(keys)
        keys = keys[order]
        self.child = np.fromiter(kids.values(), dtype=np.int64, count=len(kids))[order]
        self.parent = np.full(self.size, -1, dtype=np.int64)
        self.parent[self.child] = keys // width
        self.bounds = np.searchsorted(keys, np.arange(self.size + 1, dtype=np.int64) * width)
        self.by_last = keys % width == 0

    def _tour(self) -> None:
        child, parent = self.child.tolist(), self.parent.tolist()
        at, bound = self.bounds[:-1].tolist(), self.bounds[1:].tolist()
        node, tour = 0, [0]
        put = tour.append
        while True:
            k = at[node]
            if k < bound[node]:
                at[node] = k + 1
                node = child[k]
                put(node)
            else:
                node = parent[node]
                if node < 0:
                    break
                put(node)
        t = np.array(tour)
        down = np.zeros(len(t), dtype=bool)
        down[1:] = self.parent[t[1:]] == t[:-1]
        seen = np.flatnonzero(self.is_leaf[t])
        suffix_of = np.cumsum(self.is_leaf) - 1  # leaves are made in the order of their suffixes
        order = suffix_of[t[seen]]

        def along(steps: np.ndarray) -> np.ndarray:
            """Sum of ``steps`` from the root to each node the tour passes."""
            moves = np.zeros(len(t), dtype=np.int64)
            moves[1:] = np.where(down[1:], steps[t[1:]], -steps[t[:-1]])
            return np.cumsum(moves)

        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = seen
        self.minima = RangeMinima(along(self.edge_length))
        self.rank = np.empty(len(order), dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        # leaves below each node, from its first and last place in the tour
        passed = np.cumsum(self.is_leaf[t])
        first, last = np.full(self.size, -1), np.full(self.size, -1)
        last[t] = np.arange(len(t))
        first[t[::-1]] = np.arange(len(t))[::-1]
        leaves = passed[last] - passed[first] + self.is_leaf
        before = np.concatenate([[0], np.cumsum(leaves[self.child])])
        steps = np.zeros(self.size, dtype=np.int64)
        group = self.parent[self.child]
        # siblings that come first in the opposite order: all greater ones, and the end of the sequence
        steps[self.child] = before[self.bounds[group + 1]] - before[1:]
        ends = np.zeros(self.size, dtype=np.int64)
        ends[group[self.by_last]] = 1
        steps[self.child] += ends[group]
        steps[self.child[self.by_last]] = 0
        self.rank_reversed = np.empty(len(order), dtype=np.int64)
        self.rank_reversed[order] = along(steps)[seen]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at ``i`` and ``j`` share; i != j, the sequence's length stands for the empty suffix."""
        a, b = self.place[i], self.place[j]
        return self.minima.query(np.minimum(a, b), np.maximum(a, b)).astype(np.int64)


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each place the next one of smaller rank; the length where there is none."""
    out, open_ = [len(rank)] * len(rank), []
    for i, r in enumerate(rank.tolist()):
        while open_ and open_[-1][0] > r:
            out[open_.pop()[1]] = i
        open_.append((r, i))
    return np.array(out, dtype=np.int64)


def maximal_runs(sequence: list[int]) -> np.ndarray:
    """(start, length, period) of every maximal repetition of two periods or more, by start and period.

    Each run has a Lyndon word of its period's length as a root under one of
    the two orders, and a suffix's longest Lyndon prefix ends at the next
    smaller suffix. So every place gives two candidates, which the common
    extensions to the right and, in the reversal's tree, to the left complete.
    """
    n = len(sequence)
    if n < 2:
        return np.zeros((0, 3), dtype=np.int64)
    tree, back = SuffixTree(sequence), SuffixTree(sequence[::-1])
    i = np.arange(n, dtype=np.int64)
    found = []
    for rank in (tree.rank, tree.rank_reversed):
        j = np.minimum(next_smaller(rank[:n]), n)
        k, e = i[j < n], j[j < n]
        right, left = tree.common(k, e), back.common(n - k, n - e)
        period = e - k
        keep = left + right >= period
        found.append(np.stack([k - left, left + period + right, period], axis=1)[keep])
    return np.unique(np.concatenate(found)[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]
