"""A tree over sets of ordered tokens, searched with partial overlaps shared."""

from __future__ import annotations

import numpy as np


class PrefixTree:
    """Sets sorted by their tokens, the most frequent first; sets with a common beginning share its nodes.

    ``sets`` are arrays of distinct tokens, ``sizes`` the full sizes of the sets:
    a set may have further tokens that no other set has.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        unique, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(unique), np.int64)
        rank[np.lexsort((unique, -counts))] = np.arange(len(unique))
        ends = np.cumsum([len(s) for s in sets])
        own = [np.sort(part) for part in np.split(rank[place], ends[:-1])] if sets else []
        order = sorted(range(len(sets)), key=lambda i: own[i].astype(">u4").tobytes())
        self.order = np.array(order, dtype=np.int64)
        self.sets = [own[i] for i in order]
        self.sizes = np.asarray(sizes, dtype=np.int64)[self.order]
        self.tokens = len(unique)
        self._build()

    def _build(self) -> None:
        n = len(self.sets)
        common = [0] * (n + 1)  # with the set before
        for i in range(1, n):
            a, b = self.sets[i - 1], self.sets[i]
            k = min(len(a), len(b))
            differ = np.flatnonzero(a[:k] != b[:k])
            common[i] = int(differ[0]) if len(differ) else k
        # nodes as (first set, set behind the last, depth where it ends); the parent is filled in when it closes
        nodes: list[list[int]] = []
        above: list[int] = []
        open_: list[tuple[int, int, list[int]]] = [(0, 0, [])]  # depth, first set, children
        for i in range(n):
            leaf = [i, i + 1, len(self.sets[i])]
            nodes.append(leaf)
            above.append(-1)
            child = len(nodes) - 1
            shared = common[i + 1]
            while open_[-1][0] > shared:
                depth, first, children = open_.pop()
                children.append(child)
                nodes.append([first, i + 1, depth])
                above.append(-1)
                child = len(nodes) - 1
                for c in children:
                    above[c] = child
            if open_[-1][0] < shared:
                first = nodes[child][0]
                open_.append((shared, first, [child]))
            else:
                open_[-1][2].append(child)
        depth_of = {-1: 0}
        by_level: list[list[int]] = []
        children_of: dict[int, list[int]] = {}
        for c, p in enumerate(above):
            children_of.setdefault(p, []).append(c)
        level = children_of.get(-1, [])
        place = {-1: 0}
        first_child, last_child = [], []
        lo, hi, begin, end = [], [], [], []
        while level:
            by_level.append(level)
            for c in level:
                place[c] = len(lo)
                first, last, depth = nodes[c]
                lo.append(first)
                hi.append(last)
                begin.append(depth_of[above[c]])
                end.append(depth)
                depth_of[c] = depth
            level = [g for c in level for g in children_of.get(c, [])]
        at = len(children_of.get(-1, []))
        for level in by_level:
            for c in level:
                first_child.append(at)
                at += len(children_of.get(c, []))
                last_child.append(at)
        self.roots = len(children_of.get(-1, []))
        self.lo, self.hi = np.array(lo, np.int64), np.array(hi, np.int64)
        self.first_child, self.last_child = np.array(first_child, np.int64), np.array(last_child, np.int64)
        self.begin, self.end = np.array(begin, np.int64), np.array(end, np.int64)
        lengths = self.end - self.begin
        self.edge = np.r_[0, np.cumsum(lengths)]
        self.labels = (
            np.concatenate([self.sets[a][s:e] for a, s, e in zip(lo, begin, end, strict=True)])
            if lo
            else np.zeros(0, np.int64)
        )
        tails = np.array([len(s) for s in self.sets], np.int64)
        self.least = np.minimum.reduceat(self.sizes, self.lo) if n else self.sizes
        self.tail = np.zeros(len(lo), np.int64)
        for k, (a, b) in enumerate(zip(lo, hi, strict=True)):
            self.least[k] = self.sizes[a:b].min() if b - a > 1 else self.sizes[a]
            self.tail[k] = (tails[a:b].max() if b - a > 1 else tails[a]) - end[k]
        self.leaf = (self.last_child == self.first_child) & (self.hi - self.lo == 1)

    def search(self, q: int, after: int) -> np.ndarray:
        """Places, in the tree's order from ``after`` on, of sets that link with set ``q``.

        Level by level: the overlap of a node is its parent's and that of its own
        tokens; a node is left where even all that can follow is too little.
        """
        mine, size = self.sets[q], int(self.sizes[q])
        has = np.zeros(self.tokens + 1, bool)
        has[mine] = True
        nodes, overlap = np.arange(self.roots), np.zeros(self.roots, np.int64)
        found = []
        while len(nodes):
            keep = self.hi[nodes] > after
            nodes, overlap = nodes[keep], overlap[keep]
            if not len(nodes):
                break
            starts, lengths = self.edge[nodes], self.edge[nodes + 1] - self.edge[nodes]
            at = np.repeat(starts - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(int(lengths.sum()))
            hits = np.r_[0, np.cumsum(has[self.labels[at]])]
            ends = np.cumsum(lengths)
            overlap = overlap + hits[ends] - hits[ends - lengths]
            last = np.where(lengths > 0, self.labels[np.maximum(self.edge[nodes + 1] - 1, 0)], -1)
            left = np.where(lengths > 0, len(mine) - np.searchsorted(mine, last, side="right"), len(mine))
            reach = overlap + np.minimum(left, self.tail[nodes])
            alive = 7 * reach >= 3 * (size + self.least[nodes])
            nodes, overlap = nodes[alive], overlap[alive]
            done = self.leaf[nodes]
            found.append(self.lo[nodes[done]])
            nodes, overlap = nodes[~done], overlap[~done]
            counts = self.last_child[nodes] - self.first_child[nodes]
            overlap = np.repeat(overlap, counts)
            nodes = np.repeat(self.first_child[nodes] - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(
                int(counts.sum())
            )
        places = np.concatenate(found) if found else np.zeros(0, np.int64)
        return places[places >= after]


class Forest:
    """Disjoint groups of the numbers below ``n``."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True


def linked_groups(sets: list[np.ndarray], sizes: np.ndarray, groups: list) -> list[tuple[int, int]]:
    """Links that connect what is not yet in one group: pairs of places in ``sets``.

    Two sets link if 100 times their overlap is at least 75 times their union.  A set all
    of whose partners are in its group already is not searched for.
    """
    tree = PrefixTree(sets, sizes)
    order = tree.order.tolist()
    forest = Forest(len(sets))
    first: dict = {}
    for i, g in enumerate(groups):
        forest.join(first.setdefault(g, i), i)
    parts = len(set(map(forest.root, range(len(sets)))))
    links = []
    for q in range(len(order)):
        if parts == 1:
            break
        mine = forest.root(order[q])
        if all(forest.root(order[j]) == mine for j in range(q + 1, len(order))):
            continue
        for j in tree.search(q, q + 1).tolist():
            if forest.join(order[q], order[j]):
                links.append((order[q], order[j]))
                parts -= 1
    return links
