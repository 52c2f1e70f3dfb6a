"""Signature trees: exact Jaccard links between the sets of one or two blocks."""

from __future__ import annotations

import numpy as np

#: Bits of a document's token bitmap, and children per node.
WIDTH, FANOUT = 2048, 16
#: Node pairs that are bounded at once; bounds the memory of a traversal.
CHUNK = 65_536


class Forest:
    """Union-find over the entries of a block."""

    def __init__(self, parents: np.ndarray) -> None:
        self.parent = parents.tolist()

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)

    def roots(self) -> np.ndarray:
        return np.fromiter((self.root(i) for i in range(len(self.parent))), np.int64, len(self.parent))


class Sets:
    """The sets of a block as one array of dense token numbers with offsets."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        distinct, self.token = np.unique(tokens, return_inverse=True)
        self.mark = np.zeros(len(distinct), dtype=np.int64)
        self.bitmap = np.zeros((len(sets), WIDTH // 64), dtype=np.uint64)
        bit = (tokens >> np.uint64(20)) % np.uint64(WIDTH)
        row = np.repeat(np.arange(len(sets)), self.size)
        np.bitwise_or.at(self.bitmap, (row, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
        #: tokens that share their bit with another one of the set
        self.excess = self.size - np.bitwise_count(self.bitmap).sum(axis=1, dtype=np.int64)

    def overlaps(self, i: int, others: np.ndarray) -> np.ndarray:
        """Exact intersection sizes of set ``i`` with each of ``others``."""
        own = self.token[self.start[i] : self.start[i + 1]]
        self.mark[own] = 1
        sizes = self.size[others]
        ends = np.cumsum(sizes)
        at = np.repeat(self.start[others] - ends + sizes, sizes) + np.arange(ends[-1])
        found = np.add.reduceat(self.mark[self.token[at]], ends - sizes)
        self.mark[own] = 0
        return found


class Tree:
    """Nodes over entries ordered by size and smallest token; level 0 are the entries."""

    def __init__(self, sets: Sets, entries: np.ndarray, order: np.ndarray) -> None:
        entries = entries[np.lexsort((order[entries], np.log(sets.size[entries]) // np.log(4 / 3)))]
        self.entries = entries
        self.bits = [sets.bitmap[entries]]
        self.low = [sets.size[entries]]
        self.high = [sets.size[entries]]
        self.excess = [sets.excess[entries]]
        while len(self.low[-1]) > 1:
            at = np.arange(0, len(self.low[-1]), FANOUT)
            self.bits.append(np.bitwise_or.reduceat(self.bits[-1], at, axis=0))
            self.low.append(np.minimum.reduceat(self.low[-1], at))
            self.high.append(np.maximum.reduceat(self.high[-1], at))
            self.excess.append(np.maximum.reduceat(self.excess[-1], at))

    def level(self, k: int) -> int:
        return min(k, len(self.low) - 1)

    def components(self, roots: np.ndarray) -> list[np.ndarray]:
        """Per level: the component of a node's entries, -1 if they are of several."""
        out = [roots[self.entries]]
        while len(out[-1]) > 1:
            at = np.arange(0, len(out[-1]), FANOUT)
            low, high = np.minimum.reduceat(out[-1], at), np.maximum.reduceat(out[-1], at)
            out.append(np.where(low == high, low, -1))
        return out


def _children(nodes: np.ndarray, tree: Tree, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First child and number of children of nodes at ``level``."""
    below = len(tree.low[level - 1])
    first = nodes * FANOUT
    return first, np.minimum(FANOUT, below - first)


def _survivors(a: np.ndarray, b: np.ndarray, ta: Tree, tb: Tree, la: int, lb: int, ca: list, cb: list, percent: int) -> np.ndarray:
    """Node pairs that may hold a link between two components."""
    low_a, low_b, high_a, high_b = ta.low[la][a], tb.low[lb][b], ta.high[la][a], tb.high[lb][b]
    open_ = (ca[la][a] != cb[lb][b]) | (ca[la][a] < 0)
    # intersection <= smaller set, union >= larger set
    open_ &= (100 * high_a >= percent * low_b) & (100 * high_b >= percent * low_a)
    at = np.flatnonzero(open_)
    if not len(at):
        return at
    a, b = a[at], b[at]
    common = np.bitwise_count(ta.bits[la][a] & tb.bits[lb][b]).sum(axis=1, dtype=np.int64)
    most = common + np.minimum(ta.excess[la][a], tb.excess[lb][b])
    most = np.minimum(most, np.minimum(high_a[at], high_b[at]))
    # a link needs (100 + percent) * intersection >= percent * (sizes together)
    return at[(100 + percent) * most >= percent * (low_a[at] + low_b[at])]


def _verify(sets: Sets, forest: Forest, left: np.ndarray, right: np.ndarray, percent: int) -> None:
    for i in np.unique(left):
        others = right[left == i]
        mine = forest.root(int(i))
        others = np.array([j for j in others.tolist() if forest.root(j) != mine], dtype=np.int64)
        if len(others):
            shared = sets.overlaps(int(i), others)
            union = sets.size[i] + sets.size[others] - shared
            for j in others[100 * shared >= percent * union].tolist():
                forest.join(int(i), j)


def link(sets: list[np.ndarray], component: np.ndarray, side: np.ndarray | None = None, percent: int = 75) -> np.ndarray:
    """Components of the entries after all links at ``percent`` or more.

    ``component`` gives the entries that are known to be connected (the least index of
    each component). With ``side`` (0 or 1) only pairs across the two sides are tested,
    else all pairs. Entries need non-empty sets of distinct 64-bit tokens.

    First a few pivots are compared with all others, which connects a group of near
    copies in linear time. Then two trees (or one with itself) are traversed together
    from the roots. A node pair is dropped if all its entries are of one component, if
    the size ranges do not meet, or if the tokens that can be common - the bits of both
    OR-combined bitmaps, and what may share a bit - are too few. What is left at the
    leaves is compared exactly.
    """
    data, forest = Sets(sets), Forest(component)
    n = len(sets)
    if n < 2:
        return forest.roots()
    order = np.array([s[0] for s in sets], dtype=np.uint64)
    if side is None and n > FANOUT:
        everyone = np.arange(n)
        for _ in range(12):
            roots = forest.roots()
            names, counts = np.unique(roots, return_counts=True)
            single = names[counts == 1]
            if len(single) < n // 50 + 2:
                break
            pivot = int(single[len(single) // 2])
            _verify(data, forest, np.full(n - 1, pivot), np.delete(everyone, pivot), percent)
    one = side is None
    ta = Tree(data, np.arange(n) if one else np.flatnonzero(side == 0), order)
    tb = ta if one else Tree(data, np.flatnonzero(side == 1), order)
    if not len(ta.entries) or not len(tb.entries):
        return forest.roots()
    top = max(len(ta.low), len(tb.low)) - 1
    todo = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        k, a, b = todo.pop()
        if len(a) > CHUNK:
            todo += [(k, a[i : i + CHUNK], b[i : i + CHUNK]) for i in range(0, len(a), CHUNK)]
            continue
        roots = forest.roots()
        ca = ta.components(roots)
        cb = ca if one else tb.components(roots)
        la, lb = ta.level(k), tb.level(k)
        keep = _survivors(a, b, ta, tb, la, lb, ca, cb, percent)
        a, b = a[keep], b[keep]
        if not k:
            keep = a != b if one else slice(None)
            left, right = ta.entries[a[keep]], tb.entries[b[keep]]
            _verify(data, forest, left, right, percent)
            continue
        # a tree that is lower than the other waits at its root
        fa, na = _children(a, ta, la) if la == k else (a, np.ones_like(a))
        fb, nb = _children(b, tb, lb) if lb == k else (b, np.ones_like(b))
        pairs = na * nb
        which = np.repeat(np.arange(len(a)), pairs)
        at = np.arange(len(which)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        a, b = fa[which] + at // nb[which], fb[which] + at % nb[which]
        if one:
            a, b = a[a <= b], b[a <= b]
        if len(a):
            todo.append((k - 1, a, b))
    return forest.roots()
