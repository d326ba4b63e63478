"""Cover trees of vectors in memory, and their dual traversal.

On unit vectors a cosine of at least t is a distance of at most sqrt(2 - 2t). A node has a
centre, which is one of its vectors, and a covering radius, the largest distance of its vectors
from the centre; the children of a node are a net: their centres are further apart than half
the node's level, and every vector of the node is within that of its child's centre. Levels
halve until a node's vectors are few, or one.

Two trees are traversed together, a level of both at a time: of all pairs of nodes that are
left, those whose radii keep them apart are pruned, those within the distance as a whole are
taken as a whole, the others give way to their children, and leaves are multiplied out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: Vectors of a leaf at most, centres that a net is tried with at once, pairs of nodes or
#: vectors that are compared at once, and pairs of children from which on a pair of nodes is
#: expanded by itself.
LEAF, NET_STEP, PAIRS_AT_ONCE, TILE = 16, 64, 1 << 17, 1 << 13
#: What rounding may change of a distance, and of a product in single precision, which serves
#: for distances above SINGLE_FROM.
SLACK, SINGLE, SINGLE_FROM = 1e-7, 2e-5, 0.05


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; rows of tiny or huge components too."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _within(a: np.ndarray, b: np.ndarray, reach: np.ndarray | float) -> np.ndarray:
    """Of all pairs of unit vectors whether they may be within ``reach``; none that is so is
    missed. Products are taken in single precision where their error is far below the reach."""
    if np.min(reach) > SINGLE_FROM:
        product, allowance = a.astype(np.float32) @ b.astype(np.float32).T, SINGLE
    else:
        product, allowance = a @ b.T, 1e-14
    return product >= (1 - np.minimum(reach, 2.0) ** 2 / 2 - allowance).astype(product.dtype) if isinstance(reach, np.ndarray) else product >= product.dtype.type(1 - min(reach, 2.0) ** 2 / 2 - allowance)


def net(vectors: np.ndarray, rows: np.ndarray, radius: float) -> list[np.ndarray]:
    """``rows`` in groups: each within ``radius`` of its first row, but for rounding, the first
    rows further apart than that. The first row of all is the first of the first group."""
    groups, left = [], rows
    while len(left):
        tried = left[:NET_STEP]
        near = _within(vectors[tried], vectors[left], radius)
        free = np.ones(len(left), bool)
        alone = (near.sum(axis=1) <= 1).tolist()
        for i in range(len(tried)):
            if not free[i]:
                continue
            if alone[i]:
                groups.append(left[i : i + 1])
                free[i] = False
                continue
            near[i, i] = True
            mine = near[i] & free
            order = np.flatnonzero(mine)
            groups.append(left[np.concatenate(([i], order[order != i]))])
            free &= ~mine
        left = left[free]
    return groups


@dataclass
class CoverTree:
    """Nodes in the order of levels, the first is the root. ``rows`` lists the vectors so that
    those of a node are ``rows[start:stop]``; ``first`` and ``last`` bound its children."""

    vectors: np.ndarray
    rows: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @property
    def leaves(self) -> np.ndarray:
        return np.flatnonzero(self.first == self.last)


def build(vectors: np.ndarray, leaf: int = LEAF, least_radius: float = 0.0) -> CoverTree:
    """The tree of unit vectors, at least one. Nodes of at most ``leaf`` vectors or of a radius
    of at most ``least_radius`` are leaves."""
    rows = np.arange(len(vectors))
    centre, radius, start, stop, first, last, levels = [], [], [], [], [], [], []

    def add(at: int, group: np.ndarray, level: float) -> None:
        rows[at : at + len(group)] = group
        centre.append(group[0])
        radius.append(float(np.linalg.norm(vectors[group] - vectors[group[0]], axis=1).max()) if len(group) > 1 else 0.0)
        start.append(at)
        stop.append(at + len(group))
        levels.append(level)

    add(0, rows.copy(), 2.0)
    node = 0
    while node < len(centre):
        first.append(len(centre))
        level = levels[node] / 2
        if stop[node] - start[node] > leaf and radius[node] > max(least_radius, 10 * SLACK):
            while level >= radius[node]:  # levels at which the node has one child are passed
                level /= 2
            groups = net(vectors, rows[start[node] : stop[node]].copy(), level)
            at = start[node]
            for g in groups:
                add(at, g, level)
                at += len(g)
        last.append(len(centre))
        node += 1
    return CoverTree(vectors, rows, *(np.array(x) for x in (centre, radius, start, stop, first, last)))


def spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one after the other, and the range of each."""
    size = high - low
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + low[of], of


class DualTraversal:
    """Links between two sets of vectors, or within one (``b`` is None). ``weights`` say how
    many equal vectors each stands for. Counts what it compared: pairs of nodes and of vectors."""

    def __init__(self, a: np.ndarray | CoverTree, b: np.ndarray | None, threshold: float, weights_a: np.ndarray | None = None, weights_b: np.ndarray | None = None):
        self.same, self.threshold = b is None, threshold
        self.reach = math.sqrt(max(0.0, 2 - 2 * threshold))
        self.compared_nodes = self.compared_vectors = 0
        self.x = a if isinstance(a, CoverTree) else build(unit(a))
        self.y = self.x if self.same else build(unit(b))
        self.single = [t.vectors.astype(np.float32) for t in (self.x, self.y)]
        n, m = len(self.x.vectors), 0 if self.same else len(b)
        self.weights = np.ones(n, np.int64) if weights_a is None else weights_a, None if self.same else np.ones(m, np.int64) if weights_b is None else weights_b
        if self.same:
            self.weights = self.weights[0], self.weights[0]
        self.links = np.zeros(n, np.int64), np.zeros(m, np.int64)
        self.offset = 0 if self.same else n
        self.parent = list(range(n + m))
        zero = np.zeros(1, np.int64)
        self.visit(zero, zero)

    def visit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Pairs of nodes that are left, depth first by halves where they are many."""
        stack = [(x, y)]
        while stack:
            x, y = stack.pop()
            if len(x) > PAIRS_AT_ONCE:
                half = len(x) // 2
                stack += [(x[half:], y[half:]), (x[:half], y[:half])]
                continue
            self.compared_nodes += len(x)
            apart = self._apart(x, y)
            around = self.x.radius[x] + self.y.radius[y]
            left = apart - around <= self.reach + SLACK
            # a row does not link with itself: one node with itself counts as within a double radius
            whole = left & (np.where((x == y) & self.same, 2 * self.x.radius[x], apart + around) < self.reach - SLACK)
            whole &= (self.x.stop[x] - self.x.start[x]) * (self.y.stop[y] - self.y.start[y]) >= LEAF
            for i, j in zip(x[whole].tolist(), y[whole].tolist(), strict=True):
                self._all_link(i, j)
            x, y = x[left & ~whole], y[left & ~whole]
            ends_x, ends_y = self.x.first[x] == self.x.last[x], self.y.first[y] == self.y.last[y]
            self._compare(x[ends_x & ends_y], y[ends_x & ends_y])
            # the wider of two nodes gives way; both, where both may
            wide = self.x.radius[x] >= self.y.radius[y]
            open_x, open_y = ~ends_x & (wide | ends_y), ~ends_y & (~wide | ends_x)
            both = ~ends_x & ~ends_y
            self._push(stack, x, y, both, both)
            self._push(stack, x, y, open_x & ~both, np.zeros(len(x), bool))
            self._push(stack, x, y, np.zeros(len(x), bool), open_y & ~both)

    def _children(self, tree: CoverTree, node: int, opened: bool) -> np.ndarray:
        return np.arange(tree.first[node], tree.last[node]) if opened else np.array([node])

    def _push(self, stack: list, x: np.ndarray, y: np.ndarray, open_x: np.ndarray, open_y: np.ndarray) -> None:
        chosen = open_x | open_y
        x, y, open_x, open_y = x[chosen], y[chosen], open_x[chosen], open_y[chosen]
        if not len(x):
            return
        many = np.where(open_x, self.x.last[x] - self.x.first[x], 1) * np.where(open_y, self.y.last[y] - self.y.first[y], 1)
        for k in np.flatnonzero(many > TILE).tolist():
            self._push_wide(stack, self._children(self.x, x[k], open_x[k]), self._children(self.y, y[k], open_y[k]), self.same and x[k] == y[k])
        few = np.flatnonzero(many <= TILE)
        for part in np.split(few, np.flatnonzero(np.diff(np.cumsum(many[few]) // PAIRS_AT_ONCE)) + 1):
            if not len(part):
                continue
            i, j, ox, oy = x[part], y[part], open_x[part], open_y[part]
            once = (i == j) & self.same  # of the children of one node each pair once
            i, of = spans(np.where(ox, self.x.first[i], i), np.where(ox, self.x.last[i], i + 1))
            j, oy, once = j[of], oy[of], once[of]
            j, of = spans(np.where(oy, self.y.first[j], j), np.where(oy, self.y.last[j], j + 1))
            i = i[of]
            keep = ~once[of] | (i <= j)
            stack.append((i[keep], j[keep]))

    def _push_wide(self, stack: list, i: np.ndarray, j: np.ndarray, once: bool) -> None:
        """The pairs of many children that are not pruned, by products of matrices. Children of
        one vector have a bound of their own, which spares the others' sums of radii."""
        step = 1024
        rx, ry = self.x.radius[i], self.y.radius[j]
        for p in (i[rx == 0], i[rx > 0]):
            for q in (j[ry == 0], j[ry > 0]):
                for s in range(0, len(p), step):
                    for t in range(0, len(q), step):
                        x, y = p[s : s + step], q[t : t + step]
                        if once and x[0] > y[-1]:
                            continue
                        bound = self.reach + SLACK
                        if self.x.radius[x[0]] or self.y.radius[y[0]]:
                            bound = bound + self.x.radius[x][:, None] + self.y.radius[y][None, :]
                        near = _within(self.x.vectors[self.x.centre[x]], self.y.vectors[self.y.centre[y]], bound)
                        self.compared_nodes += near.size
                        at = np.flatnonzero(near)
                        x, y = x[at // len(y)], y[at % len(y)]
                        if once:
                            x, y = x[x <= y], y[x <= y]
                        if len(x):
                            stack.append((x, y))

    def _apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        a, b = self.x.vectors, self.y.vectors
        for s in range(0, len(x), 1 << 14):
            e = slice(s, s + (1 << 14))
            out[e] = np.linalg.norm(a[self.x.centre[x[e]]] - b[self.y.centre[y[e]]], axis=1)
        return out

    def _all_link(self, i: int, j: int) -> None:
        p, q = self.x.rows[self.x.start[i] : self.x.stop[i]], self.y.rows[self.y.start[j] : self.y.stop[j]]
        if self.same and i == j:
            self.links[0][p] += self.weights[0][p].sum() - self.weights[0][p]
        else:
            self.links[0][p] += self.weights[1][q].sum()
            self.links[0 if self.same else 1][q] += self.weights[0][p].sum()
        root = int(p[0])
        for k in p[1:].tolist():
            self.join(root, k)
        for k in q.tolist():
            self.join(root, k + self.offset)

    def _compare(self, x: np.ndarray, y: np.ndarray) -> None:
        """Vectors of pairs of leaves."""
        if not len(x):
            return
        # a leaf has LEAF vectors, or more only if they are all but equal
        many = (self.x.stop[x] - self.x.start[x]) * (self.y.stop[y] - self.y.start[y])
        for part in np.split(np.arange(len(x)), np.flatnonzero(np.diff(np.cumsum(many) // PAIRS_AT_ONCE)) + 1):
            if not len(part):
                continue
            p, of = spans(self.x.start[x[part]], self.x.stop[x[part]])
            leaf = y[part][of]
            own = x[part][of]
            q, of = spans(self.y.start[leaf], self.y.stop[leaf])
            p, q, twice = self.x.rows[p[of]], self.y.rows[q], (own == leaf)[of]
            if self.same:
                keep = ~twice | (p < q)  # within a leaf each pair once
                p, q = p[keep], q[keep]
            self._verify(p, q)

    def _verify(self, p: np.ndarray, q: np.ndarray) -> None:
        self.compared_vectors += len(p)
        for s in range(0, len(p), 1 << 14):
            i, j = p[s : s + (1 << 14)], q[s : s + (1 << 14)]
            # single precision tells most that are not; the others are decided in double precision
            near = np.einsum("ij,ij->i", self.single[0][i], self.single[1][j]) >= self.threshold - SINGLE
            i, j = i[near], j[near]
            near = np.einsum("ij,ij->i", self.x.vectors[i], self.y.vectors[j]) >= self.threshold
            i, j = i[near], j[near]
            np.add.at(self.links[0], i, self.weights[1][j])
            np.add.at(self.links[0 if self.same else 1], j, self.weights[0][i])
            for k, m in zip(i.tolist(), j.tolist(), strict=True):
                self.join(k, m + self.offset)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)
