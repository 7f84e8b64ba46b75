"""Cover trees over integer vectors, and the dual search for largest inner products."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LEAF = 48
BRANCHES = 24
MOST = 0.9  # of the pairs of leaves: with more of them left, going on down saves little
SOME = 64  # leaves compared at once, once every query has a kth score


@dataclass
class Node:
    center: np.ndarray
    norm: float  # of the center
    radius: float  # of the ball around the center that covers all rows below
    rows: np.ndarray  # all rows below
    children: list["Node"] = field(default_factory=list)


def build(vectors: np.ndarray, rows: np.ndarray | None = None, center: int | None = None, far=None) -> Node:
    """A tree over ``rows``. The children's centers are rows, the node's own center among them, picked
    farthest first until half the node's radius covers all (or ``BRANCHES`` are picked)."""
    rows = np.arange(len(vectors)) if rows is None else rows
    center = int(rows[0]) if center is None else center
    own = vectors[rows]

    def distances_to(row: int) -> np.ndarray:
        between = own - vectors[row]
        return np.sqrt(np.einsum("ij,ij->i", between, between))

    far = distances_to(center) if far is None else far
    radius = float(far.max())
    node = Node(vectors[center], float(np.sqrt((vectors[center] ** 2).sum())), radius, rows)
    if len(rows) <= LEAF or radius == 0:
        return node
    nearest, owner, centers, distances = far.copy(), np.zeros(len(rows), int), [center], far
    distances = [far]
    while nearest.max() > radius / 2 and len(centers) < BRANCHES:
        pick = int(rows[nearest.argmax()])
        d = distances_to(pick)
        closer = d < nearest
        owner[closer], nearest[closer] = len(centers), d[closer]
        centers.append(pick)
        distances.append(d)
    if len(centers) == 1:
        return node
    for k, own in enumerate(centers):
        mine = owner == k
        if mine.any():
            node.children.append(build(vectors, rows[mine], own, distances[k][mine]))
    return node


class Tree:
    """The nodes of a tree as arrays, and its vectors in the order of its leaves: a node's leaves, and rows, lie side by side."""

    def __init__(self, vectors: np.ndarray):
        nodes, self.children, first, leaves = [], [], [], []

        def add(node: Node) -> int:
            at = len(nodes)
            nodes.append(node)
            self.children.append(None)
            first.append([len(leaves), 0])
            if not node.children:
                leaves.append(at)
            self.children[at] = np.array([add(child) for child in node.children], np.int64)
            first[at][1] = len(leaves)
            return at

        add(build(vectors))
        self.center = np.stack([node.center for node in nodes])
        self.norm, self.radius = np.array([node.norm for node in nodes]), np.array([node.radius for node in nodes])
        self.leaf = np.array([not len(c) for c in self.children])
        self.below = np.array(first)  # leaves, by their number
        self.leaves = np.array(leaves)
        self.start = np.append(0, np.cumsum([len(nodes[n].rows) for n in leaves]))  # of the rows of each leaf
        self.rows = np.concatenate([nodes[n].rows for n in leaves])
        self.vectors = vectors[self.rows]
        self.largest = np.abs(vectors).max()

    def limits(self, nodes: np.ndarray, of: "Tree", other: np.ndarray) -> np.ndarray:
        """No inner product of a row below one of ``nodes`` with one below one of ``other`` of the other tree is larger."""
        radius, norm = of.radius[other], of.norm[other]
        return self.center[nodes] @ of.center[other].T + np.outer(self.norm[nodes], radius) + np.outer(self.radius[nodes], norm + radius)


class Best:
    """The k best (score, then smaller id) of every query."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)
        self.floor = floor  # known lower bounds of the kth score

    def bar(self, rows: np.ndarray) -> np.ndarray:
        """What a score of these queries must reach."""
        return np.maximum(self.score[rows, -1], self.floor[rows])

    def offer(self, rows: np.ndarray, names: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of all pairs of ``rows``, queries called ``names``, and ``ids``; a pair of one name doesn't count."""
        at, of = np.nonzero(scores >= self.bar(rows)[:, None])
        other = names[at] != ids[of]
        at, of = at[other], of[other]
        if not len(at):
            return
        some = np.unique(at)
        row = np.concatenate([np.repeat(some, self.k), at])
        score = np.concatenate([self.score[rows[some]].ravel(), scores[at, of]])
        name = np.concatenate([self.id[rows[some]].ravel(), ids[of]])
        order = np.lexsort((name, -score, row))
        row = row[order]
        first = np.searchsorted(row, some)
        kept = order[first[:, None] + np.arange(self.k)]  # every row has k at least
        self.score[rows[some]], self.id[rows[some]] = score[kept], name[kept]


def search(
    queries: np.ndarray | Tree,
    query_ids: np.ndarray,
    points: np.ndarray | Tree,
    point_ids: np.ndarray,
    k: int,
    floor: np.ndarray,
    best: Best | None = None,
) -> tuple[Best, int]:
    """The k points of largest inner product of every query, but points of its own id; pairs compared. ``best``, from a
    search of the same queries in other points, goes on.

    Vectors hold whole numbers as floats; products below 2**53 are exact. Both trees are descended together: below a
    query node go on those nodes of points whose limit reaches the worst kth score of the queries under it. Where most
    pairs of the leaves below reach it, they are compared at once, those of the largest limits first.
    """
    best, compared = best or Best(len(query_ids), k, floor), 0
    if not len(query_ids) or not len(point_ids):
        return best, 0
    queries, points = (x if isinstance(x, Tree) else Tree(x) for x in (queries, points))
    most = queries.largest * points.largest * queries.vectors.shape[1]
    slack = 1e-9 * (1 + most)
    kind = np.float32 if most < 1 << 24 else np.float64  # sums of whole numbers that are exact
    left, right, names = queries.vectors.astype(kind), points.vectors.astype(kind), point_ids[points.rows]

    def compare(here: np.ndarray, leaves: np.ndarray) -> int:
        spans = np.sort(leaves)
        at = np.concatenate([np.arange(c, d) for c, d in zip(points.start[spans], points.start[spans + 1])])
        whole = len(at) == len(names)
        rows = queries.rows[here]
        best.offer(rows, query_ids[rows], left[here] @ (right if whole else right[at]).T, names if whole else names[at])
        return len(here) * len(at)

    stack = [(0, np.array([0]))]
    while stack:
        q, nodes = stack.pop()
        first, last = queries.below[q]
        here = np.arange(queries.start[first], queries.start[last])
        rows = queries.rows[here]
        while True:
            limit = points.limits(nodes, queries, np.array([q]))[:, 0] + slack
            reach = limit >= best.bar(rows).min()
            nodes, limit = nodes[reach], limit[reach]
            part = ~points.leaf[nodes] & (queries.leaf[q] | (points.radius[nodes] > queries.radius[q]))
            if not part.any():
                break
            nodes = np.concatenate([nodes[~part], *[points.children[n] for n in nodes[part]]])
        if not len(nodes):
            continue
        by = np.argsort(-limit, kind="stable")
        leaves = np.concatenate([np.arange(*points.below[n]) for n in nodes[by]])
        step = 1
        while len(leaves) and not np.isfinite(best.bar(rows)).all():
            compared += compare(here, leaves[:step])
            leaves, step = leaves[step:], 2 * step
        if not len(leaves):
            continue
        limit = points.limits(points.leaves[leaves], queries, queries.leaves[first:last]) + slack
        bar = np.minimum.reduceat(best.bar(rows), queries.start[first:last] - queries.start[first])
        reach = limit >= bar
        share = np.diff(points.start)[leaves] @ reach @ np.diff(queries.start)[first:last] / (len(here) * np.diff(points.start)[leaves].sum())
        if not queries.leaf[q] and len(here) > LEAF and share < MOST:
            stack += [(c, points.leaves[leaves]) for c in queries.children[q]]
            continue
        some = np.repeat(reach.any(0), np.diff(queries.start)[first:last])
        leaves, here = leaves[reach.any(1)], here[some]
        while len(leaves):
            compared += compare(here, leaves[: max(step, SOME)])
            leaves, step = leaves[max(step, SOME) :], 2 * max(step, SOME)
    return best, compared
