"""Cover trees over blocks of vectors, and the dual-tree search for the greatest inner products.

A node covers all its points within its radius round its centre, itself a point. Its
children form a net: their centres, the node's own among them, are more than half its radius
apart, and every point belongs to the nearest centre. Nodes of few points are not split
further, and small children of one node share a leaf.

For a query node (centre q, radius r) and a data node (centre p, radius s) no inner product
of their points exceeds q.p + r|p| + s|q| + r s (Curtin, Ram and Gray, "Fast exact max-kernel
search", 2013). A pair is pruned if that is less than the worst k-th score in the query node.
"""

from dataclasses import dataclass

import numpy as np

BLOCK_ROWS = 2048
LEAF_ROWS = 128
_NONE = np.iinfo(np.int64).min + 1  # can be negated
_LAST = np.iinfo(np.int64).max


@dataclass
class Tree:
    """A block in the order of its tree; children of a node are neighbours."""

    ids: np.ndarray  # a point's id
    points: np.ndarray  # points x dim, whole numbers
    centers: np.ndarray  # a node's centre, by place
    radii: np.ndarray
    first: np.ndarray  # a node's points: first to last - 1
    last: np.ndarray
    kids: np.ndarray  # a node's children: kids to kids_end - 1; none for a leaf
    kids_end: np.ndarray


def build(ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> Tree:
    """The tree of at least one and not too many points: all their distances are held."""
    x = points.astype(np.float64)
    square = (x * x).sum(1)
    gaps = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * (x @ x.T), 0))
    order = np.empty(len(ids), np.int64)
    # centre, radius, first, last, kids, kids_end
    nodes = [[0, float(gaps[0].max()), 0, len(ids), 0, 0]]
    waiting = [(0, np.arange(len(ids)))]
    for node, members in waiting:
        center, radius, first, _, _, _ = nodes[node]
        if len(members) <= leaf_rows or radius == 0:
            order[first : first + len(members)] = members
            continue
        nodes[node][4] = len(nodes)
        for kid_center, inside in _children(gaps, members, center, radius, leaf_rows):
            nodes.append([kid_center, float(gaps[kid_center, inside].max()), first, first + len(inside), 0, 0])
            # A leaf of small children may be as wide as its parent, and is not split.
            waiting.append((len(nodes) - 1, inside))
            first += len(inside)
        nodes[node][5] = len(nodes)
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    table = list(zip(*nodes))
    columns = [np.array(c, np.float64 if i == 1 else np.int64) for i, c in enumerate(table)]
    return Tree(ids[order], points[order], place[columns[0]], *columns[1:])


def _children(gaps, members, center, radius, leaf_rows):
    """(centre, members) of the children: a net of half the radius, small ones put together."""
    net = [center]
    nearest = gaps[center, members]
    while True:
        far = np.flatnonzero(nearest > radius / 2)
        if not len(far):
            break
        net.append(members[far[0]])
        nearest = np.minimum(nearest, gaps[net[-1], members])
    own = np.argmin(gaps[np.ix_(net, members)], 0) if len(net) > 1 else np.zeros(len(members), np.int64)
    by_own = np.argsort(own, kind="stable")
    sizes = np.bincount(own, minlength=len(net))
    small, held = [], 0
    for i, inside in enumerate(np.split(members[by_own], np.cumsum(sizes)[:-1])):
        if len(inside) >= leaf_rows // 4:
            yield net[i], inside
            continue
        if held + len(inside) > leaf_rows:
            yield small[0][0], np.concatenate([s for _, s in small])
            small, held = [], 0
        small.append((net[i], inside))
        held += len(inside)
    if small:
        yield small[0][0], np.concatenate([s for _, s in small])


class Best:
    """The k best scores so far of the queries of a tree, ties to the smaller id."""

    def __init__(self, queries: Tree, k: int):
        self.scores = np.full((len(queries.ids), k), _NONE)
        self.ids = np.full((len(queries.ids), k), _LAST)
        self.worst = np.full(len(queries.ids), -np.inf)
        self.k = k

    def add(self, first: int, last: int, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        """Take the scores (queries first to last - 1, by data points), those of own ids left out."""
        k = self.k
        least = self.worst[first:last]
        if scores.shape[1] > k + 1:
            # Its own id may be among a query's k + 1 greatest scores, once if ids are unique.
            cut = np.partition(scores, scores.shape[1] - k - 1, axis=1)[:, scores.shape[1] - k - 1]
            if len(np.unique(ids)) == len(ids):
                least = np.maximum(least, cut)
        who, what = np.nonzero(scores >= least[:, None])
        other = ids[what] != own[who]
        who, what = who[other], what[other]
        if not len(who):
            return
        rows = np.unique(who)
        who_all = np.concatenate([np.repeat(rows, k), who])
        score_all = np.concatenate([self.scores[first + rows].ravel(), scores[who, what].astype(np.int64)])
        ids_all = np.concatenate([self.ids[first + rows].ravel(), ids[what]])
        by = np.lexsort((ids_all, -score_all, who_all))
        starts = np.searchsorted(who_all[by], rows)
        taken = by[starts[:, None] + np.arange(k)]
        self.scores[first + rows] = score_all[taken]
        self.ids[first + rows] = ids_all[taken]
        full = self.scores[first + rows, -1]
        self.worst[first + rows] = np.where(full == _NONE, -np.inf, full.astype(np.float64))


class Search:
    """Dual-tree search of data blocks for the queries of several trees."""

    def __init__(self, trees: list[Tree], k: int):
        self.queries = [(t, Best(t, k), _Nodes(t)) for t in trees]
        self.scored = 0  # products made

    def visit(self, data: Tree) -> None:
        """Compare all queries with the points of a block."""
        nodes = _Nodes(data)
        for tree, best, own in self.queries:
            self._pair(tree, best, own, data, nodes)

    def _pair(self, tree, best, q, data, p):
        product = _product(tree, q, data, p)
        waiting = [(0, 0, np.inf)]
        while waiting:
            a, b, bound = waiting.pop()
            if bound < best.worst[tree.first[a] : tree.last[a]].min():
                continue
            split_a, split_b = tree.kids_end[a] > tree.kids[a], data.kids_end[b] > data.kids[b]
            if not split_a and not split_b:
                i, j, m, n = tree.first[a], tree.last[a], data.first[b], data.last[b]
                self.scored += int((j - i) * (n - m))
                best.add(i, j, product(i, j, m, n), data.ids[m:n], tree.ids[i:j])
                continue
            if split_b and (not split_a or data.radii[b] >= tree.radii[a]):
                pairs = [(a, kid) for kid in range(data.kids[b], data.kids_end[b])]
                bounds = q.bounds(a, p, slice(data.kids[b], data.kids_end[b]))
            else:
                pairs = [(kid, b) for kid in range(tree.kids[a], tree.kids_end[a])]
                bounds = p.bounds(b, q, slice(tree.kids[a], tree.kids_end[a]))
            # The most promising pair is taken next.
            waiting += [(*pairs[i], bounds[i]) for i in np.argsort(bounds, kind="stable")]

    def results(self):
        """(query ids, ids, scores) of what was found, one entry for each, over all trees."""
        for tree, best, _ in self.queries:
            who, place = np.nonzero(best.scores != _NONE)
            yield tree.ids[who], best.ids[who, place], best.scores[who, place]


class _Nodes:
    """Centres of a tree's nodes for bounds."""

    def __init__(self, tree: Tree):
        self.centers = tree.points[tree.centers].astype(np.float64)
        self.norms = np.sqrt((self.centers**2).sum(1))
        self.radii = tree.radii
        self.longest = float(np.sqrt((tree.points.astype(np.float64) ** 2).sum(1).max()))

    def bounds(self, node: int, other: "_Nodes", some: slice) -> np.ndarray:
        """No inner product of the node's points and those of the other nodes is greater."""
        c, r, s = self.centers[node], self.radii[node], other.radii[some]
        reach = r * other.norms[some] + s * self.norms[node] + r * s
        bound = other.centers[some] @ c + reach
        return bound + 1e-9 * (1 + np.abs(bound) + reach)  # more than the rounding


def _product(tree: Tree, q: _Nodes, data: Tree, p: _Nodes):
    """Inner products of ranges of points, exact: no partial sum exceeds the product of the lengths."""
    most = q.longest * p.longest
    if most >= 2.0**62:
        raise ValueError("inner products may not fit 64 bits")
    kind = np.float32 if most < 2.0**23 else np.float64 if most < 2.0**52 else np.int64
    x, y = tree.points.astype(kind), data.points.astype(kind).T
    return lambda i, j, m, n: x[i:j] @ y[:, m:n]
