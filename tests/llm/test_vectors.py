"""Top-k search and product codes against brute force, with ties, gaps and odd tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import cover_tree, top_k, vector_codes

R = np.random.default_rng(7)
SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, v int, id string"


def table(spark, rows):
    """(id, vector, label) and columns named as the operators' own."""
    return spark.createDataFrame([(*row, "x", 1, "y") for row in rows], SCHEMA)


def whole(x):
    return math.floor(256 * float(np.float32(x)))


def usable(rows):
    return [
        (i, [whole(x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]


def messy(n, dim, spread=1.0):
    """Clusters, copies, ties, and vectors that must not count."""
    centers = R.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centers[R.integers(6)] * spread + R.normal(size=dim) * 0.2
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 4) if i % 7 else None))
    for i in range(0, n, 5):
        rows[i] = (i, rows[0][1], rows[i][2])
    bad = [None, [None] + [0.5] * (dim - 1), [float("nan")] * dim, [float("inf")] * dim]
    rows += [(n + j, v, 1) for j, v in enumerate(bad)]
    return [rows[i] for i in R.permutation(len(rows))]


# --- search -------------------------------------------------------------------


def best_of_all(rows, every, k):
    kept = [(i, v) for i, v, _ in usable(rows) if i is not None]
    out = []
    for q in sorted({i for i, _ in kept if i % every == 0}):
        own = min(v for i, v in kept if i == q)
        found = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in kept if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(found, 1)]
    return out


def found(spark, rows, every=3, **options):
    got = top_k.top_k(table(spark, rows), F.col("vec_id") % every == 0, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_search_equals_brute_force(spark):
    rows = messy(300, 16)
    want = best_of_all(rows, 3, 5)
    assert found(spark, rows) == want
    # Many small blocks, several chunks of queries.
    assert found(spark, rows, block_rows=32, strips=3, chunk_bytes=1024) == want
    # Every hundredth row asks; fewer candidates than k.
    assert found(spark, rows[:4], every=1) == best_of_all(rows[:4], 1, 5)


def test_search_of_odd_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 0)]) == []
    assert found(spark, [(0, [1.0], 0)]) == []
    assert found(spark, [(3, None, 0), (None, [1.0], 0)]) == []
    # Other lengths, none at all, one id on several rows, no id.
    rows = [(0, [1.0, 2.0], 0), (3, [1.0], 0), (4, [], 0), (6, [0.5, 0.25], 1), (6, [0.5, 0.125], 1), (6, [0.5, 0.25], 1),
            (7, [2.0, 2.0], 0), (7, [2.0, 2.0], 0), (None, [9.0, 9.0], 0)]
    assert found(spark, rows) == best_of_all(rows, 3, 5)
    # Products beyond 24 and beyond 53 bits.
    for scale in (2.0**7, 2.0**18):
        big = [(i, [float(x) * scale for x in R.integers(-4, 5, 6)], 0) for i in range(40)]
        assert found(spark, big) == best_of_all(big, 3, 5)


@pytest.mark.parametrize("leaf", [1, 8, 64])
def test_trees_cover_their_points(leaf):
    points = np.concatenate([R.integers(-50, 50, (200, 5)), np.zeros((60, 5), int), np.full((1, 5), 9999)]).astype(np.int32)
    tree = cover_tree.build(np.arange(len(points)) * 10, points, leaf)
    assert sorted(tree.ids) == [10 * i for i in range(len(points))]
    assert (tree.points == points[tree.ids // 10]).all()
    leaves = np.zeros(len(points), int)
    for n in range(len(tree.radii)):
        inside = tree.points[tree.first[n] : tree.last[n]].astype(float)
        gaps = np.sqrt(((inside - tree.points[tree.centers[n]]) ** 2).sum(1))
        assert gaps.max() <= tree.radii[n] + 1e-6
        kids = range(tree.kids[n], tree.kids_end[n])
        if kids:
            assert tree.first[kids[0]] == tree.first[n] and tree.last[kids[-1]] == tree.last[n]
            assert all(tree.last[a] == tree.first[a + 1] for a in kids[:-1])
        else:
            leaves[tree.first[n] : tree.last[n]] += 1
    assert (leaves == 1).all()


def test_search_prunes():
    centers = R.normal(size=(12, 24))
    own = R.integers(0, 12, 3000)
    points = np.floor(256 * (centers[own] * 3 + R.normal(size=(3000, 24)) * 0.05)).astype(np.int32)
    points = points[np.argsort(own, kind="stable")]
    trees = [cover_tree.build(np.arange(a, a + 1000), points[a : a + 1000], 16) for a in (0, 1000, 2000)]
    search = cover_tree.Search(trees, 5)
    for tree in trees:
        search.visit(tree)
    assert search.scored < 0.3 * 3000 * 3000
    for ids, others, scores in search.results():
        assert len(ids) == 5000
        assert ((points[ids].astype(int) * points[others]).sum(1) == scores).all()


# --- codes -----------------------------------------------------------------------


def coded(rows, parts, entries, rounds):
    """Every distance, one row after another."""
    kept = sorted(usable(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    cut = [
        (i, [(v + [0] * parts * width)[p * width : (p + 1) * width] for p in range(parts)], label) for i, v, label in kept
    ]
    books = [[v[p] for _, v, _ in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            to = [nearest(p, v[p])[1] for _, v, _ in cut]
            for n in range(len(books[p])):
                mine = [v[p] for (_, v, _), t in zip(cut, to) if t == n]
                if mine:
                    books[p][n] = [sum(c) // len(mine) for c in zip(*mine)]
        books = [[list(e) for e in book] for book in books]
    out = []
    for i, v, label in cut:
        best = [nearest(p, v[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{n:02x}" for _, n in best), sum(d for d, _ in best)))
    return out, books


@pytest.mark.parametrize("dim, parts, entries", [(16, 4, 12), (10, 4, 64), (8, 8, 1)])
def test_codes_equal_brute_force(spark, dim, parts, entries):
    rows = messy(150, dim)
    got, books = vector_codes.compress(table(spark, rows), parts=parts, entries=entries)
    want, want_books = coded(rows, parts, entries, vector_codes.ROUNDS)
    assert books.tolist() == want_books
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_code_report(spark):
    rows = [*messy(40, 32), (None, [0.25] * 32, None), (3, [0.5] * 32, 2), (3, [0.5] * 32, 2), (9, [0.125] * 20, 2)]
    got = vector_codes.code_report(table(spark, rows)).collect()
    want, books = coded(rows, 16, 64, 2)
    totals = {}
    for _, label, _, error in want:
        totals[label] = totals.get(label, 0) + error
    digest = vector_codes.codebook_digest(np.array(books))
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, c, e, totals[label], digest)) for i, label, c, e in want)
    assert vector_codes.code_report(table(spark, [])).collect() == []
    assert vector_codes.code_report(table(spark, [(1, None, 1)])).collect() == []


def test_orchard_measures_less_than_all_and_takes_the_lowest_of_ties():
    entries = R.integers(-300, 300, (64, 4))
    points = np.concatenate([entries[R.integers(0, 64, 1000)] + R.integers(-20, 21, (1000, 4)), entries])
    search = vector_codes.Orchard(entries)
    code, distance = search.nearest(points)
    all_of_them = ((points[:, None] - entries) ** 2).sum(2)
    assert (code == all_of_them.argmin(1)).all() and (distance == all_of_them.min(1)).all()
    assert search.measured < 0.6 * all_of_them.size
    # Points half-way between entries, and entries that agree.
    tied = np.array([[0, 0], [4, 0], [0, 4], [4, 4], [4, 4], [0, 0]])
    grid = np.array([[x, y] for x in range(-1, 6) for y in range(-1, 6)])
    code, _ = vector_codes.Orchard(tied).nearest(grid)
    assert (code == ((grid[:, None] - tied) ** 2).sum(2).argmin(1)).all()
