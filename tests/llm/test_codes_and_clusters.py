"""Vector codes over cover trees and centroids with pivots, against plain Lloyd's rounds."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from tastemap.llm import pivot_clusters, vector_codes

from llm_fixtures import frame  # noqa: F401


@pytest.fixture
def vectors(frame):
    """vec_id, embedding, label rows, with extra columns of clashing names."""
    def build(rows):
        return frame(vec_id=(pa.int64(), [r[0] for r in rows]), embedding=(pa.list_(pa.float32()), [r[1] for r in rows]),
                     label=(pa.int32(), [r[2] for r in rows]), code=(pa.string(), ["x"] * len(rows)),
                     cluster=(pa.string(), ["y"] * len(rows)), v=(pa.string(), ["z"] * len(rows)))
    return build


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def ints(rows, scale):
    return [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows if usable(v)]


def sq(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def lloyd(points, book, rounds):
    """(final entries, index of the nearest entry of every point), in whole numbers."""
    def near():
        return [min(range(len(book)), key=lambda j: (sq(p, book[j]), j)) for p in points]

    for _ in range(rounds):
        at = near()
        for j in set(at):
            own = [p for p, a in zip(points, at) if a == j]
            book[j] = [sum(c) // len(own) for c in zip(*own)]
    return book, near()


def by_id(row):
    return (row[0] is None, row[0] or 0, row[1])


def brute_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    out, kept = [], sorted(ints(rows, scale), key=by_id)
    for dim in {len(v) for _, v, _ in kept}:
        own, edge = [r for r in kept if len(r[1]) == dim], vector_codes.cuts(dim, parts)
        codes, errors, books = [""] * len(own), [0] * len(own), []
        for a, b in zip(edge, edge[1:]):
            points = [v[a:b] for _, v, _ in own]
            book, at = lloyd(points, [list(p) for p in points[:entries]], rounds)
            codes = [c + "%02x" % j for c, j in zip(codes, at)]
            errors = [e + sq(p, book[j]) for e, p, j in zip(errors, points, at)]
            books += [c for entry in book for c in entry]
        told = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
        out += [(i, c, e, label, told) for (i, _, label), c, e in zip(own, codes, errors)]
    total = {}
    for _, _, e, label, _ in out:
        total[label] = total.get(label, 0) + e
    return sorted(((i, c, e, total[label], told) for i, c, e, label, told in out), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_vectors(rng, dim):
    rows = [(i, rng.integers(-3, 4, dim).astype(float).tolist(), int(i) % 3) for i in range(300)]          # many ties
    rows += [(i, rng.standard_normal(dim).tolist(), None) for i in range(300, 420)]
    rows += [(i, rows[7][1], 5) for i in range(500, 700)]                                                  # a hot vector
    rows += [rows[3], rows[3], (3, rows[9][1], 1), (None, rows[11][1], 2), (None, rows[12][1], None)]
    rows += [(900, None, 0), (901, [None] + [0.0] * (dim - 1), 0), (902, [float("nan")] * dim, 0), (903, [float("inf")] * dim, 0)]
    return rows


def test_codes_equal_plain_rounds(vectors):
    rows = odd_vectors(np.random.default_rng(4), 8)
    got = vector_codes.compress(vectors(rows).repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert rows_of(got) == brute_codes(rows)


def test_codes_of_other_lengths_and_few_rows(vectors):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(d).tolist(), i) for i, d in enumerate([8] * 9 + [6] * 5 + [3] * 4 + [1, 0, 0])]
    assert rows_of(vector_codes.compress(vectors(rows), entries=4)) == brute_codes(rows, entries=4)
    assert vector_codes.compress(vectors([])).count() == 0
    assert vector_codes.compress(vectors([(1, None, 0)])).count() == 0


def test_codes_stay_exact_on_large_components(vectors):
    rows = [(i, [float(2 ** 16 + 7 * i), float(-(2 ** 15) + i * i)] * 4, 0) for i in range(60)]
    assert rows_of(vector_codes.compress(vectors(rows), entries=6)) == brute_codes(rows, entries=6)
    top = rows_of(vector_codes.compress(vectors([(1, [3e38] * 4, 0), (2, [-3e38] * 4, 0)])))
    assert [r[2] for r in top] == [0, 0]                                    # held within the bound, no overflow


def test_tree_covers_its_points():
    rng = np.random.default_rng(6)
    rows = np.concatenate([rng.integers(-900, 900, (700, 4)), np.zeros((300, 4), np.int64)])
    tree = vector_codes.Tree.build(rows)
    assert np.array_equal(tree.points[tree.where], rows) and len(tree.points) == len(np.unique(rows, axis=0))
    for (lo, hi, child, n), radius in zip(tree.nodes.tolist(), tree.radius.tolist()):
        far = np.sqrt(((tree.points[lo:hi] - tree.points[lo]) ** 2).sum(axis=1)).max()
        assert far <= radius <= far + 1e-6
        if n:
            parts = tree.nodes[child:child + n, :2].tolist()
            assert parts[0][0] == lo and parts[-1][1] == hi and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
            for a, _ in parts[1:]:                                          # siblings are apart
                assert np.sqrt(((tree.points[a] - tree.points[lo]) ** 2).sum()) > radius / vector_codes.SHRINK
        else:
            assert hi - lo <= vector_codes.LEAF
    again = vector_codes.Tree.unpack(rows, *tree.pack())
    assert all(np.array_equal(a, b) for a, b in zip(tree, again))


def test_tree_assigns_whole_subtrees():
    rng = np.random.default_rng(7)
    centres = rng.integers(-100_000, 100_000, (20, 8))
    rows = (centres[:, None, :] + rng.integers(-40, 41, (20, 200, 8))).reshape(-1, 8)
    tree = vector_codes.Tree.build(rows)
    label, looked = tree.assign(centres)
    assert looked < len(rows) / 50                                          # the rest went with its subtree
    assert np.array_equal(label[tree.where], vector_codes.squared(rows, centres).argmin(axis=1))
    count, total = tree.sums(label, 20)
    assert count.tolist() == np.bincount(label[tree.where], minlength=20).tolist()
    assert np.array_equal(total, np.stack([rows[label[tree.where] == j].sum(axis=0) for j in range(20)]))


def brute_clusters(rows, dim, k=16, rounds=3, scale=64):
    kept = [(i, v) for i, v, _ in ints(rows, scale) if len(v) == dim]
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    book, at = lloyd([v for _, v in kept], [list(v) for _, v in kept[:k]], rounds)
    dist = [sq(v, book[j]) for (_, v), j in zip(kept, at)]
    own = {j: sum(d for d, a in zip(dist, at) if a == j) for j in set(at)}
    return sorted(((i, j, d, own[j], sum(dist), hashlib.sha256(",".join(map(str, book[j])).encode()).hexdigest())
                   for (i, _), j, d in zip(kept, at, dist)), key=str)


def test_clusters_equal_plain_rounds(vectors):
    rows = odd_vectors(np.random.default_rng(8), 64) + [(950, [1.0] * 63, 0), (951, [], 0)]
    got = pivot_clusters.cluster(vectors(rows).repartition(3))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert rows_of(got) == brute_clusters(rows, 64)


def test_clusters_of_few_equal_and_large_vectors(vectors):
    rows = [(i, [1.0, 2.0], 0) for i in range(20)] + [(30, [4.0, 4.0], 0)]
    assert rows_of(pivot_clusters.cluster(vectors(rows), dim=2)) == brute_clusters(rows, 2)
    assert rows_of(pivot_clusters.cluster(vectors(rows[:3]), dim=2)) == brute_clusters(rows[:3], 2)
    rows = [(i, [float(2 ** 20 + 3 * i), float(i * i)], 0) for i in range(80)]
    assert rows_of(pivot_clusters.cluster(vectors(rows), dim=2, k=5)) == brute_clusters(rows, 2, k=5)
    assert pivot_clusters.cluster(vectors([]), dim=2).count() == 0
    assert pivot_clusters.cluster(vectors([(1, [1.0], 0)]), dim=2).count() == 0


def test_pivot_bounds_hold_and_save_work():
    rng = np.random.default_rng(9)
    centres = rng.integers(-5000, 5000, (16, 64))
    x = (centres[rng.integers(0, 16, 3000)] + rng.integers(-60, 61, (3000, 64)))
    pivots = pivot_clusters.Pivots(centres)
    bounds = pivots.bounds(pivot_clusters.distances(x, pivots.points), centres)
    true = pivot_clusters.distances(x, centres)
    assert (bounds <= true).all() and len(pivots.pairs) == 15
    label, best, looked = pivot_clusters.assign(x, bounds, centres)
    assert np.array_equal(label, ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1))
    assert np.array_equal(best, ((x - centres[label]) ** 2).sum(axis=1))
    assert looked < 3 * len(x)                                              # of 16 centroids each
