"""Exact and approximate vector search against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest

from tastemap.llm import ann, topk_search

from llm_fixtures import SMALL, documents, frame  # noqa: F401


@pytest.fixture
def vectors(frame):
    def build(rows):
        return frame(vec_id=(pa.int64(), [r[0] for r in rows]), embedding=(pa.list_(pa.float32()), [r[1] for r in rows]),
                     label=(pa.int32(), [0] * len(rows)), score=(pa.string(), ["x"] * len(rows)))
    return build


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def brute_topk(rows, k, every):
    ints = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if usable(v)]
    out = {}
    for q, qv in ints:
        if q % every == 0:
            found = {(-sum(a * b for a, b in zip(qv, v)), i) for i, v in ints if i != q and len(v) == len(qv)}
            out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_topk_ties_nulls_and_repeats(vectors):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(400)]      # many ties
    rows += [(1000, None), (1001, [1.0, None, 0.0, 0.0]), (1002, [float("nan")] * 4), (1003, [float("inf"), 0.0, 0.0, 0.0]),
             (1100, [0.0] * 4), (1200, []), rows[3], rows[3], (100, rows[100][1]), (1300, [1.0, 2.0])]
    want = brute_topk(rows, 10, 100)
    df = topk_search.top_k(vectors(rows), block_rows=64, query_block=2)
    result = got(df)
    want.pop(1300, None)
    assert result == want and len(result[0]) == 10


def test_topk_big_values_stay_exact(vectors):
    rows = [(i, [float(2**30 + i), float(-(2**29) + 3 * i)]) for i in range(0, 300, 7)] + [(0, [float(2**28), 1.0])]
    rows = list({i: v for i, v in rows}.items())
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    with np.errstate(over="ignore"):
        want = brute_topk(rows, 10, 100)
    assert {k: v for k, v in got(topk_search.top_k(vectors(rows))).items()} == {
        k: v for k, v in want.items()} or max(abs(s) for v in want.values() for _, s in v) >= 2**63


def test_topk_empty_and_lonely(vectors):
    assert topk_search.top_k(vectors([])).count() == 0
    assert topk_search.top_k(vectors([(0, [1.0])])).count() == 0
    assert got(topk_search.top_k(vectors([(0, [1.0]), (5, [2.0])]))) == {0: [(5, 1024 * 2048)]}


def test_threshold_search_stops_early():
    rng = np.random.default_rng(0)
    x = np.sort(rng.exponential(1, (5000, 3)) * 100, axis=0)[::-1].round()      # correlated lists
    lists = np.argsort(x, axis=0, kind="stable")
    seen = []

    class Counting(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple) and isinstance(key[0], slice):
                seen.append(key[0].stop)
            return super().__getitem__(key)

    ids, scores = topk_search.threshold_search(x, np.arange(5000), lists.view(Counting), np.array([1.0, 2.0, 3.0]), -1, 10)
    best = np.lexsort((np.arange(5000), -(x @ np.array([1.0, 2.0, 3.0]))))[:10]
    assert ids.tolist() == best.tolist() and len(seen) <= 6


def brute_cosine(rows, k, every):
    x = {i: np.array(v, float) for i, v in rows if usable(v) and any(v)}
    out = {}
    for q in x:
        if q % every == 0:
            s = sorted((-float(x[q] @ v) / (math.sqrt(x[q] @ x[q]) * math.sqrt(v @ v)), i) for i, v in x.items() if i != q)
            out[q] = [(i, -d) for d, i in s[:k]]
    return out


def recall(result, want):
    hits = sum(len({i for i, _ in result.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(len(w) for w in want.values())


def test_ann_recall_on_given_vectors(spark):
    df = spark.read.parquet(f"{SMALL.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want, result = brute_cosine(rows, 5, 50), got(ann.nearest(df))
    assert set(result) == set(want) and recall(result, want) >= 0.9
    exact = {q: dict(brute) for q, brute in brute_cosine(rows, len(rows), 50).items()}
    for q, found in result.items():
        assert len(found) == 5 and all(abs(exact[q][i] - s) < 1e-12 for i, s in found)
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)


def test_ann_hot_vector_is_dealt_into_tiles(vectors):
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 else rng.standard_normal(4).tolist()) for i in range(900)]
    result = got(ann.nearest(vectors(rows), list_rows=50, block_rows=40, probe=1.0))
    want = brute_cosine([(i, np.array(v, np.float32).tolist()) for i, v in rows], 5, 50)
    assert recall(result, want) >= 0.99
    assert [i for i, _ in result[50]] == [1, 2, 4, 5, 7]                      # equal vectors: smaller ids


def test_ann_odd_rows(vectors):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]),
            (6, [float("nan"), 1.0]), (7, [1.0]), (50, None), (100, [0.0, 3.0]), (1, [2.0, 0.0])]
    result = got(ann.nearest(vectors(rows), probe=1.0))
    assert result == {0: [(1, 1.0), (2, 0.0), (100, 0.0)], 100: [(2, 1.0), (0, 0.0), (1, 0.0)]}
    assert ann.nearest(vectors([])).count() == 0
    assert ann.nearest(vectors([(0, [1.0, 1.0])])).count() == 0


def test_ann_searches_each_length_on_its_own(vectors):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(4 if i % 3 else 7).astype(np.float32).tolist()) for i in range(600)] + [(1000, [2.0] * 9)]
    width = {i: len(v) for i, v in rows}
    want = {q: found for w in (4, 7) for q, found in brute_cosine([r for r in rows if width[r[0]] == w], 5, 50).items()}
    for more in ({}, {"sample_rows": 5}):                     # few sampled rows: a length may have none
        result = got(ann.nearest(vectors(rows), list_rows=40, block_rows=60, probe=1.0, **more))
        assert {q: [i for i, _ in found] for q, found in result.items()} == {q: [i for i, _ in found] for q, found in want.items()}
        assert {width[q] for q in result} == {4, 7}
    both = [(0, [1.0, 0.0]), (0, [1.0]), (1, [2.0, 1.0]), (2, [3.0])]          # an id of two lengths asks in both
    assert [i for i, _ in got(ann.nearest(vectors(both), probe=1.0))[0]] == [2, 1]


def test_centroids_and_rotation():
    q = ann.rotation(8)
    assert np.allclose(q @ q.T, np.eye(8))
    c = ann.fit_lists(ann.unit(np.random.default_rng(0).standard_normal((200, 8))), 10)
    assert c.shape == (10, 8) and np.allclose((c * c).sum(axis=1), 1)


@pytest.mark.parametrize("others", [10, 40, 100])
def test_ann_finds_all_it_can_beside_many_repeats(vectors, others):
    rng = np.random.default_rng(others)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(1, others + 1) if i != 50]
    hot = rng.standard_normal(8).tolist()
    found = got(ann.nearest(vectors(rows + [(50, hot)] * 1500)))            # the probe share of production
    plain = {q: v for q, v in brute_cosine(rows + [(50, hot)], 5, 50).items()}
    assert found.keys() == plain.keys() and all(len(found[q]) == min(5, others - 1 + (others < 50)) for q in found)
    if others <= 40:
        assert [i for i, _ in found[50]] == [i for i, _ in plain[50]]


def test_ann_hot_vector_under_many_ids(vectors):
    rng = np.random.default_rng(3)
    hot = rng.standard_normal(8).tolist()
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)] + [(i, hot) for i in range(1000, 2000)]
    found = got(ann.nearest(vectors(rows)))
    assert all(len(v) == 5 for v in found.values()) and len(found) == 6 + 20
    assert [i for i, _ in found[1000]] == [1001, 1002, 1003, 1004, 1005]
