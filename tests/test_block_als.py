"""Least squares over shared layouts, sliced lists and shared grids, against plain numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tastemap.operators import als as als_ops
from tastemap.operators import block_als, top_n, tuning
from tastemap.operators.ranking import ranking_metrics
from tastemap.session import scratch_path

KIND = "user_id LONG, item_id LONG, rating DOUBLE"
P = block_als.Point


def ratings_of(n_users=40, n_items=25, each=9, seed=1, hot=None):
    rng = np.random.default_rng(seed)
    u, v = rng.uniform(0.2, 1.2, (n_users, 3)), rng.uniform(0.2, 1.2, (n_items, 3))
    rows = [(i, int(j), float(u[i] @ v[j])) for i in range(n_users) for j in rng.choice(n_items, each, replace=False)]
    if hot is not None:                                    # one user with a third of all rows, pairs repeated
        rows += [(hot, int(rng.integers(n_items)), float(rng.uniform(1, 5))) for _ in range(len(rows) // 2)]
    return rows


def plain_fit(rows, point, rounds, seed=als_ops.ALS_SEED):
    """users, items -> factors, by the definition, in the same 32-bit storage."""
    ids = [sorted({r[s] for r in rows}) for s in (0, 1)]
    x = block_als._normal(np.array(ids[0], np.int64), point.rank, seed)
    x = np.abs(x) if point.nonnegative else x
    sides = [dict(zip(ids[0], (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype("<f4").astype(float))), None]
    for _ in range(rounds):
        for own in (1, 0):
            other, out = sides[1 - own], {}
            gram = sum(np.outer(f, f) for f in other.values()) if point.implicit else 0
            for i in ids[own]:
                mine = [r for r in rows if r[own] == i]
                f, r = np.stack([other[m[1 - own]] for m in mine]), np.array([m[2] for m in mine])
                c = point.alpha * np.abs(r)
                if point.implicit:
                    a, b, n = gram + f.T @ (f * c[:, None]), f.T @ ((1 + c) * (r > 0)), (r > 0).sum()
                else:
                    a, b, n = f.T @ f, f.T @ r, len(r)
                out[i] = block_als.solve(np.array([a]), b[None], np.array([n]), np.zeros((point.rank,) * 2), point)[0].astype("<f4").astype(float)
            sides[own] = out
    return sides


def table(model, kind, n):
    return {r["id"]: np.array(r["features"]) for r in model.factors(kind, n).collect()}


POINTS = [P(3, 0.1), P(20, 0.05), P(2, 0.1, nonnegative=True), P(4, 0.1, True, 0.5), P(18, 0.2, True)]


@pytest.mark.parametrize("hot", [None, 7])
def test_factors_equal_plain_least_squares(spark, hot):
    rows = ratings_of(hot=hot)
    df = spark.createDataFrame(rows, KIND)
    fits = block_als.fit(df, POINTS, (1, 3), per_block=64, per_id=16)
    for rounds, model in fits.items():
        for n, point in enumerate(POINTS):
            want = plain_fit(rows, point, rounds)
            for side, kind in enumerate(("user", "item")):
                got = table(model, kind, n)
                assert got.keys() == want[side].keys()
                assert max(np.abs(got[i] - want[side][i]).max() for i in got) < 2e-3 * max(1, max(np.abs(v).max() for v in want[side].values()))


def test_hot_user_is_spread_and_solved(spark):
    rows = ratings_of(hot=7)
    df = spark.createDataFrame(rows, KIND)
    layout = block_als.lay_out(df, "user_id", "item_id", "rating", 64, 16)
    held = [(set(np.frombuffer(r["ids"], np.int64).tolist()), len(r["ratings"]) // 8) for r in layout.blocks.collect()]
    of_hot = [n for ids, n in held if 7 in ids]
    assert layout.hot_parts >= len(of_hot) > 4 and sum(n for _, n in held) == len(rows)
    assert max(n for _, n in held) < len(rows) / 3                          # no block holds the user's whole third
    model = block_als.fit(df, [P(3, 0.1)], (3,), per_block=64, per_id=16)[3]
    users, items = table(model, "user", 0), table(model, "item", 0)
    for u in (7, 3):                                                        # the normal equations of the side solved last
        f = np.stack([items[i] for a, i, _ in rows if a == u])
        r = np.array([r for a, _, r in rows if a == u])
        a, b = f.T @ f + 0.1 * len(r) * np.eye(3), f.T @ r
        assert np.abs(a @ users[u] - b).max() < 1e-4 * np.abs(b).max()


def test_factors_do_not_depend_on_the_blocks(spark):
    df = spark.createDataFrame(ratings_of(hot=3), KIND)
    a, b = (block_als.fit(df.repartition(n), [P(3, 0.1), P(3, 0.1, True)], (2,), per_block=k, per_id=h)[2]
            for n, k, h in ((1, 10_000, 10_000), (5, 40, 8)))
    for kind in ("user", "item"):
        for n in range(2):
            x, y = table(a, kind, n), table(b, kind, n)
            assert x.keys() == y.keys() and all(np.allclose(x[i], y[i], atol=1e-4) for i in x)


def test_many_partial_equations_are_added_in_levels(spark, monkeypatch):
    monkeypatch.setattr(block_als, "FAN", 2)
    rows = ratings_of(hot=7)
    model = block_als.fit(spark.createDataFrame(rows, KIND), [P(3, 0.1)], (1,), per_block=16, per_id=4)[1]
    want = plain_fit(rows, P(3, 0.1), 1)
    got = table(model, "user", 0)
    assert all(np.allclose(got[i], want[0][i], atol=1e-3) for i in got)


def test_odd_ratings(spark):
    rows = [(1, 1, 2.0), (1, 1, 2.0), (2, 1, 0.0), (2, 2, -1.0), (None, 1, 3.0), (1, None, 3.0), (3, 2, None), (2 ** 40, 2 ** 41, 1.0)]
    model = block_als.fit(spark.createDataFrame(rows, KIND), [P(2, 0.1), P(2, 0.1, True)], (2,))[2]
    assert set(table(model, "user", 0)) == {1, 2, 2 ** 40} and set(table(model, "item", 1)) == {1, 2, 2 ** 41}
    assert all(np.isfinite(v).all() for n in (0, 1) for v in table(model, "user", n).values())
    empty = block_als.fit(spark.createDataFrame([], KIND), [P(2, 0.1)], (1,))[1]
    assert empty.users.count() == empty.items.count() == 0


def test_nonnegative_solutions_meet_their_conditions():
    rng = np.random.default_rng(0)
    f = rng.normal(size=(30, 12, 6))
    a, b = np.einsum("nij,nik->njk", f, f) + 0.1 * np.eye(6), rng.normal(size=(30, 6)) * 3
    x = block_als.nonnegative(a, b)
    slope = np.einsum("nij,nj->ni", a, x) - b
    assert (x >= 0).all() and (slope > -1e-6).all() and np.abs(slope[x > 0]).max() < 1e-6


# --- lists ------------------------------------------------------------------------

def plain_lists(users, items, n):
    out = {}
    for u, x in users.items():
        scored = sorted((-float(np.asarray(x, "<f4").astype(float) @ np.asarray(y, "<f4").astype(float)), i) for i, y in items.items())[:n]
        out[u] = [(i, -s) for s, i in scored]
    return out


def as_lists(df):
    out = {}
    for r in df.orderBy("user_id", "rank").collect():
        out.setdefault(r["user_id"], []).append((r["item_id"], r["score"]))
        assert r["rank"] == len(out[r["user_id"]])
    return out


def vectors(spark, side):
    return spark.createDataFrame([(i, [float(c) for c in v]) for i, v in side.items()], "id LONG, features ARRAY<FLOAT>")


@pytest.mark.parametrize("slice_items,tile_users", [(None, None), (7, 5), (1, 1000)])
def test_lists_equal_plain_scores(spark, slice_items, tile_users):
    rng = np.random.default_rng(4)
    users = {i: rng.integers(-2, 3, 4) for i in range(30)}                  # whole numbers: many ties
    items = {100 + i: rng.integers(-2, 3, 4) for i in range(60)}
    got = as_lists(top_n.exact_top_n(vectors(spark, users), vectors(spark, items), 8, 4, slice_items=slice_items, tile_users=tile_users))
    want = plain_lists(users, items, 8)
    assert got == want


def test_lists_of_few_or_no_items(spark):
    users, items = {1: [1, 0], 2: [0, -1]}, {5: [2, 3], 6: [1, 1]}
    assert as_lists(top_n.exact_top_n(vectors(spark, users), vectors(spark, items), 10, 2)) == plain_lists(users, items, 10)
    assert top_n.exact_top_n(vectors(spark, {}), vectors(spark, items), 10, 2).count() == 0
    assert top_n.exact_top_n(vectors(spark, users), vectors(spark, {}), 10, 2).count() == 0


def test_search_stops_when_norms_cannot_win(spark):
    rng = np.random.default_rng(5)
    users = {i: np.abs(rng.normal(size=6)) for i in range(50)}
    items = {i: np.abs(rng.normal(size=6)) * 50 / (1 + i) for i in range(2000)}              # norms fall fast
    a, b = (top_n.packed_vectors(vectors(spark, s)) for s in (users, items))
    tiles = top_n.top_lists(a, b, 5, [6], slice_items=50, tile_users=25)
    assert as_lists(top_n.explode_lists(tiles, [6], 5).drop("point")) == plain_lists(users, items, 5)
    scored = tiles.agg(F.sum("scored")).first()[0]
    assert 50 * 50 <= scored < 50 * 2000 / 4                                # of all pairs
    plan = tiles._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan


def test_lists_equal_the_estimators_own(spark):
    df = spark.createDataFrame(ratings_of(80, 60, 20), KIND)
    model = als_ops.fit_als(df, rank=4, max_iter=3)
    got = top_n.exact_top_n(model.userFactors, model.itemFactors, 10, 4, slice_items=16).toPandas()
    want = als_ops.recommend(model, 10).toPandas()
    both = got.merge(want, on=["user_id", "rank"])
    assert len(both) == len(got) == len(want) == 800
    assert np.allclose(both.score_x, both.score_y, atol=1e-5) and (both.item_id_x == both.item_id_y).mean() > 0.99


def test_hits_of_a_tile_in_several_parts(spark, monkeypatch):
    monkeypatch.setattr(top_n, "TRUTH_ROWS", 10)
    rng = np.random.default_rng(6)
    users, items = {i: rng.normal(size=3) for i in range(20)}, {i: rng.normal(size=3) for i in range(50)}
    truth = [(u, i) for u in range(25) for i in range(50) if (u * i) % 3 == 0 or u == 4]
    tiles = top_n.top_lists(*(top_n.packed_vectors(vectors(spark, s)) for s in (users, items)), 7, [3], tile_users=8)
    frame = spark.createDataFrame(truth, "user_id LONG, item_id LONG")
    got = sorted(tuple(r) for r in top_n.list_hits(tiles, frame, [3], 7).collect())
    lists = plain_lists(users, items, 7)
    assert got == sorted((0, u, r + 1) for u, some in lists.items() for r, (i, _) in enumerate(some) if (u, i) in set(truth))


# --- grids ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def split(spark):
    rows = ratings_of(60, 40, 20, seed=3)
    train = [r for n, r in enumerate(rows) if n % 4] + [(500, 1, 2.0)]
    valid = [r for n, r in enumerate(rows) if n % 4 == 0] + [(900, 1, 3.0), (1, 901, 2.0)]   # untrained user, item
    return train, valid, spark.createDataFrame(train, KIND), spark.createDataFrame(valid, KIND)


GRID = tuning.grid((2, 5), (1, 3), (0.05, 0.5), implicit=True) + tuning.grid((3,), (2,), (0.1,))


def test_grid_rows_equal_separate_evaluation(spark, split):
    rows, held, train, valid = split
    got = {(r["rank"], r["max_iter"], r["reg"], r["implicit"]): r for r in tuning.run_shared_grid(train, valid, GRID, 6).collect()}
    assert len(got) == len(GRID)
    for g in GRID:
        r = got[g.rank, g.max_iter, g.reg, g.implicit]
        users, items = plain_fit(rows, P(g.rank, g.reg, g.implicit, g.alpha, not g.implicit), g.max_iter)
        errors = [(x - users[u] @ items[i]) ** 2 for u, i, x in held if u in users and i in items]
        assert r["n_rows"] == len(errors) and r["rmse"] == pytest.approx(np.sqrt(np.mean(errors)), rel=1e-3)
        lists = plain_lists({u: users[u] for u in {u for u, _, _ in held} & users.keys()}, items, 6)
        recs = spark.createDataFrame([(u, i, n + 1) for u, some in lists.items() for n, (i, _) in enumerate(some)],
                                     "user_id LONG, item_id LONG, rank LONG")
        want = ranking_metrics(recs, valid, 6).first()
        assert r["n_users"] == want["n_users"] == len(lists)
        for name in ("precision_at_k", "map", "ndcg_at_k"):
            assert r[name] == pytest.approx(want[name], abs=0.01)           # near ties may swap places


def test_stopped_grid_goes_on(spark, split, monkeypatch):
    _, _, train, valid = split
    path, ran, whole = scratch_path(spark, "grid"), [], tuning.evaluate_batch

    def once(train, valid, points, *rest, **more):
        if len(ran) == 1:
            raise KeyboardInterrupt                                         # killed within the second batch
        ran.append(points)
        return whole(train, valid, points, *rest, **more)

    monkeypatch.setattr(tuning, "evaluate_batch", once)
    with pytest.raises(KeyboardInterrupt):
        tuning.run_shared_grid(train, valid, GRID, 6, path, width=7)
    stored = spark.read.parquet(path).count()
    assert 0 < stored == len(ran[0]) < len(GRID)
    again = []

    def noted(train, valid, points, *rest, **more):
        again.extend(points)
        return whole(train, valid, points, *rest, **more)

    monkeypatch.setattr(tuning, "evaluate_batch", noted)
    got = tuning.run_shared_grid(train, valid, GRID, 6, path, width=7)
    assert got.count() == len(GRID) and not set(again) & set(ran[0]) and len(again) == len(GRID) - stored
    again.clear()
    assert tuning.run_shared_grid(train, valid, GRID[:3], 6, path).count() == 3 and not again
    one = tuning.run_shared_grid(train, valid, GRID, 6).toPandas()
    keys = ["rank", "max_iter", "reg", "implicit"]
    both = got.toPandas().merge(one, on=keys)
    assert len(both) == len(GRID) and np.allclose(both.rmse_x, both.rmse_y, rtol=1e-4)


def test_batches_hold_points_of_one_kind():
    points = tuning.grid((5, 10), (1, 2), (0.1, 1.0), implicit=True) + tuning.grid((5,), (1,), (0.1,))
    cut = tuning.batches(points, 15)
    assert sorted(map(repr, sum(cut, []))) == sorted(map(repr, points))
    for b in cut:
        assert len({p.implicit for p in b}) == 1 and sum({(p.rank, p.reg): p.rank for p in b}.values()) <= 15
    assert len(tuning.batches(tuning.grid((50,), (1,), (0.1,)), 15)) == 1   # wider than a batch: alone


# --- lists at size ------------------------------------------------------------------

@pytest.mark.parametrize("slice_items", [4, 64])
def test_tables_written_do_not_grow_with_the_slices(spark, monkeypatch, slice_items):
    rng = np.random.default_rng(8)
    users, items = {i: rng.normal(size=3) for i in range(10)}, {i: rng.normal(size=3) for i in range(64)}
    written, whole = [], top_n.materialize
    monkeypatch.setattr(top_n, "materialize", lambda df, name: written.append(name) or whole(df, name))
    tiles = top_n.top_lists(*(top_n.packed_vectors(vectors(spark, s)) for s in (users, items)), 5, [3], slice_items=slice_items)
    assert as_lists(top_n.explode_lists(tiles, [3], 5).drop("point")) == plain_lists(users, items, 5)
    assert len(written) <= 3                                                # a table of lists for each round before


def test_all_users_are_not_crossed_with_all_items(spark):
    model = als_ops.fit_als(spark.createDataFrame(ratings_of(40, 30, 10), KIND), rank=2, max_iter=1)
    plan = als_ops.recommend(model, 5)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Join Cross" not in plan


def test_hits_found_in_the_search_equal_those_of_stored_lists(spark):
    rng = np.random.default_rng(9)
    users, items = {i: rng.normal(size=5) for i in range(40)}, {2 ** 40 + i: rng.normal(size=5) for i in range(90)}
    truth = spark.createDataFrame([(u, i) for u in range(45) for i in items if (u + i) % 3 == 0], "user_id LONG, item_id LONG")
    a, b = (top_n.packed_vectors(vectors(spark, s)) for s in (users, items))
    tiles = top_n.top_lists(a, b, 7, [2, 3], tile_users=15)
    want = sorted(tuple(r) for r in top_n.list_hits(tiles, truth, [2, 3], 7).collect())
    assert want and sorted(tuple(r) for r in top_n.top_hits(a, b, truth, 7, [2, 3]).collect()) == want


@pytest.mark.parametrize("kind", ["plain", "copies", "outlier", "huge", "tiny"])
def test_pool_is_exact_and_bounded(monkeypatch, kind):
    monkeypatch.setattr(top_n, "FEWEST_OFFERS", 1 << 10)
    monkeypatch.setattr(top_n, "EPOCH_BYTES", 1 << 14)
    rng = np.random.default_rng(10)
    x, y = rng.normal(size=(30, 8)), rng.normal(size=(6000, 8))
    if kind == "copies":
        y = np.repeat(y[:3], 2000, axis=0)                                  # every score comes two thousand times
    if kind == "outlier":
        y[17] *= 1e7                                                        # its rounding error is above all other scores
    x, y = (x * 1e18, y * 1e19) if kind == "huge" else (x * 1e-30, y * 1e-10) if kind == "tiny" else (x, y)
    x, y, ids = x.astype("<f4"), y.astype("<f4"), rng.permutation(len(y)).astype(np.int64)
    order = np.lexsort((ids, -top_n.norms_of(y)))
    pool, most = top_n.Pool(np.arange(30).tobytes(), x.tobytes(), 8, 10), 0
    for lo in range(0, len(y), 500):
        pool.meet(ids[order[lo:lo + 500]], y[order[lo:lo + 500]])
        most = max(most, len(pool.pool[0]))
    items, scores = pool.lists()
    exact = x.astype(float) @ y.astype(float).T
    for u in range(30):
        want = np.lexsort((ids, -exact[u]))[:10]
        assert items[u].tolist() == ids[want].tolist() and np.allclose(scores[u], exact[u][want], rtol=1e-9)
    assert most <= 2 * (1 << 10)


def test_recommended_lists_equal_the_estimators_call(spark):
    model = als_ops.fit_als(spark.createDataFrame(ratings_of(40, 30, 10), KIND), rank=3, max_iter=2)
    own = model.recommendForAllUsers(8).select("user_id", F.posexplode("recommendations").alias("at", "of")).select(
        F.col("user_id").cast("long"), (F.col("at") + 1).cast("long").alias("rank"), F.col("of.rating").alias("score")).toPandas()
    both = als_ops.recommend(model, 8).toPandas().merge(own, on=["user_id", "rank"])
    assert len(both) == len(own) == 40 * 8 and np.allclose(both.score_x, both.score_y, atol=1e-5)


@pytest.mark.parametrize("point", [P(12, 0.01, True), P(12, 0.3, True, 0.5), P(12, 0.0, True), P(12, 0.1, True, 0.0)])
def test_few_ratings_are_solved_in_their_own_space(spark, monkeypatch, point):
    rng = np.random.default_rng(11)
    rows = [(u, int(i), float(r)) for u in range(60) for i, r in zip(rng.integers(0, 40, 1 + u % 14), rng.integers(-1, 6, 20))]
    rows += [(100, 3, -2.0), (100, 4, 0.0)]                                 # no positive rating: factors of zero
    widths, whole = [], np.linalg.solve
    monkeypatch.setattr(np.linalg, "solve", lambda a, b: widths.append(a.shape[-1]) or whole(a, b))
    y = rng.normal(size=(40, 12))
    met, rating = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    starts = np.unique([r[0] for r in rows], return_index=True)[1]
    k, n = np.diff(np.append(starts, len(rows))), np.add.reduceat(rating > 0, starts, dtype=np.int64)
    gram = y.T @ y
    taken = block_als.few(n, k, *block_als.spectrum(gram, point)[:1], point)
    assert taken.tolist() == (k < 12).tolist()                              # this gram matrix is far from singular
    a, b, _ = block_als.equations(y[met], rating, starts, point)
    want = block_als.solve(a, b, n, gram, point)
    widths.clear()
    got = block_als.solve_few(y[met], rating, starts, k, n, *block_als.spectrum(gram, point), point)
    assert np.allclose(got, want, rtol=1e-8, atol=1e-10) and not got[-1].any()
    assert sorted(widths) == sorted(set(k[n > 0].tolist()))                 # before: all as wide as the factors
    flat = np.zeros((12, 12))
    assert not block_als.few(np.array([3]), np.array([3]), np.linalg.eigvalsh(flat + np.diag([1.0] + [0] * 11)), P(12, 0.0, True)).any()



def test_first_pass_scores_few_items_of_a_large_slice(spark):
    rng = np.random.default_rng(12)
    users, items = {i: rng.normal(size=5) for i in range(20)}, {i: rng.normal(size=5) for i in range(500)}
    a, b = (top_n.packed_vectors(vectors(spark, s)) for s in (users, items))
    slices = top_n.cut_slices(b, [2, 3], 400)
    first = {r["point"]: r for r in top_n.top_slices(slices, 6).collect()}
    for point, s in enumerate((slice(0, 2), slice(2, 5))):
        x = np.stack([items[i][s] for i in range(500)]).astype("<f4")
        got = np.frombuffer(first[point]["top_ids"], np.int64)                  # 400 or more before
        assert got.tolist() == np.lexsort((np.arange(500), -top_n.norms_of(x)))[:top_n.FIRST_ITEMS * 6].tolist()
        assert np.array_equal(np.frombuffer(first[point]["top_vecs"], "<f4").reshape(len(got), -1), x[got])
    tiles = top_n.top_lists(a, b, 6, [2, 3], slices=slices, tile_users=7)
    lists = top_n.explode_lists(tiles, [2, 3], 6)
    for point, s in enumerate((slice(0, 2), slice(2, 5))):
        want = plain_lists({u: v[s] for u, v in users.items()}, {i: v[s] for i, v in items.items()}, 6)
        assert as_lists(lists.filter(F.col("point") == point).drop("point")) == want


def test_factors_are_shipped_in_few_rows(spark):
    rows = [(i, j, 1.0 + (i * j) % 5) for i in range(60) for j in range(i % 7, 90, 3)]
    layout = block_als.lay_out(spark.createDataFrame(rows, KIND), "user_id", "item_id", "rating", 200)
    factors = block_als.first_factors(spark.range(95).select("id"), [P(3, 0.1)])
    vec = {r["id"]: r["vec"] for r in factors.collect()}
    got, shipped = {}, block_als.shipments(layout.needs, factors, 3).collect()
    for r in shipped:
        x = block_als.unplaned([r["vecs"]], np.float32).reshape(-1, 3)
        for other, v in zip(block_als.unplaned([r["others"]], np.int64).tolist(), x):
            assert (r["block"], other) not in got
            got[r["block"], other] = v.tobytes()
    want = {(r["block"], o) for r in layout.blocks.collect() for o in np.frombuffer(r["others"], np.int64).tolist()}
    assert set(got) == want and all(v == vec[o] for (_, o), v in got.items())
    assert len(shipped) < len(want) / 3                                     # a row for every pair before


def test_shipments_in_small_parts(spark, monkeypatch):
    monkeypatch.setattr(block_als, "SHIP_BYTES", 4 * 2 * 5)                 # five pairs at once
    needs = spark.createDataFrame([(i, list(range(i % 4, 9))) for i in range(30)], "other LONG, blocks ARRAY<INT>")
    factors = block_als.first_factors(spark.range(30).select("id"), [P(2, 0.1)])
    shipped = block_als.shipments(needs.coalesce(1), factors, 2).collect()
    got = sorted((r["block"], o) for r in shipped for o in block_als.unplaned([r["others"]], np.int64).tolist())
    assert got == sorted((b, i) for i in range(30) for b in range(i % 4, 9))


@pytest.mark.parametrize("pool_entries", [3 << 20, 21])
def test_seen_pairs_are_left_out_of_one_search(spark, monkeypatch, pool_entries):
    rng = np.random.default_rng(12)
    users, items = {i: rng.normal(size=4) for i in range(40)}, {2 ** 33 + i: rng.normal(size=4) for i in range(60)}
    pairs = [(u, i) for u in range(45) for i in items if rng.random() < (0.9 if u == 7 else 0.3)]
    seen = spark.createDataFrame(pairs + pairs[:50] + [(None, 2 ** 33), (3, None)], "user LONG, item LONG")
    a, b = (top_n.packed_vectors(vectors(spark, s)) for s in (users, items))
    monkeypatch.setattr(top_n, "BARRED_PAIRS", 16)
    per = top_n.POOL_ENTRIES
    top_n.POOL_ENTRIES = pool_entries
    pools = top_n.pools_of(np.arange(40).tobytes(), np.array(list(users.values()), "<f4").tobytes(), 4, 7)
    top_n.POOL_ENTRIES = per
    y, ids = np.array(list(items.values()), "<f4"), np.array(list(items), np.int64)
    order, got = np.argsort(-top_n.norms_of(y)), []
    for pool in pools:
        for lo in range(0, len(pairs), 100):
            pool.bar(*np.array(pairs[lo:lo + 100]).T)
        pool.meet(ids[order], y[order])
        got += [(u, [i for i in row if i >= 0]) for u, row in zip(pool.ids.tolist(), pool.lists()[0].tolist())]
    score = {u: {i: float(np.float32(x).astype(float) @ np.float32(v).astype(float)) for i, v in items.items()} for u, x in users.items()}
    want = {u: sorted((i for i in items if (u, i) not in set(pairs)), key=lambda i: -score[u][i])[:7] for u in users}
    assert dict(got) == want and len(got) == 40
    lists = top_n.explode_lists(top_n.top_lists(a, b, 7, [4], tile_users=15, seen=seen), [4], 7).collect()
    assert sorted((r["user_id"], r["rank"], r["item_id"]) for r in lists) == sorted((u, n + 1, i) for u, l in want.items() for n, i in enumerate(l))


def test_tiles_do_not_outnumber_the_cores(spark, monkeypatch):
    rng = np.random.default_rng(13)
    users = top_n.packed_vectors(vectors(spark, {i: rng.normal(size=2) for i in range(6000)}))
    cores = spark.sparkContext.defaultParallelism
    assert top_n.cut_tiles(users, [2], 100)[1] == cores                     # four a core before: slices sent four times as often
    assert top_n.cut_tiles(users, [2], 100, tile_users=100)[1] == 60


@pytest.mark.parametrize("seen", [None, {(u, u % 7) for u in range(60)}])
def test_tiles_searched_in_waves(spark, monkeypatch, seen):
    rng = np.random.default_rng(12)
    users, items = {i: rng.normal(size=3) for i in range(60)}, {i: rng.normal(size=3) for i in range(150)}
    monkeypatch.setattr(top_n, "WAVE_BYTES", 1)                            # as many tiles in a job as cores
    waves, whole = [], top_n.write_spent
    monkeypatch.setattr(top_n, "write_spent", lambda df, path, mode: waves.append(path) or whole(df, path, mode))
    a, b = (top_n.packed_vectors(vectors(spark, s)) for s in (users, items))
    pairs = None if seen is None else spark.createDataFrame(sorted(seen), "user LONG, item LONG")
    tiles = top_n.top_lists(a, b, 5, [3], slice_items=20, tile_users=2, seen=pairs)
    left = {u: {i: y for i, y in items.items() if (u, i) not in (seen or ())} for u in users}
    want = {u: plain_lists({u: users[u]}, left[u], 5)[u] for u in users}
    assert as_lists(top_n.explode_lists(tiles, [3], 5).drop("point")) == want
    assert len(waves) == -(-30 // spark.sparkContext.defaultParallelism) and len(set(waves)) == 1
    truth = spark.createDataFrame([(u, i) for u in users for i in range(0, 150, 4)], "user_id LONG, item_id LONG")
    monkeypatch.setattr(top_n, "cut_tiles", lambda *x, cut=top_n.cut_tiles: cut(*x[:3], 2))
    hits = top_n.top_hits(a, b, truth, 5, [3]).collect()
    plain = plain_lists(users, items, 5)
    assert sorted((r["user_id"], r["rank"]) for r in hits) == sorted((u, n + 1) for u, some in plain.items() for n, (i, _) in enumerate(some) if i % 4 == 0)
