import math

from tastemap.operators import tuning


def _grid(spark):
    rows = [(20, 5, 0.1, 1.0, False, 100, 1.2, 0.01, 0.002, 0.03, 1.0),
            (20, 10, 0.1, 1.0, False, 100, 0.9, 0.02, 0.001, 0.02, 1.0),
            (40, 10, 0.01, 1.0, False, 100, math.nan, 0.05, 0.004, 0.05, 1.0),
            (40, 5, 0.01, 1.0, False, 100, 1.0, 0.03, 0.003, 0.04, 1.0)]
    return spark.createDataFrame(rows, tuning.GRID_SCHEMA)


def test_best_lowest_skips_nan(spark):
    best = tuning.best_params(_grid(spark), "rmse", lowest=True).first()
    assert (best["rank"], best["max_iter"]) == (20, 10)


def test_best_highest(spark):
    best = tuning.best_params(_grid(spark), "precision_at_k", lowest=False).first()
    assert (best["rank"], best["max_iter"]) == (40, 10)


def test_cross_table(spark):
    table = tuning.cross_table(_grid(spark).filter("max_iter = 10"), "reg", "rank", "map").collect()
    assert [r["reg"] for r in table] == [0.01, 0.1]
    assert table[0]["40"] == 0.004 and table[1]["20"] == 0.001 and table[0]["20"] is None


def test_grid_points():
    pts = tuning.grid((5, 20), (4,), (0.01, 0.1), implicit=True)
    assert len(pts) == 4 and all(p.implicit for p in pts)


def test_ties_go_to_the_smallest_parameters(spark):
    from tastemap.operators.tuning import best_params, metrics_frame
    rows = [dict(rank=r, max_iter=4, reg=0.1, alpha=1.0, implicit=True, k=5, rmse=1.0, precision_at_k=0.5, map=0.1,
                 ndcg_at_k=0.1, seconds=0.0) for r in (80, 20, 40)]
    for order in (rows, rows[::-1]):
        frame = metrics_frame(spark, order)
        assert best_params(frame, "rmse").first()["rank"] == 20
        assert best_params(frame, "precision_at_k", lowest=False).first()["rank"] == 20


def test_damped_means_against_plain_python(spark):
    from collections import defaultdict
    train = [(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(15) if (u + 2 * i) % 3]
    valid = [(u, i, float(1 + (u + i) % 5)) for u in range(12) for i in range(17) if (u + 2 * i) % 3 == 0]
    kind = "user_id LONG, item_id LONG, rating DOUBLE"
    got = tuning.damped_mean_grid(spark.createDataFrame(train, kind), spark.createDataFrame(valid, kind), (0, 2), (1, 4))
    rows = {(r["damping"], r["k"]): (r["rmse"], r["precision_at_k"]) for r in got.collect()}
    of = defaultdict(list)
    for _, i, r in train:
        of[i].append(r)
    overall = sum(r for _, _, r in train) / len(train)
    users = {u for u, _, _ in valid}
    for d in (0, 2):
        score = {i: (sum(rs) + d * overall) / (len(rs) + d) for i, rs in of.items()}
        err = [(r - score[i]) ** 2 for _, i, r in valid if i in score]
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for k in (1, 4):
            hits = sum(i in ranked[:k] for _, i, _ in valid)
            assert math.isclose(rows[d, k][0], math.sqrt(sum(err) / len(err)), abs_tol=1e-9)
            assert math.isclose(rows[d, k][1], hits / (k * len(users)), abs_tol=1e-9)
    assert len(rows) == 4
