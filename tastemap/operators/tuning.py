"""Parameter grids, selection of the best point and result cross tables."""

from __future__ import annotations

import itertools
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemap.operators import als as als_ops
from tastemap.operators import block_als, top_n, whole_als
from tastemap.operators.ranking import METRIC_DIGITS, per_user_metrics, ranking_metrics, rmse, truth_sets, truth_sizes
from tastemap.session import scratch_scope
from tastemap.sources.files import materialize, path_exists, read_parquet_table

GRID_SCHEMA = ("rank INT, max_iter INT, reg DOUBLE, alpha DOUBLE, implicit BOOLEAN, k INT, "
               "rmse DOUBLE, precision_at_k DOUBLE, map DOUBLE, ndcg_at_k DOUBLE, seconds DOUBLE")
SHARED_GRID_SCHEMA = GRID_SCHEMA + ", n_rows LONG, n_users LONG"


@dataclass(frozen=True)
class GridPoint:
    rank: int
    max_iter: int
    reg: float
    alpha: float = 1.0
    implicit: bool = False


def grid(ranks, iters, regs, alphas=(1.0,), implicit: bool = False) -> list[GridPoint]:
    return [GridPoint(r, i, g, a, implicit) for r, i, g, a in itertools.product(ranks, iters, regs, alphas)]


def evaluate_point(train: DataFrame, valid: DataFrame, point: GridPoint, k: int,
                   user: str = "user_id", item: str = "item_id", rating: str = "rating",
                   seed: int = als_ops.ALS_SEED) -> dict:
    """Fit on ``train``; RMSE and ranking metrics on ``valid`` (lists for its users only)."""
    start = time.time()
    model = als_ops.fit_als(train, point.rank, point.max_iter, point.reg, point.implicit, point.alpha,
                            nonnegative=not point.implicit, seed=seed, user=user, item=item, rating=rating)
    err = rmse(als_ops.predict(model, valid, user, item, rating)).first()
    recs = als_ops.recommend(model, k, valid.select(user), user, item)
    metrics = ranking_metrics(recs, valid, k, user, item).first()
    return dict(rank=point.rank, max_iter=point.max_iter, reg=float(point.reg), alpha=float(point.alpha),
                implicit=point.implicit, k=k, rmse=err["rmse"], precision_at_k=metrics["precision_at_k"],
                map=metrics["map"], ndcg_at_k=metrics["ndcg_at_k"], seconds=round(time.time() - start, 3))


def run_grid(train: DataFrame, valid: DataFrame, points: list[GridPoint], k: int = 100,
             user: str = "user_id", item: str = "item_id", rating: str = "rating") -> DataFrame:
    """One metric row per grid point.  Each fit is a distributed job that
    reads the training columns again; only the few metric values per point come back."""
    train, valid = train.select(user, item, rating), valid.select(user, item, rating)
    rows = [evaluate_point(train, valid, p, k, user, item, rating) for p in points]
    return metrics_frame(train.sparkSession, rows)


def metrics_frame(spark, rows: list[dict], schema: str = GRID_SCHEMA) -> DataFrame:
    """Metric rows (one per grid point, so a handful) as a DataFrame."""
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


GRID_WIDTH = 1280       # factors of all points fitted together, at most (a single point may be wider)
GRID_KEY = ("rank", "max_iter", "reg", "alpha", "implicit", "k")


def batches(points: list[GridPoint], width: int = GRID_WIDTH) -> list[list[GridPoint]]:
    """Points that are fitted together: of one kind, ``width`` factors in all.
    Points that differ in their rounds alone share their factors."""
    out: list[list[GridPoint]] = []
    shapes: list[set] = []
    for p in sorted(points, key=lambda p: (p.implicit, p.rank, p.reg, p.alpha, p.max_iter)):
        shape = (p.rank, p.reg, p.alpha)
        if out and out[-1][0].implicit == p.implicit and sum(r for r, _, _ in shapes[-1] | {shape}) <= width:
            out[-1].append(p)
            shapes[-1].add(shape)
        else:
            out.append([p])
            shapes.append({shape})
    return out


def evaluate_batch(train: DataFrame, valid: DataFrame, points: list[GridPoint], k: int, user: str = "user_id",
                   item: str = "item_id", rating: str = "rating", seed: int = als_ops.ALS_SEED) -> list[dict]:
    """Metric rows of points fitted together over one layout of ``train``, or each in a
    task of its own where a point fits there (``whole_als``): RMSE over the rows
    of ``valid`` that get a prediction, ranking metrics over the users of ``valid``
    that were trained and have a truth."""
    start = time.time()
    shapes = sorted({(p.rank, p.reg, p.alpha) for p in points})
    fitted = [block_als.Point(r, g, points[0].implicit, a, nonnegative=not points[0].implicit) for r, g, a in shapes]
    wanted = [tuple(sorted({p.max_iter for p in points if (p.rank, p.reg, p.alpha) == s})) for s in shapes]
    widths, rows = [p.rank for p in fitted], []
    truth = materialize(truth_sets(valid, user, item), "grid-truth")
    sizes = truth_sizes(truth, user)
    trained = train.select(F.col(user).cast("long").alias("id"), F.col(item).cast("long").alias("item"), rating).dropna()
    users = materialize(trained.groupBy("id").agg(F.count(F.lit(1)).alias("n")), "grid-ids")
    n_users, n_train = users.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if whole_als.fits_task(n_users, trained.select("item").distinct().count(), n_train, valid.count(), max(widths)):
        found = whole_als.evaluated(train, valid, fitted, wanted, k, user, item, rating, seed)
        told = [(rounds, found.filter((F.col("kind") == whole_als.ERRORS) & (F.col("rounds") == rounds)).select("point", F.col("num").alias("n_rows"), "squares"),
                 users, found.filter((F.col("kind") == whole_als.HIT) & (F.col("rounds") == rounds)).select("point", F.col("id").alias(user), F.col("num").alias("rank")))
                for rounds in sorted({p.max_iter for p in points})]
    else:
        told = _blocked(train, valid, truth, sizes, fitted, points, k, user, item, rating, seed)
    for rounds, errors, ranked_users, hits in told:
        squares = {r["point"]: r for r in errors.collect()}
        listed = materialize(ranked_users.join(sizes, ranked_users["id"] == sizes[user]).select("id", "n_truth"), "grid-users")
        # A user counts once for each point: the key is the pair.
        key = F.struct("point", F.col(user).alias("id")).alias(user)
        each = listed.select(F.col("id").alias(user), "n_truth", F.explode(F.sequence(F.lit(0), F.lit(len(fitted) - 1))).alias("point"))
        per_user = per_user_metrics(each.select(key, "n_truth"), hits.select(key, "rank"), k, user, "rank")
        ranked = {r["point"]: r for r in per_user.groupBy(F.col(f"{user}.point").alias("point")).agg(
            F.count(F.lit(1)).alias("n_users"), *[F.round(F.avg(c), METRIC_DIGITS).alias(name) for c, name in (
                ("precision_at_k", "precision_at_k"), ("average_precision", "map"), ("ndcg_at_k", "ndcg_at_k"))]).collect()}
        took = time.time() - start
        for p in points:
            n = shapes.index((p.rank, p.reg, p.alpha))
            if p.max_iter != rounds:
                continue
            sq, found = squares.get(n), ranked.get(n)
            rows.append(dict(
                rank=p.rank, max_iter=p.max_iter, reg=float(p.reg), alpha=float(p.alpha), implicit=p.implicit, k=k,
                rmse=round((sq["squares"] / sq["n_rows"]) ** 0.5, METRIC_DIGITS) if sq and sq["n_rows"] else None,
                precision_at_k=found["precision_at_k"] if found else None, map=found["map"] if found else None,
                ndcg_at_k=found["ndcg_at_k"] if found else None, seconds=round(took, 3),
                n_rows=sq["n_rows"] if sq else 0, n_users=found["n_users"] if found else 0))
    return rows


def _blocked(train, valid, truth, sizes, fitted, points, k, user, item, rating, seed):
    """(rounds, squared errors, users, hits) of points fitted side by side over one layout in blocks."""
    widths = [p.rank for p in fitted]
    for rounds, model in block_als.fit(train, fitted, tuple({p.max_iter for p in points}), user, item, rating, seed).items():
        errors = block_als.squared_errors(model, valid, user, item, rating)
        listed = materialize(model.users.join(sizes, model.users["id"] == sizes[user]).select("id", "vec"), "grid-users")
        yield rounds, errors, model.users.select("id"), materialize(top_n.top_hits(listed, model.items, truth, k, widths, user, item), "grid-hits")


def run_shared_grid(train: DataFrame, valid: DataFrame, points: list[GridPoint], k: int = 100, path: str | None = None,
                    width: int = GRID_WIDTH, user: str = "user_id", item: str = "item_id", rating: str = "rating") -> DataFrame:
    """One metric row per grid point; points are fitted in batches over one
    layout of the ratings.  ``seconds`` is the time of a point's whole batch.

    With ``path`` a batch's rows are appended there as soon as they are ready,
    and points that the table already holds (for this ``k``) are not run again,
    so a stopped grid goes on where it ended.
    """
    spark = train.sparkSession
    train, valid = train.select(user, item, rating), valid.select(user, item, rating)
    done = set()
    if path and path_exists(spark, path):
        done = {tuple(r) for r in read_parquet_table(spark, path).select(*GRID_KEY).collect()}
    todo = [p for p in points if (p.rank, p.max_iter, float(p.reg), float(p.alpha), p.implicit, k) not in done]
    rows: list[dict] = []
    for batch in batches(todo, width):
        with scratch_scope(spark):                       # layouts, factors and lists go with the batch
            ready = evaluate_batch(train, valid, batch, k, user, item, rating)
        rows += ready
        if path:
            metrics_frame(spark, ready, SHARED_GRID_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    if not path:
        return metrics_frame(spark, rows, SHARED_GRID_SCHEMA)
    wanted = spark.createDataFrame([(p.rank, p.max_iter, float(p.reg), float(p.alpha), p.implicit, k) for p in points],
                                   "rank INT, max_iter INT, reg DOUBLE, alpha DOUBLE, implicit BOOLEAN, k INT").distinct()
    return read_parquet_table(spark, path).join(F.broadcast(wanted), list(GRID_KEY), "left_semi")


def damped_mean_grid(train: DataFrame, valid: DataFrame, dampings: tuple, cutoffs: tuple,
                     user: str = "user_id", item: str = "item_id", rating: str = "rating",
                     digits: int = METRIC_DIGITS) -> DataFrame:
    """(damping, k, rmse, precision_at_k): a grid over a predictor without
    learned factors, (sum + damping * overall mean) / (n + damping) per item.

    RMSE is over the rows of ``valid`` whose item was trained; precision@k is
    the mean over the users of ``valid`` of the shared list of the k best items.
    One lazy plan: item sums meet each row once and are spread over the few
    dampings after the join; lists are at most the largest cut-off long.
    """
    overall = train.agg((F.sum(rating) / F.count(rating)).alias("overall")).scalar()
    items = train.groupBy(item).agg(F.sum(rating).alias("total"), F.count(rating).alias("n"))
    items = items.select(item, "total", "n", overall.alias("overall"))
    points = F.explode(F.array(*[F.lit(float(d)) for d in dampings])).alias("damping")
    predicted = (F.col("total") + F.col("damping") * F.col("overall")) / (F.col("n") + F.col("damping"))

    err = F.col(rating) - predicted
    errors = (valid.join(items, item).select(rating, "total", "n", "overall", points).groupBy("damping")
              .agg(F.round(F.sqrt(F.avg(err * err)), digits).alias("rmse")))

    order = Window.partitionBy("damping").orderBy(F.desc("score"), F.asc(item))
    lists = None
    for d in dampings:
        best = (items.withColumn("damping", F.lit(float(d))).select("damping", item, predicted.alias("score"))
                .orderBy(F.desc("score"), F.asc(item)).limit(max(cutoffs)))
        lists = best if lists is None else lists.unionByName(best)
    lists = lists.select("damping", item, F.row_number().over(order).alias("place"))
    truth = truth_sets(valid, user, item)
    users = truth.agg(F.countDistinct(user).alias("users")).scalar()
    found = truth.join(F.broadcast(lists), item).groupBy("damping").agg(
        *[F.count(F.when(F.col("place") <= k, 1)).alias(f"hits_{k}") for k in cutoffs])
    by_k = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.coalesce(f"hits_{k}", F.lit(0)).alias("hits"))
                               for k in cutoffs])).alias("at")
    return (errors.join(found, "damping", "left").select("damping", "rmse", by_k)
            .select("damping", F.col("at.k").alias("k"), "rmse",
                    F.round(F.col("at.hits") / (F.col("at.k") * users), digits).alias("precision_at_k")))


def best_params(results: DataFrame, metric: str = "rmse", lowest: bool = True,
                ties: tuple = ("rank", "max_iter", "reg", "alpha")) -> DataFrame:
    """The grid row with the lowest (or highest) ``metric``; NaN and NULL never
    win, and equal metrics give the least values of the columns ``ties``."""
    params = F.struct(*[c for c in results.columns])
    usable = results.filter(F.col(metric).isNotNull() & ~F.isnan(metric))
    # A total order, so equal metrics give the same point whatever the row order.
    value = F.col(metric) if lowest else -F.col(metric)
    ties = [c for c in ties if c in results.columns]
    pick = F.min_by(params, F.struct(value, *ties))
    return usable.agg(pick.alias("best")).select("best.*")


def cross_table(results: DataFrame, row_param: str = "reg", col_param: str = "rank",
                metric: str = "map") -> DataFrame:
    """Metric by (row parameter × column parameter); column values come from the grid."""
    return results.groupBy(row_param).pivot(col_param).agg(F.first(metric)).orderBy(row_param)
