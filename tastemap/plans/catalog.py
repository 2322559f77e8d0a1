"""Registered queries: one Spark builder per operator of the inventory.

Every builder takes ``(spark, sf_dir)``, reads the driver's tables (or data
Spark derives from them) and returns a DataFrame.  Building one may already run
jobs: splits and numberings are written, models and grids fitted (kept for the
application in ``_memo``).  Deterministic ones have a DuckDB twin in
``tastemap.plans.oracle``; values that ALS learns are checked in the tests, and
what holds whatever it learns has queries with twins of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastemap.functions.vectors import spread_vector
from tastemap.operators import als as als_ops
from tastemap.operators import block_als, ids, top_n, tuning
from tastemap.operators.matrix import dense_pivot, from_sparse_rows, mean_ratings, sparse_rows
from tastemap.operators.popularity import PopularityRecommender, popularity_scores, top_items
from tastemap.operators.prep import (active_users, copy_column, drop_null_rows, hash_sample,
                                     nonzero_ratings)
from tastemap.operators.ranking import item_mean_predictions, ranking_metrics, rmse, summarize, truth_sets
from tastemap.operators.split import (SPLIT_SEED, half_split, interaction_split, label_and_number,
                                      train_val_test, user_groups)
from tastemap.params import (BUCKETS, EXPLICIT_GRID, FINAL_ALS, IMPLICIT_ALS, MEAN_CUTOFFS, MEAN_DAMPINGS, RANK1_GRID,
                             SAMPLED_GRID, TEST_K, TUNE_K)
from tastemap.plans.oracle import (LAYOUT_FILES, PIVOT_ITEMS, ROW_CHUNK, SAMPLE_FRACTION, TOP_N, VECTOR_LIST,
                                   VECTOR_WIDTH)
from tastemap.session import scratch_path
from tastemap.sources.files import (materialize, read_csv_table, read_parquet_table, register_views,
                                    repartition_layout, row_count, table_schemas, write_bucketed, write_csv_parts,
                                    write_parquet_table, write_single_csv, write_single_parquet)
from tastemap.sources.interactions import interactions
from tastemap.sources.tables import TABLES, load_table, table_path

SAMPLE_KEY = ["user_id", "item_id", "ok", "ln"]
SPLIT_COLUMNS = ["user_id", "item_id", "rating", "ts", "ok", "ln", "split"]


# --- shared fragments -------------------------------------------------------

def rated(spark: SparkSession, sf: str) -> DataFrame:
    return nonzero_ratings(interactions(spark, sf))


def stored_interactions(spark: SparkSession, sf: str) -> DataFrame:
    """The derived interaction table written once: the split reads it in
    several passes, each a pruned scan rather than a repeated join."""
    return materialize(interactions(spark, sf), "interactions")


def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    return train_val_test(stored_interactions(spark, sf)).select(*SPLIT_COLUMNS)


_memo: dict = {}


def _memoized(key, build, spark=None):
    """Models and grids reused across queries of one application."""
    if spark is not None:
        key = (spark.sparkContext.applicationId, *key)
    if key not in _memo:
        _memo[key] = build()
    return _memo[key]


def split_table(spark: SparkSession, sf: str) -> DataFrame:
    """The split written once per application and read back, as later stages
    of the workflow read stage A's output; queries of the split operators
    themselves use ``split_rows``."""
    def build():
        path = scratch_path(spark, "split-table")
        write_parquet_table(split_rows(spark, sf), path, partition_by=["split"])
        return path
    return read_parquet_table(spark, _memoized(("split_table", sf), build, spark)).select(*SPLIT_COLUMNS)


def _held_out(spark: SparkSession, sf: str) -> DataFrame:
    return label_and_number(stored_interactions(spark, sf))[1]


def _popularity(spark: SparkSession, sf: str, splits: DataFrame | None = None) -> tuple[DataFrame, PopularityRecommender]:
    s = splits if splits is not None else split_table(spark, sf)
    return s, PopularityRecommender(TOP_N).create(s.filter(F.col("split") == "train"))


# --- scans, sinks, layout ---------------------------------------------------

def q_interactions(spark, sf):
    return interactions(spark, sf)


def q_nonzero_ratings(spark, sf):
    return copy_column(rated(spark, sf), "user_id", "user_id2").select(
        "user_id", "user_id2", "item_id", "rating", "ts")


def q_drop_null_rows(spark, sf):
    return drop_null_rows(interactions(spark, sf))


def q_hash_sample(spark, sf):
    return hash_sample(rated(spark, sf), SAMPLE_FRACTION, SPLIT_SEED, SAMPLE_KEY)


def q_repartition_layout(spark, sf):
    """Round-robin layout, a named view, and the filter as SQL over the view."""
    laid_out = interactions(spark, sf).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    register_views({"interaction": laid_out})
    return spark.sql("SELECT user_id, item_id, rating, ts FROM interaction WHERE rating != 0")


def q_layout_files(spark, sf):
    """The rated rows laid out round robin, written, and counted by file."""
    path = scratch_path(spark, "layout")
    write_parquet_table(repartition_layout(rated(spark, sf), LAYOUT_FILES), path)
    files = read_parquet_table(spark, path).groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n"))
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.sum("n").alias("n_rows"))


def q_csv_round_trip(spark, sf):
    """Ratings in the source's CSV layout (epoch seconds), written as a
    multi-part CSV with header and read back under the fixed schema."""
    path = scratch_path(spark, "ratings-csv")
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    out = rated(spark, sf).select(F.col("user_id").cast("int").alias("userId"),
                                  F.col("item_id").cast("int").alias("movieId"), "rating",
                                  epoch.cast("int").alias("timestamp"))
    write_csv_parts(out, path, header=True, mode="overwrite")
    return read_csv_table(spark, path)


def q_parquet_split_round_trip(spark, sf):
    path = scratch_path(spark, "splits")
    write_parquet_table(split_rows(spark, sf), path, partition_by=["split"])
    return read_parquet_table(spark, path).select(*SPLIT_COLUMNS)


def q_split_folder_scan(spark, sf):
    path = scratch_path(spark, "splits")
    write_parquet_table(split_rows(spark, sf), path, partition_by=["split"])
    return read_parquet_table(spark, f"{path}/split=val", recursive=True).select(
        "user_id", "item_id", "rating", "ts", "ok", "ln")


def q_row_counts(spark, sf):
    inter = interactions(spark, sf)
    r = nonzero_ratings(inter)
    s = split_table(spark, sf)
    return row_count({"interactions": inter, "rated": r, "active_users": active_users(r),
                      "train": s.filter("split = 'train'"), "val": s.filter("split = 'val'"),
                      "test": s.filter("split = 'test'")})


def q_split_counts(spark, sf):
    return split_table(spark, sf).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                                      F.countDistinct("user_id").alias("n_users"))


def q_table_schemas(spark, sf):
    """Columns of every table, from the footers of all its files."""
    return table_schemas(spark, {t: table_path(sf, t) for t in TABLES}).select("table", "position", "column", "type")


def bucketed_splits(spark, sf):
    """Training and validation rows as tables bucketed by user."""
    s = split_table(spark, sf)
    return [write_bucketed(s.filter(F.col("split") == name), f"tastemap_{name}_by_user", scratch_path(spark, f"bucketed-{name}"),
                           "user_id", BUCKETS, ["user_id", "item_id"]) for name in ("train", "val")]


def q_bucketed_counts(spark, sf):
    """Training and validation rows of every validation user, from tables whose
    layout makes the exchanges unnecessary."""
    train, val = bucketed_splits(spark, sf)
    sizes = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_train"), F.sum("rating").alias("sum_train"))
    held = val.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_val"))
    return held.hint("merge").join(sizes, "user_id", "left")


# --- filters, samples, splits -----------------------------------------------

def q_active_users(spark, sf):
    return active_users(rated(spark, sf))


def q_user_groups(spark, sf):
    return user_groups(active_users(rated(spark, sf)).select("user_id"))


def q_row_numbers(spark, sf):
    return _held_out(spark, sf).select("user_id", "item_id", "rating", "ts", "ok", "ln", "grp", "row_index",
                                       "user_row")


def q_half_split(spark, sf):
    return half_split(_held_out(spark, sf)).select("user_id", "item_id", "rating", "ts", "ok", "ln", "split")


def q_train_val_test(spark, sf):
    return split_rows(spark, sf)


def q_interaction_split(spark, sf):
    """Splits concatenated, averaged per pair, then split by pair."""
    return interaction_split(mean_ratings(split_table(spark, sf)))


# --- popularity, truth, metrics ---------------------------------------------

def q_popularity_scores(spark, sf):
    s = split_table(spark, sf)
    return popularity_scores(s.filter(F.col("split") == "train"))


def q_popularity_top100(spark, sf):
    return _popularity(spark, sf)[1].top


def q_popularity_report_csv(spark, sf):
    """Top list as one CSV file with header (a bounded report) and back."""
    path = scratch_path(spark, "popularity-csv")
    write_single_csv(_popularity(spark, sf)[1].top, path)
    return read_csv_table(spark, path, schema="item_id BIGINT, score BIGINT, rank BIGINT")


def q_popularity_report_parquet(spark, sf):
    """The same list as one parquet file and back."""
    path = scratch_path(spark, "popularity-parquet")
    write_single_parquet(_popularity(spark, sf)[1].top, path)
    return read_parquet_table(spark, path)


def q_popularity_for_users(spark, sf):
    s, pr = _popularity(spark, sf)
    return pr.recommend(s.filter(F.col("split") == "val"))


def q_truth_sets(spark, sf):
    return truth_sets(split_table(spark, sf).filter(F.col("split") == "val"))


def q_popularity_user_metrics(spark, sf):
    s, pr = _popularity(spark, sf)
    per_user = pr.evaluate_by_user(s.filter(F.col("split") == "val"), TOP_N)
    return per_user.select("user_id", "n_truth", "n_hits",
                           *[F.round(c, 10).alias(c) for c in ("precision_at_k", "average_precision", "ndcg_at_k")])


def q_popularity_metrics(spark, sf):
    s, pr = _popularity(spark, sf)
    out = [summarize(pr.evaluate_by_user(s.filter(F.col("split") == t), TOP_N))
           .select(F.lit(t).alias("split"), "*") for t in ("val", "test")]
    return out[0].unionByName(out[1])


def q_item_mean_rmse(spark, sf):
    s = split_table(spark, sf)
    train = s.filter(F.col("split") == "train")
    out = []
    for target in ("val", "test"):
        scored = item_mean_predictions(train, s.filter(F.col("split") == target))
        out.append(rmse(scored).select(F.lit(target).alias("split"), "n_rows", "rmse"))
    return out[0].unionByName(out[1])


# --- matrices and vectors -----------------------------------------------------

def q_user_item_means(spark, sf):
    return mean_ratings(rated(spark, sf))


def q_user_item_pivot(spark, sf):
    """Dense pivot over a given list of items, here the 20 most popular ones,
    named by popularity rank; `user_item_means` is the full matrix."""
    r = rated(spark, sf)
    items = [row["item_id"] for row in top_items(popularity_scores(r), PIVOT_ITEMS).orderBy("rank").collect()]
    wide = dense_pivot(r, items)
    named = [F.col(str(i)).alias(f"top_{n}") for n, i in enumerate(items, 1)]
    absent = [F.lit(0.0).alias(f"top_{n}") for n in range(len(items) + 1, PIVOT_ITEMS + 1)]
    return wide.select("user_id", *named, *absent)


def q_dense_ids(spark, sf):
    """Ratings with users and items numbered from 0, for estimators that hold ids as INT."""
    rows = materialize(rated(spark, sf).select("user_id", "item_id", "rating"), "rated")
    for column in ("user_id", "item_id"):
        rows = ids.encode(rows, ids.id_table(rows, column), column)
    return rows


def q_user_item_maps(spark, sf):
    """The matrix stored by rows in bounded chunks, and opened again."""
    rows = materialize(sparse_rows(rated(spark, sf), most=ROW_CHUNK), "sparse-rows")
    return from_sparse_rows(rows)


def q_vector_columns(spark, sf):
    emb = load_table(spark, sf, "embeddings", ["vec_id", "label", "embedding"])
    return spread_vector(emb, "embedding", VECTOR_WIDTH, ["vec_id", "label"])


# --- ALS (shape-checked) ------------------------------------------------------

def _explicit_model(spark, sf):
    def build():
        train = split_table(spark, sf).filter(F.col("split") == "train")
        return als_ops.fit_als(train, **FINAL_ALS)
    return _memoized(("explicit", sf), build, spark)


def _implicit_model(spark, sf):
    def build():
        train = split_table(spark, sf).filter(F.col("split") == "train")
        return als_ops.fit_als(train, implicit=True, nonnegative=False, **IMPLICIT_ALS)
    return _memoized(("implicit", sf), build, spark)


def q_als_predictions(spark, sf):
    model = _explicit_model(spark, sf)
    return als_ops.predict(model, split_table(spark, sf).filter(F.col("split") == "val"))


def q_als_top100(spark, sf):
    return als_ops.recommend(_explicit_model(spark, sf), TOP_N)


def q_als_metrics(spark, sf):
    model = _explicit_model(spark, sf)
    s = split_table(spark, sf)
    slices = top_n.cut_slices(top_n.packed_vectors(model.itemFactors), [model.rank])      # once for both splits
    out = []
    for target in ("val", "test"):
        rows = s.filter(F.col("split") == target)
        err = rmse(als_ops.predict(model, rows)).select("rmse")
        recs = als_ops.recommend(model, TOP_N, rows.select("user_id"), slices=slices)
        ranked = ranking_metrics(recs, rows, TOP_N)
        # The RMSE is one value: a scalar subquery, not a join.
        out.append(ranked.select(F.lit(target).alias("split"), "*", err.scalar().alias("rmse")))
    return out[0].unionByName(out[1])


def q_als_implicit_top100(spark, sf):
    return als_ops.recommend(_implicit_model(spark, sf), TOP_N)


def q_als_factors(spark, sf):
    model = _implicit_model(spark, sf)
    return als_ops.wide_factors(model, "user").unionByName(als_ops.wide_factors(model, "item"))


def _explicit_grid(spark, sf):
    def build():
        s = split_table(spark, sf)
        points = tuning.grid(**EXPLICIT_GRID)
        return tuning.run_grid(s.filter("split = 'train'"), s.filter("split = 'val'"), points, TOP_N)
    return _memoized(("explicit_grid", sf), build, spark)


def _pair_splits(spark, sf):
    return q_interaction_split(spark, sf)


def _stored_pairs(spark, sf):
    """The averaged pairs with their split, written once per application."""
    def build():
        path = scratch_path(spark, "pairs")
        write_parquet_table(_pair_splits(spark, sf), path, partition_by=["split"])
        return path
    return read_parquet_table(spark, _memoized(("pairs", sf), build, spark))


def _implicit_grid(spark, sf):
    """All points of the comparison grid over the whole pair splits."""
    def build():
        pairs = _stored_pairs(spark, sf)
        points = tuning.grid(implicit=True, **SAMPLED_GRID)
        return tuning.run_shared_grid(pairs.filter("split = 'train'"), pairs.filter("split = 'val'"), points, TUNE_K,
                                      scratch_path(spark, "implicit-grid"))
    return _memoized(("implicit_grid", sf), build, spark)


def _rank1_grid(spark, sf):
    def build():
        s = split_table(spark, sf)
        return tuning.run_shared_grid(s.filter("split = 'train'"), s.filter("split = 'val'"), tuning.grid(**RANK1_GRID), TOP_N,
                                      scratch_path(spark, "rank1-grid"))
    return _memoized(("rank1_grid", sf), build, spark)


def q_als_grid(spark, sf):
    return _explicit_grid(spark, sf)


def q_implicit_grid(spark, sf):
    return _implicit_grid(spark, sf)


def q_best_params(spark, sf):
    return tuning.best_params(_explicit_grid(spark, sf), "rmse", lowest=True)


def q_best_implicit_params(spark, sf):
    return tuning.best_params(_implicit_grid(spark, sf), "precision_at_k", lowest=False)


def _refit(best, train, test, k):
    """The metric row of a stored grid's best point, fitted again and held
    against rows that no choice has seen."""
    point = tuning.GridPoint(best["rank"], best["max_iter"], best["reg"], best["alpha"], best["implicit"])
    return tuning.run_shared_grid(train, test, [point], k)


def q_best_refit(spark, sf):
    """Refit the best implicit point on train, precision@10 on the test pairs."""
    pairs = _stored_pairs(spark, sf)
    return _refit(q_best_implicit_params(spark, sf).first(), pairs.filter("split = 'train'"), pairs.filter("split = 'test'"), TEST_K)


def q_metric_cross_table(spark, sf):
    return tuning.cross_table(_implicit_grid(spark, sf), "reg", "rank", "precision_at_k")


# --- grid over damped item means: selection and cross table with SQL twins ----------

def q_mean_grid(spark, sf):
    s = split_table(spark, sf)
    return tuning.damped_mean_grid(s.filter("split = 'train'"), s.filter("split = 'val'"), MEAN_DAMPINGS,
                                   MEAN_CUTOFFS)


def q_best_mean_rmse(spark, sf):
    """Lowest error; the cut-offs tie, so the smallest one is taken."""
    return tuning.best_params(q_mean_grid(spark, sf), "rmse", True, ("damping", "k"))


def q_best_mean_precision(spark, sf):
    return tuning.best_params(q_mean_grid(spark, sf), "precision_at_k", False, ("damping", "k"))


def q_mean_cross_table(spark, sf):
    return tuning.cross_table(q_mean_grid(spark, sf), "damping", "k", "precision_at_k")


# --- ALS, what holds whatever the fit learns (with SQL twins) --------------------

def q_als_prediction_rows(spark, sf):
    """The validation rows that get a prediction: user and item were trained."""
    return q_als_predictions(spark, sf).filter(F.col("prediction").isNotNull()).select("user_id", "item_id", "rating")


def q_als_list_shape(spark, sf):
    """Per user: length, ranks and items of the list, and whether its scores never rise."""
    before = F.lag("score").over(Window.partitionBy("user_id").orderBy("rank"))
    lists = q_als_top100(spark, sf).withColumn("falls", F.coalesce(F.col("score") <= before, F.lit(True)))
    return lists.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("item_id").alias("n_items"),
        F.min("rank").cast("long").alias("first_rank"), F.max("rank").cast("long").alias("last_rank"),
        F.min("falls").alias("scores_fall"))


def q_als_factor_ids(spark, sf):
    """Every trained user and item has one factor row of full width."""
    factors = q_als_factors(spark, sf)
    filled = sum(F.col(c).isNotNull().cast("long") for c in factors.columns if c.startswith("f_"))
    return factors.select("kind", "id", filled.alias("width"))


def q_als_unseen_shape(spark, sf):
    """Lists without trained pairs: their lengths, and how many such pairs they hold."""
    train = split_table(spark, sf).filter(F.col("split") == "train")
    lists = als_ops.recommend_unseen(_explicit_model(spark, sf), TOP_N, train)
    pairs = train.select("user_id", "item_id", F.lit(1).alias("trained")).distinct()
    return lists.join(pairs, ["user_id", "item_id"], "left").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("rank").alias("last_rank"), F.count("trained").alias("n_seen"))


def q_als_evaluated_users(spark, sf):
    """What the ALS metrics cover: the users evaluated in each split."""
    return q_als_metrics(spark, sf).select("split", "n_users")


def q_implicit_grid_coverage(spark, sf):
    """For every point of the whole grid, the rows predicted and the users ranked."""
    return _implicit_grid(spark, sf).select("rank", "max_iter", "reg", "alpha", "implicit", "k", "n_rows", "n_users")


def q_sliced_list_shape(spark, sf):
    """As ``als_list_shape``, of lists found slice by slice."""
    model = _explicit_model(spark, sf)
    lists = top_n.exact_top_n(model.userFactors, model.itemFactors, TOP_N, model.rank)
    before = F.lag("score").over(Window.partitionBy("user_id").orderBy("rank"))
    return lists.withColumn("falls", F.coalesce(F.col("score") <= before, F.lit(True))).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("item_id").alias("n_items"), F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"), F.min("falls").alias("scores_fall"))


# --- learned values that SQL can state -----------------------------------------------

def q_vector_lists(spark, sf):
    """The vectors of largest inner product of every vector, found slice by slice."""
    vectors = load_table(spark, sf, "embeddings", ["vec_id", "embedding"]).select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    lists = top_n.exact_top_n(vectors, vectors, VECTOR_LIST, VECTOR_WIDTH, "vec_id", "other_id", slice_items=64)
    return lists.select("vec_id", "rank", "other_id", F.round("score", 8).alias("score"))


def q_rank1_factors(spark, sf):
    """Factors of rank 1 after the grid's most rounds, one column for each regularisation."""
    train = split_table(spark, sf).filter("split = 'train'")
    regs, rounds = RANK1_GRID["regs"], max(RANK1_GRID["iters"])
    fitted = block_als.fit(train, [block_als.Point(1, g, nonnegative=True) for g in regs], (rounds,))[rounds]
    out = None
    for kind, table in (("user", fitted.users), ("item", fitted.items)):
        wide = None
        for n in range(len(regs)):
            one = fitted.factors(kind, n).select("id", F.round(F.element_at("features", 1).cast("double"), 4).alias(f"f_{n}"))
            wide = one if wide is None else wide.join(one, "id")
        wide = wide.select(F.lit(kind).alias("kind"), "*")
        out = wide if out is None else out.unionByName(wide)
    return out


def q_rank1_grid(spark, sf):
    return _rank1_grid(spark, sf).select("max_iter", "reg", "k", *RANK1_METRICS)


RANK1_METRICS = ["rmse", "precision_at_k", "map", "ndcg_at_k", "n_rows", "n_users"]


def q_rank1_best_rmse(spark, sf):
    return tuning.best_params(q_rank1_grid(spark, sf), "rmse", True)


def q_rank1_best_precision(spark, sf):
    return tuning.best_params(q_rank1_grid(spark, sf), "precision_at_k", False)


def q_rank1_cross_table(spark, sf):
    return tuning.cross_table(q_rank1_grid(spark, sf), "reg", "max_iter", "rmse")


def q_rank1_refit(spark, sf):
    """The point of the lowest validation error, fitted again and held against the test rows."""
    s = split_table(spark, sf)
    best = tuning.best_params(_rank1_grid(spark, sf), "rmse", True).first()
    return _refit(best, s.filter("split = 'train'"), s.filter("split = 'test'"), TEST_K).select("max_iter", "reg", "k", *RANK1_METRICS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "interactions": q_interactions,
    "nonzero_ratings": q_nonzero_ratings,
    "drop_null_rows": q_drop_null_rows,
    "hash_sample": q_hash_sample,
    "active_users": q_active_users,
    "user_groups": q_user_groups,
    "row_numbers": q_row_numbers,
    "half_split": q_half_split,
    "train_val_test": q_train_val_test,
    "parquet_split_round_trip": q_parquet_split_round_trip,
    "split_folder_scan": q_split_folder_scan,
    "repartition_layout": q_repartition_layout,
    "layout_files": q_layout_files,
    "csv_round_trip": q_csv_round_trip,
    "table_schemas": q_table_schemas,
    "bucketed_counts": q_bucketed_counts,
    "row_counts": q_row_counts,
    "split_counts": q_split_counts,
    "interaction_split": q_interaction_split,
    "popularity_scores": q_popularity_scores,
    "popularity_top100": q_popularity_top100,
    "popularity_report_csv": q_popularity_report_csv,
    "popularity_report_parquet": q_popularity_report_parquet,
    "popularity_for_users": q_popularity_for_users,
    "truth_sets": q_truth_sets,
    "popularity_user_metrics": q_popularity_user_metrics,
    "popularity_metrics": q_popularity_metrics,
    "item_mean_rmse": q_item_mean_rmse,
    "user_item_means": q_user_item_means,
    "dense_ids": q_dense_ids,
    "user_item_maps": q_user_item_maps,
    "user_item_pivot": q_user_item_pivot,
    "vector_columns": q_vector_columns,
    "als_predictions": q_als_predictions,
    "als_top100": q_als_top100,
    "als_metrics": q_als_metrics,
    "als_implicit_top100": q_als_implicit_top100,
    "als_factors": q_als_factors,
    "als_prediction_rows": q_als_prediction_rows,
    "als_list_shape": q_als_list_shape,
    "als_factor_ids": q_als_factor_ids,
    "als_unseen_shape": q_als_unseen_shape,
    "als_evaluated_users": q_als_evaluated_users,
    "sliced_list_shape": q_sliced_list_shape,
    "vector_lists": q_vector_lists,
    "rank1_factors": q_rank1_factors,
    "rank1_grid": q_rank1_grid,
    "rank1_best_rmse": q_rank1_best_rmse,
    "rank1_best_precision": q_rank1_best_precision,
    "rank1_cross_table": q_rank1_cross_table,
    "rank1_refit": q_rank1_refit,
    "implicit_grid_coverage": q_implicit_grid_coverage,
    "mean_grid": q_mean_grid,
    "best_mean_rmse": q_best_mean_rmse,
    "best_mean_precision": q_best_mean_precision,
    "mean_cross_table": q_mean_cross_table,
    "als_grid": q_als_grid,
    "implicit_grid": q_implicit_grid,
    "best_params": q_best_params,
    "best_implicit_params": q_best_implicit_params,
    "best_refit": q_best_refit,
    "metric_cross_table": q_metric_cross_table,
}
