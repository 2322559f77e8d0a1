"""The workflow's stages as jobs: split, popularity baseline, ALS tuning and
evaluation, latent factors, and the sampled comparison run.

Each job reads tables, runs Spark plans and writes tables or returns small
metric frames; nothing of data size is brought to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.operators import als as als_ops
from tastemap.operators import tuning
from tastemap.operators.matrix import mean_ratings
from tastemap.operators.popularity import PopularityRecommender
from tastemap.operators.prep import drop_null_rows, hash_sample
from tastemap.operators.ranking import ranking_metrics, rmse, summarize
from tastemap.operators.split import SPLIT_SEED, interaction_split, train_val_test
from tastemap.params import (FINAL_ALS, IMPLICIT_ALS, LAYOUT_PARTITIONS, SAMPLE_FRACTION, SAMPLED_GRID, TEST_K,
                             TOP_N, TUNE_K)
from tastemap.session import delete_path, release_held, scratch_scope
from tastemap.sources.files import (materialize, read_csv_table, read_parquet_table, repartition_layout,
                                    write_csv_parts,
                                    write_parquet_table, write_single_csv)
from tastemap.sources.interactions import interactions


def write_splits(spark: SparkSession, sf_dir: str, out_path: str) -> str:
    """Stage A: derive interactions, split them, write one table partitioned by split."""
    with scratch_scope(spark):
        source = materialize(interactions(spark, sf_dir), "interactions")
        write_parquet_table(train_val_test(source), out_path, partition_by=["split"])
        release_held()
    return out_path


def ratings_from_csv(spark: SparkSession, path: str) -> DataFrame:
    """A rating file (userId, movieId, rating, epoch-second timestamp, with a
    header line) as (user_id, item_id, rating, ts)."""
    raw = read_csv_table(spark, path)
    return raw.select(F.col("userId").cast("long").alias("user_id"), F.col("movieId").cast("long").alias("item_id"),
                      F.col("rating"), F.timestamp_seconds(F.col("timestamp")).alias("ts"))


def write_splits_from_ratings(spark: SparkSession, csv_path: str, out_path: str) -> str:
    """Stage A from a rating file: ties in (user, ts, item, rating) are whole-row duplicates."""
    with scratch_scope(spark):
        source = materialize(ratings_from_csv(spark, csv_path), "ratings")
        write_parquet_table(train_val_test(source, extra_order=()), out_path, partition_by=["split"])
        release_held()
    return out_path


def read_splits(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The three splits; each filter prunes to its folder."""
    table = read_parquet_table(spark, path)
    return {name: drop_null_rows(table.filter(F.col("split") == name).drop("split"))
            for name in ("train", "val", "test")}


def _stack(rows: dict[str, DataFrame]) -> DataFrame:
    frames = [df.select(F.lit(name).alias("split"), "*") for name, df in rows.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def evaluate_popularity(splits: dict[str, DataFrame], k: int = TOP_N,
                        report_path: str | None = None) -> DataFrame:
    """Stage B: top-k by popularity from train, scored on validation and test.

    ``report_path`` writes the ranked list once as a single CSV with header.
    """
    pop = PopularityRecommender(k).create(splits["train"])
    pop.top = materialize(pop.top, "top-items")  # k rows, read by the report and both evaluations
    if report_path:
        write_single_csv(pop.top, report_path)
    return _stack({t: summarize(pop.evaluate_by_user(splits[t], k)) for t in ("val", "test")})


def tune_als(splits: dict[str, DataFrame], points: list[tuning.GridPoint], k: int = TOP_N,
             metric: str = "rmse", lowest: bool = True) -> tuple[DataFrame, DataFrame]:
    """Stage C, tuning: grid on train, scored on validation; (grid, best row)."""
    grid = tuning.run_grid(splits["train"], splits["val"], points, k)
    return grid, tuning.best_params(grid, metric, lowest)


def evaluate_als(splits: dict[str, DataFrame], rank: int = FINAL_ALS["rank"],
                 max_iter: int = FINAL_ALS["max_iter"], reg: float = FINAL_ALS["reg"],
                 k: int = TOP_N, export_dir: str | None = None) -> DataFrame:
    """Stage C, final: fit on train; RMSE and ranking metrics on validation
    and test.  ``export_dir`` receives the exploded top-k of every user as
    multi-part CSV (``all-users``)."""
    model = als_ops.fit_als(splits["train"], rank, max_iter, reg)
    rows = {}
    for target in ("val", "test"):
        part = splits[target]
        recs = als_ops.recommend(model, k, part.select("user_id"))
        err = rmse(als_ops.predict(model, part)).select("rmse")
        rows[target] = ranking_metrics(recs, part, k).select("*", err.scalar().alias("rmse"))
    if export_dir:
        write_csv_parts(als_ops.recommend(model, k), f"{export_dir}/all-users", header=True, mode="overwrite")
    return _stack(rows)


def latent_factors(splits: dict[str, DataFrame], out_dir: str, rank: int = IMPLICIT_ALS["rank"],
                   max_iter: int = IMPLICIT_ALS["max_iter"], reg: float = IMPLICIT_ALS["reg"],
                   alpha: float = IMPLICIT_ALS["alpha"]) -> None:
    """Stage D: implicit ALS; user and item factors written as wide CSV with ids."""
    model = als_ops.fit_als(splits["train"], rank, max_iter, reg, implicit=True, alpha=alpha,
                            nonnegative=False)
    for kind in ("user", "item"):
        write_csv_parts(als_ops.wide_factors(model, kind), f"{out_dir}/{kind}", header=True, mode="overwrite")


def sampled_comparison(spark: SparkSession, splits_path: str, work_dir: str,
                       fraction: float = SAMPLE_FRACTION, partitions: int = LAYOUT_PARTITIONS,
                       points: list[tuning.GridPoint] | None = None,
                       k_tune: int = TUNE_K, k_test: int = TEST_K, resume: bool = False) -> dict[str, DataFrame]:
    """Stage E: sample each split, lay it out, concatenate, average per pair,
    split the pairs 20/40/40, tune implicit ALS by precision@k_tune, refit the
    best point and score precision@k_test on the test pairs.  The grid's points
    are fitted over one layout and its rows appended to ``work_dir``/grid as they
    get ready; with ``resume``, for a run of the same splits that was stopped,
    the points already there are kept."""
    splits = read_splits(spark, splits_path)
    keys = ["user_id", "item_id", "ok", "ln"]
    sampled = {}
    for name, df in splits.items():
        # The sample grows with the data, so it stays a multi-file table; the
        # layout step sets its file count.
        laid_out = repartition_layout(hash_sample(df, fraction, SPLIT_SEED, keys), partitions)
        write_parquet_table(laid_out, f"{work_dir}/sampled-{name}")
        sampled[name] = spark.read.parquet(f"{work_dir}/sampled-{name}")
    together = sampled["train"].unionByName(sampled["val"]).unionByName(sampled["test"])
    path = f"{work_dir}/pairs"                    # every grid point reads the pairs of a split
    write_parquet_table(interaction_split(mean_ratings(together)), path, partition_by=["split"])
    pairs = spark.read.parquet(path)
    pair_splits = {name: pairs.filter(F.col("split") == name).drop("split") for name in ("train", "val", "test")}
    points = points or tuning.grid(implicit=True, **SAMPLED_GRID)
    if not resume:
        delete_path(spark, f"{work_dir}/grid")
    grid = tuning.run_shared_grid(pair_splits["train"], pair_splits["val"], points, k_tune, f"{work_dir}/grid")
    best = tuning.best_params(grid, "precision_at_k", lowest=False)
    b = best.first()
    point = tuning.GridPoint(b["rank"], b["max_iter"], b["reg"], b["alpha"], True)
    refit_df = tuning.run_shared_grid(pair_splits["train"], pair_splits["test"], [point], k_test)
    return {"grid": grid, "best": best, "refit": refit_df,
            "cross_table": tuning.cross_table(grid, "reg", "rank", "precision_at_k")}
