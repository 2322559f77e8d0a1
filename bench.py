"""Headline timings: split, popularity baseline, metrics, ALS fit and top-100.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The steps follow the workflow: interactions are derived from the driver
tables, split, and written once as parquet partitioned by split; every
later step reads that table.  Results that are not small go to the ``noop``
sink, which runs the whole plan without writing.  Before timing, the same
where an sf0.01 fit ran before the sf0.1 one, so JVM class loading and JIT
warm-up are not charged to the first query.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tastemap.operators import als as als_ops  # noqa: E402
from tastemap.operators.popularity import PopularityRecommender  # noqa: E402
from tastemap.operators.ranking import item_mean_predictions, ranking_metrics, rmse, summarize  # noqa: E402
from tastemap.plans.jobs import read_splits, write_splits  # noqa: E402
from tastemap.session import build_session, release_held, scratch_path  # noqa: E402

# One local JVM: its heap, and as few initial partitions as shuffle partitions.
LOCAL_CONF = {"spark.driver.memory": "12g",
              "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16"}
WARMUP_DIRS = ("/root/testdata/sf0.01", "/root/testdata/sf0.001")


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def run(spark, sf_dir: str, times: dict | None) -> None:
    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        if times is not None:
            times[name] = round(time.perf_counter() - t0, 3)
        return out

    path = scratch_path(spark, "bench-splits")
    timed("split_write", lambda: write_splits(spark, sf_dir, path))
    splits = read_splits(spark, path)
    train, val = splits["train"], splits["val"]

    pop = PopularityRecommender(100)
    timed("popularity_top100", lambda: pop.create(train).top.collect())
    timed("popularity_metrics", lambda: summarize(pop.evaluate_by_user(val, 100)).collect())
    timed("item_mean_rmse", lambda: rmse(item_mean_predictions(train, val)).collect())

    model = timed("als_fit", lambda: als_ops.fit_als(train, rank=20, max_iter=10, reg=0.1))
    timed("als_rmse", lambda: rmse(als_ops.predict(model, val)).collect())
    timed("als_top100_all_users", lambda: _noop(als_ops.recommend(model, 100)))
    timed("als_metrics", lambda: ranking_metrics(
        als_ops.recommend(model, 100, val.select("user_id")), val, 100).collect())
    release_held()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          extra=LOCAL_CONF,
                          app_name="tastemap-bench")
    warmup = next((d for d in WARMUP_DIRS if os.path.isdir(d) and d.rstrip("/") != sf_dir.rstrip("/")), None)
    if warmup:
        run(spark, warmup, None)
    times: dict[str, float] = {}
    run(spark, sf_dir, times)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
