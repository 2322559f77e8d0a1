"""Scaling and skew probe on inputs derived from the driver tables.

    python tools/scale_probe.py [sf_dir] [copies]

Builds ``copies`` disjoint copies of the interaction table (ids offset per
copy), then a skewed variant where one validation-group user holds a third
of all rows, and times the split, the popularity metrics and an ALS fit.
Checks that the hot user's held-out rows are split into exact halves.
Prints one JSON line.  Scratch data goes below a fresh checkpoint folder.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tastemap.functions.buckets import hash_bucket  # noqa: E402
from tastemap.operators import als as als_ops  # noqa: E402
from tastemap.operators.popularity import PopularityRecommender  # noqa: E402
from tastemap.operators.ranking import summarize  # noqa: E402
from tastemap.operators.split import SPLIT_SEED, train_val_test  # noqa: E402
from tastemap.session import build_session, release_held, scratch_path  # noqa: E402
from tastemap.sources.files import materialize, write_parquet_table  # noqa: E402
from tastemap.sources.interactions import interactions  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = build_session(master="local[8]", shuffle_partitions=16)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tastemap-probe-"))
    res: dict = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        res[name] = round(time.perf_counter() - t0, 2)
        return out

    base = materialize(interactions(spark, sf_dir), "probe-base")
    parts = [base.withColumn("user_id", F.col("user_id") + c * 10_000_000)
             .withColumn("ok", F.col("ok") + c * 100_000_000) for c in range(copies)]
    big = parts[0]
    for p in parts[1:]:
        big = big.unionByName(p)
    big = materialize(big, "probe-big")
    res["rows"] = big.count()

    ids = spark.range(1, 1000).select(F.col("id").alias("user_id"), hash_bucket(["user_id"], SPLIT_SEED).alias("b"))
    hot = ids.filter("b >= 600 AND b < 800").orderBy("user_id").first()["user_id"]
    skewed = materialize(big.withColumn("user_id", F.when(F.col("ok") % 3 == 0, F.lit(hot))
                                        .otherwise(F.col("user_id"))), "probe-skewed")

    for label, src in (("even", big), ("skewed", skewed)):
        out = scratch_path(spark, f"probe-splits-{label}")
        timed(f"{label}_split", lambda: write_parquet_table(train_val_test(src), out, partition_by=["split"]))
        release_held()
        s = spark.read.parquet(out)
        train, val = s.filter("split = 'train'"), s.filter("split = 'val'")
        pop = PopularityRecommender(100).create(train)
        timed(f"{label}_popularity_metrics", lambda: summarize(pop.evaluate_by_user(val, 100)).collect())
        timed(f"{label}_als_fit_5_iter", lambda: als_ops.fit_als(train, 20, 5, 0.1))
        if label == "skewed":
            by = {r["split"]: r["count"] for r in s.filter(F.col("user_id") == hot).groupBy("split").count().collect()}
            res["hot_user_rows"] = by
            res["hot_user_halves_exact"] = abs(by.get("val", 0) - by.get("train", 0)) <= 1
    print(json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main()
