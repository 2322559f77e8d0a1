"""Run the workflow's stages from the command line.

    python -m tastemap split      (--sf-dir DIR | --ratings-csv FILE) --out SPLITS
    python -m tastemap popularity --splits SPLITS [--report CSV_DIR] [--k 100]
    python -m tastemap tune       --splits SPLITS [--ranks 20] [--iters 5 10] [--regs 0.1] [--k 100]
    python -m tastemap evaluate   --splits SPLITS [--rank 20 --iters 10 --reg 0.1] [--export DIR]
    python -m tastemap factors    --splits SPLITS --out DIR [--rank 20 --iters 5 --reg 0.01 --alpha 0.1]
    python -m tastemap sampled    --splits SPLITS --work DIR [--fraction 0.125] [--partitions 2000] [--resume]

Metric tables are printed as JSON lines (they have a handful of rows).  On a
cluster, pass ``--master`` as the cluster's and set ``spark.checkpoint.dir``
in the Spark configuration.
"""

from __future__ import annotations

import argparse
import json

from tastemap import params
from tastemap.operators import tuning
from tastemap.plans import jobs
from tastemap.session import build_session


def _print(df) -> None:
    for row in df.collect():
        print(json.dumps(row.asDict(), default=str))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tastemap")
    parser.add_argument("--master", help="else as submitted")
    parser.add_argument("--shuffle-partitions", type=int)
    sub = parser.add_subparsers(dest="stage", required=True)

    p = sub.add_parser("split")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder of the parquet tables (interactions are derived)")
    src.add_argument("--ratings-csv", help="rating file: userId, movieId, rating, timestamp, header line")
    p.add_argument("--out", required=True)

    p = sub.add_parser("popularity")
    p.add_argument("--splits", required=True)
    p.add_argument("--report")
    p.add_argument("--k", type=int, default=params.TOP_N)

    p = sub.add_parser("tune")
    p.add_argument("--splits", required=True)
    p.add_argument("--ranks", type=int, nargs="+", default=list(params.EXPLICIT_GRID["ranks"]))
    p.add_argument("--iters", type=int, nargs="+", default=list(params.EXPLICIT_GRID["iters"]))
    p.add_argument("--regs", type=float, nargs="+", default=list(params.EXPLICIT_GRID["regs"]))
    p.add_argument("--k", type=int, default=params.TOP_N)

    p = sub.add_parser("evaluate")
    p.add_argument("--splits", required=True)
    p.add_argument("--rank", type=int, default=params.FINAL_ALS["rank"])
    p.add_argument("--iters", type=int, default=params.FINAL_ALS["max_iter"])
    p.add_argument("--reg", type=float, default=params.FINAL_ALS["reg"])
    p.add_argument("--k", type=int, default=params.TOP_N)
    p.add_argument("--export")

    p = sub.add_parser("factors")
    p.add_argument("--splits", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--rank", type=int, default=params.IMPLICIT_ALS["rank"])
    p.add_argument("--iters", type=int, default=params.IMPLICIT_ALS["max_iter"])
    p.add_argument("--reg", type=float, default=params.IMPLICIT_ALS["reg"])
    p.add_argument("--alpha", type=float, default=params.IMPLICIT_ALS["alpha"])

    p = sub.add_parser("sampled")
    p.add_argument("--splits", required=True)
    p.add_argument("--work", required=True)
    p.add_argument("--fraction", type=float, default=params.SAMPLE_FRACTION)
    p.add_argument("--partitions", type=int, default=params.LAYOUT_PARTITIONS)
    p.add_argument("--resume", action="store_true", help="keep the grid points that a stopped run has written")

    args = parser.parse_args(argv)
    spark = build_session(master=args.master, shuffle_partitions=args.shuffle_partitions)
    try:
        if args.stage == "split":
            if args.ratings_csv:
                path = jobs.write_splits_from_ratings(spark, args.ratings_csv, args.out)
            else:
                path = jobs.write_splits(spark, args.sf_dir, args.out)
            print(json.dumps({"splits": path}))
        elif args.stage == "popularity":
            _print(jobs.evaluate_popularity(jobs.read_splits(spark, args.splits), args.k, args.report))
        elif args.stage == "tune":
            points = tuning.grid(args.ranks, args.iters, args.regs)
            grid, best = jobs.tune_als(jobs.read_splits(spark, args.splits), points, args.k)
            _print(grid)
            _print(best)
        elif args.stage == "evaluate":
            _print(jobs.evaluate_als(jobs.read_splits(spark, args.splits), args.rank, args.iters, args.reg,
                                     args.k, args.export))
        elif args.stage == "factors":
            jobs.latent_factors(jobs.read_splits(spark, args.splits), args.out, args.rank, args.iters,
                                args.reg, args.alpha)
            print(json.dumps({"factors": args.out}))
        elif args.stage == "sampled":
            out = jobs.sampled_comparison(spark, args.splits, args.work, args.fraction, args.partitions,
                                          resume=args.resume)
            for name in ("grid", "best", "refit", "cross_table"):
                _print(out[name])
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
