"""Command line: ``spark-submit ... -m roamrank`` or ``python -m roamrank``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from roamrank.operators.model import AlsConfig
from roamrank.plans.pipeline import Inputs, Outputs, run
from roamrank.sinks import preview


def main() -> None:
    parser = argparse.ArgumentParser(prog="roamrank")
    for name in ("reviews", "listings", "areas"):
        parser.add_argument(f"--{name}", required=True, nargs="+", help="CSV files or folders")
    for name in ("model", "result"):
        parser.add_argument(f"--{name}", required=True, help="folder to replace")
    parser.add_argument("--metrics", help="table to append the error figures to")
    parser.add_argument("--rejects", help="folder for malformed and unmatched records")
    parser.add_argument("--seed", type=int, required=True)
    parser.add_argument("--rank", type=int, default=10)
    parser.add_argument("--iterations", type=int, default=3)
    parser.add_argument("--reg", type=float, default=0.01)
    parser.add_argument("--k", type=int, default=5)
    parser.add_argument("--exclude-seen", action="store_true")
    parser.add_argument("--no-holdout", action="store_true")
    parser.add_argument("--single-line", action="store_true", help="no line breaks inside fields")
    parser.add_argument("--as-of", help="date to stamp, yyyy-MM-dd; today if left out")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("roamrank").getOrCreate()
    published = run(
        spark,
        Inputs(args.reviews, args.listings, args.areas, not args.single_line),
        Outputs(args.model, args.result, args.metrics, args.rejects),
        AlsConfig(args.seed, args.rank, args.iterations, args.reg),
        args.k,
        args.exclude_seen,
        not args.no_holdout,
        args.as_of,
    )
    published.metrics.show(truncate=False)
    preview(published.recommendations).show(truncate=False)


if __name__ == "__main__":
    main()
