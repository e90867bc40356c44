"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from roamrank.checks import tables
from roamrank.checks.queries import FULL, K, QUERIES
from roamrank.operators import model, recommend

HEADLINE = [
    "scan_reviews",
    "area_dim",
    "listing_area_join",
    "visits",
    "visit_counts_named",
    "ratings",
    "reviewer_dim",
    "unmatched_reviews",
    "csv_quarantine",
    "holdout_split",
    "topk_bruteforce",
    "publish_full",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables.read(spark, sf_dir, "nation").groupBy("n_name").count().collect()  # start the JVM's pools

    seconds: dict[str, float] = {}

    def timed(name, job):
        start = time.perf_counter()
        result = job()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    for name in HEADLINE:
        timed(name, lambda: drain(QUERIES[name](spark, sf_dir)))

    rated = timed("joins_and_ratings_table", lambda: tables.trainer_ratings(spark, sf_dir))
    fitted = timed("als_fit_rank10", lambda: model.train(rated, FULL))

    def score():
        drain(model.evaluate(fitted, rated, FULL, "train"))
        drain(recommend.recommend_topk(fitted, K))

    timed("mse_and_top5", score)
    timed("top5_unseen", lambda: drain(recommend.recommend_topk(fitted, K, seen=rated)))
    print(
        json.dumps(
            {
                "metric": "total wall-clock of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
