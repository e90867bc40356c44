"""The whole job: raw files to published recommendations."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamrank import sinks, store
from roamrank.operators.dims import area_dim, reviewer_dim
from roamrank.operators.model import AlsConfig, FactorModel, evaluate, train, train_with_holdout
from roamrank.operators.ratings import count_ratings, kept_to_fit, to_trainer
from roamrank.operators.recommend import attach_names, recommend_topk
from roamrank.operators.visits import (
    MALFORMED,
    NULL_KEY,
    UNMATCHED,
    USED,
    join_listing_area,
    rejected,
    route_listings,
    route_reviews,
    store_routes,
    unmatched_listings,
)
from roamrank.sources import csv
from roamrank.workspace import scratch_tables, sized, write_table


# Tables beside a stored model.
AREAS = "neighbourhood string, neighbourhood_id bigint"
USERS = "reviewer_id bigint, user bigint"


@dataclass(frozen=True)
class Inputs:
    """CSV paths: a file, a folder, a glob, or a list of them each."""

    reviews: str | list[str]
    listings: str | list[str]
    areas: str | list[str]
    multi_line: bool = True


@dataclass(frozen=True)
class Outputs:
    """Where to write; ``rejects`` gets the malformed and the unmatched
    records, and those without a key."""

    model: str
    result: str
    metrics: str | None = None
    rejects: str | None = None


@dataclass(frozen=True)
class Published:
    recommendations: DataFrame
    metrics: DataFrame


def run(
    spark: SparkSession,
    inputs: Inputs,
    outputs: Outputs,
    config: AlsConfig,
    k: int = 5,
    exclude_seen: bool = False,
    holdout: bool = True,
    as_of: datetime.date | str | None = None,
) -> Published:
    """Load the CSV files, then train, store, evaluate and publish."""
    with scratch_tables(spark):
        lines = inputs.multi_line
        reviews = csv.load_reviews(
            spark, inputs.reviews, multi_line=lines, keep=csv.REVIEW_COLUMNS
        )
        listings = csv.load_listings(
            spark, inputs.listings, multi_line=lines, keep=csv.LISTING_COLUMNS
        )
        areas = csv.load_areas(spark, inputs.areas, multi_line=lines)
        if outputs.rejects:
            for name, landed in (("reviews", reviews), ("listings", listings), ("areas", areas)):
                bad = landed.quarantined.write.mode("overwrite")
                bad.parquet(f"{outputs.rejects}/malformed_{name}")
        return publish(
            csv.scan_reviews(reviews.good),
            csv.scan_listings(listings.good),
            areas.good,
            outputs,
            config,
            k,
            exclude_seen,
            holdout,
            as_of,
        )


def publish(
    reviews: DataFrame,
    listings: DataFrame,
    areas: DataFrame,
    outputs: Outputs,
    config: AlsConfig,
    k: int = 5,
    exclude_seen: bool = False,
    holdout: bool = True,
    as_of: datetime.date | str | None = None,
) -> Published:
    """The same from DataFrames in the scans' form.

    The reviews are read once: each is routed to the ratings, to the unmatched or to
    those without a key, and stored with its area. Ratings are written once and the model is stored before use, so no later
    step goes back to the reviews or refits after losing executors. Names and
    id mappings are stored beside the model: it can't be read without them.
    """
    spark = reviews.sparkSession
    with scratch_tables(spark):
        version = store.new_version(outputs.model)
        store.lease(spark, version)
        try:
            return _publish(
                reviews, listings, areas, outputs, version, config, k, exclude_seen, holdout, as_of
            )
        finally:
            store.release(spark, version)


def _publish(
    reviews: DataFrame,
    listings: DataFrame,
    areas: DataFrame,
    outputs: Outputs,
    version: str,
    config: AlsConfig,
    k: int,
    exclude_seen: bool,
    holdout: bool,
    as_of: datetime.date | str | None,
) -> Published:
    spark = reviews.sparkSession
    listings, no_listing = csv.split_null_keys(listings, *csv.LISTING_KEYS)
    areas, no_area = csv.split_null_keys(areas, *csv.AREA_KEYS)
    area_dim(areas).write.parquet(f"{version}/areas")
    dim = sized(spark.read.schema(AREAS).parquet(f"{version}/areas"))
    # Used for the ratings and the rejects, so it is joined and measured once.
    listing_area = write_table(join_listing_area(listings, dim), "listing-area")
    # The only pass over the reviews.
    routed = store_routes(route_reviews(listing_area, reviews))
    if outputs.rejects:
        lost = {
            "null_keys_reviews": rejected(routed, NULL_KEY),
            "unmatched_reviews": rejected(routed, UNMATCHED),
            "null_keys_listings": no_listing,
            "null_keys_areas": no_area,
            "unmatched_listings": unmatched_listings(listings, dim),
        }
        for name, rows in lost.items():
            rows.write.mode("overwrite").parquet(f"{outputs.rejects}/{name}")

    counted = write_table(count_ratings(routed.where(F.col("route") == USED)), "ratings")
    keyed = to_trainer(counted)
    ratings = keyed.ratings
    if keyed.users is not None:
        ratings = write_table(ratings, "keyed-ratings")
    kept = kept_to_fit(seed=config.seed)
    # The model of the metric for unseen pairs comes out of the same passes.
    model, judged = train_with_holdout(ratings, config, kept) if holdout else (train(ratings, config), None)
    model.write_to(version)
    _save_users(keyed.users, spark, version)
    store.point(spark, outputs.model, version)

    metrics = _metrics(model, judged, ratings, ~kept, version, config, as_of)
    if outputs.metrics:
        sinks.write_metrics(metrics, outputs.metrics)
    known = routed.where(F.col("route") != NULL_KEY)
    named = _recommend(version, reviewer_dim(known), k, ratings if exclude_seen else None, as_of)
    return Published(sinks.write_result(named, outputs.result), metrics)


def record_balance(
    reviews: csv.Landed, listings: csv.Landed, areas: csv.Landed
) -> DataFrame:
    """Where the records of each input went: (input, read, used, malformed, null_key, unmatched).

    Each input is read once, its records routed by left joins and counted by route.
    """
    dim = write_table(area_dim(csv.split_null_keys(areas.good, *csv.AREA_KEYS)[0]), "areas")
    routed_listings = write_table(route_listings(dim, csv.scan_listings(listings.good)), "routed-listings")
    used = routed_listings.where(F.col("route") == USED).drop("route")
    routed_reviews = route_reviews(used, csv.scan_reviews(reviews.good))
    no_area = F.col("neighbourhood").isNull()
    routed_areas = areas.good.select(F.when(no_area, NULL_KEY).otherwise(USED).alias("route"))

    def counted(name: str, landed: csv.Landed, routed: DataFrame) -> DataFrame:
        malformed = landed.quarantined.select(F.lit(MALFORMED).alias("route"))
        rows = routed.select("route").unionByName(malformed)
        count = lambda route: F.count(F.when(F.col("route") == route, 1)).alias(route)
        parts = [count(route) for route in (USED, MALFORMED, NULL_KEY, UNMATCHED)]
        return rows.agg(F.count("*").alias("read"), *parts).withColumn("input", F.lit(name))

    return (
        counted("reviews", reviews, routed_reviews)
        .unionByName(counted("listings", listings, routed_listings))
        .unionByName(counted("areas", areas, routed_areas))
    )


def _save_users(users: DataFrame | None, spark: SparkSession, path: str) -> None:
    if users is None:
        users = spark.createDataFrame([], USERS)
    users.write.parquet(f"{path}/users")


def _metrics(
    fitted: FactorModel,
    judged: FactorModel | None,
    ratings: DataFrame,
    held: Column,
    version: str,
    config: AlsConfig,
    as_of: datetime.date | str | None,
) -> DataFrame:
    """One row per sample, held by the driver; the run's id is the name of its model's version."""
    run = (version.rpartition("/")[2], as_of)
    rows = evaluate(fitted, ratings, config, "train", *run)
    if judged is not None:
        rows = rows.union(evaluate(judged, ratings.where(held), config, "holdout", *run))
    return ratings.sparkSession.createDataFrame(rows.collect(), rows.schema)


def recommend_from(
    path: str,
    reviewers: DataFrame,
    k: int = 5,
    seen: DataFrame | None = None,
    as_of: datetime.date | str | None = None,
) -> DataFrame:
    """Named recommendations from a model that ``publish`` stored."""
    return _recommend(store.current(reviewers.sparkSession, path), reviewers, k, seen, as_of)


def _recommend(
    version: str, reviewers: DataFrame, k: int, seen: DataFrame | None, as_of: datetime.date | str | None
) -> DataFrame:
    spark = reviewers.sparkSession
    users = spark.read.schema(USERS).parquet(f"{version}/users")
    # Scoring is the costly part: written, it isn't repeated for the joins below.
    best = write_table(recommend_topk(FactorModel.read_from(spark, version), k, seen), "best")
    areas = sized(spark.read.schema(AREAS).parquet(f"{version}/areas"))
    mapping = None if users.isEmpty() else users
    return attach_names(best, areas, reviewers, mapping, as_of)
