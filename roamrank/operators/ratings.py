"""Visit counts per person and area, used as ratings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamrank.functions.expressions import split_bucket
from roamrank.operators.dims import trainer_ids
from roamrank.operators.joins import lookup_join
from roamrank.operators.visits import area_of_reviews
from roamrank.workspace import write_table


def visit_counts_named(visits: DataFrame) -> DataFrame:
    """Visits per person and area with both names, for people to read.

    A renamed person has several rows here; ratings don't use this table.
    """
    return visits.groupBy("reviewer_id", "reviewer_name", "neighbourhood_id", "neighbourhood").agg(
        F.count("*").alias("count")
    )


def build_ratings(listing_area: DataFrame, reviews: DataFrame, **options) -> DataFrame:
    """(reviewer_id, neighbourhood_id, rating): one row per pair, rating = visits.

    Both columns are ids, so the shuffle carries two numbers and a count for
    each pair that a map task saw.
    """
    return count_ratings(area_of_reviews(listing_area, reviews, **options))


def count_ratings(visits: DataFrame) -> DataFrame:
    """The same from visits that know their area."""
    # The names of the columns.
    pairs = visits.groupBy("reviewer_id", "neighbourhood_id")
    return pairs.agg(F.count("*").cast("double").alias("rating"))


@dataclass(frozen=True)
class TrainerRatings:
    """(user, item, rating) under int ids; ``users`` maps back if ids changed."""

    ratings: DataFrame
    users: DataFrame | None


def to_trainer(ratings: DataFrame) -> TrainerRatings:
    """Give stored ratings the (user int, item int, rating double) form ALS takes.

    Reviewer ids that fit an int are kept, which costs no join; others are
    numbered. Area ids are dense already; the cast raises should one not fit.
    """
    users = trainer_ids(ratings, "reviewer_id", "user")
    if users is None:
        keyed = ratings.withColumn("user", F.col("reviewer_id"))
    else:
        users = write_table(users, "user-ids")
        keyed = lookup_join(ratings, users, "reviewer_id")
    return TrainerRatings(
        keyed.select(
            F.col("user").cast("int").alias("user"),
            F.col("neighbourhood_id").cast("int").alias("item"),
            F.col("rating").cast("double").alias("rating"),
        ),
        users,
    )


def kept_to_fit(percent: int = 80, seed: int = 0) -> Column:
    """Whether a (user, item, rating) is on the first side of ``holdout_split``."""
    return split_bucket(F.col("user"), F.col("item"), seed) < percent


def holdout_split(ratings: DataFrame, percent: int = 80, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split (user, item, rating) by a hash of the pair; reruns agree."""
    kept = kept_to_fit(percent, seed)
    return ratings.where(kept), ratings.where(~kept)


def random_split(ratings: DataFrame, fraction: float = 0.8, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split by Spark's sampler; reruns agree only on the same partitioning."""
    train, test = ratings.randomSplit([fraction, 1.0 - fraction], seed)
    return train, test
