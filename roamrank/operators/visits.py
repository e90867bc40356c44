"""Listings, areas and reviews joined into visits, and what fell out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamrank.operators.joins import lookup_join
from roamrank.workspace import new_path, sized

# Where a record goes.
USED, UNMATCHED, NULL_KEY, MALFORMED = "used", "unmatched", "null_key", "malformed"

# The names of the visits' columns.
VISIT_COLUMNS = [
    "host_id",
    "host_name",
    "neighbourhood",
    "neighbourhood_id",
    "listing_id",
    "date",
    "reviewer_id",
    "reviewer_name",
]


def join_listing_area(listings: DataFrame, areas: DataFrame, **options) -> DataFrame:
    joined = lookup_join(listings, areas, "neighbourhood", **options)
    return joined.select("id", "host_id", "host_name", "neighbourhood", "neighbourhood_id")


def join_reviews(listing_area: DataFrame, reviews: DataFrame, **options) -> DataFrame:
    """Visits: every review with its listing's host and area."""
    listings = sized(listing_area.withColumnRenamed("id", "listing_id"), at_most=listing_area)
    return lookup_join(reviews, listings, "listing_id", **options).select(*VISIT_COLUMNS)


def route_reviews(listing_area: DataFrame, reviews: DataFrame, **options) -> DataFrame:
    """Every review with the area of its listing and its ``route``: used, unmatched or null_key.

    One left join: a listing that isn't there leaves no area. Reviews without a
    listing or a person have no key.
    """
    areas = listing_area.select(F.col("id").alias("listing_id"), "neighbourhood_id")
    areas = sized(areas, at_most=listing_area)
    no_key = F.col("listing_id").isNull() | F.col("reviewer_id").isNull()
    return _routed(lookup_join(reviews, areas, "listing_id", "left", **options), no_key, "neighbourhood_id")


def route_listings(areas: DataFrame, listings: DataFrame, **options) -> DataFrame:
    """Every listing with its area's id and its ``route``; one without an id has no key."""
    known = sized(areas.select("neighbourhood", "neighbourhood_id"), at_most=areas)
    joined = lookup_join(listings, known, "neighbourhood", "left", **options)
    return _routed(joined, F.col("id").isNull(), "neighbourhood_id")


def _routed(joined: DataFrame, no_key: Column, found: str) -> DataFrame:
    route = F.when(no_key, NULL_KEY).when(F.col(found).isNull(), UNMATCHED).otherwise(USED)
    return joined.withColumn("route", route)


def store_routes(routed: DataFrame) -> DataFrame:
    """Written once, a folder for each route."""
    spark = routed.sparkSession
    path = new_path(spark, "routed")
    routed.write.partitionBy("route").parquet(path)
    return spark.read.schema(routed.schema).parquet(path)


def rejected(routed: DataFrame, route: str) -> DataFrame:
    """The records of a route as they came."""
    return routed.where(F.col("route") == route).drop("route", "neighbourhood_id")


def unmatched_listings(listings: DataFrame, areas: DataFrame, **options) -> DataFrame:
    """Listings whose area is null or unknown."""
    known = sized(areas.select("neighbourhood"), at_most=areas)
    return lookup_join(listings, known, "neighbourhood", "left_anti", **options)


def unmatched_reviews(listing_area: DataFrame, reviews: DataFrame, **options) -> DataFrame:
    """Reviews whose listing is null or not among the joined listings."""
    known = sized(listing_area.select(F.col("id").alias("listing_id")), at_most=listing_area)
    return lookup_join(reviews, known, "listing_id", "left_anti", **options)


def area_of_reviews(listing_area: DataFrame, reviews: DataFrame, **options) -> DataFrame:
    """(reviewer_id, neighbourhood_id) per review: all that ratings need."""
    listings = listing_area.select(F.col("id").alias("listing_id"), "neighbourhood_id")
    listings = sized(listings, at_most=listing_area)
    visits = reviews.where(F.col("reviewer_id").isNotNull()).select("listing_id", "reviewer_id")
    return lookup_join(visits, listings, "listing_id", **options).select(
        "reviewer_id", "neighbourhood_id"
    )
