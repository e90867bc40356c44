"""Schemas of the input files. Column names and their order."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Ids are long, so that large ones aren't lost; comments are text; dates are dates.
REVIEWS = StructType(
    [
        StructField("listing_id", LongType()),
        StructField("id", LongType()),
        StructField("date", DateType()),
        StructField("reviewer_id", LongType()),
        StructField("reviewer_name", StringType()),
        StructField("comments", StringType()),
    ]
)

LISTINGS = StructType(
    [
        StructField("id", LongType()),
        StructField("name", StringType()),
        StructField("host_id", LongType()),
        StructField("host_name", StringType()),
        StructField("neighbourhood_group", StringType()),
        StructField("neighbourhood", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("room_type", StringType()),
        StructField("price", IntegerType()),
        StructField("minimum_nights", IntegerType()),
        StructField("number_of_reviews", IntegerType()),
        StructField("last_review", DateType()),
        StructField("reviews_per_month", DoubleType()),
        StructField("calculated_host_listings_count", IntegerType()),
        StructField("availability_365", IntegerType()),
    ]
)

AREAS = StructType(
    [
        StructField("neighbourhood_group", StringType()),
        StructField("neighbourhood", StringType()),
    ]
)
