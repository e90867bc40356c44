"""The given star-schema tables in the form of listings, areas and reviews.

A supplier stands for a listing, its nation for the area, and an order line for
a customer's visit to the supplier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from roamrank.operators.dims import area_dim
from roamrank.operators.joins import fits_broadcast, lookup_join
from roamrank.operators.ratings import build_ratings, to_trainer
from roamrank.operators.visits import join_listing_area, join_reviews
from roamrank.workspace import write_table


_schemas: dict[str, StructType] = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up in its files once, which takes a job."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("host_name"),
        F.col("s_nationkey").alias("n_nationkey"),
    )
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return lookup_join(suppliers, nations, "n_nationkey").select(
        "id",
        F.col("n_nationkey").cast("bigint").alias("host_id"),
        "host_name",
        F.col("n_name").alias("neighbourhood"),
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = read(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    regions = read(spark, sf_dir, "region")
    return lookup_join(nations, regions, "r_regionkey").select(
        F.col("r_name").alias("neighbourhood_group"), F.col("n_name").alias("neighbourhood")
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order's date and customer's name."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus"
    )
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderdate").cast("date").alias("date"),
    )
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # Orders get their names first: they are fewer than lines. With them they are
    # larger than without, so no look is needed where they were too large before.
    if not fits_broadcast(orders):
        return lookup_join(lines, lookup_join(orders, customers, "c_custkey"), "l_orderkey", broadcast_bytes=0)
    return lookup_join(lines, write_table(lookup_join(orders, customers, "c_custkey"), "orders"), "l_orderkey")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(spark, sf_dir).select(
        F.col("l_suppkey").alias("listing_id"),
        "date",
        F.col("c_custkey").alias("reviewer_id"),
        F.col("c_name").alias("reviewer_name"),
    )


def listing_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each listing is reviewed, without the joins behind ``reviews``."""
    return read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("listing_id"))


def listing_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = write_table(area_dim(areas(spark, sf_dir)), "areas")
    return write_table(join_listing_area(listings(spark, sf_dir), dim), "listing-area")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_ratings(
        listing_area(spark, sf_dir),
        reviews(spark, sf_dir),
        frequencies=listing_frequencies(spark, sf_dir),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_reviews(
        listing_area(spark, sf_dir),
        reviews(spark, sf_dir),
        frequencies=listing_frequencies(spark, sf_dir),
    )


def trainer_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored (user, item, rating), as training and evaluation read them."""
    return to_trainer(write_table(ratings(spark, sf_dir), "ratings")).ratings


def date_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
