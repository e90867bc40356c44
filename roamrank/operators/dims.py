"""Dimensions: areas with dense ids, reviewers with their latest name."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roamrank.workspace import write_table

# Up to this many keys one task numbers them; more are numbered in parallel.
SINGLE_TASK_KEYS = 100_000
INT_MAX = 2**31 - 1
INT_MIN = -(2**31)


def dense_id(keys: DataFrame, key: str, name: str, single_task_keys: int | None = None) -> DataFrame:
    """Number the distinct non-null values of ``key`` from 0 in their order."""
    values = keys.select(key).where(F.col(key).isNotNull()).distinct()
    return _numbered(values, values.count(), key, name, single_task_keys)


def _numbered(
    values: DataFrame, count: int, key: str, name: str, single_task_keys: int | None = None
) -> DataFrame:
    if count > (SINGLE_TASK_KEYS if single_task_keys is None else single_task_keys):
        return _dense_id_by_range(values, key, name)
    order = Window.orderBy(key)
    return values.select(key, (F.row_number().over(order) - 1).cast("bigint").alias(name))


def _dense_id_by_range(values: DataFrame, key: str, name: str) -> DataFrame:
    # Range bounds are sampled, so the ranges are written down before use. The
    # generated id holds the range's number above bit 33 and the row's below.
    ranges = write_table(
        values.repartitionByRange(key)
        .sortWithinPartitions(key)
        .withColumn("_place", F.monotonically_increasing_id())
        .select(
            key,
            F.shiftright("_place", 33).alias("_range"),
            F.col("_place").bitwiseAND((1 << 33) - 1).alias("_row"),
        ),
        "dense-id",
    )
    # One row per range: as many as there were shuffle partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("_range")
        .agg(F.count("*").alias("n"))
        .select("_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    )
    return ranges.join(F.broadcast(offsets), "_range").select(
        key, (F.col("_offset") + F.col("_row")).alias(name)
    )


def area_dim(areas: DataFrame) -> DataFrame:
    """Area names with 0-based ids in the order of the names.

    The name alone is the join key, so a name that stands in two groups would
    double every count below it; that is an error here.
    """
    group = F.coalesce("neighbourhood_group", F.lit("")) if "neighbourhood_group" in areas.columns else F.lit("")
    names = (
        areas.where(F.col("neighbourhood").isNotNull())
        .withColumn("group", group)
        .groupBy("neighbourhood")
        .agg(F.min("group").alias("low"), F.max("group").alias("high"))
    )
    doubled = F.when(F.col("low") != F.col("high"), F.col("neighbourhood"))
    found = names.agg(F.count("*").alias("areas"), F.min(doubled).alias("doubled")).first()
    if found["doubled"] is not None:
        raise ValueError(f"area in more than one group: {found['doubled']!r}")
    return _numbered(names.select("neighbourhood"), found["areas"], "neighbourhood", "neighbourhood_id")


def reviewer_dim(reviews: DataFrame) -> DataFrame:
    """One name per reviewer: the latest by date, then by name.

    Grouping by (id, name) first lets the pass over all reviews use hash
    aggregation with map-side combining; ordering by a struct would sort them.
    """
    seen = (
        reviews.where(F.col("reviewer_id").isNotNull() & F.col("reviewer_name").isNotNull())
        .groupBy("reviewer_id", "reviewer_name")
        .agg(F.max("date").alias("date"))
    )
    latest = F.max(F.struct("date", "reviewer_name"))
    return seen.groupBy("reviewer_id").agg(latest.alias("latest")).select(
        "reviewer_id", F.col("latest.reviewer_name").alias("reviewer_name")
    )


def trainer_ids(keys: DataFrame, key: str, name: str) -> DataFrame | None:
    """A dense mapping for ids that don't fit an int; None when all of them fit."""
    ends = keys.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    if ends["low"] is None or (ends["low"] >= INT_MIN and ends["high"] <= INT_MAX):
        return None
    ids = dense_id(keys, key, name)
    top = ids.agg(F.max(name).alias("top")).first()["top"]
    if top > INT_MAX:
        raise ValueError(f"{top + 1} distinct values of {key}: more than an int can number")
    return ids
