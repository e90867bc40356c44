"""CSV ingest that keeps malformed records instead of losing them.

Which fields Spark parses in a CSV record depends on the columns a query asks
for, so filtering a raw scan on its corrupt-record column gives different rows
for different projections. Every file is therefore landed as Parquet by a query
that asks for all columns, and split into good and quarantined rows from there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roamrank.sources import ranges, schemas
from roamrank.workspace import new_path, write_table

CORRUPT = "_corrupt_record"
EMPTY_FIELDS = "_empty_fields"
# What the job needs of the wider files.
REVIEW_COLUMNS = ["listing_id", "date", "reviewer_id", "reviewer_name"]
LISTING_COLUMNS = ["id", "host_id", "host_name", "neighbourhood"]
# The columns without which a record can't be used. A listing without an area is
# among the listings that no area matches.
REVIEW_KEYS = ["listing_id", "reviewer_id"]
LISTING_KEYS = ["id"]
AREA_KEYS = ["neighbourhood"]


@dataclass(frozen=True)
class Landed:
    good: DataFrame
    quarantined: DataFrame


def land_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    landed: str | None = None,
    multi_line: bool = True,
    keep: list[str] | None = None,
) -> Landed:
    """Land CSV files with a header under ``schema`` and split off bad records.

    ``keep`` names the columns to store; all are parsed and checked either way,
    and a bad record's text is stored whole. Quoted fields may hold line breaks;
    such files are read in byte ranges all the same (``sources.ranges``), in two
    passes. ``multi_line=False`` saves one for files without such breaks.
    """
    full = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    target = landed or new_path(spark, "landed")
    # The number of empty fields depends on every column, so each gets parsed.
    empty = reduce(add, [F.col(name).isNull().cast("int") for name in schema.names])
    columns = [*(keep or schema.names), CORRUPT, empty.alias(EMPTY_FIELDS)]
    if multi_line:
        stored = _land_ranges(spark, path, schema.names, full, columns, target)
    else:
        raw = spark.read.schema(full).option("header", True).option("escape", '"')
        # A header that names other columns, or in another order, is an error.
        raw = raw.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False)
        table = raw.csv(path).select(*columns)
        table.write.mode("overwrite").parquet(target)
        stored = spark.read.schema(table.schema).parquet(target)
    stored = stored.drop(EMPTY_FIELDS)
    return Landed(
        good=stored.where(F.col(CORRUPT).isNull()).drop(CORRUPT),
        quarantined=stored.where(F.col(CORRUPT).isNotNull()),
    )


def _land_ranges(
    spark: SparkSession, path: str | list[str], names: list[str], full: StructType, columns: list, target: str
) -> DataFrame:
    """Land the records of byte ranges, then those put together from the pieces in several."""
    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in full.fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"', "multiLine": "true"}

    def parsed(text: Column) -> Column:
        # A generator, so that the optimizer doesn't parse a record anew for each column.
        return F.inline(F.array(F.from_csv(text, kinds, options)))

    found = write_table(ranges.states(ranges.lines(spark, path)), "csv-ranges")
    pieces = ranges.pieces(spark, path, names, found)
    whole, own = F.col("piece") == ranges.WHOLE, ["file", "start", "piece", "text"]
    rest = [F.col("file"), F.col("start"), F.col("piece"), F.when(~whole, F.col("text")).alias("text")]
    kept = [c.alias(f"_{name}") for c, name in zip(rest, own)]
    table = pieces.select(*kept, parsed(F.when(whole, F.col("text")))).select(*columns, *[f"_{c}" for c in own])
    table.write.mode("overwrite").parquet(target)
    landed = spark.read.schema(table.schema).parquet(target)
    parts = landed.where(F.col("_piece") != ranges.WHOLE).select(*[F.col(f"_{c}").alias(c) for c in own])
    ranges.check_ranges(found, parts)
    joined = ranges.joined(parts.where(F.col("piece") != ranges.RANGE))
    joined = joined.select(parsed(F.col("text"))).select(*columns)
    marked = joined.withColumns({"_file": F.lit(None).cast("string"), "_start": F.lit(None).cast("bigint")})
    marked = marked.withColumns({"_piece": F.lit(ranges.WHOLE), "_text": F.lit(None).cast("string")})
    marked.write.mode("append").parquet(target)
    every = spark.read.schema(table.schema).parquet(target)
    return every.where(F.col("_piece") == ranges.WHOLE).drop(*[f"_{c}" for c in own])


def split_null_keys(rows: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Rows that have all of the key columns, and those that lack one and can't be used."""
    lacking = reduce(or_, [F.col(key).isNull() for key in keys])
    return rows.where(~lacking), rows.where(lacking)


def scan_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(*REVIEW_COLUMNS)


def scan_listings(listings: DataFrame) -> DataFrame:
    return listings.select(*LISTING_COLUMNS)


def load_reviews(spark: SparkSession, path: str | list[str], **options) -> Landed:
    """Reviews with their id and comments; ``scan_reviews`` keeps what visits need."""
    return land_csv(spark, path, schemas.REVIEWS, **options)


def load_listings(spark: SparkSession, path: str | list[str], **options) -> Landed:
    return land_csv(spark, path, schemas.LISTINGS, **options)


def load_areas(spark: SparkSession, path: str | list[str], **options) -> Landed:
    """Areas with their group; ``area_dim`` drops the group and adds the id."""
    return land_csv(spark, path, schemas.AREAS, **options)
