"""Where results go: Parquet, a metrics table, a database over JDBC."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roamrank.workspace import file_system


def write_result(recommendations: DataFrame, path: str) -> DataFrame:
    """Replace the stored result and return a DataFrame that reads it.

    All of it is written beside the old one first, so a run that fails leaves that. Then
    the two folders are renamed; a run that ends between the renames leaves the old one
    under another name, from which the next ``read_result`` or ``write_result`` takes it.
    """
    spark = recommendations.sparkSession
    _recover(spark, path)
    staged = f"{_beside(path, 'new')}-{uuid.uuid4().hex}"
    try:
        recommendations.write.parquet(staged)
        _swap(spark, staged, path)
    except Exception:
        place, system = file_system(spark, staged)
        system.delete(place, True)
        raise
    return spark.read.schema(recommendations.schema).parquet(path)


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """The stored result, the old one if a run ended while it was being replaced."""
    _recover(spark, path)
    return spark.read.parquet(path)


def _beside(path: str, what: str) -> str:
    """A hidden folder next to ``path``."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.{what}" if parent else f".{name}.{what}"


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    place, system = file_system(spark, path)
    old, _ = file_system(spark, _beside(path, "old"))
    new, _ = file_system(spark, staged)
    if system.exists(place):
        system.delete(old, True)
        if not system.rename(place, old):
            raise OSError(f"can't move {path}")
    if not system.rename(new, place):
        _recover(spark, path)
        raise OSError(f"can't move {staged} to {path}")
    system.delete(old, True)


def _recover(spark: SparkSession, path: str) -> None:
    place, system = file_system(spark, path)
    old, _ = file_system(spark, _beside(path, "old"))
    if not system.exists(place) and system.exists(old):
        system.rename(old, place)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Add a run's rows to the metrics table, in place of those that it wrote before.

    Rows without a ``run_id`` have nothing to be told apart by and are always added.
    """
    if "run_id" not in metrics.columns:
        metrics = metrics.withColumn("run_id", F.lit(None).cast("string"))
    # Rows of a run have a folder of their own, and only folders with new rows are replaced.
    named = metrics.where(F.col("run_id").isNotNull()).coalesce(1).write.partitionBy("run_id")
    named.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    loose = metrics.where(F.col("run_id").isNull()).coalesce(1)
    if not loose.isEmpty():
        loose.write.partitionBy("run_id").mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics table; run ids are text whatever they look like."""
    found = spark.read.parquet(path).schema
    kinds = [T.StructField(f.name, T.StringType() if f.name == "run_id" else f.dataType) for f in found.fields]
    return spark.read.schema(T.StructType(kinds)).parquet(path)


def preview(stored: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows by reviewer. Pass the stored result, not the job behind it."""
    return stored.orderBy("reviewerId").limit(rows)


def jdbc_rows(recommendations: DataFrame, separator: str = "|") -> DataFrame:
    """Databases have no portable array type: one text column holds the names."""
    names = F.array_join("neighbourhoodNames", separator)
    return recommendations.withColumn("neighbourhoodNames", names)


def write_jdbc(
    recommendations: DataFrame,
    url: str,
    table: str,
    connections: int = 16,
    batch: int = 10_000,
    **properties: str,
) -> None:
    """Replace ``table``'s rows, over at most ``connections`` at a time.

    A retried task may insert rows again: write to a staging table and swap
    it, or give the table a key on (reviewerId, date).
    """
    writer = jdbc_rows(recommendations).write.format("jdbc").mode("overwrite")
    writer = writer.option("url", url).option("dbtable", table).option("truncate", True)
    writer = writer.option("numPartitions", connections).option("batchsize", batch)
    writer.options(**properties).save()
