"""Shared storage for intermediate tables.

A written table cuts lineage and survives the loss of any executor, which a
cached or locally checkpointed DataFrame doesn't.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of rows in memory that are worth a task of their own.
TASK_BYTES = 4 << 20

_scratch: ContextVar[list[str] | None] = ContextVar("_scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, the same on every node.

    Without the setting it is a folder of the warehouse in a local session, and an
    error elsewhere, where a warehouse may be a folder of one machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return folder


def file_system(spark: SparkSession, path: str):
    """A path for Hadoop, and the file system that it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; gone when the session ends."""
    path = f"{shared_dir(spark).rstrip('/')}/roamrank/{name}-{uuid.uuid4().hex}"
    created = _scratch.get()
    if created is not None:
        created.append(path)
    place, system = file_system(spark, path)
    system.deleteOnExit(place)
    return path


def _nested(kind: T.DataType) -> bool:
    numbers = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType)
    return not (numbers or isinstance(kind, T.AtomicType))


def _width(field: T.StructField) -> int | Column:
    """Bytes of one value: a number for fixed-width types, else an expression."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(field.dataType, T.ArrayType) and not _nested(field.dataType):
        return F.coalesce(F.size(column), F.lit(0)) * 8 + 8
    if not _nested(field.dataType):
        return 8
    # Nested values: their text is about as long as they are in memory, or longer.
    return F.coalesce(F.length(F.to_json(F.struct(column))), F.lit(0)) * 2 + 32


def row_bytes(df: DataFrame) -> tuple[int, list[Column]]:
    """Bytes of a row in memory: what is the same for all, and what depends on the row."""
    widths = [_width(field) for field in df.schema.fields]
    return 16 + sum(w for w in widths if isinstance(w, int)), [w for w in widths if not isinstance(w, int)]


def payload_bytes(df: DataFrame) -> int:
    """Size of the rows of ``df`` in memory.

    Known if ``write_table`` wrote it; else measured in one distributed pass, which is
    a plain count, answered from Parquet's footers, without text or array columns.
    """
    known = getattr(df, "_payload_bytes", None)
    if known is not None:
        return known
    fixed, varying = row_bytes(df)
    if not varying:
        return df.count() * fixed
    total = F.sum(sum(varying, F.lit(fixed).cast("bigint")))
    return df.agg(total.alias("n")).first()["n"] or 0


def sized(df: DataFrame, at_most: DataFrame | None = None) -> DataFrame:
    """``df``, measured once for all that ask; ``at_most`` is a table it has no more of than."""
    measured = df if at_most is None else at_most
    measured._payload_bytes = df._payload_bytes = payload_bytes(measured)
    return df


def gathered(df: DataFrame, most: int) -> DataFrame:
    """``df`` in no more partitions than ``most`` bytes, about those of its rows, and the cores ask for.

    A shuffle has as many tasks as the session says, and each would write a file,
    wherever adaptive execution doesn't merge them. Partitions are merged, never parted.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-most // TASK_BYTES)))


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the written files.

    Its size in memory is summed up as it is written, if its columns' are simple sums.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if any(_nested(f.dataType) for f in df.schema.fields):
        df.write.parquet(path)
        stored = spark.read.schema(df.schema).parquet(path)
        stored._path = path
        return stored
    fixed, varying = row_bytes(df)
    size = Observation()
    total = F.sum(sum(varying, F.lit(fixed).cast("bigint")))
    df.observe(size, total.alias("bytes")).write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._payload_bytes, stored._path = size.get["bytes"] or 0, path
    return stored


def drop_table(stored: DataFrame) -> None:
    """Delete a table of ``write_table`` that nothing reads any more, before the session ends."""
    place, system = file_system(stored.sparkSession, stored._path)
    system.delete(place, True)
    system.cancelDeleteOnExit(place)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the paths handed out inside the block when it ends.

    DataFrames that read them can't be used afterwards.
    """
    created: list[str] = []
    token = _scratch.set(created)
    try:
        yield
    finally:
        _scratch.reset(token)
        for name in created:
            place, system = file_system(spark, name)
            system.delete(place, True)
            system.cancelDeleteOnExit(place)
