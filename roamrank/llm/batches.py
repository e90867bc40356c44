"""Memory of Python workers: what they are handed at a time, and what they keep.

By default a batch is counted in rows alone, so long documents make large ones. The
operators lower the session's limit in bytes, and leave a lower one as it is.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

BYTES = 4 << 20
LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession | None = None) -> None:
    spark = spark or SparkSession.getActiveSession()
    if spark is not None:
        now = spark.conf.get(LIMIT, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= BYTES:
            spark.conf.set(LIMIT, str(BYTES))


def give_back() -> None:
    """Return memory that a finished task has freed to the system.

    Workers are used again by the next stages, and the allocators keep what was freed,
    so an executor's memory would otherwise be the sum of what its stages once needed.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(task: Callable) -> Callable:
    """``task`` over a partition's batches, giving back its memory at the end."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run
