"""Lookup joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamrank.workspace import payload_bytes, write_table

# A side is broadcast only after its payload was measured to be at most this.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more rows than this is spread over several tasks.
ROWS_PER_TASK = 2_000_000
# Rows of a key at the limit that finding hot keys should look at.
ROWS_TO_TELL = 10_000

SALT = "_salt"
FAN_OUT = "_fan_out"


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Measure ``df`` against the limit; a limit of 0 says no without a look."""
    limit = BROADCAST_BYTES if limit is None else limit
    return limit > 0 and payload_bytes(df) <= limit


@dataclass(frozen=True)
class HotKeys:
    """Frequent values of one column and the number of tasks each deserves."""

    key: str
    table: DataFrame | None
    small: bool = True

    def _sent(self, table: DataFrame) -> DataFrame:
        """Broadcast if it was measured to be small; there is one row for each ROWS_PER_TASK rows at most."""
        return F.broadcast(table) if self.small else table

    def salt(self, fact: DataFrame) -> DataFrame:
        """Add a salt that spreads the rows of every hot key, nulls included.

        It depends on the row's values and its partition number, so a retried
        task gives a row the same salt, and equal copies of a row still spread.
        """
        if self.table is None:
            return fact.withColumn(SALT, F.lit(0).cast("bigint"))
        hot = self.table.withColumnRenamed(self.key, "_hot_key")
        spread = F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in fact.columns])
        salt = F.when(F.col(FAN_OUT).isNull(), 0).otherwise(F.pmod(spread, F.col(FAN_OUT)))
        return (
            fact.join(self._sent(hot), F.col(self.key).eqNullSafe(F.col("_hot_key")), "left")
            .withColumn(SALT, salt.cast("bigint"))
            .drop("_hot_key", FAN_OUT)
        )

    def fan_out(self, dim: DataFrame) -> DataFrame:
        """Repeat the rows of hot keys once per salt; other rows stay single."""
        if self.table is None:
            return dim.withColumn(SALT, F.lit(0).cast("bigint"))
        last = F.coalesce(F.col(FAN_OUT), F.lit(1)) - 1
        return (
            dim.join(self._sent(self.table), self.key, "left")
            .withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
            .drop(FAN_OUT)
        )


def hot_keys(fact: DataFrame, key: str, rows_per_task: int | None = None) -> HotKeys:
    """Find the keys whose rows exceed one task's share.

    Counting every key exactly would shuffle about as much as the join itself,
    and which keys are spread changes only the balance, never the result. So
    frequencies are estimated: a key at the limit shows about ROWS_TO_TELL
    times in the rows looked at, which puts the estimate within a few percent.
    """
    share = ROWS_PER_TASK if rows_per_task is None else rows_per_task
    keys = fact.select(key)
    fraction = min(1.0, ROWS_TO_TELL / share)
    if fraction < 1.0:
        keys = keys.sample(fraction, seed=0)
    rows = F.count("*") / F.lit(fraction)
    frequent = (
        keys.groupBy(key)
        .agg(rows.alias("rows"))
        .where(F.col("rows") > share)
        .select(key, F.ceil(F.col("rows") / share).cast("bigint").alias(FAN_OUT))
    )
    table = write_table(frequent, "hot-keys")
    size = payload_bytes(table)
    return HotKeys(key, table if size else None, size <= BROADCAST_BYTES)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    broadcast_bytes: int | None = None,
    rows_per_task: int | None = None,
    hot: HotKeys | None = None,
    frequencies: DataFrame | None = None,
) -> DataFrame:
    """Join a large table to a lookup table on a column both call ``key``.

    A lookup table of measured small size is broadcast, and ``fact`` isn't
    shuffled at all. A larger one takes a shuffled join in which hot keys are
    salted on one side and repeated on the other, so no task gets a whole hot
    key. ``how`` is inner, left, left_semi or left_anti.

    Hot keys are looked for in ``fact`` unless they are given as ``hot``, or
    ``frequencies`` names a cheaper table in which keys are about as frequent.
    """
    if fits_broadcast(dim, broadcast_bytes):
        return fact.join(F.broadcast(dim), key, how)
    if how in ("inner", "left_semi"):
        # Said here, because no filter is pushed below a salt.
        fact = fact.where(F.col(key).isNotNull())
    if hot is None:
        hot = hot_keys(fact if frequencies is None else frequencies, key, rows_per_task)
    if hot.table is None:
        return fact.join(dim, key, how)
    return hot.salt(fact).join(hot.fan_out(dim), [key, SALT], how).drop(SALT)
