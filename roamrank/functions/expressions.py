"""Column expressions; all of them stay inside Spark's generated code."""

from __future__ import annotations

import datetime
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# A prime below 2^20, so that the products below stay far inside a bigint.
HASH_PRIME = 1_000_003
USER_FACTOR = 7_919
ITEM_FACTOR = 104_729
SEED_FACTOR = 15_485_863


def run_date(as_of: datetime.date | str | None = None) -> Column:
    """The run's date as ``yyyy-MM-dd`` text: one value for the whole query."""
    if as_of is not None:
        return F.lit(str(as_of))
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def dot(left: Column, right: Column, rank: int) -> Column:
    """Inner product of two arrays of ``rank`` numbers.

    Written out term by term: higher-order functions over arrays would leave
    whole-stage code generation.
    """
    terms = [left[i].cast("double") * right[i].cast("double") for i in range(rank)]
    return reduce(add, terms)


def split_bucket(user: Column, item: Column, seed: int) -> Column:
    """A number from 0 to 99 that depends on the pair and the seed alone."""
    pair = (
        F.pmod(user.cast("bigint"), F.lit(HASH_PRIME)) * USER_FACTOR
        + F.pmod(item.cast("bigint"), F.lit(HASH_PRIME)) * ITEM_FACTOR
    ) % HASH_PRIME
    factor, shift = split_mix(seed)
    mixed = (pair * factor + shift) % HASH_PRIME
    return (mixed * (mixed + ITEM_FACTOR)) % HASH_PRIME % 100


def split_mix(seed: int) -> tuple[int, int]:
    """The seed's factor and shift: a sum alone would only move all buckets alike."""
    factor = 1 + (seed % HASH_PRIME + 1) * SEED_FACTOR % (HASH_PRIME - 1)
    return factor, seed * USER_FACTOR % HASH_PRIME


def start_factors(user: Column, rank: int, seed: int) -> Column:
    """A positive unit vector per id, reproducible on any partitioning."""
    start = F.pmod(user.cast("bigint"), F.lit(HASH_PRIME))
    shift = seed % HASH_PRIME * SEED_FACTOR % HASH_PRIME
    parts = [
        ((start * (USER_FACTOR * (2 * d + 1)) + shift) % HASH_PRIME + 1).cast("double") / HASH_PRIME
        for d in range(rank)
    ]
    norm = F.sqrt(reduce(add, [p * p for p in parts]))
    return F.array(*[p / norm for p in parts])
