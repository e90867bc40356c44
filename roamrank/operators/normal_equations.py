"""ALS by summed normal equations; no task holds all ratings of an item or a person.

Ratings are stored once, as one list for each person, very long ones in parts. While
the items' factors fit into a task, a round is one pass over the lists: a person's
factors are worked out beside the list, the list's outer products with them are summed
where it lies, and what is shuffled is one row of sums for each item and task. Nothing
but items' factors is written. Beyond that size lists are stored by person and by item,
in buckets, and meet the other side's factors in the same buckets. Two models, of which
one learns from part of the ratings, can be trained in the same passes. Sums travel as
one array, so the plan is the same at any rank. The same sums check a fitted model.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamrank.functions.expressions import start_factors
from roamrank.operators import joins
from roamrank.operators.joins import SALT, HotKeys, hot_keys, lookup_join
from roamrank.workspace import new_path, sized, write_table

# Ratings in one list, about; a person with more has several.
RATINGS_PER_LIST = 500_000
# Ratings in one bucket or file of lists, about, and so few that another task pays.
RATINGS_PER_BUCKET = 2_000_000
RATINGS_WORTH_A_TASK = 20_000
# Numbers that a task works on, and that its sums take up before they are passed on.
NUMBERS_AT_ONCE = 2_000_000
NUMBERS_KEPT = 4_000_000


def _core(rank: int, models: int = 1) -> tuple[Callable, Callable, Callable]:
    """What tasks do with sums: n, the upper triangle of sum(q q'), and sum(r q), of each model.

    A second model learns from the ratings that are kept alone; its vectors stand beside
    the first's, and are not a number where it knows none. Nested functions travel to
    the executors by value, so those need no copy of this package.
    """
    rows, columns = np.triu_indices(rank)
    width = 1 + len(rows) + rank
    step, most = max(1, NUMBERS_AT_ONCE // (models * width)), max(1, NUMBERS_KEPT // (models * width))

    def merged(ids: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum the rows of equal ids."""
        if len(ids) > 1 and (ids[1:] < ids[:-1]).any():
            order = np.argsort(ids, kind="stable")
            ids, sums = ids[order], sums[order]
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, dtype=np.int64)
        return ids[starts], np.add.reduceat(sums, starts) if len(ids) else sums

    def terms(ratings: np.ndarray, vectors: np.ndarray, kept: np.ndarray | None) -> np.ndarray:
        parts = []
        for m in range(models):
            v, r, one = vectors[:, m * rank : (m + 1) * rank], ratings, np.ones(len(ratings))
            if models > 1:
                use = ~np.isnan(v[:, 0]) if m == 0 or kept is None else kept & ~np.isnan(v[:, 0])
                v, r, one = np.where(use[:, None], v, 0.0), np.where(use, r, 0.0), use.astype(np.float64)
            parts += [one[:, None], v[:, rows] * v[:, columns], r[:, None] * v]
        return np.hstack(parts)

    def summed(parts: Iterator[tuple]) -> Iterator[tuple]:
        """Sums by id of (ids, ratings, vectors, kept), combined as far as memory allows."""
        done, count = [], 0
        for ids, ratings, vectors, kept in parts:
            for low in range(0, len(ids), step):
                some = slice(low, low + step)
                found = terms(ratings[some], vectors[some], None if kept is None else kept[some])
                done.append(merged(ids[some], found))
                count += len(done[-1][0])
                if count > most:
                    done = [merged(*map(np.concatenate, zip(*done)))]
                    count = len(done[0][0])
                    if count > most // 2:
                        yield done.pop()
                        count = 0
        if done:
            yield merged(*map(np.concatenate, zip(*done)))

    def solved(sums: np.ndarray, reg: float) -> np.ndarray:
        """Factors from ``(gram + reg * n * I) x = right``, side by side; none where n is zero."""
        out = np.full((len(sums), models * rank), np.nan)
        for m in range(models):
            own = sums[:, m * width : (m + 1) * width]
            some = np.flatnonzero(own[:, 0])
            matrix = np.zeros((len(some), rank, rank))
            matrix[:, rows, columns] = own[some, 1 : 1 + len(rows)]
            matrix[:, columns, rows] = matrix[:, rows, columns]
            matrix += (reg * own[some, 0])[:, None, None] * np.eye(rank)
            out[some, m * rank : (m + 1) * rank] = np.linalg.solve(matrix, own[some, 1 + len(rows) :, None])[:, :, 0]
        return out

    return merged, summed, solved


def _shippable() -> tuple[Callable, Callable]:
    """Matrix to column of lists and back, as functions that travel by value."""

    def lists_of(matrix):
        offsets = np.arange(0, matrix.size + 1, matrix.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))

    def matrix(column):
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)

    return lists_of, matrix


def _combined(partial: DataFrame, rank: int, finish: Callable | None, schema: str) -> DataFrame:
    """Sum partial rows (id, sums) by id, in the order of the ids, and finish each sum.

    A row of sums comes from a task, so they are as many as ids and tasks, not ratings.
    """
    merged, _, _ = _core(rank)
    lists_of, matrix = _shippable()

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, sums = batch.column(0).to_numpy(), matrix(batch.column(1))
            if rest is not None:
                ids, sums = np.concatenate([rest[0], ids]), np.concatenate([rest[1], sums])
            ids, sums = merged(ids, sums)
            rest = ids[-1:], sums[-1:]  # its sum may go on in the next batch
            yield made(ids[:-1], sums[:-1])
        if rest is not None:
            yield made(*rest)

    def made(ids, sums):
        values = sums if finish is None or not len(sums) else finish(sums)
        return pa.RecordBatch.from_arrays([pa.array(ids), lists_of(values)], ["id", "values"])

    ordered = partial.repartition("id").sortWithinPartitions("id")
    return ordered.mapInArrow(combine, schema)


def normal_equations(
    ratings: DataFrame, factors: DataFrame, by: str, rank: int, hot: HotKeys | None = None
) -> DataFrame:
    """For each ``by`` id: n, the upper triangle of sum(q q') and sum(r q).

    ``factors`` (id, features) belongs to the other side of the ratings.
    """
    other = "item" if by == "user" else "user"
    side = factors.select(F.col("id").alias(other), F.col("features").cast("array<double>").alias("features"))
    joined = lookup_join(ratings, side, other, hot=hot)
    sums = _combined(_row_sums(joined, by, rank), rank, None, "id int, values array<double>")
    pairs = rank * (rank + 1) // 2
    return sums.select(
        "id",
        F.col("values")[0].cast("bigint").alias("n"),
        F.slice("values", 2, pairs).alias("gram"),
        F.slice("values", 2 + pairs, rank).alias("right"),
    )


def _row_sums(rows: DataFrame, by: str, rank: int, models: int = 1) -> DataFrame:
    """Partial sums (id, sums) of rows that hold a rating and the other side's features."""
    _, summed, _ = _core(rank, models)
    lists_of, matrix = _shippable()

    def columns(batch: pa.RecordBatch) -> tuple:
        ids, ratings, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), matrix(batch.column(2))
        return ids, ratings, vectors, batch.column(3).to_numpy(zero_copy_only=False) if models > 1 else None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sums in summed(columns(b) for b in batches if b.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(ids), lists_of(sums)], ["id", "sums"])

    kept = ["kept"] if models > 1 else []
    return rows.select(by, "rating", "features", *kept).mapInArrow(add, "id int, sums array<double>")


@dataclass(frozen=True)
class Trainer:
    """What the steps of a fit share. ``models`` is 2 if a second one learns from kept ratings."""

    rank: int
    reg: float
    seed: int
    models: int

    @property
    def listed(self) -> list[str]:
        return ["ratings", "kept"] if self.models > 1 else ["ratings"]

    def start(self) -> Column:
        vector = start_factors(F.col("user"), self.rank, self.seed)
        return F.concat(*[vector] * self.models)

    def solver(self) -> Callable:
        _, _, solved = _core(self.rank, self.models)
        reg = self.reg
        return lambda sums: solved(sums, reg)

    def factors(self, partial: DataFrame) -> DataFrame:
        """(id, features) from partial sums."""
        return _combined(partial, self.rank, self.solver(), "id int, features array<double>")

    def model(self, factors: DataFrame, number: int) -> DataFrame:
        """One model's (id, features) of those that stand side by side."""
        if self.models == 1:
            return factors
        own = factors.select("id", F.slice("features", number * self.rank + 1, self.rank).alias("features"))
        return sized(own.where(~F.isnan(F.col("features")[0])), at_most=factors)


def rating_lists(ratings: DataFrame, trainer: Trainer) -> tuple[DataFrame, bool]:
    """(user, split, items, ratings[, kept]), stored once, and whether any list is in parts."""
    rows, cores = ratings.count(), ratings.sparkSession.sparkContext.defaultParallelism
    hot = _long(ratings, "user", rows)
    # As many files as there is work for: every sweep reads them, and they are small for it.
    files = max(1, math.ceil(rows / RATINGS_PER_BUCKET), min(2 * cores, math.ceil(rows / RATINGS_WORTH_A_TASK)))
    salted = hot.salt(ratings).repartition(files, "user", SALT)
    stored = _lists(salted, "user", "item", trainer)
    split = F.lit(False)
    if hot.table is not None:
        stored = stored.join(F.broadcast(hot.table.select("user", F.lit(True).alias("split"))), "user", "left")
        split = F.coalesce("split", F.lit(False))
    stored = stored.select("user", split.alias("split"), "items", *trainer.listed)
    return write_table(stored, "rating-lists"), hot.table is not None


def _long(ratings: DataFrame, key: str, rows: int) -> HotKeys:
    """Ids with more ratings than a list takes; none if there are no more in all."""
    if rows <= RATINGS_PER_LIST:
        return HotKeys(key, None)
    return hot_keys(ratings, key, RATINGS_PER_LIST)


def _lists(salted: DataFrame, by: str, other: str, trainer: Trainer) -> DataFrame:
    """An id's ratings, or a part of them, in one row, in the order of the other side's ids."""
    kept = ["kept"] if trainer.models > 1 else []
    rated = F.sort_array(F.collect_list(F.struct(other, "rating", *kept))).alias("rated")
    lists = salted.groupBy(by, SALT).agg(rated)
    columns = [F.col(f"rated.{other}").alias(f"{other}s"), F.col("rated.rating").alias("ratings")]
    return lists.select(by, SALT, *columns, *(F.col(f"rated.{c}") for c in kept))


def _sweep(lists: DataFrame, trainer: Trainer, items: tuple | None, last: bool = False) -> DataFrame:
    """One pass over lists: partial sums (id, sums) of the items; with ``last`` the users' factors.

    Users' factors are worked out in the tasks, beside the lists, from the ``items`` given
    (ids and their vectors); without these they are in the lists' column ``features``.
    """
    rank, models, solve = trainer.rank, trainer.models, trainer.solver()
    _, summed, _ = _core(rank, models)
    width = models * (1 + rank * (rank + 1) // 2 + rank)
    lists_of, matrix = _shippable()
    told = None if items is None else lists.sparkSession.sparkContext.broadcast(items)
    slices = 100_000

    def read(batch: pa.RecordBatch) -> tuple:
        """Items, ratings, the list that each belongs to, and whether they are kept, one after another."""
        lengths = batch.column("items").value_lengths().to_numpy(zero_copy_only=False)
        flat = [batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("items", "ratings")]
        kept = batch.column("kept").flatten().to_numpy(zero_copy_only=False) if models > 1 else None
        return *flat, np.repeat(np.arange(batch.num_rows), lengths), kept

    def cut(*columns) -> Iterator[tuple]:
        for low in range(0, len(columns[0]), slices):
            yield tuple(None if c is None else c[low : low + slices] for c in columns)

    def vectors(batch: pa.RecordBatch, ids, ratings, owner, kept) -> np.ndarray:
        if told is None:
            return matrix(batch.column("features"))
        known, values = told.value
        place = np.searchsorted(known, ids)
        total = np.zeros((batch.num_rows, width))
        parts = ((o, r, values[at], k) for o, r, at, k in cut(owner, ratings, place, kept))
        for lists_at, sums in summed(parts):
            total[lists_at] += sums
        return solve(total)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            if batch.num_rows:
                ids, ratings, owner, kept = read(batch)
                own = vectors(batch, ids, ratings, owner, kept)
                for i, r, o, k in cut(ids, ratings, owner, kept):
                    yield i, r, own[o], k

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sums in summed(parts(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), lists_of(sums)], ["id", "sums"])

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = vectors(batch, *read(batch))
                yield pa.RecordBatch.from_arrays([batch.column("user"), lists_of(own)], ["id", "features"])

    if last:
        return lists.mapInArrow(end, "id int, features array<double>")
    return lists.mapInArrow(add, "id int, sums array<double>")


def _part_sums(lists: DataFrame, trainer: Trainer, items: tuple) -> DataFrame:
    """Partial sums (id, sums) of users whose lists are in parts."""
    item_ids, values = items
    rows = lists.select("user", F.explode(F.arrays_zip("items", *trainer.listed)).alias("r"))
    rows = rows.select("user", "r.items", F.col("r.ratings").alias("rating"), *[f"r.{c}" for c in trainer.listed[1:]])
    told = lists.sparkSession.sparkContext.broadcast((item_ids, values))
    rank, models = trainer.rank, trainer.models
    _, summed, _ = _core(rank, models)
    lists_of, _ = _shippable()

    def columns(batch: pa.RecordBatch) -> tuple:
        known, vectors = told.value
        at = np.searchsorted(known, batch.column("items").to_numpy())
        kept = batch.column("kept").to_numpy(zero_copy_only=False) if models > 1 else None
        return batch.column("user").to_numpy(), batch.column("rating").to_numpy(), vectors[at], kept

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sums in summed(columns(b) for b in batches if b.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), lists_of(sums)], ["id", "sums"])

    return rows.mapInArrow(add, "id int, sums array<double>")


def _numbers(items: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and their vectors, in order; the caller measured the size."""
    rows = items.toPandas().sort_values("id")
    return rows["id"].to_numpy(), np.stack(rows["features"].to_numpy()).astype(np.float64)


def fit_by_sums(
    ratings: DataFrame, rank: int, iterations: int, reg: float, seed: int, kept: Column | None = None
) -> list[tuple[DataFrame, DataFrame]]:
    """User and item factors after ``iterations`` rounds; items go first.

    With ``kept`` a second pair, learnt from the ratings of which that is true, in the
    same passes. The ratings are stored as lists once and only read from then on: a
    round writes factors.
    """
    trainer = Trainer(rank, reg, seed, 1 if kept is None else 2)
    if kept is not None:
        ratings = ratings.withColumn("kept", kept)
    lists, any_split = rating_lists(ratings, trainer)
    started = lists.withColumn("features", trainer.start())
    items = write_table(trainer.factors(_sweep(started, trainer, None)), "item-factors")
    if not joins.fits_broadcast(items):
        # More items than tasks should hold.
        users, items = _fit_in_buckets(ratings, items, trainer, iterations)
    else:
        users, items = _fit_beside_items(lists, any_split, items, trainer, iterations)
    return [(trainer.model(users, m), trainer.model(items, m)) for m in range(trainer.models)]


def _fit_beside_items(
    lists: DataFrame, any_split: bool, items: DataFrame, trainer: Trainer, iterations: int
) -> tuple[DataFrame, DataFrame]:
    """The rounds after the first items' step, with all items' factors in every task.

    They come to the driver on the way, as many as were measured after the first step.
    """
    whole = lists.where("NOT split") if any_split else lists
    parts = lists.where("split")
    now = _numbers(items)
    for n in range(1, iterations + 1):
        if any_split:
            long = write_table(trainer.factors(_part_sums(parts, trainer, now)), "user-factors")
        if n == iterations:
            users = _sweep(whole, trainer, now, last=True)
            return write_table(users.unionByName(long) if any_split else users, "user-factors"), items
        sums = _sweep(whole, trainer, now)
        if any_split:
            beside = lookup_join(parts, long.withColumnRenamed("id", "user"), "user")
            sums = sums.unionByName(_sweep(beside, trainer, None))
        items = trainer.factors(sums)
        if n + 1 == iterations:
            items = write_table(items, "item-factors")
        now = _numbers(items)


def _fit_in_buckets(
    ratings: DataFrame, items: DataFrame, trainer: Trainer, iterations: int
) -> tuple[DataFrame, DataFrame]:
    """The rounds after the first items' step when items' factors are too many to send around.

    Lists by user and lists by item are stored once, in buckets; each half-step stores
    the other side's factors in the same buckets, so lists meet factors without a
    shuffle of lists. Long lists are in parts, and their factors are there for each.
    """
    many = ratings.count()
    count = max(1, math.ceil(many / RATINGS_PER_BUCKET), ratings.sparkSession.sparkContext.defaultParallelism)
    spark, tables = ratings.sparkSession, []

    def bucketed(df: DataFrame, key: str) -> DataFrame:
        name = f"roamrank_{uuid.uuid4().hex}"
        writer = df.write.format("parquet").bucketBy(count, key, SALT).sortBy(key, SALT)
        writer.option("path", new_path(spark, "buckets")).saveAsTable(name)
        tables.append(name)
        return spark.table(name)

    def side(factors: DataFrame, key: str, hot: HotKeys) -> DataFrame:
        return bucketed(hot.fan_out(factors.withColumnRenamed("id", key)), key)

    try:
        hot_users, hot_items = _long(ratings, "user", many), _long(ratings, "item", many)
        by_user = bucketed(_lists(hot_users.salt(ratings), "user", "item", trainer), "user")
        by_item = bucketed(_lists(hot_items.salt(ratings), "item", "user", trainer), "item")
        for n in range(1, iterations + 1):
            rated = met_in_buckets(by_item, side(items, "item", hot_items), "item")
            rows = rated.select("item", "features", F.explode(F.arrays_zip("users", *trainer.listed)).alias("r"))
            kept = ["r.kept"] if trainer.models > 1 else []
            rows = rows.select("item", "features", F.col("r.users").alias("user"), F.col("r.ratings").alias("rating"), *kept)
            # Ratings go to their users, those of one user to several tasks if there are many.
            dealt = rows.repartition("user", F.pmod("item", F.lit(64)))
            users = write_table(trainer.factors(_row_sums(dealt, "user", trainer.rank, trainer.models)), "user-factors")
            if n < iterations:
                beside = met_in_buckets(by_user, side(users, "user", hot_users), "user")
                items = write_table(trainer.factors(_sweep(beside, trainer, None)), "item-factors")
        return users, items
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def met_in_buckets(lists: DataFrame, factors: DataFrame, key: str) -> DataFrame:
    """Lists beside their factors; both are stored in buckets of the same key and number."""
    return lists.join(factors, [key, SALT])


def residuals(equations: DataFrame, factors: DataFrame, rank: int, reg: float) -> DataFrame:
    """(id, residual): how far ``factors`` are from solving their equations,
    relative to the right side's length."""
    rows, columns = np.triu_indices(rank)
    place = np.zeros((rank, rank), dtype=int)
    place[rows, columns] = place[columns, rows] = np.arange(len(rows))

    def line(i: int):
        gram = F.transform(F.array(*[F.lit(int(x)) for x in place[i]]), lambda k: F.get("gram", k))
        products = F.zip_with(gram, F.col("features").cast("array<double>"), lambda a, b: a * b)
        total = F.aggregate(products, F.lit(0.0), lambda a, b: a + b)
        return total + F.lit(reg) * F.col("n") * F.col("features")[i].cast("double") - F.col("right")[i]

    off = sum(F.pow(line(i), 2) for i in range(rank))
    length = F.aggregate("right", F.lit(0.0), lambda a, b: a + b * b)
    return equations.join(factors, "id").select("id", F.sqrt(off / length).alias("residual"))
