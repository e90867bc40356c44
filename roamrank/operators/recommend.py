"""The best items per user, with or without those already visited."""

from __future__ import annotations

import datetime
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from roamrank.functions.expressions import run_date
from roamrank.operators.joins import lookup_join
from roamrank.operators.model import FactorModel
from roamrank.workspace import write_table

# Item vectors in a block, in numbers: 16 MB of doubles. At rank 10 that is 200,000 items.
CHUNK_NUMBERS = 2_000_000
# Users scored together against a block of items.
BUNDLE_USERS = 4096
# Scores a task holds at a time: few enough to stay in the processor's cache.
SCORES_IN_MEMORY = 100_000
# Scores worth a task of its own, and the most a task should compute.
SCORES_PER_TASK = 100_000_000
MOST_SCORES_PER_TASK = 4_000_000_000
RECOMMENDED = "array<struct<item:int,score:double>>"
OPENED = f"user int, items {RECOMMENDED}, reach int, bar double, features array<double>, seen array<int>"
BUNDLED = (
    "users array<int>, vectors array<double>, seen array<array<int>>, "
    "bars array<double>, reaches array<int>, blocks array<int>"
)
# What bounds are multiplied with before scores are held against them.
ROUNDING = 1 + 1e-9
# Fixed value: what stands for an unknown name.
EMPTY = "empty"


def recommend_topk(
    model: FactorModel,
    k: int,
    seen: DataFrame | None = None,
    chunk_items: int | None = None,
    visits: Observation | None = None,
) -> DataFrame:
    """(user, items): for every user the ``k`` best items, best first.

    Equal scores go by item id. Pairs in ``seen`` (user, item) are passed over
    before ranking, so a user gets fewer than ``k`` only when fewer are left,
    and an empty array when none is.

    Users come in bundles, items in blocks of ``chunk_items``. A single block, whose
    size is bounded, is broadcast, and users are scored where they lie. Of several,
    the items are in the order of their vectors' lengths, longest first. Every user
    meets the first block that way; what it gives is a bar for the rest: no item of
    a block scores above the user's length times the block's longest vector, so once
    that is below the user's k-th best, this and all further blocks are left out. The
    remaining pairs of a bundle and a block are dealt by block and by group of users,
    so tasks grow with both. ``visits`` counts them: of ``pairs`` of a user and a block
    after the first ``met`` were needed.
    """
    chunk = chunk_items or max(1, CHUNK_NUMBERS // model.rank)
    items = model.item_factors.select(F.col("id").alias("item"), "features")
    count = items.count()
    blocks = max(1, math.ceil(count / chunk))
    users = model.user_factors.select(F.col("id").alias("user"), F.col("features").cast("array<double>").alias("features"))
    users = _spread(users, min(count, chunk))
    if seen is None:
        users = users.withColumn("seen", F.array().cast("array<int>"))
    else:
        visited = seen.groupBy("user").agg(F.collect_set("item").alias("seen"))
        users = users.join(visited, "user", "left")
    bundles = users.mapInArrow(_bundler(BUNDLE_USERS), "users array<int>, vectors array<double>, seen array<array<int>>")
    names = ["users", "vectors", "seen", "ids", "factors"]
    if blocks == 1:
        # CHUNK_NUMBERS numbers at most.
        cut = _block(items, model.rank)
        met = bundles.withColumn("block", F.lit(0)).join(F.broadcast(cut), "block")
        return met.select(*names).mapInArrow(_scorer(model.rank, k), f"user int, items {RECOMMENDED}")
    cut = write_table(_by_length(items, blocks), "item-blocks")
    # One number for each block.
    longest = [(row["block"], row["longest"]) for row in cut.select("block", "longest").orderBy("block").collect()]
    first, rest = longest[0][0], longest[1:]
    begun = bundles.withColumn("block", F.lit(first)).join(F.broadcast(cut.where(F.col("block") == first)), "block")
    found = begun.select(*names).mapInArrow(_opener(model.rank, k, [top for _, top in rest]), OPENED)
    if visits is not None:
        found = found.observe(visits, F.sum("reach").alias("met"), (F.count("*") * len(rest)).alias("pairs"))
    kept = [F.when(F.col("reach") > 0, F.col(c)).alias(c) for c in ("features", "seen")]
    found = write_table(found.select("user", "items", "reach", "bar", *kept), "first-block")
    best = found.select("user", "items")
    left = found.where("reach > 0")
    pending = left.count()
    if not pending or not rest:
        return best
    pairs = _pairs(left, pending, [block for block, _ in rest])
    met = _meet(pairs, cut.where(F.col("block") != first), pending, chunk, len(rest))
    further = met.select("users", "vectors", "seen", "bars", "reaches", "place", "ids", "factors").mapInArrow(
        _scorer(model.rank, k), f"user int, items {RECOMMENDED}"
    )
    both = best.unionByName(further).groupBy("user").agg(F.flatten(F.collect_list("items")).alias("items"))
    return both.select("user", _best_first(F.col("items"), k).alias("items"))


def _tasks(work: int, cores: int) -> int:
    return max(1, math.ceil(work / MOST_SCORES_PER_TASK), min(2 * cores, math.ceil(work / SCORES_PER_TASK)))


def _spread(users: DataFrame, items: int) -> DataFrame:
    """Split users by the scoring ahead: their file is small for the work it means."""
    tasks = _tasks(users.count() * items, users.sparkSession.sparkContext.defaultParallelism)
    return users.repartition(tasks, "user") if tasks > 1 else users


def _pairs(left: DataFrame, pending: int, blocks: list[int]) -> DataFrame:
    """Bundles of users with alike reach, once for each block that one of them has to meet."""
    parts = max(1, math.ceil(pending / (4 * BUNDLE_USERS)))
    alike = left.repartitionByRange(parts, F.desc("reach"), "user").sortWithinPartitions(F.desc("reach"))
    bundles = alike.mapInArrow(_bundler(BUNDLE_USERS, blocks), BUNDLED)
    return bundles.select("users", "vectors", "seen", "bars", "reaches", F.posexplode("blocks").alias("place", "block"))


def _meet(pairs: DataFrame, cut: DataFrame, pending: int, chunk: int, blocks: int) -> DataFrame:
    """Pairs beside their blocks, in tasks for each block and group of users."""
    cores = pairs.sparkSession.sparkContext.defaultParallelism
    groups = math.ceil(_tasks(pending * chunk * blocks, cores) / blocks)
    grouped = pairs.withColumn("group", F.pmod(F.xxhash64(F.col("users")[0]), F.lit(groups)).cast("int"))
    copies = cut.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return grouped.repartition(blocks * groups, "block", "group").join(copies, ["block", "group"])


def _best_first(items: Column, k: int) -> Column:
    keyed = F.transform(items, lambda x: F.struct((-x["score"]).alias("below"), x["item"].alias("item")))
    best = F.slice(F.sort_array(keyed), 1, k)
    return F.transform(best, lambda x: F.struct(x["item"].alias("item"), (-x["below"]).alias("score")))


def _block(items: DataFrame, rank: int) -> DataFrame:
    """(block, ids, factors): all item vectors in one row, in the order of their ids."""

    def bundle(rows):
        rows = rows.sort_values("item")
        vectors = np.stack(rows["features"].to_numpy()).astype(np.float64)
        own = (0, rows["item"].to_numpy(np.int32).tolist(), vectors.T.tobytes())
        return pd.DataFrame([own], columns=["block", "ids", "factors"])

    whole = items.withColumn("block", F.lit(0))
    return whole.groupBy("block").applyInPandas(bundle, "block int, ids array<int>, factors binary")


def _by_length(items: DataFrame, blocks: int) -> DataFrame:
    """(block, longest, ids, factors): item vectors by length, longest first, in blocks of about equal size.

    Within a block they are in the order of their ids.
    """

    def bundle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [f for f in frames if len(f)]
        if frames:
            rows = pd.concat(frames).sort_values("item")
            vectors = np.stack(rows["features"].to_numpy()).astype(np.float64)
            ids = rows["item"].to_numpy(np.int32).tolist()
            own = (TaskContext.get().partitionId(), float(rows["length"].max()), ids, vectors.T.tobytes())
            yield pd.DataFrame([own], columns=["block", "longest", "ids", "factors"])

    squares = F.aggregate(F.col("features").cast("array<double>"), F.lit(0.0), lambda a, b: a + b * b)
    ordered = items.withColumn("length", F.sqrt(squares)).repartitionByRange(blocks, F.desc("length"), "item")
    return ordered.mapInPandas(bundle, "block int, longest double, ids array<int>, factors binary")


def _bundler(size: int, blocks: list[int] | None = None) -> Callable:
    """Several users in a row; nested, so that it travels to the executors by value.

    With ``blocks``, the users' bars and reaches come along, and the blocks within the
    reach of any of them.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def listed(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        for batch in batches:
            for low in range(0, batch.num_rows, size):
                part = batch.slice(low, size)
                seen = part.column("seen")
                if seen.null_count:
                    seen = pa.array([x or [] for x in seen.to_pylist()], pa.list_(pa.int32()))
                columns = [listed(part.column("user")), listed(part.column("features").flatten()), listed(seen)]
                names = ["users", "vectors", "seen"]
                if blocks is not None:
                    most = max(part.column("reach").to_pylist())
                    columns += [listed(part.column("bar")), listed(part.column("reach"))]
                    columns.append(listed(pa.array(blocks[:most], pa.int32())))
                    names += ["bars", "reaches", "blocks"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return bundle


def _scoring(rank: int, k: int) -> tuple[Callable, Callable]:
    """The scoring of a bundle of users against a block of items.

    Nested functions travel to the executors by value, so those need no copy of
    this package.
    """

    def best(factors: np.ndarray, matrix: np.ndarray, owners: np.ndarray, visited: np.ndarray) -> tuple:
        """User, item place and score of each user's best, in that order."""
        scores = factors @ matrix
        scores[owners, visited] = -np.inf
        # Everything not below the k-th best, so that ties are settled by item id.
        count = matrix.shape[1]
        below = count - min(k, count)
        bar = np.partition(scores, below, axis=1)[:, below]
        user, place = np.divmod(np.flatnonzero(scores >= bar[:, None]), count)
        value = scores[user, place]
        new = value > -np.inf
        user, place, value = user[new], place[new], value[new]
        order = np.lexsort((place, -value, user))
        user, place, value = user[order], place[order], value[order]
        keep = np.arange(len(user)) - np.searchsorted(user, user) < k
        return user[keep], place[keep], value[keep]

    def scored(factors, seen, item_ids, matrix, bars=None) -> tuple[np.ndarray, pa.Array]:
        """Where each user's recommendations begin and end, and all of them."""
        rows = len(factors)
        step = max(1, SCORES_IN_MEMORY // len(item_ids))
        lengths = seen.value_lengths().to_numpy(zero_copy_only=False)
        owners = np.repeat(np.arange(rows), lengths)
        flat = seen.flatten().to_numpy(zero_copy_only=False)
        visited = np.minimum(np.searchsorted(item_ids, flat), len(item_ids) - 1)
        here = item_ids[visited] == flat  # the others are in other blocks
        owners, visited = owners[here], visited[here]
        parts = []
        for low in range(0, rows, step):
            high = min(low + step, rows)
            mine = slice(np.searchsorted(owners, low), np.searchsorted(owners, high))
            user, place, value = best(factors[low:high], matrix, owners[mine] - low, visited[mine])
            parts.append((user + low, place, value))
        user, place, value = (np.concatenate(column) for column in zip(*parts))
        if bars is not None:
            enough = value >= bars[user]
            user, place, value = user[enough], place[enough], value[enough]
        offsets = np.searchsorted(user, np.arange(rows + 1)).astype(np.int32)
        found = pa.StructArray.from_arrays(
            [pa.array(item_ids[place], pa.int32()), pa.array(value, pa.float64())], ["item", "score"]
        )
        return offsets, found

    def read(batch: pa.RecordBatch, n: int) -> tuple:
        """Of a row: users, their vectors, what they have seen, item ids and item vectors."""
        users, vectors, seen, ids = (batch.column(c)[n].values for c in ("users", "vectors", "seen", "ids"))
        matrix = np.frombuffer(batch.column("factors")[n].as_buffer(), dtype=np.float64).reshape(rank, -1)
        factors = vectors.to_numpy(zero_copy_only=False).reshape(-1, rank)
        return users, factors, seen, ids.to_numpy(zero_copy_only=False), matrix

    return scored, read


def _scorer(rank: int, k: int) -> Callable:
    """Each user's best of a block. With reaches, of a block within them, and at the bar or above."""
    scored, read = _scoring(rank, k)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                users, factors, seen, ids, matrix = read(batch, n)
                bars = None
                if "reaches" in batch.schema.names:
                    # The longest reach comes first.
                    reaches = batch.column("reaches")[n].values.to_numpy(zero_copy_only=False)
                    here = int((reaches > batch.column("place")[n].as_py()).sum())
                    users, factors, seen = users[:here], factors[:here], seen[:here]
                    bars = batch.column("bars")[n].values.to_numpy(zero_copy_only=False)[:here]
                offsets, found = scored(factors, seen, ids, matrix, bars)
                lists = pa.ListArray.from_arrays(pa.array(offsets), found)
                yield pa.RecordBatch.from_arrays([users, lists], ["user", "items"])

    return score


def _opener(rank: int, k: int, longest: list[float]) -> Callable:
    """Each user's best of the first block, the bar that it sets, and how many further blocks may pass it."""
    scored, read = _scoring(rank, k)

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = np.array(longest, dtype=np.float64)
        for batch in batches:
            for n in range(batch.num_rows):
                users, factors, seen, ids, matrix = read(batch, n)
                offsets, found = scored(factors, seen, ids, matrix)
                bar = np.full(len(users), -np.inf)
                full = np.flatnonzero(np.diff(offsets) == k)
                bar[full] = found.field("score").to_numpy()[offsets[full] + k - 1]
                # Rounding must not leave out a block.
                most = np.sqrt((factors**2).sum(1))[:, None] * tops * ROUNDING
                reach = (most >= bar[:, None]).sum(1).astype(np.int32)
                each = np.arange(0, factors.size + 1, rank, dtype=np.int32)
                columns = [
                    users,
                    pa.ListArray.from_arrays(pa.array(offsets), found),
                    pa.array(reach),
                    pa.array(bar),
                    pa.ListArray.from_arrays(pa.array(each), pa.array(factors.ravel())),
                    seen,
                ]
                yield pa.RecordBatch.from_arrays(columns, ["user", "items", "reach", "bar", "features", "seen"])

    return open_


def exploded(recommended: DataFrame) -> DataFrame:
    """(user, rank, item, score), one row per recommendation, rank from 1."""
    return recommended.select("user", F.posexplode("items").alias("place", "best")).select(
        "user",
        (F.col("place") + 1).alias("rank"),
        F.col("best.item").alias("item"),
        F.col("best.score").alias("score"),
    )


def attach_names(
    recommended: DataFrame,
    areas: DataFrame,
    reviewers: DataFrame,
    users: DataFrame | None = None,
    as_of: datetime.date | str | None = None,
) -> DataFrame:
    """(reviewerId, reviewerName, neighbourhoodNames, date) for publishing.

    ``users`` maps trainer ids back to reviewer ids where they differ. A name
    nobody knows becomes ``"empty"``; the order of the areas is kept.
    """
    if users is None:
        owned = recommended.withColumn("reviewer_id", F.col("user").cast("bigint"))
    else:
        owned = recommended.join(users, "user")
    # From here on everything is grouped and joined on reviewer_id: one shuffle.
    rows = owned.select("reviewer_id", F.posexplode_outer("items").alias("place", "best")).select(
        "reviewer_id", "place", F.col("best.item").cast("bigint").alias("neighbourhood_id")
    )
    named = lookup_join(rows, areas, "neighbourhood_id", "left")
    entry = F.when(
        F.col("place").isNotNull(),
        F.struct("place", F.coalesce("neighbourhood", F.lit(EMPTY)).alias("name")),
    )
    # collect_list skips the null of a user without recommendations.
    lists = named.groupBy("reviewer_id").agg(F.sort_array(F.collect_list(entry)).alias("places"))
    # The names of the result's columns.
    return lists.join(reviewers, "reviewer_id", "left").select(
        F.col("reviewer_id").alias("reviewerId"),
        F.coalesce("reviewer_name", F.lit(EMPTY)).alias("reviewerName"),
        F.transform("places", lambda x: x["name"]).alias("neighbourhoodNames"),
        run_date(as_of).alias("date"),
    )
