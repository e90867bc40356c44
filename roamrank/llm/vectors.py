"""What the two vector searches share: usable rows, bundles of vectors, bundle pairs, merged answers.

Vectors travel in bundles, one row holding the ids and the matrix of some thousand
vectors, so that tasks work on matrices and few rows are shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roamrank.llm.batches import bound_batches

BUNDLE = "ids binary, matrix binary, width int"
#: Lists that a bundle of queries meets in one task.
GROUP = 64


def usable(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a vector of finite components; as (vec_id, embedding)."""
    bound_batches(vectors.sparkSession)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite
    )


def stacked(embeddings) -> np.ndarray:
    """Vectors as a matrix of doubles; shorter ones count as filled up with zeros."""
    width = max((len(v) for v in embeddings), default=0)
    out = np.zeros((len(embeddings), width))
    for i, v in enumerate(embeddings):
        out[i, : len(v)] = v
    return out


def sample(vectors: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of at most ``n`` rows, those with the smallest hashes.

    Hashes are first counted by powers of two, from the smallest possible one: at most 64 numbers.
    Only rows up to the power with the ``n``-th row are ranked, mostly fewer than ``2 * n``.
    """
    place = F.xxhash64("vec_id").cast("double") + F.lit(2.0**63)
    power = F.floor(F.log2(F.greatest(place, F.lit(1.0)))).cast("int")
    last, many = 0, 0
    for last, count in sorted(map(tuple, vectors.groupBy(power).agg(F.count("*")).collect())):
        many += count
        if many >= n:
            break
    low = vectors.where(power <= last).orderBy(F.xxhash64("vec_id"), "vec_id", F.hash("embedding")).limit(n)
    # Collected as it is, a sorted limit sends the driver ``n`` rows of each partition.
    rows = low.coalesce(1).collect()
    ids = np.array([r["vec_id"] for r in rows], dtype=np.int64)
    return ids, stacked([r["embedding"] for r in rows])


def packed(matrix: np.ndarray) -> bytes:
    """Doubles as the smallest kind of number that keeps all their bits; the first byte names the kind."""
    matrix = np.ascontiguousarray(matrix, dtype=np.float64)
    for kind in "hf":
        with np.errstate(all="ignore"):
            small = matrix.astype(kind)
        if small.astype(np.float64).tobytes() == matrix.tobytes():
            return kind.encode() + small.tobytes()
    return b"d" + matrix.tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data[1:], dtype=chr(data[0])).astype(np.float64).reshape(-1, width)


def bundled(ids: np.ndarray, matrix: np.ndarray) -> dict:
    return {
        "ids": np.ascontiguousarray(ids, dtype=np.int64).tobytes(),
        "matrix": packed(matrix),
        "width": matrix.shape[1],
    }


def unbundled(row) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row.ids, dtype=np.int64), unpacked(row.matrix, row.width)


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m for m in (a, b))


def query_bundles(vectors: DataFrame, every: int, size: int, near: str | None = None) -> DataFrame:
    """Rows whose id is divisible by ``every``, about ``size`` in a bundle; as (block, BUNDLE).

    ``near`` is a column of few small numbers, none null; a bundle has rows of one or of neighbouring ones.
    """
    queries = vectors.where(F.col("vec_id") % every == 0)
    mixed = F.xxhash64("vec_id", "embedding")
    if near is None:
        block = F.pmod(mixed, F.lit(1 + queries.count() // size))
    else:
        counts = {r[near]: r["count"] for r in queries.groupBy(near).count().collect()}
        begin, begins, many = 0, [], []
        for number in range(max(counts, default=0) + 1):
            begins.append(begin)
            many.append(counts.get(number, 0))
            begin += many[-1]
        told = [F.get(F.array(*[F.lit(x).cast("bigint") for x in xs]), F.col(near)) for xs in (begins, many)]
        block = F.floor((told[0] + F.pmod(mixed, told[1])) / size)
    dealt = queries.withColumn("block", block.cast("int"))

    def bundle(pdf):
        pdf = pdf.sort_values("vec_id")
        row = bundled(pdf["vec_id"].to_numpy(), stacked(list(pdf["embedding"])))
        return pd.DataFrame([{"block": pdf["block"].iloc[0], **row}])

    return dealt.groupBy("block").applyInPandas(bundle, f"block int, {BUNDLE}")


def meet(queries: DataFrame, lists: DataFrame, n_lists: int, asked: str | None = None) -> DataFrame:
    """Every bundle of queries beside every list of vectors, or those whose numbers ``asked`` holds.

    The queries are the smaller side. They are repeated for each list that they ask for, or for
    some lists in a row where they meet all, at most GROUP and few enough for all cores; a bundle
    meets these one after another. Neither side is collected or broadcast, and a row is one pair of bundles.
    """
    told = [F.col(c).alias(f"q_{c}") for c in queries.columns if c != asked]
    if asked:
        return queries.select(F.explode(asked).alias("list"), *told).join(lists, "list")
    cores = queries.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(GROUP, n_lists // (4 * cores)))
    # The rows made of one row are in memory together, so they must not be one for each list.
    groups = F.explode(F.sequence(F.lit(0), F.lit(max(n_lists - 1, 0) // size)))
    grouped = lists.withColumn("lists", F.floor(F.col("list") / size).cast("int"))
    return queries.select(groups.alias("lists"), *told).join(grouped, "lists").drop("lists")


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all lists' answers for each query row, ties to the smaller id."""
    order = Window.partitionBy("block", "pos").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
