"""Exact top-k search by inner product with block-at-a-time pruning.

The rows lie in lists of about LIST rows, near ones together, and a list in blocks of
BLOCK rows. A block knows the greatest and the smallest value of each term, whose
products with a query's terms sum up to a bound for all its rows. Each query takes a
list's blocks in the order of their bounds, scores them through their rows (the
forward index), and stops at the first block whose bound is below its k-th best
score. That is known to be at least the k-th best of a bounded set of seed rows.

Vectors are turned into integers, floor(scale * x), and scores are exact. Rows whose
vector is null, empty or has null or non-finite components, or that have no id, take
no part; shorter vectors count as filled up with zeros. Rows with a query's own id
aren't its candidates. Repeated query rows are answered one by one, ties go to the
smaller id, and an empty table or no query gives no rows. A vector that a third of
all rows share is spread over lists by the hash of the id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamrank.llm import vectors as V
from roamrank.workspace import write_table

SCALE = 256
BLOCK = 128
LIST = 4096
QUERIES = 1024
PIVOTS = 32
SEEDS = 2048


def integers(matrix: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as whole doubles."""
    return np.floor(SCALE * matrix) + 0.0  # no -0.0


def exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether every sum of products stays within the whole numbers that a double holds."""
    if not a.size or not b.size:
        return True
    return float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows, exact whole numbers; Python's integers where doubles don't do."""
    if exact(a, b):
        return a @ b.T
    to_int = np.vectorize(int, otypes=[object])
    return to_int(a) @ to_int(b).T


def lists(rows: DataFrame) -> tuple[DataFrame, int, np.ndarray, np.ndarray]:
    """Lists of near rows with their blocks' extremes, their number, and the seed rows."""
    ids, some = V.sample(rows, SEEDS)
    pivots = integers(some[:PIVOTS])

    @F.pandas_udf("int")
    def nearest(embeddings: pd.Series) -> pd.Series:
        own, to = V.same_width(integers(V.stacked(list(embeddings))), pivots)
        return pd.Series(np.argmax(own @ to.T, axis=1).astype(np.int32))

    near = rows.withColumn("pivot", nearest("embedding") if len(pivots) else F.lit(0))
    # At most PIVOTS rows.
    counts = {r["pivot"]: r["n"] for r in near.groupBy("pivot").agg(F.count("*").alias("n")).collect()}
    chunks = {p: 1 + n // LIST for p, n in counts.items()}
    first = dict(zip(sorted(chunks), np.cumsum([0, *[chunks[p] for p in sorted(chunks)]]).tolist(), strict=False))
    if counts:
        number = F.create_map(*[F.lit(x) for p in chunks for x in (p, first[p])])[F.col("pivot")]
        parts = F.create_map(*[F.lit(x) for p in chunks for x in (p, chunks[p])])[F.col("pivot")]
    else:
        number = parts = F.lit(1)
    dealt = near.withColumn("list", (number + F.pmod(F.xxhash64("vec_id", F.lit(2)), parts)).cast("int"))

    def bundle(pdf):
        matrix = integers(V.stacked(list(pdf["embedding"])))
        ids = pdf["vec_id"].to_numpy()
        # Rows nearest to the same of some rows of the list stand in the same block.
        inner = matrix[np.lexsort((ids,))][:: max(1, len(matrix) // 64)]
        order = np.lexsort((ids, np.argmax(matrix @ inner.T, axis=1)))
        ids, matrix = ids[order], matrix[order]
        starts = np.arange(0, len(ids), BLOCK)
        row = V.bundled(ids, matrix)
        row["greatest"] = V.packed(np.maximum.reduceat(matrix, starts))
        row["smallest"] = V.packed(np.minimum.reduceat(matrix, starts))
        return pd.DataFrame([{"list": pdf["list"].iloc[0], **row}])

    schema = f"list int, {V.BUNDLE}, greatest binary, smallest binary"
    made = dealt.groupBy("list").applyInPandas(bundle, schema)
    return made, sum(chunks.values()), ids, integers(some)


def search(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for each row whose id is divisible by ``every``."""
    rows = V.usable(vectors)
    made, n_lists, seed_ids, seeds = lists(rows)
    queries = V.query_bundles(rows, every, QUERIES)

    def score(batches):
        held = None
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if held is None or held.block != row.q_block:
                    if held is not None:
                        yield held.answers()
                    held = _Bundle(row, seed_ids, seeds, k)
                held.take(row)
        if held is not None:
            yield held.answers()

    found = V.meet(queries, write_table(made, "lists"), n_lists).mapInPandas(
        score, "block int, pos int, query_id bigint, vec_id bigint, score bigint"
    )
    return V.best(found, k).withColumn("rank", F.col("rank").cast("int"))


class _Bundle:
    """The best rows for each query of a bundle, from the lists that it has met so far."""

    def __init__(self, row, seed_ids: np.ndarray, seeds: np.ndarray, k: int):
        self.block, self.k = row.q_block, k
        self.query_ids = np.frombuffer(row.q_ids, dtype=np.int64)
        self.queries = integers(V.unpacked(row.q_matrix, row.q_width))
        self.kth = _seeded(self.query_ids, *V.same_width(self.queries, seeds), seed_ids, k)
        self.best = [(np.zeros(0), np.zeros(0, dtype=np.int64))] * len(self.query_ids)

    def take(self, row) -> None:
        ids, matrix = V.unbundled(row)
        greatest, smallest = V.unpacked(row.greatest, row.width), V.unpacked(row.smallest, row.width)
        queries, matrix = V.same_width(self.queries, matrix)
        greatest, smallest = (V.same_width(m, matrix)[0] for m in (greatest, smallest))
        bounds = products(np.maximum(queries, 0), greatest) + products(np.minimum(queries, 0), smallest)
        for q in range(len(self.query_ids)):
            kth, (best_scores, best_ids) = self.kth[q], self.best[q]
            order = np.argsort(-bounds[q].astype(float), kind="stable")
            for at in range(0, len(order), 4):
                blocks = order[at : at + 4]
                if kth is not None:
                    blocks = [b for b in blocks if bounds[q, b] >= kth]
                if not len(blocks):
                    break  # the others' bounds are lower still
                rows = np.concatenate([np.arange(b * BLOCK, min(len(ids), (b + 1) * BLOCK)) for b in blocks])
                scores = products(matrix[rows], queries[q : q + 1])[:, 0]
                keep = ids[rows] != self.query_ids[q]
                if kth is not None:
                    keep &= scores >= kth
                all_scores = np.concatenate([best_scores, scores[keep]])
                all_ids = np.concatenate([best_ids, ids[rows][keep]])
                first = np.lexsort((all_ids, -all_scores))[: self.k]
                best_scores, best_ids = all_scores[first], all_ids[first]
                if len(first) == self.k:
                    kth = best_scores[-1] if kth is None else max(kth, best_scores[-1])
            self.kth[q], self.best[q] = kth, (best_scores, best_ids)

    def answers(self) -> pd.DataFrame:
        out = [
            (self.block, q, query_id, i, int(s))
            for q, query_id in enumerate(self.query_ids)
            for s, i in zip(*self.best[q], strict=True)
        ]
        return pd.DataFrame(out, columns=["block", "pos", "query_id", "vec_id", "score"])


def _seeded(query_ids, queries, seeds, seed_ids, k) -> list:
    """A score that each query's k-th best reaches for certain, or None."""
    if len(seed_ids) <= k:
        return [None] * len(query_ids)
    scores = products(queries, seeds)
    out = []
    for q, own in enumerate(query_ids):
        others = np.sort(scores[q][seed_ids != own])
        out.append(others[-k] if len(others) >= k else None)
    return out
