"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words, word pairs and pairs with one word between are hashed into SPACE columns;
a document has a column or not. FTRL-proximal gives each column its own rate and
keeps a weight at zero until the evidence exceeds L1, so the model is some hundred
weights, which go to the tasks with the code. Scores are calibrated on the sample,
each row scored without having been trained on, and shifted to the share of toxic rows among all labels.

It may learn from rows whose crc32(doc_id as text) mod 3 is not 1 and is fitted on a
bounded sample of them: the MAX_TOXIC toxic and MAX_CLEAN clean ids with the
smallest hashes, each once: of several rows with an id the smallest text trains, nulls
last. Null or empty texts have the score of the bias alone; without
labels of both kinds every score is the share of toxic ones among those there are (0
if none). A null doc_id is never held out and never trains. Of several labels for a
document the largest counts. Repeated rows get equal scores; whole texts are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamrank.llm.batches import bound_batches, give_back, tidy
from roamrank.llm import boosting

MAX_TOXIC, MAX_CLEAN = 6_000, 10_000
SPACE = 1 << 22
L1, L2, ALPHA, BETA, EPOCHS = 8.0, 1.0, 1.0, 1.0, 4
CUT = 0.7
FOLDS = 3
WORDS = re.compile(r"[^\W_]+")
#: Words whose hashes a task remembers before it starts over.
REMEMBERED = 100_000


class Hasher:
    """Turns texts into column numbers."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def columns(self, text: str | None) -> np.ndarray:
        """Columns of all n-grams and skip-grams, repeats included."""
        words = WORDS.findall(text.lower()) if text else []
        known = self.known
        try:
            ids = [known[w] for w in words]
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for w in set(words):
                if w not in known:
                    known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass"))
            ids = [known[w] for w in words]
        one = np.array(ids, dtype=np.uint64)
        pairs = (one[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ one[1:]
        skips = (one[:-2] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (one[2:] + np.uint64(0x5851F42D))
        mixed = np.concatenate([one, pairs, skips]) * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed >> np.uint64(32)) % np.uint64(SPACE)).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """Train on (distinct columns, label) rows in order: columns with a weight, weights, bias."""
    z, n = np.zeros(SPACE + 1, dtype=np.float32), np.zeros(SPACE + 1, dtype=np.float32)

    def weights(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == SPACE, 0.0, L1)  # the bias, in the last place, isn't shrunk
        pull = z[at]
        w = -(pull - np.sign(pull) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(pull) <= l1, 0.0, w)

    for _ in range(epochs):
        for columns, label in rows:
            at = np.append(columns, SPACE)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    kept = np.flatnonzero(np.abs(z[:SPACE]) > L1)
    return kept, weights(kept), float(weights(np.array([SPACE]))[0])


@dataclass
class Model:
    """Columns that have a weight, their weights, and the calibrated line."""

    columns: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def table(self) -> np.ndarray:
        table = np.zeros(SPACE, dtype=np.float32)
        table[self.columns] = self.weights
        return table

    def margin(self, columns: np.ndarray, table: np.ndarray) -> float:
        hit = np.unique(columns[table[columns] != 0])
        return self.bias + float(table[hit].sum(dtype=np.float64))

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -40, 40)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float | None]:
    """(text, toxic) of the bounded sample, and the share of toxic labels that may be learnt from."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = usable.agg(F.avg("toxic")).first()[0]
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    parts = [
        usable.where(F.col("toxic") == y).orderBy(*order).limit(most) for y, most in ((1, MAX_TOXIC), (0, MAX_CLEAN))
    ]
    # MAX_TOXIC + MAX_CLEAN rows of two numbers at most.
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    found = docs.select("doc_id", "text").join(chosen, "doc_id")
    # Repeated rows are combined before the shuffle, so the bound on ids is one on rows.
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), share


def _hashed(batches):
    hasher = Hasher()
    for pdf in batches:
        columns = pd.Series([np.unique(hasher.columns(t)).astype(np.int32) for t in pdf["text"]], dtype=object)
        yield pd.DataFrame({"rank": pdf["rank"], "toxic": pdf["toxic"], "columns": columns})


def _train(share: float):
    def train(batches):
        rows = []
        for batch in batches:
            flat = batch.column(2).flatten().to_numpy()
            ends = np.cumsum(batch.column(2).value_lengths().to_numpy())
            rows += zip(np.split(flat, ends[:-1]) if len(ends) else [], batch.column(1).to_pylist(), strict=True)
        toxic = sum(y for _, y in rows)
        if not 0 < toxic < len(rows):
            return
        # Each row is scored by a model that hasn't seen it, for the calibration.
        margins = np.zeros(len(rows))
        for fold in range(FOLDS):
            model = Model(*ftrl([r for i, r in enumerate(rows) if i % FOLDS != fold]), 1.0, 0.0)
            table = model.table()
            margins[fold::FOLDS] = [model.margin(c, table) for c, _ in rows[fold::FOLDS]]
        columns, weights, bias = ftrl(rows)
        slope, shift = boosting.platt(margins, np.array([y for _, y in rows], dtype=float))
        drawn = toxic / len(rows)
        shift += float(np.log(share / (1 - share)) - np.log(drawn / (1 - drawn)))
        yield pa.RecordBatch.from_pylist(
            [{"columns": columns.tolist(), "weights": weights.tolist(), "line": [bias, slope, shift]}]
        )

    return train


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Hash the sample where it lies, then train on it in one task; its size is bounded by MAX_TOXIC and MAX_CLEAN."""
    bound_batches(docs.sparkSession)
    sample, share = _sample(docs, labels)
    nothing = Model(np.zeros(0, dtype=np.int64), np.zeros(0), 0.0, 1.0, 0.0)
    if share is None or not 0 < share < 1:
        nothing.shift = 40.0 if share else -40.0
        return nothing
    ranked = sample.select(F.xxhash64("doc_id", F.lit(1)).alias("rank"), "toxic", "text")
    hashed = ranked.mapInPandas(tidy(_hashed), "rank bigint, toxic int, columns array<int>")
    ordered = hashed.repartition(1).sortWithinPartitions("rank", "toxic", F.hash("columns"))
    found = ordered.mapInArrow(
        tidy(_train(share)), "columns array<bigint>, weights array<double>, line array<double>"
    ).collect()
    if not found:
        nothing.shift = float(np.log(share / (1 - share)))
        return nothing
    return Model(np.array(found[0]["columns"], dtype=np.int64), np.array(found[0]["weights"]), *found[0]["line"])


def score(text: Column, model: Model) -> Column:
    """Probability that a text is toxic."""
    bound_batches()

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, hasher = model.table(), Hasher()
        try:
            for texts in batches:
                margins = [model.margin(hasher.columns(t), table) for t in texts]
                yield pd.Series(model.probability(np.array(margins, dtype=float)))
        finally:
            del table, hasher
            give_back()

    return scored(text)


def judge(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with ``held_out``, ``score`` and ``predicted``; columns of these names are replaced."""
    scored = docs.withColumn("score", score(F.col("text"), model or fit(docs, labels)))
    return scored.withColumns(
        {"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= CUT).cast("int")}
    )
