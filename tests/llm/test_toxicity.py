import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roamrank.llm import toxicity
from tests.llm.fixtures import awkward, documents, words

BAD = ["idiota", "morona", "scuma", "trasha"]


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1, 901):
        text = words(rng, rng.randrange(20, 120)).split()
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(BAD))
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(planted):
    docs, labels = planted
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = toxicity.judge(docs, labels).select("doc_id", "held_out", "score", "predicted").collect()
    assert all(r["held_out"] == held(r["doc_id"]) for r in rows)
    test = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in test) > 0.97 * len(test)
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_and_other_columns_play_no_part(planted):
    docs, labels = planted
    a = {r["doc_id"]: r["score"] for r in toxicity.judge(docs, labels).collect()}
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    others = docs.withColumn("source", F.lit("other")).withColumn("lang", F.lit("xx"))
    b = {r["doc_id"]: r["score"] for r in toxicity.judge(others, flipped).collect()}
    assert a == b


def test_awkward_rows(spark, planted):
    docs, labels = planted
    more = documents(spark, [(None if r[0] is None else r[0] + 2000, *r[1:]) for r in awkward()])
    odd = spark.createDataFrame([(None, 1), (2001, None), (1, 0), (1, 1), (99_999, 1)], "doc_id bigint, toxic int")
    rows = toxicity.judge(docs.unionByName(more), labels.unionByName(odd)).where("doc_id IS NULL OR doc_id > 2000").collect()
    assert len(rows) == len(awkward())
    assert all(r["score"] is not None and r["predicted"] == 0 for r in rows)
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    empty = {r["score"] for r in rows if not (r["text"] or "").strip()}
    assert len(empty) == 1
    assert toxicity.judge(docs.limit(0), labels).count() == 0


def test_without_labels_of_both_kinds(planted):
    docs, labels = planted
    assert {r["predicted"] for r in toxicity.judge(docs, labels.limit(0)).collect()} == {0}
    assert {r["predicted"] for r in toxicity.judge(docs, labels.where("toxic = 0")).collect()} == {0}
    assert {r["predicted"] for r in toxicity.judge(docs, labels.where("toxic = 1")).collect()} == {1}


def test_weights_are_sparse(planted):
    docs, labels = planted
    assert len(toxicity.fit(docs, labels).columns) < 500


def test_columns_by_hand():
    hasher = toxicity.Hasher()
    one, two = (hasher.columns(t) for t in ("A b, c!", "a  B c"))
    assert one.tolist() == two.tolist() and len(one) == 3 + 2 + 1
    assert hasher.columns(None).size == hasher.columns(" ;").size == 0


def plain_columns(text):
    """Distinct columns of a text, a number at a time."""
    ids = [zlib.crc32(w.encode()) for w in toxicity.WORDS.findall((text or "").lower())]
    wide = (1 << 64) - 1
    mixed = list(ids)
    mixed += [(a * 0x9E3779B97F4A7C15 & wide) ^ b for a, b in zip(ids, ids[1:])]
    mixed += [(a * 0xC2B2AE3D27D4EB4F & wide) ^ (b + 0x5851F42D) for a, b in zip(ids, ids[2:])]
    return sorted({((m * 0xD6E8FEB86659FD93 & wide) >> 32) % toxicity.SPACE for m in mixed})


def plain_ftrl(rows):
    """FTRL-proximal as published, a coordinate at a time: weights by column, the bias under None."""
    z, n = {}, {}

    def weight(i):
        l1, pull = (0.0 if i is None else toxicity.L1), z.get(i, 0.0)
        if abs(pull) <= l1:
            return 0.0
        return -(pull - math.copysign(l1, pull)) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for columns, label in rows:
            w = {i: weight(i) for i in [*columns, None]}
            g = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w.values()))))) - label
            for i, own in w.items():
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / toxicity.ALPHA * own
    return {i: weight(i) for i in z if weight(i)}


def test_columns_equal_plain_ones():
    hasher = toxicity.Hasher()
    for text in ("", "one", "one two", "One, two; THREE four one two", "é ß 日本 x_y 12"):
        assert np.unique(hasher.columns(text)).tolist() == plain_columns(text)


def test_scores_equal_those_of_plain_ftrl(spark, planted):
    """The query's model and scores, against a model trained a coordinate at a time."""
    docs, labels = planted
    model = toxicity.fit(docs, labels)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    texts = docs.select("doc_id", "text", F.xxhash64("doc_id", F.lit(1)).alias("rank")).collect()
    ordered = sorted((r for r in texts if not held(r["doc_id"])), key=lambda r: r["rank"])
    weights = plain_ftrl([(plain_columns(r["text"]), truth[r["doc_id"]]) for r in ordered])
    bias = weights.pop(None)
    assert model.bias == pytest.approx(bias, abs=1e-3)
    got = dict(zip(model.columns.tolist(), model.weights.tolist(), strict=True))
    assert all(got.get(i, 0.0) == pytest.approx(weights.get(i, 0.0), abs=1e-3) for i in {*got, *weights})
    scores = {r["doc_id"]: r["score"] for r in toxicity.judge(docs, labels, model).collect()}
    for r in texts:
        margin = bias + sum(weights.get(c, 0.0) for c in plain_columns(r["text"]))
        expected = 1 / (1 + math.exp(-(model.slope * margin + model.shift)))
        assert scores[r["doc_id"]] == pytest.approx(expected, abs=5e-3)


def test_an_id_trains_once_however_often_it_is_repeated(spark, planted):
    docs, labels = planted
    one = next(r["doc_id"] for r in docs.orderBy("doc_id").collect() if not held(r["doc_id"]))
    again = docs.where(F.col("doc_id") == one).withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("_n")
    repeated = docs.unionByName(again).unionByName(again.limit(1).withColumn("text", F.lit(None).cast("string")))
    sample, _ = toxicity._sample(repeated, labels)
    assert sample.count() == sample.select("doc_id").distinct().count() == sum(not held(i) for i in range(1, 901))
    a, b = toxicity.fit(docs, labels), toxicity.fit(repeated, labels)
    assert a.columns.tolist() == b.columns.tolist() and a.weights.tolist() == b.weights.tolist()
    assert (a.bias, a.slope, a.shift) == (b.bias, b.slope, b.shift)
