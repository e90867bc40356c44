import random

import pytest
from pyspark.sql import functions as F

from roamrank.llm import mixing
from tests.llm.fixtures import awkward, documents, words


def filled(sizes, share=1.5, cap=2):
    """Targets by handing out the excess again and again."""
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    total, target, full = share * sum(sizes), [0.0] * len(sizes), set()
    while True:
        rest = total - sum(cap * sizes[i] for i in full)
        open_ = [i for i in range(len(sizes)) if i not in full]
        w = sum(weights[i] for i in open_)
        target = [cap * sizes[i] if i in full else rest * weights[i] / w for i in range(len(sizes))]
        above = {i for i in open_ if target[i] > cap * sizes[i]}
        if not above:
            return target
        full |= above


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_taken(spark, seed):
    rng = random.Random(seed)
    sources = [f"s{i}" for i in range(rng.randrange(1, 9))] + [None] * (seed % 2)
    rows = [(i, words(rng, rng.randrange(0, 60)), rng.choice([*sources, sources[0]])) for i in range(400)]
    mixed = mixing.mix(documents(spark, rows)).collect()
    assert len(mixed) == 400
    names = sorted({r["source"] for r in mixed}, key=lambda s: (s is None, s))
    sizes = [sum(len(r[1].split()) for r in rows if r[2] == s) for s in names]
    for s, size, want in zip(names, sizes, filled(sizes)):
        own = [r for r in mixed if r["source"] == s]
        assert {r["source_size"] for r in own} == {size}
        assert own[0]["target"] == pytest.approx(want)
        assert sum(r["taken"] for r in own) == int(own[0]["target"] + 1e-9)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in mixed)
    assert all(r["taken"] == sum(c["words"] for c in r["copies"]) for r in mixed)
    again = mixing.mix(documents(spark, rows).repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in mixed)


def test_buckets_change_nothing(spark, monkeypatch):
    rng = random.Random(9)
    docs = documents(spark, [(i, words(rng, rng.randrange(1, 30)), "a" if i % 3 else "b") for i in range(300)])
    one = sorted((r["doc_id"], r["taken"], str(r["copies"])) for r in mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "BUCKET", 7)
    assert sorted((r["doc_id"], r["taken"], str(r["copies"])) for r in mixing.mix(docs).collect()) == one


def test_positions_invert_the_demand(spark):
    """By time t, a source has used its target times the integral of its weight."""
    rng = random.Random(4)
    docs = documents(spark, [(i, words(rng, 10), "abc"[i % 3]) for i in range(600)])
    mixed = mixing.mix(docs).collect()
    for s, slope in zip("abc", mixing.SLOPES):
        copies = sorted((c["position"], c["words"]) for r in mixed if r["source"] == s for c in r["copies"])
        used, target = 0, next(r["target"] for r in mixed if r["source"] == s)
        for position, n in copies:
            assert used / target == pytest.approx((1 + slope) * position - slope * position**2, abs=1e-9)
            used += n


def test_training_rows(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, rng.randrange(5, 40)), "abcd"[i % 4]) for i in range(200)]
    docs = documents(spark, rows)
    mixed = {r["doc_id"]: r for r in mixing.mix(docs, whole=True).collect()}
    out = mixing.training_rows(docs)
    assert out.columns == docs.columns
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {i: len(r["copies"]) for i, r in mixed.items() if r["copies"]}
    assert {r["size"] for r in out.select("size").collect()} == {"clash"}


def test_awkward_rows(spark):
    docs = documents(spark, awkward()).withColumn("source", F.when(F.col("doc_id") < 6, F.col("source")))
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == len(awkward())
    assert all(r["size"] == len((r["text"] or "").split()) for r in mixed)
    assert all(r["taken"] == 0 and r["copies"] == [] for r in mixed if r["size"] == 0)
    assert set(docs.columns) <= set(mixed[0].asDict())
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.in_order(mixing.mix(docs.where("doc_id = 2"))).first()["target"] == 0


def test_no_source_with_a_target_vanishes(spark):
    """A source that is one document far longer than its target keeps it, and so does one of a tiny target."""
    rows = [(i, "a", "word " * 10) for i in range(100)] + [(200, "b", "long " * 1000), (300, "c", "none " * 10)]
    rows += [(201, "b", None), (202, "b", " \t"), (101, "a", "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    options = {"weights": (100, 1, 0.000001), "slopes": (0.0, 0.0, 0.0), "share": 0.5}
    taken = mixing.training_rows(docs, **options).collect()
    assert [r["doc_id"] for r in taken if r["source"] == "b"] == [200]
    assert [r["doc_id"] for r in taken if r["source"] == "c"] == [300]
    assert all(r["text"].split() for r in taken)
    target = {r["source"]: r["target"] for r in mixing.mix(docs, whole=True, **options).collect()}
    words = sum(len(r["text"].split()) for r in taken if r["source"] == "a")
    assert abs(words - target["a"]) <= 5


@pytest.mark.parametrize("light", [False, True])
def test_rows_without_an_id_are_placed_in_parts(spark, monkeypatch, light):
    """A third of all rows have no id: no window has them all, targets are met to the word, and reruns agree."""
    monkeypatch.setattr(mixing, "BUCKET", 20)
    rng = random.Random(8)
    rows = [(i if i % 3 else None, words(rng, rng.randrange(0, 30)), "ab"[i % 2]) for i in range(900)]
    docs = documents(spark, rows)
    found = []
    parted = mixing._parted
    monkeypatch.setattr(mixing, "_parted", lambda *a: found.append(parted(*a)) or found[-1])
    mixed = mixing.mix(docs, light=light).collect()
    sizes = found[-1].groupBy("source_id", "_bucket", "_part").count().collect()
    assert max(r["count"] for r in sizes) <= 60 and sum(r["count"] for r in sizes) == 900
    assert len(mixed) == 900
    for s in "ab":
        own = [r for r in mixed if r["source"] == s]
        assert sum(r["taken"] for r in own) == int(own[0]["target"] + 1e-9)
        starts = sorted((c["position"], c["words"]) for r in own for c in r["copies"])
        assert len({at for at, _ in starts}) == len(starts)  # no two begin at one place
    told = lambda rows: sorted(((r["doc_id"], r["size"], r["taken"], str(r["copies"])) for r in rows), key=str)
    assert told(mixing.mix(docs.repartition(5), light=light).collect()) == told(mixed)
