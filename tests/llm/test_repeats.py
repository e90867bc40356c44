import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roamrank.llm import super_kmers
from roamrank.llm.super_kmers import without_repeats
from roamrank.operators import joins
from tests.llm.fixtures import awkward, documents, words


def plainly(rows, window=35):
    """All windows counted in a dictionary."""
    split = [(doc_id, (text or "").encode().split()) for doc_id, text, *_ in rows]
    found = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = []
    for doc_id, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if found[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, no in zip(w, gone) if not no).decode()
        out.append((doc_id, len(w), sum(gone), kept))
    return sorted(out, key=str)


def drawn():
    rng = random.Random(3)
    passage, line, whole = words(rng, 90), words(rng, 12), words(rng, 60)
    rows = awkward(rng)
    for i in range(40):
        # One passage in many documents, each with other words around it, and a short line.
        rows.append((100 + i, f"{words(rng, 50)} {passage} {line}\n{words(rng, 40)}"))
    rows += [(200 + i, whole) for i in range(25)]  # copies
    rows += [(240 + i, whole + f" tail{i}") for i in range(25)]  # near copies
    rows += [(300, whole)] * 3 + [(None, whole)] * 2  # repeated rows
    rows += [(310, words(rng, 34)), (311, words(rng, 35))]
    short = words(rng, 34)
    rows += [(312, short), (313, short)]  # copies shorter than a window
    own = words(rng, 36)
    rows += [(320, f"{own} x {own}"), (321, "a " * 200), (322, "b c " * 40), (323, "a " * 40 + "z")]
    rows += [(330, own.replace(" ", " \t\n")), (331, "é日  x " * 60), (332, passage.upper())]
    return rows


@pytest.mark.parametrize("way", ["buckets", "hot", "large"])
def test_against_counting_every_window(spark, monkeypatch, way):
    if way != "buckets":
        monkeypatch.setattr(super_kmers, "HOT", 3)
        monkeypatch.setattr(super_kmers, "TASK_BYTES", 10_000)
    if way == "large":
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(joins, "ROWS_PER_TASK", 20)
    rows = drawn()
    got = without_repeats(documents(spark, rows).repartition(5))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == plainly(rows)


@pytest.mark.parametrize("window,minimiser", [(1, 1), (2, 1), (5, 2), (8, 8), (35, 1)])
def test_other_windows(spark, window, minimiser):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(30)]
    got = without_repeats(documents(spark, rows), window, minimiser)
    assert sorted(map(tuple, got.collect()), key=str) == plainly(rows, window)


def test_frequent_minimisers_go_one_by_one(spark):
    docs = documents(spark, drawn())
    texts = super_kmers._keyed(docs, "doc_id").withColumn("copied", F.lit(False))
    counts = super_kmers.minimiser_counts(texts, 35, 7).where("n > 3")
    assert counts.count() > 5
    packed = super_kmers.super_kmers(texts, 35, 7)
    sums = packed.groupBy("minimiser").agg(F.count("*").alias("n")).where("n > 3")
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, sums.collect()))


def test_super_kmers_hold_every_window_once(spark):
    rows = drawn()
    docs = documents(spark, rows).select("doc_id", "text")
    texts = super_kmers._keyed(docs, "doc_id").withColumn("copied", F.lit(False))
    found = Counter()
    for row in super_kmers.super_kmers(texts, 35, 7).collect():
        w = bytes(row["packed"]).split(b" ")
        assert len(w) >= 35
        found.update((bytes(row["key"]), row["first"] + t, tuple(w[t : t + 35])) for t in range(len(w) - 34))
    expected = Counter()
    for row in texts.collect():
        w = bytes(row["raw"]).split()
        expected.update((bytes(row["key"]), t, tuple(w[t : t + 35])) for t in range(len(w) - 34))
    assert found == expected


def test_empty_table_and_wrong_parts(spark):
    assert without_repeats(documents(spark, [])).count() == 0
    assert [tuple(r) for r in without_repeats(documents(spark, [(1, None)])).collect()] == [(1, 0, 0, "")]
    with pytest.raises(ValueError):
        without_repeats(documents(spark, []), 5, 6)


def test_windows_alone_in_small_parts(spark, monkeypatch):
    monkeypatch.setattr(super_kmers, "HOT", 2)
    monkeypatch.setattr(super_kmers, "AT_ONCE", 50)
    rows = drawn()
    got = without_repeats(documents(spark, rows).repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == plainly(rows)


def test_words_hash_by_their_bytes_alone():
    import numpy as np
    import pyarrow as pa

    from roamrank.llm.texts import Words, buffer_of

    rng = random.Random(9)
    texts = [b" ".join(bytes(rng.choices(b"abc\xc3\x00", k=rng.choice([1, 2, 7, 8, 9, 16, 17, 255, 256, 257, 900]))) for _ in range(50))
             for _ in range(40)] + [b"", b"abc ab abc"]
    found = {}
    words = Words(*buffer_of(pa.array(texts, pa.binary())), super_kmers.SPACES)
    hashes = words.hashes()
    listed = [w for t in texts for w in t.split()]
    assert len(listed) == len(words) == len(hashes)
    for word, value in zip(listed, hashes.tolist()):
        assert found.setdefault(word, value) == value
    assert len(set(found.values())) == len(found)
    assert np.array_equal(hashes, words.hashes())
