import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roamrank.llm import packing
from tests.llm.fixtures import awkward, documents, words

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids if text else []


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aZé ß'sİı&-1२٣\x1c\x85\xa0 　́<|>"), st.characters(codec="utf-8")), max_size=40))
def test_ids_are_the_tokenizers(text):
    own = packing.Encoder(PATH) if not hasattr(test_ids_are_the_tokenizers, "e") else test_ids_are_the_tokenizers.e
    test_ids_are_the_tokenizers.e = own
    full = test_ids_are_the_tokenizers.__dict__.setdefault("t", Tokenizer.from_file(PATH))
    ids = np.frombuffer(own.encode(text), dtype="<u4").tolist()
    assert ids == full.encode(text, add_special_tokens=False).ids


def test_ids_of_the_given_texts(spark, tokenizer, encoder):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["<|endoftext|> <|ENDOFTEXT|> it's IT'S I'LL x'll", "a\x1cb a\x1db\x85c", "ﬁ Å Å ΑΣ ΣΑΣ", "e\u0301 \u0301e"]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == ids_of(tokenizer, text)


class Counted:
    """The tokenizer's model, and how often it is asked."""

    def __init__(self, model):
        self.model, self.calls = model, []

    def __getattr__(self, name):
        def asked(*args, **named):
            self.calls.append(args[0])
            return getattr(self.model, name)(*args, **named)

        return asked


def test_new_words_go_to_the_model_together_and_once(tokenizer):
    rng = random.Random(3)
    letters = ["".join(rng.choice("abcdefghiéü") for _ in range(9)) for _ in range(500)]
    text = " ".join(f"{w} {w.capitalize()}, {w.upper()}! {w}" for w in letters)
    encoder = packing.Encoder(PATH)
    encoder.model = Counted(encoder.model)
    assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == ids_of(tokenizer, text)
    assert len(encoder.model.calls) == 1
    encoder.encode(text)
    assert len(encoder.model.calls) == 1


@pytest.mark.parametrize("parts", [0, 40, 400_000])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_batches_of_texts(tokenizer, monkeypatch, parts, kind):
    """The ids don't depend on the batch, on what is remembered or on how much is learned at a time."""
    monkeypatch.setattr(packing, "PARTS", parts)
    monkeypatch.setattr(packing, "TOGETHER", 7)
    rng = random.Random(5)
    odd = ["a\x1cb a\x1db", "it's it's <|endoftext|>x <|ENDOFTEXT|>", "Öl, öl; ÖL*** ×a÷ ÿ Ÿ", "z" * 300 + "," + " é" * 30]
    plain = [None, "", "  \u3000 ", " a  b ", *[words(rng, 40) for _ in range(20)], "don't A1b2 é! ...", odd[1], odd[2], odd[3]]
    encoder = packing.Encoder(PATH)
    for texts in ([], [None, ""], plain, odd + plain, plain[::-1]):
        array = pa.array(["not this one", *texts], kind).slice(1)
        found = [np.frombuffer(ids, dtype="<u4").tolist() for ids in encoder.encode_all(array)]
        assert found == [ids_of(tokenizer, text) for text in texts]


def one_by_one(counts, capacity):
    """The same packing, a bin at a time."""
    left = dict(counts)
    bins = []
    while any(left.values()):
        here, gap = [], capacity
        while fits := [x for x, n in left.items() if n and x <= gap]:
            here.append(max(fits))
            left[here[-1]] -= 1
            gap -= here[-1]
        if len(here) > 1 and gap:
            room = gap + here[-1]
            best = max(
                (a + b for a, n in left.items() if n for b, m in left.items() if m and (a != b or n > 1) and a + b <= room),
                default=0,
            )
            if best > here[-1]:
                left[here.pop()] += 1
                gap = room - best
                bins.append(capacity - gap)
                a = max(a for a, n in left.items() if n and left.get(best - a, 0) > (a == best - a))
                left[a] -= 1
                left[best - a] -= 1
                continue
        bins.append(capacity - gap)
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_bins_are_bins_one_by_one(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 61): rng.randrange(1, 30) for _ in range(25)}
    bins = packing.plan(counts, 60)
    used = {}
    for b in bins:
        filled = sum(x * k for x, k in zip(b.lengths, b.times))
        assert filled <= 60 and b.offsets == np.cumsum([0, *[x * k for x, k in zip(b.lengths, b.times)]])[:-1].tolist()
        for x, k in zip(b.lengths, b.times):
            used[x] = used.get(x, 0) + k * b.many
    assert used == counts
    alone = one_by_one(counts, 60)
    assert abs(sum(b.many for b in bins) - len(alone)) <= 1


def check(rows, tokenizer, texts, capacity):
    """Every document whole, every sequence gapless and within its capacity."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in texts.items():
        ids = [*ids_of(tokenizer, text), 0]
        own = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // capacity)))
        for r in own:
            part = ids[r["start"] : r["start"] + capacity]
            assert len(part) == r["length"]
            assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r["ids_crc32"]


def test_packing(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET", 20)
    rng = random.Random(7)
    texts = {i: words(rng, rng.choice([1, 5, 30, 200])) for i in range(150)} | {200: None, 201: "", 202: words(rng, 900)}
    packed = packing.pack_documents(documents(spark, list(texts.items())), PATH, capacity=256)
    rows = packed.collect()
    check(rows, tokenizer, texts, 256)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= 1.02 * total / 256 + 1
    for s in packing.sequences(packed).collect():
        ids = np.frombuffer(s["ids"], dtype="<u4").tolist()
        for p in s["pieces"]:
            full = [*ids_of(tokenizer, texts[p["doc_id"]]), 0]
            start = 256 * p["piece"]
            assert ids[p["offset"] : p["offset"] + p["length"]] == full[start : start + 256]


def test_awkward_rows(spark, tokenizer):
    docs = documents(spark, awkward())
    rows = packing.pack_documents(docs, PATH, keep_ids=False).collect()
    unique = {i: t for i, t in awkward() if i not in (None, 5)}
    check(rows, tokenizer, unique, 2048)
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert sum(r["doc_id"] == 5 for r in rows) == 3
    assert packing.pack_documents(docs.limit(0), PATH).count() == 0


def test_repeated_rows_are_ranked_in_several_tasks(spark, tokenizer, monkeypatch):
    """One row 3,000 times: no bucket holds much more than its share, and all of them are packed."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(packing, "BUCKET", 100)
    docs = documents(spark, [(7, "the same text again")]).withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(3000))))
    docs = docs.repartition(4, "_n").drop("_n")
    cut = packing.write_table(packing.pieces(docs, PATH, 256, False), "pieces")
    sizes = [r["count"] for r in cut.groupBy(packing._bucket(31).alias("b")).count().collect()]
    assert sum(sizes) == 3000 and len(sizes) > 10 and max(sizes) <= 1000
    rows = packing.pack(cut, 256).collect()
    ids = [*ids_of(tokenizer, "the same text again"), 0]
    assert len(rows) == len({(r["sequence_id"], r["offset"]) for r in rows}) == 3000
    assert all(r["length"] == len(ids) and r["offset"] % len(ids) == 0 for r in rows)
    assert len({r["sequence_id"] for r in rows}) == -(-3000 // (256 // len(ids)))


def test_large_ids_beside_null_ids(spark):
    """No id becomes a floating-point number on its way."""
    docs = spark.createDataFrame([(2**53 + 1, "a b"), (None, "c"), (-(2**62) - 1, None)], "doc_id bigint, text string")
    rows = packing.pack_documents(docs.coalesce(1), PATH, keep_ids=False).collect()
    assert {r["doc_id"] for r in rows} == {2**53 + 1, None, -(2**62) - 1}


def test_runs_are_gathered_in_the_order_asked_for():
    pool, ends = packing._gather(np.arange(10, dtype="<u4"), np.array([3, 0, 5, 2]), np.array([2, 1, 0, 2, 3]))
    assert pool.tolist() == [3, 4, 5, 6, 7, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9] and ends.tolist() == [5, 5, 8, 13, 15]
    pool, ends = packing._gather(np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert not len(pool) and not len(ends)
