import random
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from roamrank.llm import phrase_mining
from roamrank.llm.phrase_mining import _score, mine

KIND = "doc_id bigint, text string, lang string, id bigint, block string, a string, head int, phrase string"


def table(spark, rows):
    return spark.createDataFrame([(i, text, lang, 0, "x", "y", 1, "z") for i, (lang, text) in enumerate(rows)], KIND)


def plainly(rows, min_count, longest, top, percent=100):
    found, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    found[lang, tuple(words[i : i + n])] += 1
    candidates = {key: a for key, a in found.items() if len(key[1]) > 1 and a >= min_count}
    covered = set()
    for (lang, w), longer in candidates.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w) and 100 * longer >= percent * candidates[lang, w[i:j]]:
                    covered.add((lang, w[i:j]))
    out = []
    for lang in {key[0] for key in candidates}:
        scored = []
        for (own, w), a in candidates.items():
            if own == lang and (own, w) not in covered:
                cuts = []
                for k in range(1, len(w)):
                    l, r = found[lang, w[:k]], found[lang, w[k:]]
                    cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
                score, _, l, r = min(cuts)
                scored.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def drawn(seed):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "é", "日本", "a-b", "x", "y", "z", "É", " ", "\x1c"]
    signs = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "?!", "\r\n", " : "]
    rows = []
    for _ in range(60):
        text = "".join(rng.choice(vocabulary) + rng.choice(signs) for _ in range(rng.randrange(0, 60)))
        rows.append((rng.choice(["en", "en", "de", None, "und", ""]), text))
    rows += [("en", None), (None, ""), ("en", " \t,. "), ("fr", "one two"), ("fr", "one two"), ("fr", "one two")]
    return rows + [("en", "x y z . " * 3000), ("en", "same same same same same same same")]


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("settings", [(3, 5, 2000, 100), (2, 4, 7, 50), (5, 2, 2000, 100)])
def test_against_counting_everything(spark, monkeypatch, limit, settings):
    if limit is not None:
        monkeypatch.setattr(phrase_mining, "BROADCAST_BYTES", limit)
    rows = drawn(sum(settings))
    min_count, longest, top, percent = settings
    got = mine(table(spark, rows), min_count, longest, top, percent)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plainly(rows, *settings)


def test_repeated_rows_count_as_often(spark):
    rows = [("en", "to be or not to be")] * 100
    got = mine(table(spark, rows))
    assert sorted(map(tuple, got.collect())) == plainly(rows, 100, 5, 2000)
    assert {r["phrase"] for r in got.collect()} >= {"to be or not to", "be or not to be"}


def test_empty_tables_and_nothing_frequent(spark):
    for rows in ([], [("en", "a b c d")], [("en", None)]):
        got = mine(table(spark, rows))
        assert got.collect() == []
        assert dict(got.dtypes)["score"] == "bigint"


def test_products_beyond_64_bits_are_exact(spark):
    counts = [(10**12, 2 * 10**12 + 7, 3 * 10**12 + 1, 10**15 - 3), (5, 5, 5, 10**13), (10**12, 10**12, 10**12, 10**12)]
    df = spark.createDataFrame(
        [([l, a], [r, a], a, n) for a, l, r, n in counts], "heads array<bigint>, tails array<bigint>, a bigint, n bigint"
    )
    got = [tuple(r) for r in df.select(_score(2, F.col("n")).alias("s")).select("s.*").collect()]
    assert got == [(int(Fraction(1000 * a * n, l * r)), 1, l, r) for a, l, r, n in counts]


def test_lowest_cut_and_the_first_of_equals(spark):
    df = spark.createDataFrame(
        [([10, 4, 2], [10, 4, 2], 2, 100), ([5, 4, 2], [10, 8, 2], 2, 100)],
        "heads array<bigint>, tails array<bigint>, a bigint, n bigint",
    )
    got = [tuple(r) for r in df.select(_score(3, F.col("n")).alias("s")).select("s.*").collect()]
    assert got == [(5000, 1, 10, 4), (5000, 1, 5, 8)]
