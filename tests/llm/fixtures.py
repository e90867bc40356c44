"""Small made-up tables with the awkward cases, and helpers."""

import random

from pyspark.sql import functions as F

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "an the of tion ing ed re ou st nd ea th ha wh he sh ti or er en at on in es ly ble is it as to".split()


def words(rng, n):
    return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def documents(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns of clashing names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCUMENTS)
    clash = ["key", "n", "class", "size", "rows", "slope", "score", "pii", "_hash", "piece", "position", "target"]
    return df.withColumns({c: F.lit("clash") for c in clash})


def awkward(rng=None):
    """Null and empty texts, null and repeated ids, equal rows, and a very long text."""
    rng = rng or random.Random(5)
    long = words(rng, 30_000)
    return [
        (1, words(rng, 80)),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (None, words(rng, 50)),
        (None, None),
        (5, "one two"),
        (5, "one two"),
        (5, words(rng, 40)),
        (6, long),
        (7, long + " tail"),
        (8, "x" * 50_000),
    ]
