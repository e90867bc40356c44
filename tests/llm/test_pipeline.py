import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from roamrank.llm import jaccard_join, toxicity
from tests.llm.fixtures import awkward, words
from tests.llm.test_jaccard import brute
from tests.llm.test_mixing import filled
from tests.llm.test_pii import plain

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, key string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    rows, labels = [], []
    for i in range(400):
        text = words(rng, rng.randrange(8, 90)).split()
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(["idiota", "morona"]))
        if i % 7 == 0:
            text.insert(2, rng.choice(["a.b@mail.example.com", "10.20.30.40", "+1 (234) 555-0000", "4532015112830366"]))
        rows.append((i, " ".join(text), "abc"[i % 3]))
        labels.append((i, toxic))
    rows += [(1000 + i, rows[i * 7 + 1][1] + (" more" if i % 2 else ""), "a") for i in range(30)]
    rows += [(None if i is None else 2000 + i, t, None) for i, t in awkward()]
    folder = str(tmp_path_factory.mktemp("corpus"))
    full = [(i, t, "en", s, len(t or ""), "clash", "clash") for i, t, s in rows]
    spark.createDataFrame(full, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages_one_by_one(spark, corpus):
    """Each stage against a plain version over what the one before kept."""
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns = docs.columns
    order = lambda rows: sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
    stages = dict(corpus_pipeline.STAGES)

    def after(name, given):
        out = stages[name](spark, given, corpus)
        return corpus_pipeline.write_table(out, name)

    kept = after("toxicity", docs)
    assert kept.columns == columns
    labels = spark.read.parquet(f"{corpus}/labels.parquet")
    judged = toxicity.judge(docs.select("doc_id", "text"), labels).where("predicted = 0").select("doc_id", "text")
    assert order(kept.select("doc_id", "text").collect()) == order(judged.collect())
    bad = kept.where("text LIKE '%idiota%' OR text LIKE '%morona%'").count()
    clean = kept.where("doc_id < 400 AND doc_id % 4 <> 0").count()
    assert bad <= 3 and clean >= 297

    rows = [(r["doc_id"], r["text"], r["source"]) for r in kept.collect()]
    once = after("near_duplicates", kept)
    assert once.columns == columns
    sets, links, component = brute(rows)
    groups = {}
    for k, (s, c) in enumerate(zip(sets, component)):
        groups.setdefault(("empty", k) if not s else ("id", c) if c is not None else ("null", k), []).append(k)
    assert links and once.count() in (len(groups), len(groups) + 1)  # one id stands on two texts
    remaining = [(r["doc_id"], r["text"], r["source"]) for r in once.collect()]
    assert not brute(remaining)[1] and all(r in rows for r in remaining)

    clean = after("pii", once)
    assert clean.columns == columns and clean.count() == once.count()
    before = {r["doc_id"]: r["text"] for r in once.where("doc_id < 400").collect()}
    for r in clean.collect():
        assert not plain(r["text"]) and r["n_chars"] == len(r["text"] or "")
        if r["doc_id"] in before and not plain(before[r["doc_id"]]):
            assert r["text"] == before[r["doc_id"]]

    mixed = after("mixing", clean)
    assert mixed.columns == columns
    sizes = {}
    for r in clean.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s))
    longest = {s: 0 for s in names}
    taken = {s: 0 for s in names}
    for r in mixed.collect():
        n = len((r["text"] or "").split())
        taken[r["source"]] += n
        longest[r["source"]] = max(longest[r["source"]], n)
    for s, target in zip(names, filled([sizes[s] for s in names])):
        assert abs(taken[s] - target) <= longest[s] / 2 + 1

    packed = after("packing", mixed)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = sum(len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert packed.agg(F.sum("length")).first()[0] == ids
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_run_and_empty_tables(spark, corpus, tmp_path):
    assert corpus_pipeline.run(spark, corpus).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "pii", "mixing", "packing"]
    for name in ("documents", "labels"):
        spark.read.parquet(f"{corpus}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_document_of_each_group_is_that_of_its_component(spark):
    rng = random.Random(2)
    text = words(rng, 50)
    rows = [(i, text + " x" * (i % 3), "en", "s", 1, "c", "c") for i in range(9, 0, -1)]
    kept = jaccard_join.distinct_documents(spark.createDataFrame(rows, COLUMNS))
    assert [r["doc_id"] for r in kept.collect()] == [1]
