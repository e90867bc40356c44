"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet and hands what it reads back to the next. All but the last return the columns
of the documents. Nulls, empty tables and repeated rows are as in the operators; other
columns pass through up to the packing. Documents without words (null, empty or white
space only) end at the mixing stage: they have no share of the mix and no place in it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamrank.llm import jaccard_join, mixing, packing, pii, toxicity
from roamrank.workspace import write_table


def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    return docs.where(toxicity.score(F.coalesce("text", F.lit("")), model) < toxicity.CUT)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 0.8 join up, the one with the smallest doc_id."""
    return jaccard_join.distinct_documents(docs)


def personal_data_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by their kinds; ``n_chars`` follows the text."""
    told = docs.withColumn("text", pii.redact(F.col("text"), pii.fit(docs)))
    if "n_chars" not in docs.columns:
        return told
    kind = docs.schema["n_chars"].dataType
    return told.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind))


def sources_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's share of the mix in training order; a document taken twice is two rows, one without words none."""
    return mixing.training_rows(docs)


def sequences_packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their places in sequences of 2048 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, path, keep_ids=False)


STAGES = [
    ("toxicity", toxic_documents_go),
    ("near_duplicates", one_of_each_group),
    ("pii", personal_data_redacted),
    ("mixing", sources_mixed),
    ("packing", sequences_packed),
]

#: A trained classifier decides the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
