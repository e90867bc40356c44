"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamrank.llm import (
    chat_tree,
    fill_middle,
    html_mincut,
    inverted_multi_index,
    jaccard_join,
    mixing,
    packing,
    phrase_mining,
    pii,
    super_kmers,
    topk_blocks,
    toxicity,
    warc,
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts of base spans, their digest, and all spans."""
    found = pii.detect(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans")
    )


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_mincut.extract(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.judge(docs, labels).select("doc_id", "held_out", "score", "predicted")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of one and a half times all words takes of every document, in training order."""
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"), light=True)
    return mixing.in_order(mixed).select("doc_id", "size", "source_size", "target", "taken")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back: responses with payload, revisits by header alone."""
    path = warc.write_pages(read(spark, sf_dir, "pages"))
    full = warc.scan(spark, path).where("record_type = 'response'")
    brief = warc.scan(spark, path, "record_id", "record_type", "refers_to", "payload_digest", "payload_length")
    responses = full.select(
        warc.page_id(F.col("record_id")).alias("page_id"),
        F.length("payload").cast("bigint").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.lit(None).cast("bigint").alias("refers_to"),
    )
    revisits = brief.where("record_type = 'revisit'").select(
        warc.page_id(F.col("record_id")).alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        warc.page_id(F.col("refers_to")).alias("refers_to"),
    )
    return responses.unionByName(revisits)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows, by the product of integer components, for every fiftieth vector."""
    found = topk_blocks.search(read(spark, sf_dir, "embeddings"))
    return found.select("query_id", "rank", "vec_id", "score")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(read(spark, sf_dir, "documents"), path, keep_ids=False)


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest rows found for every twentieth vector."""
    return inverted_multi_index.search(read(spark, sf_dir, "embeddings"))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set and the smallest id that links reach."""
    return jaccard_join.grouped(read(spark, sf_dir, "documents").select("doc_id", "text"))


# A conversation whose texts hold the control strings of common templates.
HARD = r"\### Assistant: </turn> ok"


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one of control strings, formatted as prefix trees and read back."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HARD).alias("text"),
    )
    return chat_tree.digests(chat_tree.packs(rows.unionByName(added)))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with prefix, middle and suffix reordered, and its text rebuilt from that."""
    made = fill_middle.transform(read(spark, sf_dir, "documents"))
    digests = {
        "output_sha256": F.sha2(F.col("output").cast("binary"), 256),
        "restored_sha256": F.sha2(fill_middle.restored(F.col("output"), F.col("form")).cast("binary"), 256),
    }
    return made.withColumns(digests).drop("output")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's phrases that occur most above what their parts suggest."""
    return phrase_mining.mine(read(spark, sf_dir, "documents"))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 35 words and more that also stand elsewhere."""
    kept = super_kmers.without_repeats(read(spark, sf_dir, "documents"))
    return kept.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_html": op2_html,
    "op3_toxicity": op3_toxicity,
    "op4_mixing": op4_mixing,
    "op5_warc": op5_warc,
    "op6_topk": op6_topk,
    "op7_packing": op7_packing,
    "op8_ann": op8_ann,
    "op9_jaccard": op9_jaccard,
    "op10_chat": op10_chat,
    "op11_fim": op11_fim,
    "op12_phrases": op12_phrases,
    "op13_repeats": op13_repeats,
}
