"""Named queries of this subpackage over the sample tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tillstar.llm import (
    bpe, collocations, counts, decontaminate, licences, near, pages, passages, quality,
    sharding, spelling, toxicity, urls,
)

SHARDS = 40


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_byte_bpe(spark, folder):
    documents = _table(spark, folder, "documents")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(
        documents, path, public_tokenizers.PATTERN, keep=["doc_id"], with_ids=False
    )


def op2_near_duplicates(spark, folder):
    documents = _table(spark, folder, "documents")
    return near.near_duplicates(documents, words=2).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op3_passages(spark, folder):
    spans = passages.repeated_spans(_table(spark, folder, "documents"))
    return spans.select(F.col("id").alias("doc_id"), F.explode("spans").alias("span")).select(
        "doc_id", F.col("span.start").alias("start_char"), F.col("span.end").alias("end_char"),
        F.col("span.words").alias("n_words"), F.col("span.kept_id").alias("kept_doc_id"),
    )


def op4_toxicity(spark, folder):
    documents, labels = (_table(spark, folder, n) for n in ("documents", "labels"))
    scored = toxicity.toxicity(documents, toxicity.fit(documents, labels), keep=["doc_id"])
    held_out = F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_decontamination(spark, folder):
    documents, benchmark = (_table(spark, folder, n) for n in ("documents", "benchmark"))
    return decontaminate.contaminated(documents, benchmark, keep=["doc_id"]).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op6_sharding(spark, folder):
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    dealt = sharding.shuffled_shards(documents.withColumn("size", size), SHARDS)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return dealt.select(
        "doc_id", "size", crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_quality(spark, folder):
    return quality.quality(_table(spark, folder, "documents"), keep=["doc_id"])


def op8_licences(spark, folder):
    return licences.licences(_table(spark, folder, "documents"), keep=["doc_id"], with_spans=False)


def op9_token_counts(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return counts.token_counts(_table(spark, folder, "documents"), path, keep=["doc_id"])


def op10_urls(spark, folder):
    return urls.judged_urls(_table(spark, folder, "pages"), keep=["page_id"])


def op11_spelling(spark, folder):
    counts = spelling.word_counts(_table(spark, folder, "documents"), least=7, damage=31)
    return spelling.variants(counts, least=2, ratio=10)


def op12_collocations(spark, folder):
    documents = _table(spark, folder, "documents")
    return collocations.collocations(documents, longest=4, least=30, most=2000)


def op13_main_text(spark, folder):
    return pages.main_text(_table(spark, folder, "pages"), keep=["page_id", "url"])


def queries():
    every = (
        op1_byte_bpe, op2_near_duplicates, op3_passages, op4_toxicity, op5_decontamination,
        op6_sharding, op7_quality, op8_licences, op9_token_counts, op10_urls,
        op11_spelling, op12_collocations, op13_main_text,
    )
    return {f.__name__: f for f in every}
