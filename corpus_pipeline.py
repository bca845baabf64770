"""From documents to training tokens: each stage works on all that the one before kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillstar.llm import bpe, decontaminate, near, passages, toxicity
from tillstar.sinks.writers import shared_folder

#: The columns of documents; n_chars stays that of the text as it came.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the network, trained on the labelled ones, doesn't find toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    scored = toxicity.toxicity(docs, model, keep=COLUMNS)
    return scored.where("predicted = 0").select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near.without_near_duplicates(docs).select(*COLUMNS)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages that an earlier one has."""
    return passages.without_repeats(docs).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the passages that benchmark items have too."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(docs, benchmark, keep=COLUMNS, clean=True).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with their number and digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN, keep=["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", harmless),
    ("near_dedup", distinct),
    ("substring_dedup", unrepeated),
    ("decontamination", decontaminated),
    ("byte_bpe", encoded),
]

#: SQL has no tokenizer and no trained network; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each writes its table, which the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
