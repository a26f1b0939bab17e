"""A training corpus from raw documents: language, near copies, repeated passages, secrets, packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from canopycast.llm.language_id import accepted, train
from canopycast.llm.ngram_join import one_of_each
from canopycast.llm.packing import pack
from canopycast.llm.queries import documents, vocabulary
from canopycast.llm.secrets import redact
from canopycast.llm.substring_dedup import without_repeats
from canopycast.sources.staging import staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from the labelled ones."""
    return accepted(docs, train(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its runs of five words."""
    return one_of_each(docs, n=5, percent=80)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every repeated passage in its first document only."""
    return without_repeats(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials that look live are masked; widely copied examples stay."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the pieces of every document lie in the training sequences."""
    return pack(docs, vocabulary("byte_bpe_50k.json"), keep_ids=False).drop("ids")


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", passages),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: Trained models, MinHash and the tokenizer are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over what the one before kept, written and read again between them."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, name.replace(" ", "-"))
    return docs
