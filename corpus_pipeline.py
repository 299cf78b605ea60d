"""A training corpus from ``documents``: identified, deduplicated, mixed and encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.llm import bpe, exact_dedup, language, mixing, simhash
from factline.sources.storage import write_shared

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Most rows of an Arrow batch, which hold whole texts here.
BATCH = 1024


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's rows of an Arrow batch to ``BATCH``, so that neither a worker nor its executor holds many texts at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH:
        spark.conf.set(name, BATCH)


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that documents state, as learned from all that do."""
    small_batches(spark)
    return language.keep_identified(docs, language.train(docs))


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts with a similarity of 0.8 or more by five-word shingles, the document with the smallest id."""
    small_batches(spark)
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a shard of the mix is in one file, in its shuffled order."""
    return mixing.mix(docs).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, and whether they decode to its text."""
    small_batches(spark)
    encoded = bpe.encode_checked(docs, TOKENIZER, ["doc_id", "lang", "source"])
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [("language", identify), ("exact_dedup", dedup_exact), ("near_dedup", dedup_near), ("mixing", mix_sources), ("bpe", encode)]

#: Fingerprints, language models and merges aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
