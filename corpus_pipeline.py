"""Corpus pipeline: filters, near-duplicate removal, sanitising and packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that its
predecessor kept; ``sf_dir`` is read only for the labelled documents that the
two classifiers are trained on. Stages are written as Parquet under the shared
checkpoint folder and read again, so a lost executor never costs more than the
stage at hand. All stages but the last return the columns of ``documents``.

Corner cases (each operator's docstring has its own): null and empty texts go
through every stage like short documents; rows with equal ids and texts form
one near-duplicate group; columns beyond those of ``documents`` are carried; an
empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan.llm import packing, pii, quality, simhash, toxicity
from sylvan.llm.common import read, small_batches
from sylvan.llm.queries import SIMHASH_DISTANCE, SIMHASH_SHINGLE
from sylvan.session import Scratch

#: Bytes of words that a worker of the packing stage holds: its process also
#: keeps what the stages before it loaded.
WORD_CACHE = 64_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    small_batches(spark)
    model = toxicity.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "toxic", modulus=3, held_out=1)
    return docs.where(toxicity.score_column(model) < toxicity.THRESHOLD)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    small_batches(spark)
    model = quality.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "quality", modulus=5, held_out=0)
    return docs.where(quality.score_column(model) >= quality.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id."""
    return simhash.keep_one(docs, shingle=SIMHASH_SHINGLE, max_distance=SIMHASH_DISTANCE)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that give it away are replaced in the text."""
    return pii.sanitise_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece of a document."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=0, word_cache=WORD_CACHE)
    return pieces.withColumn("ids_crc32", packing.ids_crc32(F.col("ids")))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", sanitise),
    ("packing", pack),
]

#: Trained models and tokenising cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
