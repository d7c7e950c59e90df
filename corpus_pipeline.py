"""The training-data pipeline: stages over ``documents``, each written and read again.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps with all their columns; the
last returns the packed pieces.

Defined cases, in any stage: null, empty and blank texts have no n-gram, so the first stage rejects them unless no label is
good, and later stages treat a null text as empty; rows that repeat id and text share their fate up to the second stage,
which keeps one; rows without an id are rows like others; very long texts are read whole; extra columns, whatever their
names, pass through all stages but the last; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import importance, mixing, packing, repeats, simhash
from shelfcast.llm.common import bound_batches, table
from shelfcast.sources.staging import stage


def _tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws."""
    return importance.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints: shingles of three words, 2 bits."""
    bound_batches(spark)
    return simhash.keep_one(docs, radius=2, shingle=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 100 bytes that start earlier in the corpus."""
    bound_batches(spark)
    return repeats.remove_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to one and a half times."""
    bound_batches(spark)
    return mixing.mix(docs, _tokenizer())


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    bound_batches(spark)
    return packing.pack(docs, _tokenizer())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("mixture", mixture), ("packing", packed)]
#: SQL has no shingle hash, tokenizer or suffix index; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), name)
    return docs
