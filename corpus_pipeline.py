"""The corpus pipeline: five operators in a row over `documents`, each on all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and gives a DataFrame; the caller writes it and hands it, read again, to the next.
All stages but the last give the columns of `documents`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from siftworks.llm import bpe, exact_dedup, mixing, simhash, toxicity
from siftworks.llm.common import checkpoint_dir


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that score 0.5 or more go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of texts that are equal without white space one stays."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group linked by five-word shingles at similarity 0.8 or more the document with the least id stays."""
    return simhash.drop_near_duplicates(docs, width=5, similarity=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents, or runs of their words, as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: token counts and digests of the ids and of the decoded text."""
    return bpe.digests(docs, bpe.tokenizer_path())


STAGES = [("toxicity", clean), ("exact_dedup", exact), ("simhash", near), ("mixing", mix), ("bpe", encode)]

#: Scores come from a fitted model and fingerprints and token ids from code that SQL has no words for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written to the shared folder and read again."""
    root = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
