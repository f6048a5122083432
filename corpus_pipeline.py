"""From raw documents to token ids: five stages, each the next one's input.

All stages hold for awkward tables: a null text counts as empty, rows that share an id stay or go together from the second stage
on, columns beyond doc_id and text pass through whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, exact_dedup, minhash, quality
from tidemark.llm.common import shared_dir, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier selects: neither toxic nor of low quality."""
    graded = quality.grades(table(spark, sf_dir, "labels"))
    return quality.select(docs, quality.train(docs, graded, 3), wanted=2)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity of 0.8), the document with the smallest id."""
    return minhash.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, in its own words or re-parameterised."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, and digests of the ids and of the decoded text."""
    return bpe.round_trip(docs, digest=True)


STAGES = [("quality classifier", keep_good), ("exact dedup", drop_copies), ("MinHash near-dedup", drop_near_copies), ("benchmark decontamination", drop_leaks), ("BPE encoding and decoding", encode)]

#: A trained model and a tokenizer decide here: SQL cannot say it. tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name.replace(' ', '-')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
