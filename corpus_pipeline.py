"""Training-corpus pipeline: raw documents to packed token sequences.

Each stage takes all rows its predecessor kept and returns a DataFrame that is
written as Parquet and read back as the next stage's input; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from revline.llm import exact_dedup, langid, packing, probminhash, quality_fm
from revline.session import write_scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; learned from every label of the table."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_fm.keep_good(docs, quality_fm.train(docs, labels))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and those too far from every language of the table."""
    return langid.keep_determined(docs, langid.train(docs, farthest=True))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each exact text, the one with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates, the one with the smallest id."""
    return probminhash.keep_one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's tokens at their place in sequences of 1024."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("packing", pack),
]

#: models and tokens: no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = write_scratch(stage(spark, rows, sf_dir), "pipeline-" + name.split()[0].lower())
    return rows
