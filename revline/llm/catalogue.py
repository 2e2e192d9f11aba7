"""Queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revline.llm import (
    backoff,
    exact_dedup,
    extraction,
    fim,
    langid,
    merkle,
    nbest,
    packing,
    probminhash,
    quality_fm,
    sharding,
    simhash,
    urlfilter,
)
from revline.session import scratch_path

#: UTF-8 bytes of text in a shard
SHARD_BYTES = 16 << 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprints_of_edits(_table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.written_shards(_table(spark, sf_dir, "documents"), scratch_path(spark, "shards"), SHARD_BYTES)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.held_out_languages(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.held_out_quality(_table(spark, sf_dir, "documents"),
                                       _table(spark, sf_dir, "labels"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urlfilter.train(urlfilter.seed_table(spark))
    return urlfilter.judge_urls(_table(spark, sf_dir, "pages"), model)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff.backoff_scores(_table(spark, sf_dir, "documents"))
    return (scored.withColumn("log_score", F.round("log_score", 4))
            .withColumn("mean_log_score", F.round("mean_log_score", 6)))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"))


def op10_nbest_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.encode_nbest(_table(spark, sf_dir, "documents"),
                              public_tokenizers.path("piece_bpe_32k.model"), packed=True)


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_main_text(_table(spark, sf_dir, "pages"), extraction.train())


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.round_trip(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_test(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": corpus_pipeline.run} | {f.__name__: f for f in (
        op1_document_fingerprints,
        op2_sharding,
        op3_language_id,
        op4_quality_classifier,
        op5_url_filters,
        op6_minhash_near_dedup,
        op7_lm_scoring,
        op8_exact_dedup,
        op9_packing,
        op10_nbest_segmentation,
        op11_html_extraction,
        op12_fill_in_middle,
        op13_merkle_manifest,
    )}


def oracles() -> dict[str, str]:
    from revline.llm import oracle_sql
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return dict(oracle_sql.ORACLES) | pipeline
