"""The registered queries of the corpus operators and their SQL answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm import (
    alignment, chat, codes, decontamination, language, licenses, packing, quality, sharding, simhash,
    spotsigs, substrings, wavelet,
)

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": lambda spark, sf: decontamination.contained_items(
            _documents(spark, sf), _benchmark(spark, sf)),
        "op2_spotsigs": lambda spark, sf: spotsigs.fingerprints(_documents(spark, sf)),
        "op3_simhash": lambda spark, sf: simhash.near_duplicates(_documents(spark, sf)),
        "op4_sharding": lambda spark, sf: sharding.shards(_documents(spark, sf)),
        "op5_substrings": lambda spark, sf: substrings.digests(_documents(spark, sf)),
        "op6_packing": lambda spark, sf: packing.pack(_documents(spark, sf)),
        "op7_chat": lambda spark, sf: chat.digests(
            chat.with_control(spark.read.parquet(f"{sf}/conversations.parquet"))),
        "op8_language": lambda spark, sf: language.languages(_documents(spark, sf)),
        "op9_licenses": lambda spark, sf: licenses.labels(_documents(spark, sf)),
        "op10_quality": lambda spark, sf: quality.scores(
            _documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")),
        "op11_alignment": lambda spark, sf: alignment.alignments(_documents(spark, sf)),
        "op12_wavelet": lambda spark, sf: wavelet.token_files(_documents(spark, sf)),
        "op13_codes": lambda spark, sf: codes.product_codes(spark.read.parquet(f"{sf}/embeddings.parquet")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontamination.contained_sql(),
        "op7_chat": chat.digests_sql(),
        "op13_codes": codes.product_codes_sql(),
    }
