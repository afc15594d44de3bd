"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bitlake.llm import (decontaminate, exact_dedup, html_extract, mixing, packing, quality, ranked_search, secret_scan, sharding,
                         simhash, substring_dedup, suffix_array_dedup, whitening)
from bitlake.llm.common import read_table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(spark, read_table(spark, sf_dir, "documents"),
                                       read_table(spark, sf_dir, "benchmark"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"), keep="largest")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(read_table(spark, sf_dir, "documents")))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_dedup.suffix_array_dedup(read_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(read_table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(read_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_quality, op2_substring_dedup, op3_decontamination, op4_html_extraction, op5_exact_dedup, op6_sharding,
    op7_mixing, op8_suffix_array_dedup, op9_simhash, op10_secret_scan, op11_whitening, op12_ranked_search, op13_packing)}


def oracle_sql() -> dict[str, str]:
    return {"op2_substring_dedup": substring_dedup.ORACLE, "op5_exact_dedup": exact_dedup.ORACLE,
            "op6_sharding": sharding.oracle(), "op7_mixing": mixing.ORACLE,
            "op8_suffix_array_dedup": suffix_array_dedup.ORACLE, "op12_ranked_search": ranked_search.ORACLE}
