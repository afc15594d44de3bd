"""Training-corpus pipeline: documents through five of the operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet to the shared folder and reread as the next stage's documents.  All
but the last return the columns of their input.  No stage drops a row for being
null, empty, long or repeated as such; what each operator does with those is in
its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bitlake.llm import decontaminate, mixing, quality, sharding, simhash
from bitlake.llm.common import read_table, stage, text_or_empty

#: No stage before the mix can be said in SQL (a trained model, XXH64 majorities,
#: alignments); tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit(spark, docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(quality.scored(spark, model, text_or_empty()) >= quality.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the smallest id."""
    return simhash.keep_one(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(spark, docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_documents(docs)


def place(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ``slot`` and ``shard``."""
    return sharding.shard(docs)


STAGES = [("quality", keep_good), ("near-dedup", drop_near_copies), ("decontamination", drop_test_items),
          ("mixing", mix_sources), ("sharding", place)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
