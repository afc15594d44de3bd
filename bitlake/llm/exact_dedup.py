"""Exact deduplication by a tree merge of sorted digest runs (native).

Every row becomes ``(digest, check, bytes, id)``.  Rows are dealt to ``R``
runs, each run is combined and sorted by digest, and the runs are then merged
in rounds of fan-in ``2**RADIX_BITS``: in round ``r`` the runs whose numbers
differ only in digit ``r`` exchange parts, so that the new owner of a digest
has the digest's own digit there.  A merge joins equal entries only when digest,
byte length and a second, independent checksum all agree, and retains the
identifier that stays and the number of rows.  After the last round every
digest lies in exactly one run.  A digest has at most one entry per run, so a
text that fills a third of the table is ``R`` rows after the first step.

Defined cases: a null text counts as empty; a null ``doc_id`` ranks below
every other; of rows that repeat both text and ``doc_id`` exactly one is kept;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitlake.llm.common import shuffle_partitions, stage, text_or_empty

#: A merge takes 2**RADIX_BITS runs at a time.
RADIX_BITS = 2


def digest_rows(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.xxhash64(text).alias("check"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.monotonically_increasing_id().alias("row"))


def merge_runs(rows: DataFrame, keep: str = "largest") -> DataFrame:
    """``(digest, check, n_bytes, best, group_size)``, one row per text."""
    spark = rows.sparkSession
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep: {keep}")
    # One aggregate serves both rules: ids are compared as (id, row), negated
    # for the smallest; nulls rank last either way.
    sign = F.lit(1 if keep == "largest" else -1)
    best = F.struct(F.col("doc_id").isNotNull().alias("has"),
                    (F.coalesce(F.col("doc_id"), F.lit(0)) * sign).alias("rank"),
                    (-F.col("row")).alias("row"))
    digits = 1
    while 1 << (RADIX_BITS * digits) < shuffle_partitions(spark):
        digits += 1
    n_runs = 1 << (RADIX_BITS * digits)
    key = ["digest", "check", "n_bytes"]
    runs = (rows.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(n_runs)))
            .groupBy("run", *key)
            .agg(F.max(best).alias("best"), F.count(F.lit(1)).alias("group_size")))
    own = F.pmod(F.xxhash64("digest", "check"), F.lit(n_runs))
    for r in range(digits):
        mask = ((1 << RADIX_BITS) - 1) << (RADIX_BITS * r)
        owner = F.col("run").bitwiseAND(F.lit(n_runs - 1 - mask)).bitwiseOR(
            own.bitwiseAND(F.lit(mask)))
        runs = (runs.withColumn("run", owner)
                .repartition(n_runs, "run").sortWithinPartitions("run", *key)
                .groupBy("run", *key)
                .agg(F.max("best").alias("best"), F.sum("group_size").alias("group_size")))
    return runs.drop("run")


def exact_dedup(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = stage(digest_rows(docs), "digests")
    runs = merge_runs(rows, keep)
    key = ["digest", "check", "n_bytes"]
    sign = 1 if keep == "largest" else -1
    keep_id = F.when(F.col("best.has"), F.col("best.rank") * sign)
    return (rows.join(runs, key)
            .select("doc_id", keep_id.alias("keep_id"), "group_size",
                    (F.col("row") == -F.col("best.row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))


ORACLE = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""
