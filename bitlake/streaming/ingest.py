"""Load runs: report (A15); the batch and streaming loads live in
:mod:`bitlake.streaming.load`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import parse_lines
from ..spec import LogSpec


def ingest_report(lines: DataFrame, spec: LogSpec = LogSpec(), inventory: DataFrame | None = None) -> DataFrame:
    """Per file the number of lines, rejected lines and lines whose
    time did not parse, with its size; plus one total row (file NULL).

    With ``inventory`` every listed file appears, files without lines with 0.
    """
    p = parse_lines(lines, spec)
    short = F.col("n_pos") < F.lit(spec.min_positions)
    per_file = (p.groupBy("dt", "part", "file_path")
                .agg(F.max("file_size").cast("long").alias("file_size"),
                     F.count(F.lit(1)).cast("long").alias("n_lines"),
                     F.sum(F.when(short, 1).otherwise(0)).cast("long").alias("n_rejects"),
                     F.sum(F.when(~short & F.col("ts").isNull(), 1).otherwise(0)).cast("long").alias("n_bad_time")))
    if inventory is not None:
        per_file = (inventory.select("dt", "part", "file_path", F.col("file_size").alias("_size"))
                    .join(per_file.drop("file_size"), ["dt", "part", "file_path"], "left")
                    .select("dt", "part", "file_path", F.col("_size").cast("long").alias("file_size"),
                            *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                              for c in ("n_lines", "n_rejects", "n_bad_time")]))
    total = per_file.agg(
        F.lit(None).cast("date").alias("dt"), F.lit(None).cast("int").alias("part"),
        F.lit(None).cast("string").alias("file_path"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
          for c in ("file_size", "n_lines", "n_rejects", "n_bad_time")])
    return per_file.unionByName(total)
