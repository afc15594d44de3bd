"""Log-line views over the driver's tables, and a writer for real log folders.

``event_log_lines``: the fixture view of FIXTURES.md section 4 (edge cases:
bad times, short lines, empty lists, empty list elements, extra positions).
``lineitem_log_lines``: the scale view (sf0.1 is ~600,000 lines), one folder
per ship month and bucket.
Both return the line schema of :mod:`bitlake.sources.logs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows of a table of few row groups.  For these views only:
    real log folders have a file, and so a task, per bucket and more."""
    par = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(par) if df.rdd.getNumPartitions() < par else df


#: Order keys of one view file; files stay this small at any scale.
ORDERS_PER_FILE = 4_000_000


def _finish(df: DataFrame, value, dt, part, file_key) -> DataFrame:
    df = spread(df)
    lines = df.select(
        value.alias("value"),
        dt.alias("dt"),
        part.cast("int").alias("part"),
        F.concat(F.lit("pixel/dt="), F.date_format(dt, "yyyy-MM-dd"),
                 F.lit("/part="), part.cast("string"), F.lit("/"),
                 file_key.cast("string"), F.lit(".gz")).alias("file_path"),
    )
    # Synthetic file size: bytes of the file's lines, each with its LF.
    w = Window.partitionBy("file_path")
    return lines.withColumn("file_size", F.sum(F.length("value") + 1).over(w).cast("long"))


def event_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    eid = F.col("event_id")
    et = F.col("event_type")
    ts_raw = F.when(eid % 97 == 0, F.lit("not-a-time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    idfield = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"), (eid % 20).cast("string"))
    cfield = F.concat(F.lit("k"), F.get_json_object("props", "$.k"))
    sfield_list = (F.when(eid % 7 == 0, F.lit(""))
                   .when(eid % 11 == 0, F.concat(et, F.lit(",,"), et))
                   .otherwise(F.concat(et, F.lit(",v"), F.floor("value").cast("string"))))
    four = F.concat_ws("\t", ts_raw, idfield, cfield, et)
    five = F.concat_ws("\t", four, sfield_list)
    value = (F.when(eid % 101 == 0, four)
             .when(eid % 13 == 0, F.concat(five, F.lit("\textra")))
             .otherwise(five))
    dt = F.to_date("ts")
    return _finish(ev, value, dt, eid % 8, F.floor(eid / 500))


def lineitem_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    ok = F.col("l_orderkey")
    value = F.concat_ws(
        "\t",
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
        F.concat(F.lit("o"), ok.cast("string")),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string"), F.lit(",q"),
                 F.floor("l_quantity").cast("string")),
    )
    # Folder day = first day of the ship month (a log folder per month and
    # bucket keeps files large); the line's own time is the ship date.
    return _finish(li, value, F.trunc(F.to_date("l_shipdate"), "MM"), ok % 16,
                   F.expr(f"l_orderkey div {ORDERS_PER_FILE}"))


def write_log_files(lines: DataFrame, root: str) -> str:
    """Write lines as ``<root>/dt=/part=/`` gzip text files (a real log folder).

    The lines of a folder go to one writer task (AQE splits a large folder by its
    bytes), so the number of files follows the folders and the bytes, not
    folders times tasks.
    """
    (lines.select("value", "dt", "part")
     .hint("rebalance", "dt", "part")
     .write.partitionBy("dt", "part")
     .option("compression", "gzip")
     .mode("errorifexists")
     .text(root))
    return root
