"""Log sources: day/bucket-partitioned gzip text files.

Folder layout ``<root>/dt=<YYYY-MM-DD>/part=<int>/<file>.gz``.  Spark infers
``dt`` as date and ``part`` as int, so day and bucket selection are partition
filters.  With a date range we also hand Spark only the day folders inside it,
so that the file listing itself (not only the scan) is pruned.
"""

from __future__ import annotations

import datetime as _dt
import re
import urllib.parse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import _fs, path_exists
from ..spec import ScanConfig

LINE_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("dt", T.DateType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("file_size", T.LongType()),
])

INVENTORY_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("dt", T.DateType()),
    T.StructField("part", T.IntegerType()),
])



def _as_date(d) -> _dt.date | None:
    if d is None or isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))


def day_folders(spark: SparkSession, root: str, start=None, end=None) -> list[str]:
    """Existing ``dt=`` folders of ``root`` with start <= dt <= end (inclusive).

    One directory listing of the top level; the number of days is small even
    when the number of files is in the hundreds of millions.
    """
    start, end = _as_date(start), _as_date(end)
    if not path_exists(spark, root):
        return []
    fs, p = _fs(spark, root)
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith("dt=")):
            continue
        try:
            day = _dt.date.fromisoformat(name[3:])
        except ValueError:
            continue
        if (start is None or day >= start) and (end is None or day <= end):
            out.append(st.getPath().toString())
    return sorted(out)


_GLOB = str.maketrans({c: "\\" + c for c in "\\[]{}*?"})


def literal_path(path: str) -> str:
    """``path`` with the characters quoted that ``load`` takes for a pattern."""
    return path.translate(_GLOB)


def plain_path(c: Column) -> Column:
    """The text source's URL-encoded ``_metadata.file_path`` as the plain path
    that the inventory has."""
    plain = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def _load(spark: SparkSession, fmt: str, root: str, paths, options: dict) -> DataFrame | None:
    r = spark.read.format(fmt)
    for k, v in options.items():
        r = r.option(k, v)
    if paths is None:
        return r.load(literal_path(root))
    if len(paths) == 0:
        # load([]) would lose the partition columns: the caller builds an
        # empty frame with the right schema instead.
        return None
    return r.option("basePath", root).load([literal_path(p) for p in paths])


def read_log_lines(spark: SparkSession, root: str, paths=None, start=None, end=None) -> DataFrame:
    """A1 ``log_scan``: one row per text line with day, bucket and file.

    ``lineSep`` is pinned to LF: Spark's default also breaks at a lone CR.
    ``paths`` are taken literally, whatever characters they have.
    """
    if paths is None and (start is not None or end is not None):
        paths = day_folders(spark, root, start, end)
    df = _load(spark, "text", root, paths, {"lineSep": "\n"})
    if df is None:
        return spark.createDataFrame([], LINE_SCHEMA)
    out = df.select(
        "value",
        F.col("dt").cast("date").alias("dt"),
        F.col("part").cast("int").alias("part"),
        plain_path(F.col("_metadata.file_path")).alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    )
    return scan_date_range(out, start, end)


def check_files_read(lines: DataFrame, paths: list[str]) -> None:
    """Raise unless a scan reads exactly the files ``paths``."""
    def norm(p):
        return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):/+(?=/)", r"\1:", p)
    got = {norm(urllib.parse.unquote(p)) for p in lines.inputFiles()}
    want = {norm(p) for p in paths}
    if got != want:
        odd = sorted(got ^ want)
        raise RuntimeError(f"the batch would read other files than it marks: {len(odd)} differ, such as {odd[0]}")


def file_inventory(spark: SparkSession, root: str, paths=None, start=None, end=None) -> DataFrame:
    """A2: every file with its size, day and bucket; file contents are pruned
    from the read schema (only metadata is touched)."""
    if paths is None and (start is not None or end is not None):
        paths = day_folders(spark, root, start, end)
    df = _load(spark, "binaryFile", root, paths, {})
    if df is None:
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    out = df.select(
        F.col("path").alias("file_path"),
        F.col("length").alias("file_size"),
        F.col("dt").cast("date").alias("dt"),
        F.col("part").cast("int").alias("part"),
    )
    return scan_date_range(out, start, end)


def inventory_of_lines(lines: DataFrame) -> DataFrame:
    """File inventory of a line frame (used for views that are not on disk)."""
    return lines.select("file_path", "file_size", "dt", "part").distinct()


# ---- A3-A6: file selection, all partition predicates ---------------------

def scan_date_range(df: DataFrame, start=None, end=None) -> DataFrame:
    """A3: keep days in [start, end], both inclusive."""
    start, end = _as_date(start), _as_date(end)
    if start is not None:
        df = df.where(F.col("dt") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("dt") <= F.lit(end))
    return df


def scan_bucket_range(df: DataFrame, lo=None, hi=None) -> DataFrame:
    """A4: keep buckets in [lo, hi], both inclusive."""
    if lo is not None:
        df = df.where(F.col("part") >= F.lit(int(lo)))
    if hi is not None:
        df = df.where(F.col("part") <= F.lit(int(hi)))
    return df


def owned_bucket(node_id: int, nodes_total: int) -> Column:
    if nodes_total < 1:
        raise ValueError("nodes_total must be >= 1")
    return F.pmod(F.col("part"), F.lit(int(nodes_total))) == F.lit(int(node_id))


def scan_owned_buckets(df: DataFrame, node_id: int, nodes_total: int) -> DataFrame:
    """A5: buckets owned by this job: ``part % nodes_total == node_id``."""
    return df.where(owned_bucket(node_id, nodes_total))


def file_cap(inventory: DataFrame, max_files: int | None) -> DataFrame:
    """First ``max_files`` files in (day, bucket, path) order; ``None`` is
    unlimited, 0 selects nothing.  The cap is exact."""
    if max_files is None:
        return inventory
    return inventory.orderBy("dt", "part", "file_path").limit(int(max_files))


def select_files(inventory: DataFrame, cfg: ScanConfig) -> DataFrame:
    inv = scan_date_range(inventory, cfg.start_date, cfg.end_date)
    inv = scan_bucket_range(inv, cfg.bucket_min, cfg.bucket_max)
    if cfg.nodes_total > 1:
        inv = scan_owned_buckets(inv, cfg.node_id, cfg.nodes_total)
    return inv


def unprocessed_files(inventory: DataFrame, marks: DataFrame, index: str, start=None, end=None) -> DataFrame:
    """Inventory minus the files marked for ``index`` (left anti join).

    Marks of every owner count: a file loaded by another job is done.  The
    run's day range also filters the marks (pushed to their parquet scan,
    whose files are sorted by day).
    """
    done = (scan_date_range(marks.withColumnRenamed("day", "dt"), start, end).withColumnRenamed("dt", "day")
            .where(F.col("index") == F.lit(index))
            .select(F.col("day").alias("dt"), F.col("bucket").alias("part"),
                    F.col("file").alias("file_path")))
    return inventory.join(done, ["dt", "part", "file_path"], "left_anti")
