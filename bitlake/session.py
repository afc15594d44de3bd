"""Session helpers: a configured SparkSession and the shared work folder.

On a cluster the work folder is the one named by ``spark.checkpoint.dir``
(a shared file system or object store).  Only in local mode may it be unset:
then a fresh local folder is created and registered as the checkpoint directory.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "bitlake",
                shuffle_partitions: int | None = None,
                conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # File listing over many explicit paths runs as a Spark job with one task
    # per path up to 10,000; about two tasks per core lists the same paths
    # with far less task overhead.  Only when the user kept the default.
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(min(10000, max(8, 2 * spark.sparkContext.defaultParallelism))))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    It must be named by ``spark.checkpoint.dir`` (or set on the context).  Only
    in local mode, where driver and executors are one process, a fresh local
    folder is made when there is none."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="bitlake-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/bitlake-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: what is read
    several times is computed once, and is the same each time."""
    p = work_path(df.sparkSession, name)
    df.write.parquet(p)
    return df.sparkSession.read.schema(df.schema).parquet(p)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def write_text(spark: SparkSession, path: str, text: str = "", overwrite: bool = True) -> None:
    """Write a small file, such as a marker after a job has committed."""
    fs, p = _fs(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    src = fs.open(p)
    try:
        return bytes(src.readAllBytes()).decode()
    finally:
        src.close()


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path`` (none if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursive delete of a table partition folder (like DROP PARTITION)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return bool(fs.delete(p, True))
    return False
