"""Persistent tables of an index and the commit protocol.

Layout below ``root`` (any Hadoop file system; parquet).  Every batch writes
folders of its own, so jobs that commit at the same time share no output folder::

    row_dict/index=<i>/batch_id=<b>/field=<f>/    row_id, row_val (sorted by value)
    col_dict/index=<i>/batch_id=<b>/id_group=<g>/ col_id, shard, col_val (g = col_id >> 26; for decoding)
    col_lookup/index=<i>/batch_id=<b>/            the same entries sorted by value, with Bloom filters (for encoding)
    col_base/index=<i>/version=<v>/               lookup entries of folded batches, bucketed by value
    shard_log/index=<i>/batch_id=<b>/             shard, last_id, ids_used
    fact/index=<i>/batch_id=<b>/field=<f>/        shard, row_id, col_id, day (sorted by row, then day)
    bit/index=<i>/batch_id=<b>/field=<f>/         row_val, col_val, day      (keyed sink)
    marks/index=<i>/owner_node=<n>/batch_id=<b>/  day, bucket, file
    reject/index=<i>/batch_id=<b>/                value, reason, dt, part, file_path, n
    load_report/index=<i>/batch_id=<b>/           a row per file: size, lines, rejects, bad times
    _staging/batch_id=<b>/<name>/                 written intermediates of one batch
    _writer/index=<i>                             who is giving out ids just now

Commit order of one batch: row dictionary, shard log, column lookup, column
dictionary, then facts, rejects and report, then marks.  The shard log is
written before the column ids it describes, so it always covers the
dictionary: shard state is read from this small table instead of a scan of the
whole column dictionary.  Every committed fact is a true bit with durable ids,
so a crash needs no rollback: unmarked files are read again, their values find
the ids already stored and repeated bits collapse because every read of the
facts is distinct.  Ids are given out by one job at a time (:meth:`BitStore.writer`);
everything else of several jobs' batches runs side by side.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, list_folders, path_exists, read_text, write_text
from ..spec import DEFAULT_INDEX, LogSpec
from .query import Index

DONE = "_bitlake_done"  # our own commit marker (Spark's _SUCCESS can be switched off)
S, L, D, I, B = T.StringType(), T.LongType(), T.DateType(), T.IntegerType(), T.BooleanType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


SCHEMAS = {
    "row_dict": _schema(("row_id", L), ("row_val", S), ("index", S), ("batch_id", L), ("field", S)),
    "col_dict": _schema(("col_id", L), ("shard", L), ("col_val", S), ("index", S), ("batch_id", L),
                        ("id_group", L)),
    "col_lookup": _schema(("col_id", L), ("shard", L), ("col_val", S), ("index", S), ("batch_id", L)),
    "fact": _schema(("shard", L), ("row_id", L), ("col_id", L), ("day", D),
                    ("index", S), ("batch_id", L), ("field", S)),
    "bit": _schema(("row_val", S), ("col_val", S), ("day", D), ("index", S), ("batch_id", L), ("field", S)),
    "marks": _schema(("day", D), ("bucket", I), ("file", S), ("index", S), ("owner_node", I), ("batch_id", L)),
    "shard_log": _schema(("shard", L), ("last_id", L), ("ids_used", L), ("index", S), ("batch_id", L)),
    "reject": _schema(("value", S), ("reason", S), ("dt", D), ("part", I), ("file_path", S), ("n", L),
                      ("index", S), ("batch_id", L)),
    "load_report": _schema(("dt", D), ("part", I), ("file_path", S), ("file_size", L), ("n_lines", L),
                           ("n_rejects", L), ("n_bad_time", L), ("index", S), ("batch_id", L)),
}
#: Partition columns below the batch's folder.
INNER = {"row_dict": ["field"], "col_dict": ["id_group"], "fact": ["field"], "bit": ["field"]}
#: Parquet settings of the lookup files: a Bloom filter of the values of every row
#: group (about 4 bytes a value), small row groups and small pages, so that a few
#: values are found, or found missing, without decoding the rest.
LOOKUP_OPTIONS = {
    "parquet.bloom.filter.enabled#col_val": "true", "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.fpp#col_val": "0.00001", "parquet.bloom.filter.max.bytes": str(1 << 20),
    "parquet.block.row.count.limit": "20000", "parquet.page.row.count.limit": "500"}
#: A batch with at most so many distinct values of so many bytes asks for them by name.
NAMED_VALUES, NAMED_BYTES = 1_000, 1 << 20
#: A bucket of the folded lookup has at most about so many entries.
BUCKET_ENTRIES = 1 << 22


def named(col: str, values: list[str]):
    """``col`` is one of ``values``, as ORs of short lists: parquet then compares every
    single value with the statistics of row groups and pages and with the Bloom filters."""
    parts = [F.col(col).isin(values[i:i + 10]) for i in range(0, len(values), 10)]
    while len(parts) > 1:
        parts = [parts[i] | parts[i + 1] if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else F.lit(False)


def new_batch_id() -> int:
    """Provenance of one load attempt (microseconds since the epoch)."""
    return time.time_ns() // 1000


class BitStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    # ---- reads ------------------------------------------------------------

    def _index_path(self, table: str, index: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", index):
            raise ValueError(f"index name {index!r}: letters, digits and _ . - only")
        return f"{self.path(table)}/index={index}"

    def read(self, table: str) -> DataFrame:
        p = self.path(table)
        schema = SCHEMAS[table]
        if not path_exists(self.spark, p):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", p).parquet(p)

    def row_dict(self, index: str | None = None) -> DataFrame:
        d = self.read("row_dict")
        if index is not None:
            d = d.where(F.col("index") == F.lit(index))
        return d.select("index", "field", "row_id", "row_val")

    def col_dict(self, index: str | None = None) -> DataFrame:
        d = self.read("col_dict")
        if index is not None:
            d = d.where(F.col("index") == F.lit(index))
        return d.select("index", "col_id", "shard", "col_val", "id_group")

    def _lookups(self, index: str) -> list[DataFrame]:
        """The column dictionary for encoding, ``(col_val, col_id, shard)``: the folded,
        bucketed entries, and those of the batches since."""
        version, says = self._base(index)
        newer = self.read("col_lookup").where(F.col("index") == F.lit(index))
        if version is None:
            return [newer.select("col_val", "col_id", "shard")]
        if says["batches"]:  # folded, but their folders may still be there
            newer = newer.where(~F.col("batch_id").isin(*says["batches"]))
        out = f"{self._index_path('col_base', index)}/version={version}"
        # Spark knows buckets from a catalog only; the table is a name for the folder.
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {_table_name(out)} (col_val STRING, col_id BIGINT, shard BIGINT) "
                       f"USING parquet CLUSTERED BY (col_val) SORTED BY (col_val) INTO {int(says['buckets'])} BUCKETS "
                       f"LOCATION '{out}'")
        return [self.spark.table(_table_name(out)), newer.select("col_val", "col_id", "shard")]

    def col_lookup(self, index: str) -> DataFrame:
        """The column dictionary for encoding, ``(col_val, col_id, shard)``."""
        parts = self._lookups(index)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def known_columns(self, vals: DataFrame, index: str) -> DataFrame:
        """``(col_val, col_id, shard)`` of those of the distinct, staged ``vals``
        (``col_val``) that have ids.

        A few values (at most :data:`NAMED_VALUES` of :data:`NAMED_BYTES` bytes, counted
        first) are asked for by name: the scans skip row groups by Bloom filter and pages
        by range.  More are joined, with the folded entries bucket by bucket (only the
        batch's values are shuffled), with the unfolded ones as Spark chooses."""
        n = vals.agg(F.count("col_val").alias("n"), F.coalesce(F.sum(F.octet_length("col_val")), F.lit(0)).alias("b")).first()
        parts = self._lookups(index)
        if n["n"] <= NAMED_VALUES and n["b"] <= NAMED_BYTES:
            few = named("col_val", [r["col_val"] for r in vals.where("col_val is not null").select("col_val").collect()])
            parts = [p.where(few) for p in parts]
        else:
            parts = [vals.select("col_val").join(p, "col_val") for p in parts]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _base(self, index: str) -> tuple[int | None, dict]:
        """Newest folded lookup: its version, and its buckets and batches."""
        base = self._index_path("col_base", index)
        versions = self._versions(base)
        return (versions[-1], json.loads(read_text(self.spark, f"{base}/version={versions[-1]}/{DONE}"))) if versions else (None, {})

    def fold_lookup(self, index: str) -> str:
        """Write all lookup entries bucketed by value, as a new version, then drop the
        older ones and the folders of the batches in it.  For the index's writer only.
        The number of buckets, kept with the version, follows the number of entries."""
        version, base = new_batch_id(), self._index_path("col_base", index)
        batches = _ids(list_folders(self.spark, self._index_path("col_lookup", index)), "batch_id")
        entries = self.col_lookup(index)
        n = entries.count()
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = 1 << (max(1, n // BUCKET_ENTRIES, min(tasks, n >> 16)) - 1).bit_length()
        out = f"{base}/version={version}"
        (entries.repartition(buckets, "col_val").write.options(**LOOKUP_OPTIONS).option("path", out)
         .bucketBy(buckets, "col_val").sortBy("col_val").saveAsTable(_table_name(out)))
        write_text(self.spark, f"{out}/{DONE}", json.dumps({"buckets": buckets, "entries": n, "batches": batches}))
        for old in _ids(list_folders(self.spark, base), "version"):
            if old != version:
                self.spark.sql(f"DROP TABLE IF EXISTS {_table_name(f'{base}/version={old}')}")
                delete_path(self.spark, f"{base}/version={old}")
        for b in batches:
            delete_path(self.spark, f"{self._index_path('col_lookup', index)}/batch_id={b}")
        return out

    def facts(self, index: str = DEFAULT_INDEX) -> DataFrame:
        """A13 read-back: distinct bits of the index in id space."""
        return (self.read("fact").where(F.col("index") == F.lit(index))
                .select("field", "row_id", "col_id", "shard", "day").distinct())

    def keyed_bits(self, index: str = DEFAULT_INDEX) -> DataFrame:
        """A14 read-back: distinct bits written in value space."""
        return (self.read("bit").where(F.col("index") == F.lit(index))
                .select("field", "row_val", "col_val", "day").distinct())

    def marks(self, index: str | None = None) -> DataFrame:
        m = self.read("marks")
        if index is not None:
            m = m.where(F.col("index") == F.lit(index))
        return m.select("day", "bucket", "index", "file", "owner_node")

    def marked_files(self, index: str, day, bucket: int) -> DataFrame:
        """Files marked for index, day and bucket, whoever marked them."""
        return (self.marks(index)
                .where((F.col("day") == F.lit(day).cast("date")) & (F.col("bucket") == F.lit(int(bucket))))
                .select("file").distinct())

    def index(self, index: str = DEFAULT_INDEX, spec: LogSpec = LogSpec()) -> Index:
        """Queries over the facts.  Each of them collapses repeated bits itself, in an
        aggregate that it needs anyway, so the facts are not made distinct first."""
        raw = (self.read("fact").where(F.col("index") == F.lit(index))
               .select("field", "row_id", "col_id", "shard", "day"))
        return Index(raw, spec, self.row_dict(index), self.col_dict(index), index)

    def decoded_bits(self, index: str = DEFAULT_INDEX) -> DataFrame:
        """End state in value space: facts joined back to both dictionaries."""
        f = self.facts(index)
        r = self.row_dict(index).select("field", "row_id", "row_val")
        c = self.col_dict(index).select("col_id", "col_val")
        return f.join(r, ["field", "row_id"]).join(c, "col_id").select("field", "row_val", "col_val", "day").distinct()

    # ---- appends (one batch each) -------------------------------------------

    def _append(self, table: str, df: DataFrame, index: str, batch_id: int, owner_node: int | None = None,
                options: dict | None = None) -> None:
        inner = INNER.get(table, [])
        out = self._index_path(table, index)
        if owner_node is not None:
            out += f"/owner_node={int(owner_node)}"
        cols = [f for f in SCHEMAS[table].fields if f.name not in ("index", "batch_id", "owner_node")]
        (df.select(*[F.col(f.name).cast(f.dataType) for f in cols])
         .write.mode("append").options(**(options or {})).partitionBy(*inner).parquet(f"{out}/batch_id={int(batch_id)}"))

    def append_row_dict(self, entries: DataFrame, index: str, batch_id: int) -> None:
        """New (index, field, row_id, row_val) entries, sorted by value."""
        self._append("row_dict", entries.hint("rebalance", "field").sortWithinPartitions("field", "row_val"),
                     index, batch_id)

    def append_col_dict(self, entries: DataFrame, index: str, batch_id: int) -> None:
        """New column entries: first by value, for encoding, then by id, for decoding."""
        self._append("col_lookup", entries.repartitionByRange("col_val").sortWithinPartitions("col_val"), index, batch_id,
                     options=LOOKUP_OPTIONS)
        self._append_by_id(entries, index, batch_id)

    def _append_by_id(self, entries: DataFrame, index: str, batch_id: int) -> None:
        from ..operators.codec import id_group
        by_id = entries.withColumn("id_group", id_group("col_id"))
        self._append("col_dict", by_id.hint("rebalance", "id_group").sortWithinPartitions("id_group", "col_id"),
                     index, batch_id)

    def append_shard_log(self, entries: DataFrame, index: str, batch_id: int) -> None:
        """Per-shard summary of one batch's new column ids (a few rows)."""
        self._append("shard_log", entries.groupBy("shard").agg(
            F.max("col_id").alias("last_id"), F.count(F.lit(1)).alias("ids_used")), index, batch_id)

    def shard_state(self, index: str, shard_width: int) -> DataFrame:
        """D4 from the index's shard log: ``max(last_id)`` per shard (the
        dictionary is never scanned).  An index without a log (its dictionary
        was written by other means) has it derived from the dictionary."""
        from ..operators.ids import shard_state as from_dict
        if not path_exists(self.spark, self._index_path("shard_log", index)):
            return from_dict(self.col_dict(index), shard_width)
        w = int(shard_width)
        return (self.read("shard_log").where(F.col("index") == F.lit(index))
                .groupBy("index", "shard")
                .agg(F.max("last_id").alias("last_id"), F.sum("ids_used").cast("long").alias("ids_used"))
                .withColumn("next_offset", F.pmod(F.col("last_id") + 1, F.lit(w)))
                .withColumn("full", F.col("next_offset") == 0))

    def append_facts(self, facts: DataFrame, index: str, batch_id: int) -> None:
        """A13 sink: bits of one (field, row) go to the same writer task, sorted by
        (row_id, day, col_id).  Every query names its row and ``range`` days as well, so
        parquet statistics of row groups and pages prune both, without a folder per
        month.  ``rebalance`` (not ``repartition``) lets AQE split a hot row and merge
        small ones."""
        out = facts.hint("rebalance", "field", "row_id").sortWithinPartitions("field", "row_id", "day", "col_id")
        self._append("fact", out, index, batch_id)

    def append_keyed_bits(self, bits: DataFrame, index: str, batch_id: int) -> None:
        """A14 sink: bits with string keys (no dictionaries)."""
        out = bits.hint("rebalance", "field").sortWithinPartitions("field", "row_val", "col_val")
        self._append("bit", out, index, batch_id)

    def append_marks(self, files: DataFrame, index: str, owner_node: int, batch_id: int) -> None:
        """Mark finished files (inventory rows: dt, part, file_path),
        sorted by day so a day-range read of the marks skips row groups."""
        self._append("marks", files.select(
            F.col("dt").alias("day"), F.col("part").alias("bucket"), F.col("file_path").alias("file"))
            .sortWithinPartitions("day", "bucket", "file"), index, batch_id, owner_node)

    def append_rejects(self, rejects: DataFrame, index: str, batch_id: int) -> None:
        """Rejected lines of a batch (``n``: how often the line occurs in its file)."""
        self._append("reject", rejects, index, batch_id)

    def append_report(self, report: DataFrame, index: str, batch_id: int) -> None:
        """One row per file of a batch."""
        self._append("load_report", report, index, batch_id)

    def rejects(self, index: str = DEFAULT_INDEX) -> DataFrame:
        return self.read("reject").where(F.col("index") == F.lit(index)).select(
            "value", "reason", "dt", "part", "file_path", "n", "batch_id")

    def load_report(self, index: str = DEFAULT_INDEX) -> DataFrame:
        return self.read("load_report").where(F.col("index") == F.lit(index)).select(
            "dt", "part", "file_path", "file_size", "n_lines", "n_rejects", "n_bad_time", "batch_id")

    # ---- one writer of ids at a time ------------------------------------------

    @contextlib.contextmanager
    def writer(self, index: str, wait_s: float = 3600.0, poll_s: float = 1.0):
        """Hold the index's writer mark while new ids are given out and
        committed.  Another job waits up to ``wait_s`` seconds, then fails.  A
        job that died inside leaves the mark; :meth:`release_writer` removes it.
        Yields a function that raises if the mark is no longer this job's, to be
        called before each commit.  What it cannot see, between two calls, the check
        of new values against entries committed meanwhile does (:meth:`check_unseen`)."""
        path = f"{self.root}/_writer/index={index}"
        own = uuid.uuid4().hex
        until = time.monotonic() + wait_s
        while True:
            try:
                write_text(self.spark, path, own, overwrite=False)
                time.sleep(0.05)  # a file system without atomic create: the last one in has it
                if read_text(self.spark, path) == own:
                    break
            except Exception as e:  # noqa: BLE001 - the file system says that the mark is there or has just gone
                if not re.search("AlreadyExists|already exists|FileNotFound|does not exist", str(e)):
                    raise
            if time.monotonic() > until:
                raise TimeoutError(f"another job gives out ids for index {index!r} (mark {path})")
            time.sleep(poll_s)
        def held() -> bool:
            return path_exists(self.spark, path) and read_text(self.spark, path) == own

        def check() -> None:
            if not held():
                raise RuntimeError(f"this job's writer mark of index {index!r} was taken away; nothing more is committed")

        try:
            yield check
        finally:
            if held():  # never another job's
                delete_path(self.spark, path)

    def dict_batches(self, index: str) -> dict[str, list[int]]:
        """The batches whose dictionary entries are there now."""
        out = {t: _ids(list_folders(self.spark, self._index_path(t, index)), "batch_id") for t in ("row_dict", "col_lookup")}
        out["col_base"] = [self._base(index)[0]]
        return out

    def check_unseen(self, entries: DataFrame, table: str, index: str, seen: dict[str, list[int]]) -> None:
        """D7 before a commit: raise if a new value or id is in an entry that another job
        committed after ``seen`` was taken, i.e. after the values were looked up.  Reads the
        folders of those batches only: none, unless two jobs gave out ids at once."""
        now = self.dict_batches(index)
        new = sorted(set(now[table]) - set(seen[table]))
        folded = table == "col_lookup" and now["col_base"] != seen["col_base"]  # what is new may be in there
        if not new and not folded:
            return
        keys = (["field", "row_val"], ["field", "row_id"]) if table == "row_dict" else (["col_val"], ["col_id"])
        other = self.col_lookup(index) if folded else self.read(table).where(
            (F.col("index") == F.lit(index)) & F.col("batch_id").isin(*new))
        for k in keys:
            n = entries.join(other.select(*k), k, "left_semi").count()
            if n:
                raise RuntimeError(f"another job has committed {n} of the new {table} entries ({', '.join(k)}); "
                                   "nothing was committed, run the batch again")

    def release_writer(self, index: str) -> bool:
        """Remove the mark of a writer that died."""
        return delete_path(self.spark, f"{self.root}/_writer/index={index}")

    def stage(self, df: DataFrame, batch_id: int, name: str, by: tuple = ()) -> DataFrame:
        """Write an intermediate of the batch (in folders of the columns ``by``) and read
        it back: cuts the lineage and makes later reads deterministic (ids depend on it)."""
        p = f"{self.root}/_staging/batch_id={batch_id}/{name}"
        df.write.mode("overwrite").partitionBy(*by).parquet(p)
        return self.spark.read.schema(df.schema).parquet(p) if by else self.spark.read.parquet(p)

    def drop_staging(self, batch_id: int) -> None:
        delete_path(self.spark, f"{self.root}/_staging/batch_id={batch_id}")

    # ---- refresh (A9, A10) --------------------------------------------------

    def refresh_marks(self, index: str, owner_node: int) -> None:
        """Forget the marks of this index made by this owner only."""
        delete_path(self.spark, f"{self._index_path('marks', index)}/owner_node={int(owner_node)}")

    def refresh_index(self, index: str) -> None:
        """A10: drop facts, keyed bits, rollups, rejects, reports and the
        dictionaries of an index, so old bits can never meet new ids."""
        base = self._index_path("col_base", index)
        for v in _ids(list_folders(self.spark, base), "version"):
            self.spark.sql(f"DROP TABLE IF EXISTS {_table_name(f'{base}/version={v}')}")
        for t in ("rollup", "rollup_delta", "rollup_time", "fact", "bit", "reject", "load_report", "shard_log", "col_lookup",
                  "col_base", "col_dict", "row_dict"):
            delete_path(self.spark, self._index_path(t, index))

    # ---- E5 rollup ----------------------------------------------------------
    # rollup/index=<i>/version=<v>/field=<f>/        full build from the facts
    # rollup_delta/index=<i>/batch_id=<b>/field=<f>/ one per loaded batch
    # The marker of a version holds the ids of the batches it covers.  Bitmap OR
    # is idempotent, so readers OR the newest version with the deltas of all
    # batches it does not cover, and refuse if a batch is in neither.

    def _rollup_of(self, index: str, batches: list[int] | None, fields: list[str] | None) -> DataFrame:
        """Bitmaps of raw facts: OR needs no distinct input."""
        from ..operators.bitmaps import bitmap_index
        f = self.read("fact").where(F.col("index") == F.lit(index))
        if batches is not None:
            f = f.where(F.col("batch_id").isin(*batches))
        if fields is not None:
            f = f.where(F.col("field").isin(*fields))
        return bitmap_index(f.select("field", "row_id", "col_id"))

    def append_rollup(self, index: str, batch_id: int) -> None:
        """Delta rollup of one batch's committed facts (partition-pruned read),
        of the fields that the newest version has (all without one)."""
        out = f"{self._index_path('rollup_delta', index)}/batch_id={batch_id}"
        _, _, fields = self._newest(index)
        (self._rollup_of(index, [batch_id], fields).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("field").parquet(out))
        write_text(self.spark, f"{out}/{DONE}")

    def fact_batches(self, index: str) -> list[int]:
        return _ids(list_folders(self.spark, self._index_path("fact", index)), "batch_id")

    def write_rollup(self, index: str = DEFAULT_INDEX, fields: list[str] | None = None) -> str:
        """Full build from the batches that are committed now, as a new version;
        older versions and the deltas it covers are dropped afterwards.
        ``fields`` names the fields worth it (dense rows; default: all)."""
        version = new_batch_id()
        base = self._index_path("rollup", index)
        batches = self.fact_batches(index)
        (self._rollup_of(index, batches or [-1], fields).write.partitionBy("field")
         .parquet(f"{base}/version={version}"))
        write_text(self.spark, f"{base}/version={version}/{DONE}", json.dumps({"batches": batches, "fields": fields}))
        for old in self._versions(base):
            if old != version:
                delete_path(self.spark, f"{base}/version={old}")
        deltas = self._index_path("rollup_delta", index)
        for b in self._versions(deltas, "batch_id"):
            if b in batches:
                delete_path(self.spark, f"{deltas}/batch_id={b}")
        return f"{base}/version={version}"

    def _versions(self, base: str, key: str = "version") -> list[int]:
        return [v for v in _ids(list_folders(self.spark, base), key)
                if path_exists(self.spark, f"{base}/{key}={v}/{DONE}")]

    def _newest(self, index: str) -> tuple[int | None, list[int], list[str] | None]:
        """Newest rollup version, the batches it covers and its fields."""
        base = self._index_path("rollup", index)
        versions = self._versions(base)
        if not versions:
            return None, [], None
        says = json.loads(read_text(self.spark, f"{base}/version={versions[-1]}/{DONE}"))
        return versions[-1], says["batches"], says["fields"]

    def rollup(self, index: str = DEFAULT_INDEX) -> DataFrame:
        """Current rollup ``(field, row_id, bucket, bitmap)``: the newest full
        version OR the deltas it does not cover (merged lazily; filters on field
        and row_id are pushed below the merge).  Raises if a batch is missing."""
        version, covered, _ = self._newest(index)
        deltas = self._index_path("rollup_delta", index)
        newer = [b for b in self._versions(deltas, "batch_id") if b not in covered]
        missing = set(self.fact_batches(index)) - set(covered) - set(newer)
        if missing:
            raise ValueError(f"the rollup of index {index!r} lacks {len(missing)} loaded batches; call write_rollup")
        paths = [f"{deltas}/batch_id={b}" for b in newer]
        if version is not None:
            paths.insert(0, f"{self._index_path('rollup', index)}/version={version}")
        if not paths:
            raise ValueError(f"no rollup for index {index!r}; load with rollup=True or call write_rollup")
        cols = "row_id bigint, bucket bigint, bitmap binary, field string"
        parts = [self.spark.read.schema(cols).parquet(p).select("field", "row_id", "bucket", "bitmap") for p in paths]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        if len(parts) == 1:
            return out
        return out.groupBy("field", "row_id", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

    def rollup_index(self, index: str = DEFAULT_INDEX):
        from ..operators.bitmaps import BitmapIndex
        return BitmapIndex(self.rollup(index), self.row_dict(index), index, self._newest(index)[2],
                           self.time_rollup(index), self.col_dict(index))

    def write_time_rollup(self, index: str = DEFAULT_INDEX) -> str:
        """Month and day bitmaps of the batches that are committed now, as a new
        version below ``rollup_time``; older versions are dropped afterwards."""
        from ..operators.bitmaps import time_bitmap_index
        base, version, batches = self._index_path("rollup_time", index), new_batch_id(), self.fact_batches(index)
        out = f"{base}/version={version}"
        facts = self.read("fact").where((F.col("index") == F.lit(index)) & F.col("batch_id").isin(*batches or [-1]))
        (time_bitmap_index(facts).sortWithinPartitions("field", "row_id", "period")
         .write.partitionBy("field").parquet(out))
        write_text(self.spark, f"{out}/{DONE}", json.dumps({"batches": batches}))
        for old in self._versions(base):
            if old != version:
                delete_path(self.spark, f"{base}/version={old}")
        return out

    def time_rollup(self, index: str = DEFAULT_INDEX) -> DataFrame:
        """Month and day bitmaps ``(field, row_id, period, bucket, bitmap)``: the newest
        version, and those of the batches it does not cover straight from their facts.
        A bucket may come several times; what reads it takes the OR."""
        from ..operators.bitmaps import time_bitmap_index
        base = self._index_path("rollup_time", index)
        versions = self._versions(base)
        covered = json.loads(read_text(self.spark, f"{base}/version={versions[-1]}/{DONE}"))["batches"] if versions else []
        newer = sorted(set(self.fact_batches(index)) - set(covered))
        cols = "row_id bigint, period int, bucket bigint, bitmap binary, field string"
        names = ["field", "row_id", "period", "bucket", "bitmap"]
        live = time_bitmap_index(self.read("fact").where(
            (F.col("index") == F.lit(index)) & F.col("batch_id").isin(*newer or [-1]))).select(*names)
        if not versions:
            return live
        stored = self.spark.read.schema(cols).parquet(f"{base}/version={versions[-1]}").select(*names)
        return stored.unionByName(live) if newer else stored

    # ---- compaction ---------------------------------------------------------

    def compact_facts(self, index: str, batch_id: int | None = None) -> None:
        """Collapse repeated bits across batches: write the distinct facts once,
        as one new batch, then drop the old batch folders."""
        old = self.fact_batches(index)
        batch_id = batch_id or new_batch_id()
        version, covered, fields = self._newest(index)
        deltas = self._versions(self._index_path("rollup_delta", index), "batch_id")
        self.append_facts(self.facts(index), index, batch_id)
        if set(old) <= set(covered) | set(deltas):  # the rollup covers the new batch, too
            if version is not None:
                write_text(self.spark, f"{self._index_path('rollup', index)}/version={version}/{DONE}",
                           json.dumps({"batches": [*covered, batch_id], "fields": fields}))
            elif deltas:
                self.append_rollup(index, batch_id)
        for b in old:
            delete_path(self.spark, f"{self._index_path('fact', index)}/batch_id={b}")

    def compact_dicts(self, index: str) -> None:
        """Fold the dictionaries' and the shard log's batch folders into one
        each, and the lookup entries into buckets, then drop the old folders.
        Entries are never changed, so a reader meets the same ids before and after; if
        the job dies in between, entries of the first three are there twice until it is
        run again (it writes them distinct)."""
        with self.writer(index):  # entries are only folded: nothing new is given out
            batch_id = new_batch_id()
            old = {t: _ids(list_folders(self.spark, self._index_path(t, index)), "batch_id")
                   for t in ("row_dict", "col_dict", "shard_log")}
            rows = self.row_dict(index).distinct()
            cols = self.col_dict(index).select("index", "col_id", "shard", "col_val").distinct()
            if old["row_dict"]:
                self.append_row_dict(rows, index, batch_id)
            if old["col_dict"]:
                self.append_shard_log(cols, index, batch_id)
                self._append_by_id(cols, index, batch_id)
                self.fold_lookup(index)
            for t, batches in old.items():
                for b in batches:
                    delete_path(self.spark, f"{self._index_path(t, index)}/batch_id={b}")


def _table_name(folder: str) -> str:
    return "bitlake_" + hashlib.sha256(folder.encode()).hexdigest()[:32]


def _ids(names: list[str], key: str) -> list[int]:
    return sorted(int(n[len(key) + 1:]) for n in names if n.startswith(key + "="))
