"""

Every query reads the driver's ``events`` table (through the fixture log
view of FIXTURES.md section 4) and returns a DataFrame; the matching DuckDB
SQL is in :mod:`bitlake.plans.oracle`.  Parameters below are fixed values
of the test queries, not of the engine.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import accepted, offset_in_shard, parse_lines, reject_lines
from ..functions.parse import shard_of as shard_of_id
from ..operators import ids
from ..operators.bitmaps import bitmap_index, time_bitmap_index
from ..operators.bits import BIT_COLS, list_elements, set_bits, time_views, unpivot_bits
from ..operators.codec import decode_columns, decode_rows, encode_columns, encode_rows
from ..session import checkpoint_dir, written
from ..sources.fixtures import event_log_lines
from ..sources.logs import (file_cap, inventory_of_lines, scan_bucket_range, scan_date_range,
                            scan_owned_buckets, unprocessed_files)
from ..spec import DEFAULT_INDEX, IdConfig, LogSpec, ScanConfig
from .query import Count, Index, batch_calls
from .store import BitStore

# Fixed parameters of the test queries.
INDEX = DEFAULT_INDEX
ID_CFG = IdConfig(shard_width=64, lanes=3)
SPLIT_DAY = _dt.date(2024, 1, 15)          # batch 1 = files with dt <= SPLIT_DAY
RANGE_START, RANGE_END = "2024-01-03", "2024-01-05"
BUCKET_LO, BUCKET_HI = 2, 5
OWNER_NODE, OWNER_TOTAL = 1, 3
FILE_CAP = 25
BITMAP_START, BITMAP_END = "2023-12-30", "2024-02-02"
NESTED, TYPES = 50, ("click", "view", "purchase", "signup", "error")

ROW_DICT_SCHEMA = T.StructType([
    T.StructField("index", T.StringType()), T.StructField("field", T.StringType()),
    T.StructField("row_id", T.LongType()), T.StructField("row_val", T.StringType())])
COL_DICT_SCHEMA = T.StructType([
    T.StructField("index", T.StringType()), T.StructField("col_id", T.LongType()),
    T.StructField("shard", T.LongType()), T.StructField("col_val", T.StringType())])


class Fixture:
    """All frames of the fixture log view of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str, spec: LogSpec = LogSpec(),
                 cfg: IdConfig = ID_CFG, index: str = INDEX):
        self.spark, self.sf_dir, self.spec, self.cfg, self.index = spark, sf_dir, spec, cfg, index

    @cached_property
    def lines(self) -> DataFrame:
        return event_log_lines(self.spark, self.sf_dir)

    @cached_property
    def parsed(self) -> DataFrame:
        return parse_lines(self.lines, self.spec)

    @cached_property
    def raw_bits(self) -> DataFrame:
        return unpivot_bits(self.parsed, self.spec, keep=("dt",))

    @cached_property
    def bits(self) -> DataFrame:
        return set_bits(self.raw_bits)

    @cached_property
    def written_bits(self) -> DataFrame:
        """The bits of the lines with their batch (``first``; NULL without a day folder),
        written by one pass over the lines: both dictionaries and the facts read them."""
        first = (F.col("dt") <= F.lit(SPLIT_DAY)).alias("first")
        return written(self.raw_bits.select(*BIT_COLS, first), "bits")

    def batch_bits(self, batch: int) -> DataFrame:
        return self.written_bits.where(F.col("first") if batch == 1 else ~F.col("first")).select(*BIT_COLS)

    @cached_property
    def stored_bits(self) -> DataFrame:
        return set_bits(self.written_bits)

    @cached_property
    def value_index(self) -> Index:
        return Index(self.bits, self.spec, name=self.index)

    # ---- dictionaries built in two batches, lineage cut by checkpoints ----

    def _empty(self, schema) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    @cached_property
    def row_dict(self) -> DataFrame:
        checkpoint_dir(self.spark)
        d1 = ids.assign_row_ids(self.batch_bits(1), self._empty(ROW_DICT_SCHEMA), self.index, self.cfg).checkpoint()
        d2 = ids.assign_row_ids(self.batch_bits(2), d1, self.index, self.cfg).checkpoint()
        return d1.unionByName(d2)

    @cached_property
    def col_dict(self) -> DataFrame:
        checkpoint_dir(self.spark)
        d1 = ids.assign_column_ids(self.batch_bits(1), self._empty(COL_DICT_SCHEMA), self.index, self.cfg).checkpoint()
        d2 = ids.assign_column_ids(self.batch_bits(2), d1, self.index, self.cfg).checkpoint()
        return d1.unionByName(d2)

    @cached_property
    def facts(self) -> DataFrame:
        return (encode_columns(encode_rows(self.stored_bits, self.row_dict, self.index), self.col_dict, self.index)
                .select("field", "row_id", "col_id", "shard", "day"))

    @cached_property
    def id_index(self) -> Index:
        return Index(self.facts, self.spec, self.row_dict, self.col_dict, self.index)


# ---- A: sources over the fixture view --------------------------------------

def log_scan(fx: Fixture) -> DataFrame:
    return fx.lines.select("dt", "part", "file_path", "value")


def file_inventory(fx: Fixture) -> DataFrame:
    return inventory_of_lines(fx.lines)


def scan_date_range_q(fx: Fixture) -> DataFrame:
    return scan_date_range(inventory_of_lines(fx.lines), RANGE_START, RANGE_END)


def scan_bucket_range_q(fx: Fixture) -> DataFrame:
    return scan_bucket_range(inventory_of_lines(fx.lines), BUCKET_LO, BUCKET_HI)


def scan_owned_buckets_q(fx: Fixture) -> DataFrame:
    return scan_owned_buckets(inventory_of_lines(fx.lines), OWNER_NODE, OWNER_TOTAL)


def file_cap_q(fx: Fixture) -> DataFrame:
    return file_cap(inventory_of_lines(fx.lines), FILE_CAP)


def _batch1_marks(fx: Fixture) -> DataFrame:
    inv = inventory_of_lines(fx.lines).where(F.col("dt") <= F.lit(SPLIT_DAY))
    return inv.select(F.col("dt").alias("day"), F.col("part").alias("bucket"),
                      F.lit(fx.index).alias("index"), F.col("file_path").alias("file"),
                      F.lit(0).alias("owner_node"))


def unprocessed_files_q(fx: Fixture) -> DataFrame:
    return unprocessed_files(inventory_of_lines(fx.lines), _batch1_marks(fx), fx.index)


def ingest_report(fx: Fixture) -> DataFrame:
    from ..streaming.ingest import ingest_report as report
    return report(fx.lines, fx.spec)


# ---- B: parsing -----------------------------------------------------------

def parse_log(fx: Fixture) -> DataFrame:
    return accepted(fx.parsed, fx.spec).select("file_path", "ts", "idfield", "cfield", "ofield", "sfield_list")


def parse_ts(fx: Fixture) -> DataFrame:
    return accepted(fx.parsed, fx.spec).select("ts_raw", "ts", "day")


def reject_lines_q(fx: Fixture) -> DataFrame:
    return reject_lines(fx.parsed, fx.spec)


def filter_empty_list(fx: Fixture) -> DataFrame:
    return (accepted(fx.parsed, fx.spec).where(F.col("sfield_list") != F.lit(""))
            .select("idfield", "sfield_list"))


def explode_list(fx: Fixture) -> DataFrame:
    return (accepted(fx.parsed, fx.spec)
            .select("idfield", F.explode(list_elements("sfield_list")).alias("sfield")))


def unpivot_bits_q(fx: Fixture) -> DataFrame:
    return fx.raw_bits.select(*BIT_COLS)


def time_views_q(fx: Fixture) -> DataFrame:
    return time_views(fx.bits)


def shard_of(fx: Fixture) -> DataFrame:
    w = fx.cfg.shard_width
    return fx.col_dict.select("col_val", "col_id", shard_of_id("col_id", w).alias("shard"),
                              offset_in_shard("col_id", w).alias("offset"))


# ---- C: joins -------------------------------------------------------------

def encode_rows_q(fx: Fixture) -> DataFrame:
    return encode_rows(fx.stored_bits, fx.row_dict, fx.index).select("field", "row_id", "col_val", "day")


def encode_columns_q(fx: Fixture) -> DataFrame:
    return encode_columns(fx.stored_bits, fx.col_dict, fx.index).select("field", "row_val", "col_id", "day")


def decode_rows_q(fx: Fixture) -> DataFrame:
    return decode_rows(fx.facts, fx.row_dict, fx.index).select("field", "row_val", "col_id", "day")


def decode_columns_q(fx: Fixture) -> DataFrame:
    return decode_columns(fx.facts, fx.col_dict, fx.index, strict=False).select("field", "row_id", "col_val", "day")


# ---- D: dictionaries ------------------------------------------------------

def assign_row_ids_q(fx: Fixture) -> DataFrame:
    return fx.row_dict


def next_row_id_q(fx: Fixture) -> DataFrame:
    return ids.next_row_id(fx.row_dict, fx.index)


def assign_column_ids_q(fx: Fixture) -> DataFrame:
    return fx.col_dict


def shard_state_q(fx: Fixture) -> DataFrame:
    return ids.shard_state(fx.col_dict, fx.cfg.shard_width, fx.index)


def open_shards_q(fx: Fixture) -> DataFrame:
    st = ids.shard_state(fx.col_dict, fx.cfg.shard_width, fx.index)
    return ids.open_shards(st, fx.cfg).select("lane", "shard", "next_offset")


def unused_shards_q(fx: Fixture) -> DataFrame:
    st = ids.shard_state(fx.col_dict, fx.cfg.shard_width, fx.index)
    return ids.unused_shards(st, fx.cfg, per_lane=2)


def dict_integrity_q(fx: Fixture) -> DataFrame:
    r = ids.dict_integrity(fx.row_dict, "row").withColumn("dictionary", F.lit("row"))
    c = ids.dict_integrity(fx.col_dict, "col").withColumn("dictionary", F.lit("col"))
    return r.unionByName(c)


def shard_status_q(fx: Fixture) -> DataFrame:
    return ids.shard_status(fx.col_dict, fx.cfg, fx.index)


# ---- E, G: set queries (value space and id space give the same answers) ----

def _calls(ix: Index):
    return {
        "row": lambda: ix.columns(ix.row("ofield", "click")),
        "range": lambda: ix.columns(ix.range("ofield", "purchase", "2024-01-05", "2024-01-12")),
        "union": lambda: ix.columns(ix.union(ix.row("sfield", "view"), ix.row("cfield", "k42"))),
        "intersect": lambda: ix.columns(ix.intersect(ix.row("ofield", "view"), ix.row("ofield", "error"))),
        "difference": lambda: ix.columns(ix.difference(ix.row("ofield", "signup"), ix.row("ofield", "click"),
                                                       ix.row("ofield", "view"))),
        "nested": lambda: ix.columns(ix.difference(
            ix.union(ix.row("ofield", "click"), ix.range("sfield", "purchase", "2024-01-10", "2024-01-20")),
            ix.intersect(ix.row("cfield", "k5"), ix.row("ofield", "error")))),
        "count_bitmap": lambda: ix.count(ix.intersect(ix.row("ofield", "click"), ix.row("sfield", "view"))),
        "topn": lambda: ix.topn("sfield", n=10),
        "topn_filtered": lambda: ix.topn("cfield", n=5, filter=ix.row("ofield", "purchase")),
        "batch_calls": lambda: batch_calls(ix, [
            ix.intersect(ix.row("ofield", "signup"), ix.row("cfield", "k1")),
            Count(ix.row("sfield", "error")),
            ix.topn("ofield")]),
        "batch_nested": lambda: batch_calls(ix, _nested_calls(ix)),
    }


def _nested_calls(ix: Index) -> list:
    """A request of :data:`NESTED` nested calls over :data:`TYPES`, every third a count."""
    out = []
    for i in range(NESTED):
        a, b, c = (TYPES[(i + k) % len(TYPES)] for k in range(3))
        bm = ix.difference(
            ix.union(ix.row("cfield", f"k{i}"), ix.range("sfield", a, f"2024-01-{i % 20 + 1:02}", f"2024-01-{i % 20 + 4:02}")),
            ix.intersect(ix.row("ofield", b), ix.row("sfield", c)), ix.row("cfield", f"k{i + 1}"))
        out.append(Count(bm) if i % 3 == 0 else bm)
    return out


def set_bits_q(fx: Fixture) -> DataFrame:
    return fx.bits


def bitmap_index_q(fx: Fixture) -> DataFrame:
    r = bitmap_index(fx.facts)
    return r.select("field", "row_id", "bucket", F.bitmap_count("bitmap").alias("n_bits"))


def _bitmap_index(fx: Fixture):
    from ..operators.bitmaps import BitmapIndex
    return BitmapIndex(bitmap_index(fx.facts), fx.row_dict, fx.index, times=time_bitmap_index(fx.facts), col_dict=fx.col_dict)


def time_bitmap_index_q(fx: Fixture) -> DataFrame:
    return time_bitmap_index(fx.facts).select("field", "row_id", "period", "bucket", F.bitmap_count("bitmap").alias("n_bits"))


def bitmap_range_q(fx: Fixture) -> DataFrame:
    """The ``range`` query over month and day bitmaps, with a whole month and edge days."""
    bx = _bitmap_index(fx)
    return bx.columns(bx.range("ofield", "purchase", BITMAP_START, BITMAP_END))


def bitmap_difference_q(fx: Fixture) -> DataFrame:
    bx = _bitmap_index(fx)
    return bx.columns(bx.difference(*bx.rows(("ofield", "signup"), ("ofield", "click"), ("ofield", "view"))))


def bitmap_nested_q(fx: Fixture) -> DataFrame:
    """The ``nested`` query over bitmaps."""
    bx = _bitmap_index(fx)
    click, k5, error = bx.rows(("ofield", "click"), ("cfield", "k5"), ("ofield", "error"))
    return bx.columns(bx.difference(bx.union(click, bx.range("sfield", "purchase", "2024-01-10", "2024-01-20")),
                                    bx.intersect(k5, error)))


def bitmap_count_q(fx: Fixture) -> DataFrame:
    """count(intersect / union of row(ofield=click), row(sfield=view)) over the rollup."""
    bx = _bitmap_index(fx)
    a, b = bx.rows(("ofield", "click"), ("sfield", "view"))
    return (bx.count(bx.intersect(a, b)).select(F.lit("intersect").alias("kind"), "count")
            .unionByName(bx.count(bx.union(a, b)).select(F.lit("union").alias("kind"), "count")))


def bitmap_topn_q(fx: Fixture) -> DataFrame:
    return _bitmap_index(fx).topn("sfield", n=10)


# ---- A7-A14, S1, S2: persistent loads over the fixture view -------------

_STORES: dict = {}


def _cached(fx: Fixture, name: str, build):
    key = (fx.spark.sparkContext.applicationId, fx.sf_dir, name)
    if key not in _STORES:
        _STORES[key] = build()
    return _STORES[key]


def loaded_store(fx: Fixture) -> "BitStore":
    """Two resumable runs over the fixture view: run 1 (owner 0) takes the
    files up to SPLIT_DAY, run 2 (owner 1) everything not yet marked."""
    from ..session import work_path
    from ..streaming.load import run_load

    def build():
        store = BitStore(fx.spark, work_path(fx.spark, "store"))
        r1 = run_load(fx.spark, store, lines=fx.lines, index=fx.index, scan=ScanConfig(end_date=SPLIT_DAY),
                      spec=fx.spec, cfg=fx.cfg, owner_node=0, keyed=True)
        r2 = run_load(fx.spark, store, lines=fx.lines, index=fx.index, scan=ScanConfig(),
                      spec=fx.spec, cfg=fx.cfg, owner_node=1, keyed=True)
        return store.root, r1[0]["batch_id"], r2[0]["batch_id"]
    root, b1, b2 = _cached(fx, "load", build)
    store = BitStore(fx.spark, root)
    store.batches = (b1, b2)
    return store


def log_folder(fx: Fixture) -> str:
    """The fixture view written as a real gzip log folder (dt=/part=)."""
    from ..session import work_path
    from ..sources.fixtures import write_log_files
    return _cached(fx, "logs", lambda: write_log_files(fx.lines, work_path(fx.spark, "logs")))


_ODD_NAMES = ("a[1]", "x{1}", "s*t", "q?", "b c", "p%20+q", "back\\slash", "plain")


def odd_log_folder(fx: Fixture) -> str:
    """A real log folder whose file names have pattern characters, spaces and
    percent signs."""
    from ..session import _fs, work_path
    from ..sources.fixtures import write_log_files

    def build():
        root = write_log_files(fx.lines, work_path(fx.spark, "odd-logs"))
        fs, p = _fs(fx.spark, root)
        path = fx.spark._jvm.org.apache.hadoop.fs.Path
        it, files = fs.listFiles(p, True), []
        while it.hasNext():
            f = it.next().getPath()
            if f.getName().startswith("part-"):
                files.append(f)
        for i, f in enumerate(files):
            fs.rename(f, path(f.getParent(), f"{_ODD_NAMES[i % len(_ODD_NAMES)]}{i // len(_ODD_NAMES)}.txt.gz"))
        return root
    return _cached(fx, "odd-logs", build)


def resume_ingest_files(fx: Fixture) -> DataFrame:
    """S1 over a real folder, in two runs: first 37 files, then the rest."""
    from ..session import work_path
    from ..streaming.load import run_load

    def build():
        store = BitStore(fx.spark, work_path(fx.spark, "file-store"))
        run_load(fx.spark, store, root=odd_log_folder(fx), index=fx.index, scan=ScanConfig(max_files=37),
                 spec=fx.spec, cfg=fx.cfg, days_per_listing=3)
        run_load(fx.spark, store, root=odd_log_folder(fx), index=fx.index, spec=fx.spec, cfg=fx.cfg, files_per_batch=150)
        return store.root
    return BitStore(fx.spark, _cached(fx, "files", build)).decoded_bits(fx.index)


def load_rejects(fx: Fixture) -> DataFrame:
    """B3 as the loads stored it."""
    return loaded_store(fx).rejects(fx.index).select(
        "value", "reason", "dt", "part", "file_path", "n")


def load_report(fx: Fixture) -> DataFrame:
    """A15 as the loads stored it."""
    return loaded_store(fx).load_report(fx.index).drop("batch_id")


def stream_after_resume(fx: Fixture) -> DataFrame:
    """S2 after S1 took the files up to SPLIT_DAY: raw fact and mark counts
    show that no file was loaded twice."""
    from ..session import work_path
    from ..streaming.load import run_load, stream_load

    def build():
        store = BitStore(fx.spark, work_path(fx.spark, "mixed"))
        root = log_folder(fx)
        run_load(fx.spark, store, root=root, index=fx.index, scan=ScanConfig(end_date=SPLIT_DAY), spec=fx.spec, cfg=fx.cfg)
        stream_load(fx.spark, store, root, store.root + "/_checkpoint", index=fx.index, spec=fx.spec, cfg=fx.cfg)
        return store.root
    st = BitStore(fx.spark, _cached(fx, "mixed", build))
    return (st.marks(fx.index).groupBy("day", "bucket").agg(F.count(F.lit(1)).alias("marks"),
                                                           F.countDistinct("file").alias("files"))
            .select("day", "bucket", (F.col("marks") - F.col("files")).alias("marked_twice"))
            .join(st.load_report(fx.index).groupBy(F.col("dt").alias("day"), F.col("part").alias("bucket"))
                  .agg(F.sum("n_lines").alias("n_lines")), ["day", "bucket"]))


def log_files_scan(fx: Fixture) -> DataFrame:
    from ..sources.logs import read_log_lines
    return read_log_lines(fx.spark, log_folder(fx)).select("dt", "part", "value")


def file_inventory_files(fx: Fixture) -> DataFrame:
    """A2 over the real folder: its days and buckets, and whether all files have bytes."""
    from ..sources.logs import file_inventory as files_of
    return files_of(fx.spark, odd_log_folder(fx)).groupBy("dt", "part").agg(
        (F.min("file_size") > 0).alias("has_bytes"))


def mark_files(fx: Fixture) -> DataFrame:
    return loaded_store(fx).marks(fx.index)


def marked_files(fx: Fixture) -> DataFrame:
    return loaded_store(fx).marked_files(fx.index, "2024-01-03", 2)


def refresh_marks(fx: Fixture) -> DataFrame:
    from ..session import work_path
    store = BitStore(fx.spark, work_path(fx.spark, "marks"))
    inv = inventory_of_lines(fx.lines)
    first = F.col("dt") <= F.lit(SPLIT_DAY)
    store.append_marks(inv.where(first), fx.index, 0, 1)
    store.append_marks(inv.where(~first), fx.index, 1, 2)
    store.append_marks(inv.where(first), "_other", 0, 3)
    store.refresh_marks(fx.index, 0)
    return store.marks()


def refresh_index(fx: Fixture) -> DataFrame:
    from ..session import work_path
    from ..streaming.load import load_batch
    store = BitStore(fx.spark, work_path(fx.spark, "refresh"))
    load_batch(store, fx.lines, fx.index, fx.spec, fx.cfg)
    before = {t: store.read(t).where(F.col("index") == fx.index).count() for t in ("fact", "row_dict", "col_dict")}
    store.refresh_index(fx.index)
    rows = [(t, before[t], store.read(t).where(F.col("index") == fx.index).count()) for t in before]
    return fx.spark.createDataFrame(rows, "tbl string, rows_before long, rows_after long")


def row_dict_load(fx: Fixture) -> DataFrame:
    return (loaded_store(fx).row_dict(fx.index).where(F.col("field") == "sfield")
            .select("row_val", "row_id"))


def row_dict_append(fx: Fixture) -> DataFrame:
    st = loaded_store(fx)
    return (st.read("row_dict").where((F.col("index") == fx.index) & (F.col("batch_id") == st.batches[1]))
            .select("index", "field", "row_id", "row_val"))


def fact_sink(fx: Fixture) -> DataFrame:
    return loaded_store(fx).facts(fx.index)


def fact_sink_keyed(fx: Fixture) -> DataFrame:
    return loaded_store(fx).keyed_bits(fx.index)


def resume_ingest(fx: Fixture) -> DataFrame:
    return loaded_store(fx).decoded_bits(fx.index)


def resume_topn(fx: Fixture) -> DataFrame:
    ix = loaded_store(fx).index(fx.index, fx.spec)
    return ix.topn("sfield", n=10)


def stream_ingest(fx: Fixture) -> DataFrame:
    from ..session import work_path
    from ..streaming.load import stream_load

    def build():
        store = BitStore(fx.spark, work_path(fx.spark, "stream"))
        stream_load(fx.spark, store, log_folder(fx), store.root + "/_checkpoint", index=fx.index,
                    spec=fx.spec, cfg=fx.cfg, max_files_per_trigger=60)
        return store.root
    return BitStore(fx.spark, _cached(fx, "stream", build)).decoded_bits(fx.index)


def _value_call(name):
    return lambda fx: _calls(fx.value_index)[name]()


def _id_call(name):
    return lambda fx: _calls(fx.id_index)[name]()


QUERIES = {
    # A
    "log_scan": log_scan,
    "file_inventory": file_inventory,
    "scan_date_range": scan_date_range_q,
    "scan_bucket_range": scan_bucket_range_q,
    "scan_owned_buckets": scan_owned_buckets_q,
    "file_cap": file_cap_q,
    "unprocessed_files": unprocessed_files_q,
    "ingest_report": ingest_report,
    # B
    "parse_log": parse_log,
    "parse_ts": parse_ts,
    "reject_lines": reject_lines_q,
    "filter_empty_list": filter_empty_list,
    "explode_list": explode_list,
    "unpivot_bits": unpivot_bits_q,
    "time_views": time_views_q,
    "shard_of": shard_of,
    # C
    "encode_rows": encode_rows_q,
    "encode_columns": encode_columns_q,
    "decode_rows": decode_rows_q,
    "decode_columns": decode_columns_q,
    # D
    "assign_row_ids": assign_row_ids_q,
    "next_row_id": next_row_id_q,
    "assign_column_ids": assign_column_ids_q,
    "shard_state": shard_state_q,
    "open_shards": open_shards_q,
    "unused_shards": unused_shards_q,
    "dict_integrity": dict_integrity_q,
    "shard_status": shard_status_q,
    # E
    "set_bits": set_bits_q,
    "bitmap_index": bitmap_index_q,
    "bitmap_count": bitmap_count_q,
    "bitmap_topn": bitmap_topn_q,
    "time_bitmap_index": time_bitmap_index_q,
    "bitmap_range": bitmap_range_q,
    "bitmap_difference": bitmap_difference_q,
    "bitmap_nested": bitmap_nested_q,
    # A7-A14, S
    "log_files_scan": log_files_scan,
    "file_inventory_files": file_inventory_files,
    "mark_files": mark_files,
    "marked_files": marked_files,
    "refresh_marks": refresh_marks,
    "refresh_index": refresh_index,
    "row_dict_load": row_dict_load,
    "row_dict_append": row_dict_append,
    "fact_sink": fact_sink,
    "fact_sink_keyed": fact_sink_keyed,
    "resume_ingest": resume_ingest,
    "resume_topn": resume_topn,
    "stream_ingest": stream_ingest,
    "resume_ingest_files": resume_ingest_files,
    "load_rejects": load_rejects,
    "load_report": load_report,
    "stream_after_resume": stream_after_resume,
}
for _n in ("row", "range", "union", "intersect", "difference", "nested", "count_bitmap", "topn",
           "topn_filtered", "batch_calls", "batch_nested"):
    QUERIES[_n] = _value_call(_n)
    QUERIES[f"{_n}_ids"] = _id_call(_n)


_FIXTURES: dict = {}


def fixture(spark: SparkSession, sf_dir: str) -> Fixture:
    """One Fixture per Spark application and data folder, so the two-batch
    dictionaries (checkpointed) are built once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FIXTURES:
        _FIXTURES[key] = Fixture(spark, sf_dir)
    return _FIXTURES[key]


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES[name](fixture(spark, sf_dir))
