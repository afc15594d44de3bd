"""Incremental, resumable loads: one batch (all of section 3.1), the batch
runner that skips marked files (S1) and the Structured Streaming load (S2).

One batch:

1. one pass over the lines: bits (repeats collapsed), rejected lines and line
   counts per file -> staged;
2. look up the batch's distinct row and column values in the dictionaries;
3. as the index's writer, give the unknown ones ids, check both unique keys and
   append them (commits 1 and 2);
4. encode the bits with the batch's value->id maps and append the facts, the
   rejects and the report (commit 3);
5. mark the batch's files (commit 4).

Only the batch's *distinct* values meet the dictionaries, each once: a few are asked
for by name, many are joined (:meth:`BitStore.known_columns`).
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import parse_lines
from ..operators.bits import BIT_COLS, load_rows
from ..operators.ids import assign_column_ids, assign_row_ids, check_col_entries, check_row_entries
from ..plans.store import BitStore, new_batch_id
from ..sources.logs import (check_files_read, day_folders, file_cap, file_inventory, inventory_of_lines, plain_path,
                            read_log_lines, select_files, unprocessed_files)
from ..spec import DEFAULT_INDEX, IdConfig, LogSpec, ScanConfig

#: Files that one batch opens at most: the driver holds their paths.
FILES_PER_BATCH = 50_000
#: gzip cannot be split, so lines of larger files are dealt out before they are parsed.
BIG_FILE_BYTES = 256 << 20


def load_batch(store: BitStore, lines: DataFrame, index: str = DEFAULT_INDEX, spec: LogSpec = LogSpec(),
               cfg: IdConfig = IdConfig(), batch_id: int | None = None, files: DataFrame | None = None,
               owner_node: int = 0, keyed: bool = False, skip_known_bits: bool = False,
               rollup: bool = False, writer_wait_s: float = 3600.0) -> dict:
    """Load one batch of lines; ``files`` (dt, part, file_path, file_size) are
    marked once the facts are committed.  ``keyed`` also writes the value-space
    bits (string keys, no ids).  ``skip_known_bits`` drops bits already in
    the fact table (anti join, NULL days equal) instead of leaving repeats
    to distinct reads and compaction; worth it while the table is small.
    ``rollup`` appends a delta bitmap rollup of the batch's facts.  The report
    has the totals of the batch; the store has it by file (``load_report``)."""
    batch_id = batch_id or new_batch_id()
    t = [time.perf_counter()]
    staged = store.stage(load_rows(parse_lines(lines, spec), spec), batch_id, "rows")
    bits = staged.where(~F.col("field").startswith("#")).select(*BIT_COLS)
    row_vals = store.stage(bits.select("field", "row_val").distinct(), batch_id, "row_values")
    col_vals = store.stage(bits.select("col_val").distinct(), batch_id, "col_values")
    t.append(time.perf_counter())

    with store.writer(index, writer_wait_s) as still_mine:
        seen = store.dict_batches(index)
        rd = store.row_dict(index)
        old_rows = store.stage(row_vals.join(rd.select("field", "row_val", "row_id"), ["field", "row_val"]),
                               batch_id, "old_rows")
        new_rows = row_vals.join(old_rows, ["field", "row_val"], "left_anti")
        row_entries = store.stage(assign_row_ids(None, rd, index, cfg, new_values=new_rows), batch_id, "new_rows")
        n_new_rows = row_entries.count()
        if n_new_rows:
            check_row_entries(row_entries, rd, index)
            store.check_unseen(row_entries, "row_dict", index, seen)
            still_mine()
            store.append_row_dict(row_entries, index, batch_id)
        t.append(time.perf_counter())

        old_cols = store.stage(store.known_columns(col_vals, index), batch_id, "old_cols")
        new_cols = store.stage(col_vals.select("col_val").join(old_cols, "col_val", "left_anti"), batch_id, "new_col_values")
        state = store.shard_state(index, cfg.shard_width)
        col_entries = store.stage(assign_column_ids(None, store.col_dict(index), index, cfg, new_values=new_cols,
                                                    state=state), batch_id, "new_cols")
        n_new_cols = col_entries.count()
        if n_new_cols:
            check_col_entries(col_entries, state)
            store.check_unseen(col_entries, "col_lookup", index, seen)
            still_mine()
            store.append_shard_log(col_entries, index, batch_id)   # log first: it always covers the dictionary
            store.append_col_dict(col_entries, index, batch_id)
        t.append(time.perf_counter())

    added_rows = row_entries.select("field", "row_val", "row_id")
    added_cols = col_entries.select("col_val", "col_id", "shard")
    facts = (bits.join(old_rows.unionByName(added_rows), ["field", "row_val"])
             .join(old_cols.unionByName(added_cols), "col_val")
             .select("field", "shard", "row_id", "col_id", "day"))
    if skip_known_bits:
        old = (store.read("fact").where(F.col("index") == F.lit(index))
               .select("field", "row_id", "col_id", "day").alias("o"))
        n = facts.alias("n")
        cond = [F.col("n.field") == F.col("o.field"), F.col("n.row_id") == F.col("o.row_id"),
                F.col("n.col_id") == F.col("o.col_id"), F.col("n.day").eqNullSafe(F.col("o.day"))]
        facts = n.join(old, cond, "left_anti")
    store.append_facts(facts, index, batch_id)
    if rollup:
        store.append_rollup(index, batch_id)
    if keyed:
        store.append_keyed_bits(bits, index, batch_id)
    t.append(time.perf_counter())
    totals = _report(store, staged, files, index, spec, batch_id)
    if files is not None:
        store.append_marks(files, index, owner_node, batch_id)
    t.append(time.perf_counter())
    steps = ("stage_bits", "row_ids", "col_ids", "facts", "report_marks")
    report = {"batch_id": batch_id, "bits": bits.count(),
              "new_rows": n_new_rows, "new_cols": n_new_cols, **totals,
              "seconds": {k: round(t[i + 1] - t[i], 3) for i, k in enumerate(steps)}}
    store.drop_staging(batch_id)
    return report


def _report(store: BitStore, staged: DataFrame, files: DataFrame | None, index: str, spec: LogSpec,
            batch_id: int) -> dict:
    """Commit the batch's rejects and its report by file; the totals."""
    def lines_of(kind=None):
        n = F.col("n") if kind is None else F.when(F.col("col_val") == kind, F.col("n")).otherwise(0)
        return F.sum(n).cast("long")

    by_file = staged.where(F.col("field") == "#line").groupBy(F.col("row_val").alias("file_path")).agg(
        F.max("day").alias("dt"), F.max("part").alias("part"), lines_of().alias("n_lines"),
        lines_of("reject").alias("n_rejects"), lines_of("bad_time").alias("n_bad_time"))
    counts = ("n_lines", "n_rejects", "n_bad_time")
    if files is not None:
        by_file = files.select("dt", "part", "file_path", "file_size").join(
            by_file.drop("dt", "part"), "file_path", "left")
        by_file = by_file.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    else:
        by_file = by_file.withColumn("file_size", F.lit(None).cast("long"))
    by_file = store.stage(by_file, batch_id, "report")
    store.append_report(by_file, index, batch_id)
    r = by_file.agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"), F.sum("n_lines").alias("lines"),
                    F.sum("n_rejects").alias("rejects"), F.sum("n_bad_time").alias("bad_times")).first()
    totals = {k: int(r[k] or 0) for k in ("files", "bytes", "lines", "rejects", "bad_times")}
    if totals["rejects"]:
        store.append_rejects(staged.where(F.col("field") == "#reject").select(
            F.col("col_val").alias("value"),
            F.concat(F.lit("positions="), F.col("n_pos").cast("string"),
                     F.lit(f" < {spec.min_positions}")).alias("reason"),
            F.col("day").alias("dt"), "part", F.col("row_val").alias("file_path"), "n"), index, batch_id)
    return totals


def run_load(spark: SparkSession, store: BitStore, *, root: str | None = None, lines: DataFrame | None = None,
             index: str = DEFAULT_INDEX, scan: ScanConfig = ScanConfig(), spec: LogSpec = LogSpec(),
             cfg: IdConfig = IdConfig(), owner_node: int = 0, keyed: bool = False,
             until_done: bool = False, rollup: bool = False, days_per_listing: int = 31,
             files_per_batch: int = FILES_PER_BATCH, writer_wait_s: float = 3600.0) -> list[dict]:
    """Load the files that are selected by ``scan`` and not yet marked
    for ``index`` — from a log folder ``root`` or from a line frame with
    ``file_path`` (e.g. a view over tables).  Without ``max_files`` a run
    loads everything selected; with it a run loads exactly so many files (fewer
    only if there are no more), or with ``until_done`` everything, that many at
    a time.  A batch has at most ``files_per_batch`` files.

    A log folder is listed ``days_per_listing`` day folders at a time (one
    top-level listing finds the days), so the driver never holds the file
    list of the whole history.
    """
    if (root is None) == (lines is None):
        raise ValueError("give exactly one of root and lines")
    left = None if until_done else scan.max_files
    per_batch = max(0, min(files_per_batch, files_per_batch if scan.max_files is None else scan.max_files))
    kw = dict(index=index, scan=scan, spec=spec, cfg=cfg, owner_node=owner_node, keyed=keyed, rollup=rollup,
              per_batch=per_batch, writer_wait_s=writer_wait_s)
    if per_batch == 0:
        return []
    if lines is not None:
        return _load_listing(spark, store, inventory_of_lines(lines), root=None, lines=lines,
                             start=scan.start_date, end=scan.end_date, left=left, **kw)
    days = day_folders(spark, root, scan.start_date, scan.end_date)
    reports = []
    for i in range(0, len(days), max(1, days_per_listing)):
        chunk = days[i:i + max(1, days_per_listing)]
        first, last = _day_of_folder(chunk[0]), _day_of_folder(chunk[-1])
        reps = _load_listing(spark, store, file_inventory(spark, root, paths=chunk), root=root, lines=None,
                             start=first, end=last, left=left, **kw)
        reports += reps
        if left is not None:
            left -= sum(r["files"] for r in reps)
            if left <= 0:
                break
    return reports


def _day_of_folder(path: str) -> str:
    return path.rstrip("/").rsplit("dt=", 1)[1]


def _load_listing(spark, store, inv, *, root, lines, start, end, index, scan, spec, cfg, owner_node, keyed,
                  rollup, per_batch, left, writer_wait_s) -> list[dict]:
    """Batches over one file listing: stage it once, then each batch takes
    up to ``per_batch`` files not yet marked, ``left`` in all (None: no end)."""
    list_id = new_batch_id()
    selected = store.stage(select_files(inv, scan), list_id, "inventory")
    reports = []
    if lines is not None:
        lines = _lines_of_batches(store, lines, unprocessed_files(selected, store.marks(index), index, start, end),
                                  per_batch, left, list_id)
    while left is None or left > 0:
        batch_id = new_batch_id()
        todo = unprocessed_files(selected, store.marks(index), index, start, end)
        take = per_batch if left is None else min(per_batch, left)
        batch_files = store.stage(file_cap(todo, take), batch_id, "files")
        if root is not None:
            # Exactly the batch's files, at most files_per_batch: marked files are never opened.
            listed = {r["file_path"]: r["file_size"] for r in batch_files.select("file_path", "file_size").collect()}
            n_files = len(listed)
            batch_lines = _lines_of(spark, root, listed) if listed else None
        else:
            n_files, batch_lines = _lines_of_files(lines, batch_files)
        if n_files == 0:
            store.drop_staging(batch_id)
            break
        reports.append(load_batch(store, batch_lines, index, spec, cfg, batch_id, files=batch_files,
                                  owner_node=owner_node, keyed=keyed, rollup=rollup, writer_wait_s=writer_wait_s))
        if left is not None:
            left -= n_files
    store.drop_staging(list_id)
    return reports


def _lines_of_batches(store: BitStore, lines: DataFrame, todo: DataFrame, per_batch: int, left: int | None,
                      list_id: int) -> DataFrame:
    """A line frame for the batches of one run.  A run of several batches has the
    lines of its files written once, by day and in the order of its batches, so that
    each batch reads its own part and not the whole frame again."""
    n = todo.count()
    if min(n, n if left is None else left) <= per_batch:
        return lines
    own = lines.select("value", "dt", "part", "file_path").join(todo.select("file_path"), "file_path", "left_semi")
    return store.stage(own.hint("rebalance", "dt", "part").sortWithinPartitions("dt", "part", "file_path"),
                       list_id, "lines", by=("dt",))


def _lines_of_files(lines: DataFrame, files: DataFrame) -> tuple[int, DataFrame]:
    """The number of ``files`` and their lines.  Files of a batch are neighbours in
    (day, bucket, path) order: its first and last are filters that reach the scan."""
    key = F.struct("dt", "part", "file_path")
    got = files.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    own = lines.join(files.select("file_path"), "file_path", "left_semi")
    if got["n"] and None not in (*got["lo"], *got["hi"]):
        dt, part, path = F.col("dt"), F.col("part"), F.col("file_path")
        (d0, p0, f0), (d1, p1, f1) = got["lo"], got["hi"]
        own = own.where((dt >= F.lit(d0)) & (dt <= F.lit(d1))
                        & ((dt > F.lit(d0)) | part.isNull() | (part > F.lit(p0)) | ((part == F.lit(p0)) & (path >= F.lit(f0))))
                        & ((dt < F.lit(d1)) | part.isNull() | (part < F.lit(p1)) | ((part == F.lit(p1)) & (path <= F.lit(f1)))))
    return got["n"], own


def _lines_of(spark: SparkSession, root: str, sizes: dict[str, int]) -> DataFrame:
    """Lines of the listed files.  Lines of big files are rebalanced (AQE sizes
    the parts); the others are parsed where they are read."""
    out = None
    for big in (False, True):
        paths = [p for p, n in sizes.items() if (n > BIG_FILE_BYTES) == big]
        if paths:
            df = read_log_lines(spark, root, paths=paths)
            check_files_read(df, paths)
            df = df.hint("rebalance") if big else df
            out = df if out is None else out.unionByName(df)
    return out


def stream_load(spark: SparkSession, store: BitStore, root: str, checkpoint: str, *,
                index: str = DEFAULT_INDEX, scan: ScanConfig = ScanConfig(), spec: LogSpec = LogSpec(),
                cfg: IdConfig = IdConfig(), max_files_per_trigger: int = 1000, owner_node: int = 0,
                keyed: bool = False, rollup: bool = False, processing_time: str | None = None):
    """The same load as Structured Streaming over a log folder.

    Each micro-batch (at most ``max_files_per_trigger`` files) keeps the files
    that ``scan`` selects (days, buckets, owner; ``max_files`` does not apply)
    and that no job has marked, and runs :func:`load_batch` on them; the
    streaming checkpoint records which files were taken.  A replayed
    micro-batch is harmless: its files are marked, or ids are get-or-create and
    facts are read distinct.  Runs to the end of the available files and
    returns; with ``processing_time`` (e.g. ``"5 minutes"``) it keeps running
    and the started query is returned.
    """
    src = (spark.readStream.format("text").option("lineSep", "\n")
           .option("maxFilesPerTrigger", int(max_files_per_trigger)).load(root))
    lines = src.select("value", F.col("dt").cast("date").alias("dt"), F.col("part").cast("int").alias("part"),
                       plain_path(F.col("_metadata.file_path")).alias("file_path"),
                       F.col("_metadata.file_size").alias("file_size"))

    def each(df: DataFrame, epoch_id: int) -> None:
        batch_id = new_batch_id()
        # The micro-batch feeds both its file list and the load: keep it
        # (memory, spilling to disk; recomputed from the files if lost).
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            todo = unprocessed_files(select_files(inventory_of_lines(df), scan), store.marks(index), index)
            files = store.stage(todo, batch_id, "files")
            if files.isEmpty():
                store.drop_staging(batch_id)
                return
            own = df.join(files.select("file_path"), "file_path", "left_semi")
            load_batch(store, own, index, spec, cfg, batch_id, files=files, owner_node=owner_node, keyed=keyed,
                       rollup=rollup)
        finally:
            df.unpersist()

    w = lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if processing_time:
        return w.trigger(processingTime=processing_time).start()
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q
