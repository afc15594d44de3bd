"""Benchmark: load and query the lineitem log view (FIXTURES.md section 4).

Prints one JSON line.  Env: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8), BENCH_RUNS (default 3, median after one warm-up).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


from bitlake.operators.bits import bits_from_lines  # noqa: E402
from bitlake.plans.store import BitStore  # noqa: E402
from bitlake.session import get_session, work_path  # noqa: E402
from bitlake.sources.fixtures import lineitem_log_lines, write_log_files  # noqa: E402
from bitlake.sources.logs import read_log_lines  # noqa: E402
from bitlake.spec import IdConfig  # noqa: E402
from bitlake.streaming.load import load_batch, run_load, stream_load  # noqa: E402


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs):
    fn()  # warm-up
    ts = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t0)
    return statistics.median(ts)


def once(fn):
    t0 = time.perf_counter()
    out = fn()
    return time.perf_counter() - t0, out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_session(f"local[{cpus}]", app="bitlake-bench", shuffle_partitions=max(8, 2 * cpus),
                        conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    q = {}

    lines = lineitem_log_lines(spark, sf_dir)
    n_lines = lines.count()
    q["parse_to_bits"] = timed(lambda: noop(bits_from_lines(lines)), runs)

    # the real source: gzip text folder, dt=/part= partitions
    root = write_log_files(lines, work_path(spark, "bench-logs"))
    q["gzip_scan_to_bits"] = timed(lambda: noop(bits_from_lines(read_log_lines(spark, root))), runs)

    # full load: dictionaries + facts + marks, one batch
    cfg = IdConfig(lanes=8)
    store = BitStore(spark, work_path(spark, "bench-store"))
    # one listing and one batch over all month folders (days_per_listing covers them all)
    q["full_load"], reps = once(lambda: run_load(spark, store, root=root, cfg=cfg, days_per_listing=100_000))
    n_bits = reps[0]["bits"]
    q["resume_noop"], _ = once(lambda: run_load(spark, store, root=root, cfg=cfg, days_per_listing=100_000))

    # the same load as Structured Streaming (micro-batches of at most 500 files)
    sstore = BitStore(spark, work_path(spark, "bench-stream"))
    q["stream_load"], _ = once(lambda: stream_load(spark, sstore, root, sstore.root + "/_checkpoint", cfg=cfg,
                                                   max_files_per_trigger=500))

    # two new and two known entities against a dictionary of 3M entries
    big = BitStore(spark, work_path(spark, "bench-dict"))
    entries = spark.range(3_000_000).select(F.col("id").alias("col_id"), F.shiftright("id", 20).alias("shard"),
                                            F.concat(F.lit("e"), F.col("id").cast("string")).alias("col_val"))
    big.append_shard_log(entries, "_test", 1)
    big.append_col_dict(entries, "_test", 1)
    few = spark.createDataFrame([(f"2024-01-01 00:00:00\t{v}\tc\to\ts",) for v in ("e7", "e2999999", "n1", "n2")],
                                "value string")
    q["small_batch_on_large_dict"], _ = once(lambda: load_batch(big, few, cfg=cfg))

    # values with ids and without, half each, against the same dictionary: by name, then joined with it folded
    def lookup(n):
        vals = big.stage(spark.range(n).select(F.concat(F.lit("e"), F.col("id") * (6_000_000 // n)).alias("col_val")), n, "vals")
        return timed(lambda: noop(big.known_columns(vals, "_test")), runs)

    q["lookup_500"] = lookup(500)
    q["fold_dict"], _ = once(lambda: big.compact_dicts("_test"))
    q["lookup_100k"] = lookup(100_000)

    ix = store.index("_test")
    calls = {
        "row": lambda: ix.columns(ix.row("ofield", "RF")),
        "range": lambda: ix.columns(ix.range("ofield", "NO", "1995-01-01", "1996-01-01")),
        "intersect": lambda: ix.columns(ix.intersect(ix.row("ofield", "RF"), ix.row("sfield", "q10"))),
        "count": lambda: ix.count(ix.union(ix.row("sfield", "q1"), ix.row("sfield", "q2"))),
        "topn": lambda: ix.topn("sfield", n=10),
        "topn_filtered": lambda: ix.topn("cfield", n=10, filter=ix.row("ofield", "AF")),
    }
    for name, fn in calls.items():
        q[name] = timed(lambda fn=fn: noop(fn()), runs)

    # bitmap rollup: built once and stored, then count / topn from bitmaps
    q["bitmap_build"], _ = once(lambda: store.write_rollup("_test"))
    bx = store.rollup_index("_test")
    q["bitmap_intersect_count"] = timed(lambda: noop(bx.count(bx.intersect(
        *bx.rows(("ofield", "RF"), ("sfield", "q10"))))), runs)
    q["bitmap_topn"] = timed(lambda: noop(bx.topn("sfield", n=10)), runs)

    total = sum(q.values())
    print(json.dumps({
        "metric": "total_sec", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "sf": sf, "cpus": cpus, "lines": n_lines, "bits": n_bits,
        "load_bits_per_sec": round(n_bits / q["full_load"], 1),
        "load_steps": reps[0].get("seconds"),
        "parse_lines_per_sec": round(n_lines / q["parse_to_bits"], 1),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
