"""Resumable loads: split run == single run, replay, refresh, compaction,
file batches over a gzip folder and the streaming load."""

import os

import pytest
from pyspark.sql import functions as F

from bitlake.operators.bits import bits_from_lines
from bitlake.plans.store import BitStore
from bitlake.sources.fixtures import event_log_lines, write_log_files
from bitlake.sources.logs import file_inventory
from bitlake.spec import IdConfig, ScanConfig
from bitlake.streaming.load import load_batch, run_load, stream_load

from conftest import SF001

CFG = IdConfig(shard_width=64, lanes=3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def lines(spark):
    return event_log_lines(spark, SF001).cache()


@pytest.fixture(scope="module")
def expected(lines):
    return rows(bits_from_lines(lines))


def test_split_run_equals_single_run(spark, lines, expected, workdir):
    a = BitStore(spark, workdir + "/a")
    run_load(spark, a, lines=lines, scan=ScanConfig(end_date="2024-01-10"), cfg=CFG)
    run_load(spark, a, lines=lines, cfg=CFG)
    b = BitStore(spark, workdir + "/b")
    run_load(spark, b, lines=lines, cfg=CFG)
    assert rows(a.decoded_bits()) == expected
    assert rows(b.decoded_bits()) == expected
    # shard state from the per-batch log equals the state derived from the dictionary
    from bitlake.operators.ids import shard_state
    key = lambda df: rows(df.select("shard", "last_id", "next_offset", "full"))
    assert key(a.shard_state("_test", CFG.shard_width)) == key(shard_state(a.col_dict("_test"), CFG.shard_width))
    # nothing left to do, nothing loaded again
    assert run_load(spark, a, lines=lines, cfg=CFG) == []
    # old ids unchanged by the second run
    first = BitStore(spark, workdir + "/c")
    run_load(spark, first, lines=lines, scan=ScanConfig(end_date="2024-01-10"), cfg=CFG)
    old = set(map(tuple, first.col_dict().collect()))
    assert old <= set(map(tuple, a.col_dict().collect()))


def test_replay_and_compaction(spark, lines, expected, workdir):
    s = BitStore(spark, workdir + "/r")
    load_batch(s, lines, cfg=CFG)
    n_rows, n_cols = s.row_dict().count(), s.col_dict().count()
    rep = load_batch(s, lines, cfg=CFG)          # crash-replay of the same batch
    assert rep["new_rows"] == 0 and rep["new_cols"] == 0
    assert (s.row_dict().count(), s.col_dict().count()) == (n_rows, n_cols)
    assert rows(s.decoded_bits()) == expected
    raw = s.read("fact").count()
    assert raw == 2 * s.facts().count()
    s.compact_facts("_test")
    assert s.read("fact").count() == s.facts().count()
    assert rows(s.decoded_bits()) == expected


def test_refresh(spark, lines, workdir):
    s = BitStore(spark, workdir + "/f")
    inv = lines.select("file_path", "dt", "part").distinct()
    s.append_marks(inv, "_test", 0, 1)
    s.append_marks(inv, "_test", 1, 2)
    s.refresh_marks("_test", 0)
    assert s.marks("_test").select("owner_node").distinct().collect()[0][0] == 1
    load_batch(s, lines, cfg=CFG)
    s.refresh_index("_test")
    assert s.facts().count() == 0 and s.row_dict().count() == 0 and s.col_dict().count() == 0


def test_file_batches_and_stream(spark, lines, expected, workdir):
    root = write_log_files(lines, workdir + "/logs")
    n_files = file_inventory(spark, root).count()
    s = BitStore(spark, workdir + "/files")
    reps = run_load(spark, s, root=root, scan=ScanConfig(max_files=40), cfg=CFG, until_done=True)
    assert len(reps) == -(-n_files // 40)
    assert sum(r["files"] for r in reps) == n_files
    assert s.marks("_test").count() == n_files
    assert rows(s.decoded_bits()) == expected
    st = BitStore(spark, workdir + "/stream")
    stream_load(spark, st, root, workdir + "/stream/_ckpt", cfg=CFG, max_files_per_trigger=80)
    assert rows(st.decoded_bits()) == expected
    assert st.marks("_test").count() == n_files
    # restart on the same checkpoint: no new files, nothing loaded again
    stream_load(spark, st, root, workdir + "/stream/_ckpt", cfg=CFG, max_files_per_trigger=80)
    assert st.marks("_test").count() == n_files


def test_owner_split_by_bucket(spark, lines, expected, workdir):
    s = BitStore(spark, workdir + "/own")
    for node in range(2):
        run_load(spark, s, lines=lines, scan=ScanConfig(node_id=node, nodes_total=2), cfg=CFG, owner_node=node)
    assert rows(s.decoded_bits()) == expected
    owners = dict(s.marks("_test").groupBy("owner_node").count().collect())
    assert set(owners) == {0, 1}
    assert s.marks("_test").where(F.pmod("bucket", F.lit(2)) != F.col("owner_node")).count() == 0


def test_stored_rollup_matches_facts(spark, lines, workdir):
    s = BitStore(spark, workdir + "/roll")
    run_load(spark, s, lines=lines, scan=ScanConfig(end_date="2024-01-10"), cfg=CFG, rollup=True)
    run_load(spark, s, lines=lines, cfg=CFG, rollup=True)      # two delta rollups
    _check_rollup(s)
    s.write_rollup("_test")
    s.write_rollup("_test")                      # a new version replaces the old one and the deltas
    assert not os.path.exists(workdir + "/roll/rollup_delta/index=_test") or \
        not os.listdir(workdir + "/roll/rollup_delta/index=_test")
    _check_rollup(s)


def _check_rollup(s):
    bx, ix = s.rollup_index("_test"), s.index("_test")
    a, b = ("ofield", "click"), ("sfield", "view")
    got = bx.count(bx.intersect(bx.row(*a), bx.row(*b))).collect()[0]["count"]
    assert got == ix.count(ix.row(*a) & ix.row(*b)).collect()[0]["count"]
    got = bx.count(bx.union(bx.row(*a), bx.row(*b))).collect()[0]["count"]
    assert got == ix.count(ix.row(*a) | ix.row(*b)).collect()[0]["count"]
    assert rows(bx.topn("sfield", 7)) == rows(ix.topn("sfield", 7))
    assert bx.count(bx.row("ofield", "no-such")).collect()[0]["count"] == 0


def test_skip_known_bits(spark, lines, expected, workdir):
    s = BitStore(spark, workdir + "/skip")
    load_batch(s, lines, cfg=CFG)
    n = s.read("fact").count()
    load_batch(s, lines, cfg=CFG, skip_known_bits=True)
    assert s.read("fact").count() == n
    assert rows(s.decoded_bits()) == expected


def test_listing_in_day_chunks(spark, lines, expected, workdir):
    root = write_log_files(lines, workdir + "/chunked-logs")
    s = BitStore(spark, workdir + "/chunked")
    reps = run_load(spark, s, root=root, cfg=CFG, days_per_listing=7)
    assert len(reps) == 5                     # 30 days, 7 per listing, one batch each
    assert rows(s.decoded_bits()) == expected
    assert run_load(spark, s, root=root, cfg=CFG, until_done=True, days_per_listing=7) == []


def test_one_big_file_is_spread(spark, workdir):
    import gzip
    import os as _os
    root = workdir + "/big"
    rows_ = []
    for f, n in (("dt=2024-01-01/part=0/big.gz", 3000), ("dt=2024-01-01/part=1/a.gz", 10),
                 ("dt=2024-01-02/part=0/b.gz", 10)):
        p = _os.path.join(root, f)
        _os.makedirs(_os.path.dirname(p), exist_ok=True)
        with gzip.open(p, "wt", newline="") as fh:
            for i in range(n):
                fh.write(f"2024-01-01 00:00:00\tu{i % 700}\tc{i % 5}\to{i % 3}\ts{i % 11},s{i % 13}\n")
                rows_.append(i)
    s = BitStore(spark, workdir + "/bigstore")
    rep = run_load(spark, s, root=root, cfg=CFG)
    assert sum(r["files"] for r in rep) == 3
    ix = s.index("_test")
    assert ix.count(ix.row("ofield", "o1")).collect()[0]["count"] == len({i % 700 for i in range(3000) if i % 3 == 1})


def test_a_log_folder_has_files_by_folder_not_by_task(spark, workdir):
    frame = spark.range(4000).select(
        F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string"), F.lit(" 00:00:00\tu\tc\to\ta")).alias("value"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 3).cast("int")).alias("dt"), (F.col("id") % 2).cast("int").alias("part"),
        F.concat(F.lit("f"), F.col("id").cast("string")).alias("file_path"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        root = write_log_files(frame, workdir + "/logs")
    finally:
        spark.conf.set(key, "true")
    found = [f for d, _, fs in os.walk(root) for f in fs if f.endswith(".gz")]
    assert len(found) == 6
    assert rows(spark.read.text(root).groupBy("dt", "part").count().select("count")) == rows(
        frame.groupBy("dt", "part").count().select("count"))


def test_batches_of_a_line_frame_read_their_own_part(spark, lines, expected, workdir, monkeypatch):
    from bitlake.streaming import load
    lines.write.parquet(workdir + "/lines")
    source = spark.read.parquet(workdir + "/lines")
    seen = []

    def noted(store, batch_lines, *a, **kw):
        seen.append((batch_lines.inputFiles(), batch_lines.count()))
        return load_batch(store, batch_lines, *a, **kw)
    monkeypatch.setattr(load, "load_batch", noted)
    n_files = lines.select("file_path").distinct().count()
    s = BitStore(spark, workdir + "/s")
    reps = run_load(spark, s, lines=source, cfg=CFG, files_per_batch=-(-n_files // 3))
    assert [r["files"] for r in reps[:-1]] == [-(-n_files // 3)] * 2 and sum(r["files"] for r in reps) == n_files
    assert not [f for fs, _ in seen for f in fs if workdir + "/lines/" in f]  # the frame is not read again
    assert sum(n for _, n in seen) == lines.count()
    assert rows(s.decoded_bits()) == expected
    # a run whose cap ends inside a day
    c = BitStore(spark, workdir + "/c")
    got = run_load(spark, c, lines=source, cfg=CFG, scan=ScanConfig(max_files=7), files_per_batch=3)
    assert [r["files"] for r in got] == [3, 3, 1]
