"""Rules of the loads and queries that small clean input does not reach: odd
file names, exact caps, two writers, pruning as executed, stale rollups."""

import gzip
import os
import threading

import pytest
from pyspark.sql import functions as F

from bitlake.__main__ import _answer, _leaf, _parser
from bitlake.functions.parse import parse_ts, shard_of
from bitlake.operators import ids
from bitlake.operators.bits import bits_from_lines
from bitlake.operators.codec import decode_columns
from bitlake.plans.store import BitStore
from bitlake.session import checkpoint_dir
from bitlake.sources.logs import read_log_lines
from bitlake.spec import IdConfig, ScanConfig
from bitlake.streaming import load
from bitlake.streaming.load import load_batch, run_load, stream_load

from golden import BATCH2, BATCH3, LINES, write

CFG = IdConfig(shard_width=4, lanes=2)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def executed(df):
    """The plan that ran, with AQE's final choices."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def leaves(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return leaves(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return leaves(plan.plan())
    kids = plan.children()
    return [x for i in range(kids.size()) for x in leaves(kids.apply(i))] if kids.size() else [plan]


def decoded_rows(df):
    """Rows that the scans handed on: what row-group and page skipping left."""
    df.collect()
    scans = [x for x in leaves(df._jdf.queryExecution().executedPlan()) if "Scan" in x.getClass().getSimpleName()]
    assert scans
    return sum(x.metrics().get("numOutputRows").get().value() for x in scans)


def test_file_names_are_literal(spark, workdir):
    root = workdir + "/odd"
    names = ["a[1].gz", "a1.gz", "x{1}.gz", "s*.gz", "q?.gz", "b c.gz", "p%20+q.gz", "é.gz"]
    for i, n in enumerate(names):
        write(root, {f"dt=2018-07-0{1 + i % 2}/part=0/{n}": [f"2018-07-01 10:00:00\tu{i}\tc\to\ts"]})
    s = BitStore(spark, workdir + "/odd-store")
    assert sum(r["files"] for r in run_load(spark, s, root=root, cfg=CFG)) == len(names)
    assert {r.col_val for r in s.decoded_bits().collect()} == {f"u{i}" for i in range(len(names))}
    assert run_load(spark, s, root=root, cfg=CFG) == []
    stream_load(spark, s, root, workdir + "/odd-ckpt", cfg=CFG)  # the stream names files the same way
    assert s.marks("_test").count() == len(names)


def test_a_batch_that_would_read_other_files_is_not_marked(spark, workdir, monkeypatch):
    root = write(workdir + "/mm", LINES)
    s = BitStore(spark, workdir + "/mm-store")
    monkeypatch.setattr(load, "read_log_lines", lambda sp, r, paths: read_log_lines(sp, r, paths=paths[:1]))
    with pytest.raises(RuntimeError, match="other files"):
        run_load(spark, s, root=root, cfg=CFG)
    assert s.marks("_test").count() == 0 and s.read("fact").count() == 0


def test_cap_spans_listings(spark, workdir):
    root = workdir + "/cap"
    write(root, {f"dt=2018-07-{1 + i:02d}/part=0/f.gz": [f"2018-07-01 10:00:00\tu{i}\tc\to\ts"] for i in range(10)})
    s = BitStore(spark, workdir + "/cap-store")
    reps = run_load(spark, s, root=root, cfg=CFG, scan=ScanConfig(max_files=5), days_per_listing=3)
    assert sum(r["files"] for r in reps) == 5 == s.marks("_test").count()
    assert run_load(spark, s, root=root, cfg=CFG, scan=ScanConfig(max_files=0)) == []


def test_rejects_and_report_of_a_load(spark, workdir, tmp_path):
    root = write(workdir + "/rej", LINES)
    with gzip.open(root + "/dt=2018-07-02/part=0/empty.gz", "wt"):
        pass
    for name in ("batch", "stream"):
        s = BitStore(spark, f"{workdir}/rej-{name}")
        if name == "batch":
            rep, = run_load(spark, s, root=root, cfg=CFG)
            assert (rep["files"], rep["lines"], rep["rejects"], rep["bad_times"]) == (4, 8, 1, 1) and rep["bytes"] > 0
        else:
            stream_load(spark, s, root, str(tmp_path / "ckpt"), cfg=CFG)
        r, = s.rejects().collect()
        assert r.value.endswith("u5\tc2\to1") and r.reason == "positions=4 < 5" and r.part == 1 and r.file_path.endswith("b.gz")
        by = {os.path.basename(x.file_path): (x.n_lines, x.n_rejects, x.n_bad_time) for x in s.load_report().collect()}
        assert by.items() >= {"a.gz": (3, 0, 0), "b.gz": (3, 1, 1), "c.gz": (2, 0, 0)}.items()


def test_decoding_a_small_answer_reads_one_id_group(spark, workdir):
    s = BitStore(spark, workdir + "/groups")
    col = (F.col("id") % 16) * (1 << 26) + F.col("id")
    shard = F.lit(0).cast("long")
    s.append_col_dict(spark.range(1600).select(col.alias("col_id"), shard.alias("shard"),
                                               F.concat(F.lit("v"), F.col("id").cast("string")).alias("col_val")), "_test", 1)
    s.append_row_dict(spark.createDataFrame([("ofield", 0, "o1"), ("ofield", 1, "o2")],
                                            "field string, row_id long, row_val string"), "_test", 1)
    s.append_facts(spark.range(1600).select(F.lit("ofield").alias("field"), shard.alias("shard"),
                                            (F.col("id") != 5).cast("long").alias("row_id"), col.alias("col_id"),
                                            F.lit(None).cast("date").alias("day")), "_test", 1)
    ix = s.index("_test")
    out = ix.columns(ix.row("ofield", "o1"))
    plan = executed(out)
    assert rows(out) == [("v5",)]
    scans = [x for x in plan.split("FileScan")[1:] if "col_val" in x.split("\n")[0]]
    assert scans and all("dynamicpruning" in x for x in scans) and "dynamicpruningexpression(true)" not in plan
    with pytest.raises(Exception, match="unknown column id 77"):
        decode_columns(spark.createDataFrame([(77,)], "col_id long"), s.col_dict("_test")).collect()
    odd = decode_columns(spark.createDataFrame([(77,)], "col_id long"), s.col_dict("_test"), strict=False)
    assert [r.col_val for r in odd.collect()] == ["77"]


def test_a_small_batch_does_not_move_the_dictionary(spark, workdir):
    s = BitStore(spark, workdir + "/lookup")
    entries = spark.range(200_000).select(F.col("id").alias("col_id"), F.lit(0).cast("long").alias("shard"),
                                          F.concat(F.lit("v"), F.col("id").cast("string")).alias("col_val"))
    s.append_col_dict(entries, "_test", 1)
    vals = s.stage(spark.createDataFrame([("v7",), ("new",), (None,)], "col_val string"), 2, "vals")
    known = s.known_columns(vals, "_test")
    assert rows(known) == [("v7", 7, 0)]
    plan = executed(known)
    assert "Exchange" not in plan and "Join" not in plan and "col_val" in plan.split("PushedFilters")[1].split("]")[0]
    assert decoded_rows(known) <= 3 * 500  # a page or so of 200,000 entries


def test_lookups_by_name_decode_few_entries(spark, workdir):
    s = BitStore(spark, workdir + "/named")
    entries = spark.range(300_000).select(F.col("id").alias("col_id"), F.lit(0).cast("long").alias("shard"),
                                          F.concat(F.lit("v"), F.col("id").cast("string")).alias("col_val"))
    s.append_shard_log(entries, "_test", 1)
    s.append_col_dict(entries, "_test", 1)
    new = s.stage(spark.range(500).select(F.concat(F.lit("v"), F.col("id") * 600, F.lit("x")).alias("col_val")), 2, "new")
    old = s.stage(spark.range(50).select(F.concat(F.lit("v"), F.col("id") * 5_999).alias("col_val")), 2, "old")
    none = s.stage(old.limit(0), 2, "none")
    for folded in (False, True):
        known = s.known_columns(new, "_test")
        assert rows(known) == [] and decoded_rows(known) < 30_000  # Bloom filters: under a tenth
        known = s.known_columns(old, "_test")
        assert sorted(r.col_id for r in known.collect()) == [i * 5_999 for i in range(50)]
        if not folded:
            assert decoded_rows(known) <= 50 * 2 * 500             # a page or two for each
        known = s.known_columns(old.where("col_val in ('v0', 'v5999')"), "_test")
        assert len(rows(known)) == 2 and decoded_rows(known) <= 2 * 20_000  # at most a row group for each
        assert rows(s.known_columns(none, "_test")) == []
        s.compact_dicts("_test")


def test_a_large_batch_meets_the_folded_dictionary_bucket_by_bucket(spark, workdir):
    s = BitStore(spark, workdir + "/buckets")
    def entries(lo, hi):
        return spark.range(lo, hi).select(F.col("id").alias("col_id"), F.lit(0).cast("long").alias("shard"),
                                          F.concat(F.lit("v"), F.col("id").cast("string")).alias("col_val"))
    for b, (lo, hi) in enumerate([(0, 400_000), (400_000, 600_000), (600_000, 600_100)]):
        s.append_shard_log(entries(lo, hi), "_test", b + 1)
        s.append_col_dict(entries(lo, hi), "_test", b + 1)
        if b == 1:
            s.compact_dicts("_test")
    assert s._base("_test")[1]["buckets"] > 1
    vals = s.stage(spark.range(1_000_000).select(F.concat(F.lit("v"), F.col("id") + 300_000).alias("col_val")), 9, "vals")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # both sides too large to broadcast
    try:
        known = s.known_columns(vals, "_test")
        assert known.count() == 300_100 and known.agg(F.sum("col_id")).first()[0] == sum(range(300_000, 600_100))
        plan = executed(known)
        side = plan.split("Bucketed: true")[0].rsplit("Exchange", 1)[1]  # from the last exchange above the folded scan
        assert "Bucketed: true" in plan and "FileScan" in side.split("spark_catalog")[0]  # that exchange is of the batch
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # another session meets the folder without the catalog's name; a fold half done is not read
    spark.sql("DROP TABLE " + s._lookups("_test")[0]._jdf.queryExecution().analyzed().collectLeaves().apply(0)
              .catalogTable().get().identifier().unquotedString())
    spark.range(1).write.parquet(f"{workdir}/buckets/col_base/index=_test/version=9999999999999999")
    assert s.col_lookup("_test").count() == 600_100
    s.compact_dicts("_test")
    assert s.col_lookup("_test").count() == 600_100 and rows(
        s.known_columns(vals.where("col_val = 'v300000'"), "_test")) == [("v300000", 300_000, 0)]
    s.refresh_index("_test")
    assert s.col_lookup("_test").count() == 0


def test_stream_leaves_what_a_load_has_marked(spark, workdir):
    root = write(workdir + "/both", LINES)
    s = BitStore(spark, workdir + "/both-store")
    run_load(spark, s, root=root, cfg=CFG)
    facts, marks = s.read("fact").count(), s.marks("_test").count()
    stream_load(spark, s, root, workdir + "/both-ckpt", cfg=CFG)
    assert (s.read("fact").count(), s.marks("_test").count()) == (facts, marks)
    write(root, BATCH2 | BATCH3)
    stream_load(spark, s, root, workdir + "/both-ckpt", cfg=CFG, scan=ScanConfig(end_date="2018-07-03"))
    assert s.marks("_test").count() == marks + 1


def test_two_owner_jobs_side_by_side(spark, workdir):
    root = write(workdir + "/own", LINES | BATCH2 | {"dt=2018-07-03/part=1/d2.gz": ["2018-07-03 05:00:00\tu9\tc1\to1\ta,z"]})
    s = BitStore(spark, workdir + "/own-store")
    failed = []

    def job(node):
        try:
            run_load(spark, BitStore(spark, s.root), root=root, scan=ScanConfig(node_id=node, nodes_total=2),
                     cfg=IdConfig(shard_width=4, lanes=2, owner=node, n_owners=2), owner_node=node)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=job, args=(n,)) for n in range(2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    for d, kind in ((s.row_dict(), "row"), (s.col_dict(), "col")):
        assert {r.violations for r in ids.dict_integrity(d, kind).collect()} == {0}
    assert rows(s.decoded_bits()) == rows(bits_from_lines(read_log_lines(spark, root)))
    with s.writer("_test"), pytest.raises(TimeoutError), s.writer("_test", wait_s=0.2, poll_s=0.1):
        pass
    before = rows(s.decoded_bits())
    s.compact_dicts("_test")
    assert rows(s.decoded_bits()) == before and len({r.batch_id for r in s.read("row_dict").collect()}) == 1


def test_entries_that_break_a_key_are_not_committed(spark):
    rd = spark.createDataFrame([("_test", "f", 0, "a")], "index string, field string, row_id long, row_val string")
    for bad in ([("_test", "f", 0, "b")], [("_test", "f", 1, "b"), ("_test", "f", 1, "c")]):
        with pytest.raises(RuntimeError, match="unique key"):
            ids.check_row_entries(spark.createDataFrame(bad, rd.schema), rd, "_test")
    ids.check_row_entries(spark.createDataFrame([("_test", "f", 1, "b")], rd.schema), rd, "_test")


def test_range_reads_its_days(spark, workdir):
    root = write(workdir + "/mon", LINES)
    s = BitStore(spark, workdir + "/mon-store")
    run_load(spark, s, root=root, cfg=CFG)
    ix = s.index("_test")
    out = ix.columns(ix.range("ofield", "o1", "2018-07-01", "2018-07-02"))
    plan = out._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")]
    assert any("EqualTo(row_id," in f and "GreaterThanOrEqual(day,2018-07-01)" in f and "LessThan(day,2018-07-02)" in f
               for f in pushed)
    assert rows(out) == [("u1",), ("u3",)]
    assert rows(ix.columns(ix.range("ofield", "o1", "2018-07-02", "2018-08-02"))) == [("u1",), ("u2",)]
    with pytest.raises(ValueError):
        ix.range("ofield", "o1", "2018-07-01garbage", "2018-07-02")


def test_row_and_range_skip_what_they_do_not_ask_for(spark, workdir):
    """2,000,000 bits, half of them of one row, over 700 days, in one batch."""
    s = BitStore(spark, workdir + "/skip")
    n = 2_000_000
    day = F.date_add(F.lit("2018-01-01").cast("date"), F.pmod(F.xxhash64("id"), F.lit(700)).cast("int"))
    facts = spark.range(n).select(F.lit("f").alias("field"), F.lit(0).cast("long").alias("shard"), F.when(
        F.col("id") % 2 == 0, 0).otherwise(F.pmod(F.hash("id"), F.lit(1000)) + 1).cast("long").alias("row_id"),
        F.col("id").alias("col_id"), day.alias("day"))
    s.append_facts(facts, "_test", 1)
    f = s.read("fact").where(F.col("index") == "_test")
    assert len(f.inputFiles()) <= 16
    one = f.where((F.col("field") == "f") & (F.col("row_id") == 17)).select("col_id")
    assert one.count() > 500 and decoded_rows(one) < n / 10
    days = f.where((F.col("row_id") == 0) & (F.col("day") >= "2018-07-01") & (F.col("day") < "2018-07-08")).select("col_id")
    assert days.count() > 5_000 and decoded_rows(days) < n / 10


def test_a_rollup_never_answers_stale(spark, workdir):
    root = write(workdir + "/ru", LINES)
    s = BitStore(spark, workdir + "/ru-store")
    run_load(spark, s, root=root, cfg=CFG)
    s.write_rollup("_test", fields=["ofield"])
    bx = s.rollup_index("_test")
    assert bx.count(bx.row("ofield", "o1")).first()[0] == 3
    with pytest.raises(ValueError, match="not in the rollup"):
        bx.row("sfield", "a")
    write(root, BATCH2)
    run_load(spark, s, root=root, cfg=CFG)
    with pytest.raises(ValueError, match="lacks 1"):
        s.rollup_index("_test")
    s.write_rollup("_test")
    write(root, BATCH3)
    run_load(spark, s, root=root, cfg=CFG, rollup=True)
    bx = s.rollup_index("_test")
    assert bx.count(bx.union(*bx.rows(("ofield", "o1"), ("ofield", "o3")))).first()[0] == 6
    s.compact_facts("_test")
    bx = s.rollup_index("_test")
    assert bx.count(bx.row("ofield", "o1")).first()[0] == 5


def test_two_indexes_keep_their_own_shards(spark, workdir):
    s = BitStore(spark, workdir + "/two")
    lines = spark.createDataFrame([(f"2018-07-01 10:00:00\tu{i}\tc\to\ts",) for i in range(9)], "value string")
    load_batch(s, lines, "one", cfg=CFG)
    # "two" has a dictionary from elsewhere and no log of its own
    s.append_col_dict(spark.createDataFrame([(0, 0, "x0"), (1, 0, "x1")], "col_id long, shard long, col_val string"), "two", 1)
    load_batch(s, lines, "two", cfg=CFG)
    assert {r.violations for r in ids.dict_integrity(s.col_dict("two"), "col").collect()} == {0}
    assert s.col_dict("two").count() == 11
    with pytest.raises(ValueError, match="index name"):
        load_batch(s, lines, "a/b", cfg=CFG)


def test_rank_over_many_ranges_at_default_settings(spark):
    n = 130_000
    df = spark.range(n).select(F.format_string("k%07d", (F.col("id") * 7919) % n).alias("v"))
    out = ids.dense_rank_at_scale(df, "v")
    assert "cast(_bucket" in out._jdf.queryExecution().toString() or "_bucket" in out._jdf.queryExecution().toString()
    assert out.where(F.col("rank") != F.substring("v", 2, 7).cast("long")).count() == 0 and out.count() == n


def test_fractions_big_ids_and_lanes(spark):
    df = spark.createDataFrame([(f"2018-07-01 10:00:00{f}",) for f in ("", ".1", ".1234567", ".123456789")], "t string")
    assert df.select(parse_ts("t").alias("x")).where("x is null").count() == 0
    big = (1 << 53) + 1
    r = spark.createDataFrame([(big * 3 + 2,)], "i long").select(shard_of("i", 3), ids._idiv(F.col("i"), 3)).first()
    assert tuple(r) == (big, big)
    lanes = [(s, 1) for s in range(500)]
    shard, col_id = ids.column_id_expr(F.col("r"), lanes, 500, IdConfig(shard_width=4, lanes=500))
    got = spark.range(1000).select(F.col("id").alias("r")).select("r", shard.alias("s"), col_id.alias("c")).collect()
    assert all(x.s == x.r % 500 and x.c == 4 * x.s + 1 + x.r // 500 for x in got)


def test_checkpoint_folder_is_required_off_local_mode():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_cli_leaves(spark, workdir):
    root = write(workdir + "/cli", {"dt=2018-07-01/part=0/a.gz": [
        f"2018-07-01 10:00:00\tu{i}\tc@x..y\to\ts" for i in range(150)]})
    s = BitStore(spark, workdir + "/cli-store")
    run_load(spark, s, root=root, cfg=IdConfig(lanes=2))
    ix = s.index("_test")

    def ask(*args):
        return _answer(ix, _parser().parse_args(["--store", "x", "query", *args]))

    assert _parser().parse_args(["--store", "x", "query", "row"]).limit is None
    assert ask("row", "--leaf", "ofield=o").count() == 150
    assert ask("range", "--leaf", "ofield=o@2018-07-01..2018-07-02").count() == 150
    assert _leaf(ix, "cfield=a@b.com").leaf == ("cfield", "a@b.com", None, None)
    for bad in (["row", "--leaf", "ofield=o", "--leaf", "ofield=p"], ["range", "--leaf", "ofield=o"], ["row"], ["count"],
                ["row", "--leaf", "ofield"]):
        with pytest.raises(SystemExit):
            ask(*bad)
