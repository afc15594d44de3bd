"""FIXTURES.md section 3: hand-derived answers on 8 edge-case lines."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from bitlake.functions.parse import parse_lines, reject_lines
from bitlake.operators.bits import set_bits, unpivot_bits
from bitlake.plans.query import Index
from bitlake.plans.store import BitStore
from bitlake.sources.logs import file_inventory, read_log_lines, scan_owned_buckets
from bitlake.spec import IdConfig
from bitlake.streaming.load import run_load

from golden import BATCH2, BATCH3, LINES, write


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("golden") / "pixel")
    write(root, LINES)
    lines = read_log_lines(spark, root)
    parsed = parse_lines(lines)
    bits = set_bits(unpivot_bits(parsed)).cache()
    return root, lines, parsed, bits, Index(bits)


def cols(df):
    return sorted(r[0] for r in df.collect())


def names(df):
    return sorted(os.path.basename(r["file_path"]) for r in df.collect())


def test_lines_and_rejects(golden):
    root, lines, parsed, bits, ix = golden
    assert lines.count() == 8
    rej = reject_lines(parsed).collect()
    assert len(rej) == 1 and rej[0]["value"].startswith("2018-07-01 12:00:00\tu5")


def test_bit_counts(golden):
    bits = golden[3]
    by_field = dict(bits.groupBy("field").count().collect())
    assert by_field == {"ofield": 6, "cfield": 6, "sfield": 7}
    no_day = dict(bits.select("field", "row_val", "col_val").distinct().groupBy("field").count().collect())
    assert no_day == {"ofield": 5, "cfield": 5, "sfield": 6}
    assert bits.where(F.col("day").isNull()).count() == 3


def test_bitmap_answers(golden):
    ix = golden[4]
    assert cols(ix.columns(ix.row("ofield", "o1"))) == ["u1", "u2", "u3"]
    assert cols(ix.columns(ix.range("ofield", "o1", "2018-07-01", "2018-07-02"))) == ["u1", "u3"]
    assert cols(ix.columns(ix.range("ofield", "o1", "2018-07-02", "2018-08-01"))) == ["u1"]
    assert cols(ix.columns(ix.range("ofield", "o2", "2018-07-01", "2018-09-01"))) == ["u2"]
    assert cols(ix.columns(ix.row("sfield", "a") | ix.row("sfield", "c"))) == ["u1", "u2", "u4"]
    assert ix.count(ix.row("ofield", "o1") & ix.row("sfield", "b")).collect()[0]["count"] == 2
    assert cols(ix.columns(ix.row("ofield", "o1") - ix.row("ofield", "o2"))) == ["u1", "u3"]
    assert ix.columns(ix.row("ofield", "zzz")).count() == 0


def test_topn(golden):
    ix = golden[4]
    top = [tuple(r) for r in ix.topn("sfield").collect()]
    assert top == [("b", 2), ("c", 2), ("", 1), ("a", 1)]
    assert [tuple(r) for r in ix.topn("cfield", n=1).collect()] == [("c2", 3)]
    assert [tuple(r) for r in ix.topn("sfield", filter=ix.row("ofield", "o2")).collect()] == [("c", 2), ("b", 1)]


def test_errors(golden):
    ix = golden[4]
    with pytest.raises(ValueError):
        ix.row("nofield", "x")
    with pytest.raises(TypeError):
        ix.row("ofield", 3)


def test_file_selection(spark, golden):
    root = golden[0]
    inv = file_inventory(spark, root)
    assert names(scan_owned_buckets(inv, 0, 2)) == ["a.gz", "c.gz"]
    assert names(file_inventory(spark, root, start="2018-07-01", end="2018-07-01")) == ["a.gz", "b.gz"]
    assert names(read_log_lines(spark, root, start="2018-07-02", end="2018-07-02").select("file_path").distinct()) == ["c.gz"]


def test_golden_ids(spark, tmp_path):
    root = str(tmp_path / "pixel")
    write(root, LINES)
    store = BitStore(spark, str(tmp_path / "store"))
    cfg = IdConfig(shard_width=2, lanes=2)
    run_load(spark, store, root=root, cfg=cfg)
    rows = {(r["field"], r["row_val"]): r["row_id"] for r in store.row_dict("_test").collect()}
    assert rows == {("ofield", "o1"): 0, ("ofield", "o2"): 1, ("cfield", "c1"): 0, ("cfield", "c2"): 1,
                    ("sfield", ""): 0, ("sfield", "a"): 1, ("sfield", "b"): 2, ("sfield", "c"): 3}
    colmap = lambda: {r["col_val"]: r["col_id"] for r in store.col_dict("_test").collect()}
    assert colmap() == {"u1": 0, "u2": 2, "u3": 1, "u4": 3}
    # u5 is only on the rejected line: no id
    write(root, BATCH2)
    run_load(spark, store, root=root, cfg=cfg)
    c = colmap()
    assert (c["u6"], c["u7"]) == (4, 6)
    write(root, BATCH3)
    run_load(spark, store, root=root, cfg=cfg)
    assert colmap()["u8"] == 5
    # all files marked once, facts decode to the value-space bits
    assert store.marks("_test").count() == 5
    ix = store.index("_test")
    assert cols(ix.columns(ix.row("ofield", "o1"))) == ["u1", "u2", "u3", "u6", "u7"]
    assert store.facts("_test").where(F.col("day") == dt.date(2018, 7, 4)).count() == 3


def test_report_lists_files_without_lines(spark, tmp_path):
    import gzip
    from bitlake.streaming.ingest import ingest_report
    root = str(tmp_path / "pixel")
    write(root, LINES)
    p = os.path.join(root, "dt=2018-07-01", "part=1", "empty.gz")
    with gzip.open(p, "wb"):
        pass                                   # a valid gzip with no lines
    inv = file_inventory(spark, root)
    rep = {os.path.basename(r["file_path"] or "*"): r for r in
           ingest_report(read_log_lines(spark, root), inventory=inv).collect()}
    assert rep["empty.gz"]["n_lines"] == 0
    assert (rep["a.gz"]["n_lines"], rep["b.gz"]["n_rejects"], rep["b.gz"]["n_bad_time"]) == (3, 1, 1)
    assert rep["*"]["n_lines"] == 8


def test_stream_processing_time_mode(spark, tmp_path):
    from bitlake.streaming.load import stream_load
    root = str(tmp_path / "pixel")
    write(root, LINES)
    store = BitStore(spark, str(tmp_path / "store"))
    q = stream_load(spark, store, root, str(tmp_path / "ckpt"), processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert store.marks("_test").count() == 3
    ix = store.index("_test")
    assert cols(ix.columns(ix.row("ofield", "o1"))) == ["u1", "u2", "u3"]
