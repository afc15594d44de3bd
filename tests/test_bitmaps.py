"""Bitmaps: complement, difference, columns, periods; the writer mark and new entries."""

import datetime as dt
import random

import pytest

from bitlake.operators import bitmaps as B
from bitlake.plans.registry import Fixture
from bitlake.plans.store import BitStore
from bitlake.streaming.load import load_batch

from conftest import SF001


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    fx = Fixture(spark, SF001)
    s = BitStore(spark, str(tmp_path_factory.mktemp("bitmaps")))
    load_batch(s, fx.lines.where("dt <= '2024-01-15'"), "_test", fx.spec, fx.cfg)
    s.write_time_rollup("_test")
    load_batch(s, fx.lines.where("dt > '2024-01-15'"), "_test", fx.spec, fx.cfg)
    s.write_rollup("_test")
    return fx, s


def frame(spark, ids):
    facts = spark.createDataFrame([("f", 0, i) for i in ids] or [("f", 1, 0)], "field string, row_id long, col_id long")
    return B.row_bitmap(B.bitmap_index(facts), "f", 0)


def ids_of(bm):
    return sorted(r.col_id for r in B.bitmap_columns(bm).collect())


def test_set_algebra_against_sets(spark):
    rng = random.Random(6)
    some = [0, 1, 7, 8, 32767, 32768, 65535, 65536, 200_000]
    a = {*some, *(rng.randrange(100_000) for _ in range(300))}
    b = {*some[::2], *rng.sample(sorted(a), 100), *(rng.randrange(300_000) for _ in range(50))}
    c = {5, 32768, 99_999, 400_000}
    fa, fb, fc, none = (frame(spark, x) for x in (a, b, c, set()))
    assert ids_of(fa) == sorted(a) and ids_of(none) == []
    assert ids_of(B.minus_bitmaps(fa, fb, fc)) == sorted(a - b - c)
    assert ids_of(B.minus_bitmaps(fa)) == sorted(a) == ids_of(B.minus_bitmaps(fa, none))
    assert ids_of(B.minus_bitmaps(fa, fa)) == [] == ids_of(B.minus_bitmaps(none, fa))
    assert B.minus_bitmaps(fa, fa).count() == 0  # empty buckets go
    nested = B.minus_bitmaps(B.or_bitmaps(fa, fc), B.and_bitmaps(fa, fb))
    assert ids_of(nested) == sorted((a | c) - (a & b))
    assert B.bitmap_cardinality(nested).first()[0] == len((a | c) - (a & b))


def test_calendar_cover():
    day = dt.timedelta(days=1)
    rng = random.Random(2)
    for _ in range(200):
        start = dt.date(2023, 12, 1) + rng.randrange(500) * day
        end = start + rng.randrange(-5, 200) * day
        got = []
        for p in B.calendar_cover(start, end):
            if p > 1_000_000:
                got.append(dt.date(p // 10_000, p // 100 % 100, p % 100))
            else:
                d = dt.date(p // 100, p % 100, 1)
                while d.month == p % 100:
                    got.append(d)
                    d += day
        assert got == [start + k * day for k in range(max(0, (end - start).days))]
    assert B.calendar_cover(dt.date(2023, 12, 31), dt.date(2024, 3, 2)) == [20231231, 202401, 202402, 20240301]


@pytest.mark.parametrize("start,end", [("2024-01-01", "2024-02-01"), ("2024-01-03", "2024-01-05"), ("2023-06-15", "2024-03-10"),
                                       ("2024-01-05", "2024-01-05"), ("2025-01-01", "2026-01-01")])
def test_range_of_stored_periods_equals_facts(store, start, end):
    """The first batch is in the stored version, the second is read from its facts."""
    _, s = store
    bx, ix = s.rollup_index("_test"), s.index("_test")
    want = sorted(r[0] for r in ix.columns(ix.range("ofield", "purchase", start, end)).collect())
    assert sorted(r[0] for r in bx.columns(bx.range("ofield", "purchase", start, end)).collect()) == want
    assert bx.count(bx.range("ofield", "purchase", start, end)).first()[0] == len(want)


def test_range_reads_its_periods_only(store):
    _, s = store
    s.write_time_rollup("_test")
    bx = s.rollup_index("_test")
    p = bx.range("ofield", "view", "2024-01-01", "2024-02-03")._jdf.queryExecution().executedPlan().toString()
    assert "In(period, [202401,20240201,20240202])" in p and "EqualTo(row_id," in p
    assert bx.range("ofield", "no such", "2024-01-01", "2024-02-03").count() == 0
    s.refresh_index("_other")


def test_rollups_without_periods_or_fields_say_so(store):
    _, s = store
    bx = B.BitmapIndex(s.rollup("_test"), s.row_dict("_test"), "_test", ["ofield"])
    with pytest.raises(ValueError, match="no periods"):
        bx.range("ofield", "view", "2024-01-01", "2024-02-01")
    with pytest.raises(ValueError, match="not in the rollup"):
        bx.rows(("sfield", "view"))


def test_a_writer_mark_is_dropped_by_its_holder_only(spark, workdir):
    s = BitStore(spark, workdir)
    with pytest.raises(RuntimeError, match="taken away"):
        with s.writer("_test") as a_holds:
            a_holds()
            s.release_writer("_test")  # an operator thinks that A is dead
            b = s.writer("_test", wait_s=2)
            b_holds = b.__enter__()
            a_holds()
    b_holds()  # A's end has left B's mark alone
    with pytest.raises(TimeoutError):
        with s.writer("_test", wait_s=0.2, poll_s=0.05):
            pass
    b.__exit__(None, None, None)
    with s.writer("_test", wait_s=2):
        pass


def test_values_that_another_job_committed_meanwhile_are_refused(spark, workdir):
    s = BitStore(spark, workdir)
    rows = spark.createDataFrame([("_test", "f", 0, "x")], "index string, field string, row_id long, row_val string")
    s.append_row_dict(rows, "_test", 1)
    seen = s.dict_batches("_test")
    mine = spark.createDataFrame([("_test", "f", 1, "y")], rows.schema)
    s.check_unseen(mine, "row_dict", "_test", seen)
    s.append_row_dict(spark.createDataFrame([("_test", "f", 2, "y")], rows.schema), "_test", 2)  # one value, two ids
    with pytest.raises(RuntimeError, match="field, row_val"):
        s.check_unseen(mine, "row_dict", "_test", seen)
    with pytest.raises(RuntimeError, match="field, row_id"):
        s.check_unseen(spark.createDataFrame([("_test", "f", 2, "z")], rows.schema), "row_dict", "_test", seen)
    cols = spark.createDataFrame([("_test", 5, 0, "c")], "index string, col_id long, shard long, col_val string")
    seen = s.dict_batches("_test")
    s.append_col_dict(cols, "_test", 3)
    with pytest.raises(RuntimeError, match="col_val"):
        s.check_unseen(spark.createDataFrame([("_test", 6, 0, "c")], cols.schema), "col_lookup", "_test", seen)


def test_ids_are_shuffled_not_bitmaps(spark):
    import datetime as dt
    from bitlake.operators.bitmaps import bitmap_index, time_bitmap_index
    day = dt.date(2024, 1, 31)
    facts = spark.createDataFrame(
        [("f", 0, c, day + dt.timedelta(days=c % 2)) for c in (1, 2, 40000)] + [("f", 0, 1, day), ("f", 0, 5, None)],
        "field string, row_id long, col_id long, day date")
    for made in (bitmap_index(facts), time_bitmap_index(facts)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "bitmap_construct_agg" not in plan.split("Exchange", 1)[1]
    got = time_bitmap_index(facts).selectExpr("period", "bucket", "bitmap_count(bitmap) n").collect()
    assert {(r[0], r[1]): r[2] for r in got} == {
        (202402, 0): 1, (20240201, 0): 1, (202401, 0): 2, (20240131, 0): 2, (202401, 1): 1, (20240131, 1): 1}
