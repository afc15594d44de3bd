"""Set-algebra properties and equality of value-space and id-space answers."""

import pytest

from bitlake.plans.registry import Fixture

from conftest import SF001


@pytest.fixture(scope="module")
def fx(spark):
    return Fixture(spark, SF001)


def n(df):
    return df.count()


def test_union_intersect_identity(fx):
    ix = fx.value_index
    a, b = ix.row("ofield", "click"), ix.row("sfield", "view")
    assert n((a | b).df) + n((a & b).df) == n(a.df) + n(b.df)
    # A\B and A∩B partition A
    assert n((a - b).df) + n((a & b).df) == n(a.df)
    assert n(((a - b) & (a & b)).df) == 0


def test_topn_total_is_sum_of_row_counts(fx):
    ix = fx.value_index
    total = sum(r["Count"] for r in ix.topn("ofield").collect())
    parts = sum(ix.count(ix.row("ofield", t)).collect()[0]["count"]
                for t in ("click", "view", "purchase", "signup", "error"))
    assert total == parts


@pytest.mark.parametrize("name", ["row", "range", "union", "intersect", "difference", "nested",
                                  "count_bitmap", "topn", "topn_filtered", "batch_calls"])
def test_id_space_equals_value_space(fx, name):
    from bitlake.plans.registry import QUERIES
    v = sorted(map(tuple, QUERIES[name](fx).collect()), key=str)
    i = sorted(map(tuple, QUERIES[name + "_ids"](fx).collect()), key=str)
    assert v == i


def test_unseen_value_is_empty_and_creates_nothing(fx):
    ix = fx.id_index
    before = fx.row_dict.count()
    assert ix.columns(ix.row("ofield", "no-such-value")).count() == 0
    assert ix.count(ix.row("ofield", "no-such-value")).collect()[0]["count"] == 0
    assert fx.row_dict.count() == before


def test_bitmap_rollup_counts_equal_facts(fx):
    from bitlake.plans.registry import QUERIES
    got = dict((r["kind"], r["count"]) for r in QUERIES["bitmap_count"](fx).collect())
    ix = fx.value_index
    a, b = ix.row("ofield", "click"), ix.row("sfield", "view")
    assert got == {"intersect": n((a & b).df), "union": n((a | b).df)}


def test_fused_leaves_equal_pairwise(fx):
    ix = fx.id_index
    a, b, c = ix.row("sfield", "view"), ix.row("sfield", "click"), ix.range("sfield", "error", "2024-01-02", "2024-01-09")
    pairwise = a.df.intersect(b.df)
    assert sorted(map(tuple, (a & b).df.collect())) == sorted(map(tuple, pairwise.collect()))
    u = a.df.unionByName(b.df).unionByName(c.df).distinct()
    assert sorted(map(tuple, ix.union(a, b, c).df.collect())) == sorted(map(tuple, u.collect()))
    # same key twice: A & A == A
    assert ix.intersect(a, ix.row("sfield", "view")).df.count() == a.df.count()


def test_codec_unknown_ids(spark, fx):
    from bitlake.operators.codec import decode_columns, decode_rows
    rows = spark.createDataFrame([("ofield", 10**9)], "field string, row_id long")
    assert decode_rows(rows, fx.row_dict, "_test").collect()[0]["row_val"] == ""
    cols = spark.createDataFrame([(10**12,)], "col_id long")
    assert decode_columns(cols, fx.col_dict, "_test", strict=False).collect()[0]["col_val"] == str(10**12)
    with pytest.raises(Exception, match="unknown column id"):
        decode_columns(cols, fx.col_dict, "_test", strict=True).collect()


def test_fused_difference_equals_anti_join(fx):
    for ix in (fx.value_index, fx.id_index):
        a, b, c = ix.row("cfield", "k1"), ix.row("cfield", "k2"), ix.row("cfield", "k3")
        want = a.df.join(b.df.unionByName(c.df), ix.ccol, "left_anti")
        assert sorted(map(tuple, ix.difference(a, b, c).df.collect())) == sorted(map(tuple, want.collect()))
        r1 = ix.range("ofield", "view", "2024-01-01", "2024-01-10")
        r2 = ix.range("ofield", "click", "2024-01-01", "2024-01-10")
        want = r1.df.join(r2.df, ix.ccol, "left_anti")
        assert sorted(map(tuple, (r1 - r2).df.collect())) == sorted(map(tuple, want.collect()))
        assert (a - ix.row("cfield", "k1")).df.count() == 0


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]


def test_many_calls_read_facts_and_dictionary_once(spark, workdir):
    """50 nested calls over a store: the same answers as one by one, two scans in all."""
    from bitlake.plans.query import Count, batch_calls
    from bitlake.plans.registry import _nested_calls
    from bitlake.plans.store import BitStore
    from bitlake.streaming.load import load_batch
    fx = Fixture(spark, SF001)
    s = BitStore(spark, workdir)
    load_batch(s, fx.lines, "_test", fx.spec, fx.cfg)
    ix = s.index("_test", fx.spec)
    calls = _nested_calls(ix)
    out = batch_calls(ix, calls)
    p = executed(out)
    assert p.count("FileScan parquet") == 2
    got = {}
    for r in out.collect():
        got.setdefault(r.call_no, []).append(r.key if r.kind == "bitmap" else r["count"])
    for i, c in list(enumerate(calls))[::7]:
        want = ([ix.count(c.bitmap).first()[0]] if isinstance(c, Count)
                else [r.col_val for r in ix.columns(c).collect()])
        assert sorted(got.get(i, [])) == sorted(want)


def test_shared_masks_take_every_kind_of_call(fx):
    from bitlake.plans.query import Count, batch_calls
    for ix in (fx.value_index, fx.id_index):
        a, b = ix.row("ofield", "click"), ix.row("cfield", "nowhere")
        calls = [Count(a), Count(b), Count(a | b), Count(a & b), Count(a - b), Count(b - a), Count(ix.union()),
                 Count(ix.intersect()), a & b, Count(ix.intersect(a)), ix.count(a), ix.topn("ofield", 1)]
        n = {r.call_no: r["count"] for r in batch_calls(ix, calls).collect()}
        k = ix.count(a).first()[0]
        assert [n.get(i) for i in range(11)] == [k, 0, k, 0, k, 0, 0, 0, None, k, k] and 11 in n
        # more leaves than one word holds
        rows = [ix.row("cfield", f"k{i}") for i in range(130)]
        many = {r.call_no: r["count"] for r in batch_calls(ix, [Count(r) for r in rows] + [Count(ix.union(*rows))]).collect()}
        assert many[130] == ix.count(ix.union(*rows)).first()[0]
        assert many[125] == ix.count(rows[125]).first()[0] and sum(many[i] for i in range(130)) >= many[130]
    opaque = type(a)(ix, a.df)
    assert batch_calls(ix, [Count(opaque), Count(opaque | b)]).count() == 2
    with pytest.raises(ValueError):
        batch_calls(ix, [])


def test_an_answer_is_decoded_from_one_scan(spark, workdir):
    from bitlake.operators.codec import decode_distinct
    from bitlake.plans.store import BitStore
    from bitlake.streaming.load import load_batch
    fx = Fixture(spark, SF001)
    s = BitStore(spark, workdir)
    load_batch(s, fx.lines, "_test", fx.spec, fx.cfg)
    ix = s.index("_test", fx.spec)
    out = ix.columns(ix.row("ofield", "click"))
    assert executed(out).count("FileScan parquet") == 2
    assert sorted(r[0] for r in out.collect()) == sorted(
        r[0] for r in fx.value_index.columns(fx.value_index.row("ofield", "click")).collect())
    odd = spark.createDataFrame([(10**12,)], "col_id long")
    assert decode_distinct(odd, s.col_dict("_test"), strict=False).collect()[0]["col_val"] == str(10**12)
    with pytest.raises(Exception, match="unknown column id"):
        decode_distinct(odd, s.col_dict("_test")).collect()
