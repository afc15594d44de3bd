"""Properties of the dictionaries: scalable rank, get-or-create, shards."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from bitlake.operators import ids
from bitlake.plans.registry import COL_DICT_SCHEMA, ROW_DICT_SCHEMA
from bitlake.spec import IdConfig


def test_rank_many_buckets_equals_global_row_number(spark):
    rnd = random.Random(7)
    vals = sorted({"".join(rnd.choice("abcxyz019") for _ in range(rnd.randint(0, 6))) for _ in range(6000)})
    rows = [(g, v) for g in ("f1", "f2") for v in vals if rnd.random() < 0.8]
    df = spark.createDataFrame(rows, "field string, row_val string")
    got = ids.dense_rank_at_scale(df, "row_val", ["field"], rows_per_bucket=300)
    want = df.withColumn("want", F.row_number().over(Window.partitionBy("field").orderBy("row_val")) - 1)
    j = got.join(want, ["field", "row_val"])
    assert j.count() == len(rows)
    assert j.where(F.col("rank") != F.col("want")).count() == 0


def _empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_row_ids_get_or_create(spark):
    v1 = spark.createDataFrame([("f", "b"), ("f", "a"), ("g", "z")], "field string, row_val string")
    d1 = ids.assign_row_ids(v1, _empty(spark, ROW_DICT_SCHEMA), "_t").cache()
    assert {(r.field, r.row_val): r.row_id for r in d1.collect()} == {("f", "a"): 0, ("f", "b"): 1, ("g", "z"): 0}
    v2 = spark.createDataFrame([("f", "c"), ("f", "a"), ("g", "y"), ("h", "q")], "field string, row_val string")
    d2 = ids.assign_row_ids(v2, d1, "_t").collect()
    assert {(r.field, r.row_val): r.row_id for r in d2} == {("f", "c"): 2, ("g", "y"): 1, ("h", "q"): 0}
    both = d1.unionByName(spark.createDataFrame(d2, ROW_DICT_SCHEMA))
    assert all(r.violations == 0 for r in ids.dict_integrity(both, "row").collect())


def test_column_ids_shards_and_lanes(spark):
    cfg = IdConfig(shard_width=16, lanes=3, rows_per_rank_bucket=20)
    d = _empty(spark, COL_DICT_SCHEMA)
    seen = {}
    for batch in range(4):
        vals = [(f"v{batch}-{i:03d}",) for i in range(37 + batch * 11)]
        new = ids.assign_column_ids(spark.createDataFrame(vals, "col_val string"), d, "_t", cfg).collect()
        for r in new:
            assert r.col_val not in seen
            seen[r.col_val] = r.col_id
            assert r.shard == r.col_id // cfg.shard_width
        d = spark.createDataFrame(d.collect() + new, COL_DICT_SCHEMA)
        if batch == 0:
            per_shard = {}
            for r in new:
                per_shard[r.shard] = per_shard.get(r.shard, 0) + 1
            fill = sorted(per_shard.values())
            assert fill[-1] <= cfg.shard_width
    assert len(set(seen.values())) == len(seen)
    st = ids.shard_state(d, cfg.shard_width).collect()
    assert all(r.ids_used <= cfg.shard_width for r in st)
    assert all(r.violations == 0 for r in ids.dict_integrity(d, "col").collect())


def test_owners_disjoint(spark):
    d = _empty(spark, COL_DICT_SCHEMA)
    out = {}
    for owner in range(3):
        cfg = IdConfig(shard_width=8, lanes=2, owner=owner, n_owners=3)
        vals = spark.createDataFrame([(f"o{owner}-{i}",) for i in range(30)], "col_val string")
        rows = ids.assign_column_ids(vals, d, "_t", cfg).collect()
        assert all(r.shard % 3 == owner for r in rows)
        out[owner] = {r.col_id for r in rows}
    assert not (out[0] & out[1]) and not (out[1] & out[2]) and not (out[0] & out[2])


def test_new_values_are_computed_once(spark, workdir):
    from pyspark.sql import functions as F
    from bitlake.operators.ids import assign_column_ids, assign_row_ids
    from bitlake.plans.registry import COL_DICT_SCHEMA, ROW_DICT_SCHEMA
    from bitlake.spec import IdConfig
    spark.range(300).select(F.lit("f").alias("field"), (F.col("id") % 50).cast("string").alias("row_val"),
                            F.col("id").cast("string").alias("col_val")).write.parquet(workdir + "/values")
    values = spark.read.parquet(workdir + "/values")
    cfg = IdConfig(shard_width=64, lanes=3, rows_per_rank_bucket=1000)
    r = assign_row_ids(values, spark.createDataFrame([], ROW_DICT_SCHEMA), "i", cfg)
    c = assign_column_ids(values, spark.createDataFrame([], COL_DICT_SCHEMA), "i", cfg)
    assert (r.count(), c.count()) == (50, 300)
    # the rank goes over its rows several times: over the written values, not over the source
    assert not [f for d in (r, c) for f in d.inputFiles() if "/values/" in f]


def test_dictionaries_and_facts_share_one_pass_over_the_lines(spark):
    from bitlake.operators.bits import set_bits
    from bitlake.plans.registry import Fixture
    from conftest import SF001
    fx = Fixture(spark, SF001)
    assert not [f for d in (fx.row_dict, fx.col_dict, fx.facts) for f in d.inputFiles() if "events.parquet" in f]
    assert fx.facts.count() == set_bits(fx.raw_bits).count()
