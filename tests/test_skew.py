"""A hot entity (a third of all lines) and a hot value: answers equal a
brute-force computation, through the full load and the id-space queries."""

import random

from bitlake.plans.store import BitStore
from bitlake.spec import IdConfig
from bitlake.streaming.load import load_batch


def test_hot_entity_and_value(spark, workdir):
    rnd = random.Random(3)
    lines, truth = [], set()
    for i in range(3000):
        col = "hot" if i % 3 == 0 else f"u{rnd.randint(0, 400)}"
        ofield = "click" if rnd.random() < 0.8 else f"o{rnd.randint(0, 9)}"
        sf = [f"s{rnd.randint(0, 300)}" for _ in range(rnd.randint(0, 3))]
        day = f"2024-01-{1 + i % 28:02d}"
        lines.append((f"{day} 10:00:00\t{col}\tc{i % 7}\t{ofield}\t{','.join(sf)}", i % 4, f"f{i % 10}"))
        truth |= {("ofield", ofield, col), ("cfield", f"c{i % 7}", col)} | {("sfield", s, col) for s in sf}
    df = spark.createDataFrame(lines, "value string, part int, file_path string")
    store = BitStore(spark, workdir + "/skew")
    load_batch(store, df, cfg=IdConfig(shard_width=128, lanes=4, rows_per_rank_bucket=50))
    ix = store.index("_test")

    def col_set(field, val):
        return {c for f, v, c in truth if f == field and v == val}
    got = {r["col_val"] for r in ix.columns(ix.row("ofield", "click")).collect()}
    assert got == col_set("ofield", "click")
    top = [tuple(r) for r in ix.topn("sfield", n=5).collect()]
    counts = {}
    for f, v, c in truth:
        if f == "sfield":
            counts[v] = counts.get(v, 0) + 1
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert top == want
    inter = ix.count(ix.row("ofield", "click") & ix.row("cfield", "c3")).collect()[0]["count"]
    assert inter == len(col_set("ofield", "click") & col_set("cfield", "c3"))
