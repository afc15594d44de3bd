"""Exact, substring, suffix-array and SimHash deduplication against brute force."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import data  # noqa: E402

from bitlake.llm import exact_dedup, graph, repeats, simhash, substring_dedup, suffix_array_dedup  # noqa: E402
from bitlake.llm.suffix import SuffixArray  # noqa: E402

ORDER = lambda r: tuple((x is None, x) for x in r)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=ORDER)


@pytest.fixture(scope="module")
def docs(spark):
    df, rows = data.documents(spark)
    return df.cache(), rows


@pytest.mark.parametrize("op,plain", [
    (substring_dedup.substring_dedup, brute.substring_dedup),
    (suffix_array_dedup.suffix_array_dedup, brute.suffix_array_dedup),
    (simhash.simhash_dedup, brute.simhash), (exact_dedup.exact_dedup, brute.exact)])
def test_against_brute_force(docs, op, plain):
    df, rows = docs
    assert rows_of(op(df)) == sorted(plain([r[:2] for r in rows]), key=ORDER)


@pytest.mark.parametrize("op", [substring_dedup.substring_dedup, suffix_array_dedup.suffix_array_dedup,
                                simhash.simhash_dedup, exact_dedup.exact_dedup])
def test_empty_table(spark, op):
    out = op(data.empty(spark))
    assert out.count() == 0 and out.columns[0] == "doc_id"


def test_exact_keeps_one_of_each_text(docs):
    df, rows = docs
    for keep, pick in (("largest", max), ("smallest", min)):
        out = exact_dedup.exact_dedup(df, keep).collect()
        assert sum(r.kept for r in out) == len({t or "" for _, t, _ in rows})
        by = {}
        for i, t, _ in rows:
            by.setdefault(brute.sha((t or "").encode()), []).append(i)
        for r in out:
            some = [i for i in by[r.text_sha256] if i is not None]
            assert r.keep_id == (pick(some) if some else None)


@pytest.mark.parametrize("words,op,plain", [(True, substring_dedup, brute.substring_dedup),
                                            (False, suffix_array_dedup, brute.suffix_array_dedup)])
def test_hot_anchors_are_counted_exactly(docs, monkeypatch, words, op, plain):
    """With groups of two classes at most, the counting path does the work."""
    df, rows = docs
    monkeypatch.setattr(repeats.repeated_spans, "__defaults__", (2,))
    run = op.substring_dedup if words else op.suffix_array_dedup
    assert rows_of(run(df)) == sorted(plain([r[:2] for r in rows]), key=ORDER)


@pytest.mark.parametrize("seed", range(6))
def test_solvers_find_all_repeats(seed):
    """Both solvers cover what a window count covers, on low-entropy sequences."""
    rng = np.random.default_rng(seed)
    seqs = [rng.integers(1, 3 + seed, rng.integers(1, 60)).astype(np.uint64) for _ in range(12)]
    seqs += [seqs[3], seqs[5][2:]]
    ends = np.cumsum([len(s) + 1 for s in seqs]) - 1
    laid = np.concatenate([np.append(s, 0) for s in seqs]).astype(np.uint64)
    want = np.concatenate([np.append(d, False) for d in brute.repeated([tuple(s.tolist()) for s in seqs], 7)])
    for found in ([(n, p) for n, p in substring_dedup.repeats(laid, ends, 7, subtree=5)],
                  list(_split(*suffix_array_dedup.maximal_repeats(laid, ends, 7)))):
        got = np.zeros(len(laid), bool)
        for n, places in found:
            assert len(places) > 1
            assert len({tuple(laid[p:p + n].tolist()) for p in places.tolist()}) == 1
            for p in places.tolist():
                got[p:p + n] = True
        assert (got == want).all()


def _split(size, n, places):
    at = 0
    for s, k in zip(size.tolist(), n.tolist()):
        yield s, places[at:at + k]
        at += k


def test_suffix_array_order():
    rng = np.random.default_rng(1)
    laid = rng.integers(1, 4, 200).astype(np.uint64)
    ends = np.array([49, 120, 199])
    sa = SuffixArray(laid, ends)
    key = [tuple(sa.ids[i:].tolist()) for i in range(200)]
    assert sa.order.tolist() == sorted(range(200), key=key.__getitem__)
    for i in range(1, 200):
        a, b = key[sa.order[i - 1]], key[sa.order[i]]
        assert sa.lcp[i] == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_bk_tree_and_split_shards(spark):
    """Links of clustered fingerprints, with shards split to the last level."""
    rng = random.Random(2)
    fps = set()
    for _ in range(6):
        c = rng.getrandbits(64)
        for _ in range(25):
            f = c
            for _ in range(rng.randint(0, 5)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    tree = simhash.BKTree(np.array(fps, np.uint64))
    got = {(n, int(q)) for n, hit in tree.search(np.array(fps, np.uint64), 4) for q in hit}
    assert got == {(a, b) for a in range(len(fps)) for b in range(len(fps)) if (fps[a] ^ fps[b]).bit_count() <= 4}
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                up[find(a)] = find(b)
    want = {frozenset(f for f in fps if find(f) == r) for r in {find(f) for f in fps}}
    df = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp bigint")
    for shard_rows in (2, 4096):
        rows = simhash.classes(df, 4, shard_rows).collect()
        by = {}
        for r in rows:
            by.setdefault(r.root, set()).add(r.fp % (1 << 64))
        assert {frozenset(x) for x in by.values()} == want


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    got = dict(graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert got == {i: 0 for i in range(1, 61)} | {101: 100}


def test_keep_one_keeps_all_columns(docs):
    df, rows = docs
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    classes = {c for *_, c in brute.simhash([r[:2] for r in rows])}
    assert out.count() == len(classes) and {r.doc_id for r in out.collect()} == classes


@pytest.mark.parametrize("group", [repeats.GROUP, 1])
def test_repeated_rows_are_read_and_collected_once(spark, group):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    shared = rng.choices(words, k=80)
    hot = " ".join(rng.choices(words, k=30) + shared + rng.choices(words, k=30))
    other = [" ".join(rng.choices(words, k=30) + shared[9 * i:] + rng.choices(words, k=30)) for i in range(4)]
    docs = [(None, hot)] * 300 + list(enumerate(other))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    tx = repeats.keyed(df).filter("doc_id is null").first().tx
    wanted = spark.createDataFrame([(-(1 << 62), tx, 1, 2, 0, 40)],
                                   "k long, tx long, a long, c long, start int, len int")
    assert repeats._texts(df, wanted, True).count() <= 8  # one a task at most, not one a row
    spans = {(r.k, r.tx): [tuple(x) for x in r.spans] for r in repeats.repeated_spans(
        df, substring_dedup.WINDOW, substring_dedup.GRAM, True, substring_dedup.solve, group).collect()}
    assert len(spans) == 5 and all(len(set(x)) == len(x) for x in spans.values())
    got = [tuple(r) for r in substring_dedup.substring_dedup(df.filter("doc_id is not null").unionByName(
        df.filter("doc_id is null"))).collect()]
    two = brute.substring_dedup(docs[298:])
    assert len(got) == 304 and set(got) == set(two)
