"""Ranked lexical search by pipelined term partitioning."""

import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import data  # noqa: E402

from bitlake.llm import ranked_search  # noqa: E402

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def plain(docs, items, top=10, b=75):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for (i, c), size in zip(counts, sizes):
            score = 0
            for t, q in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 100 - b + b * size * n // total
                    score += q * w * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    df, rows = data.documents(spark, ["Naïve CAFÉ café\x00x y z_z a-b", "é" * 50, "one\x7ftwo_three"])
    path = str(tmp_path_factory.mktemp("docs") / "d")
    df.write.parquet(path)
    rng = random.Random(9)
    texts = [t for _, t, _ in rows if t]
    items = [(k, " ".join(rng.choices(" ".join(rng.choices(texts, k=3)).split() or ["x"], k=rng.randint(1, 30)))) for k in range(30)]
    items += [(30, None), (31, ""), (32, "zzzz-not-there"), (33, "café CAFÉ naïve X y z a b"), (None, texts[5]), (3, items[3][1]),
              (3, items[3][1]), (40, texts[-1])]
    frame = spark.createDataFrame([(i, t, "e", 1) for i, t in items], "item_id bigint, text string, term string, score int")
    return spark.read.parquet(path), [(i, t) for i, t, _ in rows], frame.repartition(2), items


def test_against_brute_force(tables):
    df, docs, frame, items = tables
    out = ranked_search.search(df, frame)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows_of(out) == plain(docs, items)


@pytest.mark.parametrize("kw", [{"prune": False}, {"broadcast_terms": 0}, {"block_items": 4, "owners": 7}, {"owners": 1}])
def test_plans_agree(tables, kw):
    df, docs, frame, items = tables
    assert rows_of(ranked_search.search(df, frame, top=3, **kw)) == plain(docs, items, top=3)


def test_many_small_slices(tables, monkeypatch):
    """Documents over many slices, long texts as slices of their own."""
    df, docs, frame, items = tables
    monkeypatch.setattr(ranked_search, "SLICE_DOCS", 3)
    monkeypatch.setattr(ranked_search, "SLICE_TERMS", 500)
    assert rows_of(ranked_search.search(df, frame, top=5)) == plain(docs, items, top=5)


def test_ties_go_by_id(spark):
    docs = [(i, "same words here") for i in (9, 4, None, 7, 4, 1, 8)] + [(k, "other") for k in range(20, 40)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    items = spark.createDataFrame([(1, "words")], "item_id bigint, text string")
    got = rows_of(ranked_search.search(df, items, top=6))
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == [1, 4, 4, 7, 8, 9]
    assert got == plain(docs, [(1, "words")], top=6)


def test_very_long_text_and_empty(spark, tables):
    df, docs, frame, items = tables
    rng = random.Random(1)
    words = [f"w{k}" for k in range(3000)]
    docs = [(1, " ".join(rng.choices(words, k=300_000))), (2, "w5 w6"), (3, None)]
    asked = [(1, "w5 w6 w7"), (2, " ".join(words))]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(asked, "item_id bigint, text string")
    assert rows_of(ranked_search.search(d, i)) == plain(docs, asked)
    none = i.limit(0)
    assert ranked_search.search(data.empty(spark), frame).count() == 0
    assert ranked_search.search(df, none).count() == 0
    assert ranked_search.search(d.filter("doc_id = 3"), i).count() == 0
