"""Quality classifier, decontamination, HTML extraction and the pipeline."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import data  # noqa: E402

from bitlake.llm import decontaminate, html_extract, mixing, quality, sharding  # noqa: E402
from bitlake.llm.hashing import Prefix, sliding_min, word_tokens  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_word_tokens_and_sliding_min():
    texts = ["  a bb\tccc ", "", "bb a", "x"]
    raw = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    offs = np.append(0, np.cumsum([len(x) for x in raw]))
    h, s, e, at = word_tokens(buf, offs)
    words = [bytes(buf[x:y]).decode() for x, y in zip(s, e)]
    assert words == ["a", "bb", "ccc", "bb", "a", "x"] and at.tolist() == [0, 3, 3, 5, 6]
    assert h[0] == h[4] and h[1] == h[3] and len(set(h.tolist())) == 4
    x = np.random.default_rng(0).integers(0, 50, 40)
    for w in (1, 3, 7, 40):
        assert sliding_min(x, w).tolist() == [x[i:i + w].min() for i in range(41 - w)]
    p = Prefix(np.array([5, 6, 5, 6], np.uint64))
    assert p.slices(np.array([0]), np.array([2])) == p.slices(np.array([2]), np.array([4]))


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    y = np.where(rng.random(200) < 0.5, 1.0, -1.0)
    rows = [(np.array([0 if t > 0 else 1, 2 + int(rng.integers(5))]), np.array([1.0, 0.3])) for t in y]
    w = quality.dual_coordinate_descent(rows, y, 10)
    assert all((w[s] @ v + w[-1]) * t > 0 for (s, v), t in zip(rows, y))


def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.quality(spark, docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got.values())
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7)
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(p == q for p, q in held) >= 0.97 * len(held)


def test_quality_learns_nothing_from_held_out_rows(spark):
    docs, _ = data.documents(spark)
    labels = spark.createDataFrame(
        [(i, 0 if zlib.crc32(str(i).encode()) % 4 == 2 else 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    out = quality.quality(spark, docs, labels).collect()  # only class 1 is left
    assert {r.score for r in out} == {1.0} and len(out) == docs.count()
    none = quality.quality(spark, docs, labels.limit(0)).collect()
    assert {r.predicted for r in none} == {1}
    odd = spark.createDataFrame([(3, 0), (3, 1), (None, 0), (4, None), (5, 0)], "doc_id long, quality int")
    assert {(r.t, r.y) for r in quality.training_rows(docs, odd).collect()} <= {
        (r.text.encode(), 0) for r in docs.filter("doc_id = 5").collect()}
    assert quality.quality(spark, data.empty(spark), labels).count() == 0


def test_quality_edge_rows_get_scores(spark):
    docs, rows = data.documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(45)], "doc_id long, quality int")
    out = quality.quality(spark, docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    empty = {r.score for r in out if r.doc_id in (0, 1, 2)}
    assert len(empty) == 1


def labelled(spark, n):
    """Documents of class 1, and some of which a fifth is of class 0; ids that are not held out."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    ids = [i for i in range(2 * n) if zlib.crc32(str(i).encode()) % 4 != 2][:n]
    rows = []
    for k, i in enumerate(ids):
        mixed = k % 5 < 3
        y = 0 if mixed and rng.random() < 0.2 else 1
        rows.append((i, " ".join([*rng.choices(vocabulary, k=12), *(["Mixed!"] * 3 if mixed else ["plain"])]), y))
    return (spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4),
            spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int"), rows)


def test_quality_counts_all_rows_and_draws_from_those_with_a_document(spark, monkeypatch):
    docs, labels, rows = labelled(spark, 300)
    full = quality.fit(spark, docs, labels)
    assert np.array_equal(quality.fit(spark, docs, labels, sample=20).ratios, full.ratios)  # no sample in the ratios
    wider = labels.unionByName(spark.range(10**6, 10**6 + 3000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality"))
    same = quality.fit(spark, docs, wider, sample=300)
    assert isinstance(same, quality.QualityModel) and np.array_equal(same.weights, full.weights)
    monkeypatch.setattr(quality, "BROADCAST", 0)
    assert np.array_equal(quality.fit(spark, docs, labels).weights, full.weights)


def test_quality_sample_bounds_repeated_rows(spark, monkeypatch):
    docs, labels, rows = labelled(spark, 300)
    more = docs.unionByName(docs.filter(docs.doc_id == rows[0][0]).crossJoin(spark.range(2000)).select("doc_id", "text"))
    sizes = []
    descent = quality.dual_coordinate_descent
    monkeypatch.setattr(quality, "dual_coordinate_descent", lambda x, y, *a, times=None, **k: sizes.append(
        (len(x), sum(np.ones(len(x)) if times is None else times))) or descent(x, y, *a, times=times, **k))
    model = quality.fit(spark, more, labels, sample=100)
    assert isinstance(model, quality.QualityModel) and max(x for x, _ in sizes) <= 200
    assert max(x for _, x in sizes) <= 200 + 1e-6


def test_quality_sample_keeps_the_class_ratio(spark):
    docs, labels, rows = labelled(spark, 6000)
    rng = random.Random(8)
    new = [" ".join([*rng.choices([f"w{i}" for i in range(40)], k=12), *tail])  # not learned from
           for tail in (["Mixed!"] * 3, ["plain"]) for _ in range(400)]
    new = spark.createDataFrame(enumerate(new), "doc_id long, text string")
    kept, mean = [], []
    for sample in (quality.SAMPLE, 600):  # class 0 has about 720 rows, class 1 has 5,280
        model = quality.fit(spark, docs, labels, sample=sample)
        s = np.array([r.s for r in new.select(quality.scored(spark, model, new.text).alias("s")).collect()])
        kept.append((s >= quality.THRESHOLD).mean())
        mean.append(s.mean())
    assert abs(mean[1] - mean[0]) < 0.03 and abs(kept[1] - kept[0]) < 0.1, (mean, kept)


def words(t):
    buf = np.frombuffer(t.lower().encode(), np.uint8)
    return decontaminate._tokens(buf, np.array([0, len(buf)]))[0]


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(3)
    for _ in range(40):
        a, b = (rng.integers(0, 4, rng.integers(1, 12)).astype(np.uint64) for _ in range(2))
        assert decontaminate.align(a, b)[0] == brute.smith_waterman(a.tolist(), b.tolist())


def test_decontamination_against_brute_force(spark):
    rng = random.Random(6)
    docs, rows = data.documents(spark)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [" ".join(rng.choices(vocabulary, k=30)) for _ in range(8)] + ["Only two", "", None, "***", "w1"]
    planted = []
    for k in range(8):
        w = items[k].split()
        for rate in (0.0, 0.1, 0.25, 0.6):
            edited = [rng.choice(vocabulary) if rng.random() < rate else x for x in w]
            if rate == 0.1:
                del edited[5]
            planted.append(" ".join(rng.choices(vocabulary, k=40)) + ". " + " ".join(edited).upper() + "! tail")
    planted += [items[0]] * 30 + ["it has ONLY, two words"]
    docs, rows = data.documents(spark, planted)
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, score string")
    got = {}
    for r in decontaminate.contamination(spark, docs, bench).collect():
        got.setdefault((r.doc_id, r.item_id), r.score)
    want = {}
    for d, t, _ in rows:
        for i, x in enumerate(items):
            a, b = words(x or ""), words(t or "")
            if len(a) and len(b) and (s := decontaminate.align(a, b)[0] / (2 * len(a))) >= 0.5:
                want[d, i] = round(s, 6)
    assert {k: v for k, v in got.items() if v > 0.55} == {k: v for k, v in want.items() if v > 0.55}
    assert set(got) <= set(want)
    kept = decontaminate.drop_contaminated(spark, docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == sorted(
        (d is None, d) for d, *_ in rows if not any(k[0] == d for k in got))
    assert decontaminate.contamination(spark, data.empty(spark), bench).count() == 0
    assert decontaminate.contamination(spark, docs, bench.limit(0)).count() == 0


def edited(item, rate, rng):
    """The item with ``rate`` of its words changed, at places of any kind."""
    out = list(item)
    for k in rng.sample(range(len(out)), round(rate * len(out))):
        out[k] = f"z{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("exact_copies", [0, 1, 40])
def test_edited_copies_are_found_down_to_the_score(spark, exact_copies):
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(2000)] + ["the", "of"] * 300
    items = [rng.choices(vocabulary, k=n) for n in (6, 9, 15, 30, 60) for _ in range(12)]
    docs = [rng.choices(vocabulary, k=20) + edited(x, (0.2, 0.25, 0.3, 1 / 3)[i % 4], rng) + rng.choices(vocabulary, k=20)
            for i, x in enumerate(items)]
    docs += [[w if k % 3 else "zz" for k, w in enumerate(x)] for x in items]  # every third word
    docs += [[y for w in x for y in (w, "zz")] for x in items]  # a word after every word
    docs += [x for x in items for _ in range(exact_copies)]
    df = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(docs)], "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contamination(spark, df, bench).collect()}
    want, b = {}, [words(" ".join(x)) for x in items]
    for d, x in enumerate(docs[:180]):
        t = words(" ".join(x))
        for i, w in enumerate(b):
            if len(set(w.tolist()) & set(t.tolist())) * 2 >= len(set(w.tolist())):
                if (s := decontaminate.align(w, t)[0] / (2 * len(w))) >= decontaminate.SCORE:
                    want[d, i] = round(s, 6)
    assert min(want.values()) == 0.5 and sum((i, i) in want for i in range(60)) >= 55
    assert all((120 + i, i) in want for i in range(60))
    assert {k: v for k, v in got.items() if k[0] < 180 and k in want} == want
    kept = {r.doc_id for r in decontaminate.drop_contaminated(spark, df, bench).collect()}
    assert not kept & {d for d, _ in want}


def test_blocks_of_items_give_the_same_pairs(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, decontaminate.contamination(spark, docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 4000)
    assert whole and sorted(map(tuple, decontaminate.contamination(spark, docs, bench).collect())) == whole


PAGE = """<!doctype html><html><head><title>T</title><script>var a = "<p>no</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="ad-slot">Buy</div><div id="cookie_notice">We use cookies</div>
<{0}><h1>R&eacute;sum&eacute; &amp; more</h1><p>First <b>bold&nbsp;text<br>two<p>Second
 line</p><aside>side</aside><div class="shareBox social">Share</div><p>{1}</p><p>Same on all pages</p>
<section class="comments"><article class="comment"><p>me too</p></article></section></{0}>
<form><input name=q>find</form><div class="sidebar">rail</div><footer>&copy; us</footer><!-- x -->"""


def test_extraction_of_one_page():
    want = "Résumé & more\n\nFirst bold text two\n\nSecond line\n\nnew\n\nSame on all pages"
    assert html_extract.main_text(PAGE.format("article", "new")) == want
    assert html_extract.main_text(PAGE.format("div", "new")) == want  # without an article element
    assert html_extract.main_text("") == "" and html_extract.main_text("plain <b>text") == "plain text"
    assert html_extract.main_text("<p>a</b></div>b<p>c < d") == "ab\n\nc < d"


def test_template_deduction(spark):
    rows = [(i, f"http://h.example/{i}", PAGE.format("div", f"page {i} has {i * i}")) for i in range(12)]
    rows += [(100 + i, f"http://few.example/{i}", PAGE.format("div", f"page {i}")) for i in range(5)]
    rows += [(200, None, None), (201, "no host", ""), (None, "http://h.example/x", PAGE.format("div", "odd")), rows[0]]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, text string, host string")
    got = {}
    for r in html_extract.extract(df).collect():
        assert r.n_chars == len(r.text)
        got.setdefault(r.page_id, r.text)
    assert len(html_extract.extract(df).collect()) == len(rows)
    assert "Same on all pages" not in got[3] and "page 3 has 9" in got[3] and "odd" in got[None]
    assert "Same on all pages" in got[102] and got[200] == got[201] == ""
    t = html_extract.templates(html_extract.occurrences(df)).collect()
    assert {r.host for r in t} == {"h.example"} and all(r.pages >= 10 for r in t)
    assert html_extract.extract(df.limit(0)).count() == 0


def test_copies_and_shared_paragraphs_are_kept(spark):
    article = "<nav>menu</nav><div><h1>One story</h1><p>It is told on every mirror page.</p></div>"
    rows = [(i, f"http://mirror.example/{i}", article) for i in range(30)]
    rows += [(100 + i, f"http://mirror.example/o{i}", f"<div><p>Other story {i} here</p></div>") for i in range(4)]
    rows += [(200 + i, f"http://own.example/{i}", PAGE.format("article", f"page {i}")) for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    for i, url, html in rows:
        assert got[i] == html_extract.main_text(html), i  # as on a host of one page
    assert "One story" in got[0] and "Same on all pages" in got[203]
    t = {(r.host, r.token): (r.vector, r.pages) for r in html_extract.occurrences(df).collect()}
    once = df.filter("page_id = 0 or page_id >= 100")
    assert t == {(r.host, r.token): (r.vector, r.pages) for r in html_extract.occurrences(once).collect()}
    assert t["mirror.example", 0][1] == 5


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    assert len(got) == pages.count() and all(got.values())
    assert all("track(" not in t and "<p>" not in t for t in got.values())


def test_pipeline_against_plain_stages(spark):
    """The pipeline's rows from the plain versions, fed with its own classifier."""
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = cp.keep_good(spark, docs, SF)
    assert good.columns == docs.columns
    rows = {r.doc_id: r for r in good.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = [q == (i in rows) for i, q in labels.items()]
    assert sum(right) > 0.97 * len(right)
    one = {c for _, _, c in brute.simhash([(i, r.text) for i, r in rows.items()])}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    clean = []
    items = [words(b.text) for b in bench]
    for i in sorted(one):
        w = words(rows[i].text)
        if not any(len(w) and decontaminate.align(x, w)[0] >= len(x) for x in items):
            clean.append(i)
    want = []
    for i, size, _, _, taken in brute.mixing([(i, rows[i].text, rows[i].source) for i in clean]):
        want += [i] * int(taken / max(size, 1) + 0.5)
    got = cp.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    assert all(r.shard == sharding.lookup_table(sharding.SHARDS)[r.slot] and r.text == rows[r.doc_id].text for r in got)
    assert mixing.REPEATS >= max(want.count(i) for i in set(want))


@pytest.mark.parametrize("k", range(5))
def test_stages_take_empty_and_odd_documents(spark, k):
    import corpus_pipeline as cp

    name, step = cp.STAGES[k]
    out = step(spark, data.empty(spark), SF)
    assert out.count() == 0
    df, rows = data.documents(spark)
    out = step(spark, df, SF)
    assert set(df.columns) <= set(out.columns) and (k == 4 or out.columns == df.columns)
    assert 0 < out.count() <= 3 * len(rows)
