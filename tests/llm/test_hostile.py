"""Inputs that are made to break a shortcut: hash algebra, quadratic scans."""

import time

from bitlake.llm import html_extract, substring_dedup, suffix_array_dedup


def thue_morse(n, a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_thue_morse_words_are_not_equal(spark):
    """Equal under every polynomial hash with an odd base modulo 2^64."""
    one, two = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    rest = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join([*rest[:20], one, *rest[20:]])), (2, " ".join([*rest[:20], two, *rest[20:]]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [r.n_removed for r in substring_dedup.substring_dedup(df).collect()] == [0, 0]
    texts = [(1, "x" + thue_morse(4096, "a", "b")), (2, "y" + thue_morse(4096, "c", "d")), (3, "z" + thue_morse(4096, "d", "c"))]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    want = {}
    for i, t in texts:  # 200 bytes that start anywhere else
        n = 200
        seen = {}
        for _, u in texts:
            for k in range(len(u) - n + 1):
                seen[u[k:k + n]] = seen.get(u[k:k + n], 0) + 1
        gone = [False] * len(t)
        for k in range(len(t) - n + 1):
            if seen[t[k:k + n]] > 1:
                gone[k:k + n] = [True] * n
        want[i] = sum(gone)
    assert {r.doc_id: r.n_removed for r in suffix_array_dedup.suffix_array_dedup(df).collect()} == want


def test_long_junk_pages_take_linear_time():
    start = time.perf_counter()
    for page in ("<a " * 350_000, "<a>" * 100_000, "<b>x" * 50_000 + "</i>" * 50_000, "<button>" + "<b>x" * 100_000,
                 "<!--" * 250_000, "< " * 300_000, "<p>" + "<a href='x" * 100_000, "<div>" * 50_000 + "</span>" * 50_000):
        html_extract.blocks(page)
    assert time.perf_counter() - start < 40


def test_text_after_the_last_tag_stays():
    def texts(page):
        return [b.text for b in html_extract.blocks(page)[0]]

    assert texts("<p>ok</p>< 5 kg of flour") == ["ok", "< 5 kg of flour"]
    assert texts("<p><3 love you") == ["<3 love you"]
    assert texts("<p>a < b and 1<2") == ["a < b and 1<2"]
    assert texts("<p>a</p>b <a href=") == ["a", "b"]
    assert texts("<p>a</p>b <!-- c > d") == ["a", "b"]
    assert texts("plain") == ["plain"] and texts("") == [] and texts("<!-- x") == []


def test_class_words_and_links_in_an_article(spark):
    def page(i, body):
        return f"<nav>menu</nav><div class='post-body'><p>Story {i} goes on</p>{body}</div>"

    share = "<div class='post-share-price'>Share price {0}</div><div id='search-for-truth'>Truth {0}</div>"
    assert html_extract.main_text(page(1, share.format(1))) == "Story 1 goes on\n\nShare price 1\n\nTruth 1"
    assert html_extract.main_text(page(1, "<p><a href=x>A linked paragraph</a>.</p><div><a href=y>Home</a></div>")) \
        == "Story 1 goes on\n\nA linked paragraph."
    for name in ("ad-slot", "reader-comments", "site-footer", "related-posts", "cookie_notice", "shareBox", "comment-12"):
        assert html_extract.main_text(page(1, f"<div class={name}>out</div>")) == "Story 1 goes on", name
    # The template decides where the words do not: fixed on every page of a host or not, in an article too.
    same = "<article>" + page(0, "<div class='post-share-price'>Tell a friend</div>").replace("Story 0", "Story {0}") + share + "</article>"
    rows = [(i, f"http://a.example/{i}", same.format(i)) for i in range(12)]
    rows += [(100 + i, f"http://b{i}.example/", same.format(i)) for i in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    for i in range(12):
        assert got[i] == f"Story {i} goes on\n\nShare price {i}\n\nTruth {i}"
    assert "Tell a friend" in got[100]
