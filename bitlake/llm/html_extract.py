r"""HTML extraction by equivalence-class template deduction.

1. Every page becomes tokens: its tags, each with its path of open tags, and its
   text blocks, each with its path and words.
2. A token's occurrence vector is how often it occurs in each page of its host,
   where pages of equal html are one page, however many rows they are.
   Vectors are compared by a hash that is summed up page by page (one aggregate
   by host and token, so a host with a third of all pages is spread).  Tokens of
   one host with equal vectors are an equivalence class.
3. A class is valid if it is large (two words or tags) and frequent (half of the
   host's pages, ten at least).  Valid classes nest by the paths of their tokens;
   a class outside the class of its enclosing tag is dropped.  What is left is
   the host's template: the text blocks in it are the same on page after page.
4. The slots of the template are the blocks that remain, and all blocks of an
   article or main element: a byline or licence that articles share is part of
   them.  Those in menus,
   headers, footers, sidebars, notices, adverts, forms and reader comments (by
   element, role, or the words of class and id) are left out.  Where such a word is
   one of several in a class (``post-share-price``), the template decides: blocks
   in it are left out, others stay.  If the page marks an
   article or main element, only slots inside it count; else blocks that are
   mostly links, paragraphs apart, are left out too.

A block ends at any block-level tag; ``br`` is white space.  Character
references are decoded, white space in a block becomes one space, blocks are
joined by an empty line.

Defined cases: null and empty html give the empty text; a page whose url has no
host belongs to the host ''; pages of a host with fewer than ten different pages
have no template; a tag that is never closed ends with its parent, a closing tag without
an opening one is ignored; repeated rows give rows each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitlake.llm.common import stage

#: A template class has so many pages at least, and this share of its host's.
PAGES, SHARE, WORDS = 10, 0.5, 2

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>|<[/a-zA-Z][^>]*>|<[!?][^>]*>""", re.S)
_BROKEN = re.compile(r"<[a-zA-Z/!?]")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup.
_RAW = frozenset("script style textarea title xmp iframe noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead "
    "tr ul".split())
_ENDS_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "option": ("select",),
                "td": ("tr", "table"), "th": ("tr", "table")}
#: Elements that are never part of an article.
_OUT = frozenset("nav footer aside form head button select svg math object noscript template dialog menu canvas audio "
                 "video label script style textarea title iframe xmp noframes".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar "
                       "toolbar".split())
#: Words of class and id that mark what is not part of an article.
_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion "
    "banner nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars rail widget widgets footer foot "
    "header masthead topbar toolbar cookie cookies consent gdpr notice notices notification notifications alert alerts "
    "popup modal overlay newsletter subscribe subscription signup social share sharing related recommended "
    "recommendations trending comment comments commentlist commentary disqus reply replies respond responses pagination "
    "pager copyright login search searchbox skip disclaimer".split())
_UNLESS = frozenset("has with no without not".split())
#: Words that say nothing beside one of those: a class of both only is as clear as the one.
_PLAIN = frozenset(
    "area articles article bar block body bottom box btn button col column container content entry for form global group "
    "header id inner item items js left link links list main main-content off on outer page panel post posts primary reader "
    "readers right row secondary section site slot text the thread top unit user users view wrap wrapper zone".split())


class Block(NamedTuple):
    path: str
    text: str
    main: bool
    out: bool
    links: int
    unsure: bool  # left out if it is in the template


#: What an element's own marks say of it: part of an article, unclear, or not part.
IN, UNSURE, OUT = 0, 1, 2


def _is_out(tag: str, attributes: str, main: bool) -> int:
    if tag in _OUT or tag == "header" and not main:
        return OUT
    if not attributes or tag in ("html", "body", "main"):
        return IN
    if tag == "article":
        return OUT if _comment(attributes) else IN
    says = IN
    for name, *value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(value)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return OUT
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return OUT
        if name == "role" and value.lower() in _OUT_ROLES:
            return OUT
        if name in ("class", "id"):
            for word in value.split():
                says = max(says, _named([x.lower() for x in _NAME.findall(word)]))
    return says


def _named(parts: list[str]) -> int:
    """``ad-slot`` and ``reader-comments`` are clear; ``post-share-price`` has one of the
    words among others, so the template has to say."""
    hits = [p in _OUT_NAMES and (not i or parts[i - 1] not in _UNLESS) for i, p in enumerate(parts)]
    if not any(hits):
        return IN
    return OUT if all(h or p in _PLAIN or p.isdigit() for h, p in zip(hits, parts)) else UNSURE


def _comment(attributes: str) -> bool:
    """An article element that is a reader's comment."""
    for name, *value in _ATTRIBUTE.findall(attributes or ""):
        if name.lower() in ("class", "id"):
            if {x.lower() for w in value for x in _NAME.findall(w)} & {"comment", "comments", "reply"}:
                return True
    return False


def _is_main(tag: str, attributes: str) -> bool:
    return tag in ("article", "main") or bool(re.search(
        r"""role\s*=\s*["']?main\b|itemprop\s*=\s*["']?articleBody\b""", attributes or "", re.I))


def blocks(page: str) -> tuple[list[Block], Counter]:
    """The text blocks of a page in order, and how often each tag path occurs."""
    found: list[Block] = []
    tags: Counter = Counter()
    # Tag, in main, what the marks say, path, what those of the innermost block say.
    open_: list[tuple[str, bool, int, str, int]] = []
    depth: Counter = Counter()  # open elements by tag
    text: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        body = " ".join(entities.unescape("".join(text)).split())
        if body:
            _, main, out, path, _ = open_[-1] if open_ else ("", False, IN, "", IN)
            found.append(Block(path, body, main, out == OUT, links, out == UNSURE))
        text.clear()
        links = 0

    def close(to: int) -> None:
        if any(x[0] in _BLOCK for x in open_[to:]):
            flush()
        depth.subtract(x[0] for x in open_[to:])
        del open_[to:]

    def last(names: tuple[str, ...], stop: tuple[str, ...] | frozenset = ()) -> int:
        if not any(depth[x] for x in names):
            return -1
        for i in range(len(open_) - 1, -1, -1):
            if open_[i][0] in names:
                return i
            if open_[i][0] in stop:
                break
        return -1

    at, cut_off = 0, False
    closed = page.rfind(">") + 1  # no tag ends after it, so none is looked for
    while m := _MARKUP.search(page, at, closed):
        chunk = page[at:m.start()]
        at = m.end()
        cut_off = m[0].startswith("<!--") and not m[0].endswith("-->")
        if chunk:
            if open_ and open_[-1][2] == OUT != open_[-1][4]:
                chunk = ""  # an inline element that is left out
            text.append(chunk)
            if chunk and depth["a"]:
                links += len(chunk)
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "br":
                text.append(" ")
            elif (i := last((tag,))) >= 0:
                close(i)
            continue
        attributes = m[3]
        if tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        if tag in _BLOCK:
            if (i := last(("p",), _BLOCK - {"p"})) >= 0:
                close(i)
            flush()
        if tag in _ENDS_ITSELF and (i := last((tag,), _ENDS_ITSELF[tag])) >= 0:
            close(i)
        if tag in ("td", "th"):
            text.append(" ")
        _, main, out, path, block_out = open_[-1] if open_ else ("", False, IN, "", IN)
        main = main or _is_main(tag, attributes)
        path = f"{path}/{tag}" if len(open_) < 64 else path
        tags[path] += 1
        if tag in _RAW:
            end = re.compile(f"</{tag}", re.I).search(page, at)
            at = end.start() if end else len(page)
        if not attributes.rstrip().endswith("/") or tag in _BLOCK:
            out = out if out == OUT else max(out, _is_out(tag, attributes, main))
            open_.append((tag, main, out, path, out if tag in _BLOCK else block_out))
            depth[tag] += 1
    if not cut_off and not (open_ and open_[-1][2] == OUT != open_[-1][4]):
        # A tag or comment that the page breaks off in is no text; any other "<" is.
        text.append(_BROKEN.split(page[at:], maxsplit=1)[0])
    flush()
    return found, tags


def _token(kind: str, path: str, text: str = "") -> int:
    x = xxhash.xxh64_intdigest(f"{kind}\0{path}\0{text}".encode("utf-8", "surrogatepass"))
    return x - (1 << 64) if x >> 63 else x


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        host_of(F.col("url").cast("string")).alias("host"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))


def occurrences(pages: DataFrame) -> DataFrame:
    """``host, token, words, parent, vector, pages``: the tokens of each host.
    Token 0 occurs once in every page.  ``words`` is 0 for tags.  ``copy`` is the
    hash of a html that the host has several times: its rows count once."""
    names = ["host", "token", "words", "parent", "vector", "copy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for b in batches:
            out: list[list] = [[], [], [], [], [], []]
            for key, host, page, again in zip(*(b.column(i).to_pylist() for i in range(4))):
                if again:
                    if (host, key) in met:
                        continue
                    met.add((host, key))
                copy = key if again else None
                found, tags = blocks(page)
                own = {0: [1, 0, 0]}
                for path, n in tags.items():
                    own[_token("tag", path)] = [n, 0, _token("tag", path.rpartition("/")[0]) if path.count("/") > 1 else 0]
                for x in found:
                    t = _token("text", x.path, x.text)
                    own.setdefault(t, [0, len(x.text.split()), _token("tag", x.path)])[0] += 1
                for t, (n, words, parent) in own.items():
                    # 40 bits: sums over any number of pages fit.
                    v = xxhash.xxh64_intdigest(f"{key}:{n}") >> 24
                    for o, x in zip(out, (host, t, words, parent, v, copy)):
                        o.append(x)
            yield pa.RecordBatch.from_arrays([
                pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()),
                pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64()), pa.array(out[5], pa.int64())], names)

    p = _pages(pages).select(F.xxhash64("html").alias("key"), "host", "html")
    again = stage(p.groupBy("key", "host").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                  .select("key", "host", F.lit(True).alias("again")), "page-copies")
    p = p.join(again, ["key", "host"], "left").select("key", "host", "html", F.coalesce("again", F.lit(False)).alias("again"))
    rows = p.mapInArrow(run, "host string, token bigint, words int, parent bigint, vector bigint, copy bigint")
    wide, single = F.col("vector").cast("decimal(38,0)"), F.col("copy").isNull()
    once = rows.groupBy("host", "token", "copy").agg(
        F.max("words").alias("words"), F.max("parent").alias("parent"),
        F.when(single, F.sum(wide)).otherwise(F.max(wide)).alias("vector"),
        F.when(single, F.count(F.lit(1))).otherwise(F.lit(1)).alias("pages"))
    return once.groupBy("host", "token").agg(
        F.max("words").alias("words"), F.max("parent").alias("parent"),
        F.sum("vector").cast("decimal(38,0)").alias("vector"), F.sum("pages").alias("pages"))


def templates(tokens: DataFrame, pages: int = PAGES, share: float = SHARE, words: int = WORDS) -> DataFrame:
    """``host, token, words, class, parent_class, pages``: valid, nested classes.
    A class is named by its vector."""
    total = tokens.filter("token = 0").select("host", F.col("pages").alias("total"))
    often = tokens.join(total, "host").filter((F.col("pages") >= pages) & (F.col("pages") >= share * F.col("total")))
    classes = often.groupBy("host", "vector", "pages").agg(F.sum(F.greatest("words", F.lit(1))).alias("weight"))
    valid = often.join(classes.filter(F.col("weight") >= words).drop("pages"), ["host", "vector"])
    outer = valid.select("host", F.col("token").alias("parent"), F.col("vector").alias("parent_class"))
    return valid.join(outer, ["host", "parent"]).select(
        "host", "token", "words", F.col("vector").alias("class"), "parent_class", "pages")


def main_text(page: str, template: frozenset | set = frozenset()) -> str:
    """The blocks of a page that are article slots, joined by empty lines."""
    found, _ = blocks(page)
    left = [x for x in found if not x.out]
    inside = any(x.main for x in left)

    def slot(x: Block) -> bool:
        fixed = bool(template) and _token("text", x.path, x.text) in template
        if x.unsure and fixed:
            return False
        if inside:
            return x.main
        # A paragraph may be a link; any other block that is mostly links is a menu.
        return not fixed and (2 * x.links <= len(x.text) or x.path.endswith("/p"))

    return "\n\n".join(x.text for x in left if slot(x))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    tokens = stage(occurrences(pages), "page-tokens")
    # A host's list holds at most 1 / SHARE times as many blocks as its pages on average.
    fixed = stage(templates(tokens).filter("words > 0").groupBy("host").agg(F.collect_set("token").alias("template")),
                  "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(h, set(t or ())) for h, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(list(map(len, text)), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return (_pages(pages).join(fixed, "host", "left").select("page_id", "url", "html", "template")
            .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint"))
