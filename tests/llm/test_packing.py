"""Pattern packing by non-negative least squares."""

import random
import string
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import data  # noqa: E402

from bitlake.llm import packing  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")


def tokenizer(name=packing.TOKENIZER):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return t


def pieces(rows, capacity, t):
    out = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for p, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4")
            out.append((i, p, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=str)


def check(got, capacity):
    """Pieces lie gapless from 0 in their sequences; the number of sequences."""
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert all(n <= capacity for n in at.values())
    return len(at)


TEXTS = ["It's o'clock's. don't, WON'T. she'll 'sand x's", "a..b ., c ,. 1,2.3. ...", "ǰ J̌ Ǩ. é. ≮. Σ. ΑΣ. ΑΣ.Α K",
         "tab\tand\x0bother\x1cspaces\x85here there\r\nend.", "<|endoftext|> <|startoftext|>.", "日本語。テスト, 한국어.", "👍🏽. x👍.", "   ", "\n\n.",
         "İstanbul, ﬁ ½ ² ٣. á. ́ ́a", ".5 5. 5,", "x" * 5000, "ß. ẞ, ꙮ"]


def test_words_give_the_ids_of_the_whole_text():
    rng = random.Random(2)
    marks = "abcXYZ019 .,'\n\t -!éñ́̌Σςıİ<|>"
    texts = TEXTS + [t or "" for t in data.texts()] + ["".join(rng.choices(marks, k=rng.randint(1, 60))) for _ in range(3000)]
    t = tokenizer()
    want = [np.array(e.ids, "<u4").tobytes() for e in t.encode_batch(texts, add_special_tokens=False)]
    assert list(packing.Encoder().encode(texts)) == want


def test_words_are_forgotten_and_met_again(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 10)
    texts = ["a b c d e f g", "h i j k l", "a b c d e f g h i j k l m n o p"] * 20
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert list(packing.Encoder().encode(texts)) == want


def whole_words(monkeypatch):
    """What the encoder gives to the whole tokenizer from now on."""
    seen, encode = [], packing.Encoder._encode
    monkeypatch.setattr(packing.Encoder, "_encode", lambda self, texts: seen.extend(texts) or encode(self, texts))
    return seen


def test_plain_words_go_to_the_merges(monkeypatch):
    rng = random.Random(3)
    marks = string.ascii_letters + string.digits + string.punctuation + "'" * 4 + "stvremdl" * 4 + "".join(
        chr(c) for c in (*range(0xC0, 0x17F), *range(0x2010, 0x2028)) if c not in (0xD7, 0xF7, 0x130))
    words = ["".join(rng.choices(marks, k=rng.randint(1, 9))) for _ in range(20_000)]
    words += ["it's", "WE'LL", "l'été", "'S's", "Émile's", "tion.", "wait...", "end$$$", "\u2018tis\u2019", "x\u2014y", "3.14", "a1b2", "<|endoftext|>"]
    texts = [" ".join(words[i:i + 7]) for i in range(0, len(words), 7)] + words[-13:]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    seen = whole_words(monkeypatch)
    assert list(packing.Encoder().encode(texts)) == want
    assert not seen


def test_words_met_again_stay(monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 20)
    monkeypatch.setattr(packing, "BYTES", 64, raising=False)
    texts = [f"日本語 한국어 new{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]} 번{i}" for i in range(100)]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    seen = whole_words(monkeypatch)
    assert list(packing.Encoder().encode(texts)) == want
    assert Counter(seen)["日本語"] == 1 and len(seen) == len(set(seen)) == 102


def test_long_words_are_bounded_by_their_characters(monkeypatch):
    monkeypatch.setattr(packing, "BYTES", 1000)
    monkeypatch.setattr(packing, "CHARS", 5000)
    e = packing.Encoder()
    texts = [f"{i}{'x' * 400} {i}{'語' * 50}" for i in range(300)]
    want = [np.array(x.ids, "<u4").tobytes() for x in tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert list(e.encode(texts)) == want
    assert all(sum(map(len, d)) <= 5000 + 2000 for d in (e.known, e.before))


@pytest.mark.parametrize("nbytes", [1, 50, 1 << 23])
def test_texts_looked_up_together(monkeypatch, nbytes):
    monkeypatch.setattr(packing, "BYTES", nbytes, raising=False)
    texts = [None, "", " ", *TEXTS, None, "\t\n\r\x0b\x0c", "A\u0301 \u0301a", *[t or "" for t in data.texts()], ""]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer().encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for kind in (pa.string(), pa.large_string()):
        assert list(packing.Encoder().encode(pa.array(["cut"] + texts, kind).slice(1))) == want
    assert list(packing.Encoder().encode(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("capacity", [1, 7, 64, 2048])
def test_pack(spark, capacity):
    df, rows = data.documents(spark, TEXTS)
    got = packing.pack(df, capacity=capacity).collect()
    want = pieces([(i, t) for i, t, _ in rows], capacity, tokenizer())
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == want
    n, total = check(got, capacity), sum(r.length for r in got)
    lengths = Counter(r.length for r in got)
    bound = max(-(-total // capacity), sum(v for k, v in lengths.items() if 2 * k > capacity))
    assert bound <= n <= bound + 1 + len(got) // 50


def test_other_tokenizer_whole_texts(spark):
    df, rows = data.documents(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack(df, capacity=100, tokenizer=path, by_word=False, end_id=50256).collect()
    check(got, 100)
    t = tokenizer("byte_bpe_50k.json")
    n = sum(len(t.encode(x or "", add_special_tokens=False).ids) + 1 for _, x, _ in rows)
    assert sum(r.length for r in got) == n


def placed(counts):
    """All pieces of a plan as (sequence, offset, length)."""
    p = packing.plan(counts)
    out = []
    for k in np.flatnonzero(counts):
        number = p.base[k] + np.arange(counts[k])
        r = np.searchsorted(p.first, number, "right") - 1
        out += zip((p.sequence[r] + number - p.first[r]).tolist(), p.offset[r].tolist(), [int(k)] * len(r))
    return p, out


def test_plans_are_whole_and_tight():
    rng = np.random.default_rng(4)
    for case in range(25):
        cap = int(rng.choice([3, 10, 64, 300]))
        counts = np.zeros(cap + 1, np.int64)
        some = rng.integers(1, cap + 1, rng.integers(1, cap + 1))
        counts[some] = rng.integers(1, 200, len(some))
        p, out = placed(counts)
        at = {}
        for s, offset, k in sorted(out):
            assert offset == at.get(s, 0)
            at[s] = offset + k
        assert len(at) == p.sequences and max(at.values()) <= cap and len(out) == counts.sum()
    lengths = np.minimum(rng.lognormal(4.5, 1, 60_000).astype(int) + 1, 2048)
    counts = np.bincount(lengths, minlength=2049)
    p, out = placed(counts)
    bound = -(-int(lengths.sum()) // 2048)
    assert bound <= p.sequences <= bound * 1.002 + 1


def test_patterns_are_all_and_the_fit_is_least_squares():
    counts = np.zeros(13, np.int64)
    counts[[1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]] = [9, 1, 2, 9, 1, 3, 5, 2, 4, 7, 3]
    have = [int(k) for k in np.flatnonzero(counts)]
    want = set()
    for a in have:
        for b in (x for x in have if x >= a):
            for c in [0] + [x for x in have if x >= b]:
                if a + b + c == 12 and all(counts[k] >= v for k, v in Counter(x for x in (a, b, c) if x).items()):
                    want.add(tuple(sorted((a, b, c))))
    rows = packing.patterns(counts)
    assert {tuple(sorted(r)) for r in rows.tolist()} == want and len(rows) == len(want)
    # A histogram that three patterns make is met by the fit.
    exact = np.zeros(101, np.int64)
    for n, times in ((10, 500), (90, 500), (30, 300), (70, 300), (20, 200), (25, 200), (55, 200)):
        exact[n] += times
    rows = packing.patterns(exact)
    x = packing.fit_counts(exact, rows)
    used = np.zeros(101)
    for r, v in zip(rows, x):
        for k in r:
            used[k] += v * (k > 0)
    assert (x >= 0).all() and np.abs(used - exact).max() < 2
    assert packing.plan(exact).sequences == 1000


def test_hot_length_empty_and_bad(spark):
    rows = [(i, "") for i in range(5000)] + [(9000 + i, "one two three") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = packing.pack(df, capacity=50).collect()
    assert check(got, 50) == -(-sum(r.length for r in got) // 50)
    out = packing.pack(data.empty(spark))
    assert out.count() == 0
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    with pytest.raises(ValueError):
        packing.pack(df, capacity=0)
