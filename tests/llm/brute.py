"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def repeated(tokens, length):
    """Per document, which tokens a window covers that starts elsewhere too."""
    count = Counter(t[s:s + length] for t in tokens for s in range(len(t) - length + 1))
    out = []
    for t in tokens:
        drop = [False] * len(t)
        for s in range(len(t) - length + 1):
            if count[t[s:s + length]] > 1:
                drop[s:s + length] = [True] * length
        out.append(drop)
    return out


def substring_dedup(docs, length=35):
    words = [tuple(WORD.findall((t or "").encode())) for _, t in docs]
    out = []
    for (i, _), w, drop in zip(docs, words, repeated(words, length)):
        kept = [x for x, d in zip(w, drop) if not d]
        out.append((i, len(w), len(w) - len(kept), sha(b" ".join(kept))))
    return out


def suffix_array_dedup(docs, length=200):
    raw = [(t or "").encode() for _, t in docs]
    out = []
    for (i, _), b, drop in zip(docs, raw, repeated(raw, length)):
        runs = len(re.findall(b"\1+", bytes(drop)))
        out.append((i, len(b), sum(drop), runs, sha(bytes(x for x, d in zip(b, drop) if not d))))
    return out


def fingerprint(text):
    w = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    h = [xxhash.xxh64_intdigest(b" ".join(w[s:s + 4]), 42) for s in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def simhash(docs, radius=4):
    """``(id, fingerprint, class)``; ids are sorted with None last."""
    key = lambda i: (i is None, i or 0)
    rows = sorted(((i, fingerprint(t)) for i, t in docs), key=lambda r: key(r[0]))
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return [(i, f"{f:016x}", rows[find(n)][0]) for n, (i, f) in enumerate(rows)]


def exact(docs):
    """``(id, keep_id, group_size, kept, sha)`` with the largest id kept."""
    group = {}
    for i, t in docs:
        group.setdefault(t or "", []).append(i)
    out, used = [], set()
    for i, t in docs:
        ids = group[t or ""]
        some = [x for x in ids if x is not None]
        keep = max(some) if some else None
        out.append((i, keep, len(ids), i == keep and (t or "") not in used, sha((t or "").encode())))
        if out[-1][3]:
            used.add(t or "")
    return out


def md5(text):
    return hashlib.md5((text or "").encode()).hexdigest()


def mixing(docs, seed=11):
    """``(id, size, source_size, target, taken)``: capping and resharing in turns."""
    size = [len(WORD.findall((t or "").encode())) for _, t, _ in docs]
    names = sorted({s for *_, s in docs}, key=lambda s: (s is None, (s or "").encode()))
    total = {n: sum(z for z, d in zip(size, docs) if d[2] == n) for n in names}
    weight = {n: k % 3 + 1 for k, n in enumerate(names)}
    target, free, rest = {}, set(names), sum(size)
    while free:
        level = rest / sum(weight[n] for n in free)
        over = [n for n in free if weight[n] * level > 3 * total[n]]
        if not over:
            target |= {n: weight[n] * level for n in free}
            break
        for n in over:
            target[n] = 3.0 * total[n]
            rest -= 3 * total[n]
            free.remove(n)
    out = []
    block = max(1, -(-sum(int(target[n] + 0.5) for n in names) // 1024), -(-4 * sum(size) // max(1, len(docs))))
    for k, n in enumerate(names):
        line = sorted((int(hashlib.md5(f"{seed}:{'' if i is None else i}:{md5(t)}".encode()).hexdigest()[:13], 16),
                       (i is not None, i or 0), z) for (i, t, s), z in zip(docs, size) if s == n)
        quota, at, drawn = int(target[n] + 0.5), 0, []
        word = [None] * (3 * total[n])  # the line, word by word
        for j, (_, _, z) in enumerate(line):
            for e in range(3):
                word[e * total[n] + at:e * total[n] + at + z] = [j] * z
            at += z
        for b in sorted(range(-(-len(word) // block)),
                        key=lambda b: (hashlib.md5(f"{seed}:{k}:{b}".encode()).hexdigest()[:13], b)):
            drawn += word[b * block:(b + 1) * block]
        took = [0] * len(line)
        for j in drawn[:quota]:
            took[j] += 1
        out += [(i if has else None, z, total[n], target[n], c) for (_, (has, i), z), c in zip(line, took)]
    return out


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return int(h.max())


SECRETS = (("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
           ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))


def base_spans(text):
    return sorted((m.start(), k, m.end(), kind) for k, (kind, p, g, least) in enumerate(SECRETS)
                  for m in re.finditer(p, text or "") if len(m[g]) >= least)


def score(token, alphabets):
    """The battery's encoding, length and score of one run."""
    body = token.rstrip("=")
    names = [(e, a) for e, a in alphabets if set(body) <= set(a)]
    e, alpha = names[0] if names else ("mixed", alphabets[3][1] + "-_")
    x = [alpha.index(c) for c in body]
    n, a = len(x), len(alpha)
    z1 = (a / n * sum(c * c for c in Counter(x).values()) - n - (a - 1)) / (2 * (a - 1) * (n - 1) / n) ** 0.5
    up = [v < a / 2 for v in x]
    prod = 2 * sum(up) * (n - sum(up))
    spread = prod * (prod - n) / (n * n * (n - 1))
    runs = 1 + sum(p != q for p, q in zip(up, up[1:]))
    z2 = (runs - prod / n - 1) / spread ** 0.5 if spread > 0 else n ** 0.5
    m = sum(x) / n
    var = sum((v - m) ** 2 for v in x)
    z3 = sum((p - m) * (q - m) for p, q in zip(x, x[1:])) / var * n ** 0.5 if var else n ** 0.5
    kind = lambda c: 0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3
    size, seen = Counter(map(kind, alpha)), Counter(map(kind, body))
    chi = sum((seen[k] - n * s / a) ** 2 / (n * s / a) for k, s in size.items())
    z4 = (chi - (len(size) - 1)) / (2 * (len(size) - 1)) ** 0.5
    return e, n, max(z1, 0) ** 2 + z2 ** 2 + z3 ** 2 + max(z4, 0) ** 2


def secret_tokens(tokens, plain, alphabets, fdr):
    """The distinct ``tokens`` that Benjamini-Hochberg calls not ordinary."""
    def place(t):
        e, n, s = score(t, alphabets)
        return min(n.bit_length() - 1, 6), e, int(min(s, 50) * 4)
    tokens, null = [(t, place(t)) for t in set(tokens)], [place(t) for t in set(plain)]
    out = set()
    for band in {k[0] for _, k in tokens}:
        mine, of = [(t, k) for t, k in tokens if k[0] == band], [k for k in null if k[0] == band]
        p = {t: min(1, 6 * (1 + sum(o[1] == k[1] and o[2] <= k[2] for o in of)) / (1 + len(of))) for t, k in mine}
        good = [q for q in p.values() if q <= fdr * sum(r <= q for r in p.values()) / len(p)]
        out |= {t for t, q in p.items() if good and q <= max(good)}
    return out
