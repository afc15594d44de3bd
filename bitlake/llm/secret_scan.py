r"""Secret scan: three patterns and a randomness test battery (native).

Base spans come from the three patterns of :data:`BASE`, leftmost and not
overlapping within a kind.  The battery adds ``random`` spans.  Candidates are
runs of 20 or more characters of the base-64 alphabets, with a letter and a digit,
that overlap no base span.  Each gets the narrowest encoding that fits (upper or
lower hex, base 32, base 64, URL base 64) and four statistics, each near 0 if its
symbols are independent and uniform over that alphabet:

* chi-squared of symbol counts (its exact mean and variance, so short runs count);
* chi-squared of upper case, lower case, digits and signs;
* runs above and below the middle of the alphabet (Wald-Wolfowitz);
* serial correlation of neighbouring symbols.

The sum of their squares (the chi-squared ones one-sided) is the score; low is random.

The null hypothesis is that a run is ordinary text.  Its distribution is taken from
the corpus: 4, 8 and 16 words in a row, one of them with a digit, written as one run
the way identifiers are (:func:`ordinary`).
The p-value of a candidate is the share of ordinary runs of its length band that fit
its encoding and score no higher, times the number of encodings.  In each band,
Benjamini-Hochberg at level :data:`FDR` over the candidates decides which are not
ordinary; those are secrets, so the expected share of ordinary text among them is
bounded.  Short runs, which carry little evidence, borrow nothing from long ones, and
where the corpus has too little ordinary text of a length to tell, nothing is added.
Both sides count distinct texts, so copies weigh once; the decision needs two
histograms of at most a few thousand rows at any size.

Defined cases: a null text counts as empty; no span gives the digest of the
empty text and an empty list; repeated rows and null ids each give their own
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bitlake.llm.common import stage, text_or_empty

# The three base patterns, in their order.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
FDR = 0.05
#: Words in a row that make an ordinary run, and the last length band (powers of two).
WORDS, LAST_BAND = (4, 8, 16), 6
#: Scores are compared in steps of 1 / STEPS, up to TOP.
STEPS, TOP = 4, 50
# The alphabets, narrowest first.
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ALPHABETS = (("hex", _DIGITS + "abcdef"), ("HEX", _DIGITS + "ABCDEF"), ("base32", _UPPER + "234567"),
             ("base64", _UPPER + _LOWER + _DIGITS + "+/"), ("base64url", _UPPER + _LOWER + _DIGITS + "-_"))


def _q(s: str) -> str:
    return "r'" + s + "'" if "'" not in s else 'r"""' + s + '"""'


def spans(text: str, pattern: str, group: int, least: int, kind: int):
    """SQL for the array of ``(start, kind, end, token)`` of a pattern's matches.
    The text between matches (``split``) and the matches alternate, so offsets
    are running sums; they are worked out only where something matches."""
    p = F.lit(pattern)
    t = F.col(text)
    whole = F.regexp_extract_all(t, p, F.lit(0))
    part = F.regexp_extract_all(t, p, F.lit(group)) if group else whole
    none = F.array().cast("array<struct<start:int,kind:int,end:int,token:string>>")
    pairs = F.zip_with(F.slice(F.split(t, pattern, -1), F.lit(1), F.size(whole)),
                       F.arrays_zip(whole.alias("w"), part.alias("g")),
                       lambda gap, m: F.struct(F.length(gap).alias("gap"), m["w"].alias("w"), m["g"].alias("g")))
    walked = F.aggregate(
        pairs, F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda st, x: F.struct(
            (st["at"] + x["gap"] + F.length(x["w"])).alias("at"),
            F.when(F.length(x["g"]) >= least, F.concat(st["out"], F.array(F.struct(
                (st["at"] + x["gap"]).alias("start"), F.lit(kind).alias("kind"),
                (st["at"] + x["gap"] + F.length(x["w"])).alias("end"), x["w"].alias("token")))))
            .otherwise(st["out"]).alias("out")))["out"]
    return F.when(F.size(whole) > 0, walked).otherwise(none)


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` (column ``token``) with ``encoding, n, score`` (low: random)."""
    body = F.regexp_replace("token", "=+$", "")
    enc = F.lit(None).cast("string")
    alpha = F.lit(None).cast("string")
    for name, letters in reversed(ALPHABETS):
        fits = F.translate("body", letters, "") == ""
        enc, alpha = F.when(fits, F.lit(name)).otherwise(enc), F.when(fits, F.lit(letters)).otherwise(alpha)
    d = tokens.withColumn("body", body).withColumn("encoding", F.coalesce(enc, F.lit("mixed")))
    # Both + / and - _ : no standard encoding; the union alphabet.
    d = d.withColumn("alpha", F.coalesce(alpha, F.lit(ALPHABETS[3][1] + "-_")))
    d = d.withColumn("x", F.expr("transform(sequence(1, length(body)), i -> locate(substr(body, i, 1), alpha) - 1)"))
    d = d.withColumn("n", F.size("x").cast("double")).withColumn("a", F.length("alpha").cast("double"))
    d = d.withColumn("sq", F.expr("aggregate(transform(array_distinct(x), v -> size(filter(x, u -> u = v))), 0D, (s, c) -> s + c * c)"))
    d = d.withColumn("n1", F.expr("cast(size(filter(x, v -> v < a / 2)) as double)")).withColumn("n2", F.col("n") - F.col("n1"))
    d = d.withColumn("runs", F.expr("1D + aggregate(sequence(2, size(x)), 0D, (s, i) -> s + if((x[i-1] < a / 2) <> (x[i-2] < a / 2), 1, 0))"))
    d = d.withColumn("mean", F.expr("aggregate(x, 0D, (s, v) -> s + v) / n"))
    d = d.withColumn("var", F.expr("aggregate(x, 0D, (s, v) -> s + (v - mean) * (v - mean))"))
    d = d.withColumn("cov", F.expr("aggregate(sequence(2, size(x)), 0D, (s, i) -> s + (x[i-1] - mean) * (x[i-2] - mean))"))
    n, a = F.col("n"), F.col("a")
    z1 = (a / n * F.col("sq") - n - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n)
    prod = 2 * F.col("n1") * F.col("n2")
    spread = prod * (prod - n) / (n * n * (n - 1))
    z2 = F.when(spread > 0, (F.col("runs") - prod / n - 1) / F.sqrt(spread)).otherwise(F.sqrt(n))
    z3 = F.when(F.col("var") > 0, F.col("cov") / F.col("var") * F.sqrt(n)).otherwise(F.sqrt(n))
    classes = [_UPPER, _LOWER, _DIGITS, "+/-_"]
    cells, chi = F.lit(0.0), F.lit(0.0)
    for letters in classes:
        size = F.length("alpha") - F.length(F.translate("alpha", letters, ""))
        seen, due = F.length("body") - F.length(F.translate("body", letters, "")), n * size / a
        cells += F.when(size > 0, 1.0).otherwise(0.0)
        chi += F.when(size > 0, (seen - due) * (seen - due) / due).otherwise(0.0)
    z4 = (chi - (cells - 1)) / F.sqrt(2 * (cells - 1))
    z1, z4 = F.greatest(z1, F.lit(0.0)), F.greatest(z4, F.lit(0.0))
    d = d.withColumn("score", z1 * z1 + z2 * z2 + z3 * z3 + z4 * z4)
    return d.drop("body", "alpha", "x", "a", "sq", "n1", "n2", "runs", "mean", "var", "cov")


def _eligible(token: str):
    return F.col(token).rlike("[A-Za-z]") & F.col(token).rlike("[0-9]")


def ordinary(texts: DataFrame) -> DataFrame:
    """Distinct ``token``: words of column ``t`` in a row, from one with a digit on, as
    one run of 20 characters or more with a letter.  Up to the longest of :data:`WORDS`
    words are met once; their first 4, 8 and 16 make a run each.  Words of more than 15
    characters, which may be secrets, end a row.  The run's own hash says how it is written
    (InCapitals, with_underscores, with-hyphens, just joined) and whether backwards, so
    that numbers come first or last."""
    digit = "(?<![A-Za-z0-9])[A-Za-z]{0,14}+[0-9][A-Za-z0-9]{0,14}+(?![A-Za-z0-9])"
    more = f"(?:[^A-Za-z0-9]+[A-Za-z0-9]{{1,15}}+(?![A-Za-z0-9])){{{WORDS[0] - 1},{WORDS[-1] - 1}}}"
    # explode_outer: explode would filter by size first and match every text twice.
    rows = texts.select(F.explode_outer(F.regexp_extract_all("t", F.lit(digit + more), F.lit(0))).alias("w"))
    rows = rows.filter(F.col("w").isNotNull()).select(F.split("w", "[^A-Za-z0-9]+").alias("w"))
    parts = F.array(*[F.when(F.size("w") >= k, F.slice("w", 1, k)) for k in WORDS])
    w = rows.select(F.explode(F.array_compact(parts)).alias("w"))
    h = F.xxhash64("w")
    w = w.select(F.pmod(h, F.lit(4)).alias("style"),
                 F.array_join(F.when(F.pmod(F.floor(h / 4), F.lit(2)) == 0, F.col("w")).otherwise(F.reverse("w")), " ").alias("w"))
    style = F.col("style")
    token = (F.when(style == 0, F.replace(F.initcap("w"), F.lit(" "), F.lit("")))
             .when(style == 1, F.translate("w", " ", "_")).when(style == 2, F.translate("w", " ", "-"))
             .otherwise(F.replace("w", F.lit(" "), F.lit(""))))
    once = w.select(token.alias("token")).filter((F.length("token") >= 20) & F.col("token").rlike("[A-Za-z]")).distinct()
    # The battery costs far more than its bytes say, so tasks are not merged by size.
    return once.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _binned(scored: DataFrame) -> DataFrame:
    return (scored.withColumn("band", F.least(F.floor(F.log2("n")), F.lit(LAST_BAND)).cast("int"))
            .withColumn("bin", F.floor(F.least(F.col("score"), F.lit(float(TOP))) * STEPS).cast("int")))


def secrets(scored: DataFrame, null: DataFrame, fdr: float = FDR) -> DataFrame:
    """The rows of ``scored`` that are not ordinary: Benjamini-Hochberg in each length
    band against ``null``, both from :func:`battery`."""
    key = ["band", "encoding", "bin"]
    d = _binned(scored)
    seen = d.select("token", *key).distinct().select(*key, F.lit(1).alias("c"), F.lit(0).alias("o"))
    plain = _binned(null).select(*key, F.lit(0).alias("c"), F.lit(1).alias("o"))
    # Bands times encodings times bins: at most a few thousand rows, whatever the corpus.
    hist = seen.unionByName(plain).groupBy(*key).agg(F.sum("c").alias("c"), F.sum("o").alias("o"))
    band = W.partitionBy("band")
    below = F.sum("o").over(W.partitionBy("band", "encoding").orderBy("bin"))
    hist = hist.withColumn("p", F.least(F.lit(1.0), (len(ALPHABETS) + 1) * (below + 1) / (F.sum("o").over(band) + 1)))
    hist = hist.withColumn("ok", F.col("p") <= fdr * F.sum("c").over(band.orderBy("p")) / F.greatest(F.sum("c").over(band), F.lit(1)))
    cut = hist.withColumn("cut", F.max(F.when(F.col("ok"), F.col("p"))).over(band)).filter("c > 0 and p <= cut").select(*key)
    return d.join(F.broadcast(cut), key).drop("band", "bin")


def secret_scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """One row per document; see the module."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("t"))
    base = [spans("t", p, g, least, k) for k, (_, p, g, least) in enumerate(BASE)]
    d = d.select("doc_id", *[b.alias(f"b{k}") for k, b in enumerate(base)],
                 spans("t", CANDIDATE, 0, 20, len(BASE)).alias("c"))
    d = d.withColumn("b", F.concat("b0", "b1", "b2"))
    free = F.filter("c", lambda x: ~F.exists("b", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))
    d = d.select("doc_id", F.monotonically_increasing_id().alias("row"),
                 F.expr("cast(size(b0) as bigint)").alias("n_assign"), F.expr("cast(size(b1) as bigint)").alias("n_access"),
                 F.expr("cast(size(b2) as bigint)").alias("n_hex"),
                 F.transform("b", lambda x: F.struct(x["start"], x["kind"], x["end"])).alias("b"), free.alias("c"))
    d = stage(d, "spans")
    tokens = d.select("row", F.explode("c").alias("c")).select("row", "c.*").filter(_eligible("token"))
    left = secrets(battery(tokens), battery(ordinary(docs.select(text_or_empty().alias("t")))), fdr)
    more = left.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    names = F.array(*[F.lit(k) for k, *_ in BASE], F.lit("random"))

    def joined(spans_col):
        ordered = F.array_sort(spans_col)
        return F.array_join(F.transform(ordered, lambda x: F.concat_ws(
            ":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")

    every = F.concat("b", F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>")))
    return d.join(more, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("b")), 256).alias("base_sha256"),
        joined(every).alias("spans"))
