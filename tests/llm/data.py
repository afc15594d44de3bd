"""Small documents with every awkward case."""

import random

from pyspark.sql import Row
from pyspark.sql import types as T

#: Extra columns with names that the operators use inside.
EXTRA = ("score", "kept", "fp", "root", "row", "k", "t", "a", "c", "place", "size", "h", "idx", "slot", "shard", "digest")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(x, T.StringType()) for x in EXTRA])


def texts(seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopé", k=rng.randint(1, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    passage, line = prose(60), prose(12)
    out = [None, "", " \t\n ", "One", "two words", prose(3), prose(20), " x  y", "  lead\r\nand trail  "]
    base = [prose(rng.randint(30, 200)) for _ in range(14)]
    out += base + [base[0]] * 3 + [base[1].replace(" ", "  ", 1), base[1].upper()]
    out += [prose(15) + " " + passage + " " + prose(15) for _ in range(4)]
    out += [prose(25) + " " + line + "\n" + prose(25) for _ in range(4)]
    words = base[2].split()
    for _ in range(6):  # near copies
        w = list(words)
        w[rng.randrange(len(w))] = prose(1)
        out.append(" ".join(w))
    out += ["ab " * 300, "x" * 900, "abc" * 200 + prose(5), prose(4000)]
    return out


def documents(spark, more=()):
    """A DataFrame with clashing extra columns, and its ``(id, text, source)``."""
    rng = random.Random(5)
    rows = [(i, t, rng.choice(["s1", "s2", "s2", "s2", "ä", None])) for i, t in enumerate([*texts(), *more])]
    rows += [rows[10], rows[10], rows[12], (None, "no id", "s1"), (None, None, None), (None, rows[11][1], "s2")]
    df = spark.createDataFrame(
        [Row(i, t, "en", s, len(t or ""), *("extra" for _ in EXTRA)) for i, t, s in rows], SCHEMA).repartition(3)
    return df, rows


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
