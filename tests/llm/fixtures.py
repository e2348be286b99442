"""Documents with everything that operators must stand: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        *[StructField(c, StringType()) for c in ("text", "lang", "source")],
        StructField("n_chars", LongType()),
        *[StructField(c, StringType()) for c in ("size", "score", "node", "n_words")],
    ]
)


def prose(rng, n):
    return " ".join("".join(rng.choices(["ka", "lo", "mi", "ren", "tas", "é", "Vu"], k=rng.randint(1, 4))) for _ in range(n))


def odd_rows(seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        rows.append((i, prose(rng, rng.randint(1, 120)), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "ſ", None]), 1))
    base = prose(rng, 200)
    rows += [(100 + i, base, "en", "s1", 1) for i in range(8)]  # copies
    for i in range(8):  # near copies
        w = base.split(" ")
        w[rng.randrange(200)] = "changed"
        rows.append((120 + i, " ".join(w), "en", "s1", 1))
    rows += [
        (200, None, None, None, None),
        (201, "", "en", "s2", 0),
        (202, " \t\n\x0b\x0c\r ", "en", "s2", 0),
        (203, "one", "en", "s2", 0),
        (204, "ONE two", "en", "s2", 0),
        (205, "one TWO", "en", "s2", 0),
    ]
    rows += [(300, prose(rng, 30_000), "en", "s1", 1), (301, "x" * 50_000, "en", "s1", 1), (302, "ab " * 10_000, "en", "s1", 1)]
    rows += [rows[3], rows[3], (None, "no id here", "en", "s1", 1), (None, "no id here", "en", "s1", 1), (None, base, "en", "s1", 1), (3, "same id another text entirely", "en", "s2", 1)]
    rows += [(400, "\u2028日本語 text ﬁ Σας\x1cx\x85y\xa0z", "ja", "s9", 1), (401, "<|endoftext|> is text", "en", "s9", 1)]
    return [(*r, "a", "b", "c", "d") for r in rows]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
