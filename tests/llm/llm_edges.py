"""Shared fixtures: a documents table with every awkward case, and helpers."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        *[T.StructField(c, T.StringType()) for c in ("key", "row", "at", "nid", "first", "copies", "size")],
    ]
)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, rows):
    """rows: (doc_id, text, lang, source)."""
    return spark.createDataFrame([(i, t, x, s, None if t is None else len(t), *["x"] * 7) for i, t, x, s in rows], SCHEMA)


def awkward(seed=1):
    rng = random.Random(seed)
    long = words(rng, 30_000)
    base = words(rng, 120)
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", None, None),
        (4, base, "en", "b"),
        (5, base, "en", "b"),
        (5, base, "en", "b"),
        (None, base, None, None),
        (6, long, "en", "a"),
        (7, "one", "en", "c"),
        (8, "one two three four", "en", None),
        (9, "same line of ten words in here for you all\n" * 4 + "end", "de", "c"),
        (10, "é ñ ü 日本語 текст", "de", "c"),
        (11, None, None, None),
        (12, base + " tail", "en", "\U0001f600"),
    ]
