"""Awkward documents that every operator must take."""

from __future__ import annotations

import random

WORDS = "the of and river stone light seven wander copper meadow quiet harbour lantern signal orchard velvet".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    out = [r.choice(WORDS) + (str(r.randrange(400)) if r.random() < 0.7 else "") for _ in range(words)]
    return " ".join(" ".join(out[k : k + 12]) + "." for k in range(0, len(out), 12))


LONG = prose(1, 30_000)
AWKWARD = [
    (1, None), (2, ""), (3, "   \t\n \x0b"), (4, prose(4, 120)), (5, prose(4, 120)), (5, prose(4, 120)), (6, "one"),
    (7, LONG), (8, "\n\n" + prose(8, 60) + "\n\n"), (9, "ÜBER straße été " * 40), (10, "a b c d"), (None, prose(10, 50)),
    (11, "it's <|endoftext|> İ, x" * 5), (12, "word " * 300),
]


def docs(spark, rows=None, **extra):
    """A table of documents; extra columns hold the same value in every row."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(AWKWARD if rows is None else rows, "doc_id long, text string")
    for name, value in extra.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame
