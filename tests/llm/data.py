"""Small hand-made tables for the tests of the llm operators."""

from __future__ import annotations

import random

CHUNKS = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(CHUNKS) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(words(rng, n))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, repeated rows."""
    return [(None, "a lonely text without an id", "en", "s1", 27), (900, None, "en", "s1", None), (901, "", None, None, 0), (902, " \t\n ", "de", "s2", 4),
            (903, "one", "en", None, 3), (903, "one", "en", None, 3), (904, "word " * 40_000, "en", "s2", 200_000), (905, "x" * 30_000, None, "s1", 30_000),
            (906, "Ümläut naïve ÉCOLE 漢字 \U0001f600", "fr", "s3", 25)]


def documents(spark, rows, extra: bool = True):
    """With columns whose names clash with those the operators use inside."""
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for c in ("fp", "y", "held", "_id", "t", "row", "key", "places", "rn", "shard", "low", "root"):
            df = df.selectExpr("*", f"'extra' AS `{c}`")
    return df
