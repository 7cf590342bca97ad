"""Small tables with the odd cases that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns with names that operators use themselves.
CLASHES = ["size", "shard", "slot", "score", "token", "n", "cls", "label", "target", "taken", "start", "at", "digest", "node"]


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 8))) for _ in range(words))


def odd_rows(seed: int = 1) -> list[tuple]:
    """Nulls in every column, empty and blank texts, copies, near copies, repeated rows, a long text, odd characters."""
    rng = random.Random(seed)
    base = sentence(rng, 60)
    words = base.split()
    near = " ".join([*words[:30], "changed", *words[31:]])
    far = " ".join(words[:20]) + " " + sentence(rng, 40)
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "b", None), (3, near, "de", "a", 3), (4, far, None, None, 4),
        (5, "", "en", "a", 0), (6, None, "en", "b", None), (7, "   \n\t ", "fr", "c", 6), (8, "one two", "en", None, 7),
        (9, "ONE two", "en", "c", 7), (10, "x" * 30_000, "es", "c", 9), (11, sentence(rng, 30_000), "es", "b", 10),
        (12, "Äö ñ Σς İ ﬁ 日本語 👍🏽 é it's <|endoftext|> 12345 !!?", "de", "a", 11),
        (13, None, None, None, None), (13, base, "en", "a", 1), (14, "line\nline\n\nline", "en", "b", 1),
        (None, base, "en", "a", 1), (None, None, None, None, None), (1, base, "en", "a", 1), (1, base, "en", "a", 1),
    ]
    return rows + [(100 + i, sentence(rng, rng.randint(5, 80)), rng.choice(["en", "de"]), rng.choice("abc"), i) for i in range(40)]


def table(spark: SparkSession, rows: list[tuple], clashes: bool = False) -> DataFrame:
    df = spark.createDataFrame(rows, SCHEMA)
    if clashes:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])
    return df


def hot_rows(copies: int = 60, others: int = 120, seed: int = 3) -> list[tuple]:
    """One text holds a third of all rows; another third are near copies of each other."""
    rng = random.Random(seed)
    hot = sentence(rng, 50)
    words = sentence(rng, 80).split()
    rows = [(i, hot, "en", "a", 1) for i in range(copies)]
    for i in range(copies):
        own = list(words)
        own[rng.randrange(80)] = f"edit{i}"
        rows.append((1000 + i, " ".join(own), "en", "a", 1))
    return rows + [(2000 + i, sentence(rng, 40), "en", "b", 1) for i in range(others - copies)]
