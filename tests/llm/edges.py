"""Small tables with what operators must stand: nulls, empty and very long texts, ties."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n: int, seed: int, vocabulary: int = 500) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edge_rows() -> list[tuple]:
    long_text = words(30_000, 1, 5_000)
    texts = [
        None,
        "",
        " \t\n ",
        "One",
        "one two three",
        words(60, 2),
        words(60, 2),
        words(60, 2).replace("w1", "W1"),
        long_text,
        long_text + " end",
        "x" * 50_000,
        "Éa ñandú größe   words 日本語 " * 20,
    ]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5]]  # repeated rows
    rows += [(None, "a text without an id " * 3, None, None, None), (None, None, None, None, None)]
    return rows


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df, *names: str):
    """``df`` with further columns of the given names."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit("other").alias(n) for n in names if n not in df.columns))
