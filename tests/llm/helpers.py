"""Small tables with the cases every operator has to stand."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n: int, seed: int = 0) -> str:
    draw = random.Random(seed)
    words = "river stone green light moves over under small house".split()
    return " ".join(draw.choice(("the", "of", "and")) if draw.random() < 0.2 else f"{draw.choice(words)}{draw.randint(0, 999)}" for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Nulls in any column, empty, blank and very long texts, exact and near copies, repeated rows."""
    long = prose(9000, 5)
    base = prose(80, 1)
    return [
        (0, None, "en", "a", None),
        (1, "", "en", "a", 0),
        (2, " \n\t ", None, None, 3),
        (3, base, "en", "a", 1),
        (4, base, "en", "a", 1),
        (4, base, "en", "a", 1),
        (5, base + " coda", "de", "b", 2),
        (None, base, "en", "a", 1),
        (6, "two words", "en", "a", 9),
        (7, long, "en", "a", 9),
        (8, "x" * 70_000, "en", "a", 9),
        (9, "ÀÉ ﬁ 漢字 \u0000 \U0001f600 " * 30, "fr", "c", 9),
        (10, "same line\nsame line\n\nsame line\nlast", "en", "a", 9),
        (11, (prose(30, 8) + " ") * 3, "en", "a", 9),
    ]


def table_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df: DataFrame) -> DataFrame:
    """The table with columns named like those that operators work with."""
    for name in ("key", "code", "root", "node", "row", "words", "rate", "mix", "pii", "quality", "one", "first", "host"):
        df = df.selectExpr("*", f"'clash' AS {name}")
    return df


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)
