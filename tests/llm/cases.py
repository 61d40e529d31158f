"""Awkward tables that every text operator has to take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHING = ("score", "node", "component", "_text", "queue", "part", "kept", "held_out", "line", "h1", "band")

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards mix a strong potion"
LONG = " ".join(f"word{i % 997} filler{i % 31}" for i in range(20_000))
ROWS = [
    (1, PROSE, "en", "a", len(PROSE)),
    (2, PROSE, "en", "b", len(PROSE)),
    (2, PROSE, "en", "b", len(PROSE)),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \t\n ", "en", "", 4),
    (6, "12 34 -- ??", None, "a", 11),
    (7, LONG, "en", "c", len(LONG)),
    (8, "Ünïcode straße ☃ 漢字 \U0001d54f\nzweite Zeile", "de", "c", 40),
    (None, PROSE + " and more", "en", "a", 100),
    (9, "one", "en", "d", 3),
]


def awkward(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def clashing(docs: DataFrame) -> DataFrame:
    """The same rows with extra columns of names that operators use."""
    from pyspark.sql import functions as F

    return docs.withColumns({name: F.lit("x") for name in CLASHING if name not in docs.columns})


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
