"""Pairs of Spark query and oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensoria.checks.fixtures import Inputs, expand
from sensoria.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DECIMALS = 6


def rounded(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Doubles rounded, so that summation order cannot show."""
    return df.select(
        *[
            F.round(name, decimals).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def check(name: str, sql: str | None = None, decimals: int | None = DECIMALS):
    """Register a query taking :class:`Inputs`, with the SQL giving the same rows."""

    def register(build: Callable[[Inputs], DataFrame]):
        def query(spark: SparkSession, folder: str) -> DataFrame:
            result = build(Inputs(configure(spark), folder))
            return result if decimals is None else rounded(result, decimals)

        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = expand(sql)
        return build

    return register
