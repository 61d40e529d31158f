"""Colour bands and units as small lookup joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensoria.catalogs import (
    COLOR_BANDS,
    COLOR_NO_DATA,
    COLOR_OUT_OF_BANDS,
    DEFAULT_UNIT,
    band_table,
    unit_table,
)


def _no_data(value: Column) -> Column:
    """NULL or not a number, which Spark would place above all bands."""
    return value.isNull() | F.isnan(value.cast("double"))


def color_of(value: Column, variable: str) -> Column:
    """Colour of a value of one variable that is known when the plan is built."""
    color = F.when(_no_data(value), COLOR_NO_DATA)
    for name, lo, hi, band in COLOR_BANDS:
        if name == variable:
            inside = value >= lo if hi is None else (value >= lo) & (value < hi)
            color = color.when(inside, band)
    return color.otherwise(COLOR_OUT_OF_BANDS)


def color_band(df: DataFrame, variable: str, value: str, name: str = "color") -> DataFrame:
    """Colour of a value within its variable's half-open bands.

    A range join with the variable as equality key.  The band table has 36 fixed
    rows, which Spark broadcasts on its own, so the range is tested inside a hash
    join.
    """
    bands = band_table(df.sparkSession).select(
        F.col("variable").alias("_var"), "lo", "hi", "color"
    )
    in_band = (
        (F.col(variable) == F.col("_var"))
        & (F.col(value) >= F.col("lo"))
        & (F.col("hi").isNull() | (F.col(value) < F.col("hi")))
    )
    color = F.when(_no_data(F.col(value)), COLOR_NO_DATA).otherwise(
        F.coalesce(F.col("color"), F.lit(COLOR_OUT_OF_BANDS))
    )
    return df.join(bands, in_band, "left").select(
        *[F.col(column) for column in df.columns], color.alias(name)
    )


def band_labels(bands: DataFrame) -> DataFrame:
    """Legend rows (variable, etiqueta, color, orden) of a band table."""

    def text(column: str):
        return F.col(column).cast("bigint").cast("string")

    label = F.when(F.col("hi").isNull(), F.concat(text("lo"), F.lit("+"))).otherwise(
        F.concat_ws(" - ", text("lo"), text("hi"))
    )
    return bands.select("variable", label.alias("etiqueta"), "color", F.col("lo").alias("orden"))


def with_unit(df: DataFrame, variable: str, name: str = "unidad") -> DataFrame:
    """Display unit of a variable; variables without one get the default."""
    units = unit_table(df.sparkSession).select(
        F.col("variable").alias("_var"), F.col("unit").alias("_unit")
    )
    return df.join(units, F.col(variable) == F.col("_var"), "left").select(
        *[F.col(column) for column in df.columns],
        F.coalesce(F.col("_unit"), F.lit(DEFAULT_UNIT)).alias(name),
    )
