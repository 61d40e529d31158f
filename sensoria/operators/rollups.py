"""Aggregations over readings that carry a sensor key.

The recurring question is "mean by some attribute of the sensor" (its district).
The plan is always the same: sum and count per sensor first, which collapses in
the map tasks however many readings one sensor has, and only then meet the
sensor table.  The join therefore sees one row per sensor and period instead of
raw readings, and a sensor that holds a third of all rows is no hot key.

Spark chooses how to join from the measured sizes; nothing is broadcast by hint,
because sensor tables may grow with the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums_per_sensor(
    readings: DataFrame, sensor: str, value: str, periods: Sequence[Column] = ()
) -> DataFrame:
    """Partial means: ``_sum`` and ``_n`` per sensor and period."""
    return readings.groupBy(sensor, *periods).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_n")
    )


def mean_of_sums() -> Column:
    return F.try_divide(F.sum("_sum"), F.sum("_n"))


def mean_by_attribute(
    readings: DataFrame,
    sensors: DataFrame,
    sensor: str,
    value: str,
    attributes: Sequence[str] = (),
    periods: Sequence[Column] = (),
    period_names: Sequence[str] = (),
    name: str = "media",
) -> DataFrame:
    """Mean of ``value`` by sensor attributes and periods, one row per group."""
    partial = sums_per_sensor(readings, sensor, value, periods)
    located = partial.join(sensors.select(sensor, *attributes), sensor)
    return located.groupBy(*attributes, *period_names).agg(mean_of_sums().alias(name))


def distinct_by_attribute(
    readings: DataFrame,
    sensors: DataFrame,
    sensor: str,
    columns: Sequence[Column | str],
    result: Sequence[str],
) -> DataFrame:
    """Distinct combinations seen at the given sensors, reduced before the join."""
    seen = readings.select(sensor, *columns).distinct()
    return seen.join(sensors, sensor).select(*result).distinct()


def daily_rollup(traffic: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Mean of each measure by day and point; the 15-minute rows end here."""
    return traffic.groupBy(F.to_date("FECHA").alias("FECHA"), "ID_TRAFICO").agg(
        *[F.avg(measure).alias(measure) for measure in measures]
    )


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The row of each key that is greatest in ``order`` (NULLs are lowest).

    A partial maximum keeps one candidate per key and map task, so copies of a single
    key are never gathered.  Rows equal in ``order`` are told apart by their other
    columns, which makes the choice repeatable.
    """
    rank = [F.col(name).alias(f"_orden_{i}") for i, name in enumerate(order)]
    best = df.groupBy(*keys).agg(F.max(F.struct(*rank, *df.columns)).alias("_fila"))
    return best.select(*[F.col("_fila")[name].alias(name) for name in df.columns])


def count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def count_where(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row of conditional counts."""
    return df.agg(*[F.count_if(test).alias(name) for name, test in conditions.items()])


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of NULLs of every column."""
    return count_where(df, {name: F.col(name).isNull() for name in df.columns})


def date_coverage(df: DataFrame, column: str = "FECHA") -> DataFrame:
    """Range, days with data, days in range and rows: shows gaps at a glance.

    Rows are first counted per day, so the distinct days come out of the same
    aggregation instead of expanding the input.
    """
    per_day = df.groupBy(F.to_date(column).alias("dia")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_day.agg(
        F.min("dia").alias("fecha_min"),
        F.max("dia").alias("fecha_max"),
        F.count("dia").alias("dias_con_dato"),
        (F.datediff(F.max("dia"), F.min("dia")) + 1).cast("long").alias("dias_del_rango"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("filas"),
    )


def group_profile(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows and non-NULL values of a column per group."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count(column).alias(f"n_{column}")
    )
