"""Leak-free features for direct forecasts of a whole horizon.

A feature is legal when it is known on the day the forecast is made: calendar
values of the target day, and readings at least H days older than it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensoria.functions.dates import is_weekend, weekday, year_angle
from sensoria.operators.quality import require_none

# Days added to the horizon for each lag, and the rolling window.
LAG_OFFSETS = (0, 7, 30)
ROLLING_DAYS = 30

LAG_FEATURES = tuple(f"lag_{offset}" for offset in LAG_OFFSETS) + ("roll_mean",)
CALENDAR_FEATURES = ("dow", "mes", "doy_sin", "doy_cos", "is_weekend")
FEATURES = ("estacion",) + LAG_FEATURES + CALENDAR_FEATURES

SERIES = ("gas", "estacion", "cod_dis")


def history(fact: DataFrame, gases: DataFrame, names: list[str]) -> DataFrame:
    """Readings of the named gases out of the air fact."""
    wanted = gases.filter(F.col("MAGNITUD").isin(names))
    return fact.join(F.broadcast(wanted), "ID_MAGNITUD").select(
        F.col("MAGNITUD").alias("gas"),
        F.col("ID_AIRE").alias("estacion"),
        F.col("COD_DIS").alias("cod_dis"),
        F.col("FECHA").alias("fecha"),
        F.col("DATO").alias("dato"),
    )


def history_bounds(hist: DataFrame) -> DataFrame:
    """First and last day with data per gas.

    One row per gas of a fixed catalogue, so it is safe to broadcast: joining on the
    gas would otherwise shuffle everything onto a handful of hot keys.
    """
    return hist.groupBy("gas").agg(F.min("fecha").alias("f0"), F.max("fecha").alias("f1"))


def dense_series(hist: DataFrame, horizon_days: int) -> DataFrame:
    """One row per series and day, from the gas's first day to last + H.

    ``futuro`` marks the H days after the last one with data.

    The empty calendar of each series is appended to the readings and both are
    aggregated by day.  That fills gaps with NULL and enforces the grain in one
    shuffle with map-side combine; repeated readings of one day are averaged.
    """
    bounds = history_bounds(hist)
    calendar = (
        hist.select(*SERIES)
        .distinct()
        .join(F.broadcast(bounds), "gas")
        .select(
            *SERIES,
            "f1",
            F.explode(F.sequence("f0", F.date_add("f1", horizon_days))).alias("fecha"),
        )
    )
    empty_days = calendar.select(
        *SERIES,
        "fecha",
        F.lit(None).cast("double").alias("dato"),
        (F.col("fecha") > F.col("f1")).alias("futuro"),
    )
    readings = hist.select(*SERIES, "fecha", "dato", F.lit(False).alias("futuro"))
    return (
        empty_days.unionByName(readings)
        .groupBy(*SERIES, "fecha")
        .agg(F.avg("dato").alias("dato"), F.max("futuro").alias("futuro"))
    )


def add_features(dense: DataFrame, horizon_days: int) -> DataFrame:
    """Lag, rolling and calendar columns on a dense series.

    Lags count rows, which on the dense series are days.  All windows share one
    partitioning and ordering, so there is a single shuffle, and a window holds
    one series at daily grain: its size is the calendar, not the readings.
    """
    by_day = Window.partitionBy(*SERIES).orderBy("fecha")
    rolling = by_day.rowsBetween(-(horizon_days + ROLLING_DAYS), -horizon_days)
    angle = year_angle(F.col("fecha"))
    return dense.select(
        *SERIES,
        "fecha",
        "dato",
        *[
            F.lag("dato", horizon_days + offset).over(by_day).alias(f"lag_{offset}")
            for offset in LAG_OFFSETS
        ],
        F.avg("dato").over(rolling).alias("roll_mean"),
        weekday(F.col("fecha")).alias("dow"),
        F.month("fecha").alias("mes"),
        F.sin(angle).alias("doy_sin"),
        F.cos(angle).alias("doy_cos"),
        is_weekend(F.col("fecha")).alias("is_weekend"),
        "futuro",
    )


def feature_table(hist: DataFrame, horizon_days: int) -> DataFrame:
    """Complete feature rows; ``futuro`` marks the days to be forecast.

    Rows lacking a lag or rolling value are dropped, on both sides: a gap in the
    history also removes the forecast days that would need it.
    """
    ready = add_features(dense_series(hist, horizon_days), horizon_days).dropna(
        subset=list(LAG_FEATURES)
    )
    return ready.filter(F.col("futuro") | F.col("dato").isNotNull())


def train_rows(features: DataFrame) -> DataFrame:
    return features.filter(~F.col("futuro")).drop("futuro")


def future_rows(features: DataFrame) -> DataFrame:
    return features.filter("futuro").drop("futuro", "dato")


def leaking_rows(future: DataFrame, hist: DataFrame, horizon_days: int) -> DataFrame:
    """Gases whose furthest forecast day would need an unobserved lag."""
    furthest = future.groupBy("gas").agg(F.max("fecha").alias("hasta"))
    return furthest.join(F.broadcast(history_bounds(hist)), "gas").filter(
        F.date_sub("hasta", horizon_days) > F.col("f1")
    )


def require_no_leak(future: DataFrame, hist: DataFrame, horizon_days: int) -> None:
    require_none(leaking_rows(future, hist, horizon_days), "a lag reads unseen days")
