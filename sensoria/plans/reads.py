"""Reading queries over silver and gold tables.

Parameters reach the plan as literals, never as text spliced into SQL.  Month
filters are half-open date ranges, so Parquet row groups outside the month are
skipped.  Station and point tables meet readings that were already reduced per
sensor (see :mod:`sensoria.operators.rollups`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.catalogs import TRAFFIC_VARIABLES
from sensoria.functions.dates import within_month
from sensoria.operators.cleaning import valid_only
from sensoria.operators.rollups import distinct_by_attribute, mean_by_attribute


def traffic_variable(name: str) -> str:
    """Checked name of a traffic variable."""
    if name.upper() not in TRAFFIC_VARIABLES:
        raise ValueError(f"unknown traffic variable: {name!r}")
    return name.upper()


def chosen(option: object) -> bool:
    """Whether a selector has a value; 0 is one."""
    return option is not None and option != ""


def _of_gas(air: DataFrame, gas: str) -> DataFrame:
    return valid_only(air).filter(F.col("MAGNITUD") == F.lit(gas))


def _read_at(readings: DataFrame, sensors: DataFrame, sensor: str) -> DataFrame:
    """Readings of the given sensors only, so that others are not aggregated and shuffled."""
    return readings.join(sensors.select(sensor), sensor, "left_semi")


def _in_district(sensors: DataFrame, district: str) -> DataFrame:
    return sensors.filter(F.col("COD_DIS") == F.lit(str(district)))


def _month_start(column: str):
    return F.trunc(F.to_date(column), "month")


# Lists of sensors, gases and districts.


def traffic_districts(points: DataFrame) -> DataFrame:
    return points.select("COD_DIS").distinct().orderBy("COD_DIS")


def stations(air: DataFrame) -> DataFrame:
    """Station ids as text, in numeric order."""
    ids = air.select("ID_AIRE").distinct().orderBy("ID_AIRE")
    return ids.select(F.col("ID_AIRE").cast("string").alias("ID_AIRE"))


def magnitudes(air: DataFrame, station: int | str | None = None) -> DataFrame:
    if chosen(station):
        air = air.filter(F.col("ID_AIRE") == F.lit(int(station)))
    return air.select("MAGNITUD").distinct().orderBy("MAGNITUD")


# Series of one sensor.


def monthly_average(air: DataFrame, station: int | str, gas: str) -> DataFrame:
    rows = _of_gas(air, gas).filter(F.col("ID_AIRE") == F.lit(int(station)))
    by_month = rows.groupBy(_month_start("FECHA").alias("mes"))
    return by_month.agg(F.avg("DATO").alias("media")).orderBy("mes")


def daily_values(air: DataFrame, station: int | str, gas: str) -> DataFrame:
    rows = _of_gas(air, gas).filter(F.col("ID_AIRE") == F.lit(int(station)))
    return rows.select(F.to_date("FECHA").alias("dia"), "DATO").orderBy("dia", "DATO")


def monthly_average_traffic(
    traffic: DataFrame, point: int | str, variable: str
) -> DataFrame:
    rows = traffic.filter(F.col("ID_TRAFICO") == F.lit(int(point)))
    by_month = rows.groupBy(_month_start("FECHA").alias("mes"))
    return by_month.agg(F.avg(traffic_variable(variable)).alias("media")).orderBy("mes")


def daily_traffic_series(
    traffic: DataFrame, point: int | str, variable: str
) -> DataFrame:
    rows = traffic.filter(F.col("ID_TRAFICO") == F.lit(int(point)))
    by_day = rows.groupBy(F.to_date("FECHA").alias("dia"))
    return by_day.agg(F.avg(traffic_variable(variable)).alias("valor")).orderBy("dia")


# Means by district.


def district_monthly_air(
    air: DataFrame, sensors: DataFrame, gas: str, year: int, month: int
) -> DataFrame:
    rows = _of_gas(air, gas).filter(within_month(F.col("FECHA"), year, month))
    return mean_by_attribute(
        rows, sensors, "ID_AIRE", "DATO", ["COD_DIS"], name="valor_medio"
    ).orderBy("COD_DIS")


def district_monthly_traffic(
    traffic: DataFrame, points: DataFrame, variable: str, year: int, month: int
) -> DataFrame:
    variable = traffic_variable(variable)
    rows = traffic.filter(within_month(F.col("FECHA"), year, month))
    return mean_by_attribute(
        rows, points, "ID_TRAFICO", variable, ["COD_DIS"], name="valor_medio"
    ).orderBy("COD_DIS")


def daily_air_by_district(
    air: DataFrame, sensors: DataFrame, gas: str, district: str
) -> DataFrame:
    chosen = _in_district(sensors, district)
    return mean_by_attribute(
        _read_at(_of_gas(air, gas), chosen, "ID_AIRE"),
        chosen,
        "ID_AIRE",
        "DATO",
        periods=[F.to_date("FECHA").alias("dia")],
        period_names=["dia"],
    ).orderBy("dia")


def daily_traffic_by_district_noon(
    traffic: DataFrame, points: DataFrame, variable: str, district: str
) -> DataFrame:
    """Daily mean over the readings taken within the noon hour."""
    chosen = _in_district(points, district)
    return mean_by_attribute(
        _read_at(traffic.filter(F.hour("FECHA") == 12), chosen, "ID_TRAFICO"),
        chosen,
        "ID_TRAFICO",
        traffic_variable(variable),
        periods=[F.to_date("FECHA").alias("dia")],
        period_names=["dia"],
    ).orderBy("dia")


# What is available where and when.


def air_variables_by_district(
    air: DataFrame, sensors: DataFrame, district: str
) -> DataFrame:
    chosen = _in_district(sensors, district)
    return distinct_by_attribute(
        _read_at(valid_only(air), chosen, "ID_AIRE"),
        chosen,
        "ID_AIRE",
        ["MAGNITUD"],
        ["MAGNITUD"],
    ).orderBy("MAGNITUD")


def districts_by_gas(air: DataFrame, sensors: DataFrame, gas: str) -> DataFrame:
    return distinct_by_attribute(
        _of_gas(air, gas), sensors, "ID_AIRE", [], ["COD_DIS"]
    ).orderBy("COD_DIS")


def air_periods(
    air: DataFrame, sensors: DataFrame, gas: str, district: str
) -> DataFrame:
    """Months with a valid reading as (anio, mes)."""
    chosen = _in_district(sensors, district)
    return distinct_by_attribute(
        _read_at(_of_gas(air, gas), chosen, "ID_AIRE"),
        chosen,
        "ID_AIRE",
        [F.year("FECHA").alias("anio"), F.month("FECHA").alias("mes")],
        ["anio", "mes"],
    ).orderBy("anio", "mes")


def traffic_periods(
    traffic: DataFrame, points: DataFrame, variable: str, district: str
) -> DataFrame:
    """Every month from the first to the last reading of a district.

    Months without readings inside that span are listed as well; see
    :func:`traffic_periods_exact` for those with data only.
    """
    traffic_variable(variable)
    chosen = _in_district(points, district)
    span = (
        _read_at(traffic, chosen, "ID_TRAFICO")
        .agg(F.min("FECHA").alias("f0"), F.max("FECHA").alias("f1"))
        .filter(F.col("f0").isNotNull())
    )
    months = span.select(
        F.explode(
            F.sequence(_month_start("f0"), _month_start("f1"), F.expr("INTERVAL 1 MONTH"))
        ).alias("m")
    )
    return months.select(F.year("m").alias("anio"), F.month("m").alias("mes")).orderBy(
        "anio", "mes"
    )


def traffic_periods_exact(
    traffic: DataFrame, points: DataFrame, variable: str, district: str
) -> DataFrame:
    """Months with at least one value of the variable in a district."""
    rows = traffic.filter(F.col(traffic_variable(variable)).isNotNull())
    chosen = _in_district(points, district)
    return distinct_by_attribute(
        _read_at(rows, chosen, "ID_TRAFICO"),
        chosen,
        "ID_TRAFICO",
        [F.year("FECHA").alias("anio"), F.month("FECHA").alias("mes")],
        ["anio", "mes"],
    ).orderBy("anio", "mes")


# Positions and counts.


def points_by_district(points: DataFrame, district: str) -> DataFrame:
    return (
        _in_district(points, district)
        .select("ID_TRAFICO", "NOMBRE", "LONGITUD", "LATITUD")
        .orderBy("NOMBRE", "ID_TRAFICO")
    )


def station_coords(sensors: DataFrame) -> DataFrame:
    return sensors.select(
        "ID_AIRE", "ESTACION", "LONGITUD", "LATITUD", "COD_DIS"
    ).orderBy("ESTACION", "ID_AIRE")


def count_in_district(sensors: DataFrame, district: str) -> DataFrame:
    return _in_district(sensors, district).agg(F.count(F.lit(1)).alias("n"))
