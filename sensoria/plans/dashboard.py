"""Data behind the dashboard: selectors, KPIs, maps, tables, overlays."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.catalogs import (
    DEFAULT_AIR_VARIABLES,
    DEFAULT_MONTHS,
    DEFAULT_UNIT,
    DEFAULT_YEARS,
    TRAFFIC_VARIABLES,
    UNITS,
    band_table,
)
from sensoria.functions.codes import run_gas, run_months
from sensoria.operators.bands import band_labels, color_of
from sensoria.plans import reads
from sensoria.session import literal_table
from sensoria.sources.tables import Lakehouse

AIR = "Aire"


@dataclass(frozen=True)
class SensorTables:
    """The tables the dashboard reads; the selectors do without ``outlines``."""

    air: DataFrame
    stations: DataFrame
    traffic: DataFrame
    points: DataFrame
    districts: DataFrame
    outlines: DataFrame | None = None

    @classmethod
    def of(cls, lake: Lakehouse) -> SensorTables:
        return cls(
            lake.silver("aire"),
            lake.silver("estaciones_aire"),
            lake.silver("trafico"),
            lake.gold("dim_punto_trafico"),
            lake.gold("dim_distrito"),
            lake.gold("dim_geometria"),
        )


def first_non_empty(preferred: DataFrame, fallback: DataFrame) -> DataFrame:
    """``preferred``, or all of ``fallback`` when it has no rows.

    Both inputs are short option lists.  The emptiness test is a scalar subquery
    of the same plan, so nothing runs on the driver.
    """
    empty = preferred.agg((F.count(F.lit(1)) == 0).alias("e")).scalar()
    return preferred.unionByName(fallback.filter(empty))


def _options(df: DataFrame, column: str, values: Sequence, kind: str) -> DataFrame:
    return literal_table(df.sparkSession, [(v,) for v in values], f"{column} {kind}")


# Selectors.


def district_options(
    tables: SensorTables, domain: str | None = None, variable: str | None = None
) -> DataFrame:
    every = reads.traffic_districts(tables.points)
    if domain != AIR or not variable:
        return every
    measured = reads.districts_by_gas(tables.air, tables.stations, variable)
    return first_non_empty(measured, every)


def variable_options(
    tables: SensorTables, domain: str, district: str | None = None
) -> DataFrame:
    if domain != AIR:
        return _options(tables.air, "MAGNITUD", sorted(TRAFFIC_VARIABLES), "string")
    every = _options(tables.air, "MAGNITUD", DEFAULT_AIR_VARIABLES, "string")
    if not district:
        return every
    measured = reads.air_variables_by_district(tables.air, tables.stations, district)
    return first_non_empty(measured, every)


def _periods(
    tables: SensorTables, domain: str, variable: str, district: str
) -> DataFrame:
    if domain == AIR:
        return reads.air_periods(tables.air, tables.stations, variable, district)
    return reads.traffic_periods(tables.traffic, tables.points, variable, district)


def year_options(
    tables: SensorTables, domain: str, variable: str | None, district: str | None
) -> DataFrame:
    every = _options(tables.air, "anio", DEFAULT_YEARS, "int")
    if not variable or not district:
        return every
    periods = _periods(tables, domain, variable, district)
    return first_non_empty(periods.select("anio").distinct(), every).orderBy("anio")


def month_options(
    tables: SensorTables,
    domain: str,
    variable: str | None,
    district: str | None,
    year: int | str | None,
) -> DataFrame:
    every = _options(tables.air, "mes", DEFAULT_MONTHS, "int")
    if not variable or not district or not year:
        return every
    periods = _periods(tables, domain, variable, district)
    of_year = periods.filter(F.col("anio") == F.lit(int(year))).select("mes")
    return first_non_empty(of_year, every).orderBy("mes")


# Values of either domain.


def district_values(
    tables: SensorTables, domain: str, variable: str, year: int, month: int
) -> DataFrame:
    """Monthly mean per district."""
    if domain == AIR:
        return reads.district_monthly_air(
            tables.air, tables.stations, variable, year, month
        )
    return reads.district_monthly_traffic(
        tables.traffic, tables.points, variable, year, month
    )


def evolution(
    tables: SensorTables, domain: str, variable: str, district: str
) -> DataFrame:
    """Daily mean of one district over the whole history."""
    if domain == AIR:
        return reads.daily_air_by_district(tables.air, tables.stations, variable, district)
    return reads.daily_traffic_by_district_noon(
        tables.traffic, tables.points, variable, district
    )


def overview(
    tables: SensorTables,
    domain: str,
    variable: str,
    district: str,
    year: int,
    month: int,
) -> dict[str, DataFrame]:
    """All that one search shows: legend, map, counts, mean and daily series."""
    if tables.outlines is None:
        raise ValueError("the map needs the outlines of the districts")
    means = district_values(tables, domain, variable, year, month)
    legend = band_labels(band_table(tables.air.sparkSession))
    return {
        "legend": legend.filter(F.col("variable") == F.lit(variable)),
        "map": choropleth_table(tables.districts, means, variable, tables.outlines),
        "counts": kpi_counts(tables.stations, tables.points, district),
        "mean": kpi_mean(means, district),
        "evolution": evolution(tables, domain, variable, district),
    }


def summary(tables: SensorTables) -> dict[str, DataFrame]:
    """Catalogue view: KPIs, positions, coverage map and table."""
    return {
        "kpis": summary_kpis(tables.districts),
        "positions": position_layer(tables.stations, tables.points),
        "map": coverage_map(tables.districts),
        "table": coverage_table(tables.districts),
    }


def prediction_view(
    fact: DataFrame,
    gases: DataFrame,
    predictions: DataFrame,
    metrics: DataFrame,
    gas: str,
    station: int,
) -> dict[str, DataFrame]:
    """The stored forecasts of one gas and station: choices, series and model table.

    ``predictions`` and ``metrics`` are what the forecast job wrote.  Everything follows the
    longest run of the gas; a gas without a run has neither forecast nor metrics.
    """
    runs = longest_runs(predictions.select("run").distinct())
    chosen = runs.filter(F.col("gas") == F.lit(gas))
    # the date filter of a caller reaches the fact; the gas is resolved by its name
    gas_id = gases.filter(F.col("MAGNITUD") == F.lit(gas)).select("ID_MAGNITUD")
    own = F.col("ID_AIRE") == F.lit(int(station))
    real = fact.filter(own).join(gas_id, "ID_MAGNITUD", "left_semi")
    ahead = predictions.filter(own).join(chosen.select("run"), "run", "left_semi")
    compared = metrics.join(
        chosen.select("gas", F.col("meses").alias("horizonte_meses")),
        ["gas", "horizonte_meses"],
        "left_semi",
    )
    return {
        "gases": runs,
        "estaciones": forecast_stations(predictions, gas),
        "serie": history_plus_forecast(
            real.select(F.col("FECHA").alias("fecha"), F.col("DATO").alias("dato")),
            ahead.select(F.col("FECHA").alias("fecha"), F.col("VALOR_PREDICHO").alias("valor")),
        ),
        "metricas": metrics_table(compared),
    }


# KPIs and tables.


def kpi_mean(district_means: DataFrame, district: str) -> DataFrame:
    """One row: a district's mean to two decimals, NULL when it has none."""
    own = district_means.filter(F.col("COD_DIS") == F.lit(str(district)))
    return own.agg(F.round(F.max("valor_medio"), 2).alias("valor"))


def kpi_counts(stations: DataFrame, points: DataFrame, district: str) -> DataFrame:
    """One row: stations and traffic points of a district."""
    n_points = reads.count_in_district(points, district).scalar()
    counted = reads.count_in_district(stations, district)
    return counted.select(
        F.col("n").alias("n_estaciones"), F.coalesce(n_points, F.lit(0)).alias("n_puntos")
    )


def summary_kpis(dim_distrito: DataFrame) -> DataFrame:
    return dim_distrito.agg(
        F.count(F.lit(1)).alias("n_distritos"),
        F.sum("N_ESTACIONES_AIRE").alias("n_estaciones"),
        F.sum("N_PUNTOS_TRAFICO").alias("n_puntos"),
        F.count_if(~F.col("COBERTURA_AIRE")).alias("n_sin_cobertura"),
    )


def coverage_table(dim_distrito: DataFrame) -> DataFrame:
    mark = F.when(F.col("COBERTURA_AIRE"), "With coverage").otherwise("No coverage")
    return dim_distrito.select(
        "NOMBRE", "N_ESTACIONES_AIRE", "N_PUNTOS_TRAFICO", mark.alias("cobertura")
    ).orderBy("NOMBRE")


def daily_table(
    air: DataFrame, station: int | str | None, gas: str | None
) -> DataFrame:
    """(Fecha, Valor, unidad) of one series; empty until both are chosen."""
    if not (reads.chosen(station) and reads.chosen(gas)):
        rows = air.select(F.to_date("FECHA").alias("dia"), "DATO").limit(0)
    else:
        rows = reads.daily_values(air, station, gas)
    return rows.select(
        F.col("dia").alias("Fecha"),
        F.col("DATO").alias("Valor"),
        F.lit(UNITS.get(gas, DEFAULT_UNIT)).alias("unidad"),
    )


# Maps.


def position_layer(
    stations: DataFrame, points: DataFrame, district: str | None = None
) -> DataFrame:
    """Every station with its district, and the traffic points of the chosen district."""
    layer = stations.select(
        F.lit("estacion").alias("kind"),
        F.col("ID_AIRE").alias("id"),
        F.col("ESTACION").alias("nombre"),
        F.col("LONGITUD").alias("longitud"),
        F.col("LATITUD").alias("latitud"),
        F.col("COD_DIS").alias("distrito"),
    )
    if not district:
        return layer
    chosen = reads.points_by_district(points, district).select(
        F.lit("punto").alias("kind"),
        F.col("ID_TRAFICO").alias("id"),
        F.col("NOMBRE").alias("nombre"),
        F.col("LONGITUD").alias("longitud"),
        F.col("LATITUD").alias("latitud"),
        F.lit(str(district)).alias("distrito"),
    )
    return layer.unionByName(chosen)


def choropleth_table(
    districts: DataFrame, district_means: DataFrame, variable: str, outlines: DataFrame
) -> DataFrame:
    """Every district with its mean, its text for the popup, its colour and its number's place.

    ``outlines`` is the geometry dimension; a district without geometry has no place.
    """
    places = outlines.select("COD_DIS", "CENTROID_LAT", "CENTROID_LON")
    valued = districts.join(district_means, "COD_DIS", "left").join(places, "COD_DIS", "left")
    text = F.coalesce(F.round("valor_medio", 2).cast("string"), F.lit("N/A"))
    return valued.select(
        "COD_DIS",
        "NOMBRE",
        "valor_medio",
        text.alias("valor_texto"),
        color_of(F.col("valor_medio"), variable).alias("color"),
        "CENTROID_LAT",
        "CENTROID_LON",
    )


def coverage_map(dim_distrito: DataFrame) -> DataFrame:
    color = F.when(F.col("COBERTURA_AIRE"), "green").otherwise("red")
    return dim_distrito.select(
        "COD_DIS", "NOMBRE", "N_ESTACIONES_AIRE", "N_PUNTOS_TRAFICO", color.alias("color")
    )


# Series.


def air_traffic_by_day(daily_air: DataFrame, daily_traffic: DataFrame) -> DataFrame:
    """Days on which both a gas and a traffic mean exist."""
    return (
        daily_air.select("dia", F.col("media").alias("media_gas"))
        .join(daily_traffic.select("dia", F.col("media").alias("media_trafico")), "dia")
        .orderBy("dia")
    )


def history_plus_forecast(real: DataFrame, forecast: DataFrame) -> DataFrame:
    """Real series, then the forecast starting at a bridge point.

    ``real`` is (fecha, dato) of one series and ``forecast`` (fecha, valor).  The
    bridge repeats the last real reading as the forecast's first point.
    """
    last = real.agg(
        F.max("fecha").alias("fecha"), F.max_by("dato", "fecha").alias("valor")
    ).filter(F.col("fecha").isNotNull())
    place = F.array_position(F.lit(["real", "puente", "predicho"]), F.col("kind"))
    return (
        real.select("fecha", F.col("dato").alias("valor"), F.lit("real").alias("kind"))
        .unionByName(last.withColumn("kind", F.lit("puente")))
        .unionByName(
            forecast.select("fecha", "valor", F.lit("predicho").alias("kind"))
        )
        .orderBy(place, "fecha")
    )


def longest_runs(runs: DataFrame) -> DataFrame:
    """Longest forecast run of each gas out of run names in column ``run``."""
    named = runs.select(
        "run", run_gas(F.col("run")).alias("gas"), run_months(F.col("run")).alias("meses")
    ).filter(F.col("gas").isNotNull())
    longest = named.groupBy("gas").agg(
        F.max("meses").alias("meses"), F.max_by("run", "meses").alias("run")
    )
    return longest.orderBy("gas")


def forecast_stations(predictions: DataFrame, gas: str) -> DataFrame:
    """Stations in the longest run of a gas."""
    names = predictions.select("run").distinct()
    longest = longest_runs(names).filter(F.col("gas") == F.lit(gas))
    return (
        predictions.join(longest.select("run"), "run", "left_semi")
        .select("ID_AIRE")
        .distinct()
        .orderBy("ID_AIRE")
    )


def metrics_table(metrics: DataFrame) -> DataFrame:
    """Model rows of stored metrics: winner mark, MAE and RMSE to two decimals."""
    rows = metrics.select(
        "gas", "horizonte_meses", "ultima_fecha_real", "ganador", F.inline("comparativa")
    )
    return rows.select(
        "gas",
        "horizonte_meses",
        "ultima_fecha_real",
        "modelo",
        F.round("mae", 2).alias("mae"),
        F.round("rmse", 2).alias("rmse"),
        (F.col("modelo") == F.col("ganador")).alias("es_ganador"),
    )
