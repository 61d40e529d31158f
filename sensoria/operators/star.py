"""Gold star schema: dimensions and facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.catalogs import (
    FLAG_GAS_CODES,
    GAS_LABELS,
    STATION_FLAGS,
    TRAFFIC_VARIABLES,
)
from sensoria.functions.codes import pad_code, presence_flag
from sensoria.functions.readings import inside_box
from sensoria.operators.reshape import measures_to_rows
from sensoria.operators.rollups import count_by, daily_rollup, latest_per_key


def dim_estacion_aire(stations: DataFrame) -> DataFrame:
    """Station dimension of silver stations, gas marks as 1/0."""
    return stations.select(
        "ID_AIRE", "ESTACION", "DIRECCION", "LATITUD", "LONGITUD", "COD_DIS",
        *[presence_flag(F.col(flag)).alias(flag) for flag in STATION_FLAGS],
    )


def dim_punto_trafico(
    snapshots: DataFrame, order: Sequence[str] = ("snapshot",)
) -> DataFrame:
    """Traffic point dimension: latest snapshot per point, then sanity filters.

    Filters run after the choice of the snapshot, so a point whose latest row is
    unusable drops out rather than falling back to an older row.
    """
    latest = latest_per_key(snapshots, ["id"], order)
    return latest.filter(
        F.col("distrito").isNotNull() & inside_box(F.col("latitud"), F.col("longitud"))
    ).select(
        F.col("id").alias("ID_TRAFICO"),
        pad_code(F.col("distrito")).alias("COD_DIS"),
        F.col("nombre").alias("NOMBRE"),
        F.col("latitud").alias("LATITUD"),
        F.col("longitud").alias("LONGITUD"),
    )


def dim_distrito(
    districts: DataFrame, stations: DataFrame, points: DataFrame
) -> DataFrame:
    """District dimension with sensor counts and coverage marks."""
    counted = (
        districts.join(count_by(stations, "COD_DIS", "N_ESTACIONES_AIRE"), "COD_DIS", "left")
        .join(count_by(points, "COD_DIS", "N_PUNTOS_TRAFICO"), "COD_DIS", "left")
        .fillna(0, ["N_ESTACIONES_AIRE", "N_PUNTOS_TRAFICO"])
    )
    return counted.withColumns(
        {
            "COBERTURA_AIRE": F.col("N_ESTACIONES_AIRE") > 0,
            "COBERTURA_TRAFICO": F.col("N_PUNTOS_TRAFICO") > 0,
        }
    )


def flags_to_rows(stations: DataFrame) -> DataFrame:
    """Gases measured by at least one station of a district."""
    flags = [flag for flag in STATION_FLAGS if flag in FLAG_GAS_CODES]
    by_district = stations.groupBy("COD_DIS").agg(
        *[F.max(flag).alias(flag) for flag in flags]
    )
    gases = F.array(
        *[
            F.struct(
                F.lit(FLAG_GAS_CODES[flag]).alias("ID_MAGNITUD"),
                F.lit(GAS_LABELS[FLAG_GAS_CODES[flag]]).alias("MAGNITUD"),
                F.col(flag).alias("_medido"),
            )
            for flag in flags
        ]
    )
    return (
        by_district.select("COD_DIS", F.inline(gases))
        .filter(F.col("_medido") == 1)
        .drop("_medido")
    )


def union_bounds(air: DataFrame, traffic: DataFrame) -> DataFrame:
    """First and last day over both silver tables, one row."""
    days = air.select(F.to_date("FECHA").alias("d")).unionByName(
        traffic.select(F.to_date("FECHA").alias("d"))
    )
    return days.agg(F.min("d").alias("f0"), F.max("d").alias("f1"))


def dim_fecha(air: DataFrame, traffic: DataFrame) -> DataFrame:
    """One row per calendar day between the bounds of both silver tables."""
    days = union_bounds(air, traffic).select(
        F.explode(F.sequence("f0", "f1", F.expr("INTERVAL 1 DAY"))).alias("d")
    )
    return days.select(
        F.col("d").cast("timestamp_ntz").alias("FECHA"),
        F.year("d").cast("long").alias("ANIO"),
        F.month("d").cast("long").alias("MES"),
    )


def fact_calidad_aire(
    air: DataFrame, stations: DataFrame, gases: DataFrame
) -> DataFrame:
    """Air fact: silver readings with district and gas id.

    A row-level join that keeps every reading; where the station table is too
    large to broadcast, the adaptive skew join splits hot stations.
    """
    return (
        air.join(stations.select("ID_AIRE", "COD_DIS"), "ID_AIRE")
        .join(gases.select("MAGNITUD", "ID_MAGNITUD"), "MAGNITUD")
        .select("FECHA", "ID_AIRE", "COD_DIS", "ID_MAGNITUD", "DATO")
    )


def traffic_daily_by_point(traffic: DataFrame, points: DataFrame) -> DataFrame:
    """Daily means with the point's district; unknown points drop out.

    The 15-minute rows are reduced to days before they meet the point table.
    """
    daily = daily_rollup(traffic, TRAFFIC_VARIABLES)
    districts = points.select("ID_TRAFICO", "COD_DIS").distinct()
    return daily.join(districts, "ID_TRAFICO").select(
        "FECHA", "ID_TRAFICO", "COD_DIS", *TRAFFIC_VARIABLES
    )


def fact_trafico_diario(
    traffic: DataFrame, points: DataFrame, measures: DataFrame
) -> DataFrame:
    """Traffic fact: one row per point, day and measure."""
    long = measures_to_rows(
        traffic_daily_by_point(traffic, points), ["FECHA", "ID_TRAFICO", "COD_DIS"]
    )
    return long.join(measures, "MEDIDA").select(
        "FECHA", "ID_TRAFICO", "COD_DIS", "ID_MEDIDA_TRAFICO", "VALOR"
    )
