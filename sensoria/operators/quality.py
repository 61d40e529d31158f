"""Integrity checks; every check returns the violating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.session import literal_table

# Natural keys of the gold tables.
NATURAL_KEYS = {
    "dim_distrito": ["COD_DIS"],
    "dim_geometria": ["COD_DIS"],
    "dim_estacion_aire": ["ID_AIRE"],
    "dim_punto_trafico": ["ID_TRAFICO"],
    "dim_magnitud": ["ID_MAGNITUD"],
    "dim_medida_trafico": ["ID_MEDIDA_TRAFICO"],
    "dim_fecha": ["FECHA"],
    "dim_distrito_magnitud": ["COD_DIS", "ID_MAGNITUD"],
    "fact_calidad_aire": ["ID_AIRE", "FECHA", "ID_MAGNITUD"],
    "fact_trafico_diario": ["ID_TRAFICO", "FECHA", "ID_MEDIDA_TRAFICO"],
}

# Foreign keys of the gold tables: column and the dimension whose natural key it is.
FOREIGN_KEYS = {
    "dim_geometria": {"COD_DIS": "dim_distrito"},
    "dim_estacion_aire": {"COD_DIS": "dim_distrito"},
    "dim_punto_trafico": {"COD_DIS": "dim_distrito"},
    "dim_distrito_magnitud": {"COD_DIS": "dim_distrito", "ID_MAGNITUD": "dim_magnitud"},
    "fact_calidad_aire": {
        "FECHA": "dim_fecha", "ID_AIRE": "dim_estacion_aire", "COD_DIS": "dim_distrito",
        "ID_MAGNITUD": "dim_magnitud",
    },
    "fact_trafico_diario": {
        "FECHA": "dim_fecha", "ID_TRAFICO": "dim_punto_trafico", "COD_DIS": "dim_distrito",
        "ID_MEDIDA_TRAFICO": "dim_medida_trafico",
    },
}

# The agreed column types of the gold tables.
CONTRACT = {
    "dim_distrito": {
        "COD_DIS": "string", "NOMBRE": "string", "GEOMETRY": "binary",
        "N_ESTACIONES_AIRE": "bigint", "N_PUNTOS_TRAFICO": "bigint",
        "COBERTURA_AIRE": "boolean", "COBERTURA_TRAFICO": "boolean",
    },
    "dim_geometria": {
        "COD_DIS": "string", "GEOMETRY_WKT": "string",
        "CENTROID_LAT": "double", "CENTROID_LON": "double",
    },
    "dim_estacion_aire": {
        "ID_AIRE": "bigint", "ESTACION": "string", "DIRECCION": "string",
        "LATITUD": "double", "LONGITUD": "double", "COD_DIS": "string",
        "NO2": "bigint", "SO2": "bigint", "CO": "bigint", "PM10": "bigint",
        "PM2_5": "bigint", "O3": "bigint", "BTX": "bigint",
    },
    "dim_punto_trafico": {
        "ID_TRAFICO": "bigint", "COD_DIS": "string", "NOMBRE": "string",
        "LATITUD": "double", "LONGITUD": "double",
    },
    "dim_magnitud": {"ID_MAGNITUD": "int", "MAGNITUD": "string"},
    "dim_medida_trafico": {"ID_MEDIDA_TRAFICO": "int", "MEDIDA": "string"},
    "dim_fecha": {"FECHA": "timestamp_ntz", "ANIO": "bigint", "MES": "bigint"},
    "dim_distrito_magnitud": {
        "COD_DIS": "string", "ID_MAGNITUD": "int", "MAGNITUD": "string",
    },
    "fact_calidad_aire": {
        "FECHA": "date", "ID_AIRE": "bigint", "COD_DIS": "string",
        "ID_MAGNITUD": "int", "DATO": "double",
    },
    "fact_trafico_diario": {
        "FECHA": "date", "ID_TRAFICO": "bigint", "COD_DIS": "string",
        "ID_MEDIDA_TRAFICO": "int", "VALOR": "double",
    },
}


class IntegrityError(AssertionError):
    """A table breaks its contract."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    )


def orphan_keys(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Key values without a dimension row, with their number of rows.

    Values are counted before the anti join, so each is looked up once.
    """
    used = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return used.join(dimension.select(key), key, "left_anti")


def unknown_references(df: DataFrame, references: Mapping[str, DataFrame]) -> DataFrame:
    """(columna, valor, n): values of several foreign keys that their dimensions lack.

    All keys are counted in one pass, one row per value and task before the shuffle.  The
    dimension's key has the column's name; NULLs refer to nothing and pass.
    """
    cells = [
        F.struct(F.lit(name).alias("columna"), F.col(name).cast("string").alias("valor")) for name in references
    ]
    used = df.select(F.inline(F.array(*cells))).where("valor IS NOT NULL")
    kinds = dict(df.dtypes)
    known = None
    for name, dimension in references.items():
        part = dimension.select(F.lit(name).alias("columna"), F.col(name).cast(kinds[name]).cast("string").alias("valor"))
        known = part if known is None else known.unionByName(part)
    counted = used.groupBy("columna", "valor").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(known, ["columna", "valor"], "left_anti")


def schema_drift(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Columns that are missing, unexpected or of another type than agreed."""
    spark = df.sparkSession
    fields = "columna string, {} string"
    actual = literal_table(
        spark,
        [(f.name, f.dataType.simpleString()) for f in df.schema],
        fields.format("tipo_real"),
    )
    agreed = literal_table(spark, contract.items(), fields.format("tipo_acordado"))
    return actual.join(agreed, "columna", "full").filter(
        ~F.col("tipo_real").eqNullSafe(F.col("tipo_acordado"))
    )


def contract_report(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Every column of the table or the contract: both types, rows and NULLs.

    Rows and NULLs come from one aggregation over the table; they are NULL for columns that
    the table lacks.
    """
    rows = F.count(F.lit(1))
    counts = [
        F.struct(F.lit(name).alias("columna"), rows.alias("filas"), F.count_if(F.col(f"`{name}`").isNull()).alias("nulos"))
        for name in df.columns
    ]
    counted = df.agg(F.array(*counts).alias("c")).select(F.inline("c"))
    spark = df.sparkSession
    names = sorted({*df.columns, *contract})
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    every = literal_table(
        spark,
        [(name, types.get(name), contract.get(name)) for name in names],
        "columna string, tipo_real string, tipo_acordado string",
    )
    return every.join(counted, "columna", "left")


def require_none(violations: DataFrame, message: str) -> None:
    """Raise with a few examples when a check found something."""
    examples = violations.take(5)
    if examples:
        raise IntegrityError(f"{message}: {examples}")
