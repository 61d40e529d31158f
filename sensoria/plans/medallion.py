"""Bronze to silver to gold, as one idempotent batch job.

Run with ``spark-submit`` (or ``python -m sensoria.plans.medallion``) and the root
folder of the lake as argument; targets behind it (silver, dimensions, facts, coverage) build
just these.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensoria.catalogs import STATION_RENAMES, gas_table, measure_table
from sensoria.operators.cleaning import clean_traffic, rename_uppercase
from sensoria.operators.geo import (
    assign_district,
    dim_geometria,
    edges_to_degrees,
    polygon_edges,
)
from sensoria.operators.quality import (
    CONTRACT,
    FOREIGN_KEYS,
    NATURAL_KEYS,
    duplicate_keys,
    require_none,
    schema_drift,
    unknown_references,
)
from sensoria.operators.reshape import unpivot_air
from sensoria.operators.star import (
    dim_distrito,
    dim_estacion_aire,
    dim_fecha,
    dim_punto_trafico,
    fact_calidad_aire,
    fact_trafico_diario,
    flags_to_rows,
)
from sensoria.plans import coverage
from sensoria.session import configure
from sensoria.sources.tables import PERIOD, Lakehouse

# Reading queries select days or months, so large tables are laid out by day.
BY_DAY_AND_STATION = ("FECHA", "ID_AIRE")
BY_DAY_AND_POINT = ("FECHA", "ID_TRAFICO")
TARGETS = ("silver", "dimensions", "facts", "coverage")


def _districts(lake: Lakehouse):
    return lake.bronze("distritos").select(
        F.col("COD_DIS_TX").cast("string").alias("COD_DIS"), "NOMBRE", "geometry"
    )


def build_silver(lake: Lakehouse) -> None:
    """Clean air, traffic and stations."""
    lake.write("silver", "aire", unpivot_air(lake.bronze("aire")), BY_DAY_AND_STATION)
    traffic = lake.bronze("trafico").drop(*PERIOD)
    lake.write("silver", "trafico", clean_traffic(traffic), BY_DAY_AND_POINT)
    build_stations(lake)


def build_stations(lake: Lakehouse) -> None:
    districts = _districts(lake)
    edges = edges_to_degrees(polygon_edges(districts, "COD_DIS"))
    stations = assign_district(lake.bronze("estaciones_aire"), edges, districts)
    lake.write("silver", "estaciones_aire", rename_uppercase(stations, STATION_RENAMES))


def build_dimensions(lake: Lakehouse, point_order: tuple[str, ...] = PERIOD) -> None:
    lake.write("gold", "dim_magnitud", gas_table(lake.spark))
    lake.write("gold", "dim_medida_trafico", measure_table(lake.spark))
    lake.write("gold", "dim_estacion_aire", dim_estacion_aire(lake.silver("estaciones_aire")))
    lake.write(
        "gold",
        "dim_punto_trafico",
        dim_punto_trafico(lake.bronze("trafico_puntos_medida"), point_order),
    )
    stations = lake.gold("dim_estacion_aire")
    districts = _districts(lake)
    shapes = districts.withColumnRenamed("geometry", "GEOMETRY")
    lake.write(
        "gold",
        "dim_distrito",
        dim_distrito(shapes, stations, lake.gold("dim_punto_trafico")),
    )
    lake.write("gold", "dim_distrito_magnitud", flags_to_rows(stations))
    lake.write("gold", "dim_geometria", dim_geometria(polygon_edges(districts, "COD_DIS")))
    lake.write("gold", "dim_fecha", dim_fecha(lake.silver("aire"), lake.silver("trafico")))


def build_facts(lake: Lakehouse) -> None:
    lake.write(
        "gold",
        "fact_calidad_aire",
        fact_calidad_aire(
            lake.silver("aire"), lake.gold("dim_estacion_aire"), lake.gold("dim_magnitud")
        ),
        BY_DAY_AND_STATION,
    )
    lake.write(
        "gold",
        "fact_trafico_diario",
        fact_trafico_diario(
            lake.silver("trafico"),
            lake.gold("dim_punto_trafico"),
            lake.gold("dim_medida_trafico"),
        ),
        BY_DAY_AND_POINT,
    )


def check_gold(lake: Lakehouse, names: Sequence[str] = tuple(CONTRACT)) -> None:
    """Raise when a gold table breaks its schema, its grain or a reference.

    A table is read twice: once by its natural key, once for all its foreign keys.
    """
    for name in names:
        check_table(lake, name, lake.gold(name))


def check_table(lake: Lakehouse, name: str, table: DataFrame) -> None:
    """The same of one gold table, or of some of its rows."""
    require_none(schema_drift(table, CONTRACT[name]), f"{name}: columns")
    require_none(duplicate_keys(table, NATURAL_KEYS[name]), f"{name}: grain")
    if references := FOREIGN_KEYS.get(name):
        dimensions = {column: lake.gold(other) for column, other in references.items()}
        require_none(unknown_references(table, dimensions), f"{name}: unknown references")


def run(
    lake: Lakehouse, point_order: tuple[str, ...] = PERIOD, targets: Sequence[str] = TARGETS
) -> None:
    """Build the targets, in their order, and check the gold tables if any of them was built."""
    if unknown := set(targets) - set(TARGETS):
        raise ValueError(f"unknown targets {sorted(unknown)}, not of {TARGETS}")
    steps = {
        "silver": lambda: build_silver(lake),
        "dimensions": lambda: build_dimensions(lake, point_order),
        "facts": lambda: build_facts(lake),
        "coverage": lambda: coverage.rebuild(lake),
    }
    for name in TARGETS:
        if name in targets:
            steps[name]()
    if {"dimensions", "facts"} & set(targets):
        check_gold(lake)


if __name__ == "__main__":
    run(
        Lakehouse(configure(SparkSession.builder.getOrCreate()), sys.argv[1]),
        targets=tuple(sys.argv[2:]) or TARGETS,
    )
