"""Bronze to silver: names, sentinels, completeness, duplicates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.catalogs import INTENSITY_CAP, TRAFFIC_RENAMES, TRAFFIC_VARIABLES
from sensoria.functions.readings import inside_box, no_sentinel


def rename_uppercase(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Apply the rename map and uppercase every other column."""
    return df.withColumnsRenamed(
        {name: renames.get(name, name.upper()) for name in df.columns}
    )


def sentinels_to_null(traffic: DataFrame) -> DataFrame:
    """Replace "no data" marks of the four traffic measures by NULL."""
    caps = {"INTENSIDAD": INTENSITY_CAP}
    return traffic.withColumns(
        {
            name: no_sentinel(F.col(name), caps.get(name.upper()))
            for name in traffic.columns
            if name.upper() in TRAFFIC_VARIABLES
        }
    )


def drop_incomplete(traffic: DataFrame) -> DataFrame:
    """Keep rows with all four measures and no error mark."""
    return traffic.dropna(subset=list(TRAFFIC_VARIABLES)).filter(F.col("ERROR") == "N")


def clean_traffic(bronze: DataFrame) -> DataFrame:
    """Silver traffic of a bronze table; unknown extra columns pass through.

    Rows are filtered before the whole-row DISTINCT, so only survivors shuffle.
    DISTINCT is a partial aggregation: copies of a hot row collapse in the map
    tasks and never meet in one reducer.
    """
    silver = rename_uppercase(bronze, TRAFFIC_RENAMES)
    return drop_incomplete(sentinels_to_null(silver)).distinct()


def valid_only(readings: DataFrame) -> DataFrame:
    """Keep readings marked valid."""
    return readings.filter(F.col("VALIDEZ") == "V")


def inside_region(points: DataFrame) -> DataFrame:
    """Keep positions in the region's bounding box."""
    return points.filter(inside_box(F.col("LATITUD"), F.col("LONGITUD")))
