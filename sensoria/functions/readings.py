"""Plausibility of single readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensoria.catalogs import LATITUDE_RANGE, LONGITUDE_RANGE


def no_sentinel(value: Column, cap: float | None = None) -> Column:
    """NULL for "no data" marks: negatives, NaN and values above the cap."""
    missing = (value < 0) | F.isnan(value)
    if cap is not None:
        missing = missing | (value > cap)
    return F.when(missing, None).otherwise(value)


def inside_box(latitude: Column, longitude: Column) -> Column:
    """Whether a position lies in the region's bounding box, edges included."""
    return latitude.between(*LATITUDE_RANGE) & longitude.between(*LONGITUDE_RANGE)
