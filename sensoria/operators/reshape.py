"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.catalogs import GAS_LABELS, TRAFFIC_VARIABLES
from sensoria.functions.codes import label_of
from sensoria.functions.dates import calendar_day, day_exists
from sensoria.operators.cleaning import valid_only

DAYS = range(1, 32)


def days_to_rows(wide: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per real calendar day out of the ``D01..D31``/``V01..V31`` columns.

    A single pass over the file: every wide row is expanded in place, then the
    padding days that the month does not have are dropped.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(day).alias("dia"),
                F.col(f"D{day:02d}").cast("double").alias("DATO"),
                F.col(f"V{day:02d}").alias("VALIDEZ"),
            )
            for day in DAYS
        ]
    )
    exploded = wide.select(*keys, "ANO", "MES", F.inline(cells))
    return exploded.filter(day_exists(F.col("ANO"), F.col("MES"), F.col("dia"))).select(
        *keys,
        calendar_day(F.col("ANO"), F.col("MES"), F.col("dia")).alias("FECHA"),
        "DATO",
        "VALIDEZ",
    )


def unpivot_air(
    bronze: DataFrame, labels: Mapping[int, str] = GAS_LABELS
) -> DataFrame:
    """Silver air readings of the wide bronze table."""
    long = valid_only(days_to_rows(bronze, ["ESTACION", "MAGNITUD"]))
    return long.select(
        F.col("ESTACION").alias("ID_AIRE"),
        label_of(F.col("MAGNITUD"), labels).alias("MAGNITUD"),
        "FECHA",
        "DATO",
        "VALIDEZ",
    ).distinct()


def rows_to_days(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Wide month rows of daily values (FECHA, DATO, VALIDEZ).

    Days without a reading are padded with 0.0 and 'N', as the source does.
    Partial aggregation over 62 plain columns: no group is held in memory.
    """
    day = F.dayofmonth("FECHA")
    cells = []
    for number in DAYS:
        on_day = day == number
        cells.append(
            F.coalesce(F.max(F.when(on_day, F.col("DATO"))), F.lit(0.0)).alias(
                f"D{number:02d}"
            )
        )
        cells.append(
            F.coalesce(F.max(F.when(on_day, F.col("VALIDEZ"))), F.lit("N")).alias(
                f"V{number:02d}"
            )
        )
    return long.groupBy(
        *keys, F.year("FECHA").alias("ANO"), F.month("FECHA").alias("MES")
    ).agg(*cells)


def measures_to_rows(
    daily: DataFrame, keys: Sequence[str], measures: Sequence[str] = TRAFFIC_VARIABLES
) -> DataFrame:
    """One (MEDIDA, VALOR) row per measure that has a value."""
    return daily.unpivot(list(keys), list(measures), "MEDIDA", "VALOR").filter(
        F.col("VALOR").isNotNull()
    )
