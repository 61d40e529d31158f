"""What there is to select from, kept by the loads: one row per sensor, variable and month.

The table has ``dataset, sensor, variable, filas, primer_dia, ultimo_dia`` and the month as
``anio, mes``, its partitions.  A load adds or replaces the rows of its months only, so it never
reads older readings; rows of the same month from different loads are merged by sums, least and
greatest days.  Selectors read this table in the place of the readings: :func:`selector_tables`
gives the first and the last day of every row back as readings without a value, and any query for
districts, variables, years, months or spans finds the same in them as in the readings.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.catalogs import TRAFFIC_VARIABLES
from sensoria.operators.cleaning import valid_only
from sensoria.plans.dashboard import SensorTables
from sensoria.session import cut_lineage, literal_table, staging
from sensoria.sources.tables import Lakehouse, clear_period, write_periods

TABLE = "cobertura"
AIR, TRAFFIC = "aire", "trafico"
#: Stands for a reading of any kind, with values or without.
ANY = "*"
PERIOD = ("dataset", "anio", "mes")
KEY = ("dataset", "sensor", "variable", "anio", "mes")
COLUMNS = "sensor bigint, variable string, filas bigint, primer_dia date, ultimo_dia date"


def _month() -> list:
    return [F.year("FECHA").alias("anio"), F.month("FECHA").alias("mes")]


def air_coverage(air: DataFrame) -> DataFrame:
    """Coverage of silver air readings: valid ones by gas."""
    day = F.col("FECHA").cast("date")
    counted = valid_only(air).groupBy(
        F.col("ID_AIRE").cast("bigint").alias("sensor"), F.col("MAGNITUD").alias("variable"), *_month()
    ).agg(F.count(F.lit(1)).alias("filas"), F.min(day).alias("primer_dia"), F.max(day).alias("ultimo_dia"))
    return counted.withColumn("dataset", F.lit(AIR))


def traffic_coverage(traffic: DataFrame) -> DataFrame:
    """Coverage of silver traffic readings by variable, and of all readings as ``*``; one scan."""
    day = F.col("FECHA").cast("date")
    cells = {ANY: F.lit(True)} | {name: F.col(name).isNotNull() for name in TRAFFIC_VARIABLES}
    sums = [
        F.struct(
            F.lit(name).alias("variable"), F.count_if(there).alias("filas"),
            F.min(F.when(there, day)).alias("primer_dia"), F.max(F.when(there, day)).alias("ultimo_dia"),
        )
        for name, there in cells.items()
    ]
    sensor = F.col("ID_TRAFICO").cast("bigint").alias("sensor")
    counted = traffic.groupBy(sensor, *_month()).agg(F.array(*sums).alias("celdas"))
    return (
        counted.select("sensor", "anio", "mes", F.inline("celdas")).where("filas > 0")
        .withColumn("dataset", F.lit(TRAFFIC))
    )


def merged(parts: Iterable[DataFrame]) -> DataFrame:
    """One table from those of several loads."""
    whole = None
    for part in parts:
        whole = part if whole is None else whole.unionByName(part)
    return whole.groupBy(*KEY).agg(
        F.sum("filas").alias("filas"), F.min("primer_dia").alias("primer_dia"), F.max("ultimo_dia").alias("ultimo_dia")
    )


def read(lake: Lakehouse) -> DataFrame:
    schema = f"{COLUMNS}, dataset string, anio int, mes int"
    return lake.spark.read.schema(schema).parquet(lake.path("gold", TABLE))


def replace_months(lake: Lakehouse, dataset: str, readings: DataFrame, months: Iterable[tuple[int, int]]) -> None:
    """Bring the coverage of these months up to date with their readings, all of them.

    The months limit the scan of ``readings`` by day ranges; a month without readings is emptied.
    """
    months = sorted(set(months))
    path = lake.path("gold", TABLE)
    wanted = F.lit(False)
    for year, month in months:
        start = F.make_date(F.lit(year), F.lit(month), F.lit(1))
        wanted = wanted | ((F.col("FECHA") >= start) & (F.col("FECHA") < F.add_months(start, 1)))
    with staging(lake.spark):
        found = cut_lineage(coverage_of(dataset, readings.where(wanted)))
        write_periods(found, path, PERIOD)
        given = literal_table(lake.spark, months, "anio int, mes int")
        for row in given.join(found, ["anio", "mes"], "left_anti").collect():
            clear_period(lake.spark, path, {"dataset": dataset, **row.asDict()})


def add_load(lake: Lakehouse, dataset: str, readings: DataFrame) -> None:
    """Merge the readings of one load, which are new, into the table."""
    path = lake.path("gold", TABLE)
    with staging(lake.spark):
        new = cut_lineage(coverage_of(dataset, readings))
        months = new.select(*PERIOD).distinct()
        old = read(lake).join(months, list(PERIOD), "left_semi")
        write_periods(cut_lineage(merged([old, new])), path, PERIOD)


def rebuild(lake: Lakehouse) -> None:
    """The table from all readings."""
    air, traffic = air_coverage(lake.silver("aire")), traffic_coverage(lake.silver("trafico"))
    lake_table = merged([air, traffic])
    lake_table.hint("rebalance", *PERIOD).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy(*PERIOD).parquet(lake.path("gold", TABLE))


def coverage_of(dataset: str, readings: DataFrame) -> DataFrame:
    if dataset not in (AIR, TRAFFIC):
        raise ValueError(f"no coverage of {dataset!r}")
    return air_coverage(readings) if dataset == AIR else traffic_coverage(readings)


def _days(coverage: DataFrame, dataset: str) -> DataFrame:
    return coverage.where(F.col("dataset") == dataset).withColumn(
        "FECHA", F.explode(F.array_distinct(F.array("primer_dia", "ultimo_dia")))
    )


def selector_tables(
    coverage: DataFrame, stations: DataFrame, points: DataFrame, districts: DataFrame
) -> SensorTables:
    """Tables for the selectors of the dashboard; no reading is scanned behind them."""
    air = _days(coverage, AIR).select(
        F.col("sensor").alias("ID_AIRE"), F.col("variable").alias("MAGNITUD"), "FECHA",
        F.lit(None).cast("double").alias("DATO"), F.lit("V").alias("VALIDEZ"),
    )
    traffic = _days(coverage, TRAFFIC).select(
        F.col("sensor").alias("ID_TRAFICO"), "FECHA",
        *[F.when(F.col("variable") == name, F.lit(0.0)).alias(name) for name in TRAFFIC_VARIABLES],
    )
    return SensorTables(air, stations, traffic, points, districts)
