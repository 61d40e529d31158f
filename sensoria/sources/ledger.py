"""Load ledger and the grid of periods still to be loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert_entries(
    ledger: DataFrame, entries: DataFrame, key: str | Sequence[str] | None,
    order: str | None = None,
) -> DataFrame:
    """Ledger with the entries added; an entry replaces older ones of its period.

    Of several entries of one period in the batch the last by ``order`` stays, a column that
    the ledger need not have; without it, the greatest by all columns.

    Snapshot datasets have no period (``key=None``): their newest entries replace
    everything.
    """
    if key is None:
        return entries.select(*ledger.columns)
    keys = [key] if isinstance(key, str) else list(key)
    columns = F.struct(*([order] if order else []), *[c for c in ledger.columns if c != order])
    entries = entries.groupBy(*keys).agg(F.max(columns).alias("_last")).select("_last.*")
    kept = ledger.join(entries.select(*keys), keys, "left_anti")
    return kept.select(*ledger.columns).unionByName(entries.select(*ledger.columns))


def period_grid(
    spark: SparkSession,
    first_year: int,
    last_year: int,
    monthly: Sequence[str] = ("trafico", "trafico_puntos_medida"),
    yearly: Sequence[str] = ("aire",),
) -> DataFrame:
    """Every (dataset, periodo) of a backfill; yearly datasets have no month."""
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("anio"))

    def named(datasets: Sequence[str]):
        return F.explode(F.array(*[F.lit(name) for name in datasets])).alias("dataset")

    months = years.select(named(monthly), "anio").select(
        "dataset", "anio", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mes")
    )
    by_month = months.select(
        "dataset",
        F.concat_ws(
            "-", F.col("anio").cast("string"), F.lpad(F.col("mes").cast("string"), 2, "0")
        ).alias("periodo"),
    )
    by_year = years.select(named(yearly), F.col("anio").cast("string").alias("periodo"))
    return by_month.unionByName(by_year)


def missing_periods(grid: DataFrame, ledger: DataFrame) -> DataFrame:
    """Periods of the grid the ledger does not list yet."""
    return grid.join(ledger.select("dataset", "periodo"), ["dataset", "periodo"], "left_anti")
