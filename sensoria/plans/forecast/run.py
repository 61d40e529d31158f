"""Forecast job: features, backtest, winner, prediction table, metrics.

Run with ``spark-submit`` (or ``python -m sensoria.plans.forecast.run``) and the lake's
root folder, the number of months and the gases: ``<root> 2 NO2,O3``.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensoria.catalogs import MAX_FORECAST_MONTHS
from sensoria.functions.codes import run_name
from sensoria.functions.dates import months_ahead_in_days
from sensoria.plans.forecast.backtest import backtest
from sensoria.plans.forecast.features import (
    feature_table,
    future_rows,
    history,
    history_bounds,
    require_no_leak,
    train_rows,
)
from sensoria.plans.forecast.models import MODELS, Model
from sensoria.session import configure, cut_lineage, staging
from sensoria.sources.tables import Lakehouse


def checked_months(months: int | str) -> int:
    months = int(months)
    if not 1 <= months <= MAX_FORECAST_MONTHS:
        raise ValueError(f"months must be within 1 and {MAX_FORECAST_MONTHS}: {months}")
    return months


def horizons(hist: DataFrame, months: int) -> DataFrame:
    """Last real day and horizon in days per gas."""
    return history_bounds(hist).select(
        "gas",
        F.col("f1").alias("ultima_fecha_real"),
        months_ahead_in_days(F.col("f1"), months).alias("horizonte_dias"),
    )


def winners(ranking: DataFrame) -> DataFrame:
    return ranking.filter(F.col("puesto") == 1).select("gas", "modelo")


def forecast_table(
    predictions: DataFrame, chosen: DataFrame, gases: DataFrame
) -> DataFrame:
    """Published forecast rows of the winning model of each gas.

    ``predictions`` holds (gas, modelo, estacion, cod_dis, fecha, yhat).
    """
    return (
        predictions.join(F.broadcast(chosen), ["gas", "modelo"])
        .join(F.broadcast(gases), F.col("gas") == F.col("MAGNITUD"))
        .select(
            "gas",
            F.col("fecha").alias("FECHA"),
            F.col("estacion").alias("ID_AIRE"),
            F.col("cod_dis").alias("COD_DIS"),
            "ID_MAGNITUD",
            F.col("yhat").alias("VALOR_PREDICHO"),
            F.col("modelo").alias("MODELO"),
        )
    )


def metrics_rows(ranking: DataFrame, last_days: DataFrame, months: int) -> DataFrame:
    """One metrics row per gas with the ranked comparison as an array.

    The array has one entry per registered model.
    """
    entry = F.struct("puesto", "modelo", "mae", "rmse", "origenes")
    ranked = ranking.groupBy("gas").agg(
        F.array_sort(F.collect_list(entry)).alias("_ranked")
    )
    plain = F.transform(
        "_ranked",
        lambda e: F.struct(
            e.modelo.alias("modelo"),
            e.mae.alias("mae"),
            e.rmse.alias("rmse"),
            e.origenes.alias("origenes"),
        ),
    )
    return ranked.join(last_days, "gas").select(
        "gas",
        F.lit(months).alias("horizonte_meses"),
        F.col("ultima_fecha_real").cast("string").alias("ultima_fecha_real"),
        F.col("_ranked")[0]["modelo"].alias("ganador"),
        plain.alias("comparativa"),
    )


def run_forecast(
    fact: DataFrame,
    gases: DataFrame,
    names: list[str],
    months: int,
    models: Mapping[str, Model] = MODELS,
) -> tuple[DataFrame, DataFrame]:
    """(forecast rows, metrics rows) for several gases.

    Gases that end on the same day share one horizon and run as one job.  Only the
    horizon and the winner of each gas come back to the driver.
    """
    months = checked_months(months)
    hist = history(fact, gases, names)
    last_days = cut_lineage(horizons(hist, months))
    ends = {row["gas"]: row["horizonte_dias"] for row in last_days.toLocalIterator()}
    missing = sorted(set(names) - set(ends))
    if missing:
        raise ValueError(f"no readings of {missing} in the fact table")

    forecasts, rankings = None, None
    for horizon in sorted(set(ends.values())):
        group = sorted(gas for gas, days in ends.items() if days == horizon)
        own = hist.filter(F.col("gas").isin(group))
        features = cut_lineage(feature_table(own, horizon))
        train, future = train_rows(features), future_rows(features)
        require_no_leak(future, own, horizon)

        ranking = cut_lineage(backtest(train, horizon, models))
        chosen = {row["gas"]: row["modelo"] for row in winners(ranking).toLocalIterator()}
        unranked = sorted(set(group) - set(chosen))
        if unranked:
            raise ValueError(f"not enough history for a single origin: {unranked}")

        for name in sorted(set(chosen.values())):
            won = [gas for gas, model in chosen.items() if model == name]
            mine = F.col("gas").isin(won)
            part = models[name](train.filter(mine), future.filter(mine), ("gas",))
            part = part.withColumn("modelo", F.lit(name))
            forecasts = part if forecasts is None else forecasts.unionByName(part)
        rankings = ranking if rankings is None else rankings.unionByName(ranking)

    published = forecast_table(forecasts, winners(rankings), gases)
    return published, metrics_rows(rankings, last_days, months)


def write_forecast(
    published: DataFrame, metrics: DataFrame, months: int, folder: str
) -> None:
    """Write predictions per run and the metrics; a rerun replaces its own run."""
    named = published.withColumn("run", run_name(F.col("gas"), F.lit(months))).drop("gas")
    (
        named.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .parquet(f"{folder}/predictions")
    )
    (
        metrics.withColumn("run", run_name(F.col("gas"), F.lit(months)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .json(f"{folder}/metrics")
    )


def main(root: str, months: str = "2", names: str = "NO2,O3") -> None:
    lake = Lakehouse(configure(SparkSession.builder.getOrCreate()), root)
    gases = [name.strip() for name in names.split(",") if name.strip()]
    with staging(lake.spark):
        published, metrics = run_forecast(
            lake.gold("fact_calidad_aire"), lake.gold("dim_magnitud"), gases, checked_months(months)
        )
        write_forecast(published, metrics, checked_months(months), lake.path("gold", "ml"))


if __name__ == "__main__":
    main(*sys.argv[1:])
