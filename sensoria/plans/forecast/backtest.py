"""Rolling-origin backtest: models are ranked on the task they will be given."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensoria.plans.forecast.models import Model
from sensoria.session import cut_lineage

ORIGINS = 3
FOLD_DOMAIN = ("gas", "fold")


def _origins(per_gas: DataFrame, horizon_days: int, origins: int) -> DataFrame:
    """Fold number with the first and last test day, per gas."""
    numbered = per_gas.withColumn(
        "fold", F.explode(F.sequence(F.lit(0), F.lit(origins - 1)))
    )
    end = F.date_sub(F.col("fin"), F.col("fold") * horizon_days)
    return numbered.select(
        "gas", "fold", F.date_sub(end, horizon_days - 1).alias("ini_test"), end.alias("fin_test")
    )


def usable_folds(
    train: DataFrame, horizon_days: int, origins: int = ORIGINS
) -> DataFrame:
    """Folds with a test window and at least H earlier days, up to the first gap.

    Works on the distinct days per gas, a table as small as the calendar.
    """
    days = train.select("gas", "fecha").distinct()
    ends = days.groupBy("gas").agg(F.max("fecha").alias("fin"))
    windows = _origins(ends, horizon_days, origins)
    in_test = F.col("fecha").between(F.col("ini_test"), F.col("fin_test"))
    counted = (
        days.join(F.broadcast(windows), "gas")
        .groupBy("gas", "fold", "ini_test", "fin_test")
        .agg(
            F.count_if(in_test).alias("n_test"),
            F.count_if(F.col("fecha") < F.col("ini_test")).alias("n_train"),
        )
    )
    valid = (F.col("n_test") > 0) & (F.col("n_train") >= horizon_days)
    in_order = Window.partitionBy("gas").orderBy("fold")
    chained = counted.withColumn("ok", F.min(valid.cast("int")).over(in_order))
    return chained.filter(F.col("ok") == 1).select(
        "gas", "fold", "ini_test", "fin_test", "n_train", "n_test"
    )


def fold_rows(train: DataFrame, folds: DataFrame) -> DataFrame:
    """Training rows repeated per fold with their role ``train`` or ``test``."""
    role = F.when(F.col("fecha") < F.col("ini_test"), "train").when(
        F.col("fecha") <= F.col("fin_test"), "test"
    )
    return (
        train.join(
            F.broadcast(folds.select("gas", "fold", "ini_test", "fin_test")), "gas"
        )
        .withColumn("rol", role)
        .filter(F.col("rol").isNotNull())
        .drop("ini_test", "fin_test")
    )


def backtest_predictions(rows: DataFrame, models: Mapping[str, Model]) -> DataFrame:
    """Predictions of every model on every test window, next to the real value."""
    train = rows.filter(F.col("rol") == "train").drop("rol")
    test = rows.filter(F.col("rol") == "test").drop("rol")
    actual = test.select(*FOLD_DOMAIN, "estacion", "cod_dis", "fecha", "dato")
    predictions = None
    for name, model in models.items():
        part = model(train, test.drop("dato"), FOLD_DOMAIN).withColumn(
            "modelo", F.lit(name)
        )
        predictions = part if predictions is None else predictions.unionByName(part)
    # stations outside every district have no cod_dis; they count like all others
    predictions = predictions.drop("cod_dis")
    return actual.join(predictions, [*FOLD_DOMAIN, "estacion", "fecha"]).select(
        "gas", "modelo", "fold", "estacion", "cod_dis", "fecha", "dato", "yhat"
    )


def error_metrics(predictions: DataFrame, by: list[str]) -> DataFrame:
    """MAE and RMSE per group."""
    error = F.col("dato") - F.col("yhat")
    return predictions.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse")
    )


def rank_models(predictions: DataFrame) -> DataFrame:
    """Mean errors over the folds, best RMSE first within each gas."""
    per_fold = error_metrics(predictions, ["gas", "modelo", "fold"])
    scored = per_fold.groupBy("gas", "modelo").agg(
        F.avg("mae").alias("mae"),
        F.avg("rmse").alias("rmse"),
        F.count(F.lit(1)).alias("origenes"),
    )
    best_first = Window.partitionBy("gas").orderBy("rmse", "modelo")
    return scored.withColumn("puesto", F.row_number().over(best_first))


def backtest(
    train: DataFrame,
    horizon_days: int,
    models: Mapping[str, Model],
    origins: int = ORIGINS,
) -> DataFrame:
    """Ranking (gas, modelo, mae, rmse, origenes, puesto).

    The folds (at most ``origins`` rows per gas) are fixed first, so that the model
    plans do not each derive them again.
    """
    folds = cut_lineage(usable_folds(train, horizon_days, origins))
    rows = fold_rows(train, folds)
    return rank_models(backtest_predictions(rows, models))
