"""Forecast models behind one contract.

A model is a function ``(train, future, domain) -> predictions``.  ``train`` holds
feature rows with ``dato``, ``future`` feature rows without; both carry the domain
columns, and the result has one row per row of ``future``: the domain, ``estacion``,
``cod_dis``, ``fecha`` and ``yhat``.

Tables with one row per domain are broadcast: there are as many as gases in the
catalogue times backtest folds.  Tables per station are left to the optimizer.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensoria.plans.forecast import boosting
from sensoria.plans.forecast.features import FEATURES

Model = Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame]

# Occurrences of a weekday the naive model averages; observations
# the autoregression needs; ceiling of its forecasts as a multiple of the
# station's maximum; settings of the boosted trees.
NAIVE_WINDOW = 4
MIN_OBSERVATIONS = 60
CEILING_FACTOR = 2.0
GBT_SETTINGS = {
    "rounds": 300,
    "depth": 5,
    "step": 0.05,
    "sample": 0.8,
    "seed": 42,
}

WEEK = 7
PERSISTENCE_LIMIT = 0.99


def _keys(domain: Sequence[str]) -> list[str]:
    return [*domain, "estacion", "cod_dis", "fecha"]


def last_n_mean(
    rows: DataFrame, groups: Sequence[str], order: str, value: str, n: int, name: str
) -> DataFrame:
    """Mean of the last ``n`` rows of each group.

    Spark applies the rank limit before the shuffle, so each map task passes on at
    most ``n`` rows per group.
    """
    latest_first = Window.partitionBy(*groups).orderBy(F.col(order).desc())
    ranked = rows.withColumn("_rank", F.row_number().over(latest_first))
    kept = ranked.filter(F.col("_rank") <= n)
    return kept.groupBy(*groups).agg(F.avg(value).alias(name))


def seasonal_naive(
    train: DataFrame, future: DataFrame, domain: Sequence[str]
) -> DataFrame:
    """What the station usually reads on this weekday, else the overall mean."""
    table = last_n_mean(
        train, [*domain, "estacion", "dow"], "fecha", "dato", NAIVE_WINDOW, "_usual"
    )
    overall = train.groupBy(*domain).agg(F.avg("dato").alias("_overall"))
    return (
        future.join(table, [*domain, "estacion", "dow"], "left")
        .join(F.broadcast(overall), list(domain), "left")
        .select(*_keys(domain), F.coalesce("_usual", "_overall").alias("yhat"))
    )


def _station_states(train: DataFrame, domain: Sequence[str]) -> DataFrame:
    """Everything the autoregression knows per station, one row each.

    With y the daily series and w = (1 - B)(1 - B^7) y, the model is
    w[t] = phi w[t-1].  Gaps remove pairs from the estimate of phi; the last eight
    levels carry the last known value forward.
    """
    series = [*domain, "estacion"]
    spans = train.groupBy(*series).agg(F.min("fecha").alias("a"), F.max("fecha").alias("b"))
    calendar = spans.select(
        *series,
        F.explode(F.sequence("a", "b")).alias("fecha"),
        F.lit(None).cast("double").alias("dato"),
    )
    daily = (
        calendar.unionByName(train.select(*series, "fecha", "dato"))
        .groupBy(*series, "fecha")
        .agg(F.avg("dato").alias("y"))
    )
    by_day = Window.partitionBy(*series).orderBy("fecha")
    known = F.last("y", ignorenulls=True).over(
        by_day.rowsBetween(Window.unboundedPreceding, 0)
    )
    levels = daily.select(*series, "fecha", "y", known.alias("v"))

    def twice_differenced(name: str):
        def back(days: int):
            return F.lag(name, days).over(by_day)

        return F.col(name) - back(1) - back(WEEK) + back(WEEK + 1)

    moved = levels.select(
        *series,
        "fecha",
        "y",
        twice_differenced("y").alias("w"),
        twice_differenced("v").alias("w_known"),
        *[F.lag("v", days).over(by_day).alias(f"v{days}") for days in range(WEEK + 1)],
    )
    paired = moved.withColumn("w_before", F.lag("w").over(by_day))
    both = F.col("w").isNotNull() & F.col("w_before").isNotNull()
    recent = F.struct(
        F.col("w_known"), F.array(*[F.col(f"v{d}") for d in range(WEEK + 1)]).alias("v")
    )
    states = paired.groupBy(*series).agg(
        F.avg("y").alias("media"),
        F.max("y").alias("maximo"),
        F.count("y").alias("n"),
        F.max("fecha").alias("fin"),
        F.try_divide(
            F.sum(F.when(both, F.col("w") * F.col("w_before"))),
            F.sum(F.when(both, F.col("w_before") * F.col("w_before"))),
        ).alias("phi"),
        F.max_by(recent, "fecha").alias("ultimo"),
    )
    limited = F.greatest(
        F.lit(-PERSISTENCE_LIMIT), F.least(F.lit(PERSISTENCE_LIMIT), F.col("phi"))
    )
    return states.withColumn("phi", F.coalesce(limited, F.lit(0.0)))


def _path(last_levels, last_w, phi, steps):
    """Levels for 1..steps days after the end, as an array."""
    start = F.struct(
        F.array().cast("array<double>").alias("path"),
        last_levels.alias("recent"),
        F.coalesce(last_w, F.lit(0.0)).alias("w"),
    )

    def advance(state, _):
        w = state.w * phi
        level = w + state.recent[0] + state.recent[WEEK - 1] - state.recent[WEEK]
        return F.struct(
            F.concat(state.path, F.array(level)).alias("path"),
            F.concat(F.array(level), F.slice(state.recent, 1, WEEK)).alias("recent"),
            w.alias("w"),
        )

    days = F.when(steps > 0, F.sequence(F.lit(1), F.greatest(steps, F.lit(1))))
    return F.aggregate(days, start, advance, lambda state: state.path)


def seasonal_ar(
    train: DataFrame, future: DataFrame, domain: Sequence[str]
) -> DataFrame:
    """Weekly seasonal autoregression per station, in one plan for all stations.

    Stations with too few observations forecast their mean, forecasts stay within
    what the station can plausibly read, and unknown stations get the mean of the
    station means.
    """
    series = [*domain, "estacion"]
    reach = future.groupBy(*series).agg(F.max("fecha").alias("hasta"))
    steps = F.greatest(F.datediff("hasta", "fin"), F.lit(0))
    enough = (F.col("n") >= MIN_OBSERVATIONS) & F.col("ultimo.v")[WEEK].isNotNull()
    path = _path(F.col("ultimo.v"), F.col("ultimo.w_known"), F.col("phi"), steps)
    stations = (
        _station_states(train, domain)
        .join(reach, series)
        .select(
            *series,
            "fin",
            "media",
            (F.col("maximo") * CEILING_FACTOR).alias("_techo"),
            F.when(enough, path).alias("_niveles"),
        )
    )
    overall = (
        train.groupBy(*series)
        .agg(F.avg("dato").alias("_m"))
        .groupBy(*domain)
        .agg(F.avg("_m").alias("_overall"))
    )
    level = F.try_element_at("_niveles", F.datediff("fecha", "fin"))
    bounded = F.greatest(F.lit(0.0), F.least(level, F.col("_techo")))
    # greatest and least skip NULLs, so the bounds apply to existing levels only.
    fitted = F.when(level.isNotNull(), bounded)
    fallback = F.when(F.col("_niveles").isNull(), F.col("media"))
    return (
        future.join(stations, series, "left")
        .join(F.broadcast(overall), list(domain), "left")
        .select(*_keys(domain), F.coalesce(fitted, fallback, F.col("_overall")).alias("yhat"))
    )


def seasonal_arma(train: DataFrame, future: DataFrame, domain: Sequence[str]) -> DataFrame:
    """Seasonal autoregression with moving-average terms, (1,1,1)(1,1,1) of period 7.

    One task fits one station's daily series, whose length is the calendar.  Fallbacks and
    bounds are those of :func:`seasonal_ar`.
    """
    series = [*domain, "estacion"]
    days = train.groupBy(*series, "fecha").agg(F.avg("dato").alias("dato"))
    wanted = future.select(*series, "fecha").distinct()
    rows = days.withColumn("_ahead", F.lit(False)).unionByName(
        wanted.withColumns({"dato": F.lit(None).cast("double"), "_ahead": F.lit(True)})
    )
    kinds = dict(rows.dtypes)
    schema = ", ".join([*[f"{name} {kinds[name]}" for name in series], "fecha date, yhat double"])

    def forecast(table):
        from sensoria.plans.forecast import arma

        known, ahead = table[~table["_ahead"]], table[table["_ahead"]]
        values = arma.predict(
            known["fecha"], known["dato"], ahead["fecha"], MIN_OBSERVATIONS, CEILING_FACTOR
        )
        return ahead[[*series, "fecha"]].assign(yhat=values)

    fitted = rows.groupBy(*series).applyInPandas(forecast, schema)
    overall = (
        train.groupBy(*series)
        .agg(F.avg("dato").alias("_m"))
        .groupBy(*domain)
        .agg(F.avg("_m").alias("_overall"))
    )
    return (
        future.join(fitted, [*series, "fecha"], "left")
        .join(F.broadcast(overall), list(domain), "left")
        .select(*_keys(domain), F.coalesce("yhat", "_overall").alias("yhat"))
    )


def gradient_boosting(**overrides) -> Model:
    """Boosted trees over the legal features, fitted for all domains together."""
    settings = boosting.Settings(**{**GBT_SETTINGS, **overrides})

    def predict(train: DataFrame, future: DataFrame, domain: Sequence[str]) -> DataFrame:
        keys = _keys(domain)
        trees = boosting.fit(train, domain, FEATURES, "dato", keys, settings)
        return trees.predict(future, keys)

    return predict


MODELS: dict[str, Model] = {
    "seasonal_naive": seasonal_naive,
    "gradient_boosting": gradient_boosting(),
    "seasonal_ar": seasonal_ar,
    "seasonal_arma": seasonal_arma,
}
