"""The three smoke tests on a synthetic series, and the edge cases around them."""

import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from sensoria.plans.forecast import backtest as bt
from sensoria.plans.forecast import features as ft
from sensoria.plans.forecast import models as md
from sensoria.plans.forecast import run as rn

LAST, HORIZON = date(2024, 6, 30), 30
FIRST = date(2023, 1, 1)
SCHEMA = "gas string, estacion bigint, cod_dis string, fecha date, dato double"


def series(station=1, gas="NO2", first=FIRST, last=LAST, skip=()):
    """A year's cycle plus a working-day effect."""
    result = []
    for i in range((last - first).days + 1):
        day = first + timedelta(days=i)
        if day not in skip:
            value = 30 + 10 * math.sin(2 * math.pi * i / 365) + 3 * (day.weekday() < 5)
            result.append((gas, station, "1", day, value))
    return result


@pytest.fixture(scope="module")
def hist(spark):
    return spark.createDataFrame(series(1) + series(2), SCHEMA).cache()


@pytest.fixture(scope="module")
def tables(hist):
    table = ft.feature_table(hist, HORIZON).cache()
    return ft.train_rows(table), ft.future_rows(table)


def test_registry():
    assert set(md.MODELS) == {
        "seasonal_naive", "gradient_boosting", "seasonal_ar", "seasonal_arma",
    }


def test_future_starts_after_the_last_reading(tables):
    train, future = tables
    assert train.agg(F.max("fecha")).first()[0] == LAST
    bounds = future.agg(F.min("fecha"), F.max("fecha")).first()
    assert tuple(bounds) == (LAST + timedelta(days=1), LAST + timedelta(days=HORIZON))
    assert "dato" not in future.columns


@pytest.mark.parametrize(
    "name, model",
    [
        ("seasonal_naive", md.seasonal_naive),
        ("seasonal_ar", md.seasonal_ar),
        ("seasonal_arma", md.seasonal_arma),
        ("gradient_boosting", md.gradient_boosting(rounds=5)),
    ],
)
def test_one_finite_prediction_per_row(tables, name, model):
    train, future = tables
    predicted = model(train, future, ("gas",)).collect()
    assert len(predicted) == future.count() == 2 * HORIZON
    assert all(row.yhat is not None and math.isfinite(row.yhat) for row in predicted)


def test_lags_mean_days_even_with_gaps(spark):
    gap = {LAST - timedelta(days=n) for n in (3, 10, 33)}
    hist = spark.createDataFrame(series(1, skip=gap), SCHEMA)
    value = {row[3]: row[4] for row in series(1)}
    for row in ft.feature_table(hist, HORIZON).collect():
        for offset in ft.LAG_OFFSETS:
            day = row.fecha - timedelta(days=HORIZON + offset)
            assert day not in gap
            assert row[f"lag_{offset}"] == pytest.approx(value[day])
        window = [
            value[day]
            for day in (row.fecha - timedelta(days=HORIZON + n) for n in range(31))
            if day in value and day not in gap
        ]
        assert row.roll_mean == pytest.approx(sum(window) / len(window))
    future = {r.fecha for r in ft.future_rows(ft.feature_table(hist, HORIZON)).collect()}
    for missing in (3, 10):
        assert LAST - timedelta(days=missing) + timedelta(days=HORIZON) not in future


def test_repeated_readings_of_a_day_are_one_row(spark, tables):
    twice = spark.createDataFrame(series(1) + series(1) + series(2), SCHEMA)
    assert ft.feature_table(twice, HORIZON).count() == sum(t.count() for t in tables)


def test_leak_guard(hist, tables):
    _, future = tables
    ft.require_no_leak(future, hist, HORIZON)
    late = future.withColumn("fecha", F.date_add("fecha", 1))
    with pytest.raises(AssertionError):
        ft.require_no_leak(late, hist, HORIZON)


def test_naive_is_the_mean_of_the_last_four_weekdays(tables):
    train, future = tables
    known = {r.fecha: r.dato for r in train.filter("estacion = 1").collect()}
    for row in md.seasonal_naive(train, future, ("gas",)).filter("estacion = 1").collect():
        same = sorted(d for d in known if d.weekday() == row.fecha.weekday())[-4:]
        assert row.yhat == pytest.approx(sum(known[d] for d in same) / 4)


def test_naive_falls_back_to_the_overall_mean(tables):
    train, future = tables
    unknown = future.withColumn("estacion", F.lit(99).cast("long"))
    mean = train.agg(F.avg("dato")).first()[0]
    found = md.seasonal_naive(train, unknown, ("gas",)).select("yhat").distinct().collect()
    assert [r.yhat for r in found] == [pytest.approx(mean)]


def test_ar_repeats_a_purely_weekly_series(spark):
    rows = [
        ("O3", 1, "1", FIRST + timedelta(days=i), float((FIRST + timedelta(days=i)).weekday()))
        for i in range(200)
    ]
    table = ft.feature_table(spark.createDataFrame(rows, SCHEMA), 14)
    found = md.seasonal_ar(ft.train_rows(table), ft.future_rows(table), ("gas",)).collect()
    assert len(found) == 14
    for row in found:
        assert row.yhat == pytest.approx(float(row.fecha.weekday()))


def test_ar_uses_the_mean_of_short_series_and_stays_in_bounds(tables):
    train, future = tables
    short = train.filter(
        (F.col("estacion") == 2) | (F.col("fecha") > F.lit(LAST - timedelta(days=40)))
    )
    mean = short.filter("estacion = 1").agg(F.avg("dato")).first()[0]
    top = short.filter("estacion = 2").agg(F.max("dato")).first()[0]
    found = md.seasonal_ar(short, future, ("gas",)).collect()
    assert {round(r.yhat, 9) for r in found if r.estacion == 1} == {round(mean, 9)}
    assert all(0 <= r.yhat <= 2 * top for r in found if r.estacion == 2)


def test_boosting_beats_the_overall_mean(tables):
    train, _ = tables
    cut = LAST - timedelta(days=HORIZON)
    past, recent = train.filter(F.col("fecha") <= cut), train.filter(F.col("fecha") > cut)
    model = md.gradient_boosting(rounds=20, step=0.3)
    scored = model(past, recent.drop("dato"), ("gas",)).join(
        recent.select("estacion", "fecha", "dato"), ["estacion", "fecha"]
    )
    mean = past.agg(F.avg("dato")).first()[0]
    model_error, mean_error = scored.agg(
        F.avg(F.abs(F.col("dato") - F.col("yhat"))), F.avg(F.abs(F.col("dato") - mean))
    ).first()
    assert model_error < mean_error


def test_folds_stop_when_history_runs_out(spark):
    first = LAST - timedelta(days=149)
    table = ft.feature_table(spark.createDataFrame(series(1, first=first), SCHEMA), HORIZON)
    train = ft.train_rows(table)
    assert train.count() == 90
    folds = bt.usable_folds(train, HORIZON).orderBy("fold").collect()
    assert [(f.fold, f.n_train, f.n_test) for f in folds] == [(0, 60, 30), (1, 30, 30)]


def test_run_picks_one_winner_per_gas(spark, tmp_path):
    from sensoria.catalogs import gas_table
    from sensoria.plans import dashboard
    from sensoria.sources.metrics import read_metrics

    late = LAST + timedelta(days=31)
    fact = spark.createDataFrame(
        [(8, 1, "01", r[3], r[4]) for r in series(1)]
        + [(14, 1, "01", r[3], r[4] + 5) for r in series(1, last=late)],
        "ID_MAGNITUD int, ID_AIRE bigint, COD_DIS string, FECHA date, DATO double",
    )
    models = {"seasonal_naive": md.seasonal_naive, "seasonal_ar": md.seasonal_ar}
    published, metrics = rn.run_forecast(fact, gas_table(spark), ["NO2", "O3"], 1, models)
    folder = str(tmp_path / "ml")
    for _ in range(2):
        rn.write_forecast(published, metrics, 1, folder)
    written = spark.read.parquet(f"{folder}/predictions")
    assert sorted(written.columns) == sorted(
        ["FECHA", "ID_AIRE", "COD_DIS", "ID_MAGNITUD", "VALOR_PREDICHO", "MODELO", "run"]
    )
    counts = {r.run: r.n for r in written.groupBy("run").agg(F.count("*").alias("n")).collect()}
    assert counts == {"pred_NO2_1m": 30, "pred_O3_1m": 31}
    stored = read_metrics(spark, f"{folder}/metrics")
    assert {r.gas: len(r.comparativa) for r in stored.collect()} == {"NO2": 2, "O3": 2}
    table = dashboard.metrics_table(stored).filter("es_ganador").collect()
    assert len(table) == 2
    assert [r.ID_AIRE for r in dashboard.forecast_stations(written, "O3").collect()] == [1]

    parts = dashboard.prediction_view(fact, gas_table(spark), written, stored, "O3", 1)
    assert [(r.gas, r.meses) for r in parts["gases"].collect()] == [("NO2", 1), ("O3", 1)]
    kinds = [r.kind for r in parts["serie"].collect()]
    assert kinds.count("predicho") == 31 and kinds.count("puente") == 1
    assert kinds.count("real") == fact.filter("ID_MAGNITUD = 14 AND ID_AIRE = 1").count()
    assert sorted(r.modelo for r in parts["metricas"].collect()) == sorted(models)
    absent = dashboard.prediction_view(fact, gas_table(spark), written, stored, "CO", 1)
    assert all(absent[part].isEmpty() for part in ("estaciones", "serie", "metricas"))


def test_run_refuses_bad_requests(spark, hist):
    from sensoria.catalogs import gas_table

    for months in (0, 13, "x"):
        with pytest.raises(ValueError):
            rn.checked_months(months)
    fact = hist.select(
        F.lit(8).alias("ID_MAGNITUD"), F.col("estacion").alias("ID_AIRE"),
        F.col("cod_dis").alias("COD_DIS"), F.col("fecha").alias("FECHA"),
        F.col("dato").alias("DATO"),
    )
    with pytest.raises(ValueError, match="O3"):
        rn.run_forecast(fact, gas_table(spark), ["O3"], 1)
    brief = fact.filter(F.col("FECHA") > F.lit(LAST - timedelta(days=100)))
    with pytest.raises(ValueError, match="origin"):
        rn.run_forecast(
            brief, gas_table(spark), ["NO2"], 1, {"seasonal_naive": md.seasonal_naive}
        )


def test_stations_outside_every_district_count_in_the_backtest(spark):
    from sensoria.plans.forecast.backtest import backtest_predictions
    from sensoria.plans.forecast.models import seasonal_naive

    days = spark.sql(
        "SELECT 'NO2' AS gas, 1L AS estacion, CAST(NULL AS STRING) AS cod_dis, "
        "explode(sequence(DATE'2024-01-01', DATE'2024-06-30')) AS fecha"
    ).selectExpr("*", "CAST(day(fecha) AS DOUBLE) AS dato", "0 AS fold", "weekday(fecha) AS dow")
    role = "CASE WHEN fecha < DATE'2024-06-01' THEN 'train' ELSE 'test' END AS rol"
    found = backtest_predictions(days.selectExpr("*", role), {"naive": seasonal_naive})
    assert found.count() == 30


def simulated(a, seasonal_a, m, seasonal_m, days, seed, gaps=0):
    """A (1,1,1)(1,1,1) series of period 7 about a level, with days missing."""
    import numpy as np

    chance = np.random.default_rng(seed)
    e = chance.normal(0, 1, days + 200)
    w = np.zeros(days + 200)
    for t in range(8, len(w)):
        w[t] = (
            a * w[t - 1] + seasonal_a * w[t - 7] - a * seasonal_a * w[t - 8]
            + e[t] + m * e[t - 1] + seasonal_m * e[t - 7] + m * seasonal_m * e[t - 8]
        )
    y = np.zeros(len(w))
    for t in range(8, len(w)):
        y[t] = w[t] + y[t - 1] + y[t - 7] - y[t - 8]
    y = y[200:]
    if gaps:
        y[chance.choice(np.arange(20, days - 20), gaps, replace=False)] = np.nan
    return y


@pytest.mark.parametrize(
    "truth, gaps", [((0.6, 0.2, 0.3, -0.6), 0), ((0.5, 0.1, 0.3, -0.5), 25), ((-0.4, 0.3, -0.5, -0.7), 0)]
)
def test_arma_recovers_the_coefficients(truth, gaps):
    from sensoria.plans.forecast import arma

    found = arma.fit(arma.differenced(simulated(*truth, 4000, 3, gaps)))
    assert found == pytest.approx(truth, abs=0.12)


def test_arma_forecasts_better_than_the_autoregression(spark):
    """Held-out error of both models on stations that do have moving averages."""
    import numpy as np

    rows = []
    for station in range(6):
        y = simulated(0.3, 0.1, -0.6, -0.8, 760, station)
        y = 500 + 100 * (y - y.min()) / (y.max() - y.min())
        rows += [
            ("O3", station, "1", FIRST + timedelta(days=i), float(v)) for i, v in enumerate(y)
        ]
    ends = FIRST + timedelta(days=745)
    table = spark.createDataFrame(rows, SCHEMA)
    train = table.filter(F.col("fecha") <= F.lit(ends))
    test = table.filter(F.col("fecha") > F.lit(ends))
    errors = {}
    for name in ("seasonal_ar", "seasonal_arma"):
        found = md.MODELS[name](train, test.drop("dato"), ("gas",))
        joined = found.join(test.drop("cod_dis"), ["gas", "estacion", "fecha"]).collect()
        assert len(joined) == 6 * 14
        errors[name] = np.sqrt(np.mean([(r.dato - r.yhat) ** 2 for r in joined]))
    assert errors["seasonal_arma"] < errors["seasonal_ar"]


def test_arma_fallbacks(spark, tables):
    from sensoria.plans.forecast import arma

    train, future = tables
    unknown = future.withColumn("estacion", F.lit(99).cast("long"))
    found = md.seasonal_arma(train, unknown, ("gas",)).select("yhat").distinct().collect()
    assert found[0].yhat == pytest.approx(train.agg(F.avg("dato")).first()[0])
    days = [LAST + timedelta(days=n) for n in range(1, 4)]
    assert list(arma.predict([FIRST, LAST], [1.0, 3.0], days, 60, 2.0)) == [2.0] * 3
    assert np_nan(arma.predict([], [], days, 60, 2.0))
    assert md.seasonal_arma(train.limit(0), future, ("gas",)).count() == 2 * HORIZON


def np_nan(values):
    return all(math.isnan(v) for v in values)
