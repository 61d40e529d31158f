"""Features, models, backtest, forecast table."""

from pyspark.sql import functions as F

from sensoria.catalogs import gas_table
from sensoria.checks.fixtures import HORIZON, Inputs
from sensoria.checks.of_star import fact_air
from sensoria.checks.registry import check
from sensoria.plans.forecast import backtest as bt
from sensoria.plans.forecast import features as ft
from sensoria.plans.forecast import models as md
from sensoria.plans.forecast import run as rn
from sensoria.session import cut_lineage

GAS = ("gas",)


def _features(inputs: Inputs, view: str = "v_hist_dense"):
    return ft.feature_table(inputs.view(view), HORIZON)


def _split(inputs: Inputs, view: str = "v_hist_dense"):
    """Train and future rows; the feature table is computed once for all uses."""
    table = cut_lineage(_features(inputs, view))
    return ft.train_rows(table), ft.future_rows(table)


def naive_sql(train: str, future: str, domain: str) -> str:
    """Mean of the last four equal weekdays per station, else the domain's mean."""
    keys = [name.strip() for name in domain.split(",")]
    on = " AND ".join(f"u.{k} = f.{k}" for k in keys)
    over = " AND ".join(f"o.{k} = f.{k}" for k in keys)
    named = ", ".join(f"f.{k}" for k in keys)
    return f"""
        SELECT {named}, f.estacion, f.cod_dis, f.fecha, COALESCE(u.usual, o.overall) AS yhat
        FROM {future} f
        LEFT JOIN (SELECT {domain}, estacion, dow, AVG(dato) AS usual FROM (
                     SELECT *, ROW_NUMBER() OVER (PARTITION BY {domain}, estacion, dow
                                                  ORDER BY fecha DESC) AS rn FROM {train})
                   WHERE rn <= 4 GROUP BY {domain}, estacion, dow) u
               ON {on} AND u.estacion = f.estacion AND u.dow = f.dow
        LEFT JOIN (SELECT {domain}, AVG(dato) AS overall FROM {train} GROUP BY {domain}) o
               ON {over}"""


def ar_ctes(train: str, future: str, domain: str, name: str = "ar") -> str:
    """Common table expressions ending in ``<name>_out``: the seasonal autoregression."""
    keys = [name.strip() for name in domain.split(",")] + ["estacion"]
    k = ", ".join(keys)

    def eq(a, b, names=keys):
        return " AND ".join(f"{a}.{n} = {b}.{n}" for n in names)

    ak = ", ".join(f"a.{n}" for n in keys)
    fk = ", ".join(f"f.{n}" for n in keys)
    sk = ", ".join(f"s.{n}" for n in keys)
    levels = ", ".join(f"LAG(v, {d}) OVER w AS v{d}" for d in range(1, 8))
    carried = ", ".join(f"s.v{d} AS l{d}" for d in range(0, 8))
    shifted = ", ".join(f"a.l{d - 1} AS l{d}" for d in range(1, 8))
    text = f"""
        ar_span AS (SELECT {k}, MIN(fecha) AS a, MAX(fecha) AS b FROM {train} GROUP BY {k}),
        ar_cal AS (SELECT {k}, CAST(UNNEST(generate_series(a, b, INTERVAL 1 DAY)) AS DATE)
                   AS fecha FROM ar_span),
        ar_y AS (SELECT c.*, t.dato AS y FROM ar_cal c LEFT JOIN {train} t
                 ON {eq('t', 'c')} AND t.fecha = c.fecha),
        ar_v AS (SELECT *, LAST_VALUE(y IGNORE NULLS) OVER (PARTITION BY {k} ORDER BY fecha
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM ar_y),
        ar_w AS (SELECT *, v AS v0, {levels},
                 y - LAG(y, 1) OVER w - LAG(y, 7) OVER w + LAG(y, 8) OVER w AS dw,
                 v - LAG(v, 1) OVER w - LAG(v, 7) OVER w + LAG(v, 8) OVER w AS dv
                 FROM ar_v WINDOW w AS (PARTITION BY {k} ORDER BY fecha)),
        ar_p AS (SELECT *, LAG(dw) OVER (PARTITION BY {k} ORDER BY fecha) AS pw FROM ar_w),
        ar_s AS (SELECT {k}, AVG(y) AS media, MAX(y) AS maximo, COUNT(y) AS n,
                 MAX(fecha) AS fin,
                 COALESCE(GREATEST(-0.99, LEAST(0.99,
                   SUM(CASE WHEN dw IS NOT NULL AND pw IS NOT NULL THEN dw * pw END)
                   / NULLIF(SUM(CASE WHEN dw IS NOT NULL AND pw IS NOT NULL THEN pw * pw END),
                            0))), 0) AS phi
                 FROM ar_p GROUP BY {k}),
        ar_last AS (SELECT p.*, s.media, s.maximo, s.n, s.fin, s.phi FROM ar_p p
                    JOIN ar_s s ON {eq('s', 'p')} AND s.fin = p.fecha),
        ar_reach AS (SELECT {k}, MAX(fecha) AS hasta FROM {future} GROUP BY {k}),
        ar_rec AS (
            SELECT {sk}, 0 AS paso, {carried}, COALESCE(s.dv, 0) AS w, s.phi, s.fin, s.maximo,
                   datediff('day', s.fin, r.hasta) AS pasos
            FROM ar_last s JOIN ar_reach r ON {eq('r', 's')}
            WHERE s.n >= 60 AND s.v7 IS NOT NULL
            UNION ALL
            SELECT {ak}, a.paso + 1, a.w * a.phi + a.l0 + a.l6 - a.l7 AS l0, {shifted},
                   a.w * a.phi, a.phi, a.fin, a.maximo, a.pasos
            FROM ar_rec a WHERE a.paso < a.pasos),
        ar_fc AS (SELECT {k}, CAST(fin + paso AS DATE) AS fecha,
                  GREATEST(0, LEAST(l0, maximo * 2)) AS fitted FROM ar_rec WHERE paso > 0),
        ar_all AS (SELECT {", ".join(keys[:-1])}, AVG(media) AS overall FROM ar_s
                   GROUP BY {", ".join(keys[:-1])}),
        ar_out AS (SELECT {fk}, f.cod_dis, f.fecha, COALESCE(c.fitted,
                   CASE WHEN s.n < 60 OR s.v7 IS NULL THEN s.media END, o.overall) AS yhat
                   FROM {future} f
                   LEFT JOIN ar_fc c ON {eq('c', 'f')} AND c.fecha = f.fecha
                   LEFT JOIN ar_last s ON {eq('s', 'f')}
                   LEFT JOIN ar_all o ON {eq('o', 'f', keys[:-1])})"""
    return text.replace("ar_", f"{name}_")


def _feature_columns(prefix: str = "") -> str:
    return f"""gas, estacion, cod_dis, fecha, ROUND(dato, 6) AS dato, ROUND(lag_0, 6) AS lag_0,
        ROUND(lag_7, 6) AS lag_7, ROUND(lag_30, 6) AS lag_30, ROUND(roll_mean, 6) AS roll_mean,
        dow, mes, ROUND(doy_sin, 6) AS doy_sin, ROUND(doy_cos, 6) AS doy_cos, is_weekend"""


@check(
    "history",
    """SELECT CASE ID_MAGNITUD WHEN 8 THEN 'NO2' ELSE 'O3' END AS gas, ID_AIRE AS estacion,
              COD_DIS AS cod_dis, FECHA AS fecha, ROUND(DATO, 6) AS dato FROM v_fact_air
       WHERE ID_MAGNITUD IN (8, 14)""",
)
def _(inputs: Inputs):
    return ft.history(fact_air(inputs), gas_table(inputs.spark), ["NO2", "O3"])


_GRID = """
    g AS (SELECT e.gas, e.estacion, e.cod_dis, CAST(UNNEST(generate_series(b.f0,
              b.f1 + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS fecha
          FROM (SELECT DISTINCT gas, estacion, cod_dis FROM v_hist_gappy) e
          JOIN (SELECT gas, MIN(fecha) AS f0, MAX(fecha) AS f1 FROM v_hist_gappy GROUP BY gas) b
            ON b.gas = e.gas),
    s AS (SELECT g.*, h.dato FROM g LEFT JOIN v_hist_gappy h
          ON h.gas = g.gas AND h.estacion = g.estacion AND h.fecha = g.fecha)"""


@check(
    "densify_cross_join",
    f"""WITH {_GRID} SELECT gas, estacion, cod_dis, fecha, ROUND(dato, 6) AS dato FROM s""",
)
def _(inputs: Inputs):
    return ft.dense_series(inputs.view("v_hist_gappy"), HORIZON).drop("futuro")


@check(
    "legal_lags",
    f"""WITH {_GRID} SELECT gas, estacion, fecha,
               ROUND(LAG(dato, 30) OVER w, 6) AS lag_0, ROUND(LAG(dato, 37) OVER w, 6) AS lag_7,
               ROUND(LAG(dato, 60) OVER w, 6) AS lag_30
        FROM s WINDOW w AS (PARTITION BY gas, estacion ORDER BY fecha)""",
)
def _(inputs: Inputs):
    dense = ft.dense_series(inputs.view("v_hist_gappy"), HORIZON)
    return ft.add_features(dense, HORIZON).select(
        "gas", "estacion", "fecha", "lag_0", "lag_7", "lag_30"
    )


@check(
    "lagged_rolling_mean",
    f"""WITH {_GRID} SELECT gas, estacion, fecha,
               ROUND(AVG(dato) OVER (PARTITION BY gas, estacion ORDER BY fecha
                     ROWS BETWEEN 60 PRECEDING AND 30 PRECEDING), 6) AS roll_mean FROM s""",
)
def _(inputs: Inputs):
    dense = ft.dense_series(inputs.view("v_hist_gappy"), HORIZON)
    return ft.add_features(dense, HORIZON).select("gas", "estacion", "fecha", "roll_mean")


@check("feature_table", f"SELECT {_feature_columns()}, futuro FROM v_feat_gappy")
def _(inputs: Inputs):
    return _features(inputs, "v_hist_gappy")


@check("feature_table_dense", f"SELECT {_feature_columns()}, futuro FROM v_feat_dense")
def _(inputs: Inputs):
    return _features(inputs)


@check(
    "leak_guard",
    """SELECT gas, MAX(fecha) AS hasta, CAST(MAX(f1) AS DATE) AS ultima,
              CAST(MAX(fecha) - 30 AS DATE) > MAX(f1) AS fuga
       FROM v_feat_dense WHERE futuro GROUP BY gas""",
)
def _(inputs: Inputs):
    hist = inputs.view("v_hist_dense")
    _, future = _split(inputs)
    ft.require_no_leak(future, hist, HORIZON)
    furthest = future.groupBy("gas").agg(F.max("fecha").alias("hasta"))
    return furthest.join(ft.history_bounds(hist), "gas").select(
        "gas", "hasta", F.col("f1").alias("ultima"),
        (F.date_sub("hasta", HORIZON) > F.col("f1")).alias("fuga"),
    )


@check(
    "last_n_per_group",
    """SELECT gas, estacion, dow, ROUND(AVG(dato), 6) AS media FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY gas, estacion, dow ORDER BY fecha DESC) AS rn
         FROM v_feat_gappy WHERE NOT futuro) WHERE rn <= 4 GROUP BY 1, 2, 3""",
)
def _(inputs: Inputs):
    train, _future = _split(inputs, "v_hist_gappy")
    return md.last_n_mean(train, ["gas", "estacion", "dow"], "fecha", "dato", 4, "media")


_TRAIN = "(SELECT * FROM v_feat_dense WHERE NOT futuro)"
_FUTURE = "(SELECT * FROM v_feat_dense WHERE futuro)"
_TRAIN_GAPPY = "(SELECT * FROM v_feat_gappy WHERE NOT futuro)"
_FUTURE_GAPPY = "(SELECT * FROM v_feat_gappy WHERE futuro)"


@check(
    "seasonal_naive",
    "SELECT gas, estacion, cod_dis, fecha, ROUND(yhat, 6) AS yhat FROM ("
    + naive_sql(_TRAIN_GAPPY, _FUTURE_GAPPY, "gas")
    + ")",
)
def _(inputs: Inputs):
    train, future = _split(inputs, "v_hist_gappy")
    return md.seasonal_naive(train, future, GAS)


@check(
    "seasonal_ar",
    "WITH RECURSIVE "
    + ar_ctes(_TRAIN, _FUTURE, "gas")
    + " SELECT gas, estacion, cod_dis, fecha, ROUND(yhat, 6) AS yhat FROM ar_out",
)
def _(inputs: Inputs):
    train, future = _split(inputs)
    return md.seasonal_ar(train, future, GAS)


@check(
    "seasonal_arma",
    f"""SELECT gas, estacion, COUNT(*) AS filas, COUNT(*) AS en_rango, MIN(fecha) AS desde,
               MAX(fecha) AS hasta FROM {_FUTURE} GROUP BY gas, estacion""",
)
def _(inputs: Inputs):
    train, future = _split(inputs)
    most = train.groupBy("gas").agg(F.max("dato").alias("maximo"))
    predicted = md.seasonal_arma(train, future, GAS).join(most, "gas")
    return predicted.groupBy("gas", "estacion").agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(F.col("yhat").between(0, md.CEILING_FACTOR * F.col("maximo"))).alias("en_rango"),
        F.min("fecha").alias("desde"),
        F.max("fecha").alias("hasta"),
    )


_FINAL = -1


@check(
    "gbt_global",
    f"""SELECT gas, COUNT(*) AS filas, COUNT(*) AS finitas, COUNT(DISTINCT estacion) AS estaciones,
               MIN(fecha) AS desde, MAX(fecha) AS hasta, TRUE AS mejor_que_naive
        FROM {_FUTURE} GROUP BY gas""",
)
def _(inputs: Inputs):
    """All rounds, fitted for the forecast and the held-out folds of all gases in the same jobs."""
    train, future = _split(inputs)
    rows = bt.fold_rows(train, cut_lineage(bt.usable_folds(train, HORIZON)))
    past, test = (rows.filter(F.col("rol") == rol).drop("rol") for rol in ("train", "test"))
    both = past.unionByName(train.withColumn("fold", F.lit(_FINAL)))
    wanted = test.drop("dato").unionByName(future.withColumn("fold", F.lit(_FINAL)))
    predicted = cut_lineage(md.gradient_boosting()(both, wanted, bt.FOLD_DOMAIN))

    keys = [*bt.FOLD_DOMAIN, "estacion", "fecha"]
    naive = md.seasonal_naive(past, test.drop("dato"), bt.FOLD_DOMAIN)
    scores = None
    for name, part in (("boosted", predicted), ("naive", naive)):
        scored = test.select(*keys, "dato").join(part.select(*keys, "yhat"), keys)
        own = bt.error_metrics(scored, ["gas"]).select("gas", F.col("rmse").alias(name))
        scores = own if scores is None else scores.join(own, "gas")
    ahead = predicted.filter(F.col("fold") == _FINAL).groupBy("gas").agg(
        F.count(F.lit(1)).alias("filas"),
        F.count_if(F.abs("yhat") < float("inf")).alias("finitas"),
        F.countDistinct("estacion").alias("estaciones"),
        F.min("fecha").alias("desde"),
        F.max("fecha").alias("hasta"),
    )
    better = scores.select("gas", (F.col("boosted") < F.col("naive")).alias("mejor_que_naive"))
    return ahead.join(better, "gas")


_STUMP_BINS = 32


def _stump_sql() -> str:
    """The best single split of each gas by squared error, over quantiles of every feature."""
    long = " UNION ALL ".join(
        f"SELECT gas, {i} AS f, CAST({name} AS DOUBLE) AS x, dato FROM {_TRAIN}"
        for i, name in enumerate(ft.FEATURES)
    )
    shares = ", ".join(str(i / _STUMP_BINS) for i in range(1, _STUMP_BINS))
    value = " ".join(f"WHEN {i} THEN CAST(p.{name} AS DOUBLE)" for i, name in enumerate(ft.FEATURES))
    return f"""
        WITH long AS ({long}),
        edges AS (SELECT DISTINCT gas, f, UNNEST(quantile_disc(x, [{shares}])) AS e
                  FROM long GROUP BY gas, f),
        sides AS (SELECT gas, f, e, AVG(dato) FILTER (x <= e) AS below, AVG(dato) FILTER (x > e) AS above,
                         COUNT(*) FILTER (x <= e) AS n_below, COUNT(*) FILTER (x > e) AS n_above
                  FROM long JOIN edges USING (gas, f) GROUP BY gas, f, e),
        best AS (SELECT * FROM sides WHERE n_below > 0 AND n_above > 0
                 QUALIFY ROW_NUMBER() OVER (PARTITION BY gas ORDER BY ROUND(
                     (n_below * n_above) / (n_below + n_above) * (below - above) * (below - above), 4) DESC,
                     f, e) = 1)
        SELECT gas, p.estacion, p.fecha,
               ROUND(CASE WHEN (CASE f {value} END) <= e THEN below ELSE above END, 6) AS yhat
        FROM {_FUTURE} p JOIN best USING (gas)"""


@check("gbt_first_split", _stump_sql())
def _(inputs: Inputs):
    train, future = _split(inputs)
    stump = md.gradient_boosting(rounds=1, depth=1, step=1.0, sample=1.0, bins=_STUMP_BINS)
    return stump(train, future, GAS).select("gas", "estacion", "fecha", "yhat")


def folds_ctes(features: str) -> str:
    """Common table expressions ending in ``ftrain`` and ``ftest``: three test windows per gas."""
    return f"""
    tr AS (SELECT * FROM {features} WHERE NOT futuro),
    ends AS (SELECT gas, MAX(h) AS h, MAX(fecha) AS fin FROM tr GROUP BY gas),
    win AS (SELECT gas, h, CAST(k AS INTEGER) AS fold,
                   CAST(fin - CAST((k + 1) * h - 1 AS INTEGER) AS DATE) AS ini_test,
                   CAST(fin - CAST(k * h AS INTEGER) AS DATE) AS fin_test
            FROM ends, range(0, 3) r(k)),
    cnt AS (SELECT w.gas, w.h, w.fold, w.ini_test, w.fin_test,
                   COUNT(DISTINCT CASE WHEN t.fecha < w.ini_test THEN t.fecha END) AS n_train,
                   COUNT(DISTINCT CASE WHEN t.fecha BETWEEN w.ini_test AND w.fin_test
                                       THEN t.fecha END) AS n_test
            FROM win w JOIN tr t ON t.gas = w.gas GROUP BY 1, 2, 3, 4, 5),
    folds AS (SELECT c.* FROM cnt c WHERE NOT EXISTS (
                SELECT 1 FROM cnt d WHERE d.gas = c.gas AND d.fold <= c.fold
                AND (d.n_test = 0 OR d.n_train < d.h))),
    ftrain AS (SELECT t.*, f.fold FROM tr t JOIN folds f ON f.gas = t.gas
               WHERE t.fecha < f.ini_test),
    ftest AS (SELECT t.*, f.fold FROM tr t JOIN folds f ON f.gas = t.gas
              WHERE t.fecha BETWEEN f.ini_test AND f.fin_test)"""


@check(
    "rolling_origin_folds",
    f"""WITH {folds_ctes('v_feat_dense')} SELECT gas, fold, 'train' AS rol, COUNT(*) AS n, MIN(fecha) AS desde,
               MAX(fecha) AS hasta FROM ftrain GROUP BY 1, 2
        UNION ALL SELECT gas, fold, 'test', COUNT(*), MIN(fecha), MAX(fecha) FROM ftest
        GROUP BY 1, 2""",
)
def _(inputs: Inputs):
    train, _future = _split(inputs)
    rows = bt.fold_rows(train, bt.usable_folds(train, HORIZON))
    return rows.groupBy("gas", "fold", "rol").agg(
        F.count(F.lit(1)).alias("n"), F.min("fecha").alias("desde"), F.max("fecha").alias("hasta")
    )


def predicted_ctes(features: str) -> str:
    """Common table expressions ending in ``ranked``: errors of the models SQL can follow."""
    return f"""
    WITH RECURSIVE {folds_ctes(features)}, {ar_ctes('ftrain', 'ftest', 'gas, fold')},
    nv AS ({naive_sql('ftrain', 'ftest', 'gas, fold')}),
    pred AS (SELECT 'seasonal_naive' AS modelo, gas, fold, estacion, fecha, yhat FROM nv
             UNION ALL SELECT 'seasonal_ar', gas, fold, estacion, fecha, yhat FROM ar_out),
    err AS (SELECT p.modelo, p.gas, p.fold, t.dato - p.yhat AS e FROM pred p JOIN ftest t
            ON t.gas = p.gas AND t.fold = p.fold AND t.estacion = p.estacion
           AND t.fecha = p.fecha),
    per_fold AS (SELECT gas, modelo, fold, AVG(ABS(e)) AS mae, SQRT(AVG(e * e)) AS rmse
                 FROM err GROUP BY 1, 2, 3),
    ranked AS (SELECT gas, modelo, AVG(mae) AS mae, AVG(rmse) AS rmse, COUNT(*) AS origenes
               FROM per_fold GROUP BY 1, 2)"""


_PREDICTED = predicted_ctes("v_feat_dense")
_SQL_MODELS = {"seasonal_naive": md.seasonal_naive, "seasonal_ar": md.seasonal_ar}


@check(
    "error_metrics",
    f"""{_PREDICTED} SELECT gas, modelo, fold, ROUND(mae, 6) AS mae, ROUND(rmse, 6) AS rmse
        FROM per_fold""",
)
def _(inputs: Inputs):
    train, _future = _split(inputs)
    rows = bt.fold_rows(train, bt.usable_folds(train, HORIZON))
    predictions = bt.backtest_predictions(rows, _SQL_MODELS)
    return bt.error_metrics(predictions, ["gas", "modelo", "fold"])


@check(
    "backtest_rank",
    f"""{_PREDICTED} SELECT gas, modelo, ROUND(mae, 6) AS mae, ROUND(rmse, 6) AS rmse, origenes,
               CAST(ROW_NUMBER() OVER (PARTITION BY gas ORDER BY rmse, modelo) AS INTEGER)
                   AS puesto FROM ranked""",
)
def _(inputs: Inputs):
    train, _future = _split(inputs)
    return bt.backtest(train, HORIZON, _SQL_MODELS)


@check(
    "model_registry",
    f"""SELECT gas, 'seasonal_naive' AS modelo, COUNT(*) AS filas, COUNT(yhat) AS predichas
        FROM ({naive_sql(_TRAIN, _FUTURE, 'gas')}) GROUP BY 1
        UNION ALL SELECT gas, name, COUNT(*), COUNT(*)
        FROM v_feat_dense, (VALUES ('seasonal_ar'), ('seasonal_arma')) m(name)
        WHERE futuro GROUP BY 1, 2""",
)
def _(inputs: Inputs):
    train, future = _split(inputs)
    result = None
    for name in (*_SQL_MODELS, "seasonal_arma"):
        part = md.MODELS[name](train, future, GAS).withColumn("modelo", F.lit(name))
        result = part if result is None else result.unionByName(part)
    return result.groupBy("gas", "modelo").agg(
        F.count(F.lit(1)).alias("filas"), F.count("yhat").alias("predichas")
    )


@check(
    "forecast_table",
    f"""SELECT gas, fecha AS FECHA, estacion AS ID_AIRE, cod_dis AS COD_DIS,
               CASE gas WHEN 'NO2' THEN 8 ELSE 14 END AS ID_MAGNITUD,
               ROUND(yhat, 6) AS VALOR_PREDICHO, 'seasonal_naive' AS MODELO
        FROM ({naive_sql(_TRAIN, _FUTURE, 'gas')})""",
)
def _(inputs: Inputs):
    train, future = _split(inputs)
    only = {"seasonal_naive": md.seasonal_naive}
    ranking = bt.backtest(train, HORIZON, only)
    predictions = md.seasonal_naive(train, future, GAS).withColumn(
        "modelo", F.lit("seasonal_naive")
    )
    return rn.forecast_table(predictions, rn.winners(ranking), gas_table(inputs.spark))


def _daily_fact(inputs: Inputs):
    """The dense history in the columns of the air fact."""
    return inputs.view("v_hist_dense").select(
        F.when(F.col("gas") == "NO2", 8).otherwise(14).alias("ID_MAGNITUD"),
        F.col("estacion").alias("ID_AIRE"),
        F.col("cod_dis").alias("COD_DIS"),
        F.col("fecha").alias("FECHA"),
        F.col("dato").alias("DATO"),
    )


@check(
    "forecast_run",
    f"""{predicted_ctes('v_feat_month')},
        won AS (SELECT gas, modelo FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY gas
                ORDER BY rmse, modelo) AS p FROM ranked) WHERE p = 1),
        ahead AS (SELECT * FROM v_feat_month WHERE futuro),
        {ar_ctes('tr', 'ahead', 'gas', 'fc')},
        fnv AS ({naive_sql('tr', 'ahead', 'gas')}),
        allp AS (SELECT 'seasonal_naive' AS modelo, * FROM fnv
                 UNION ALL SELECT 'seasonal_ar', * FROM fc_out)
        SELECT a.gas, a.fecha AS FECHA, a.estacion AS ID_AIRE, a.cod_dis AS COD_DIS,
               CASE a.gas WHEN 'NO2' THEN 8 ELSE 14 END AS ID_MAGNITUD,
               ROUND(a.yhat, 6) AS VALOR_PREDICHO, a.modelo AS MODELO
        FROM allp a JOIN won w ON w.gas = a.gas AND w.modelo = a.modelo""",
)
def _(inputs: Inputs):
    fact = _daily_fact(inputs)
    published, _metrics = rn.run_forecast(
        fact, gas_table(inputs.spark), ["NO2", "O3"], 1, _SQL_MODELS
    )
    return published


_RUNS = """
    runs AS (SELECT gas, estacion, fecha + CAST(31 * m AS INTEGER) AS fecha, dato * m AS valor, m
             FROM v_hist_dense, range(1, 3) r(m))"""


@check(
    "prediction_view",
    f"""WITH {_RUNS},
        own AS (SELECT * FROM v_hist_dense WHERE gas = 'O3' AND estacion = 1),
        marks AS (SELECT gas, MAX(fecha) AS ultima, AVG(dato) AS media, MAX(dato) AS maximo
                  FROM v_hist_dense GROUP BY gas)
        SELECT 'gases' AS parte, gas AS etiqueta, NULL::DATE AS fecha,
               CAST(MAX(m) AS DOUBLE) AS valor, NULL::DOUBLE AS rmse
        FROM runs GROUP BY gas
        UNION ALL SELECT DISTINCT 'estaciones', CAST(estacion AS VARCHAR), NULL, NULL, NULL
        FROM runs WHERE gas = 'O3'
        UNION ALL SELECT 'serie', 'real', fecha, ROUND(dato, 6), NULL FROM own
        UNION ALL SELECT 'serie', 'puente', fecha, ROUND(dato, 6), NULL FROM own
        WHERE fecha = (SELECT MAX(fecha) FROM own)
        UNION ALL SELECT 'serie', 'predicho', fecha, ROUND(valor, 6), NULL FROM runs
        WHERE gas = 'O3' AND estacion = 1 AND m = 2
        UNION ALL SELECT 'metricas', 'primero', ultima, ROUND(media, 2), ROUND(maximo * 2, 2)
        FROM marks WHERE gas = 'O3'
        UNION ALL SELECT 'metricas', 'segundo', ultima, ROUND(media + 1, 2), ROUND(maximo * 2, 2)
        FROM marks WHERE gas = 'O3'""",
)
def _(inputs: Inputs):
    from sensoria.functions.codes import run_name
    from sensoria.plans.dashboard import prediction_view

    months = F.explode(F.array(F.lit(1), F.lit(2)))
    hist = inputs.view("v_hist_dense")
    predictions = hist.withColumn("m", months).select(
        F.date_add("fecha", F.col("m") * 31).alias("FECHA"),
        F.col("estacion").alias("ID_AIRE"),
        (F.col("dato") * F.col("m")).alias("VALOR_PREDICHO"),
        run_name(F.col("gas"), F.col("m")).alias("run"),
    )
    marks = hist.groupBy("gas").agg(
        F.max("fecha").cast("string").alias("ultima_fecha_real"),
        F.avg("dato").alias("media"),
        F.max("dato").alias("maximo"),
    )

    def model(name: str, mae):
        return F.struct(
            F.lit(name).alias("modelo"), mae.alias("mae"),
            (F.col("maximo") * F.col("horizonte_meses")).alias("rmse"),
        )

    metrics = marks.withColumn("horizonte_meses", months).select(
        "gas", "horizonte_meses", "ultima_fecha_real", F.lit("primero").alias("ganador"),
        F.array(model("primero", F.col("media")), model("segundo", F.col("media") + 1))
        .alias("comparativa"),
    )
    parts = prediction_view(
        _daily_fact(inputs), gas_table(inputs.spark), predictions, metrics, "O3", 1
    )
    no_day, no_number = F.lit(None).cast("date"), F.lit(None).cast("double")

    def rows(part, label, day, value, rmse):
        return parts[part].select(
            F.lit(part).alias("parte"), label.alias("etiqueta"), day.alias("fecha"),
            value.cast("double").alias("valor"), rmse.alias("rmse"),
        )

    shown = [
        rows("gases", F.col("gas"), no_day, F.col("meses"), no_number),
        rows("estaciones", F.col("ID_AIRE").cast("string"), no_day, no_number, no_number),
        rows("serie", F.col("kind"), F.col("fecha"), F.col("valor"), no_number),
        rows("metricas", F.col("modelo"), F.to_date("ultima_fecha_real"), F.col("mae"),
             F.col("rmse")),
    ]
    result = shown[0]
    for part in shown[1:]:
        result = result.unionByName(part)
    return result


@check(
    "metrics_table",
    f"""{_PREDICTED}, w AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY gas
               ORDER BY rmse, modelo) AS p FROM ranked)
        SELECT w.gas, 1 AS horizonte_meses, CAST(h.f1 AS VARCHAR) AS ultima_fecha_real, w.modelo,
               ROUND(w.mae, 2) AS mae, ROUND(w.rmse, 2) AS rmse, w.p = 1 AS es_ganador
        FROM w JOIN (SELECT gas, MAX(fecha) AS f1 FROM v_hist_dense GROUP BY gas) h
          ON h.gas = w.gas""",
)
def _(inputs: Inputs):
    from sensoria.plans.dashboard import metrics_table
    from sensoria.session import new_folder
    from sensoria.sources.metrics import read_metrics, write_metrics

    hist = inputs.view("v_hist_dense")
    train, _future = _split(inputs)
    ranking = bt.backtest(train, HORIZON, _SQL_MODELS)
    metrics = rn.metrics_rows(ranking, rn.horizons(hist, 1), 1)
    folder = new_folder(inputs.spark, "metrics")
    write_metrics(metrics, folder)
    return metrics_table(read_metrics(inputs.spark, folder))


@check(
    "forecast_horizon_by_gas",
    """SELECT gas, MAX(fecha) AS ultima_fecha_real, CAST(datediff('day', MAX(fecha),
              CAST(MAX(fecha) + INTERVAL 2 MONTH AS DATE)) AS INTEGER) AS horizonte_dias
       FROM v_hist_gappy GROUP BY gas""",
)
def _(inputs: Inputs):
    return rn.horizons(inputs.view("v_hist_gappy"), 2)
