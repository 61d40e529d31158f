"""Projections, filters, reshaping."""

from pyspark.sql import functions as F

from sensoria.catalogs import GAS_LABELS, TRAFFIC_RENAMES, TRAFFIC_VARIABLES, band_table
from sensoria.checks.fixtures import Inputs
from sensoria.checks.registry import check
from sensoria.functions import codes, dates
from sensoria.operators import bands, cleaning, reshape, rollups
from sensoria.operators.star import dim_estacion_aire
from sensoria.sources.tables import describe_columns, sample_rows


@check(
    "rename_uppercase",
    """SELECT id AS ID_TRAFICO, fecha AS FECHA, tipo_elem AS TIPO_ELEM, intensidad AS INTENSIDAD,
              ocupacion AS OCUPACION, carga AS CARGA, vmed AS VMED, error AS ERROR,
              periodo_integracion AS PERIODO_INTEGRACION FROM v_traffic_bronze""",
    decimals=None,
)
def _(inputs: Inputs):
    return cleaning.rename_uppercase(inputs.view("v_traffic_bronze"), TRAFFIC_RENAMES)


@check(
    "code_to_label",
    """SELECT d.ESTACION, d.FECHA, d.MAGNITUD AS CODIGO,
              COALESCE(g.MAGNITUD, CAST(d.MAGNITUD AS VARCHAR)) AS MAGNITUD
       FROM v_air_daily d LEFT JOIN v_gas g ON g.ID_MAGNITUD = d.MAGNITUD""",
)
def _(inputs: Inputs):
    daily = inputs.view("v_air_daily")
    label = codes.label_of(F.col("MAGNITUD"), GAS_LABELS)
    return daily.select(
        "ESTACION", "FECHA", F.col("MAGNITUD").alias("CODIGO"), label.alias("MAGNITUD")
    )


@check(
    "sentinel_to_null",
    """SELECT ID, FECHA,
              CASE WHEN intensidad < 0 OR isnan(intensidad) OR intensidad > 20000 THEN NULL
                   ELSE intensidad END AS INTENSIDAD,
              CASE WHEN ocupacion < 0 OR isnan(ocupacion) THEN NULL ELSE ocupacion END
                  AS OCUPACION,
              CASE WHEN carga < 0 OR isnan(carga) THEN NULL ELSE carga END AS CARGA,
              CASE WHEN vmed < 0 OR isnan(vmed) THEN NULL ELSE vmed END AS VMED
       FROM (SELECT id AS ID, fecha AS FECHA, intensidad, ocupacion, carga, vmed
             FROM v_traffic_bronze)""",
    decimals=None,
)
def _(inputs: Inputs):
    upper = cleaning.rename_uppercase(inputs.view("v_traffic_bronze"), {})
    return cleaning.sentinels_to_null(upper).select("ID", "FECHA", *TRAFFIC_VARIABLES)


@check(
    "drop_incomplete",
    """SELECT id AS ID_TRAFICO, fecha AS FECHA, tipo_elem AS TIPO_ELEM, intensidad AS INTENSIDAD,
              ocupacion AS OCUPACION, carga AS CARGA, vmed AS VMED, error AS ERROR,
              periodo_integracion AS PERIODO_INTEGRACION FROM v_traffic_bronze
       WHERE intensidad >= 0 AND intensidad <= 20000 AND ocupacion >= 0 AND carga >= 0
         AND NOT isnan(vmed) AND vmed >= 0 AND error = 'N'""",
    decimals=None,
)
def _(inputs: Inputs):
    named = cleaning.rename_uppercase(inputs.view("v_traffic_bronze"), TRAFFIC_RENAMES)
    return cleaning.drop_incomplete(cleaning.sentinels_to_null(named))


@check("clean_traffic", "SELECT * FROM v_traffic", decimals=None)
def _(inputs: Inputs):
    return cleaning.clean_traffic(inputs.view("v_traffic_bronze"))


@check("valid_only", "SELECT * FROM v_air WHERE VALIDEZ = 'V'", decimals=None)
def _(inputs: Inputs):
    return cleaning.valid_only(inputs.view("v_air"))


@check(
    "bbox_filter",
    """SELECT ID_AIRE, ESTACION, LATITUD, LONGITUD FROM v_station
       WHERE LATITUD >= 39.85 AND LATITUD <= 41.20 AND LONGITUD >= -4.60 AND LONGITUD <= -3.05""",
    decimals=None,
)
def _(inputs: Inputs):
    inside = cleaning.inside_region(inputs.view("v_station"))
    return inside.select("ID_AIRE", "ESTACION", "LATITUD", "LONGITUD")


@check(
    "pad_code",
    """SELECT c_custkey, LPAD(CAST(c_nationkey AS VARCHAR), 2, '0') AS COD_DIS,
              CASE WHEN c_acctbal > 0 THEN LPAD(CAST(c_nationkey AS VARCHAR), 2, '0') END
              AS COD_TEXTO FROM customer""",
)
def _(inputs: Inputs):
    nation, segment = F.col("c_nationkey").cast("string"), F.col("c_mktsegment")
    text = F.when(F.col("c_acctbal") > 0, nation).otherwise(segment)
    return inputs.table("customer").select(
        "c_custkey",
        codes.pad_code(F.col("c_nationkey").cast("string")).alias("COD_DIS"),
        codes.pad_code(text).alias("COD_TEXTO"),
    )


@check("presence_flags", "SELECT * FROM v_dim_station", decimals=None)
def _(inputs: Inputs):
    return dim_estacion_aire(inputs.view("v_station"))


@check(
    "make_date_calendar",
    """SELECT o_orderkey, anio, mes, dia, MAKE_DATE(anio, mes, dia) AS fecha
       FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS anio,
                    CAST(month(o_orderdate) AS INTEGER) AS mes,
                    CAST(o_custkey % 31 + 1 AS INTEGER) AS dia FROM orders)
       WHERE dia <= day(last_day(MAKE_DATE(anio, mes, 1)))""",
)
def _(inputs: Inputs):
    parts = inputs.table("orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("anio"),
        F.month("o_orderdate").alias("mes"),
        (F.col("o_custkey") % 31 + 1).cast("int").alias("dia"),
    )
    year, month, day = F.col("anio"), F.col("mes"), F.col("dia")
    real = parts.filter(dates.day_exists(year, month, day))
    return real.withColumn("fecha", dates.calendar_day(year, month, day))


@check(
    "date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS anio, CAST(month(ts) AS INTEGER) AS mes,
              CAST(extract(hour FROM ts) AS INTEGER) AS hora,
              CAST(dayofyear(ts) AS INTEGER) AS dia_anio,
              CAST(date_trunc('month', ts) AS DATE) AS mes_inicio, CAST(ts AS DATE) AS dia
       FROM events""",
)
def _(inputs: Inputs):
    return inputs.table("events").select(
        "event_id",
        F.year("ts").alias("anio"),
        F.month("ts").alias("mes"),
        F.hour("ts").alias("hora"),
        F.dayofyear("ts").alias("dia_anio"),
        F.trunc(F.to_date("ts"), "month").alias("mes_inicio"),
        F.to_date("ts").alias("dia"),
    )


@check(
    "weekday_weekend",
    """SELECT o_orderkey, CAST(dayofweek(o_orderdate) AS INTEGER) AS dow,
              CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
       FROM orders""",
)
def _(inputs: Inputs):
    day = F.col("o_orderdate")
    return inputs.table("orders").select(
        "o_orderkey", dates.weekday(day).alias("dow"), dates.is_weekend(day).alias("is_weekend")
    )


@check(
    "cyclic_encoding",
    """SELECT o_orderkey, ROUND(SIN(2 * PI() * dayofyear(o_orderdate) / 365.25), 9) AS doy_sin,
              ROUND(COS(2 * PI() * dayofyear(o_orderdate) / 365.25), 9) AS doy_cos FROM orders""",
    decimals=9,
)
def _(inputs: Inputs):
    angle = dates.year_angle(F.col("o_orderdate"))
    return inputs.table("orders").select(
        "o_orderkey", F.sin(angle).alias("doy_sin"), F.cos(angle).alias("doy_cos")
    )


def _band_case(variable: str, value: str) -> str:
    edges = {
        "NO2": (90, 120, 230), "PM10": (40, 50, 100), "PM2.5": (20, 25, 50), "O3": (100, 130, 240),
    }
    tests = []
    for name, (a, b, c) in edges.items():
        for low, high, color in (
            (0, a, "green"), (a, b, "yellow"), (b, c, "orange"), (c, 1e9, "red"),
        ):
            tests.append(
                f"WHEN {variable} = '{name}' AND {value} >= {low} AND {value} < {high} "
                f"THEN '{color}'"
            )
    return f"CASE WHEN {value} IS NULL THEN 'lightgray' {' '.join(tests)} ELSE 'gray' END"


@check(
    "color_band",
    f"""SELECT ID_AIRE, MAGNITUD, FECHA, valor, {_band_case('MAGNITUD', 'valor')} AS color
        FROM (SELECT *, CASE WHEN VALIDEZ = 'V' THEN DATO - 8 END AS valor FROM v_air)""",
    decimals=None,
)
def _(inputs: Inputs):
    value = F.when(F.col("VALIDEZ") == "V", F.col("DATO") - 8)
    air = inputs.view("v_air").withColumn("valor", value)
    return bands.color_band(air, "MAGNITUD", "valor").select(
        "ID_AIRE", "MAGNITUD", "FECHA", "valor", "color"
    )


@check(
    "band_labels",
    """WITH b AS (SELECT * FROM (VALUES
           ('NO2', 0, '0 - 90', 'green'), ('NO2', 90, '90 - 120', 'yellow'),
           ('NO2', 120, '120 - 230', 'orange'), ('NO2', 230, '230+', 'red'),
           ('O3', 0, '0 - 100', 'green'), ('O3', 100, '100 - 130', 'yellow'),
           ('O3', 130, '130 - 240', 'orange'), ('O3', 240, '240+', 'red'),
           ('PM10', 0, '0 - 40', 'green'), ('PM10', 40, '40 - 50', 'yellow'),
           ('PM10', 50, '50 - 100', 'orange'), ('PM10', 100, '100+', 'red'),
           ('PM2.5', 0, '0 - 20', 'green'), ('PM2.5', 20, '20 - 25', 'yellow'),
           ('PM2.5', 25, '25 - 50', 'orange'), ('PM2.5', 50, '50+', 'red'))
           t(variable, orden, etiqueta, color)),
       seen AS (SELECT MAGNITUD, COUNT(*) AS n FROM v_air GROUP BY 1)
       SELECT b.variable, b.etiqueta, b.color, CAST(b.orden AS DOUBLE) AS orden,
              seen.n AS n_lecturas FROM b JOIN seen ON seen.MAGNITUD = b.variable""",
)
def _(inputs: Inputs):
    air = inputs.view("v_air")
    seen = rollups.count_by(air, "MAGNITUD", "n_lecturas")
    legend = bands.band_labels(band_table(inputs.spark))
    return legend.join(seen, legend.variable == seen.MAGNITUD).drop("MAGNITUD")


@check(
    "unit_lookup",
    """SELECT MAGNITUD, CASE WHEN MAGNITUD IN ('NO2', 'O3', 'PM10', 'PM2.5') THEN 'µg/m³'
                            ELSE 'unitless' END AS unidad, COUNT(*) AS n
       FROM v_air GROUP BY 1, 2""",
)
def _(inputs: Inputs):
    seen = rollups.count_by(inputs.view("v_air"), "MAGNITUD", "n")
    return bands.with_unit(seen, "MAGNITUD").select("MAGNITUD", "unidad", "n")


@check(
    "parse_run_name",
    """SELECT run, regexp_extract(run, '^pred_(.+)_(\\d+)m$', 1) AS gas,
              CAST(regexp_extract(run, '^pred_(.+)_(\\d+)m$', 2) AS INTEGER) AS meses,
              CAST(COUNT(*) AS BIGINT) AS n
       FROM (SELECT 'pred_' || MAGNITUD || '_' || CAST(day(FECHA) AS VARCHAR) || 'm' AS run
             FROM v_air) GROUP BY 1, 2, 3""",
)
def _(inputs: Inputs):
    name = codes.run_name(F.col("MAGNITUD"), F.dayofmonth("FECHA"))
    runs = rollups.count_by(inputs.view("v_air").select(name.alias("run")), "run", "n")
    return runs.select(
        "run", codes.run_gas(F.col("run")).alias("gas"),
        codes.run_months(F.col("run")).alias("meses"), "n",
    )


@check(
    "horizon_days",
    """SELECT o_orderkey, CAST(datediff('day', CAST(o_orderdate AS DATE),
              CAST(CAST(o_orderdate AS DATE) + INTERVAL 2 MONTH AS DATE)) AS INTEGER) AS dias_2,
              CAST(datediff('day', CAST(o_orderdate AS DATE),
              CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS DATE)) AS INTEGER) AS dias_12
       FROM orders""",
)
def _(inputs: Inputs):
    day = F.to_date("o_orderdate")
    return inputs.table("orders").select(
        "o_orderkey",
        dates.months_ahead_in_days(day, 2).alias("dias_2"),
        dates.months_ahead_in_days(day, 12).alias("dias_12"),
    )


@check(
    "sample_describe",
    """WITH s AS (SELECT * FROM v_air ORDER BY FECHA, ID_AIRE, MAGNITUD, DATO LIMIT 5),
       c AS (SELECT * FROM (VALUES (0, 'ID_AIRE', 'bigint'), (1, 'MAGNITUD', 'string'),
             (2, 'FECHA', 'date'), (3, 'DATO', 'double'), (4, 'VALIDEZ', 'string'))
             t(pos, columna, tipo))
       SELECT c.columna, c.tipo, s.ID_AIRE, s.MAGNITUD, s.FECHA, s.DATO FROM s CROSS JOIN c
       WHERE c.columna = 'DATO'""",
    decimals=None,
)
def _(inputs: Inputs):
    air = inputs.view("v_air")
    columns = describe_columns(air).filter(F.col("columna") == "DATO")
    sample = sample_rows(air, ["FECHA", "ID_AIRE", "MAGNITUD", "DATO"])
    return sample.select(
        columns.select("columna").scalar().alias("columna"),
        columns.select("tipo").scalar().alias("tipo"),
        "ID_AIRE", "MAGNITUD", "FECHA", "DATO",
    )


_KEYS = ["ESTACION", "MAGNITUD"]


@check(
    "unpivot_wide_days",
    """SELECT DISTINCT ESTACION AS ID_AIRE, CASE MAGNITUD WHEN 8 THEN 'NO2' WHEN 14 THEN 'O3'
              ELSE '99' END AS MAGNITUD, FECHA, DATO, VALIDEZ
       FROM v_air_daily WHERE VALIDEZ = 'V'""",
    decimals=None,
)
def _(inputs: Inputs):
    wide = reshape.rows_to_days(inputs.view("v_air_daily"), _KEYS)
    return reshape.unpivot_air(wide)


@check(
    "pivot_wide_days",
    "SELECT ESTACION, MAGNITUD, CAST(year(FECHA) AS INTEGER) AS ANO, "
    "CAST(month(FECHA) AS INTEGER) AS MES, "
    + ", ".join(
        f"COALESCE(MAX(CASE WHEN day(FECHA) = {d} THEN DATO END), 0.0) AS D{d:02d}, "
        f"COALESCE(MAX(CASE WHEN day(FECHA) = {d} THEN VALIDEZ END), 'N') AS V{d:02d}"
        for d in range(1, 32)
    )
    + " FROM v_air_daily GROUP BY 1, 2, 3, 4",
    decimals=None,
)
def _(inputs: Inputs):
    return reshape.rows_to_days(inputs.view("v_air_daily"), _KEYS)


@check(
    "unpivot_measures",
    """SELECT ID, FECHA, MEDIDA, VALOR FROM (
         SELECT id AS ID, fecha AS FECHA, 'INTENSIDAD' AS MEDIDA,
                CASE WHEN intensidad BETWEEN 0 AND 20000 THEN intensidad END AS VALOR
         FROM v_traffic_bronze
         UNION ALL SELECT id, fecha, 'OCUPACION', CASE WHEN ocupacion >= 0 THEN ocupacion END
         FROM v_traffic_bronze
         UNION ALL SELECT id, fecha, 'CARGA', CASE WHEN carga >= 0 THEN carga END
         FROM v_traffic_bronze
         UNION ALL SELECT id, fecha, 'VMED', CASE WHEN isnan(vmed) OR vmed < 0 THEN NULL
                   ELSE vmed END FROM v_traffic_bronze) WHERE VALOR IS NOT NULL""",
    decimals=None,
)
def _(inputs: Inputs):
    upper = cleaning.rename_uppercase(inputs.view("v_traffic_bronze"), {})
    return reshape.measures_to_rows(cleaning.sentinels_to_null(upper), ["ID", "FECHA"])
