"""Reading queries and the data behind the dashboard."""

from pyspark.sql import functions as F

from sensoria.checks.fixtures import Inputs
from sensoria.checks.of_geo import CENTROIDS, outlines
from sensoria.checks.of_star import dim_district, fact_air, silver_traffic
from sensoria.checks.registry import check
from sensoria.functions.codes import run_name
from sensoria.plans import coverage, dashboard, reads
from sensoria.session import new_folder
from sensoria.sources.tables import Lakehouse, sample_rows

GAS, DISTRICT, STATION, POINT = "NO2", "19", 8, 7


def _air(inputs):
    return inputs.view("v_air"), inputs.view("v_station")


def _traffic(inputs):
    return silver_traffic(inputs), inputs.view("v_point")


def _quarter_hours(inputs):
    return inputs.view("v_traffic_15m"), inputs.view("v_point_15m")


_MONTHLY_AIR = f"""
    SELECT COD_DIS, ROUND(SUM(total) / SUM(readings), 6) AS valor_medio
    FROM (SELECT ID_AIRE, SUM(DATO) AS total, COUNT(DATO) AS readings FROM v_air
          WHERE strftime(FECHA, '%Y-%m') = '2024-01' AND VALIDEZ = 'V' AND MAGNITUD = '{GAS}'
          GROUP BY ALL) per_sensor
    INNER JOIN (SELECT ID_AIRE, COD_DIS FROM v_station) places USING (ID_AIRE)
    GROUP BY ALL"""


def monthly_air(inputs: Inputs):
    air, stations = _air(inputs)
    return reads.district_monthly_air(air, stations, GAS, 2024, 1)


@check("district_monthly_air", _MONTHLY_AIR)
def _(inputs: Inputs):
    return monthly_air(inputs)


@check("traffic_districts", "SELECT DISTINCT COD_DIS FROM v_point")
def _(inputs: Inputs):
    return reads.traffic_districts(inputs.view("v_point"))


@check("distinct_lists", "SELECT DISTINCT CAST(ID_AIRE AS VARCHAR) AS ID_AIRE FROM v_air")
def _(inputs: Inputs):
    return reads.stations(inputs.view("v_air"))


@check(
    "magnitudes_of_station", f"SELECT DISTINCT MAGNITUD FROM v_air WHERE ID_AIRE = {STATION}"
)
def _(inputs: Inputs):
    return reads.magnitudes(inputs.view("v_air"), STATION)


@check(
    "monthly_average",
    f"""SELECT CAST(date_trunc('month', FECHA) AS DATE) AS mes, ROUND(AVG(DATO), 6) AS media
        FROM v_air WHERE ID_AIRE = {STATION} AND MAGNITUD = '{GAS}' AND VALIDEZ = 'V'
        GROUP BY 1""",
)
def _(inputs: Inputs):
    return reads.monthly_average(inputs.view("v_air"), STATION, GAS)


@check(
    "daily_values",
    f"""SELECT FECHA AS dia, DATO FROM v_air
        WHERE ID_AIRE = {STATION} AND MAGNITUD = '{GAS}' AND VALIDEZ = 'V'""",
    decimals=None,
)
def _(inputs: Inputs):
    return reads.daily_values(inputs.view("v_air"), STATION, GAS)


@check(
    "monthly_average_traffic",
    f"""SELECT CAST(date_trunc('month', FECHA) AS DATE) AS mes, ROUND(AVG(CARGA), 6) AS media
        FROM v_traffic WHERE ID_TRAFICO = {POINT} GROUP BY 1""",
)
def _(inputs: Inputs):
    return reads.monthly_average_traffic(silver_traffic(inputs), POINT, "CARGA")


@check(
    "air_variables_by_district",
    f"""SELECT MAGNITUD FROM v_air WHERE VALIDEZ = 'V'
        AND ID_AIRE IN (SELECT ID_AIRE FROM v_station WHERE COD_DIS = '{DISTRICT}')
        GROUP BY MAGNITUD""",
)
def _(inputs: Inputs):
    return reads.air_variables_by_district(*_air(inputs), DISTRICT)


@check(
    "daily_traffic_series",
    f"""SELECT CAST(FECHA AS DATE) AS dia, ROUND(AVG(VMED), 6) AS valor FROM v_traffic
        WHERE ID_TRAFICO = {POINT} GROUP BY 1""",
)
def _(inputs: Inputs):
    return reads.daily_traffic_series(silver_traffic(inputs), POINT, "VMED")


_DAILY_AIR = f"""
    SELECT FECHA AS dia, ROUND(SUM(DATO) / COUNT(DATO), 6) AS media FROM v_air
    WHERE ID_AIRE IN (SELECT ID_AIRE FROM v_station WHERE COD_DIS = '{DISTRICT}')
      AND VALIDEZ = 'V' AND MAGNITUD = '{GAS}' GROUP BY ALL"""
_DAILY_NOON = f"""
    SELECT CAST(FECHA AS DATE) AS dia, ROUND(SUM(INTENSIDAD) / COUNT(INTENSIDAD), 6) AS media
    FROM v_traffic_15m WHERE strftime(FECHA, '%H') = '12'
      AND ID_TRAFICO IN (SELECT ID_TRAFICO FROM v_point_15m WHERE COD_DIS = '{DISTRICT}')
    GROUP BY ALL"""


@check("daily_air_by_district", _DAILY_AIR)
def _(inputs: Inputs):
    return reads.daily_air_by_district(*_air(inputs), GAS, DISTRICT)


@check("daily_traffic_by_district_noon", _DAILY_NOON)
def _(inputs: Inputs):
    return reads.daily_traffic_by_district_noon(
        *_quarter_hours(inputs), "INTENSIDAD", DISTRICT
    )


_MONTHLY_TRAFFIC = """
    SELECT COD_DIS, ROUND(SUM(OCUPACION) / COUNT(OCUPACION), 6) AS valor_medio
    FROM (SELECT ID_TRAFICO, OCUPACION FROM v_traffic
          WHERE FECHA >= DATE '1997-05-01' AND FECHA < DATE '1997-06-01') may
    INNER JOIN (SELECT ID_TRAFICO, COD_DIS FROM v_point) places USING (ID_TRAFICO)
    GROUP BY ALL"""


def monthly_traffic(inputs: Inputs):
    return reads.district_monthly_traffic(*_traffic(inputs), "ocupacion", 1997, 5)


@check("district_monthly_traffic", _MONTHLY_TRAFFIC)
def _(inputs: Inputs):
    return monthly_traffic(inputs)


@check(
    "points_by_district",
    f"SELECT ID_TRAFICO, NOMBRE, LONGITUD, LATITUD FROM v_point WHERE COD_DIS = '{DISTRICT}'",
    decimals=None,
)
def _(inputs: Inputs):
    return reads.points_by_district(inputs.view("v_point"), DISTRICT)


@check(
    "station_coords",
    "SELECT ID_AIRE, ESTACION, LONGITUD, LATITUD, COD_DIS FROM v_station",
    decimals=None,
)
def _(inputs: Inputs):
    return reads.station_coords(inputs.view("v_station"))


@check(
    "districts_by_gas",
    f"""SELECT COD_DIS FROM v_station WHERE ID_AIRE IN
        (SELECT ID_AIRE FROM v_air WHERE VALIDEZ = 'V' AND MAGNITUD = '{GAS}')
        GROUP BY COD_DIS""",
)
def _(inputs: Inputs):
    return reads.districts_by_gas(*_air(inputs), GAS)


@check(
    "air_periods",
    f"""SELECT CAST(strftime(FECHA, '%Y') AS INTEGER) AS anio,
               CAST(strftime(FECHA, '%m') AS INTEGER) AS mes
        FROM v_air WHERE VALIDEZ = 'V' AND MAGNITUD = '{GAS}'
          AND ID_AIRE IN (SELECT ID_AIRE FROM v_station WHERE COD_DIS = '{DISTRICT}')
        GROUP BY ALL""",
)
def _(inputs: Inputs):
    return reads.air_periods(*_air(inputs), GAS, DISTRICT)


_SPAN = f"""
    b AS (SELECT date_trunc('month', MIN(t.FECHA)) AS f0, date_trunc('month', MAX(t.FECHA)) AS f1
          FROM v_traffic t JOIN v_point p ON t.ID_TRAFICO = p.ID_TRAFICO
          WHERE p.COD_DIS = '{DISTRICT}'),
    months AS (SELECT UNNEST(generate_series(f0, f1, INTERVAL 1 MONTH)) AS m FROM b)"""


@check(
    "traffic_periods",
    f"""WITH {_SPAN} SELECT CAST(year(m) AS INTEGER) AS anio, CAST(month(m) AS INTEGER) AS mes
        FROM months""",
)
def _(inputs: Inputs):
    return reads.traffic_periods(*_traffic(inputs), "CARGA", DISTRICT)


@check(
    "traffic_periods_exact",
    f"""SELECT DISTINCT CAST(year(t.FECHA) AS INTEGER) AS anio,
               CAST(month(t.FECHA) AS INTEGER) AS mes
        FROM v_traffic t JOIN v_point p ON t.ID_TRAFICO = p.ID_TRAFICO
        WHERE p.COD_DIS = '{DISTRICT}' AND t.CARGA IS NOT NULL""",
)
def _(inputs: Inputs):
    return reads.traffic_periods_exact(*_traffic(inputs), "CARGA", DISTRICT)


# Selectors: one with data, one that falls back.


_CASCADE = f"""WITH {_SPAN}
        SELECT DISTINCT 'distrito' AS selector, s.COD_DIS AS opcion
        FROM v_air a JOIN v_station s ON a.ID_AIRE = s.ID_AIRE
        WHERE a.MAGNITUD = '{GAS}' AND a.VALIDEZ = 'V'
        UNION ALL SELECT DISTINCT 'distrito sin datos', COD_DIS FROM v_point
        UNION ALL SELECT DISTINCT 'variable', a.MAGNITUD
        FROM v_air a JOIN v_station s ON a.ID_AIRE = s.ID_AIRE
        WHERE a.VALIDEZ = 'V' AND s.COD_DIS = '{DISTRICT}'
        UNION ALL SELECT 'variable sin datos', UNNEST(['NO2', 'PM10', 'PM2.5', 'O3', 'NOx'])
        UNION ALL SELECT DISTINCT 'anio', CAST(year(m) AS VARCHAR) FROM months
        UNION ALL SELECT 'anio sin datos', UNNEST(['2020', '2021', '2022', '2023', '2024'])
        UNION ALL SELECT DISTINCT 'mes', CAST(month(m) AS VARCHAR) FROM months
        WHERE year(m) = 1996
        UNION ALL SELECT 'mes sin datos', CAST(UNNEST(range(1, 13)) AS VARCHAR)"""


@check("filter_cascade", _CASCADE)
def _(inputs: Inputs):
    return _cascade(dashboard.SensorTables(*_air(inputs), *_traffic(inputs), inputs.view("v_district")))


def _cascade(shown):
    options = {
        "distrito": dashboard.district_options(shown, "Aire", GAS),
        "distrito sin datos": dashboard.district_options(shown, "Aire", "EBE"),
        "variable": dashboard.variable_options(shown, "Aire", DISTRICT),
        "variable sin datos": dashboard.variable_options(shown, "Aire", "99"),
        "anio": dashboard.year_options(shown, "Trafico", "CARGA", DISTRICT),
        "anio sin datos": dashboard.year_options(shown, "Aire", GAS, "99"),
        "mes": dashboard.month_options(shown, "Trafico", "CARGA", DISTRICT, 1996),
        "mes sin datos": dashboard.month_options(shown, "Aire", GAS, DISTRICT, 1996),
    }
    result = None
    for selector, found in options.items():
        part = found.select(
            F.lit(selector).alias("selector"),
            F.col(found.columns[0]).cast("string").alias("opcion"),
        )
        result = part if result is None else result.unionByName(part)
    return result


@check("filter_cascade_by_load", _CASCADE)
def _(inputs: Inputs):
    """The same lists from a table that two loads have kept; no reading is read for them."""
    air, stations = _air(inputs)
    traffic, points = _traffic(inputs)
    early, late = F.year("FECHA") < 1997, F.year("FECHA") >= 1997
    lake = Lakehouse(inputs.spark, new_folder(inputs.spark, "lake"))
    lake.write("silver", "aire", air.where("ID_AIRE % 2 = 0"))
    lake.write("silver", "trafico", traffic.where(early))
    coverage.rebuild(lake)
    coverage.add_load(lake, "aire", air.where("ID_AIRE % 2 = 1"))
    coverage.add_load(lake, "trafico", traffic.where(late))
    return _cascade(coverage.selector_tables(coverage.read(lake), stations, points, inputs.view("v_district")))


@check(
    "coverage_by_month",
    """SELECT ID_AIRE AS sensor, MAGNITUD AS variable, 'aire' AS dataset, CAST(year(FECHA) AS INTEGER) AS anio,
              CAST(month(FECHA) AS INTEGER) AS mes, COUNT(*) AS filas, MIN(FECHA) AS primer_dia,
              MAX(FECHA) AS ultimo_dia
       FROM v_air WHERE VALIDEZ = 'V' GROUP BY ALL
       UNION ALL
       SELECT ID_TRAFICO, variable, 'trafico', CAST(year(FECHA) AS INTEGER), CAST(month(FECHA) AS INTEGER), COUNT(*),
              CAST(MIN(FECHA) AS DATE), CAST(MAX(FECHA) AS DATE)
       FROM (SELECT ID_TRAFICO, FECHA, '*' AS variable FROM v_traffic
             UNION ALL SELECT ID_TRAFICO, FECHA, 'INTENSIDAD' FROM v_traffic WHERE INTENSIDAD IS NOT NULL
             UNION ALL SELECT ID_TRAFICO, FECHA, 'OCUPACION' FROM v_traffic WHERE OCUPACION IS NOT NULL
             UNION ALL SELECT ID_TRAFICO, FECHA, 'CARGA' FROM v_traffic WHERE CARGA IS NOT NULL
             UNION ALL SELECT ID_TRAFICO, FECHA, 'VMED' FROM v_traffic WHERE VMED IS NOT NULL)
       GROUP BY ALL""",
)
def _(inputs: Inputs):
    return coverage.merged([coverage.air_coverage(_air(inputs)[0]), coverage.traffic_coverage(_traffic(inputs)[0])])


# KPIs, tables, maps.


@check(
    "kpi_mean",
    f"""SELECT ROUND(MAX(valor_medio), 2) AS valor FROM ({_MONTHLY_AIR})
        WHERE COD_DIS = '{DISTRICT}'""",
)
def _(inputs: Inputs):
    return dashboard.kpi_mean(monthly_air(inputs), DISTRICT)


@check(
    "kpi_counts",
    f"""SELECT (SELECT COUNT(*) FROM v_station WHERE COD_DIS = '{DISTRICT}') AS n_estaciones,
               (SELECT COUNT(*) FROM v_point WHERE COD_DIS = '{DISTRICT}') AS n_puntos""",
)
def _(inputs: Inputs):
    return dashboard.kpi_counts(inputs.view("v_station"), inputs.view("v_point"), DISTRICT)


@check(
    "coverage_table",
    """SELECT NOMBRE, N_ESTACIONES_AIRE, N_PUNTOS_TRAFICO,
              CASE WHEN COBERTURA_AIRE THEN 'With coverage' ELSE 'No coverage' END AS cobertura
       FROM v_dim_district""",
)
def _(inputs: Inputs):
    return dashboard.coverage_table(dim_district(inputs))


@check(
    "coverage_map",
    """SELECT COD_DIS, NOMBRE, N_ESTACIONES_AIRE, N_PUNTOS_TRAFICO,
              CASE WHEN COBERTURA_AIRE THEN 'green' ELSE 'red' END AS color FROM v_dim_district""",
)
def _(inputs: Inputs):
    return dashboard.coverage_map(dim_district(inputs))


@check(
    "daily_table",
    f"""SELECT FECHA AS "Fecha", DATO AS "Valor", 'µg/m³' AS unidad FROM v_air
        WHERE ID_AIRE = {STATION} AND MAGNITUD = '{GAS}' AND VALIDEZ = 'V'""",
    decimals=None,
)
def _(inputs: Inputs):
    return dashboard.daily_table(inputs.view("v_air"), STATION, GAS)


@check(
    "position_layer",
    f"""SELECT 'estacion' AS kind, ID_AIRE AS id, ESTACION AS nombre, LONGITUD AS longitud,
               LATITUD AS latitud, COD_DIS AS distrito FROM v_station
        UNION ALL SELECT 'punto', ID_TRAFICO, NOMBRE, LONGITUD, LATITUD, COD_DIS FROM v_point
        WHERE COD_DIS = '{DISTRICT}'""",
    decimals=None,
)
def _(inputs: Inputs):
    return dashboard.position_layer(
        inputs.view("v_station"), inputs.view("v_point"), DISTRICT
    )


@check(
    "choropleth_table",
    f"""SELECT d.COD_DIS, d.NOMBRE, ROUND(m.valor_medio, 6) AS valor_medio,
               COALESCE(CAST(ROUND(m.valor_medio, 2) AS VARCHAR), 'N/A') AS valor_texto,
               CASE WHEN m.valor_medio IS NULL THEN 'lightgray' WHEN m.valor_medio < 0 THEN 'gray'
                    WHEN m.valor_medio < 20 THEN 'green' WHEN m.valor_medio < 40 THEN 'yellow'
                    WHEN m.valor_medio < 60 THEN 'orange' ELSE 'red' END AS color,
               ROUND(c.lat, 6) AS CENTROID_LAT, ROUND(c.lon, 6) AS CENTROID_LON
        FROM v_district d LEFT JOIN ({_MONTHLY_TRAFFIC}) m ON m.COD_DIS = d.COD_DIS
        LEFT JOIN ({CENTROIDS}) c ON c.COD_DIS = d.COD_DIS""",
)
def _(inputs: Inputs):
    return dashboard.choropleth_table(
        inputs.view("v_district"), monthly_traffic(inputs), "OCUPACION", outlines(inputs)
    )


# Series.


@check(
    "air_traffic_by_day",
    f"""SELECT a.dia, ROUND(a.media, 6) AS media_gas, ROUND(t.media, 6) AS media_trafico
        FROM ({_DAILY_AIR}) a JOIN ({_DAILY_NOON}) t ON t.dia = a.dia""",
)
def _(inputs: Inputs):
    return dashboard.air_traffic_by_day(
        reads.daily_air_by_district(*_air(inputs), GAS, DISTRICT),
        reads.daily_traffic_by_district_noon(
            *_quarter_hours(inputs), "INTENSIDAD", DISTRICT
        ),
    )


@check(
    "resolve_fk_by_name",
    """SELECT f.ID_AIRE AS estacion, f.COD_DIS AS cod_dis, f.FECHA AS fecha,
              ROUND(f.DATO, 6) AS dato, 'O3' AS gas
       FROM v_fact_air f WHERE f.ID_MAGNITUD = 14""",
)
def _(inputs: Inputs):
    from sensoria.catalogs import gas_table
    from sensoria.plans.forecast.features import history

    return history(fact_air(inputs), gas_table(inputs.spark), ["O3"])


@check(
    "history_plus_forecast",
    f"""WITH r AS (SELECT FECHA AS fecha, DATO AS valor FROM v_air_day
                   WHERE MAGNITUD = '{GAS}' AND ID_AIRE = {STATION})
        SELECT fecha, ROUND(valor, 6) AS valor, 'real' AS kind FROM r
        UNION ALL SELECT fecha, ROUND(valor, 6), 'puente' FROM r
        WHERE fecha = (SELECT MAX(fecha) FROM r)
        UNION ALL SELECT CAST(fecha + 31 AS DATE), ROUND(valor * 2, 6), 'predicho' FROM r""",
)
def _(inputs: Inputs):
    own = (F.col("MAGNITUD") == GAS) & (F.col("ID_AIRE") == STATION)
    real = inputs.view("v_air_day").filter(own).select(
        F.col("FECHA").alias("fecha"), F.col("DATO").alias("dato")
    )
    later = real.select(
        F.date_add("fecha", 31).alias("fecha"), (F.col("dato") * 2).alias("valor")
    )
    return dashboard.history_plus_forecast(real, later)


@check(
    "longest_horizon_run",
    """SELECT MAGNITUD AS gas, CAST(MAX(day(FECHA)) AS INTEGER) AS meses,
              'pred_' || MAGNITUD || '_' || CAST(MAX(day(FECHA)) AS VARCHAR) || 'm' AS run
       FROM v_air GROUP BY MAGNITUD""",
)
def _(inputs: Inputs):
    name = run_name(F.col("MAGNITUD"), F.dayofmonth("FECHA")).alias("run")
    return dashboard.longest_runs(inputs.view("v_air").select(name).distinct())


@check(
    "forecast_stations",
    f"""SELECT DISTINCT ID_AIRE FROM v_air WHERE MAGNITUD = '{GAS}'
        AND day(FECHA) = (SELECT MAX(day(FECHA)) FROM v_air WHERE MAGNITUD = '{GAS}')""",
)
def _(inputs: Inputs):
    name = run_name(F.col("MAGNITUD"), F.dayofmonth("FECHA")).alias("run")
    return dashboard.forecast_stations(inputs.view("v_air").select("ID_AIRE", name), GAS)


@check(
    "order_by",
    """SELECT FECHA, ID_AIRE, MAGNITUD, DATO FROM v_air
       ORDER BY FECHA, ID_AIRE, MAGNITUD, DATO""",
    decimals=None,
)
def _(inputs: Inputs):
    order = ["FECHA", "ID_AIRE", "MAGNITUD", "DATO"]
    return inputs.view("v_air").select(*order).orderBy(*order)


@check(
    "param_guard",
    """SELECT p.COD_DIS, ROUND(AVG(t.VMED), 6) AS valor_medio
       FROM v_traffic t JOIN v_point p ON t.ID_TRAFICO = p.ID_TRAFICO
       WHERE t.FECHA >= DATE '1999-12-01' AND t.FECHA < DATE '2000-01-01' GROUP BY p.COD_DIS""",
)
def _(inputs: Inputs):
    try:
        reads.traffic_variable("VMED) FROM t --")
    except ValueError:
        return reads.district_monthly_traffic(*_traffic(inputs), "vmed", 1999, 12)
    raise AssertionError("an unknown variable was accepted")


@check(
    "limit_n",
    """SELECT FECHA, ID_TRAFICO, INTENSIDAD FROM v_traffic_15m
       ORDER BY INTENSIDAD DESC, FECHA, ID_TRAFICO LIMIT 5""",
    decimals=None,
)
def _(inputs: Inputs):
    readings = inputs.view("v_traffic_15m").select("FECHA", "ID_TRAFICO", "INTENSIDAD")
    return sample_rows(readings, [F.col("INTENSIDAD").desc(), "FECHA", "ID_TRAFICO"])
