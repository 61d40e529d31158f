"""Joins, aggregations, dimensions, facts, integrity checks."""

from pyspark.sql import functions as F

from sensoria.catalogs import gas_table, measure_table
from sensoria.checks.fixtures import Inputs
from sensoria.checks.registry import check
from sensoria.operators import quality, rollups, star
from sensoria.operators.cleaning import clean_traffic
from sensoria.plans import dashboard


def silver_traffic(inputs: Inputs):
    return clean_traffic(inputs.view("v_traffic_bronze"))


def fact_air(inputs: Inputs):
    stations = star.dim_estacion_aire(inputs.view("v_station"))
    return star.fact_calidad_aire(inputs.view("v_air_day"), stations, gas_table(inputs.spark))


def fact_traffic(inputs: Inputs):
    return star.fact_trafico_diario(
        silver_traffic(inputs), inputs.view("v_point"), measure_table(inputs.spark)
    )


def ozone_stations(inputs: Inputs):
    return inputs.view("v_station").filter(F.col("O3").isNotNull())


def dim_point(inputs: Inputs):
    return star.dim_punto_trafico(inputs.view("v_point_snapshot"), ["snapshot", "seq"])


def dim_district(inputs: Inputs):
    return star.dim_distrito(
        inputs.view("v_district"), ozone_stations(inputs), dim_point(inputs)
    )


@check(
    "inline_values",
    """SELECT m.ID_MAGNITUD, m.MAGNITUD, COUNT(a.ID_AIRE) AS n_lecturas FROM v_gas m
       LEFT JOIN v_air a ON a.MAGNITUD = m.MAGNITUD GROUP BY 1, 2""",
)
def _(inputs: Inputs):
    seen = rollups.count_by(inputs.view("v_air"), "MAGNITUD", "n_lecturas")
    return gas_table(inputs.spark).join(seen, "MAGNITUD", "left").fillna(0, ["n_lecturas"])


@check(
    "inline_measures",
    """SELECT m.ID_MEDIDA_TRAFICO, m.MEDIDA, COUNT(f.VALOR) AS n_valores FROM v_measure m
       LEFT JOIN v_fact_traffic f ON f.ID_MEDIDA_TRAFICO = m.ID_MEDIDA_TRAFICO GROUP BY 1, 2""",
)
def _(inputs: Inputs):
    seen = rollups.count_by(fact_traffic(inputs), "ID_MEDIDA_TRAFICO", "n_valores")
    measures = measure_table(inputs.spark)
    return measures.join(seen, "ID_MEDIDA_TRAFICO", "left").fillna(0, ["n_valores"])


@check(
    "star_join_air",
    "SELECT FECHA, ID_AIRE, COD_DIS, ID_MAGNITUD, ROUND(DATO, 6) AS DATO FROM v_fact_air",
)
def _(inputs: Inputs):
    return fact_air(inputs)


@check(
    "join_points_daily",
    """SELECT FECHA, ID_TRAFICO, COD_DIS, ROUND(INTENSIDAD, 6) AS INTENSIDAD,
              ROUND(OCUPACION, 6) AS OCUPACION, ROUND(CARGA, 6) AS CARGA, ROUND(VMED, 6) AS VMED
       FROM v_traffic_daily""",
)
def _(inputs: Inputs):
    return star.traffic_daily_by_point(silver_traffic(inputs), inputs.view("v_point"))


@check(
    "daily_rollup",
    """SELECT CAST(FECHA AS DATE) AS FECHA, ID_TRAFICO, ROUND(AVG(INTENSIDAD), 6) AS INTENSIDAD
       FROM v_traffic_15m GROUP BY 1, 2""",
)
def _(inputs: Inputs):
    return rollups.daily_rollup(inputs.view("v_traffic_15m"), ["INTENSIDAD"])


@check(
    "fact_traffic_daily",
    """SELECT FECHA, ID_TRAFICO, COD_DIS, ID_MEDIDA_TRAFICO, ROUND(VALOR, 6) AS VALOR
       FROM v_fact_traffic""",
)
def _(inputs: Inputs):
    return fact_traffic(inputs)


@check(
    "left_join_counts",
    """SELECT d.COD_DIS, d.NOMBRE, COALESCE(s.n, 0) AS N FROM v_district d
       LEFT JOIN (SELECT COD_DIS, COUNT(*) n FROM v_station WHERE O3 = 'X' GROUP BY 1) s
       ON s.COD_DIS = d.COD_DIS""",
)
def _(inputs: Inputs):
    counts = rollups.count_by(ozone_stations(inputs), "COD_DIS", "N")
    return inputs.view("v_district").join(counts, "COD_DIS", "left").fillna(0, ["N"])


@check("count_by_district", "SELECT COD_DIS, COUNT(*) AS n FROM v_station GROUP BY 1")
def _(inputs: Inputs):
    return rollups.count_by(inputs.view("v_station"), "COD_DIS", "n")


@check("coverage_flags", "SELECT * FROM v_dim_district")
def _(inputs: Inputs):
    return dim_district(inputs)


@check(
    "summary_kpis",
    """SELECT COUNT(*) AS n_distritos, CAST(SUM(N_ESTACIONES_AIRE) AS BIGINT) AS n_estaciones,
              CAST(SUM(N_PUNTOS_TRAFICO) AS BIGINT) AS n_puntos,
              COUNT(*) FILTER (WHERE NOT COBERTURA_AIRE) AS n_sin_cobertura
       FROM v_dim_district""",
)
def _(inputs: Inputs):
    return dashboard.summary_kpis(dim_district(inputs))


@check(
    "conditional_counts",
    """SELECT COUNT(*) FILTER (WHERE intensidad < 0) AS negativos_intensidad,
              COUNT(*) FILTER (WHERE ocupacion < 0) AS negativos_ocupacion,
              COUNT(*) FILTER (WHERE carga < 0) AS negativos_carga,
              COUNT(*) FILTER (WHERE vmed < 0) AS negativos_vmed FROM v_traffic_bronze""",
)
def _(inputs: Inputs):
    tests = {
        f"negativos_{name}": F.col(name) < 0
        for name in ("intensidad", "ocupacion", "carga", "vmed")
    }
    return rollups.count_where(inputs.view("v_traffic_bronze"), tests)


@check(
    "null_counts",
    """SELECT COUNT(*) FILTER (WHERE intensidad < 0 OR intensidad > 20000) AS INTENSIDAD,
              COUNT(*) FILTER (WHERE ocupacion < 0) AS OCUPACION,
              COUNT(*) FILTER (WHERE carga < 0) AS CARGA,
              COUNT(*) FILTER (WHERE vmed < 0 OR isnan(vmed)) AS VMED FROM v_traffic_bronze""",
)
def _(inputs: Inputs):
    from sensoria.catalogs import TRAFFIC_VARIABLES
    from sensoria.operators.cleaning import rename_uppercase, sentinels_to_null

    upper = rename_uppercase(inputs.view("v_traffic_bronze"), {})
    return rollups.null_counts(sentinels_to_null(upper).select(*TRAFFIC_VARIABLES))


@check(
    "date_coverage",
    """SELECT MIN(CAST(FECHA AS DATE)) AS fecha_min, MAX(CAST(FECHA AS DATE)) AS fecha_max,
              COUNT(DISTINCT CAST(FECHA AS DATE)) AS dias_con_dato,
              CAST(datediff('day', MIN(CAST(FECHA AS DATE)), MAX(CAST(FECHA AS DATE))) + 1
                   AS BIGINT) AS dias_del_rango,
              COUNT(*) AS filas FROM v_traffic""",
)
def _(inputs: Inputs):
    return rollups.date_coverage(silver_traffic(inputs))


@check(
    "distinct_rows",
    """SELECT DISTINCT ID_AIRE, MAGNITUD, FECHA, VALIDEZ FROM v_air""",
)
def _(inputs: Inputs):
    return inputs.view("v_air").select("ID_AIRE", "MAGNITUD", "FECHA", "VALIDEZ").distinct()


@check(
    "latest_per_key",
    """SELECT tipo_elem, id, distrito, nombre, snapshot, seq, latitud, longitud FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY snapshot DESC, seq DESC) AS rn
         FROM v_point_snapshot) WHERE rn = 1""",
    decimals=None,
)
def _(inputs: Inputs):
    return rollups.latest_per_key(
        inputs.view("v_point_snapshot"), ["id"], ["snapshot", "seq"]
    )


@check("dim_punto_trafico", "SELECT * FROM v_dim_point", decimals=None)
def _(inputs: Inputs):
    return dim_point(inputs)


@check(
    "flags_to_rows",
    """SELECT DISTINCT COD_DIS, ID_MAGNITUD, MAGNITUD FROM (
         SELECT COD_DIS, 8 AS ID_MAGNITUD, 'NO2' AS MAGNITUD FROM v_station WHERE NO2 = 'X'
         UNION ALL SELECT COD_DIS, 1, 'SO2' FROM v_station WHERE SO2 = 'X'
         UNION ALL SELECT COD_DIS, 6, 'CO' FROM v_station WHERE CO = 'X'
         UNION ALL SELECT COD_DIS, 10, 'PM10' FROM v_station WHERE PM10 = 'X'
         UNION ALL SELECT COD_DIS, 9, 'PM2.5' FROM v_station WHERE PM2_5 = 'X'
         UNION ALL SELECT COD_DIS, 14, 'O3' FROM v_station WHERE O3 = 'X')""",
)
def _(inputs: Inputs):
    return star.flags_to_rows(star.dim_estacion_aire(inputs.view("v_station")))


@check(
    "group_profile",
    """SELECT COD_DIS, DIRECCION, COUNT(*) AS n, COUNT(NO2) AS "n_NO2" FROM v_station
       GROUP BY 1, 2""",
)
def _(inputs: Inputs):
    return rollups.group_profile(inputs.view("v_station"), ["COD_DIS", "DIRECCION"], "NO2")


@check(
    "union_bounds",
    """SELECT MIN(d) AS f0, MAX(d) AS f1 FROM (
         SELECT FECHA AS d FROM v_air UNION ALL SELECT CAST(FECHA AS DATE) FROM v_traffic)""",
)
def _(inputs: Inputs):
    return star.union_bounds(inputs.view("v_air"), silver_traffic(inputs))


@check(
    "calendar",
    """WITH b AS (SELECT MIN(d) AS f0, MAX(d) AS f1 FROM (
         SELECT FECHA AS d FROM v_air UNION ALL SELECT CAST(FECHA AS DATE) FROM v_traffic)),
       days AS (SELECT UNNEST(generate_series(f0, f1, INTERVAL 1 DAY)) AS d FROM b)
       SELECT CAST(d AS TIMESTAMP) AS FECHA, CAST(year(d) AS BIGINT) AS ANIO,
              CAST(month(d) AS BIGINT) AS MES FROM days""",
)
def _(inputs: Inputs):
    return star.dim_fecha(inputs.view("v_air"), silver_traffic(inputs))


# Integrity checks, on data that does break the rule.


@check(
    "unique_key",
    """SELECT ID_AIRE, MAGNITUD, FECHA, COUNT(*) AS n FROM v_air GROUP BY 1, 2, 3
       HAVING COUNT(*) > 1""",
)
def _(inputs: Inputs):
    return quality.duplicate_keys(inputs.view("v_air"), ["ID_AIRE", "MAGNITUD", "FECHA"])


@check(
    "fk_check",
    """SELECT ID_AIRE, COUNT(*) AS n FROM v_air
       WHERE ID_AIRE NOT IN (SELECT ID_AIRE FROM v_station WHERE NO2 = 'X') GROUP BY 1""",
)
def _(inputs: Inputs):
    measuring = inputs.view("v_station").filter(F.col("NO2").isNotNull())
    return quality.orphan_keys(inputs.view("v_air"), measuring, "ID_AIRE")


@check(
    "schema_contract",
    """SELECT t.columna, t.tipo_real, t.tipo_acordado,
              CASE WHEN t.tipo_real IS NOT NULL THEN c.filas END AS filas,
              CASE t.columna WHEN 'FECHA' THEN c.sin_fecha WHEN 'ID_AIRE' THEN c.sin_estacion
                   WHEN 'DATO' THEN c.sin_dato WHEN 'MAGNITUD' THEN c.sin_gas
                   WHEN 'VALIDEZ' THEN c.sin_validez END AS nulos
       FROM (VALUES ('FECHA', 'date', 'date'), ('ID_AIRE', 'bigint', 'bigint'),
             ('DATO', 'double', 'double'),
             ('ID_MAGNITUD', CAST(NULL AS VARCHAR), 'int'),
             ('COD_DIS', CAST(NULL AS VARCHAR), 'string'),
             ('MAGNITUD', 'string', CAST(NULL AS VARCHAR)),
             ('VALIDEZ', 'string', CAST(NULL AS VARCHAR))) t(columna, tipo_real, tipo_acordado),
            (SELECT COUNT(*) AS filas, COUNT(*) - COUNT(FECHA) AS sin_fecha,
                    COUNT(*) - COUNT(ID_AIRE) AS sin_estacion, COUNT(*) - COUNT(DATO) AS sin_dato,
                    COUNT(*) - COUNT(MAGNITUD) AS sin_gas, COUNT(*) - COUNT(VALIDEZ) AS sin_validez
             FROM v_air) c""",
)
def _(inputs: Inputs):
    return quality.contract_report(inputs.view("v_air"), quality.CONTRACT["fact_calidad_aire"])


@check(
    "fact_grain",
    """SELECT FECHA, COD_DIS, ID_MAGNITUD, COUNT(*) AS n FROM v_fact_air GROUP BY 1, 2, 3
       HAVING COUNT(*) > 1""",
)
def _(inputs: Inputs):
    return quality.duplicate_keys(fact_air(inputs), ["FECHA", "COD_DIS", "ID_MAGNITUD"])
