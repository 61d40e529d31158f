"""Bronze to gold on a small lake written by hand."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sensoria.operators import quality
from sensoria.plans import dashboard, medallion, reads
from sensoria.sources.tables import Lakehouse
from tests.test_geo import polygon_bytes

# Two districts of 1 km in UTM metres, side by side.
WEST = [(440000.0, 4474000.0), (441000.0, 4474000.0), (441000.0, 4475000.0), (440000.0, 4475000.0)]
EAST = [(x + 1000, y) for x, y in WEST]
IN_WEST = (40.4187, -3.7015)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lakehouse(spark, str(tmp_path_factory.mktemp("lake")))
    lake.write(
        "bronze",
        "distritos",
        spark.createDataFrame(
            [
                (1, "01", "Oeste", bytearray(polygon_bytes([WEST]))),
                (2, "02", "Este", bytearray(polygon_bytes([EAST]))),
            ],
            "COD_DIS int, COD_DIS_TX string, NOMBRE string, geometry binary",
        ),
    )
    stations = [
        (4, "Plaza", "Calle 1", *IN_WEST, "X", None),
        (8, "Mar", "Calle 2", 36.0, -3.7, "X", "X"),
        (9, "Lejos", "Calle 3", 40.9, -3.7, None, None),
    ]
    lake.write(
        "bronze",
        "estaciones_aire",
        spark.createDataFrame(
            stations,
            "CODIGO_CORTO bigint, ESTACION string, DIRECCION string, LATITUD double, "
            "LONGITUD double, NO2 string, BTX string",
        )
        .withColumns(
            {flag: F.lit(None).cast("string") for flag in ("SO2", "CO", "PM10", "PM2_5", "O3")}
        )
        .withColumn("Fecha alta", F.lit(date(2000, 1, 1))),
    )
    days = ", ".join(f"D{d:02d} double, V{d:02d} string" for d in range(1, 32))
    cells = [part for d in range(1, 32) for part in ((float(d), "V") if d < 31 else (0.0, "N"))]
    lake.write(
        "bronze",
        "aire",
        spark.createDataFrame(
            [(4, 8, 2024, 4, *cells), (4, 8, 2024, 4, *cells), (77, 8, 2024, 4, *cells)],
            f"ESTACION bigint, MAGNITUD int, ANO int, MES int, {days}",
        ),
    )
    at = datetime(2024, 4, 10, 12)
    readings = [(1, at, 10.0), (1, at.replace(hour=13), 30.0), (1, at, -1.0), (5, at, 50.0)]
    lake.write(
        "bronze",
        "trafico",
        spark.createDataFrame(
            [(i, t, "URB", v, 1.0, 2.0, 3.0, "N", 15, 2024, 4) for i, t, v in readings],
            "id bigint, fecha timestamp_ntz, tipo_elem string, intensidad double, "
            "ocupacion double, carga double, vmed double, error string, "
            "periodo_integracion int, year int, month int",
        ),
    )
    points = [
        (1, "9", "Viejo", *IN_WEST, 2023, 12),
        (1, "1", "Nuevo", *IN_WEST, 2024, 1),
        (2, "2", "Mar", 36.0, -3.7, 2024, 1),
        (3, None, "Sin", *IN_WEST, 2024, 1),
    ]
    lake.write(
        "bronze",
        "trafico_puntos_medida",
        spark.createDataFrame(
            points,
            "id bigint, distrito string, nombre string, latitud double, longitud double, "
            "year int, month int",
        ),
    )
    for _ in range(2):  # idempotent
        medallion.run(lake)
    return lake


def test_silver(lake):
    assert lake.silver("aire").count() == 60
    stations = {r.ID_AIRE: (r.COD_DIS, r.NOMBRE) for r in lake.silver("estaciones_aire").collect()}
    assert stations == {4: ("01", "Oeste"), 9: (None, None)}
    assert "FECHA_ALTA" in lake.silver("estaciones_aire").columns
    assert lake.silver("trafico").count() == 3
    assert "YEAR" not in lake.silver("trafico").columns


def test_dimensions(lake):
    points = [tuple(r) for r in lake.gold("dim_punto_trafico").collect()]
    assert points == [(1, "01", "Nuevo", *IN_WEST)]
    districts = {r.COD_DIS: r for r in lake.gold("dim_distrito").collect()}
    assert districts["01"].COBERTURA_AIRE and not districts["02"].COBERTURA_AIRE
    assert districts["02"].N_PUNTOS_TRAFICO == 0
    gases = [tuple(r) for r in lake.gold("dim_distrito_magnitud").collect()]
    assert gases == [("01", 8, "NO2")]
    assert lake.gold("dim_fecha").count() == 30
    shapes = {r.COD_DIS: r for r in lake.gold("dim_geometria").collect()}
    assert shapes["01"].GEOMETRY_WKT.startswith("POLYGON ((-3.7")
    assert shapes["01"].CENTROID_LON < shapes["02"].CENTROID_LON


def test_facts(lake):
    air = lake.gold("fact_calidad_aire")
    assert air.count() == 30  # station 77 is unknown
    traffic = {r.ID_MEDIDA_TRAFICO: r.VALOR for r in lake.gold("fact_trafico_diario").collect()}
    assert traffic == {1: 20.0, 2: 1.0, 3: 2.0, 4: 3.0}


def test_reads(lake):
    air, stations = lake.silver("aire"), lake.silver("estaciones_aire")
    means = reads.district_monthly_air(air, stations, "NO2", 2024, 4).collect()
    assert [tuple(r) for r in means] == [("01", 15.5)]
    assert reads.district_monthly_air(air, stations, "NO2", 2024, 12).count() == 0
    traffic, points = lake.silver("trafico"), lake.gold("dim_punto_trafico")
    noon = reads.daily_traffic_by_district_noon(traffic, points, "intensidad", "01").collect()
    assert [tuple(r) for r in noon] == [(date(2024, 4, 10), 10.0)]
    assert reads.traffic_periods(traffic, points, "VMED", "99").count() == 0
    assert [r[0] for r in reads.stations(air).collect()] == ["4", "77"]
    assert dashboard.daily_table(air, None, "NO2").count() == 0
    assert dashboard.daily_table(air, "4", "NO2").count() == 30
    kpi = dashboard.kpi_mean(reads.district_monthly_air(air, stations, "NO2", 2024, 4), "02")
    assert kpi.first().valor is None
    layer = dashboard.position_layer(stations, points, "01").collect()
    assert sorted((r.kind, r.id) for r in layer) == [("estacion", 4), ("estacion", 9), ("punto", 1)]
    assert {r.id: r.distrito for r in layer} == {4: "01", 9: None, 1: "01"}


def test_dashboard(lake):
    shown = dashboard.SensorTables.of(lake)
    assert [r[0] for r in dashboard.district_options(shown, "Aire", "NO2").collect()] == ["01"]
    assert [r[0] for r in dashboard.district_options(shown, "Aire", "O3").collect()] == ["01"]
    assert dashboard.variable_options(shown, "Trafico").count() == 4
    assert dashboard.variable_options(shown, "Aire", "02").count() == 5
    assert [r[0] for r in dashboard.year_options(shown, "Aire", "NO2", "01").collect()] == [2024]
    assert dashboard.year_options(shown, "Aire", None, "01").count() == 5
    months = dashboard.month_options(shown, "Trafico", "CARGA", "01", "2024").collect()
    assert [r[0] for r in months] == [4]
    parts = dashboard.overview(shown, "Aire", "NO2", "01", 2024, 4)
    assert [r.etiqueta for r in parts["legend"].orderBy("orden").collect()] == [
        "0 - 90", "90 - 120", "120 - 230", "230+",
    ]
    colors = {r.COD_DIS: (r.color, r.valor_texto) for r in parts["map"].collect()}
    assert colors == {"01": ("green", "15.5"), "02": ("lightgray", "N/A")}
    places = {r.COD_DIS: (r.CENTROID_LAT, r.CENTROID_LON) for r in parts["map"].collect()}
    assert places["01"] == pytest.approx(IN_WEST, abs=0.01)
    assert places["01"][1] < places["02"][1]
    assert tuple(parts["counts"].first()) == (1, 1)
    assert parts["mean"].first().valor == 15.5
    assert parts["evolution"].count() == 30
    assert dashboard.overview(shown, "Trafico", "CARGA", "01", 2024, 4)["evolution"].count() == 1
    parts = dashboard.summary(shown)
    assert tuple(parts["kpis"].first()) == (2, 1, 1, 1)
    assert parts["positions"].count() == 2
    assert {r.NOMBRE: r.cobertura for r in parts["table"].collect()} == {
        "Oeste": "With coverage", "Este": "No coverage",
    }


@pytest.mark.parametrize("name", ["x", "INTENSIDAD; DROP", ""])
def test_unknown_traffic_variable(lake, name):
    with pytest.raises(ValueError):
        reads.monthly_average_traffic(lake.silver("trafico"), 1, name)


def test_text_parameters_are_values(lake):
    assert reads.magnitudes(lake.silver("aire"), 4).count() == 1
    assert reads.daily_values(lake.silver("aire"), 4, "NO2' OR '1'='1").count() == 0
    with pytest.raises(ValueError):
        reads.daily_values(lake.silver("aire"), "4 OR 1=1", "NO2")


def test_checks_find_violations(lake):
    air = lake.gold("fact_calidad_aire")
    quality.require_none(quality.duplicate_keys(air, ["FECHA"]), "fine")
    with pytest.raises(quality.IntegrityError, match="grain"):
        quality.require_none(
            quality.duplicate_keys(air.union(air), ["FECHA"]), "grain"
        )
    stations = lake.gold("dim_estacion_aire")
    assert quality.orphan_keys(lake.silver("aire"), stations, "ID_AIRE").count() == 1
    drift = quality.schema_drift(air.drop("DATO"), quality.CONTRACT["fact_calidad_aire"])
    assert [tuple(r) for r in drift.collect()] == [("DATO", None, "double")]


def test_forecast_command_needs_enough_history(lake):
    from sensoria.plans.forecast import run

    with pytest.raises(ValueError, match="O3"):
        run.main(lake.root, "1", "O3")
    with pytest.raises(ValueError, match="within"):
        run.main(lake.root, "13")


def test_staged_tables_go_after_the_last_write(spark, tmp_path):
    import os

    from sensoria.session import cut_lineage, staging

    with staging(spark):
        staged = cut_lineage(spark.range(5))
        path = staged.inputFiles()[0].removeprefix("file:").removeprefix("//")
        staged.write.parquet(str(tmp_path / "out"))
        assert os.path.exists(path)
    assert not os.path.exists(path)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_targets_and_references(lake, spark):
    with pytest.raises(ValueError, match="gold"):
        medallion.run(lake, targets=["gold"])
    medallion.run(lake, targets=["facts"])
    facts = lake.gold("fact_calidad_aire")
    dims = {column: lake.gold(name) for column, name in quality.FOREIGN_KEYS["fact_calidad_aire"].items()}
    assert quality.unknown_references(facts, dims).count() == 0
    strange = facts.withColumns({"ID_AIRE": F.lit(99).cast("bigint"), "COD_DIS": F.lit(None).cast("string")})
    found = quality.unknown_references(strange, dims).collect()
    assert [(r.columna, r.valor, r.n) for r in found] == [("ID_AIRE", "99", facts.count())]


def test_coverage_replaces_the_readings(lake, spark):
    from sensoria.plans import coverage

    stations, points = lake.silver("estaciones_aire"), lake.gold("dim_punto_trafico")
    districts = lake.gold("dim_distrito")
    shown = coverage.selector_tables(coverage.read(lake), stations, points, districts)
    exact = dashboard.SensorTables.of(lake)
    for domain, variable, district in (("Aire", "NO2", "01"), ("Trafico", "CARGA", "01"), ("Aire", "EBE", "02")):
        for options in (
            lambda t: dashboard.year_options(t, domain, variable, district),
            lambda t: dashboard.month_options(t, domain, variable, district, 2024),
            lambda t: dashboard.district_options(t, domain, variable),
            lambda t: dashboard.variable_options(t, domain, district),
        ):
            assert options(shown).collect() == options(exact).collect()
    plan = dashboard.year_options(shown, "Aire", "NO2", "01")._jdf.queryExecution().optimizedPlan().toString()
    assert "VALIDEZ" not in plan and "DATO" not in plan


def test_selectors_do_without_outlines(lake):
    exact = dashboard.SensorTables.of(lake)
    shown = dashboard.SensorTables(exact.air, exact.stations, exact.traffic, exact.points, exact.districts)
    for options in (
        lambda t: dashboard.year_options(t, "Aire", "NO2", "01"),
        lambda t: dashboard.district_options(t, "Aire", "NO2"),
    ):
        assert options(shown).collect() == options(exact).collect()
    with pytest.raises(ValueError, match="outlines"):
        dashboard.overview(shown, "Aire", "NO2", "01", 2024, 1)


def test_selector_tables_have_no_outlines(lake):
    from sensoria.plans import coverage

    exact = dashboard.SensorTables.of(lake)
    shown = coverage.selector_tables(coverage.read(lake), exact.stations, exact.points, exact.districts)
    assert shown.outlines is None
    assert dashboard.district_options(shown, "Aire", "NO2").collect()
    with pytest.raises(ValueError, match="outlines"):
        dashboard.overview(shown, "Aire", "NO2", "01", 2024, 1)


def test_coverage_of_one_month(spark, tmp_path):
    from sensoria.plans import coverage

    lake = Lakehouse(spark, str(tmp_path / "lake"))
    kind = "ID_AIRE bigint, MAGNITUD string, FECHA date, DATO double, VALIDEZ string"
    rows = [(1, "NO2", date(2024, m, d), 1.0, "V") for m in (1, 2) for d in (3, 9)] + [(1, "O3", date(2024, 1, 5), 1.0, "N")]
    air = spark.createDataFrame(rows, kind)
    months = [(2024, 1), (2024, 2)]
    coverage.replace_months(lake, "aire", air, months)
    before = sorted(coverage.read(lake).collect())
    assert [(r.mes, r.filas, r.primer_dia.day, r.ultimo_dia.day) for r in sorted(before, key=lambda r: r.mes)] == [(1, 2, 3, 9), (2, 2, 3, 9)]
    coverage.replace_months(lake, "aire", air, months)
    assert sorted(coverage.read(lake).collect()) == before
    coverage.add_load(lake, "aire", spark.createDataFrame([(1, "NO2", date(2024, 2, 28), 2.0, "V")], kind))
    february = coverage.read(lake).where("mes = 2").first()
    assert (february.filas, february.ultimo_dia) == (3, date(2024, 2, 28))
    coverage.replace_months(lake, "aire", air.where("MONTH(FECHA) = 2"), months)
    assert [r.mes for r in coverage.read(lake).collect()] == [2]
    with pytest.raises(ValueError):
        coverage.coverage_of("otro", air)
