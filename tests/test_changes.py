"""Gold by change: only months with changes are written, and the tables equal a full rebuild."""

import os
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sensoria.plans import changes
from sensoria.plans.ingest import load_period, load_snapshot
from sensoria.sources.schemas import TRAFFIC
from tests.test_geo import polygon_bytes
from tests.test_pipeline import EAST, IN_WEST, WEST

POINT = "id bigint, distrito string, nombre string, latitud double, longitud double"
TABLES = [
    ("silver", "aire"), ("silver", "trafico"), ("silver", "estaciones_aire"), ("gold", "dim_fecha"),
    ("gold", "dim_punto_trafico"), ("gold", "dim_distrito"), ("gold", "fact_calidad_aire"),
    ("gold", "fact_trafico_diario"), ("gold", "cobertura"),
]


def traffic(spark, *rows):
    data = [(i, t, "URB", v, 1.0, 2.0, 3.0, "N", 15) for i, t, v in rows]
    return spark.createDataFrame(data, TRAFFIC)


def air(spark, year, months, value=1.0):
    days = ", ".join(f"D{d:02d} double, V{d:02d} string" for d in range(1, 32))
    cells = [value, "V"] * 31
    return spark.createDataFrame(
        [(4, 8, year, month, *cells) for month in months],
        f"ESTACION bigint, MAGNITUD int, ANO int, MES int, {days}",
    )


def points(spark, *rows):
    return spark.createDataFrame([(i, d, f"P{i}", *IN_WEST) for i, d in rows], POINT)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    lake = changes.MonthlyLakehouse(spark, str(tmp_path_factory.mktemp("base")))
    shapes = [(1, "01", "Oeste", bytearray(polygon_bytes([WEST]))), (2, "02", "Este", bytearray(polygon_bytes([EAST])))]
    kind = "COD_DIS int, COD_DIS_TX string, NOMBRE string, geometry binary"
    load_snapshot(lake, "distritos", spark.createDataFrame(shapes, kind), "d")
    stations = spark.createDataFrame(
        [(4, "Plaza", "Calle 1", *IN_WEST, "X")],
        "CODIGO_CORTO bigint, ESTACION string, DIRECCION string, LATITUD double, LONGITUD double, NO2 string",
    ).withColumns({flag: F.lit(None).cast("string") for flag in ("SO2", "CO", "PM10", "PM2_5", "O3", "BTX")})
    load_snapshot(lake, "estaciones_aire", stations.withColumn("Fecha alta", F.lit(date(2000, 1, 1))), "e")
    load_period(lake, "aire", "2023", air(spark, 2023, [11, 12]), "a")
    load_period(lake, "aire", "2024", air(spark, 2024, [1]), "a")
    load_period(lake, "trafico_puntos_medida", "2024-01", points(spark, (1, "1"), (2, "2")), "p")
    # one reading of the file of January is of February
    january = [(1, datetime(2024, 1, 5, 8), 10.0), (2, datetime(2024, 1, 6, 8), 20.0), (1, datetime(2024, 2, 1), 5.0)]
    load_period(lake, "trafico", "2024-01", traffic(spark, *january), "t")
    load_period(lake, "trafico", "2024-03", traffic(spark, (1, datetime(2024, 3, 5, 8), 7.0)), "t")
    changes.rebuild(lake)
    return lake


@pytest.fixture
def lake(base, tmp_path):
    shutil.copytree(base.root, tmp_path / "lake")
    return changes.MonthlyLakehouse(base.spark, str(tmp_path / "lake"))


def files(lake, layer, name):
    root = lake.path(layer, name)
    return {
        folder: sorted(name for name in os.listdir(os.path.join(root, folder)) if name.endswith(".parquet"))
        for folder in os.listdir(root) if folder.startswith(changes.MONTH)
    }


def written(before, after):
    return {int(k.split("=")[1]) for k in before.keys() | after.keys() if before.get(k) != after.get(k)}


def contents(lake):
    return {
        name: sorted(map(str, lake.table(layer, name).select(*sorted(lake.table(layer, name).columns)).collect()))
        for layer, name in TABLES
    }


def assert_equals_a_rebuild(lake, tmp_path):
    other = changes.MonthlyLakehouse(lake.spark, str(tmp_path / "other"))
    shutil.copytree(lake.path("bronze", ""), other.path("bronze", ""))
    changes.rebuild(other)
    assert contents(lake) == contents(other)


def test_nothing_loaded_nothing_built(lake):
    before = files(lake, "silver", "trafico")
    assert changes.apply(lake) == {}
    assert files(lake, "silver", "trafico") == before


def test_a_new_month_writes_only_its_own_files(lake, spark, tmp_path):
    kinds = [("silver", "trafico"), ("gold", "fact_trafico_diario"), ("silver", "aire"), ("gold", "fact_calidad_aire")]
    before = {kind: files(lake, *kind) for kind in kinds}
    load_period(lake, "trafico", "2024-04", traffic(spark, (2, datetime(2024, 4, 9, 8), 3.0)), "t")
    assert changes.apply(lake) == {"trafico": {202404}}
    changed = {kind: written(before[kind], files(lake, *kind)) for kind in kinds}
    assert list(changed.values()) == [{202404}, {202404}, set(), set()]
    assert_equals_a_rebuild(lake, tmp_path)
    assert changes.apply(lake) == {}


def test_a_period_loaded_again_gives_up_its_old_months(lake, spark, tmp_path):
    # the reading of February was in the file of January and is not any more
    load_period(lake, "trafico", "2024-01", traffic(spark, (1, datetime(2024, 1, 5, 9), 11.0)), "t")
    load_period(lake, "aire", "2024", air(spark, 2024, [1, 2], 9.0), "a")
    assert changes.apply(lake) == {"trafico": {202401, 202402}, "aire": {202401, 202402}}
    assert {r[0] for r in lake.silver("trafico").select(F.month("FECHA")).collect()} == {1, 3}
    assert_equals_a_rebuild(lake, tmp_path)


def test_an_emptied_period_and_readings_without_a_day(lake, spark, tmp_path):
    nothing = traffic(spark, (1, datetime(2024, 3, 5), 1.0)).filter(F.rand() < 0)
    load_period(lake, "trafico", "2024-03", nothing, "t")
    load_period(lake, "trafico", "2024-04", traffic(spark, (1, datetime(2024, 4, 1), 2.0), (1, None, 2.0)), "t")
    assert changes.apply(lake) == {"trafico": {202403, 202404, changes.NO_MONTH}}
    assert lake.silver("trafico").filter("FECHA IS NULL").count() == 1


def test_a_moved_sensor_takes_its_months_along(lake, spark, tmp_path):
    load_period(lake, "trafico_puntos_medida", "2024-02", points(spark, (1, "1"), (2, "1"), (3, "1")), "p")
    assert changes.apply(lake) == {"trafico": {202401}}
    assert {r.COD_DIS for r in lake.gold("fact_trafico_diario").collect()} == {"01"}
    assert_equals_a_rebuild(lake, tmp_path)


def test_a_first_run_needs_a_rebuild(spark, tmp_path):
    lake = changes.MonthlyLakehouse(spark, str(tmp_path / "new"))
    load_period(lake, "trafico", "2024-01", traffic(spark, (1, datetime(2024, 1, 5), 1.0)), "t")
    with pytest.raises(ValueError, match="rebuild"):
        changes.apply(lake)
