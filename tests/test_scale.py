"""Plan shapes and skew: what has to hold when the tables are large."""

import random
import re
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from sensoria.operators import rollups, star
from sensoria.operators.bands import color_band
from sensoria.operators.cleaning import clean_traffic
from sensoria.operators.reshape import unpivot_air
from sensoria.plans import reads
from sensoria.plans.forecast import features as ft


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """One station holds a third of 9,000 readings."""
    chance = random.Random(5)
    data = []
    for i in range(9000):
        station = 1 if i % 3 == 0 else chance.randrange(2, 60)
        day = date(2024, 1, 1) + timedelta(days=chance.randrange(60))
        data.append((station, "NO2", day, float(chance.randrange(100)), "V"))
    air = spark.createDataFrame(
        data, "ID_AIRE bigint, MAGNITUD string, FECHA date, DATO double, VALIDEZ string"
    )
    sensors = spark.createDataFrame(
        [(s, f"{s % 4:02d}") for s in range(50)], "ID_AIRE bigint, COD_DIS string"
    )
    return data, air.cache(), sensors


def brute_force(data, month):
    groups = defaultdict(list)
    for station, _, day, value, _ in data:
        if station < 50 and day.month == month:
            groups[f"{station % 4:02d}"].append(value)
    return {k: sum(v) / len(v) for k, v in groups.items()}


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_skewed_means_match_brute_force(spark, skewed, threshold):
    data, air, sensors = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = reads.district_monthly_air(air, sensors, "NO2", 2024, 2).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert {r.COD_DIS: r.valor_medio for r in found} == pytest.approx(brute_force(data, 2))


def test_readings_are_reduced_before_the_join(skewed):
    _, air, sensors = skewed
    plan = plan_of(reads.district_monthly_air(air, sensors, "NO2", 2024, 2))
    join = plan.index("Join")
    assert "partial_sum(DATO" in plan[join:]


def test_latest_per_key_needs_no_window(spark, skewed):
    _, air, _ = skewed
    plan = plan_of(rollups.latest_per_key(air, ["ID_AIRE"], ["FECHA", "DATO"]))
    assert "Window" not in plan and "partial_max(" in plan


def test_month_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "air")
    spark.range(10).select(
        F.col("id").alias("ID_AIRE"), F.lit("NO2").alias("MAGNITUD"),
        F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("FECHA"),
        F.lit(1.0).alias("DATO"), F.lit("V").alias("VALIDEZ"), F.lit("x").alias("EXTRA"),
    ).write.parquet(path)
    sensors = spark.createDataFrame([(1, "01")], "ID_AIRE bigint, COD_DIS string")
    query = reads.district_monthly_air(spark.read.parquet(path), sensors, "NO2", 2024, 1)
    scan = [line for line in plan_of(query).splitlines() if "FileScan" in line][0]
    full = re.sub(r"\s+", " ", scan)
    assert "GreaterThanOrEqual(FECHA,2024-01-01)" in full and "LessThan(FECHA" in full
    assert "EXTRA" not in full


def test_wide_table_is_read_once(spark, tmp_path):
    days = ", ".join(f"D{d:02d} double, V{d:02d} string" for d in range(1, 32))
    path = str(tmp_path / "wide")
    spark.createDataFrame(
        [], f"ESTACION bigint, MAGNITUD int, ANO int, MES int, X int, {days}"
    ).write.parquet(path)
    assert plan_of(unpivot_air(spark.read.parquet(path))).count("FileScan") == 1


def test_distinct_filters_first(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(
        [],
        "id bigint, fecha timestamp_ntz, tipo_elem string, intensidad double, ocupacion double, "
        "carga double, vmed double, error string, periodo_integracion int",
    ).write.parquet(path)
    plan = plan_of(clean_traffic(spark.read.parquet(path)))
    assert plan.index("Exchange") < plan.index("Filter")
    assert "EqualTo(error,N)" in plan


def test_bands_join_by_broadcast(skewed):
    plan = plan_of(color_band(skewed[1], "MAGNITUD", "DATO"))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_features_shuffle_once_per_need(spark, skewed):
    _, air, sensors = skewed
    hist = air.join(sensors, "ID_AIRE").select(
        F.col("MAGNITUD").alias("gas"), F.col("ID_AIRE").alias("estacion"),
        F.col("COD_DIS").alias("cod_dis"), F.col("FECHA").alias("fecha"),
        F.col("DATO").alias("dato"),
    )
    plan = plan_of(ft.feature_table(hist, 7))
    assert plan.count("Window [") == 1
    assert "SortMergeJoin" not in plan


def test_fact_keeps_every_reading_of_a_hot_station(spark, skewed):
    data, air, sensors = skewed
    gases = spark.createDataFrame([(8, "NO2")], "ID_MAGNITUD int, MAGNITUD string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = star.fact_calidad_aire(air, sensors, gases).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert found == sum(row[0] < 50 for row in data)


def test_a_hot_station_is_split_in_the_row_level_join(spark, skewed, tmp_path):
    data, air, sensors = skewed
    path = str(tmp_path / "air")
    air.repartition(8).write.parquet(path)
    gases = spark.createDataFrame([(8, "NO2")], "ID_MAGNITUD int, MAGNITUD string")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.files.openCostInBytes": "100MB",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        silver = spark.read.parquet(path)
        fact = silver.join(sensors.select("ID_AIRE", "COD_DIS"), "ID_AIRE")
        assert fact.count() == sum(row[0] < 50 for row in data)
        fact.collect()
        assert "skew=true" in plan_of(fact)
        assert star.fact_calidad_aire(silver, sensors, gases).count() == fact.count()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_one_district_reads_are_cut_below_the_aggregation(spark):
    from sensoria.plans import reads

    air = spark.createDataFrame([], "ID_AIRE int, FECHA timestamp, MAGNITUD string, VALIDEZ string, DATO double")
    stations = spark.createDataFrame([], "ID_AIRE int, COD_DIS string")
    plan = reads.daily_air_by_district(air, stations, "NO2", "19")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    assert any("Aggregate" in line for line in lines[:semi])
    assert not any("Aggregate" in line for line in lines[semi:])
