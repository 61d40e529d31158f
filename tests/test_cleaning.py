import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sensoria.catalogs import GAS_LABELS
from sensoria.functions import codes, dates
from sensoria.operators import bands, cleaning, reshape, rollups


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_pad_code(spark):
    df = spark.createDataFrame([("9",), ("09",), ("x",), (None,), ("12",)], "c string")
    padded = [row[0] for row in df.select(codes.pad_code(F.col("c"))).collect()]
    assert padded == ["09", "09", None, None, "12"]


def test_label_of_unknown_code_is_its_text(spark):
    df = spark.createDataFrame([(8,), (9,), (431,), (99,), (None,)], "c int")
    labels = [row[0] for row in df.select(codes.label_of(F.col("c"), GAS_LABELS)).collect()]
    assert labels == ["NO2", "PM2.5", "MPX", "99", None]


def test_sentinels(spark):
    values = [-1.0, math.nan, None, 20000.0, 20000.01, 0.0]
    df = spark.createDataFrame([(v, v) for v in values], "INTENSIDAD double, CARGA double")
    clean = cleaning.sentinels_to_null(df).collect()
    assert [r.INTENSIDAD for r in clean] == [None, None, None, 20000.0, None, 0.0]
    assert [r.CARGA for r in clean] == [None, None, None, 20000.0, 20000.01, 0.0]


def _traffic(spark, data):
    return spark.createDataFrame(
        data,
        "id bigint, fecha timestamp_ntz, tipo_elem string, intensidad double, "
        "ocupacion double, carga double, vmed double, error string, "
        "periodo_integracion int, nuevo string",
    )


def test_clean_traffic(spark):
    at = datetime(2024, 1, 1, 12)
    good = (1, at, "URB", 10.0, 1.0, 2.0, 30.0, "N", 15, "z")
    bronze = _traffic(
        spark,
        [
            good,
            good,
            (2, at, "URB", -1.0, 1.0, 2.0, 30.0, "N", 15, "z"),
            (3, at, "URB", 10.0, math.nan, 2.0, 30.0, "N", 15, "z"),
            (4, at, "URB", 10.0, 1.0, None, 30.0, "N", 15, "z"),
            (5, at, "URB", 10.0, 1.0, 2.0, 30.0, "E", 15, "z"),
            (6, at, "URB", 30000.0, 1.0, 2.0, 30.0, "N", 15, "z"),
        ],
    )
    silver = cleaning.clean_traffic(bronze)
    assert silver.columns == [
        "ID_TRAFICO", "FECHA", "TIPO_ELEM", "INTENSIDAD", "OCUPACION", "CARGA", "VMED",
        "ERROR", "PERIODO_INTEGRACION", "NUEVO",
    ]
    assert [r.ID_TRAFICO for r in silver.collect()] == [1]


def _wide(spark, months):
    """Wide rows whose day d reads d + 0.5; days outside the month are padding."""
    data = []
    for year, month, last in months:
        cells = []
        for day in range(1, 32):
            cells += [day + 0.5, "V"] if day <= last else [0.0, "N"]
        data.append((4, 8, year, month, *cells))
    columns = ", ".join(f"D{d:02d} double, V{d:02d} string" for d in range(1, 32))
    return spark.createDataFrame(
        data, f"ESTACION bigint, MAGNITUD int, ANO int, MES int, {columns}"
    )


def test_unpivot_follows_the_real_calendar(spark):
    wide = _wide(spark, [(2024, 4, 30), (2023, 2, 28), (2024, 2, 29)])
    silver = reshape.unpivot_air(wide)
    assert silver.columns == ["ID_AIRE", "MAGNITUD", "FECHA", "DATO", "VALIDEZ"]
    days = [r.FECHA for r in silver.collect()]
    assert len(days) == 30 + 28 + 29
    assert max(days) == date(2024, 4, 30) and date(2024, 2, 29) in days


def test_padding_is_dropped_even_if_marked_valid(spark):
    wide = _wide(spark, [(2024, 4, 30)]).withColumn("V31", F.lit("V"))
    assert reshape.unpivot_air(wide).count() == 30


def test_wide_round_trip(spark):
    wide = _wide(spark, [(2024, 4, 30), (2024, 2, 29)])
    long = reshape.days_to_rows(wide, ["ESTACION", "MAGNITUD"])
    again = reshape.rows_to_days(long, ["ESTACION", "MAGNITUD"])
    assert rows(again.select(*wide.columns)) == rows(wide)


def test_unpivot_measures_drops_nulls(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None, 3.0, 4.0)],
        "k int, INTENSIDAD double, OCUPACION double, CARGA double, VMED double",
    )
    found = rows(reshape.measures_to_rows(df, ["k"]))
    assert found == [(1, "CARGA", 3.0), (1, "INTENSIDAD", 1.0), (1, "VMED", 4.0)]


def test_period_label(spark):
    df = spark.createDataFrame([("2024-01",), ("2025-12",)], "m string")
    labels = [r[0] for r in df.select(dates.period_label(F.col("m"))).collect()]
    assert labels == ["Enero 2024", "Diciembre 2025"]


def test_weekday_and_weekend(spark):
    df = spark.createDataFrame([(date(2024, 6, 30),), (date(2024, 7, 1),)], "d date")
    found = df.select(dates.weekday(F.col("d")), dates.is_weekend(F.col("d"))).collect()
    assert [tuple(r) for r in found] == [(0, 1), (1, 0)]


def test_months_ahead(spark):
    df = spark.createDataFrame([(date(2023, 11, 30),), (date(2023, 12, 31),)], "d date")
    days = [r[0] for r in df.select(dates.months_ahead_in_days(F.col("d"), 2)).collect()]
    assert days == [61, 60]  # to 30 January and to 29 February


def test_run_names(spark):
    names = [("pred_NO2_12m",), ("pred_PM2.5_1m",), ("pred_a_b_3m",), ("other",)]
    df = spark.createDataFrame(names, "n string")
    found = df.select(codes.run_gas(F.col("n")), codes.run_months(F.col("n"))).collect()
    assert [tuple(r) for r in found] == [("NO2", 12), ("PM2.5", 1), ("a_b", 3), (None, None)]


@pytest.mark.parametrize(
    "variable, value, color",
    [
        ("NO2", 0.0, "green"), ("NO2", 89.99, "green"), ("NO2", 90.0, "yellow"),
        ("NO2", 120.0, "orange"), ("NO2", 230.0, "red"), ("NO2", -0.1, "gray"),
        ("NO2", None, "lightgray"), ("EBE", 5.0, "gray"), ("EBE", None, "lightgray"),
        ("VMED", 0.0, "red"), ("VMED", 60.0, "green"), ("CARGA", 75.0, "red"),
    ],
)
def test_color_bands(spark, variable, value, color):
    df = spark.createDataFrame([(variable, value)], "variable string, v double")
    assert bands.color_band(df, "variable", "v").first().color == color
    assert df.select(bands.color_of(F.col("v"), variable)).first()[0] == color


def test_latest_per_key_sends_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, 2, "b"), (1, 1, "c"), (2, None, "d")], "k int, o int, v string"
    )
    found = {r.k: r.v for r in rollups.latest_per_key(df, ["k"], ["o"]).collect()}
    assert found == {1: "b", 2: "d"}


def test_date_coverage_shows_gaps(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1),), (date(2024, 1, 1),), (date(2024, 1, 5),)], "FECHA date"
    )
    row = rollups.date_coverage(df).first()
    assert (row.dias_con_dato, row.dias_del_rango, row.filas) == (2, 5, 3)


def test_not_a_number_is_no_data(spark):
    from pyspark.sql import functions as F

    from sensoria.catalogs import COLOR_NO_DATA
    from sensoria.operators.bands import color_band, color_of

    df = spark.createDataFrame([("NO2", float("nan")), ("NO2", None)], "v string, x double")
    assert {r.color for r in color_band(df, "v", "x").collect()} == {COLOR_NO_DATA}
    assert {r.c for r in df.select(color_of(F.col("x"), "NO2").alias("c")).collect()} == {COLOR_NO_DATA}
