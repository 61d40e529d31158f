"""Fixed values of the data contract.

Everything in this module is a published code, label, unit or threshold of the
source data.  They are fixed values and are listed in their natural order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sensoria.session import literal_table

# Official gas codes and labels.
GAS_LABELS = {
    1: "SO2",
    6: "CO",
    7: "NO",
    8: "NO2",
    9: "PM2.5",
    10: "PM10",
    12: "NOx",
    14: "O3",
    20: "TOL",
    30: "BEN",
    35: "EBE",
    37: "MXY",
    38: "PXY",
    39: "OXY",
    42: "TCH",
    43: "CH4",
    44: "NMHC",
    431: "MPX",
}

# Traffic measures with their surrogate ids.
TRAFFIC_MEASURES = {1: "INTENSIDAD", 2: "OCUPACION", 3: "CARGA", 4: "VMED"}
TRAFFIC_VARIABLES = tuple(TRAFFIC_MEASURES.values())

# Fixed value: plausibility cap of INTENSIDAD in vehicles per hour.
INTENSITY_CAP = 20000

# The station table's flag columns, and the gas each one stands
# for.  BTX covers six gases at once, so it points at no single code.
STATION_FLAGS = ("NO2", "SO2", "CO", "PM10", "PM2_5", "O3", "BTX")
FLAG_GAS_CODES = {"NO2": 8, "SO2": 1, "CO": 6, "PM10": 10, "PM2_5": 9, "O3": 14}

# Generous bounding box of the region, in degrees.
LATITUDE_RANGE = (39.85, 41.20)
LONGITUDE_RANGE = (-4.60, -3.05)

# Silver names of the bronze traffic and station columns.
TRAFFIC_RENAMES = {
    "id": "ID_TRAFICO",
    "fecha": "FECHA",
    "tipo_elem": "TIPO_ELEM",
    "intensidad": "INTENSIDAD",
    "ocupacion": "OCUPACION",
    "carga": "CARGA",
    "vmed": "VMED",
    "error": "ERROR",
    "periodo_integracion": "PERIODO_INTEGRACION",
}
STATION_RENAMES = {"CODIGO_CORTO": "ID_AIRE", "Fecha alta": "FECHA_ALTA"}

# Month names used in resource descriptions.
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)

# Display units.
UNITS = {
    "NO2": "µg/m³",
    "PM10": "µg/m³",
    "PM2.5": "µg/m³",
    "O3": "µg/m³",
    "NOx": "µg/m³",
    "INTENSIDAD": "veh/h",
    "OCUPACION": "%",
    "CARGA": "%",
    "VMED": "km/h",
}
DEFAULT_UNIT = "unitless"

# Colour bands as (variable, lower, upper, colour); a band holds
# lower <= value < upper and the last one of a variable is open.
COLOR_BANDS = (
    ("NO2", 0, 90, "green"),
    ("NO2", 90, 120, "yellow"),
    ("NO2", 120, 230, "orange"),
    ("NO2", 230, None, "red"),
    ("PM10", 0, 40, "green"),
    ("PM10", 40, 50, "yellow"),
    ("PM10", 50, 100, "orange"),
    ("PM10", 100, None, "red"),
    ("PM2.5", 0, 20, "green"),
    ("PM2.5", 20, 25, "yellow"),
    ("PM2.5", 25, 50, "orange"),
    ("PM2.5", 50, None, "red"),
    ("O3", 0, 100, "green"),
    ("O3", 100, 130, "yellow"),
    ("O3", 130, 240, "orange"),
    ("O3", 240, None, "red"),
    ("NOx", 0, 50, "green"),
    ("NOx", 50, 100, "yellow"),
    ("NOx", 100, 150, "orange"),
    ("NOx", 150, None, "red"),
    ("CARGA", 0, 25, "green"),
    ("CARGA", 25, 50, "yellow"),
    ("CARGA", 50, 75, "orange"),
    ("CARGA", 75, None, "red"),
    ("OCUPACION", 0, 20, "green"),
    ("OCUPACION", 20, 40, "yellow"),
    ("OCUPACION", 40, 60, "orange"),
    ("OCUPACION", 60, None, "red"),
    ("INTENSIDAD", 0, 500, "green"),
    ("INTENSIDAD", 500, 1000, "yellow"),
    ("INTENSIDAD", 1000, 2000, "orange"),
    ("INTENSIDAD", 2000, None, "red"),
    ("VMED", 0, 20, "red"),
    ("VMED", 20, 40, "orange"),
    ("VMED", 40, 60, "yellow"),
    ("VMED", 60, None, "green"),
)
COLOR_OUT_OF_BANDS = "gray"
COLOR_NO_DATA = "lightgray"

# Selector options shown before anything is chosen.
DEFAULT_AIR_VARIABLES = ("NO2", "PM10", "PM2.5", "O3", "NOx")
DEFAULT_YEARS = (2020, 2021, 2022, 2023, 2024)
DEFAULT_MONTHS = tuple(range(1, 13))

# Fixed value: longest forecast, in months.
MAX_FORECAST_MONTHS = 12


def gas_table(spark: SparkSession) -> DataFrame:
    """Gas dimension rows (ID_MAGNITUD, MAGNITUD)."""
    return literal_table(spark, GAS_LABELS.items(), "ID_MAGNITUD int, MAGNITUD string")


def measure_table(spark: SparkSession) -> DataFrame:
    """Traffic measure dimension rows (ID_MEDIDA_TRAFICO, MEDIDA)."""
    return literal_table(
        spark, TRAFFIC_MEASURES.items(), "ID_MEDIDA_TRAFICO int, MEDIDA string"
    )


def band_table(spark: SparkSession) -> DataFrame:
    """Colour bands (variable, lo, hi, color); ``hi`` is NULL on open bands."""
    rows = [
        (variable, float(lo), None if hi is None else float(hi), color)
        for variable, lo, hi, color in COLOR_BANDS
    ]
    return literal_table(
        spark, rows, "variable string, lo double, hi double, color string"
    )


def unit_table(spark: SparkSession) -> DataFrame:
    """Display units (variable, unit)."""
    return literal_table(spark, UNITS.items(), "variable string, unit string")
