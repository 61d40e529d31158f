"""Model metrics as JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS = (
    "gas string, horizonte_meses int, ultima_fecha_real string, ganador string, "
    "comparativa array<struct<modelo: string, mae: double, rmse: double, origenes: bigint>>"
)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").option("partitionOverwriteMode", "static").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).json(path)


def as_documents(metrics: DataFrame) -> DataFrame:
    """(gas, documento): each metrics row as JSON text."""
    row = F.struct(*[F.col(name) for name in metrics.columns])
    return metrics.select("gas", F.to_json(row).alias("documento"))
