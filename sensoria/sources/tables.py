"""Parquet tables of the three layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sensoria.session import literal_table

PERIOD = ("year", "month")


def write_table(df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> int:
    """Replace a whole table; returns the rows written, counted on the way.

    With ``cluster_by`` the files cover ranges of those columns, so that later
    filters on the first one skip files and row groups by their statistics.  Give a
    second column, such as the sensor, to let a single busy day spread over files.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return seen.get["rows"]


def write_periods(
    df: DataFrame, path: str, periods: Sequence[str] = PERIOD
) -> int:
    """Replace just the periods present in ``df``; others stay as they are.

    Rows are clustered by period first, so each period gets few files; a large
    period is split by the adaptive plan instead of landing in one task.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    (
        counted.hint("rebalance", *periods)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*periods)
        .parquet(path)
    )
    return seen.get["rows"]


def clear_period(spark: SparkSession, path: str, period: Mapping[str, object]) -> None:
    """Empty one period of a table, which an overwrite without rows cannot do."""
    context = spark.sparkContext
    folder = "/".join([path, *[f"{name}={value}" for name, value in period.items()]])
    place = context._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def read_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A table folder, a file, a glob or a list of them, as one table."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per Parquet file of a freshly read table, with the file's name."""
    return df.groupBy(F.col("_metadata.file_name").alias("archivo")).agg(
        F.count(F.lit(1)).alias("filas")
    )


def sample_rows(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """First rows in key order, for a look at a table."""
    return df.orderBy(*key).limit(n)


def describe_columns(df: DataFrame) -> DataFrame:
    """(pos, columna, tipo) of a table's schema."""
    rows = [
        (pos, field.name, field.dataType.simpleString())
        for pos, field in enumerate(df.schema)
    ]
    return literal_table(df.sparkSession, rows, "pos int, columna string, tipo string")


class Lakehouse:
    """Tables of one root folder, addressed by layer and name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def table(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, self.path(layer, name))

    def bronze(self, name: str) -> DataFrame:
        return self.table("bronze", name)

    def silver(self, name: str) -> DataFrame:
        return self.table("silver", name)

    def gold(self, name: str) -> DataFrame:
        return self.table("gold", name)

    def write(
        self, layer: str, name: str, df: DataFrame, cluster_by: Sequence[str] = ()
    ) -> int:
        return write_table(df, self.path(layer, name), cluster_by)
