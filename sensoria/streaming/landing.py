"""Pick up newly landed files and replace the periods they belong to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensoria.session import cut_lineage, literal_table, staging
from sensoria.sources.delimited import read_delimited
from sensoria.sources.tables import clear_period, write_periods


def period_columns(period: Column) -> tuple[Column, Column]:
    """(year, month) of ``YYYY`` or ``YYYY-MM``; month 0 stands for a whole year."""
    parts = F.split(period, "-")
    return (
        F.element_at(parts, 1).cast("int").alias("year"),
        F.coalesce(F.try_element_at(parts, F.lit(2)).cast("int"), F.lit(0)).alias("month"),
    )


def replace_periods(rows: DataFrame, periods: list[str], table: str) -> DataFrame:
    """Put rows with a ``periodo`` in the place of these periods; (periodo, rows) of each.

    A period without rows is emptied.  The rows are computed once.
    """
    spark = rows.sparkSession
    rows = cut_lineage(rows)
    given = literal_table(spark, [(period,) for period in periods], "periodo string")
    counts = given.join(rows.groupBy("periodo").agg(F.count(F.lit(1)).alias("rows")), "periodo", "left")
    loaded = cut_lineage(counts.fillna(0, ["rows"]))
    empty = loaded.where("rows = 0").select(*period_columns(F.col("periodo"))).collect()
    if len(empty) < len(periods):
        write_periods(rows.select("*", *period_columns(F.col("periodo"))).drop("periodo"), table)
    for row in empty:
        clear_period(spark, table, row.asDict())
    return loaded


def land_new_files(
    spark: SparkSession,
    source: str,
    schema: str,
    table: str,
    checkpoint: str,
    encoding: str | None = None,
    on_loaded: Callable[[DataFrame], None] | None = None,
) -> None:
    """Bring the periods of newly arrived files up to date, then stop.

    Files lie in one folder per period, ``<source>/periodo=YYYY-MM/``, and a period of
    the table always mirrors the whole folder: when a file arrives, its period is read
    again and replaced.  Files of one period may therefore arrive in several rounds, a
    correction takes the place of the files it corrects, and a batch repeated after a
    lost executor or driver leaves the same table.  The checkpoint remembers which
    files have been seen.

    Files are read as by :func:`sensoria.sources.delimited.read_delimited`: columns by header,
    encoding per file, a bad line ends the batch before its period is replaced.  The rows of a
    batch are parsed once, staged, counted and written from there.  A period whose files hold no
    rows is emptied.  ``on_loaded`` gets (periodo, rows) of each batch.
    """
    def refresh_periods(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        name = F.regexp_extract(F.col("_file"), r"/periodo=([^/]+)/", 1)
        arrived = [row["periodo"] for row in batch.select(name.alias("periodo")).distinct().collect()]
        if not arrived:
            return
        folders = [f"{source}/periodo={period}" for period in arrived]
        with staging(session):
            files = read_delimited(session, folders, schema, encoding=encoding, file_column="_file")
            loaded = replace_periods(files.withColumn("periodo", name).drop("_file"), arrived, table)
            if on_loaded:
                on_loaded(loaded)

    query = (
        spark.readStream.schema("value string, periodo string")
        .text(source)
        .select(F.col("_metadata.file_path").alias("_file"))
        .writeStream.foreachBatch(refresh_periods)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
