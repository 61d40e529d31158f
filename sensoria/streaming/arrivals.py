"""Readings that arrive more than once, in one file or in several, land once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def once(stream: DataFrame, key: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first arrival of every key.

    State holds one row per key for as long as ``time`` may still come again: ``delay`` behind the
    latest reading seen.  Spark spreads it over the shuffle partitions by the key's hash and keeps
    it in the checkpoint, so a lost executor loses none of it, and drops what the watermark has
    passed.  A reading that is later than ``delay`` is left out; choose it above the longest
    correction period.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(key))


def land_once(
    spark: SparkSession,
    source: str,
    schema: str,
    table: str,
    checkpoint: str,
    key: Sequence[str],
    time: str,
    delay: str = "62 days",
    files_at_once: int = 1000,
) -> None:
    """Append newly arrived files of one layout to a table, every reading once, then stop.

    Files are Parquet; those of a round are read ``files_at_once`` at a time.  The table is
    partitioned by the reading's month and written exactly once by the checkpoint.
    """
    arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    landed = once(arrived, key, time, delay).withColumns({"year": F.year(time), "month": F.month(time)})
    query = (
        landed.writeStream.format("parquet").partitionBy("year", "month")
        .option("path", table).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
