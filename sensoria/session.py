"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the plans rely on to a live session.

    On a cluster, shuffles start with several partitions per core, unless the
    submitter chose a number; adaptive execution merges what turns out small.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if not context.master.startswith("local") and not spark.conf.get(INITIAL_PARTITIONS, None):
        fixed = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(fixed, 4 * context.defaultParallelism)
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Small local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sensoria")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Root of the shared folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``.  Only a purely local session
    may fall back to a folder of its own; elsewhere a machine-local folder would
    be lost with its machine, so its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    root = tempfile.mkdtemp(prefix="sensoria-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder nobody used before, below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/sensoria/{label}-{uuid.uuid4().hex}"


_STAGED: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside the block at its end.

    Results have to be written inside the block: they may read staged tables.
    """
    _STAGED.append([])
    try:
        yield
    finally:
        context = spark.sparkContext
        for folder in _STAGED.pop():
            place = context._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """The result written to the shared folder and read back, for use by several jobs.

    Parquet rather than a row checkpoint: later jobs still prune columns, skip row
    groups and know the table's size.  The files outlive any executor; :func:`staging`
    removes them after the last write.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "stage")
    if _STAGED:
        _STAGED[-1].append(folder)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Small fixed table as a local relation.

    Its size is known exactly, so Spark broadcasts it in joins by its own rule, and
    no Python worker is started to produce it.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    rows = list(rows)
    columns = [
        pa.array([row[i] for row in rows], field.type) for i, field in enumerate(arrow)
    ]
    return spark.createDataFrame(pa.table(columns, schema=arrow))
