"""Landed files to bronze tables, with the load ledger.

Every call replaces just the period it loads, in the table and in the ledger, so
it can be repeated at any time.
"""

from __future__ import annotations

import argparse
import re
import sys
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensoria.session import configure, literal_table, staging
from sensoria.sources.archives import read_zipped
from sensoria.sources.delimited import read_delimited
from sensoria.sources.ledger import missing_periods, period_grid
from sensoria.sources.schemas import AIR, TRAFFIC, TRAFFIC_POINTS
from sensoria.sources.tables import Lakehouse, clear_period, write_periods
from sensoria.streaming.landing import land_new_files, period_columns, replace_periods

LEDGER = "_ledger"
LEDGER_KEY = ("dataset", "periodo")
LEDGER_COLUMNS = "dataset string, periodo string, resource string, rows bigint"
SNAPSHOT = "latest"
#: The landed datasets; those of YEARLY have one file a year, the others one a month.
SCHEMAS = {"aire": AIR, "trafico": TRAFFIC, "trafico_puntos_medida": TRAFFIC_POINTS}
YEARLY = ("aire",)


def read_ledger(lake: Lakehouse) -> DataFrame:
    """The ledger; periods are text even where all of them look like years."""
    return lake.spark.read.schema(LEDGER_COLUMNS).parquet(lake.path("bronze", LEDGER))


def record_load(
    lake: Lakehouse, dataset: str, period: str, resource: str, rows: int
) -> None:
    """Upsert one ledger entry; the ledger is partitioned by its key."""
    entry = literal_table(
        lake.spark,
        [(dataset, period, resource, rows)],
        LEDGER_COLUMNS,
    )
    write_periods(entry, lake.path("bronze", LEDGER), LEDGER_KEY)


def load_period(
    lake: Lakehouse, dataset: str, period: str, rows: DataFrame, resource: str
) -> int:
    """Replace one period (``YYYY`` or ``YYYY-MM``) of a bronze table."""
    dated = rows.select("*", *period_columns(F.lit(period)))
    count = write_periods(dated, lake.path("bronze", dataset))
    if not count:
        year, _, month = period.partition("-")
        clear_period(lake.spark, lake.path("bronze", dataset), {"year": int(year), "month": int(month or 0)})
    record_load(lake, dataset, period, resource, count)
    return count


def load_snapshot(lake: Lakehouse, dataset: str, rows: DataFrame, resource: str) -> int:
    """Replace a dataset that only has a current state."""
    count = lake.write("bronze", dataset, rows)
    record_load(lake, dataset, SNAPSHOT, resource, count)
    return count


def ingest_csv(
    lake: Lakehouse,
    dataset: str,
    paths: str | Sequence[str],
    schema: str | None = None,
    period: str | None = None,
    resource: str = "",
) -> int:
    with staging(lake.spark):
        rows = read_delimited(lake.spark, paths, schema)
        if period is None:
            return load_snapshot(lake, dataset, rows, resource)
        return load_period(lake, dataset, period, rows, resource)


def ingest_zip(
    lake: Lakehouse,
    dataset: str,
    paths: str | Sequence[str],
    schema: str,
    period: str,
    resource: str = "",
) -> int:
    partitions = lake.spark.sparkContext.defaultParallelism
    rows = read_zipped(lake.spark, paths, schema, partitions=partitions)
    return load_period(lake, dataset, period, rows, resource)


def ingest_landed(
    lake: Lakehouse, dataset: str, folder: str, schema: str
) -> DataFrame:
    """Load every landed ``<period>.csv`` of a folder in one job.

    Returns the dataset's ledger entries.  Periods are ``YYYY`` or ``YYYY-MM`` whatever the
    file's spelling of the month; a file of another name ends the load.  A period's files are
    one entry, named after the last of them.  All periods with a file are replaced, those whose
    files hold no rows by nothing; for picking up what is new see
    :func:`sensoria.streaming.landing.land_new_files`.
    """
    with staging(lake.spark):
        files = landed_files(lake.spark, f"{folder}/*.csv")
        named = {path: period_of(path) for path, _ in files}
        last = {period: path for path, period in sorted(named.items())}
        if not any(size for _, size in files):
            rows = literal_table(lake.spark, [], f"{schema}, periodo string")
        else:
            rows = read_delimited(lake.spark, f"{folder}/*.csv", schema, file_column="_archivo")
            rows = rows.withColumn("periodo", _period_column("_archivo")).drop("_archivo")
        loaded = replace_periods(rows, sorted(last), lake.path("bronze", dataset))
        resources = literal_table(lake.spark, last.items(), "periodo string, resource string")
        entries = loaded.join(resources, "periodo").withColumn("dataset", F.lit(dataset))
        write_periods(entries, lake.path("bronze", LEDGER), LEDGER_KEY)
    return read_ledger(lake).filter(F.col("dataset") == F.lit(dataset))


PERIOD_NAME = r"^(\d{4})(?:-(\d{1,2}))?\.csv$"


def _period_column(path: str) -> Column:
    """The period a landed file is named after, ``YYYY`` or ``YYYY-MM``."""
    name = F.element_at(F.split(path, "/"), -1)
    month = F.nullif(F.regexp_extract(name, PERIOD_NAME, 2), F.lit(""))
    return F.concat_ws("-", F.regexp_extract(name, PERIOD_NAME, 1), F.lpad(month, 2, "0"))


def period_of(path: str) -> str:
    """The same of one path; a file of another name is an error."""
    found = re.match(PERIOD_NAME, path.rsplit("/", 1)[-1])
    if not found:
        raise ValueError(f"no period in the file name {path}")
    year, month = found.groups()
    return f"{year}-{int(month):02}" if month else year


def landed_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, bytes) of landed files, one for each period and so few; empty ones, which no reader lists, too."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(place)
    return [(status.getPath().toString(), status.getLen()) for status in found or []]


def ingest_all(
    lake: Lakehouse, root: str, schemas: Mapping[str, str], first_year: int, last_year: int
) -> tuple[list[tuple[str, str]], DataFrame]:
    """Load all landed datasets, ``<root>/<dataset>/<period>.csv``, one after the other.

    A dataset that fails does not stop the others.  Returns the rejects as (dataset, error
    text), and the (dataset, periodo) pairs of the years that the ledger still lacks.
    """
    rejects = backfill(
        (name, lambda name=name: ingest_landed(lake, name, f"{root}/{name}", schemas[name])) for name in schemas
    )
    monthly = [name for name in schemas if name not in YEARLY]
    yearly = [name for name in schemas if name in YEARLY]
    grid = period_grid(lake.spark, first_year, last_year, monthly, yearly)
    if len(rejects) == len(schemas):
        return rejects, grid
    return rejects, missing_periods(grid, read_ledger(lake))


def main(arguments: Sequence[str] | None = None) -> int:
    """``python -m sensoria.plans.ingest <lake> <landed files> <first year> <last year>``."""
    parser = argparse.ArgumentParser(description="Load all landed datasets into the bronze tables.")
    parser.add_argument("lake")
    parser.add_argument("landed")
    parser.add_argument("first_year", type=int)
    parser.add_argument("last_year", type=int)
    given = parser.parse_args(arguments)
    spark = configure(SparkSession.builder.getOrCreate())
    lake = Lakehouse(spark, given.lake)
    rejects, missing = ingest_all(lake, given.landed, SCHEMAS, given.first_year, given.last_year)
    for dataset, error in rejects:
        print(f"rejected {dataset}: {error}")
    print(f"{missing.count()} periods are missing")
    return 1 if rejects else 0


def land(lake: Lakehouse, dataset: str, source: str, schema: str, checkpoint: str) -> None:
    """Bring the periods of newly landed files up to date, in the table and in the ledger."""

    def record(loaded: DataFrame) -> None:
        entries = loaded.select(
            F.lit(dataset).alias("dataset"), "periodo", F.lit(source).alias("resource"), "rows"
        )
        write_periods(entries, lake.path("bronze", LEDGER), LEDGER_KEY)

    land_new_files(
        lake.spark, source, schema, lake.path("bronze", dataset), checkpoint, on_loaded=record
    )


def backfill(loads: Iterable[tuple[str, object]]) -> list[tuple[str, str]]:
    """Run (name, callable) loads; a failing one does not stop the others.

    Returns the rejects as (name, error text).
    """
    rejects = []
    for name, load in loads:
        try:
            load()
        except Exception as error:
            rejects.append((name, str(error)))
    return rejects


if __name__ == "__main__":
    sys.exit(main())
