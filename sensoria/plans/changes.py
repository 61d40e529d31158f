"""Gold by change: what the ledger says was loaded since the last run decides what is built.

Silver readings and facts lie in one folder a month.  :func:`apply` compares the ledger with the
entries that were built before, finds the months that hold readings of the changed periods now or
held them then, and replaces these months in silver, facts and coverage.  Dimensions follow a change
of their own sources; where a sensor comes, goes or changes its district, the months of its
readings are built again.  Files of other months are neither read nor written, and the tables equal
those of :func:`rebuild`.  What was built is noted last, so a run that fails is done again.

Sources without a ledger entry count as unchanged.  Months of a period that lost all its rows stay
noted, which costs their building once more when it is loaded again.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensoria.operators.cleaning import clean_traffic
from sensoria.operators.reshape import unpivot_air
from sensoria.operators.star import dim_fecha, fact_calidad_aire, fact_trafico_diario
from sensoria.plans import coverage, medallion
from sensoria.plans.ingest import LEDGER, LEDGER_COLUMNS, LEDGER_KEY
from sensoria.session import configure, cut_lineage, literal_table, staging
from sensoria.sources.tables import PERIOD, Lakehouse, clear_period, write_periods

MONTH = "_mes"
#: Stands for readings without a day.
NO_MONTH = 0
AIR, TRAFFIC, POINTS = "aire", "trafico", "trafico_puntos_medida"
MONTHLY = {("silver", AIR), ("silver", TRAFFIC), ("gold", "fact_calidad_aire"), ("gold", "fact_trafico_diario")}
BUILT, SEEN = "_construido", "_meses"
BUILT_COLUMNS = "version string, dataset string, periodo string"
SEEN_COLUMNS = "mes int, dataset string, periodo string"


def month_of(day: str) -> Column:
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(NO_MONTH)).cast("int")


def in_months(day: str, months: Iterable[int]) -> Column:
    """Days of these months as half-open ranges, which the scan uses to skip row groups."""
    wanted = F.lit(False)
    for month in months:
        if month == NO_MONTH:
            wanted = wanted | F.col(day).isNull()
        else:
            start = F.make_date(F.lit(month // 100), F.lit(month % 100), F.lit(1))
            wanted = wanted | ((F.col(day) >= start) & (F.col(day) < F.add_months(start, 1)))
    return wanted


class MonthlyLakehouse(Lakehouse):
    """A lake whose readings and facts lie in one folder a month; its tables look the same."""

    def by_month(self, layer: str, name: str) -> DataFrame:
        return super().table(layer, name)

    def table(self, layer: str, name: str) -> DataFrame:
        return super().table(layer, name).drop(MONTH)

    def write(self, layer: str, name: str, df: DataFrame, cluster_by: Sequence[str] = ()) -> int:
        if (layer, name) not in MONTHLY:
            return super().write(layer, name, df, cluster_by)
        return self._write(layer, name, df, cluster_by, "static")

    def _write(self, layer: str, name: str, df: DataFrame, cluster_by: Sequence[str], mode: str) -> int:
        placed = df.withColumn(MONTH, month_of("FECHA"))
        order = [MONTH, *cluster_by]
        placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(MONTH).parquet(self.path(layer, name))
        return 0

    def replace_months(
        self, layer: str, name: str, df: DataFrame, months: Iterable[int], cluster_by: Sequence[str]
    ) -> None:
        """Bring months up to date with ``df``, all their rows; a month without rows is emptied."""
        rows = cut_lineage(df)
        self._write(layer, name, rows, cluster_by, "dynamic")
        found = {row[0] for row in rows.select(month_of("FECHA")).distinct().collect()}
        for month in set(months) - found:
            clear_period(self.spark, self.path(layer, name), {MONTH: month})


def _state(lake: Lakehouse, name: str, schema: str) -> DataFrame:
    try:
        return lake.spark.read.schema(schema).parquet(lake.path("gold", name))
    except AnalysisException:
        return literal_table(lake.spark, [], schema)


def ledger_versions(lake: Lakehouse) -> DataFrame:
    """(version, dataset, periodo): the file of a ledger entry, which every load writes anew."""
    entries = lake.spark.read.schema(LEDGER_COLUMNS).parquet(lake.path("bronze", LEDGER))
    return entries.groupBy(*LEDGER_KEY).agg(F.max("_metadata.file_name").alias("version"))


def changed_periods(lake: Lakehouse, now: DataFrame) -> DataFrame:
    """(dataset, periodo) loaded, loaded again or gone from the ledger since the last build."""
    built = _state(lake, BUILT, BUILT_COLUMNS)
    both = [*LEDGER_KEY, "version"]
    new = now.join(built, both, "left_anti").select(*LEDGER_KEY)
    gone = built.join(now, list(LEDGER_KEY), "left_anti").select(*LEDGER_KEY)
    return new.unionByName(gone).distinct()


def _of_periods(periods: Iterable[str]) -> Column:
    wanted = F.lit(False)
    for period in periods:
        year, _, month = period.partition("-")
        wanted = wanted | ((F.col("year") == int(year)) & (F.col("month") == int(month or 0)))
    return wanted


def _bronze_month(dataset: str) -> Column:
    if dataset == AIR:
        return F.coalesce(F.col("ANO") * 100 + F.col("MES"), F.lit(NO_MONTH)).cast("int")
    return month_of("fecha")


def months_of_periods(lake: Lakehouse, dataset: str, periods: Sequence[str]) -> DataFrame:
    """(mes, dataset, periodo): months with bronze readings of the periods."""
    period = F.concat_ws("-", "year", F.when(F.col("month") > 0, F.lpad(F.col("month").cast("string"), 2, "0")))
    rows = lake.bronze(dataset).filter(_of_periods(periods))
    return rows.select(
        _bronze_month(dataset).alias("mes"), F.lit(dataset).alias("dataset"), period.alias("periodo")
    ).distinct()


def _moved_months(lake: MonthlyLakehouse, dataset: str, key: str, before: DataFrame, after: DataFrame) -> set[int]:
    """Months with readings of sensors that came, went or changed their district."""
    columns = [key, "COD_DIS"]
    old, new = before.select(*columns), after.select(*columns)
    moved = old.exceptAll(new).unionByName(new.exceptAll(old)).select(key).distinct()
    rows = lake.by_month("silver", dataset).join(moved, key, "left_semi")
    return {row[0] for row in rows.select(MONTH).distinct().collect()}


def _silver_month(lake: Lakehouse, dataset: str, months: Sequence[int]) -> DataFrame:
    bronze = lake.bronze(dataset)
    if dataset == AIR:
        return unpivot_air(bronze.filter(_bronze_month(AIR).isin(months)))
    return clean_traffic(bronze.filter(in_months("fecha", months)).drop(*PERIOD))


def _outer_months(lake: MonthlyLakehouse, dataset: str) -> DataFrame:
    """Readings of the first and the last month, which hold the table's first and last day."""
    table = lake.by_month("silver", dataset)
    ends = table.filter(F.col(MONTH) != NO_MONTH).agg(F.min(MONTH), F.max(MONTH)).first()
    return table.filter(F.col(MONTH).isin([month for month in ends if month is not None]))


LAYOUT = {AIR: medallion.BY_DAY_AND_STATION, TRAFFIC: medallion.BY_DAY_AND_POINT}
FACTS = {AIR: "fact_calidad_aire", TRAFFIC: "fact_trafico_diario"}
DIMENSIONS = {AIR: ("dim_estacion_aire", "ID_AIRE"), TRAFFIC: ("dim_punto_trafico", "ID_TRAFICO")}


def _fact(lake: MonthlyLakehouse, dataset: str, months: Sequence[int]) -> DataFrame:
    readings = lake.by_month("silver", dataset).filter(F.col(MONTH).isin(months)).drop(MONTH)
    if dataset == AIR:
        return fact_calidad_aire(readings, lake.gold("dim_estacion_aire"), lake.gold("dim_magnitud"))
    return fact_trafico_diario(readings, lake.gold("dim_punto_trafico"), lake.gold("dim_medida_trafico"))


def rebuild(lake: MonthlyLakehouse, point_order: tuple[str, ...] = PERIOD) -> None:
    """All tables from bronze, and the note of what they follow."""
    with staging(lake.spark):
        versions = cut_lineage(ledger_versions(lake))
        medallion.run(lake, point_order)
        for dataset in (AIR, TRAFFIC):
            periods = _listed(versions.select(*LEDGER_KEY), dataset)
            write_periods(months_of_periods(lake, dataset, periods), lake.path("gold", SEEN), LEDGER_KEY)
        _note(lake, versions)


def apply(lake: MonthlyLakehouse, point_order: tuple[str, ...] = PERIOD) -> dict[str, set[int]]:
    """Build what changed since the last run; the months whose facts were written, by dataset."""
    with staging(lake.spark):
        versions = cut_lineage(ledger_versions(lake))
        if _state(lake, BUILT, BUILT_COLUMNS).isEmpty():
            raise ValueError("nothing was built yet: rebuild first")
        changed = cut_lineage(changed_periods(lake, versions))
        datasets = {row[0] for row in changed.select("dataset").distinct().collect()}
        if not datasets:
            return {}
        months: dict[str, set[int]] = {}
        for dataset in datasets & {AIR, TRAFFIC}:
            months[dataset] = _update_silver(lake, dataset, _listed(changed, dataset))

        before = {name: cut_lineage(lake.gold(table)) for name, (table, _) in DIMENSIONS.items()}
        if "estaciones_aire" in datasets or "distritos" in datasets:
            medallion.build_stations(lake)
        if datasets - {AIR, TRAFFIC}:
            medallion.build_dimensions(lake, point_order)
        if months:
            days = dim_fecha(_outer_months(lake, AIR), _outer_months(lake, TRAFFIC))
            lake.write("gold", "dim_fecha", days)

        built = {}
        for dataset, (table, key) in DIMENSIONS.items():
            wanted = months.get(dataset, set()) | _moved_months(lake, dataset, key, before[dataset], lake.gold(table))
            if wanted:
                _update_facts(lake, dataset, sorted(wanted))
                built[dataset] = wanted
        for name in medallion.CONTRACT:
            if name not in FACTS.values():
                medallion.check_table(lake, name, lake.gold(name))
        _note(lake, versions)
    return built


def _listed(periods: DataFrame, dataset: str) -> list[str]:
    """A dataset's periods, as many as loads and so few."""
    return sorted(row[0] for row in periods.filter(F.col("dataset") == dataset).select("periodo").collect())


def _update_silver(lake: MonthlyLakehouse, dataset: str, periods: list[str]) -> set[int]:
    now = cut_lineage(months_of_periods(lake, dataset, periods))
    seen = _state(lake, SEEN, SEEN_COLUMNS).filter(F.col("dataset") == dataset)
    known = seen.filter(F.col("periodo").isin(periods))
    months = {row[0] for row in now.select("mes").union(known.select("mes")).distinct().collect()}
    if months:
        rows = _silver_month(lake, dataset, sorted(months))
        lake.replace_months("silver", dataset, rows, months, LAYOUT[dataset])
        write_periods(now, lake.path("gold", SEEN), LEDGER_KEY)
        days = [divmod(month, 100) for month in months if month != NO_MONTH]
        coverage.replace_months(lake, dataset, lake.silver(dataset), days)
    return months


def _update_facts(lake: MonthlyLakehouse, dataset: str, months: list[int]) -> None:
    """Replace the months of a fact and check them; their keys hold the day, so others cannot clash."""
    name = FACTS[dataset]
    lake.replace_months("gold", name, _fact(lake, dataset, months), months, LAYOUT[dataset])
    rows = lake.by_month("gold", name).filter(F.col(MONTH).isin(months)).drop(MONTH)
    medallion.check_table(lake, name, rows)


def _note(lake: Lakehouse, versions: DataFrame) -> None:
    """The ledger entries that the tables follow now, written last."""
    path = lake.path("gold", BUILT)
    gone = _state(lake, BUILT, BUILT_COLUMNS).join(versions, list(LEDGER_KEY), "left_anti").collect()
    write_periods(versions, path, LEDGER_KEY)
    for row in gone:
        clear_period(lake.spark, path, {name: row[name] for name in LEDGER_KEY})


if __name__ == "__main__":
    target = MonthlyLakehouse(configure(SparkSession.builder.getOrCreate()), sys.argv[1])
    rebuild(target) if sys.argv[2:] == ["rebuild"] else apply(target)
