"""Files in and out.  Inputs are staged from the test tables below the shared folder."""

from collections.abc import Iterator

from pyspark.sql import functions as F

from sensoria.checks.fixtures import Inputs
from sensoria.checks.registry import check
from sensoria.functions.dates import period_label
from sensoria.session import new_folder
from sensoria.sources import archives, delimited, ledger, metrics, resources, tables
from sensoria.streaming.arrivals import land_once
from sensoria.streaming.landing import land_new_files

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
LINES_A_MEMBER = 200_000


def _stage_csv(df, folder: str, encoding: str = "UTF-8", partition: str | None = None) -> str:
    writer = df.write.options(header=True, sep=";", encoding=encoding, escape='"')
    if partition:
        writer = writer.partitionBy(partition)
    writer.csv(folder)
    return folder


@check(
    "read_delimited",
    """SELECT event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type, value, props
       FROM events""",
)
def _(inputs: Inputs):
    events = inputs.table("events").withColumn("ts", F.date_format("ts", MICROS))
    folder = _stage_csv(events, new_folder(inputs.spark, "csv"))
    types = {"event_id": "bigint", "ts": "timestamp_ntz", "value": "double"}
    return delimited.read_delimited(inputs.spark, folder, types=types)


def _mixed_files(inputs: Inputs) -> str:
    """Three layouts below one folder: another order, quoted breaks in Latin-1, lines that do not fit."""
    orders = inputs.table("orders").select(
        "o_orderkey", "o_totalprice",
        F.concat(F.lit("línea\n"), F.col("o_orderpriority"), F.lit('; "fin"')).alias("nota"),
        (F.col("o_orderkey") % 3).alias("k"),
    )
    folder = new_folder(inputs.spark, "mixed")
    _stage_csv(orders.where("k = 0").select("o_orderkey", "o_totalprice", "nota"), f"{folder}/a=0")
    _stage_csv(orders.where("k = 1").select("nota", "o_orderkey", "o_totalprice"), f"{folder}/a=1", "ISO-8859-1")
    wrong = F.concat(F.lit("x"), F.col("o_totalprice").cast("string")).alias("o_totalprice")
    _stage_csv(orders.where("k = 2").select("o_totalprice", wrong, "nota").toDF("o_orderkey", "o_totalprice", "nota")
               .withColumn("o_orderkey", F.lit(7)).withColumn("nota", F.lit("simple")), f"{folder}/a=2")
    return folder


MIXED = "o_orderkey bigint, o_totalprice double, nota string"


@check(
    "read_mixed_layouts",
    """SELECT o_orderkey, o_totalprice, 'línea' || chr(10) || o_orderpriority || '; "fin"' AS nota,
              CAST(o_orderkey % 3 AS INTEGER) AS a
       FROM orders WHERE o_orderkey % 3 < 2""",
)
def _(inputs: Inputs):
    return delimited.read_delimited(inputs.spark, _mixed_files(inputs), MIXED, bad="reject", partitions="a int")


@check(
    "rejected_lines",
    """SELECT '7;x' || CAST(o_totalprice AS VARCHAR) || ';simple' AS linea, 'a=2' AS carpeta
       FROM orders WHERE o_orderkey % 3 = 2""",
)
def _(inputs: Inputs):
    found = delimited.rejected_lines(inputs.spark, _mixed_files(inputs), MIXED)
    return found.select("linea", F.element_at(F.split("archivo", "/"), -2).alias("carpeta"))


@check(
    "encoding_fallback",
    """SELECT c_custkey, 'Peñalara ' || c_name AS nombre, 'UTF-8' AS origen FROM customer
       UNION ALL
       SELECT c_custkey, 'Peñalara ' || c_name, 'ISO-8859-1' FROM customer""",
)
def _(inputs: Inputs):
    spark = inputs.spark
    named = inputs.table("customer").select(
        "c_custkey", F.concat(F.lit("Peñalara "), F.col("c_name")).alias("nombre")
    )
    folders = [
        _stage_csv(
            named.withColumn("origen", F.lit(encoding)), new_folder(spark, "text"), encoding
        )
        for encoding in ("UTF-8", "ISO-8859-1")
    ]
    schema = "c_custkey bigint, nombre string, origen string"
    return delimited.read_delimited(spark, folders, schema)


@check(
    "zip_csv_source",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag,
              CAST(l_shipdate AS DATE) AS l_shipdate FROM lineitem""",
)
def _(inputs: Inputs):
    header = "l_orderkey;l_linenumber;l_extendedprice;l_returnflag;l_shipdate"

    folder = new_folder(inputs.spark, "zip")
    target = folder.removeprefix("file:")

    def pack(batches: Iterator) -> Iterator:
        """One archive a task, its lines written as they come; members follow each other."""
        import os
        import zipfile

        import pandas as pd
        from pyspark import TaskContext

        os.makedirs(target, exist_ok=True)
        path = f"{target}/lote-{TaskContext.get().partitionId()}.zip"
        archive, member, number, count = None, None, 0, 0
        for batch in batches:
            archive = archive or zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED)
            if member and count >= LINES_A_MEMBER:
                member.close()
                member, number, count = None, number + 1, 0
            if not member:
                member = archive.open(f"datos_{number}.csv", "w")
                member.write(f"{header}\n".encode())
            member.write("".join(f"{line}\n" for line in batch["linea"]).encode())
            count += len(batch)
        if archive:
            member.close()
            archive.writestr("leeme.txt", "sin datos")
            archive.close()
            yield pd.DataFrame({"path": [path]})

    line = F.concat_ws(
        ";",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_extendedprice").cast("string"),
        F.concat(F.lit('"'), F.col("l_returnflag"), F.lit('"')),
        F.to_date("l_shipdate").cast("string"),
    )
    # the scan's own tasks: nothing is shuffled or sorted, so no task holds more than a batch
    lines = inputs.table("lineitem").select(line.alias("linea"))
    lines.mapInPandas(pack, "path string").write.format("noop").mode("overwrite").save()
    return archives.read_zipped(
        inputs.spark,
        folder,
        "l_orderkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, "
        "l_shipdate date",
    )


_RESOURCES = """
    o AS (SELECT o_orderkey AS dataset, CAST(o_custkey AS VARCHAR) AS cliente,
                 year(o_orderdate) AS y, CASE o_orderstatus WHEN 'F' THEN 'CSV' ELSE 'ZIP' END
                 AS f FROM orders),
    r AS (SELECT dataset, 0 AS pos, 'a' || cliente AS name,
                 'Datos de ' || CAST(y AS VARCHAR) AS description, f AS format FROM o
          UNION ALL SELECT dataset, 1, 'b' || cliente, 'Datos de ' || CAST(y + 1 AS VARCHAR),
                 'CSV' FROM o
          UNION ALL SELECT dataset, 2, 'c' || cliente, 'Datos de ' || CAST(y AS VARCHAR),
                 'CSV' FROM o)"""


def _payloads(inputs: Inputs):
    """A package of three resources per order, as JSON text."""

    def resource(prefix: str, year, fmt):
        return F.struct(
            F.concat(F.lit(prefix), F.col("o_custkey").cast("string")).alias("name"),
            F.concat(F.lit("Datos de "), year.cast("string")).alias("description"),
            fmt.alias("format"),
        )

    year = F.year("o_orderdate")
    own = F.when(F.col("o_orderstatus") == "F", "CSV").otherwise("ZIP")
    listed = F.array(
        resource("a", year, own),
        resource("b", year + 1, F.lit("CSV")),
        resource("c", year, F.lit("CSV")),
    )
    document = F.struct(F.struct(listed.alias("resources")).alias("result"))
    return inputs.table("orders").select(
        F.col("o_orderkey").alias("dataset"), F.to_json(document).alias("payload")
    )


@check(
    "resource_catalog",
    f"""WITH {_RESOURCES}
        SELECT dataset, pos, name, description, format FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY dataset ORDER BY pos) AS rn FROM r
          WHERE description LIKE '%1998%' AND format = 'CSV') WHERE rn = 1""",
)
def _(inputs: Inputs):
    found = resources.resource_rows(_payloads(inputs))
    return resources.first_match(found, "dataset", "1998", "CSV").drop("url")


@check(
    "resource_by_format",
    f"""WITH {_RESOURCES}
        SELECT dataset, pos, name, description, format FROM r
        WHERE format = 'ZIP'""",
)
def _(inputs: Inputs):
    found = resources.resource_rows(_payloads(inputs))
    return resources.first_match(found, "dataset", fmt="ZIP").drop("url")


@check(
    "resources_of_period",
    f"""WITH {_RESOURCES} SELECT dataset, pos, name, description, format
        FROM r WHERE description LIKE '%1999%'""",
)
def _(inputs: Inputs):
    found = resources.resource_rows(_payloads(inputs))
    return resources.of_period(found, "1999").drop("url")


@check(
    "period_label",
    """SELECT strftime(o_orderdate, '%Y-%m') AS mes,
              CASE month(o_orderdate) WHEN 1 THEN 'Enero' WHEN 2 THEN 'Febrero'
                WHEN 3 THEN 'Marzo' WHEN 4 THEN 'Abril' WHEN 5 THEN 'Mayo' WHEN 6 THEN 'Junio'
                WHEN 7 THEN 'Julio' WHEN 8 THEN 'Agosto' WHEN 9 THEN 'Septiembre'
                WHEN 10 THEN 'Octubre' WHEN 11 THEN 'Noviembre' ELSE 'Diciembre' END
              || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS etiqueta, COUNT(*) AS n
       FROM orders GROUP BY 1, 2""",
)
def _(inputs: Inputs):
    month = F.date_format("o_orderdate", "yyyy-MM").alias("mes")
    counted = inputs.table("orders").groupBy(month).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("mes", period_label(F.col("mes")).alias("etiqueta"), "n")


def _loads(inputs: Inputs, table: str, column: str, name: str, date_format: str):
    return (
        inputs.table(table)
        .groupBy(F.date_format(column, date_format).alias("periodo"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("resource", F.lit(name))
    )


@check(
    "manifest_upsert",
    """WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS periodo, COUNT(*) AS rows
                  FROM orders GROUP BY 1),
       e AS (SELECT strftime(ts, '%Y-%m') AS periodo, COUNT(*) AS rows FROM events GROUP BY 1
             UNION ALL SELECT strftime(l_shipdate, '%Y-%m'), COUNT(*) FROM lineitem
             GROUP BY 1)
       SELECT periodo, rows, 'nuevo' AS resource FROM e
       UNION ALL SELECT periodo, rows, 'anterior' FROM o
       WHERE periodo NOT IN (SELECT periodo FROM e)""",
)
def _(inputs: Inputs):
    old = _loads(inputs, "orders", "o_orderdate", "anterior", "yyyy-MM")
    shipped = _loads(inputs, "lineitem", "l_shipdate", "nuevo", "yyyy-MM")
    new = _loads(inputs, "events", "ts", "nuevo", "yyyy-MM").unionByName(shipped)
    return ledger.upsert_entries(old, new, "periodo")


@check(
    "backfill_periods",
    """WITH y AS (SELECT CAST(UNNEST(range(1994, 2003)) AS VARCHAR) AS anio),
       m AS (SELECT LPAD(CAST(UNNEST(range(1, 13)) AS VARCHAR), 2, '0') AS mes),
       g AS (SELECT 'aire' AS dataset, anio AS periodo FROM y
             UNION ALL SELECT d, anio || '-' || mes FROM y, m,
             (VALUES ('trafico'), ('trafico_puntos_medida')) t(d)),
       l AS (SELECT DISTINCT 'trafico' AS dataset, strftime(l_shipdate, '%Y-%m') AS periodo
             FROM lineitem
             UNION ALL SELECT DISTINCT 'aire', CAST(year(o_orderdate) AS VARCHAR) FROM orders)
       SELECT g.dataset, g.periodo FROM g LEFT JOIN l
       ON l.dataset = g.dataset AND l.periodo = g.periodo WHERE l.periodo IS NULL""",
)
def _(inputs: Inputs):
    traffic = _loads(inputs, "lineitem", "l_shipdate", "", "yyyy-MM").select(
        F.lit("trafico").alias("dataset"), "periodo"
    )
    air = _loads(inputs, "orders", "o_orderdate", "", "yyyy").select(
        F.lit("aire").alias("dataset"), "periodo"
    )
    grid = ledger.period_grid(inputs.spark, 1994, 2002)
    return ledger.missing_periods(grid, traffic.unionByName(air))


def _orders_by_period(inputs: Inputs):
    return inputs.table("orders").select(
        "o_orderkey",
        "o_totalprice",
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )


@check(
    "period_overwrite",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice * 2
              ELSE o_totalprice END AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
              CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
)
def _(inputs: Inputs):
    orders = _orders_by_period(inputs)
    folder = new_folder(inputs.spark, "periods")
    tables.write_periods(orders, folder)
    corrected = orders.filter(F.col("year") == 1996).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    tables.write_periods(corrected, folder)
    return tables.read_table(inputs.spark, folder)


@check(
    "incremental_landing",
    """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
              CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
)
def _(inputs: Inputs):
    spark = inputs.spark
    source, table, state = (new_folder(spark, name) for name in ("land", "bronze", "state"))
    orders = inputs.table("orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM").alias("periodo")
    )
    schema = "o_orderkey bigint, o_totalprice double"
    early, late = F.col("periodo") < "1998-01", F.col("periodo") >= "1998-01"
    cheap = F.col("o_totalprice") < 100000
    for arrived in (early, late & cheap, late & ~cheap):
        writer = orders.filter(arrived).write.options(header=True, sep=";")
        writer.mode("append").partitionBy("periodo").csv(source)
        land_new_files(spark, source, schema, table, state)
    return tables.read_table(spark, table)


@check(
    "arrivals_once",
    "SELECT event_id, value, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month FROM events",
)
def _(inputs: Inputs):
    spark = inputs.spark
    source, table, state = (new_folder(spark, name) for name in ("arrive", "once", "state"))
    events = inputs.table("events").select("event_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    third = F.col("event_id") % 3
    # every reading arrives twice, two thirds of them in different rounds
    for arrived in (third < 2, third > 0, third != 1):
        events.where(arrived).write.mode("append").parquet(source)
        land_once(spark, source, "event_id bigint, value double, ts timestamp", table, state, ["event_id"], "ts", "400 days")
    return tables.read_table(spark, table).drop("ts")


@check("glob_scan", "SELECT 'orders.parquet' AS archivo, COUNT(*) AS filas FROM orders")
def _(inputs: Inputs):
    files = tables.read_table(inputs.spark, f"{inputs.folder}/order*.parquet")
    return tables.rows_per_file(files)


@check(
    "write_table",
    "SELECT event_id, user_id, event_type, value, (SELECT COUNT(*) FROM events) AS n FROM events",
)
def _(inputs: Inputs):
    folder = new_folder(inputs.spark, "table")
    events = inputs.table("events").select("event_id", "user_id", "event_type", "value")
    tables.write_table(events, folder)
    written = tables.write_table(events, folder)
    return tables.read_table(inputs.spark, folder).withColumn("n", F.lit(written).cast("long"))


@check(
    "metrics_sink",
    """WITH m AS (SELECT MAGNITUD AS gas, VALIDEZ AS modelo, AVG(ABS(DATO - 50)) AS mae,
                         SQRT(AVG((DATO - 50) * (DATO - 50))) AS rmse, COUNT(*) AS origenes
                  FROM v_air GROUP BY 1, 2)
       SELECT gas, 2 AS horizonte_meses, FIRST_VALUE(modelo) OVER (PARTITION BY gas
              ORDER BY rmse, modelo) AS ganador, modelo, ROUND(mae, 6) AS mae,
              ROUND(rmse, 6) AS rmse, origenes FROM m""",
)
def _(inputs: Inputs):
    from sensoria.plans.forecast.backtest import error_metrics
    from sensoria.plans.forecast.run import metrics_rows

    errors = error_metrics(
        inputs.view("v_air").select(
            F.col("MAGNITUD").alias("gas"),
            F.col("VALIDEZ").alias("modelo"),
            F.col("DATO").alias("dato"),
            F.lit(50.0).alias("yhat"),
        ),
        ["gas", "modelo"],
    )
    sizes = inputs.view("v_air").groupBy(
        F.col("MAGNITUD").alias("gas"), F.col("VALIDEZ").alias("modelo")
    ).agg(F.count(F.lit(1)).alias("origenes"), F.max("FECHA").alias("ultima_fecha_real"))
    from pyspark.sql import Window

    best = Window.partitionBy("gas").orderBy("rmse", "modelo")
    ranking = errors.join(sizes.drop("ultima_fecha_real"), ["gas", "modelo"]).withColumn(
        "puesto", F.row_number().over(best)
    )
    last = sizes.groupBy("gas").agg(F.max("ultima_fecha_real").alias("ultima_fecha_real"))
    folder = new_folder(inputs.spark, "metrics")
    metrics.write_metrics(metrics_rows(ranking, last, 2), folder)
    back = metrics.read_metrics(inputs.spark, folder)
    return back.select("gas", "horizonte_meses", "ganador", F.inline("comparativa"))
