import json
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sensoria.plans import ingest
from sensoria.sources import archives, delimited, ledger, resources, schemas, tables
from sensoria.streaming.landing import land_new_files


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_same_text_in_two_encodings(spark, tmp_path):
    text = 'id;nombre\n1;Peñalara\n2;"a;b"\n3;""\n4;\n'
    (tmp_path / "u.csv").write_bytes(text.encode("utf-8"))
    (tmp_path / "l.csv").write_bytes(text.encode("latin-1"))
    found = {
        r.archivo.rsplit("/", 1)[1]: r.encoding
        for r in delimited.file_encodings(spark, str(tmp_path)).collect()
    }
    assert found == {"u.csv": "UTF-8", "l.csv": "ISO-8859-1"}
    expected = [(1, "Peñalara"), (2, "a;b"), (3, None), (4, None)]
    both = delimited.read_delimited(spark, str(tmp_path), "id int, nombre string")
    assert sorted(both.collect()) == sorted(expected * 2, key=lambda r: r[0])


def test_inference_with_overrides(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b;c\n1;2;2024-01-01\n3;4;2024-01-02\n")
    df = delimited.read_delimited(spark, str(tmp_path / "t.csv"), types={"b": "double"})
    assert df.dtypes == [("a", "int"), ("b", "double"), ("c", "date")]


def test_rejected_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b\n1;2\nx;4\n5;6;7\n")
    bad = delimited.rejected_lines(spark, str(tmp_path / "t.csv"), "a int, b int")
    assert sorted(r.linea for r in bad.collect()) == ["5;6;7", "x;4"]


def _zip(path, text, encoding="utf-8", name="datos.csv"):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr(name, text.encode(encoding))
        archive.writestr("readme.txt", "nothing")


def test_zipped_csv(spark, tmp_path):
    body = '"b";"a";"n"\n{}\n'
    _zip(tmp_path / "1.zip", body.format('2.5;1;"ñ"\n;2;""'))
    _zip(tmp_path / "2.zip", body.format('7;3;"ñ\nñ"'), "latin-1")
    paths = str(tmp_path / "*.zip")
    df = archives.read_zipped(spark, paths, "a int, b double, n string", partitions=3)
    assert sorted(df.collect(), key=lambda r: r.a) == [(1, 2.5, "ñ"), (2, None, None), (3, 7.0, "ñ\nñ")]
    with pytest.raises(Exception, match="z"):
        archives.read_zipped(spark, paths, "a int, z int").collect()
    with pytest.raises(Exception, match="does not take"):
        archives.read_zipped(spark, paths, "n int").collect()
    with pytest.raises(Exception, match="no archives"):
        archives.read_zipped(spark, str(tmp_path / "*.tar"), "a int").collect()


def test_members_are_partitions(spark, tmp_path):
    for number in range(2):
        with zipfile.ZipFile(tmp_path / f"{number}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
            for member in range(3):
                lines = "".join(f"{number * 100 + member * 10 + i};x\n" for i in range(4))
                archive.writestr(f"in/part {member}.csv", "id;v\n" + lines)
            archive.writestr("in/empty.csv", "")
            archive.writestr("in/notes.txt", "id;v\nnone;0\n")
            archive.mkdir("in/dir.csv")
    df = archives.read_zipped(spark, [f"file://{tmp_path}"], "id int", file_columns=True)
    assert df.rdd.getNumPartitions() == 8  # empty members count
    found = {(r._archivo.rsplit("/", 1)[1], r._miembro, r.id) for r in df.collect()}
    assert found == {
        (f"{a}.zip", f"in/part {m}.csv", a * 100 + m * 10 + i) for a in range(2) for m in range(3) for i in range(4)
    }
    one = archives.read_zipped(spark, str(tmp_path / "1.zip"), "id int", members="*2.csv")
    assert rows(one) == [(120,), (121,), (122,), (123,)]


def test_a_member_is_streamed(spark, tmp_path):
    """The reader's memory does not follow the member's size."""
    import tracemalloc

    import pyarrow as pa

    line = "1;" + "x" * 200 + "\n"
    peaks = []
    for size in (20_000, 200_000):
        with zipfile.ZipFile(tmp_path / f"{size}.zip", "w", zipfile.ZIP_DEFLATED) as archive, archive.open(
            "a.csv", "w"
        ) as member:
            member.write(b"id;v\n")
            for _ in range(size // 1000):
                member.write(line.encode() * 1000)
        options = {"paths": json.dumps([str(tmp_path / f"{size}.zip")])}
        from pyspark.sql.types import StructType

        reader = archives._Reader(StructType.fromDDL("id string, v string"), options)
        (partition,) = reader.partitions()
        held, count, most = pa.total_allocated_bytes(), 0, 0
        tracemalloc.start()
        for batch in reader.read(partition):
            count += batch.num_rows
            most = max(most, pa.total_allocated_bytes() - held)
        peaks.append(most + tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert count == size
    assert peaks[1] < 1.5 * peaks[0] + 4_000_000 and peaks[1] < 30_000_000


def test_archives_of_the_check_are_staged_without_a_sort(spark, monkeypatch):
    """Tasks write their lines as they come: no exchange or sort whose memory follows the table."""
    from pyspark.sql.classic.dataframe import DataFrame

    from sensoria.checks import of_sources, registry

    plans, whole = [], DataFrame.mapInPandas

    def seen(self, *args, **kwargs):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return whole(self, *args, **kwargs)

    monkeypatch.setattr(DataFrame, "mapInPandas", seen)
    monkeypatch.setattr(of_sources, "LINES_A_MEMBER", 1500)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        found = registry.QUERIES["zip_csv_source"](spark, "/root/testdata/sf0.001")
        assert found.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Sort" not in plans[0]


def _payload():
    entries = [
        {"name": "r1", "description": "Enero 2024", "format": "ZIP", "url": "u1"},
        {"name": "r2", "description": "Enero 2024", "format": "CSV", "url": "u2"},
        {"name": "r3", "description": "Enero 2024", "format": "CSV", "url": "u3"},
        {"name": "r4", "description": "Abril 2023", "format": "CSV", "url": "u4"},
    ]
    return json.dumps({"result": {"resources": entries}, "success": True})


def test_resource_choice(spark):
    packages = spark.createDataFrame([("aire", _payload())], "dataset string, payload string")
    found = resources.resource_rows(packages)
    assert found.count() == 4
    assert resources.of_period(found, "2024").count() == 3
    assert resources.first_match(found, "dataset", "Enero 2024").first().name == "r2"
    assert resources.first_match(found, "dataset", None, "ZIP").first().name == "r1"
    with pytest.raises(ValueError):
        resources.require_match(resources.first_match(found, "dataset", "2022"), "2022")


LEDGER = "periodo string, resource string, rows bigint"


def test_ledger_upsert(spark):
    old = spark.createDataFrame([("2023", "a", 1), ("2024", "b", 2)], LEDGER)
    new = spark.createDataFrame([("2024", "c", 3)], LEDGER)
    assert rows(ledger.upsert_entries(old, new, "periodo")) == [("2023", "a", 1), ("2024", "c", 3)]
    snapshot = spark.createDataFrame([(None, "d", 4)], LEDGER)
    assert rows(ledger.upsert_entries(old, snapshot, None)) == [(None, "d", 4)]


def test_missing_periods(spark):
    grid = ledger.period_grid(spark, 2023, 2024)
    assert grid.count() == 2 * 12 * 2 + 2
    done = spark.createDataFrame(
        [("aire", "2023"), ("trafico", "2024-05")], "dataset string, periodo string"
    )
    left = rows(ledger.missing_periods(grid, done))
    assert len(left) == 48 and ("trafico", "2024-05") not in left


def test_rewriting_a_period_leaves_the_others(spark, tmp_path):
    folder = str(tmp_path / "t")
    df = spark.createDataFrame([(2023, 1, 1.0), (2024, 1, 2.0)], "year int, month int, v double")
    assert tables.write_periods(df, folder) == 2
    tables.write_periods(df.filter("year = 2024").withColumn("v", F.lit(9.0)), folder)
    back = tables.read_table(spark, folder).select("year", "month", "v")
    assert rows(back) == [(2023, 1, 1.0), (2024, 1, 9.0)]


def test_whole_table_overwrite(spark, tmp_path):
    folder = str(tmp_path / "t")
    for _ in range(2):
        assert tables.write_table(spark.range(5), folder) == 5
    assert tables.read_table(spark, folder).count() == 5


def test_clustered_write_keeps_and_counts_all_rows(spark, tmp_path):
    folder = str(tmp_path / "t")
    df = spark.range(1000).select(F.lit(1).alias("day"), "id")
    assert tables.write_table(df, folder, ("day", "id")) == 1000
    assert tables.read_table(spark, folder).distinct().count() == 1000


def test_landing_is_incremental_and_repeatable(spark, tmp_path):
    source, table, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def land(name, text):
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
        land_new_files(spark, source, "id int, v double", table, state)
        return rows(tables.read_table(spark, table).select("year", "month", "id", "v"))

    land("periodo=2024-01/a.csv", "id;v\n1;1.0\n")
    whole_year = (2023, 0, 2, 2.0)
    assert land("periodo=2023/a.csv", "id;v\n2;2.0\n") == [whole_year, (2024, 1, 1, 1.0)]
    parts = land("periodo=2024-01/b.csv", "id;v\n3;3.0\n")
    assert parts == [whole_year, (2024, 1, 1, 1.0), (2024, 1, 3, 3.0)]
    (tmp_path / "in" / "periodo=2024-01" / "a.csv").unlink()
    corrected = [whole_year, (2024, 1, 1, 5.0), (2024, 1, 3, 3.0)]
    assert land("periodo=2024-01/c.csv", "id;v\n1;5.0\n") == corrected
    land_new_files(spark, source, "id int, v double", table, state)
    assert rows(tables.read_table(spark, table).select("year", "month", "id", "v")) == corrected


def test_ingest_keeps_a_ledger(spark, tmp_path):
    lake = tables.Lakehouse(spark, str(tmp_path / "lake"))
    _zip(
        tmp_path / "m.zip",
        "id;fecha;tipo_elem;intensidad;ocupacion;carga;vmed;error;periodo_integracion\n"
        "7;2024-01-01 00:15:00;URB;10;1;2;NaN;N;15\n",
    )
    (tmp_path / "s.csv").write_text("CODIGO_CORTO;ESTACION\n4;Plaza\n")
    for _ in range(2):
        zipped = str(tmp_path / "m.zip")
        assert ingest.ingest_zip(lake, "trafico", zipped, schemas.TRAFFIC, "2024-01", "r") == 1
        assert ingest.ingest_csv(lake, "estaciones_aire", str(tmp_path / "s.csv")) == 1
    row = lake.bronze("trafico").first()
    assert (row.id, row.fecha, row.year, row.month) == (7, datetime(2024, 1, 1, 0, 15), 2024, 1)
    entries = rows(ingest.read_ledger(lake).select("dataset", "periodo", "rows"))
    assert entries == [("estaciones_aire", "latest", 1), ("trafico", "2024-01", 1)]


def test_landed_files_load_in_one_job(spark, tmp_path):
    lake = tables.Lakehouse(spark, str(tmp_path / "lake"))
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "2023.csv").write_bytes("id;n\n1;ñ\n2;b\n".encode("latin-1"))
    (landed / "2024-5.csv").write_text("id;n\n3;ñ\n")
    for _ in range(2):
        entries = ingest.ingest_landed(lake, "aire", str(landed), "id int, n string")
    assert rows(entries.select("periodo", "rows")) == [("2023", 2), ("2024-05", 1)]
    back = rows(lake.bronze("aire").select("year", "month", "id", "n"))
    assert back == [(2023, 0, 1, "ñ"), (2023, 0, 2, "b"), (2024, 5, 3, "ñ")]


def test_a_ledger_of_years_still_meets_monthly_periods(spark, tmp_path):
    lake = tables.Lakehouse(spark, str(tmp_path / "lake"))
    ingest.record_load(lake, "aire", "2023", "r", 1)
    ingest.record_load(lake, "aire", "2024", "r", 1)
    grid = ledger.period_grid(spark, 2023, 2025)
    left = rows(ledger.missing_periods(grid, ingest.read_ledger(lake)))
    assert len(left) == 3 * 12 * 2 + 1 and ("aire", "2025") in left


def test_backfill_goes_on_after_a_failure():
    done = []

    def fail():
        raise OSError("corrupt")

    rejects = ingest.backfill([("a", fail), ("b", lambda: done.append("b"))])
    assert done == ["b"] and rejects == [("a", "corrupt")]


def test_columns_are_bound_by_header(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("id;v\n1;10\n")
    (tmp_path / "c.csv").write_bytes("v;extra;id\n3.5;ñ;2\n".encode("latin-1"))
    (tmp_path / "d.csv").write_text('id;v\n3;"4"\n')
    with pytest.raises(ValueError, match="extra"):
        delimited.read_delimited(spark, str(tmp_path))
    found = delimited.read_delimited(spark, str(tmp_path), "id int, v double")
    assert rows(found) == [(1, 10.0), (2, 3.5), (3, 4.0)]
    with pytest.raises(ValueError, match="missing"):
        delimited.read_delimited(spark, str(tmp_path), "id int, w int")


def test_types_are_inferred_over_all_files(spark, tmp_path):
    (tmp_path / "u.csv").write_text("n;v\na;10\n")
    (tmp_path / "l.csv").write_bytes("v;n\n3.5;ñ\n".encode("latin-1"))
    found = delimited.read_delimited(spark, str(tmp_path))
    assert dict(found.dtypes) == {"n": "string", "v": "double"}
    assert {(r.n, r.v) for r in found.collect()} == {("a", 10.0), ("ñ", 3.5)}


def test_bad_lines_fail_or_are_listed(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b\n1;2\nx;4\n5;6;7\n8\n")
    schema = "a int, b int"
    with pytest.raises(Exception, match="does not fit"):
        delimited.read_delimited(spark, str(tmp_path), schema).collect()
    kept = delimited.read_delimited(spark, str(tmp_path), schema, bad="reject")
    listed = delimited.rejected_lines(spark, str(tmp_path), schema)
    assert rows(kept) == [(1, 2)]
    assert sorted(r.linea for r in listed.collect()) == ["5;6;7", "8", "x;4"]


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a;b\n1;"two\nlines"\n2;"x"\n')
    (tmp_path / "p.csv").write_text("a;b\n3;plain\n")
    found = delimited.read_delimited(spark, str(tmp_path), "a int, b string")
    assert rows(found) == [(1, "two\nlines"), (2, "x"), (3, "plain")]


def test_an_empty_reload_empties_its_period(spark, tmp_path):
    lake = tables.Lakehouse(spark, str(tmp_path / "lake"))
    full = spark.createDataFrame([(1,)], "id int")
    ingest.load_period(lake, "aire", "2024-01", full, "r")
    ingest.load_period(lake, "aire", "2024-02", full, "r")
    ingest.load_period(lake, "aire", "2024-01", full.limit(0), "r")
    assert rows(lake.bronze("aire").select("year", "month")) == [(2024, 2)]
    assert rows(ingest.read_ledger(lake).select("periodo", "rows")) == [("2024-01", 0), ("2024-02", 1)]


def test_landing_writes_the_ledger(spark, tmp_path):
    lake = tables.Lakehouse(spark, str(tmp_path / "lake"))
    source = tmp_path / "in"
    for period, text in (("2024-01", "id;n\n1;ñ\n"), ("2024-02", "n;id\nx;2\ny;3\n")):
        (source / f"periodo={period}").mkdir(parents=True)
        (source / f"periodo={period}" / "a b.csv").write_bytes(text.encode("latin-1"))
    ingest.land(lake, "aire", str(source), "id int, n string", str(tmp_path / "state"))
    assert rows(lake.bronze("aire").select("month", "id", "n")) == [(1, 1, "ñ"), (2, 2, "x"), (2, 3, "y")]
    (source / "periodo=2024-02" / "a b.csv").unlink()
    (source / "periodo=2024-02" / "b.csv").write_text("id;n\n")
    ingest.land(lake, "aire", str(source), "id int, n string", str(tmp_path / "state"))
    assert rows(lake.bronze("aire").select("month", "id", "n")) == [(1, 1, "ñ")]
    assert rows(ingest.read_ledger(lake).select("periodo", "rows")) == [("2024-01", 1), ("2024-02", 0)]


def test_a_file_without_a_period_ends_the_load(spark, tmp_path):
    lake = tables.Lakehouse(spark, str(tmp_path / "lake"))
    (tmp_path / "2024-05.csv").write_text("id;n\n3;x\n")
    (tmp_path / "notes.csv").write_text("id;n\n9;x\n")
    with pytest.raises(Exception, match="notes"):
        ingest.ingest_landed(lake, "aire", str(tmp_path), "id int, n string")


def test_the_last_entry_of_a_batch_stays(spark):
    old = spark.createDataFrame([("2023", "a", 1)], LEDGER)
    new = spark.createDataFrame([("2023", "z", 2, 1), ("2023", "b", 3, 2)], LEDGER + ", n int")
    assert rows(ledger.upsert_entries(old, new, "periodo", "n")) == [("2023", "b", 3)]


def _split_at(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def small_splits(spark):
    _split_at(spark, 64)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quoted_records_over_many_splits(spark, tmp_path, small_splits):
    import csv
    import random

    random.seed(3)
    pieces = ["plain", "two\nlines", 'a "quoted" word', "semi;colon", "", "ñandú", "\n\n", "x" * 150, "\n" + "y" * 90 + "\n;"]
    wanted = []
    for name, encoding, count in (("a.csv", "utf-8", 80), ("b.csv", "latin-1", 60), ("c.csv", "utf-8", 0), ("d.csv", "utf-8", 9)):
        with (tmp_path / name).open("w", encoding=encoding, newline="") as file:
            writer = csv.writer(file, delimiter=";", lineterminator="\n" if name != "d.csv" else "\r\n")
            writer.writerow(["id", "t"])
            for i in range(count):
                cell = random.choice(pieces) + random.choice(["", *pieces])
                writer.writerow([i, cell])
                wanted.append((i, cell or None))
    found = delimited.read_delimited(spark, str(tmp_path), "id int, t string")
    key = lambda r: (r[0], r[1] or "")
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(wanted, key=key)
    # the file with breaks is read in several tasks
    assert spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 10
    assert delimited.rejected_lines(spark, str(tmp_path), "id int, t string").count() == 0


def test_one_scan_for_three_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;v\n1;1\n")
    (tmp_path / "b.csv").write_text("v;id\n2;2\n")
    (tmp_path / "c.csv").write_bytes('id;ñ;v\n3;x;"3"\n'.encode("latin-1"))
    found = delimited.read_delimited(spark, str(tmp_path), "id int, v int")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "FileScan csv" not in plan
    assert rows(found) == [(1, 1), (2, 2), (3, 3)]


def test_odd_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('\ufeff"id";"v"\n1;5" pipe\n2;"a ""b"" c"\n3;""\n4;"""x"""\n"5";"y"\n\n6;"open\n')
    (tmp_path / "u.csv").write_text("id;v\n7;z\nx;w\n")
    schema = "id int, v string"
    good = delimited.read_delimited(spark, str(tmp_path), schema, bad="reject")
    assert rows(good.where("id < 6 OR id = 7").fillna("-")) == [
        (1, '5" pipe'), (2, 'a "b" c'), (3, "-"), (4, '"x"'), (5, "y"), (7, "z")
    ]
    bad = delimited.rejected_lines(spark, str(tmp_path), schema).collect()
    assert "x;w" in [r.linea for r in bad]
    # no record is lost, whatever its quotes
    assert good.count() + len(bad) == 8


def test_a_landed_file_without_rows_empties_its_period(spark, tmp_path):
    lake = tables.Lakehouse(spark, str(tmp_path / "lake"))
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "2024-01.csv").write_text("id;n\n1;a\n")
    (landed / "2024-02.csv").write_text("id;n\n2;b\n")
    (landed / "2024-03.csv").write_text("id;n\n3;c\n")
    ingest.ingest_landed(lake, "aire", str(landed), "id int, n string")
    (landed / "2024-01.csv").write_text("id;n\n")
    (landed / "2024-03.csv").write_text("")
    entries = ingest.ingest_landed(lake, "aire", str(landed), "id int, n string")
    assert rows(entries.select("periodo", "rows")) == [("2024-01", 0), ("2024-02", 1), ("2024-03", 0)]
    assert rows(lake.bronze("aire").select("month", "id")) == [(2, 2)]
    (landed / "2024-02.csv").write_text("")
    entries = ingest.ingest_landed(lake, "aire", str(landed), "id int, n string")
    assert {r.rows for r in entries.collect()} == {0}


def test_ingest_of_all_datasets_goes_on(spark, tmp_path):
    lake = tables.Lakehouse(spark, str(tmp_path / "lake"))
    for name, files in {"aire": {"2023.csv": "id;n\n1;a\n"}, "trafico": {"2023-05.csv": "id;n\nx;a\n"}}.items():
        (tmp_path / "in" / name).mkdir(parents=True)
        for file, text in files.items():
            (tmp_path / "in" / name / file).write_text(text)
    kinds = {"trafico": "id int, n string", "aire": "id int, n string", "trafico_puntos_medida": "id int"}
    rejects, missing = ingest.ingest_all(lake, str(tmp_path / "in"), kinds, 2023, 2023)
    assert [name for name, _ in rejects] == ["trafico", "trafico_puntos_medida"]
    assert rows(missing.groupBy("dataset").count()) == [("trafico", 12), ("trafico_puntos_medida", 12)]


def test_staged_folders_are_removed(spark, tmp_path):
    from pathlib import Path

    from sensoria.session import shared_folder

    shared = Path(shared_folder(spark)) / "sensoria"
    before = set(shared.glob("*"))
    lake = tables.Lakehouse(spark, str(tmp_path / "lake"))
    (tmp_path / "2024-01.csv").write_text('id;n\n1;"a\nb"\n')
    ingest.ingest_landed(lake, "aire", str(tmp_path), "id int, n string")
    assert set(shared.glob("*")) == before


def test_arrivals_land_once_and_state_stays_bounded(spark, tmp_path):
    from datetime import timedelta

    from sensoria.streaming.arrivals import land_once

    source, table, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    schema = "id bigint, v double, fecha timestamp"
    start = datetime(2024, 1, 1)
    for day in range(0, 40, 4):
        arrived = [(d, float(day), start + timedelta(days=d)) for d in range(max(0, day - 3), day + 4)]
        spark.createDataFrame(arrived + arrived[:2], schema).write.mode("append").parquet(source)
        land_once(spark, source, schema, table, state, ["id"], "fecha", "10 days")
    found = tables.read_table(spark, table)
    assert sorted(r.id for r in found.collect()) == list(range(40))
    assert found.where("id = 4").first().v == 4.0  # the first arrival stays
    held = spark.read.format("statestore").load(state).count()
    assert held < 25
