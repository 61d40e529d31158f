"""CSV files inside ZIP archives, as a data source whose partitions are the archives' members."""

from __future__ import annotations

import fnmatch
import json
import re
import zipfile
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sensoria.sources.delimited import FALLBACK_ENCODING, SEPARATOR

FORMAT = "zipped_csv"
ARCHIVE, MEMBER = "_archivo", "_miembro"


def _file_system(path: str):
    """(file system, path in it).  Paths without a scheme and ``file:`` are local or mounted."""
    from pyarrow import fs

    local = re.sub("^file:/*", "/", path)
    if "://" in local:
        return fs.FileSystem.from_uri(local)
    return fs.LocalFileSystem(), local


def archive_paths(path: str) -> list[str]:
    """Archives behind a path: a file, a folder (its ``*.zip``), or a name with wildcards."""
    from pyarrow import fs

    system, inner = _file_system(path)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    folder, _, name = inner.rpartition("/")
    kind = system.get_file_info(inner).type
    if kind == fs.FileType.File:
        return [prefix + inner]
    if kind == fs.FileType.Directory:
        folder, name = inner, "*.zip"
    listed = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    found = [x.path for x in listed if x.type == fs.FileType.File and fnmatch.fnmatchcase(x.base_name, name)]
    return [prefix + x for x in sorted(found)]


def open_archive(path: str) -> zipfile.ZipFile:
    """An archive that is read by seeking: its directory first, then just what is asked for."""
    system, inner = _file_system(path)
    return zipfile.ZipFile(system.open_input_file(inner))


class _Member(InputPartition):
    def __init__(self, archive: str, name: str):
        super().__init__((archive, name))
        self.archive, self.name = archive, name


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options):
        self.columns = [name for name in schema.names if name not in (ARCHIVE, MEMBER)]
        self.paths = json.loads(options["paths"])
        self.pattern = options.get("members", "*")

    def partitions(self) -> Sequence[InputPartition]:
        """One for each member that matches; only directories are read, several at a time."""
        archives = [archive for path in self.paths for archive in archive_paths(path)]
        if not archives:
            raise ValueError(f"no archives in {self.paths}")

        def members(path: str) -> list[_Member]:
            with open_archive(path) as archive:
                names = [info.filename for info in archive.infolist() if not info.is_dir()]
            return [_Member(path, name) for name in names if fnmatch.fnmatchcase(name, self.pattern)]

        with ThreadPoolExecutor(16) as pool:
            return [member for held in pool.map(members, archives) for member in held]

    def read(self, partition: _Member) -> Iterator:
        """Batches of text columns, decompressed and split as a stream."""
        import pyarrow as pa
        from pyarrow import csv

        as_text = csv.ConvertOptions(
            include_columns=self.columns,
            column_types={name: pa.string() for name in self.columns},
            strings_can_be_null=True,
            quoted_strings_can_be_null=True,
            null_values=[""],
        )
        with open_archive(partition.archive) as archive:
            if not archive.getinfo(partition.name).file_size:
                return
            encoding = _encoding(archive, partition.name)
            with archive.open(partition.name) as member:
                # without threads: those read up to 32 blocks ahead of the rows taken
                for batch in csv.open_csv(
                    member,
                    csv.ReadOptions(encoding=encoding, use_threads=False),
                    csv.ParseOptions(delimiter=SEPARATOR, newlines_in_values=True),
                    as_text,
                ):
                    size = batch.num_rows
                    named = [pa.array([value] * size, pa.string()) for value in (partition.archive, partition.name)]
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, *named], [*batch.schema.names, ARCHIVE, MEMBER]
                    )


def _encoding(archive: zipfile.ZipFile, name: str) -> str:
    """UTF-8 if the member can be, else Latin-1; one pass over the stream."""
    with archive.open(name) as member:
        try:
            for line in member:
                line.decode("utf-8")
        except UnicodeDecodeError:
            return FALLBACK_ENCODING
    return "utf-8"


class ZippedCsv(DataSource):
    """Semicolon-separated members of ZIP archives, all columns as text.

    ``spark.read.format("zipped_csv").schema(...).option("paths", <JSON list>).load()``; the option
    ``members`` is a wildcard pattern for member names.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, self.options)


def read_zipped(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str | T.StructType,
    members: str = "*.csv",
    partitions: int | None = None,
    file_columns: bool = False,
) -> DataFrame:
    """Typed rows of the members of ZIP archives whose names match ``members``.

    Columns are found by name in each member's own header; a missing column, a line with
    too many or too few cells, and text that does not fit its column's type end the job.

    A deflate stream has no entry points, so a member is one unit of work.  Tasks seek to it in
    the archive and stream it in Arrow batches: neither an archive nor a member is ever held as
    a whole, on the driver or in a task, and one archive's members are read in parallel.  The
    archives have to lie where Arrow's file systems reach them (mounted folders, s3, gs, hdfs).
    ``partitions`` spreads the rows over that many tasks, for the case of few large members;
    ``file_columns`` adds ``_archivo`` and ``_miembro``.
    """
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    spark.dataSource.register(ZippedCsv)
    text = T.StructType([T.StructField(name, T.StringType()) for name in [*fields.names, ARCHIVE, MEMBER]])
    listed = [paths] if isinstance(paths, str) else list(paths)
    rows = spark.read.format(FORMAT).schema(text).options(paths=json.dumps(listed), members=members).load()
    if partitions:
        rows = rows.repartition(partitions)
    typed = [_typed(F.trim(field.name), field).alias(field.name) for field in fields]
    return rows.select(*typed, *([ARCHIVE, MEMBER] if file_columns else []))


def _typed(text: Column, field: T.StructField) -> Column:
    """The text as a value; NULL only for NULL and empty text."""
    if isinstance(field.dataType, T.StringType):
        return text
    message = F.concat(F.lit(f"{field.name} does not take "), text)
    value = text.try_cast(field.dataType)
    bad = value.isNull() & (text != "")
    return F.when(bad, F.raise_error(message).cast(field.dataType)).otherwise(value)
