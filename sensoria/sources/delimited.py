"""Delimited text files: columns by header name, encoding per file, no value lost in silence."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensoria.session import cut_lineage, literal_table

SEPARATOR = ";"
FALLBACK_ENCODING = "ISO-8859-1"
BAD_LINE = "_rechazo"
FAIL, REJECT = "fail", "reject"
#: Types tried for a column without a given type, narrowest first.
INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")
MOST_LAYOUTS = 1000
#: Up to so many splits (about 100 bytes each) their table is broadcast; beyond, joined.
MOST_BROADCAST = 200_000
#: A quote that opens or closes a cell, once doubled quotes are taken out.
BORDER_QUOTE = r'(?<![^;\ufeff])"|"(?=;|\r?$)'


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _lines(spark: SparkSession, paths: str | Sequence[str], partitions: str = "") -> DataFrame:
    """Raw lines with their file, the split they begin in and their place in it."""
    schema = T.StructType([T.StructField("value", T.StringType()), *_folders(partitions)])
    return spark.read.schema(schema).option("lineSep", "\n").text(_paths(paths)).select(
        "value",
        *[field.name for field in _folders(partitions)],
        F.col("_metadata.file_path").alias("archivo"),
        F.col("_metadata.file_block_start").alias("inicio"),
        F.monotonically_increasing_id().alias("orden"),
    )


def _folders(partitions: str) -> list[T.StructField]:
    return T.StructType.fromDDL(partitions).fields if partitions else []


def border_quotes(line: Column) -> Column:
    """Number of quotes that open or close a cell of a line.

    An odd number means that a record with a line break in it begins or ends here.  Doubled
    quotes and quotes in the middle of a cell do not count.
    """
    single = F.replace(line, F.lit('""'), F.lit(""))
    found = F.regexp_count(single, F.lit(BORDER_QUOTE))
    return F.when(F.contains(line, F.lit('"')), found).otherwise(0)


def file_encodings(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(archivo, encoding) per file: UTF-8 if every byte of it is valid UTF-8.

    Text lines keep their raw bytes and a line break never lies inside a UTF-8
    sequence, so large files are checked split by split and only one flag per
    split is shuffled.
    """
    valid = F.bool_and(F.is_valid_utf8("value"))
    return _lines(spark, paths).groupBy("archivo").agg(valid.alias("ok")).select(
        "archivo", F.when(F.col("ok"), "UTF-8").otherwise(FALLBACK_ENCODING).alias("encoding")
    )


def file_splits(
    spark: SparkSession, paths: str | Sequence[str], encoding: str | None = None
) -> DataFrame:
    """One row per split: its file's encoding and header, and where its records begin.

    Only counts leave the tasks.  Whether a split begins inside a quoted value follows from a
    running sum of the splits before it, so no file is read as a whole.  ``dueno`` is the split
    in which the record that runs into this one began; ``impares`` counts lines at which a
    record with a line break begins or ends, ``ultimo`` marks the end of a file.
    """
    found = _lines(spark, paths).groupBy("archivo", "inicio").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("ok"),
        F.min_by(F.col("value").cast("binary"), "orden").alias("primera"),
        F.min("orden").alias("orden_primera"),
        F.sum(border_quotes(F.col("value")) % 2).alias("impares"),
    )
    file = Window.partitionBy("archivo")
    order = file.orderBy("inicio")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    found = found.select(
        "archivo", "inicio", "impares", "orden_primera",
        F.min("ok").over(file).alias("ok"),
        F.max(F.when(F.col("inicio") == 0, F.col("primera"))).over(file).alias("header"),
        (F.coalesce(F.sum("impares").over(before), F.lit(0)) % 2 == 1).alias("dentro"),
        F.max(F.when(F.col("impares") > 0, F.col("inicio"))).over(before).alias("dueno"),
        F.lead("inicio").over(order).isNull().alias("ultimo"),
    )
    name = F.lit(encoding) if encoding else F.when(F.col("ok"), "UTF-8").otherwise(FALLBACK_ENCODING)
    # bytes that are no UTF-8 are taken as Latin-1 in the header, whatever the encoding asked for
    text = F.when(F.col("ok"), F.decode("header", "UTF-8")).otherwise(F.decode("header", FALLBACK_ENCODING))
    return found.withColumns({"encoding": name, "header": F.rtrim(text, F.lit("\r"))}).drop("ok")


def header_names(header: str) -> list[str]:
    """Column names of a header line."""
    return [name.strip() for name in next(csv.reader([header.removeprefix("﻿")], delimiter=SEPARATOR))]


def _struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _assembled(lines: DataFrame, extra: list[str]) -> DataFrame:
    """Records from the lines of files with quoted line breaks.

    Splits without such records pass through as they are.  Every other split is walked line by
    line from the state it begins in.  Records that lie in one split are whole; of one that
    crosses a border the parts are kept by the split it began in, and joined in order.
    """
    kept = ["archivo", "formato", *extra]
    kinds = {field.name: field.dataType.simpleString() for field in lines.schema}
    crossing = lines.select("value", "inicio", "dentro", "dueno", "impares", "ultimo", *kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        border = re.compile(BORDER_QUOTE.replace("\\ufeff", "\xef\xbb\xbf").encode("latin-1"))
        place: tuple | None = None
        inside, held, owner, rest = False, [], None, ()

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, target, strict=True)], names
            )

        for batch in batches:
            names = ["value", "inicio", "dueno", *kept]
            target = [batch.schema.field(name).type for name in names]
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            rows: list[tuple] = []
            for value, start, begins, before, odd, last, *others in zip(*columns, strict=True):
                if (others[0], start) != place:
                    if held:
                        rows.append((b"\n".join(held), place[1], None if at_end and owner == place[1] else owner, *rest))
                    place, inside, held, owner, rest, at_end = (others[0], start), begins, [], before, others, last
                    if not inside:
                        owner = None
                if not odd and not inside:
                    rows.append((value, start, None, *others))
                    continue
                held.append(value)
                if len(border.findall(value.replace(b'""', b""))) % 2:
                    inside = not inside
                    if inside:
                        owner = start
                if not inside:
                    whole = owner is None or owner == start
                    rows.append((b"\n".join(held), start, None if whole else owner, *others))
                    held, owner = [], None
            if rows:
                yield out(rows)
        if held:
            yield out([(b"\n".join(held), place[1], None if at_end and owner == place[1] else owner, *rest)])

    fields = ["value binary", "inicio bigint", "dueno bigint", *[f"`{name}` {kinds[name]}" for name in kept]]
    return crossing.withColumn("value", F.col("value").cast("binary")).mapInArrow(run, ", ".join(fields))


class _Layouts:
    """The files behind some paths, grouped by encoding and header.

    Only the distinct layouts come to the driver, never a list of files.
    """

    def __init__(self, spark: SparkSession, paths, encoding: str | None):
        self.spark, self.paths = spark, _paths(paths)
        self.splits = cut_lineage(file_splits(spark, paths, encoding))
        self.kinds = (
            self.splits.select("encoding", "header").distinct()
            .orderBy("encoding", "header").limit(MOST_LAYOUTS + 1).collect()
        )
        if not self.kinds:
            raise ValueError(f"no lines in {paths}")
        if len(self.kinds) > MOST_LAYOUTS:
            raise ValueError(f"more than {MOST_LAYOUTS} different headers in {paths}")
        self.names = [header_names(kind["header"]) for kind in self.kinds]

    def require(self, wanted: Sequence[str]) -> None:
        for kind, names in zip(self.kinds, self.names, strict=True):
            missing = [name for name in wanted if name not in names]
            if missing:
                raise ValueError(f"columns {missing} are missing below the header {kind['header']!r}")

    def records(self, partitions: str) -> DataFrame:
        """``value`` (text), ``formato`` and file of every record, headers and blank lines left out."""
        extra = [field.name for field in _folders(partitions)]
        numbered = literal_table(
            self.spark, [(kind["encoding"], kind["header"], i) for i, kind in enumerate(self.kinds)],
            "encoding string, header string, formato int",
        )
        splits = self.splits.join(numbered, ["encoding", "header"]).drop("encoding", "header")
        facts = self.splits.agg(
            F.count(F.lit(1)).alias("n"), F.max(F.col("impares") > 0).alias("broken"), F.max("dentro").alias("crossed")
        ).first()
        if facts["n"] <= MOST_BROADCAST:
            splits = F.broadcast(splits)
        lines = _lines(self.spark, self.paths, partitions).join(splits, ["archivo", "inicio"])
        lines = lines.where((F.col("inicio") > 0) | (F.col("orden") > F.col("orden_primera")))
        if facts["broken"]:
            found = _assembled(lines, extra)
            whole = found.where("dueno IS NULL")
            if facts["crossed"]:
                part = F.struct("inicio", F.col("value").cast("string").alias("value"))
                parts = found.where("dueno IS NOT NULL").groupBy("archivo", "formato", "dueno", *extra).agg(
                    F.sort_array(F.collect_list(part)).alias("parts")
                )
                joined = F.array_join(F.transform("parts", lambda p: p["value"]), "\n").cast("binary")
                whole = whole.select("value", "archivo", "formato", *extra).unionByName(
                    parts.select(joined.alias("value"), "archivo", "formato", *extra)
                )
            lines = whole
        raw = F.col("value").cast("binary")
        text = None
        for name in sorted({kind["encoding"] for kind in self.kinds}):
            own = F.col("value").cast("string") if name == "UTF-8" else F.decode(raw, name)
            of_name = [i for i, kind in enumerate(self.kinds) if kind["encoding"] == name]
            hit = F.col("formato").isin(of_name)
            text = F.when(hit, own) if text is None else text.when(hit, own)
        return lines.select(F.rtrim(text, F.lit("\r")).alias("value"), "archivo", "formato", *extra).where(
            F.trim("value") != ""
        )

    def rows(self, schema: T.StructType, partitions: str) -> DataFrame:
        """Columns of the schema, bad line (NULL if good), partition columns and file, in one scan."""
        parsed = None
        for number, names in enumerate(self.names):
            own = self._parsed(names, schema)
            hit = F.col("formato") == number
            parsed = F.when(hit, own) if parsed is None else parsed.when(hit, own)
        extra = [field.name for field in _folders(partitions)]
        # not deterministic, so that no filter on a cell moves below: headers are gone when a record
        # is parsed, and it is parsed once
        parsed = F.when(F.monotonically_increasing_id() >= 0, parsed)
        rows = self.records(partitions).select(parsed.alias("_fila"), *extra, F.col("archivo").alias("_archivo"))
        cells = [F.col("_fila")[f"c{i}"].alias(field.name) for i, field in enumerate(schema)]
        return rows.select(*cells, F.col("_fila")[BAD_LINE].alias(BAD_LINE), *extra, "_archivo")

    def _parsed(self, names: list[str], schema: T.StructType) -> Column:
        """The cells of a record with these columns, as a struct of the wanted ones."""
        typed = {field.name: field.dataType for field in schema}
        fields = [T.StructField(f"n{i}", typed.get(name, T.StringType())) for i, name in enumerate(names)]
        record = T.StructType([*fields, T.StructField(BAD_LINE, T.StringType())])
        options = {"sep": SEPARATOR, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
        found = F.from_csv(F.col("value"), record.toDDL(), options)

        def wanted(row: Column) -> Column:
            cells = []
            for i, field in enumerate(schema):
                cell = row[f"n{names.index(field.name)}"]
                if isinstance(field.dataType, T.StringType):
                    cell = F.nullif(cell, F.lit(""))
                cells.append(cell.alias(f"c{i}"))
            return F.struct(*cells, row[BAD_LINE].alias(BAD_LINE))

        # bound once, so that each record is parsed once, and with all its cells
        return F.transform(F.array(found), wanted)[0]


def inferred_schema(
    spark: SparkSession,
    paths: str | Sequence[str],
    types: Mapping[str, str] | None = None,
    encoding: str | None = None,
) -> T.StructType:
    """Column types that hold every value of every file, with overrides by name.

    One extra pass: all columns are read as text and the narrowest type that takes all
    values is kept, whatever file they come from.  Give :func:`read_delimited` a schema
    instead wherever it is known.
    """
    return _inferred(_Layouts(spark, paths, encoding), types or {}, "")


def _inferred(layouts: _Layouts, types: Mapping[str, str], partitions: str) -> T.StructType:
    names = list(dict.fromkeys(name for found in layouts.names for name in found))
    layouts.require(names)
    open_names = [name for name in names if name not in types]
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    fits = layouts.rows(text, partitions).agg(*[
        F.coalesce(F.bool_and(F.col(f"`{name}`").isNull() | _fits(F.col(f"`{name}`"), kind)), F.lit(True)).alias(f"{i}_{kind}")
        for i, name in enumerate(open_names) for kind in INFERRED
    ]).first() if open_names else {}
    chosen = {
        name: next((kind for kind in INFERRED if fits[f"{i}_{kind}"]), "string") for i, name in enumerate(open_names)
    } | dict(types)
    return T.StructType([T.StructField(name, T.StructType.fromDDL(f"c {chosen[name]}")["c"].dataType) for name in names])


def _fits(value: Column, kind: str) -> Column:
    parsed = value.try_cast(kind).isNotNull()
    if kind == "date":
        return value.rlike(r"^\d{4}-\d{2}-\d{2}$") & parsed
    if kind == "timestamp":
        return value.rlike(r"^\d{4}-\d{2}-\d{2}[T ]") & parsed
    if kind == "boolean":
        return F.lower(value).isin("true", "false")
    return parsed


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str | T.StructType | None = None,
    types: Mapping[str, str] | None = None,
    encoding: str | None = None,
    file_column: str | None = None,
    bad: str = FAIL,
    partitions: str = "",
) -> DataFrame:
    """Rows of semicolon-separated files with a header line.

    Columns are bound by each file's own header, one line; a file that lacks one is an error,
    further columns are left out.  Without an encoding each file is UTF-8 if it can be, else
    Latin-1; an encoding given has to agree with ASCII in its lower half.  Lines end with a line
    feed, which a carriage return may precede.  A quote inside a quoted value is doubled.  Quoted
    empty values are NULL; quoted line breaks are part of the value, and files with them are split
    like any other.

    A first pass counts by split; the result is one scan of the text, whatever the number of
    layouts.  It reads the table of splits staged by the first pass: keep it and the last write
    inside :func:`sensoria.session.staging`.

    A line with too few or too many cells, or a cell that does not fit its type, ends the
    job (``bad="fail"``) or is left out (``bad="reject"``): :func:`rejected_lines` lists
    those.  ``file_column`` adds the path of the file each row came from; ``partitions``
    names and types the folder columns below the path.
    """
    if bad not in (FAIL, REJECT):
        raise ValueError(f"bad must be {FAIL!r} or {REJECT!r}, not {bad!r}")
    layouts = _Layouts(spark, paths, encoding)
    wanted = _inferred(layouts, types or {}, partitions) if schema is None else _struct(schema)
    layouts.require(wanted.names)
    rows = layouts.rows(wanted, partitions)
    if bad == FAIL:
        message = F.concat(F.lit("a line does not fit: "), F.col(BAD_LINE), F.lit(" in "), F.col("_archivo"))
        good = F.when(F.col(BAD_LINE).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    else:
        good = F.col(BAD_LINE).isNull()
    # true for any row, and makes the parser look at every cell whatever is selected later
    good = good & (F.xxhash64(*wanted.names) >= F.lit(-(2**63)))
    folders = T.StructType.fromDDL(partitions).names if partitions else []
    extra = [F.col("_archivo").alias(file_column)] if file_column else []
    return rows.filter(good).select(*wanted.names, *folders, *extra)


def rejected_lines(
    spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType, encoding: str | None = None
) -> DataFrame:
    """Lines that do not fit the schema: their file, their text and what was read."""
    wanted = _struct(schema)
    layouts = _Layouts(spark, paths, encoding)
    layouts.require(wanted.names)
    return layouts.rows(wanted, "").filter(F.col(BAD_LINE).isNotNull()).select(
        F.col("_archivo").alias("archivo"), F.col(BAD_LINE).alias("linea"),
        F.struct(*wanted.names).alias("leido"),
    )
