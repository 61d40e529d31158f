"""Codes, labels, flags and names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_code(code: Column, width: int = 2) -> Column:
    """Integer code as zero-padded text; NULL when the code is no integer."""
    return F.lpad(code.try_cast("int").cast("string"), width, "0")


def label_of(code: Column, labels: Mapping[int, str]) -> Column:
    """Label of a code, or the code itself as text when it has none."""
    pairs = [F.lit(part) for item in labels.items() for part in item]
    found = F.try_element_at(F.create_map(*pairs), code.cast("int"))
    return F.coalesce(found, code.cast("string"))


def presence_flag(value: Column) -> Column:
    """1 where a value is present, else 0."""
    return value.isNotNull().cast("long")


def run_gas(name: Column) -> Column:
    """Gas part of a run name ``pred_<gas>_<months>m``; NULL for other names."""
    return _run_part(name, 1)


def run_months(name: Column) -> Column:
    """Months part of a run name as an integer; NULL for other names."""
    return _run_part(name, 2).cast("int")


def _run_part(name: Column, group: int) -> Column:
    pattern = r"^pred_(.+)_(\d+)m$"
    part = F.regexp_extract(name, pattern, group)
    return F.when(name.rlike(pattern), part)


def run_name(gas: Column, months: Column) -> Column:
    """Name of a forecast run; inverse of the two parsers above."""
    return F.concat(F.lit("pred_"), gas, F.lit("_"), months.cast("string"), F.lit("m"))
