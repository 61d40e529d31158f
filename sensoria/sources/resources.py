"""Resource lists of the open-data portal: JSON payload to rows, and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAYLOAD = (
    "struct<result: struct<resources: array<struct<"
    "name: string, description: string, format: string, url: string>>>>"
)


def resource_rows(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per resource of each package, ``pos`` being its place in the list.

    Other columns of the input (such as the dataset name) are kept.
    """
    keep = [name for name in payloads.columns if name != payload]
    parsed = payloads.withColumn("_p", F.from_json(payload, PAYLOAD))
    return parsed.select(*keep, F.posexplode("_p.result.resources").alias("pos", "_r")).select(
        *keep, "pos", "_r.*"
    )


def of_period(resources: DataFrame, period: str) -> DataFrame:
    """Resources that mention a period in their description."""
    return resources.filter(F.col("description").contains(period))


def first_match(
    resources: DataFrame,
    dataset: str,
    period: str | None = None,
    fmt: str = "CSV",
) -> DataFrame:
    """First resource of each dataset with the format (and period, if given)."""
    matching = resources if period is None else of_period(resources, period)
    matching = matching.filter(F.col("format") == fmt)
    row = F.struct(*[F.col(name) for name in resources.columns if name != dataset])
    return (
        matching.groupBy(dataset)
        .agg(F.min_by(row, "pos").alias("_r"))
        .select(dataset, "_r.*")
    )


def require_match(matches: DataFrame, what: str) -> DataFrame:
    """The matches, or an error when there is none."""
    if matches.isEmpty():
        raise ValueError(f"no resource found for {what}")
    return matches
