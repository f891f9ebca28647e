"""Two ways out: sendable contacts and discarded ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sendable(validated: DataFrame) -> DataFrame:
    """Contacts recommended as `accept` or `confirm`."""
    return validated.where(F.col("validation.sendable"))


def discarded(validated: DataFrame) -> DataFrame:
    """All the others."""
    return validated.where(~F.col("validation.sendable"))


def write_routed(
    validated: DataFrame, path: str, file_format: str = "parquet", mode: str = "error", column: str = "sendable"
) -> None:
    """Write both ways in one pass, as `sendable=true` and `sendable=false` below `path`.

    `column` names the folders; a contact column of that name would be lost, so it is refused.
    """
    if column.lower() in (c.lower() for c in validated.columns):
        raise ValueError(f"the contacts have a column {column!r}; pass another name for the folders")
    routed = validated.withColumn(column, F.col("validation.sendable"))
    routed.write.format(file_format).mode(mode).partitionBy(column).save(path)
