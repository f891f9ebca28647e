"""Compute columns once, where they stand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(frame: DataFrame, existing: Sequence[str] = (), **columns: Column) -> DataFrame:
    """Add columns (and settle existing ones) so that no later step repeats them.

    A filter on a plain `withColumn` is pushed below it with the whole expression copied
    into the condition, once per use. Unfolding a one-element array stops that, and stays
    inside generated code. (The outer form, because Spark derives a filter on the array
    from the inner one.)
    """
    record = F.array(F.struct(*existing, *[c.alias(n) for n, c in columns.items()]))
    others = [F.col("`" + n.replace("`", "``") + "`") for n in frame.columns if n not in existing]
    return frame.select(*others, record.alias("ps_record")).select(*others, F.inline_outer("ps_record"))
