"""Constant arrays in the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"


def text_array(values: Sequence[str | None]) -> Column:
    """Array of texts as one folded constant; None (and '') become null when read by `at`."""
    return F.split(F.lit(SEPARATOR.join(v or "" for v in values)), SEPARATOR)


def at(values: Sequence[str | None], index: Column) -> Column:
    """`values[index]`; null for None and outside the array."""
    return F.nullif(F.get(text_array(values), index), F.lit(""))
