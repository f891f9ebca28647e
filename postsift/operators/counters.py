"""Counters of distinct domains that can be merged: sketches per period, and their union.

A sketch has a fixed size (2 ** precision bytes at most), so years of batches are merged without
the domains themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRECISION = 14


def relative_error(precision: int = PRECISION, deviations: float = 3.0) -> float:
    """What the estimate of merged sketches is off by, at most, for so many standard deviations."""
    return deviations * 1.04 / 2 ** (precision / 2)


def domain_sketches(rows: DataFrame, periods: Sequence[str | Column], domain: str = "domain", precision: int = PRECISION) -> DataFrame:
    """One row per period: `requests` (rows with a domain) and `sketch` of their distinct domains.

    Sketches are built in the tasks that read the rows; one row per task and period is shuffled.
    """
    named = rows.where(F.col(domain).isNotNull())
    return named.groupBy(*periods).agg(F.count("*").alias("requests"), F.hll_sketch_agg(domain, precision).alias("sketch"))


def merged_counts(sketches: DataFrame, periods: Sequence[str | Column] = ()) -> DataFrame:
    """requests and the estimate of distinct domains over the union of sketches; all of them without `periods`."""
    merged = sketches.groupBy(*periods).agg(F.sum("requests").alias("requests"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.withColumn("domains", F.hll_sketch_estimate("sketch")).drop("sketch")
