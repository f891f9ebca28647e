"""Which domains a stream has asked about, kept by hour so that old ones are never listed.

The folder holds hour=YYYYMMDDHH/batch_id=N, the hour being that of the lookup. A reader names
the hours within the time to live, so its work follows that time and not the age of the stream.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.sources.mail_routing import instant, is_fresh

HOUR = timedelta(hours=1)


def moment(as_of: str | datetime | None) -> datetime:
    """The clock of a batch in UTC; text and naive times are read as UTC."""
    if as_of is None:
        return datetime.now(timezone.utc)
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    return as_of.replace(tzinfo=timezone.utc) if as_of.tzinfo is None else as_of.astimezone(timezone.utc)


def hour_name(clock: datetime) -> str:
    return clock.strftime("%Y%m%d%H")


def hours_within(clock: datetime, ttl_ms: int) -> Iterable[str]:
    """The hours that can hold what was asked within the time to live."""
    first = (clock - timedelta(milliseconds=ttl_ms)).replace(minute=0, second=0, microsecond=0)
    for k in range(int((clock - first) / HOUR) + 1):
        yield hour_name(first + k * HOUR)


def found(spark: SparkSession, path: str, schema: str, base: str | None = None) -> DataFrame | None:
    """The Parquet files below `path` (a glob), or None if there is no such folder."""
    reader = spark.read.schema(schema)
    try:
        return (reader.option("basePath", base) if base else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def batch_clock(spark: SparkSession, folder: str, batch_id: int, as_of: datetime) -> datetime:
    """The clock of a batch: the one it had when it ran before, else `as_of`, but never earlier than the last batch's.

    It is written before the batch does anything else. So a repeated batch finds the same
    fresh answers and writes to the same hour, and overwrites what it wrote.
    """
    kept = found(spark, f"{folder}/_clock", "last_batch bigint, clock timestamp")
    last = None if kept is None else kept.select("last_batch", F.unix_micros("clock").alias("micros")).first()
    if last is not None:
        before = datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=last["micros"])
        if last["last_batch"] == batch_id:
            return before
        as_of = max(as_of, before)
    row = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("last_batch"), instant(as_of).alias("clock"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{folder}/_clock")
    return as_of


def asked_within(spark: SparkSession, folder: str, columns: str, batch_id: int, clock: datetime, ttl_ms: int) -> DataFrame | None:
    """What earlier batches have written within the time to live, or None; `columns` is their schema.

    It must have `requested_at`. Only the folders of these hours are listed.
    """
    hours = ",".join(hours_within(clock, ttl_ms))
    earlier = found(spark, f"{folder}/hour={{{hours}}}", f"{columns}, hour string, batch_id bigint", folder)
    if earlier is None:
        return None
    return earlier.where((F.col("batch_id") < batch_id) & is_fresh(F.col("requested_at"), instant(clock), ttl_ms))


def write_asked(rows: DataFrame, folder: str, batch_id: int, clock: datetime) -> None:
    """Write what a batch asked (with `requested_at`) to its hour; a repeated batch overwrites it."""
    rows.write.mode("overwrite").parquet(f"{folder}/hour={hour_name(clock)}/batch_id={batch_id}")
