"""A kept snapshot of mail-routing answers: one row per domain, bucketed by domain.

The snapshot is a table whose partitions are its buckets, so a merge rewrites the buckets that
new answers fall into and leaves the others alone, and a join on the domain reads it without an
exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.operators.settle import settle
from postsift.sources.mail_routing import DNS_SCHEMA, domain_mail_status

ANSWER = ("fetched_at", "mx", "mx_code", "a", "a_code")


def create_snapshot(spark: SparkSession, table: str, buckets: int = 200, path: str | None = None) -> None:
    """An empty snapshot. `buckets` stays as it is; take about one for every 100 MB expected.

    With `path` the files lie there, and a new session opens them with the same call and
    `open_snapshot`.
    """
    where = f"LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE {table} ({DNS_SCHEMA.replace(':', ': ')}, slot INT) USING parquet "
        f"PARTITIONED BY (slot) CLUSTERED BY (domain) INTO {buckets} BUCKETS {where}"
    )


def open_snapshot(spark: SparkSession, table: str, buckets: int, path: str) -> None:
    """Name a snapshot that an earlier session has left at `path`."""
    create_snapshot(spark, table, buckets, path)
    spark.sql(f"MSCK REPAIR TABLE {table}")


def snapshot_answers(spark: SparkSession, table: str) -> DataFrame:
    """The kept answers, ready for `validate(..., dns=...)`."""
    return spark.table(table).drop("slot")


def _buckets(spark: SparkSession, table: str) -> int:
    for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if row["col_name"] == "Num Buckets":
            return int(row["data_type"])
    raise ValueError(f"{table} has no buckets")


def merge_answers(spark: SparkSession, table: str, answers: DataFrame) -> int:
    """Merge new answers into the snapshot; returns the number of buckets rewritten.

    Of all answers for a domain the newest that is worth keeping stays: it has a `fetched_at`
    and is no failure. Merging the same answers again changes nothing, so a merge that was
    broken off is repeated as it is. Only one merge may run on a snapshot at a time.
    """
    buckets = _buckets(spark, table)
    columns = [f.split()[0] for f in DNS_SCHEMA.split(", ")]
    timed = answers.where(F.col("fetched_at").isNotNull() & F.col("domain").isNotNull())
    # The status is a function of the answer, so it is asked per row before the newest is chosen.
    failed = domain_mail_status(timed.select("domain", *ANSWER[1:], F.struct(*columns).alias("fetched_at"))).where(~F.col("resolver_failed"))
    kept = failed.select("fetched_at.*").select(*columns)
    slot = F.pmod(F.hash("domain"), F.lit(buckets))
    fresh = settle(kept.groupBy("domain").agg(F.max(F.struct(*ANSWER)).alias("newest")).select("domain", "newest.*").withColumn("slot", slot))
    touched = [r["slot"] for r in fresh.select("slot").distinct().collect()]  # as many as buckets at most
    if not touched:
        return 0
    old = spark.table(table).where(F.col("slot").isin(touched))
    newest = (
        old.unionByName(fresh)
        .repartition(buckets, "domain")  # the hash of the buckets: a task writes one of them
        .groupBy("domain")
        .agg(F.max(F.struct(*ANSWER)).alias("newest"))
        .select("domain", "newest.*")
        .withColumn("slot", slot)
        .select(*columns, "slot")
    )
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        newest.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    return len(touched)
