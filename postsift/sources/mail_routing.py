"""Mail-routing answers per domain: a table of what the resolver said.

Schema of an answers table (`DNS_SCHEMA`): one row per domain and lookup. A null code
means "answered". `fetched_at` null marks an answer obtained for this very run; a
time marks an answer kept from an earlier run, good until its time to live is over.
Any DataFrame with these columns will do, from files, a table or a test.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions.routing import mail_status

DNS_SCHEMA = (
    "domain string, mx array<struct<exchange:string,priority:int>>, mx_code string, "
    "a array<string>, a_code string, fetched_at timestamp"
)

HOUR_MS = 3_600_000
MAIL_TTL_MS = 6 * HOUR_MS
STATUS_FIELDS = ("mx", "accepts_mail", "null_mx", "domain_exists", "resolver_failed")


def instant(as_of: str | datetime | Column | None) -> Column:
    """The clock of a run. Text and naive datetimes are read as UTC.

    Without one it is now, taken once: all actions of a run see the same time.
    """
    if as_of is None:
        as_of = datetime.now(timezone.utc)
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return F.lit(as_of.astimezone(timezone.utc).isoformat()).cast("timestamp")


def is_fresh(fetched_at: Column, as_of: Column, ttl_ms: int) -> Column:
    """Kept and not expired. At exactly the time to live an entry is expired.

    Written as a bound on `fetched_at` so that the scan can skip old row groups.
    """
    return fetched_at > as_of - F.make_dt_interval(secs=F.lit(ttl_ms / 1000))


def domain_mail_status(dns: DataFrame) -> DataFrame:
    """Decide every answer: domain, fetched_at and the five status fields."""
    status = mail_status(F.col("mx"), F.col("mx_code"), F.col("a"), F.col("a_code"))
    return dns.select("domain", "fetched_at", status.alias("status")).select(
        "domain", "fetched_at", *[F.col("status")[f].alias(f) for f in STATUS_FIELDS]
    )


def usable_answers(dns: DataFrame, as_of: Column, ttl_ms: int = MAIL_TTL_MS) -> DataFrame:
    """One answer per domain: the newest kept one that is fresh, else this run's own.

    Failures are never kept, so a failure counts only when it was met in this run.
    The choice is a plain `max`, which combines on the map side: many stored versions
    of one domain do not meet in one task.
    """
    fresh = is_fresh(F.col("fetched_at"), as_of, ttl_ms)
    candidates = domain_mail_status(dns.where(F.col("fetched_at").isNull() | fresh)).where(
        F.col("fetched_at").isNull() | ~F.col("resolver_failed")
    )
    newest = F.max(F.struct("fetched_at", *STATUS_FIELDS)).alias("newest")
    return (
        candidates.groupBy("domain")
        .agg(newest)
        .select(
            "domain",
            F.col("newest.fetched_at").isNotNull().alias("kept"),
            *[F.col(f"newest.{f}") for f in STATUS_FIELDS],
        )
    )


def latest_kept(dns: DataFrame) -> DataFrame:
    """Latest stored answer per domain that was worth storing, fresh or not."""
    newest = F.max(F.struct("fetched_at", *STATUS_FIELDS)).alias("newest")
    return (
        domain_mail_status(dns)
        .where(F.col("fetched_at").isNotNull() & ~F.col("resolver_failed"))
        .groupBy("domain")
        .agg(newest)
        .select("domain", "newest.*")
    )
