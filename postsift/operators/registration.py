"""Which registry server knows a domain, how old the domain is, and what to ask next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.operators.attach import attach
from postsift.operators.settle import checkpoint_folder, settle
from postsift.sources.registry import REGISTRATION_TTL_MS, registration_ages

# The registry of top-level domains is a small public document (about 1,500 labels).
# Up to this many rows it is broadcast; a larger table goes through `attach`.
REGISTRY_BROADCAST_ROWS = 100_000


def parent_suffixes(domain: Column) -> Column:
    """`a.b.c` -> [`b.c`, `c`]: longest first, the domain itself left out."""
    labels = F.split(domain, r"\.")
    later = F.filter(F.sequence(F.lit(1), F.size(labels)), lambda i: i < F.size(labels))
    return F.transform(later, lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def _sized(registry: DataFrame) -> tuple[DataFrame, int]:
    """The registry and its number of rows."""
    if checkpoint_folder(registry.sparkSession) is not None:
        registry = settle(registry)
    return registry, registry.count()


def registry_servers(domains: DataFrame, registry: DataFrame, rows: int | None = None) -> DataFrame:
    """(domain, base_url) for the distinct domains whose longest listed parent has a server.

    The suffix `com` is shared by a large part of all domains, so the suffixes are not
    hashed against the registry: it is broadcast after its size has been checked. `rows` is
    that size, where it is known; else the registry is counted, and settled for that if the
    session has a checkpoint folder, so that its documents are parsed once.
    """
    if rows is None:
        registry, rows = _sized(registry)
    suffixes = domains.select("domain", F.posexplode(parent_suffixes(F.col("domain"))).alias("pos", "tld"))
    if rows <= REGISTRY_BROADCAST_ROWS:
        matched = suffixes.join(F.broadcast(registry), "tld")
    else:
        matched = attach(suffixes, registry, "tld").where("base_url IS NOT NULL")
    nearest = F.min(F.struct("pos", "base_url")).alias("nearest")
    return matched.groupBy("domain").agg(nearest).select("domain", "nearest.base_url")


def domain_ages(
    rdap: DataFrame, registry: DataFrame, as_of: Column, ttl_ms: int = REGISTRATION_TTL_MS
) -> DataFrame:
    """(domain, age_days, cacheable), ready for `validate(..., ages=...)`.

    A domain without a registry server has no age, and that is final (cacheable). Without
    any registry no age is known, and nothing of that is final.
    """
    ages = registration_ages(rdap, as_of, ttl_ms)
    registry, rows = _sized(registry)
    if rows == 0:
        return ages.select("domain", F.lit(None).cast("int").alias("age_days"), F.lit(False).alias("cacheable"))
    served = registry_servers(ages.select("domain"), registry, rows)
    known = F.col("base_url").isNotNull()
    return ages.join(served, "domain", "left").select(
        "domain",
        F.when(known, F.col("age_days")).alias("age_days"),
        (~known | F.col("cacheable")).alias("cacheable"),
    )


def registration_requests(
    domains: DataFrame,
    registry: DataFrame,
    rdap: DataFrame | None,
    as_of: Column,
    ttl_ms: int = REGISTRATION_TTL_MS,
) -> DataFrame:
    """(domain, request_url) still to be asked: a server exists and no kept answer is fresh."""
    wanted = registry_servers(domains, registry)
    if rdap is not None:
        kept = registration_ages(rdap.where(F.col("fetched_at").isNotNull()), as_of, ttl_ms)
        wanted = wanted.join(kept.select("domain"), "domain", "left_anti")
    url = F.concat("base_url", F.lit("domain/"), F.url_encode("domain"))
    return wanted.select("domain", url.alias("request_url"))
