"""Registration sources: which server answers for a domain, and what it answered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions.registration import (
    answer_is_cacheable,
    answer_is_usable,
    registration_age_days,
)
from postsift.sources.mail_routing import is_fresh

REGISTRATION_TTL_MS = 24 * 3_600_000
RDAP_SCHEMA = "domain string, http_status int, body string, error string, fetched_at timestamp"


def registry_from_bootstrap(documents: DataFrame, body: str = "body", order: str | None = None) -> DataFrame:
    """Bootstrap documents -> (tld, base_url).

    A document is `{"services": [[[tld, ...], [url, ...]], ...]}`. The first URL of a
    service counts, with a trailing slash added when missing. Entries without labels or
    URLs and unreadable documents give nothing. The last mention of a TLD wins; `order`
    names a column that ranks the documents when there are several.
    """
    services = F.try_variant_get(F.try_parse_json(F.col(body)), "$.services", "array<variant>")
    rank = F.col(order) if order else F.lit(0)
    entries = documents.select(rank.alias("rank"), F.posexplode(services).alias("pos", "entry")).select(
        "rank",
        "pos",
        F.try_variant_get("entry", "$[0]", "array<string>").alias("tlds"),
        F.try_variant_get("entry", "$[1][0]", "string").alias("url"),
    )
    based = entries.where("url IS NOT NULL").select(
        "rank",
        "pos",
        F.explode("tlds").alias("tld"),
        F.when(F.endswith("url", F.lit("/")), F.col("url")).otherwise(F.concat("url", F.lit("/"))).alias("base"),
    )
    return (
        based.groupBy(F.lower("tld").alias("tld"))
        .agg(F.max(F.struct("rank", "pos", "base"))["base"].alias("base_url"))
        .where("tld IS NOT NULL")
    )


def registration_ages(
    rdap: DataFrame, as_of: Column, ttl_ms: int = REGISTRATION_TTL_MS
) -> DataFrame:
    """One age per domain from its newest usable answer: (domain, age_days, cacheable).

    An answer of this run (`fetched_at` null) counts whatever it says; a kept one only
    while fresh and only if it was worth keeping. `age_days` is null when the answer
    holds no registration date or is not an answer.
    """
    status, body, error = F.col("http_status"), F.col("body"), F.col("error")
    usable = answer_is_usable(status, body, error)
    current = rdap.where(F.col("fetched_at").isNull() | is_fresh(F.col("fetched_at"), as_of, ttl_ms))
    decided = current.select(
        "domain",
        "fetched_at",
        answer_is_cacheable(status, body, error).alias("cacheable"),
        F.when(usable, registration_age_days(body, as_of)).alias("age_days"),
    ).where(F.col("fetched_at").isNull() | F.col("cacheable"))
    newest = F.max(F.struct("fetched_at", "cacheable", "age_days")).alias("newest")
    return (
        decided.groupBy("domain")
        .agg(newest)
        .select("domain", "newest.age_days", "newest.cacheable")
    )
