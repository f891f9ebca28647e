"""The mailbox provider of a host, from a table of host suffixes of any length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.operators.attach import attach

#: Up to this many suffixes the table is broadcast; a longer one goes through `attach`.
PROVIDER_BROADCAST_ROWS = 100_000
#: Fixed value: a host name has no more characters, so no more lengths are looked up.
LONGEST_HOST = 253


def provider_matches(hosts: DataFrame, providers: DataFrame, host: str = "mx") -> DataFrame:
    """(host, provider, catch_all) for the distinct hosts that end with a provider's suffix.

    `providers` holds ordinal, mx_suffix, name and catch_all; of several suffixes that fit the one
    with the smallest ordinal counts. Only the lengths that occur among the suffixes are cut from a
    host, so it takes one row per length, and the join is on equality.
    """
    known = providers.where(F.col("mx_suffix").isNotNull() & (F.length("mx_suffix") <= LONGEST_HOST))
    known = known.groupBy("mx_suffix").agg(F.min(F.struct("ordinal", "name", "catch_all")).alias("ps_best"))
    n, lengths = known.agg(F.count("*"), F.array_sort(F.collect_set(F.length("mx_suffix")))).first()
    distinct = hosts.select(host).where(F.col(host).isNotNull()).distinct()
    cuts = F.filter(F.array(*[F.lit(k) for k in lengths]).cast("array<int>"), lambda k: k <= F.length(host))
    ends = distinct.select(host, F.explode(F.transform(cuts, lambda k: F.right(host, k))).alias("mx_suffix"))
    if n <= PROVIDER_BROADCAST_ROWS:
        met = ends.join(F.broadcast(known), "mx_suffix")
    else:
        met = attach(ends, known, "mx_suffix").where("ps_best IS NOT NULL")
    first = met.groupBy(host).agg(F.min("ps_best").alias("ps_best"))
    return first.select(host, F.col("ps_best.name").alias("provider"), F.col("ps_best.catch_all").alias("catch_all"))
