"""What the mail-routing answers of a domain mean, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postsift.functions.constants import at, text_array
from postsift.sources.lists import ReferenceLists

# Resolver codes that mean "no such domain" and "no such records".
# Any other code is a failure of the resolver, which says nothing about the domain.
NOT_FOUND = ("ENOTFOUND", "NXDOMAIN")
NO_RECORDS = "ENODATA"


def mx_host(exchange: Column) -> Column:
    """Canonical host: lower case, without one trailing dot."""
    return F.lower(F.regexp_replace(exchange, r"\.\z", ""))


def best_mx(records: Column) -> Column:
    """Exchange with the lowest priority; the first one listed wins a tie."""
    ranked = F.transform(
        records,
        lambda r, i: F.struct(r["priority"].alias("p"), i.alias("i"), r["exchange"].alias("exchange")),
    )
    return F.array_min(ranked)["exchange"]


def mail_status(mx: Column, mx_code: Column, a: Column, a_code: Column) -> Column:
    """struct<mx, accepts_mail, null_mx, domain_exists, resolver_failed>.

    A null code means the question was answered. Without MX records an IPv4 address
    is enough to deliver; a lone `.` as best exchange declares that no mail is taken.
    """
    listed = F.coalesce(F.size(mx), F.lit(0)) > 0
    addressed = F.coalesce(F.size(a), F.lit(0)) > 0
    host = F.when(mx_code.isNull() & listed, mx_host(best_mx(mx)))
    outcome = (
        F.when(host.isin("", "."), "refuses")
        .when(host.isNotNull(), "by mx")
        .when(mx_code.isin(*NOT_FOUND), "absent")
        .when((mx_code != NO_RECORDS) | (mx_code.isNull() & listed), "failed")
        # No MX records: the second question decides.
        .when(a_code.isNull() & addressed, "by address")
        .when(a_code.isNull() | (a_code == NO_RECORDS), "idle")
        .when(a_code.isin(*NOT_FOUND), "absent")
        .otherwise("failed")
    )
    return F.struct(
        F.when(outcome == "by mx", host).alias("mx"),
        outcome.isin("by mx", "by address").alias("accepts_mail"),
        (outcome == "refuses").alias("null_mx"),
        outcome.isin("by mx", "by address", "refuses", "idle").alias("domain_exists"),
        (outcome == "failed").alias("resolver_failed"),
    )


def match_provider(mx: Column, lists: ReferenceLists) -> Column:
    """struct<name, catch_all> of the first provider whose suffix ends the host.

    Null fields when no suffix fits or there is no host. `catch_all` is three-valued:
    null means unknown.
    """
    fits = F.transform(text_array([p.mx_suffix for p in lists.providers]), lambda s: F.endswith(mx, s))
    # 1-based position of the first match, 0 for none, null without a host.
    index = F.array_position(fits, True) - 1
    catch_all = [None if p.catch_all is None else str(p.catch_all) for p in lists.providers]
    return F.struct(
        at([p.name for p in lists.providers], index).alias("name"),
        at(catch_all, index).cast("boolean").alias("catch_all"),
    )
