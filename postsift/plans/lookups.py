"""Domain part of a run: everything that is looked up once per distinct domain."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions.routing import match_provider
from postsift.operators.attach import attach
from postsift.operators.typo import find_typos
from postsift.plans.parse import Parsed
from postsift.plans.rules import any_cut
from postsift.sources.mail_routing import usable_answers


def typo_columns(typo: Column) -> dict[str, Column]:
    return {"typo.suggestion": typo["suggestion"], "typo.high_confidence": typo["high_confidence"]}


def asked_domains(parsed: Parsed, settled: bool = False) -> DataFrame:
    """Distinct domains that reach the lookups.

    Columns: `ps_key`, `ps_rows` (contacts), `ps_dns_rows` (those that reach mail routing),
    `ps_first` (the earliest of these in arrival order) and `ps_typo`. A single aggregate
    with map-side combine: a provider with a third of all contacts arrives as one row
    per map task, and "who came first" needs no window over its contacts. `settled`: a long
    list of common domains is searched over a settled table of the distinct domains.
    """
    cascade = parsed.cascade
    between = cascade.rules_before("dns")[len(cascade.address_rules) :]
    per_domain = all(rule.per_domain for rule in between)
    reached = parsed.frame.where(F.col("ps_key").isNotNull())
    order = F.lit(None).cast("bigint") if parsed.order is None else parsed.order

    if per_domain:
        domains = reached.groupBy("ps_key").agg(
            F.count("*").alias("ps_rows"), F.count("*").alias("ps_dns_rows"), F.min(order).alias("ps_first")
        )
        if "typo" in cascade.lookups:
            domains = _with_typos(domains, parsed, settled)
    else:
        # A rule ahead of mail routing mixes account and typo: typos are still searched per
        # domain, then brought to the contacts, and the rule decides for each of them.
        typos = reached.groupBy("ps_key").agg(F.count("*").alias("ps_rows"))
        if "typo" in cascade.lookups:
            typos = _with_typos(typos, parsed, settled)
        else:
            typos = typos.withColumn("ps_typo", F.lit(None).cast("struct<suggestion:string,high_confidence:boolean>"))
        view = replace(parsed.view, looked_up=typo_columns(F.col("ps_typo")), notes=_notes_so_far(parsed))
        alive = ~any_cut([c for e in cascade.evaluate(view, between) for c in e.cuts])
        domains = (
            attach(reached, typos.drop("ps_rows"), "ps_key")
            .withColumn("ps_alive", alive)
            .groupBy("ps_key")
            .agg(
                F.count("*").alias("ps_rows"),
                F.count_if("ps_alive").alias("ps_dns_rows"),
                F.min(F.when(F.col("ps_alive"), order)).alias("ps_first"),
                F.first("ps_typo").alias("ps_typo"),
            )
        )
        return domains if "typo" in cascade.lookups else domains.drop("ps_typo")

    if between:
        view = replace(
            parsed.view,
            account=F.lit(None).cast("string"),
            domain=F.col("ps_key"),
            looked_up=typo_columns(F.col("ps_typo")) if "typo" in cascade.lookups else {},
        )
        cut = any_cut([c for e in cascade.evaluate(view, between) for c in e.cuts])
        domains = domains.withColumn("ps_dns_rows", F.when(cut, F.lit(0)).otherwise(F.col("ps_dns_rows")))
    return domains


def _with_typos(domains: DataFrame, parsed: Parsed, settled: bool) -> DataFrame:
    options = parsed.cascade.options
    found = find_typos(domains.withColumnRenamed("ps_key", "domain"), options.lists, extra=options.domain_table, settled=settled)
    return found.withColumnRenamed("domain", "ps_key").withColumnRenamed("typo", "ps_typo")


def with_mail_routing(domains: DataFrame, answers: DataFrame | None, parsed: Parsed) -> DataFrame:
    """Add `ps_dns`: the answer for each domain, or a failed lookup where there is none.

    Both sides are already hashed on the domain by their aggregates, so this join adds
    no shuffle of its own.
    """
    if answers is None:
        known = F.lit(None)
        return domains.withColumn(
            "ps_dns",
            F.struct(
                F.lit(False).alias("kept"),
                F.lit(True).alias("resolver_failed"),
                F.lit(False).alias("null_mx"),
                F.lit(False).alias("accepts_mail"),
                known.cast("string").alias("mx"),
                known.cast("string").alias("provider"),
                known.cast("boolean").alias("catch_all"),
            ),
        )
    provider = match_provider(F.col("mx"), parsed.cascade.options.lists)
    joined = domains.join(answers.withColumnRenamed("domain", "ps_key"), "ps_key", "left")
    answer = F.struct(
        F.coalesce("kept", F.lit(False)).alias("kept"),
        F.coalesce("resolver_failed", F.lit(True)).alias("resolver_failed"),
        F.coalesce("null_mx", F.lit(False)).alias("null_mx"),
        F.coalesce("accepts_mail", F.lit(False)).alias("accepts_mail"),
        F.col("mx"),
        provider["name"].alias("provider"),
        provider["catch_all"].alias("catch_all"),
    )
    return joined.select(*domains.columns, answer.alias("ps_dns"))


def with_domain_age(domains: DataFrame, ages: DataFrame | None) -> DataFrame:
    """Add `ps_age_days` from a table (domain, age_days); of several rows the largest age counts."""
    if ages is None:
        return domains.withColumn("ps_age_days", F.lit(None).cast("int"))
    aged = ages.groupBy(F.col("domain").alias("ps_key")).agg(F.max(F.col("age_days").cast("int")).alias("ps_age_days"))
    return domains.join(aged, "ps_key", "left")


def missing_answers(domains: DataFrame, dns: DataFrame | None, as_of: Column, ttl_ms: int) -> DataFrame:
    """Domains to ask the resolver about: they reach mail routing and no kept answer is fresh."""
    wanted = domains.where("ps_dns_rows > 0").select(F.col("ps_key").alias("domain"), F.col("ps_dns_rows").alias("contacts"))
    if dns is None:
        return wanted
    kept = usable_answers(dns.where(F.col("fetched_at").isNotNull()), as_of, ttl_ms)
    return wanted.join(kept.select("domain"), "domain", "left_anti")


def _notes_so_far(parsed: Parsed) -> dict[str, Column]:
    return parsed.evaluated[-1].notes if parsed.evaluated else parsed.view.notes
