"""Batch validation: contacts in, the same contacts plus a `validation` struct out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from postsift.functions.constants import at
from postsift.functions.text import iso_instant
from postsift.operators.attach import BROADCAST_ROWS, DEFAULT_HOT_KEYS, HotKeys, attach, attach_settled
from postsift.operators.registration import registration_requests
from postsift.operators.settle import settle
from postsift.plans.lookups import (
    asked_domains,
    missing_answers,
    typo_columns,
    with_domain_age,
    with_mail_routing,
)
from postsift.plans.options import Options
from postsift.plans.parse import ENTRY_CUTS, Parsed, parse_contacts
from postsift.plans.rules import (
    DEFAULT_RULES,
    NOTE_DEFAULTS,
    Cascade,
    Rule,
    default_notes,
    final_cuts,
    first_cut,
)
from postsift.sources.contacts import quoted
from postsift.sources.mail_routing import instant, usable_answers

# Recommendations that mean "send".
SENDABLE = ("accept", "confirm")

# Between the parts of a verdict in the name of its counter.
VERDICT_MARK = "/"

# Output struct, in order. `field_searched` is only set with `field_not_found`;
# `duration_ms` is kept for the schema's sake and is always null in a batch.
VALIDATION_SCHEMA = (
    "email string, normalized string, send_to string, status string, sub_status string, "
    "recommendation string, sendable boolean, suggestion string, account string, domain string, "
    "free_email boolean, role_based boolean, disposable boolean, normalization_applied boolean, "
    "mx_found boolean, mx_record string, smtp_provider string, catch_all boolean, "
    "domain_age_days int, checked_at string, cached boolean, duration_ms bigint, field_searched string"
)


def validate(
    contacts: DataFrame,
    email: str | Column = "email",
    *,
    options: Options = Options(),
    dns: DataFrame | None = None,
    ages: DataFrame | None = None,
    as_of: str | datetime | Column | None = None,
    order_by: str | Sequence[str] = (),
    rules: Sequence[Rule] = DEFAULT_RULES,
    fan_out: bool = True,
    keep_fields: bool = True,
    settled: bool = False,
    hot_keys: HotKeys | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    answered: DataFrame | None = None,
    observe: Observation | None = None,
) -> DataFrame:
    """Decide for every address whether to send to it.

    `email`     field name, address text, or column expression; arrays fan out
    `dns`       mail-routing answers (see `sources.mail_routing`); a domain without a
                usable answer counts as a failed lookup and is let through
    `ages`      table (domain, age_days), read when `options.include_domain_age`
    `as_of`     clock of the run, for expiry and `checked_at`
    `order_by`  arrival order of contacts, unique; needed for `cached` to tell the
                first contact of a domain from later ones. Without it `cached` reports
                only whether the answer was kept from an earlier run
    `rules`     the cascade; the default can be extended with `insert_rule`
    `answered`  table (domain) whose answers an earlier batch of the same run has used; every
                contact of such a domain comes later than its first one, as `cached` tells
    `observe`   counts contacts per verdict while the first action on the result runs, without
                one of its own; read them with `verdict_counts`

    `settled`   True: the table of domains is computed at once and kept in the checkpoint
                folder (which must be set), so its size is known and the contacts are joined
                to a broadcast of it within `broadcast_rows`, without a shuffle. False, the
                default: everything is lazy, and contacts are shuffled once (see `attach`)
    `hot_keys`  marks hot domains ahead of that shuffle; without it the adaptive skew join
                splits them, and contacts are read one time less
    """
    cascade = Cascade(tuple(rules), options)
    parsed = parse_contacts(contacts, email, cascade, order_by, fan_out)
    clock = instant(as_of)
    frame = parsed.frame
    if cascade.lookups:
        facts = asked_domains(parsed, settled)
        if "dns" in cascade.lookups:
            answers = None if dns is None else usable_answers(dns, clock, options.cache_ttl_ms)
            facts = with_mail_routing(facts, answers, parsed)
            if answered is not None:
                used = answered.select(F.col("domain").alias("ps_key")).distinct().withColumn("ps_seen", F.lit(True))
                facts = facts.join(used, "ps_key", "left").withColumn("ps_seen", F.coalesce("ps_seen", F.lit(False)))
        if "age" in cascade.lookups:
            facts = with_domain_age(facts, ages)
        facts = facts.drop("ps_dns_rows")
        if settled:
            frame = attach_settled(frame, settle(facts), "ps_key", "ps_rows", hot_keys or DEFAULT_HOT_KEYS, broadcast_rows)
        else:
            # The facts are costly, so the marks are not taken from their row counts.
            frame = attach(frame, facts.drop("ps_rows"), "ps_key", hot_keys=hot_keys)
    return _assemble(frame, parsed, clock, keep_fields, observe)


def lookup_worklist(
    contacts: DataFrame,
    email: str | Column = "email",
    *,
    options: Options = Options(),
    dns: DataFrame | None = None,
    as_of: str | datetime | Column | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    fan_out: bool = True,
) -> DataFrame:
    """Domains whose mail routing must be asked before `validate`: (domain, contacts).

    Contacts cut earlier ask nothing, and a domain is listed once however many contacts
    share it.
    """
    parsed = parse_contacts(contacts, email, Cascade(tuple(rules), options), (), fan_out)
    return missing_answers(asked_domains(parsed), dns, instant(as_of), options.cache_ttl_ms)


def answered_domains(
    contacts: DataFrame,
    email: str | Column = "email",
    *,
    options: Options = Options(),
    dns: DataFrame | None = None,
    as_of: str | datetime | Column | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    fan_out: bool = True,
) -> DataFrame:
    """Domains of which `validate` uses an answer: (domain). Failed lookups give none."""
    parsed = parse_contacts(contacts, email, Cascade(tuple(rules), options), (), fan_out)
    answers = None if dns is None else usable_answers(dns, instant(as_of), options.cache_ttl_ms)
    looked_up = with_mail_routing(asked_domains(parsed).where("ps_dns_rows > 0"), answers, parsed)
    return looked_up.where(~F.col("ps_dns.resolver_failed")).select(F.col("ps_key").alias("domain"))


def lookup_counts(
    contacts: DataFrame,
    email: str | Column = "email",
    *,
    options: Options = Options(),
    dns: DataFrame | None = None,
    as_of: str | datetime | Column | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    fan_out: bool = True,
) -> DataFrame:
    """One row (lookups, entries): lookups a run causes, and answers held after it.

    One lookup per domain without a kept answer; a failing domain is asked again for
    every contact, because failures are not kept.
    """
    parsed = parse_contacts(contacts, email, Cascade(tuple(rules), options), (), fan_out)
    answers = None if dns is None else usable_answers(dns, instant(as_of), options.cache_ttl_ms)
    looked_up = with_mail_routing(asked_domains(parsed).where("ps_dns_rows > 0"), answers, parsed)
    failed, kept = F.col("ps_dns.resolver_failed"), F.col("ps_dns.kept")
    asked = F.when(kept, 0).when(failed, F.col("ps_dns_rows")).otherwise(1)
    return looked_up.agg(
        F.coalesce(F.sum(asked), F.lit(0)).alias("lookups"), F.count_if(~failed).alias("entries")
    )


def registration_worklist(
    contacts: DataFrame,
    email: str | Column = "email",
    *,
    registry: DataFrame,
    rdap: DataFrame | None = None,
    dns: DataFrame | None = None,
    options: Options = Options(include_domain_age=True),
    as_of: str | datetime | Column | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    fan_out: bool = True,
) -> DataFrame:
    """Registration requests of a run: (domain, request_url), for domains that take mail."""
    parsed = parse_contacts(contacts, email, Cascade(tuple(rules), options), (), fan_out)
    clock = instant(as_of)
    answers = None if dns is None else usable_answers(dns, clock, options.cache_ttl_ms)
    looked_up = with_mail_routing(asked_domains(parsed).where("ps_dns_rows > 0"), answers, parsed)
    accepting = looked_up.where(~F.col("ps_dns.resolver_failed") & F.col("ps_dns.accepts_mail"))
    return registration_requests(
        accepting.select(F.col("ps_key").alias("domain")), registry, rdap, clock, options.registration_ttl_ms
    )


def _looked_up(parsed: Parsed, answered: bool) -> dict[str, Column]:
    lookups, found = parsed.cascade.lookups, {}
    if "typo" in lookups:
        found.update(typo_columns(F.col("ps_typo")))
    if "dns" in lookups:
        dns = F.col("ps_dns")
        again = F.lit(False)
        if parsed.order is not None:
            again = ~parsed.order.eqNullSafe(F.col("ps_first")) & ~dns["resolver_failed"]
        if answered:
            again = again | (F.col("ps_seen") & ~dns["resolver_failed"])
        found.update({f"dns.{name}": dns[name] for name in ("resolver_failed", "null_mx", "accepts_mail")})
        found.update({f"dns.{name}": dns[name] for name in ("mx", "provider", "catch_all")})
        found["dns.cached"] = dns["kept"] | again
    if "age" in lookups:
        found["age.days"] = F.col("ps_age_days")
    return found


def _assemble(frame: DataFrame, parsed: Parsed, clock: Column, keep_fields: bool, observe: Observation | None) -> DataFrame:
    cascade, options = parsed.cascade, parsed.cascade.options
    later_rules = cascade.rules[len(cascade.address_rules) :]
    notes_so_far = parsed.evaluated[-1].notes if parsed.evaluated else default_notes()
    view = replace(parsed.view, looked_up=_looked_up(parsed, "ps_seen" in frame.columns), notes=notes_so_far)
    later = cascade.evaluate(view, later_rules)
    notes = later[-1].notes if later else notes_so_far

    later_cuts = [c for e in later for c in e.cuts] + final_cuts(notes, options)
    cuts = parsed.cuts + later_cuts
    stop = F.col("ps_stop")
    frame = frame.withColumn(
        "ps_stop", F.coalesce("ps_stop", first_cut(later_cuts, start=len(parsed.cuts)))
    ).withColumn("ps_advice", at([c.recommendation for c in cuts], stop))

    addressed, parseable = stop >= ENTRY_CUTS, stop >= ENTRY_CUTS - 1
    sendable = F.col("ps_advice").isin(*SENDABLE)
    fields = {
        "email": F.coalesce("ps_email", F.lit("")),
        "normalized": F.when(parseable, F.col("ps_normalized")),
        "send_to": F.when(sendable, F.col("ps_normalized")),
        "status": at([c.status for c in cuts], stop),
        "sub_status": at([c.sub_status for c in cuts], stop),
        "recommendation": F.col("ps_advice"),
        "sendable": sendable,
        "account": F.when(addressed, F.col("ps_account")),
        "domain": F.when(addressed, F.col("ps_domain")),
        "normalization_applied": parseable & F.col("ps_changed"),
        "checked_at": iso_instant(clock),
        "duration_ms": F.lit(None).cast("bigint"),
        "field_searched": F.when(stop == 0, F.lit(parsed.field_searched)).cast("string"),
        **_visible_notes(parsed, later, stop),
    }
    names = [part.split()[0] for part in VALIDATION_SCHEMA.split(", ")]
    validation = F.struct(*[fields[name].alias(name) for name in names])
    kept = [quoted(c) for c in parsed.payload if c.lower() not in ("email", "validation")] if keep_fields else []
    validated = frame.select(*kept, fields["normalized"].alias("email"), validation.alias("validation"))
    if observe is None:
        return validated
    verdicts = {(c.status, c.sub_status, c.recommendation) for c in cuts}
    told = [F.col(f"validation.{name}") for name in ("status", "sub_status", "recommendation")]
    return validated.observe(
        observe,
        *[
            F.count_if(told[0].eqNullSafe(v[0]) & told[1].eqNullSafe(v[1]) & told[2].eqNullSafe(v[2])).alias(VERDICT_MARK.join(x or "" for x in v))
            for v in sorted(verdicts, key=str)
        ],
    )


def verdict_counts(observe: Observation) -> dict[tuple[str, str | None, str], int]:
    """(status, sub_status, recommendation) -> contacts, of an observed `validate`; waits for its first action."""
    split = ((tuple(x or None for x in name.split(VERDICT_MARK)), n) for name, n in observe.get.items())
    return {verdict: n for verdict, n in split if n}


def _visible_notes(parsed: Parsed, later: list, stop: Column) -> dict[str, Column]:
    """Notes of the rules that were reached; the default for all others."""
    visible, begin = default_notes(), ENTRY_CUTS
    for step in [*parsed.evaluated, *later]:
        for name, note in step.added.items():
            kind = NOTE_DEFAULTS[name][0]
            visible[name] = F.when(stop >= begin, note.cast(kind)).otherwise(visible[name])
        begin += len(step.cuts)
    return visible
