"""Narrow part of a run: one projection from raw contacts to parsed addresses."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions.text import account_of, bare_account, domain_of, fold, has_valid_syntax, rejoin
from postsift.operators.membership import flag_long_lists, membership
from postsift.operators.once import computed_once
from postsift.plans.options import Options
from postsift.plans.rules import Cascade, Cut, Evaluated, RuleView, entry_cuts, first_cut
from postsift.sources.contacts import quoted, select_addresses

ENTRY_CUTS = 4


@dataclass(frozen=True)
class Parsed:
    """Contacts with `ps_` working columns.

    `ps_stop` is the number of the cut that already applied, null for contacts that go
    on to the lookups; those also carry their domain in `ps_key`.
    """

    frame: DataFrame
    payload: list[str]
    cascade: Cascade
    view: RuleView
    cuts: list[Cut]
    evaluated: list[Evaluated]
    field_searched: str | None
    order: Column | None


def parse_contacts(
    contacts: DataFrame,
    email: str | Column,
    cascade: Cascade,
    order_by: str | Sequence[str] = (),
    fan_out: bool = True,
) -> Parsed:
    reserved = [c for c in contacts.columns if c.lower().startswith("ps_")]
    if reserved:
        raise ValueError(f"column names starting with ps_ are used internally: {reserved}")

    selected = select_addresses(contacts, email, fan_out)
    payload = [c for c in selected.frame.columns if not c.startswith("ps_")]
    order = _arrival_order(order_by, selected.fanned)

    folded = selected.frame.withColumn("ps_folded", fold(F.col("ps_email")))
    parts = folded.withColumns(
        {"ps_local": account_of(F.col("ps_folded")), "ps_domain": domain_of(F.col("ps_folded"))}
    )
    parts = parts.withColumns(
        {
            "ps_account": bare_account(F.col("ps_local")),
            "ps_normalized": rejoin(F.col("ps_folded"), F.col("ps_local"), F.col("ps_domain")),
            "ps_changed": bare_account(F.col("ps_local")) != F.col("ps_local"),
        }
    ).drop("ps_local")
    parts, flags = flag_long_lists(parts, cascade.options.lists, tables=cascade.options.list_tables)

    view = address_view(cascade.options, flags)
    evaluated = cascade.evaluate(view, cascade.address_rules)
    cuts = entry_cuts(
        F.col("ps_email"),
        F.col("ps_is_text"),
        F.col("ps_folded") == "",
        has_valid_syntax(F.col("ps_normalized"), F.col("ps_account")),
    ) + [cut for e in evaluated for cut in e.cuts]

    judged = parts.withColumn("ps_stop", first_cut(cuts)).drop("ps_folded")
    key = F.when(F.col("ps_stop").isNull(), F.col("ps_domain"))
    working = [c for c in judged.columns if c.startswith("ps_")]
    frame = computed_once(judged, working, ps_key=key)
    return Parsed(frame, payload, cascade, view, cuts, evaluated, selected.field_searched, order)


def address_view(options: Options, flags: dict[str, Column] | None = None) -> RuleView:
    account, domain = F.col("ps_account"), F.col("ps_domain")
    return RuleView(account, domain, options, membership(options.lists, flags or {}))


def _arrival_order(order_by: str | Sequence[str], fanned: bool) -> Column | None:
    names = [order_by] if isinstance(order_by, str) else list(order_by)
    if not names:
        return None
    if len(names) == 1 and not fanned:
        return quoted(names[0])
    return F.struct(*[quoted(n) for n in names], "ps_pos")
