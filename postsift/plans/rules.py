"""The cascade: an ordered list of rules, first verdict wins.

A rule is two functions from a `RuleView` (columns of one contact) to columns:

* `cuts`  gives conditions with the verdict each of them passes;
* `notes` gives output fields the rule fills in when it is reached.

`Cascade` numbers the cuts of all rules in order. The number of the first cut that
applies (`stop`) settles both the verdict and which rules were reached, and so which
notes may show: joins bring every lookup to every row, but a field stays at its
default unless its rule was reached.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from postsift.functions.filler import looks_like_filler
from postsift.plans.options import Options


@dataclass(frozen=True)
class Cut:
    """A condition and the verdict it passes; unless told otherwise the address is rejected."""

    when: Column
    sub_status: str | None
    status: str = "invalid"
    recommendation: str = "reject"


# Status and recommendation of what a person should look at.
TO_REVIEW = ("do_not_mail", "manual_review")

# Output fields a rule may fill, with type and value when nobody does.
NOTE_DEFAULTS: dict[str, tuple[str, object]] = {
    "suggestion": ("string", None),
    "free_email": ("boolean", False),
    "role_based": ("boolean", False),
    "disposable": ("boolean", False),
    "mx_found": ("boolean", False),
    "mx_record": ("string", None),
    "smtp_provider": ("string", None),
    "catch_all": ("boolean", None),
    "domain_age_days": ("int", None),
    "cached": ("boolean", False),
}


def default_notes() -> dict[str, Column]:
    return {name: F.lit(value).cast(kind) for name, (kind, value) in NOTE_DEFAULTS.items()}


@dataclass(frozen=True)
class RuleView:
    """What a rule sees: the address, list membership, lookups and earlier notes.

    `looked_up` holds the lookup columns by name: `typo.suggestion`,
    `typo.high_confidence`, `dns.resolver_failed`, `dns.null_mx`, `dns.accepts_mail`,
    `dns.mx`, `dns.provider`, `dns.catch_all`, `dns.cached`, `age.days`.
    """

    account: Column
    domain: Column
    options: Options
    on_list: Callable[[str, Column], Column]
    looked_up: dict[str, Column] = field(default_factory=dict)
    notes: dict[str, Column] = field(default_factory=default_notes)


@dataclass(frozen=True)
class Rule:
    """`lookups` names what the rule reads: "typo", "dns", "age".

    `per_domain` promises that the cuts depend on the domain alone, so that whole
    domains can be spared the next lookup.
    """

    name: str
    cuts: Callable[[RuleView], Sequence[Cut]] = lambda view: ()
    notes: Callable[[RuleView], dict[str, Column]] = lambda view: {}
    lookups: frozenset[str] = frozenset()
    per_domain: bool = False


# --- the default rules -------------------------------------------------------------

# No cuts: three flags in the output, reached by every address with valid syntax.
classify = Rule(
    "classify",
    notes=lambda v: {
        "free_email": v.on_list("free", v.domain),
        "disposable": v.on_list("disposable", v.domain),
        "role_based": v.on_list("roles", v.account) | v.on_list("system", v.account),
    },
)

# Cuts number 4 on start with the domain's list, then come those of the account.
disposable = Rule(
    "disposable", cuts=lambda v: [Cut(v.on_list("disposable", v.domain), "disposable", "do_not_mail")]
)

# Takes no option, unlike the shared mailboxes below.
system_mailbox = Rule(
    "system-mailbox", cuts=lambda v: [Cut(v.on_list("system", v.account), "system_mailbox", "do_not_mail")]
)

junk_account = Rule("junk-local-part", cuts=lambda v: [Cut(v.on_list("junk", v.account), "junk_local_part")])

suspicious_pattern = Rule(
    "suspicious-pattern",
    cuts=lambda v: [Cut(looks_like_filler(v.account), "suspicious_pattern", *TO_REVIEW)]
    if v.options.flag_suspicious_patterns
    else [],
)

role_account = Rule(
    "role-account",
    cuts=lambda v: [] if v.options.role_is_sendable else [Cut(v.on_list("roles", v.account), "role_based", *TO_REVIEW)],
)

# Its cut depends on the domain alone, so whole domains are spared the lookup of mail routing.
domain_typo = Rule(
    "domain-typo",
    cuts=lambda v: [Cut(v.looked_up["typo.high_confidence"], "possible_typo")],
    notes=lambda v: {"suggestion": F.concat(v.account, F.lit("@"), v.looked_up["typo.suggestion"])},
    lookups=frozenset({"typo"}),
    per_domain=True,
)


def _dns_cuts(v: RuleView) -> list[Cut]:
    no_mail = ~v.looked_up["dns.accepts_mail"]
    return [
        # `confirm` counts as sendable.
        Cut(v.looked_up["dns.resolver_failed"], "dns_unavailable", "unknown", "confirm"),
        Cut(v.looked_up["dns.null_mx"], "domain_does_not_accept_mail"),
        Cut(no_mail & v.notes["suggestion"].isNotNull(), "possible_typo"),
        Cut(no_mail, "no_dns_entries"),
    ]


def _dns_notes(v: RuleView) -> dict[str, Column]:
    works = ~v.looked_up["dns.resolver_failed"] & v.looked_up["dns.accepts_mail"]
    return {
        "cached": v.looked_up["dns.cached"],
        "mx_found": works,
        "mx_record": F.when(works, v.looked_up["dns.mx"]),
        "smtp_provider": F.when(works, v.looked_up["dns.provider"]),
        "catch_all": F.when(works, v.looked_up["dns.catch_all"]),
    }


mail_routing = Rule("dns", cuts=_dns_cuts, notes=_dns_notes, lookups=frozenset({"dns"}))

domain_age = Rule(
    "domain-age",
    notes=lambda v: {"domain_age_days": v.looked_up["age.days"]} if v.options.include_domain_age else {},
    lookups=frozenset({"age"}),
)

DEFAULT_RULES: tuple[Rule, ...] = (
    classify,
    disposable,
    system_mailbox,
    junk_account,
    suspicious_pattern,
    role_account,
    domain_typo,
    mail_routing,
    domain_age,
)


def insert_rule(rule: Rule, before: str, rules: Sequence[Rule] = DEFAULT_RULES) -> tuple[Rule, ...]:
    """The rules with one more in front of the named one."""
    at = [r.name for r in rules].index(before)
    return (*rules[:at], rule, *rules[at:])


def final_cuts(notes: dict[str, Column], options: Options) -> list[Cut]:
    """The verdict when no rule cut; the last one always applies."""
    catch_all_advice = "confirm" if options.catch_all_is_sendable else "manual_review"
    return [
        Cut(notes["catch_all"], None, "catch_all", catch_all_advice),
        Cut(notes["suggestion"].isNotNull(), "possible_typo", "valid", "confirm"),
        Cut(F.lit(True), None, "valid", "accept"),
    ]


def entry_cuts(email: Column, is_text: Column, is_blank: Column, syntax_ok: Column) -> list[Cut]:
    """What keeps an input from being an address at all."""
    return [
        Cut(email.isNull(), "field_not_found"),
        Cut(~is_text, "invalid_type"),
        Cut(is_blank, "empty"),
        Cut(~syntax_ok, "failed_syntax_check"),
    ]


def needs_lookup(rule: Rule, options: Options) -> bool:
    """Age is only read when the option asks for it."""
    return bool(rule.lookups - (frozenset() if options.include_domain_age else frozenset({"age"})))


@dataclass(frozen=True)
class Cascade:
    rules: tuple[Rule, ...]
    options: Options

    @property
    def address_rules(self) -> tuple[Rule, ...]:
        """The leading rules that need nothing but the address."""
        first = next((i for i, r in enumerate(self.rules) if needs_lookup(r, self.options)), len(self.rules))
        return self.rules[:first]

    @property
    def lookups(self) -> frozenset[str]:
        asked = (r.lookups for r in self.rules if needs_lookup(r, self.options))
        return reduce(frozenset.union, asked, frozenset())

    def rules_before(self, lookup: str) -> tuple[Rule, ...]:
        """Rules ahead of the first one that reads `lookup`."""
        first = next((i for i, r in enumerate(self.rules) if lookup in r.lookups), len(self.rules))
        return self.rules[:first]

    def evaluate(self, view: RuleView, rules: Sequence[Rule]) -> list[Evaluated]:
        """Cuts and notes of each rule in turn; a rule sees the notes of those before it."""
        notes, done = dict(view.notes), []
        for rule in rules:
            added = rule.notes(replace(view, notes=notes))
            notes = {**notes, **added}
            done.append(Evaluated(list(rule.cuts(replace(view, notes=notes))), added, notes))
        return done


@dataclass(frozen=True)
class Evaluated:
    cuts: list[Cut]
    added: dict[str, Column]
    notes: dict[str, Column]


def first_cut(cuts: Sequence[Cut], start: int = 0) -> Column:
    """Number of the first cut that applies, counting from `start`; null if none does."""
    branches = reduce(
        lambda chain, i: chain.when(cuts[i].when, F.lit(start + i)),
        range(len(cuts)),
        F.when(F.lit(False), F.lit(0)),
    )
    return branches.cast("int")


def any_cut(cuts: Sequence[Cut]) -> Column:
    hits = [F.coalesce(c.when, F.lit(False)) for c in cuts]
    return reduce(lambda x, y: x | y, hits, F.lit(False))
