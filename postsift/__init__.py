"""Recipient hygiene on Spark: is it worth sending to this address?"""

from postsift.functions import (
    edit_distance,
    has_valid_syntax,
    looks_like_filler,
    normalize_email,
    split_email,
)
from postsift.functions.sql import register_sql_functions
from postsift.operators.attach import HotKeys
from postsift.operators.counters import domain_sketches, merged_counts
from postsift.operators.providers import provider_matches
from postsift.operators.registration import domain_ages
from postsift.operators.snapshot import create_snapshot, merge_answers, open_snapshot, snapshot_answers
from postsift.operators.typo import find_typos, typo_match
from postsift.plans.options import Options
from postsift.plans.route import discarded, sendable, write_routed
from postsift.plans.rules import DEFAULT_RULES, Cut, Rule, RuleView, insert_rule
from postsift.plans.validate import answered_domains, lookup_counts, lookup_worklist, registration_worklist, validate, verdict_counts
from postsift.sources.lists import BASE_LISTS, ReferenceLists, build_lists

__all__ = [
    "BASE_LISTS",
    "DEFAULT_RULES",
    "Cut",
    "HotKeys",
    "Options",
    "ReferenceLists",
    "Rule",
    "RuleView",
    "answered_domains",
    "build_lists",
    "create_snapshot",
    "discarded",
    "domain_ages",
    "domain_sketches",
    "edit_distance",
    "find_typos",
    "has_valid_syntax",
    "insert_rule",
    "looks_like_filler",
    "lookup_counts",
    "lookup_worklist",
    "merge_answers",
    "merged_counts",
    "normalize_email",
    "open_snapshot",
    "provider_matches",
    "register_sql_functions",
    "registration_worklist",
    "sendable",
    "snapshot_answers",
    "split_email",
    "typo_match",
    "validate",
    "verdict_counts",
    "write_routed",
]
