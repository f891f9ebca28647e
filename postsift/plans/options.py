"""Options of a validation run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from postsift.sources.lists import ReferenceLists, build_lists
from postsift.sources.mail_routing import MAIL_TTL_MS
from postsift.sources.registry import REGISTRATION_TTL_MS


Extra = str | Sequence[str] | DataFrame


def _given(values: Extra) -> str | Sequence[str]:
    return () if isinstance(values, DataFrame) else values


def _table(values: Extra) -> DataFrame | None:
    return values if isinstance(values, DataFrame) else None


@dataclass(frozen=True)
class Options:
    """Extra lists are sequences, comma-separated text, or tables with a column `value`.

    Tables are joined where they lie; texts and sequences go into the plan.
    """

    catch_all_is_sendable: bool = True
    role_is_sendable: bool = True
    flag_suspicious_patterns: bool = True
    include_domain_age: bool = False
    extra_domains: Extra = ()
    extra_disposable: Extra = ()
    extra_roles: Extra = ()
    cache_ttl_ms: int = MAIL_TTL_MS
    registration_ttl_ms: int = REGISTRATION_TTL_MS

    @cached_property
    def lists(self) -> ReferenceLists:
        return build_lists(_given(self.extra_domains), _given(self.extra_disposable), _given(self.extra_roles))

    @property
    def domain_table(self) -> DataFrame | None:
        return _table(self.extra_domains)

    @property
    def list_tables(self) -> dict[str, DataFrame]:
        """Tables that extend a list looked up per contact, by the list's name."""
        given = {"disposable": _table(self.extra_disposable), "roles": _table(self.extra_roles)}
        return {name: table for name, table in given.items() if table is not None}
