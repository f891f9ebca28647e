"""Reference lists: fixed values, user extensions, and the same lists as tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.functions.text import EDGE_SPACE

# ---------------------------------------------------------------------------
# Word lists in their natural order. The order of FREE + LOCAL_ISPS
# decides between equally near suggestions, that of PROVIDERS between suffixes.
# ---------------------------------------------------------------------------

TIER1 = (
    "gmail.com", "hotmail.com", "outlook.com", "yahoo.com", "live.com",
    "icloud.com", "hotmail.es", "outlook.es", "yahoo.es",
)

FREE = TIER1 + (
    "ymail.com", "rocketmail.com", "me.com", "mac.com", "aol.com", "aim.com",
    "msn.com", "live.com.mx", "live.com.co", "hotmail.com.mx", "hotmail.com.co",
    "hotmail.com.ar", "hotmail.co.uk", "yahoo.com.mx", "yahoo.com.co",
    "yahoo.com.ar", "outlook.com.co", "protonmail.com", "proton.me", "gmx.com",
    "gmx.net", "zoho.com", "yandex.com", "mail.com", "mail.ru", "tutanota.com",
    "fastmail.com",
)

LOCAL_ISPS = (
    "une.net.co", "etb.net.co", "telmex.net.co", "claro.com.co", "movistar.com.co",
)

DISPOSABLE = (
    "mailinator.com", "10minutemail.com", "guerrillamail.com", "guerrillamail.info",
    "tempmail.com", "temp-mail.org", "tempmailo.com", "tempr.email", "yopmail.com",
    "throwawaymail.com", "trashmail.com", "sharklasers.com", "getnada.com",
    "maildrop.cc", "dispostable.com", "fakeinbox.com", "mailnesia.com",
    "mailcatch.com", "spamgourmet.com", "emailondeck.com", "moakt.com",
    "mohmal.com", "correotemporal.org", "grr.la",
)

SYSTEM_MAILBOXES = (
    "abuse", "bounce", "bounces", "devnull", "mailer-daemon", "mailerdaemon",
    "no-reply", "noreply", "postmaster", "spam",
)

SHARED_MAILBOXES = (
    "admin", "administracion", "ayuda", "billing", "comercial", "compras",
    "contabilidad", "contact", "contacto", "contratacion", "facturacion",
    "gerencia", "hola", "info", "licitaciones", "marketing", "notificaciones",
    "office", "pedidos", "rrhh", "sales", "servicioalcliente", "soporte",
    "support", "team", "ventas", "webmaster",
)

JUNK = (
    "123", "1234", "aaa", "aaaa", "abc", "asd", "asdf", "asdfasdf", "correo",
    "ejemplo", "example", "fake", "falso", "na", "nada", "ninguno", "noexiste",
    "nomail", "none", "prueba", "pruebas", "qwerty", "sdfsdf", "sinemail", "test",
    "testing", "xx", "xxx",
)


class Provider(NamedTuple):
    mx_suffix: str
    name: str
    catch_all: bool | None


PROVIDERS = (
    Provider("protection.outlook.com", "microsoft", True),
    Provider("outlook.com", "microsoft", True),
    Provider("google.com", "google", False),
    Provider("googlemail.com", "google", False),
    Provider("yahoodns.net", "yahoo", False),
    Provider("icloud.com", "apple", False),
    Provider("apple.com", "apple", False),
    Provider("zoho.com", "zoho", None),
    Provider("secureserver.net", "godaddy", None),
    Provider("mail.ru", "mailru", None),
    Provider("yandex.net", "yandex", None),
)


@dataclass(frozen=True)
class ReferenceLists:
    tier1: tuple[str, ...] = TIER1
    free: tuple[str, ...] = FREE
    common: tuple[str, ...] = FREE + LOCAL_ISPS
    disposable: tuple[str, ...] = DISPOSABLE
    system: tuple[str, ...] = SYSTEM_MAILBOXES
    roles: tuple[str, ...] = SHARED_MAILBOXES
    junk: tuple[str, ...] = JUNK
    providers: tuple[Provider, ...] = PROVIDERS


BASE_LISTS = ReferenceLists()


def clean_values(values: str | Iterable[str]) -> tuple[str, ...]:
    """Trimmed, lower-case, non-empty. A string is comma-separated text."""
    parts = values.split(",") if isinstance(values, str) else values
    return tuple(v for v in (p.strip(EDGE_SPACE).lower() for p in parts) if v)


def build_lists(
    domains: str | Sequence[str] = (),
    disposable: str | Sequence[str] = (),
    roles: str | Sequence[str] = (),
) -> ReferenceLists:
    """Base lists plus the user's values; the first occurrence keeps its position.

    Extra domains join `common` only: they are neither free nor tier 1.
    """

    def extend(base: tuple[str, ...], extra: str | Sequence[str]) -> tuple[str, ...]:
        return tuple(dict.fromkeys(base + clean_values(extra)))

    return ReferenceLists(
        common=extend(BASE_LISTS.common, domains),
        disposable=extend(BASE_LISTS.disposable, disposable),
        roles=extend(BASE_LISTS.roles, roles),
    )


LIST_NAMES = ("tier1", "free", "common", "disposable", "system", "roles", "junk")
LIST_SCHEMA = "list string, value string, ordinal int"


def list_dimension(spark: SparkSession, lists: ReferenceLists = BASE_LISTS) -> DataFrame:
    """All word lists as one table (list, value, ordinal)."""
    rows = [(name, value, i) for name in LIST_NAMES for i, value in enumerate(getattr(lists, name))]
    return spark.createDataFrame(rows, LIST_SCHEMA)


def provider_dimension(spark: SparkSession, lists: ReferenceLists = BASE_LISTS) -> DataFrame:
    rows = [(i, *provider) for i, provider in enumerate(lists.providers)]
    return spark.createDataFrame(rows, "ordinal int, mx_suffix string, name string, catch_all boolean")


def extend_dimension(dimension: DataFrame, extensions: DataFrame) -> DataFrame:
    """Union a table of user values (list, value, ordinal) into a list table.

    Values are cleaned like `clean_values`; a value already on a list keeps its first
    position, new ones follow in the order of their own ordinal. The new ordinals are
    ordered but need not be consecutive.
    """
    bounds = (
        dimension.where(F.col("list").isin(*LIST_NAMES))
        .groupBy("list")
        .agg((F.max("ordinal") + 1).alias("offset"))
    )
    cleaned = extensions.select(
        "list", F.lower(F.btrim("value", F.lit(EDGE_SPACE))).alias("value"), "ordinal"
    ).where("value <> ''")
    # Seven list names, so `bounds` has at most seven rows.
    shifted = cleaned.join(F.broadcast(bounds), "list", "left").select(
        "list", "value", (F.col("ordinal") + F.coalesce("offset", F.lit(0))).alias("ordinal")
    )
    return (
        dimension.select("list", "value", "ordinal")
        .unionByName(shifted)
        .groupBy("list", "value")
        .agg(F.min("ordinal").alias("ordinal"))
    )
