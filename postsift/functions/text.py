"""Address text as column expressions: trim, normalise, syntax, split.

Everything here is built-in Spark SQL, so it runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space at the edges of an address (every
# Unicode space separator, the line terminators and the byte-order mark). NEL
# (U+0085) is not one of them.
EDGE_SPACE = (
    "\t\n\x0b\f\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# The accepted alphabet and the two length limits. `\z` and not
# `$`: Java's `$` would also match before a trailing line terminator.
ADDRESS_PATTERN = r"^[A-Za-z0-9!#$%&'*+/=?^_`{|}~.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"
MAX_ADDRESS_LENGTH = 254
MAX_ACCOUNT_LENGTH = 64


def trim_edges(text: Column) -> Column:
    """Strip Unicode white space from both ends (Spark's `trim` strips U+0020 only)."""
    return F.btrim(text, F.lit(EDGE_SPACE))


def account_of(address: Column) -> Column:
    """What precedes the last `@`; the empty string when there is none."""
    size = F.length(address) - F.length(domain_of(address)) - 1
    return F.substring(address, F.lit(1), F.greatest(size, F.lit(0)))


def domain_of(address: Column) -> Column:
    """What follows the last `@`; the whole text when there is none."""
    return F.substring_index(address, "@", -1)


def split_email(address: Column) -> Column:
    """struct<account, domain>, cut at the last `@`."""
    return F.struct(account_of(address).alias("account"), domain_of(address).alias("domain"))


def fold(raw: Column) -> Column:
    """Trimmed and lower case."""
    return F.lower(trim_edges(raw))


def bare_account(account: Column) -> Column:
    """Account without the dots at its edges."""
    return F.btrim(account, F.lit("."))


def rejoin(folded: Column, account: Column, domain: Column) -> Column:
    """Folded text with the bare account; text without an account is left as it is."""
    return F.when(account == "", folded).otherwise(F.concat(bare_account(account), F.lit("@"), domain))


def normalize_email(raw: Column) -> Column:
    """struct<email, changed>: trimmed, lower case, no dots at the edges of the account.

    `changed` reports removed dots only; white space and case do not count.
    """
    folded = fold(raw)
    account = account_of(folded)
    return F.struct(
        rejoin(folded, account, domain_of(folded)).alias("email"),
        (bare_account(account) != account).alias("changed"),
    )


def has_valid_syntax(address: Column, account: Column | None = None) -> Column:
    """Pragmatic syntax gate. The pattern leaves room for exactly one `@`."""
    account = account_of(address) if account is None else account
    return (
        (F.length(address) <= MAX_ADDRESS_LENGTH)
        & ~F.contains(address, F.lit(".."))
        & address.rlike(ADDRESS_PATTERN)
        & (F.length(account) <= MAX_ACCOUNT_LENGTH)
    )


def clean_value(text: Column) -> Column:
    """A list value without the white space at its edges, in lower case."""
    return F.lower(trim_edges(text))


def list_values(text: Column) -> Column:
    """Comma-separated text -> array of trimmed, lower-case, non-empty values."""
    folded = F.transform(F.split(text, ","), clean_value)
    return F.filter(folded, lambda v: v != "")


def iso_instant(ts: Column) -> Column:
    """Timestamp -> ISO-8601 text in UTC with milliseconds, whatever the session zone."""
    # Counted from the epoch in whole days and milliseconds, so no session zone can shift it.
    millis, day = F.unix_millis(ts), F.lit(86_400_000)
    rest = F.pmod(millis, day)
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(millis / day).cast("int"))

    def digits(value: Column, width: int) -> Column:
        return F.lpad(value.cast("bigint").cast("string"), width, "0")

    time = F.concat_ws(":", digits(rest / 3_600_000, 2), digits(rest % 3_600_000 / 60_000, 2), digits(rest % 60_000 / 1000, 2))
    return F.concat(date.cast("string"), F.lit("T"), time, F.lit("."), digits(rest % 1000, 3), F.lit("Z"))
