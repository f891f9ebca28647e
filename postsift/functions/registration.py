"""Reading a registration (RDAP) answer with column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def registration_date(body: Column) -> Column:
    """Date of the first `registration` event in the answer; null when absent or unreadable."""
    document = F.try_parse_json(body)
    events = F.try_variant_get(document, "$.events", "array<variant>")
    first = F.get(
        F.filter(events, lambda e: F.try_variant_get(e, "$.eventAction", "string") == "registration"), F.lit(0)
    )
    text = F.try_variant_get(first, "$.eventDate", "string")
    # A date alone means midnight in UTC, whatever the session zone.
    bare = text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    return F.try_to_timestamp(F.when(bare, F.concat(text, F.lit("T00:00:00Z"))).otherwise(text))


def registration_age_days(body: Column, now: Column) -> Column:
    """Whole days between registration and `now`; negative when it lies in the future."""
    elapsed = F.unix_millis(now) - F.unix_millis(registration_date(body))
    return F.floor(elapsed / F.lit(DAY_MS)).cast("int")


def answer_is_usable(http_status: Column, body: Column, error: Column) -> Column:
    """A 2xx answer whose body can be parsed."""
    return F.coalesce(
        error.isNull() & http_status.between(200, 299) & F.try_parse_json(body).isNotNull(), F.lit(False)
    )


def answer_is_cacheable(http_status: Column, body: Column, error: Column) -> Column:
    """Worth keeping: a usable answer, or 404 ("not registered" is final).

    Rate limits, server errors and time-outs pass, so they are asked again.
    """
    not_registered = F.coalesce(error.isNull() & (http_status == 404), F.lit(False))
    return answer_is_usable(http_status, body, error) | not_registered
