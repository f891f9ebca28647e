"""Mail-routing decisions, freshness of kept answers, work lists and counts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

import postsift as ps
from fixtures import ZONE, zone_frame, zone_rows
from postsift.sources.mail_routing import (
    DNS_SCHEMA,
    domain_mail_status,
    instant,
    is_fresh,
    latest_kept,
    usable_answers,
)

NOW = datetime(2026, 8, 20, 12, 0, 0)
AS_OF = "2026-08-20T12:00:00Z"

# name -> (mx, mx_code, a, a_code), (mx host, accepts, null mx, exists, failed)
DECISIONS = {
    "dot": (([(".", 0)], None, None, None), (None, False, True, True, False)),
    "empty-host": (([("", 0)], None, None, None), (None, False, True, True, False)),
    "host": (([("MX.Example.COM.", 5)], None, None, None), ("mx.example.com", True, False, True, False)),
    "lowest": (([("b.", 9), ("a.", 5), ("c.", 5)], None, None, None), ("a", True, False, True, False)),
    "dot-not-best": (([("a.", 1), (".", 5)], None, None, None), ("a", True, False, True, False)),
    "no-host": (([(None, 1)], None, None, None), (None, False, False, False, True)),
    "enotfound": ((None, "ENOTFOUND", ["192.0.2.1"], None), (None, False, False, False, False)),
    "nxdomain": ((None, "NXDOMAIN", None, None), (None, False, False, False, False)),
    "servfail": ((None, "ESERVFAIL", ["192.0.2.1"], None), (None, False, False, False, True)),
    "unknown-code": ((None, "UNKNOWN", None, None), (None, False, False, False, True)),
    "a-record": ((None, "ENODATA", ["192.0.2.1"], None), (None, True, False, True, False)),
    "empty-mx-a": (([], None, ["192.0.2.1"], None), (None, True, False, True, False)),
    "null-mx-list-a": ((None, None, ["192.0.2.1"], None), (None, True, False, True, False)),
    "no-a": ((None, "ENODATA", [], None), (None, False, False, True, False)),
    "a-nodata": ((None, "ENODATA", None, "ENODATA"), (None, False, False, True, False)),
    "a-notfound": ((None, "ENODATA", None, "ENOTFOUND"), (None, False, False, False, False)),
    "a-nxdomain": (([], None, None, "NXDOMAIN"), (None, False, False, False, False)),
    "a-timeout": ((None, "ENODATA", None, "ETIMEOUT"), (None, False, False, False, True)),
}


def test_decision_table(spark):
    rows = [(name, *answer, None) for name, (answer, _) in DECISIONS.items()]
    got = {
        r["domain"]: (r["mx"], r["accepts_mail"], r["null_mx"], r["domain_exists"], r["resolver_failed"])
        for r in domain_mail_status(spark.createDataFrame(rows, DNS_SCHEMA)).collect()
    }
    assert got == {name: want for name, (_, want) in DECISIONS.items()}


def test_an_entry_expires_at_exactly_its_time_to_live(spark):
    ages = [999, 1000, 1001]
    frame = spark.createDataFrame([(ms, NOW - timedelta(milliseconds=ms)) for ms in ages], "age int, fetched_at timestamp")
    got = frame.select(is_fresh(F.col("fetched_at"), instant(AS_OF), 1000)).collect()
    assert [r[0] for r in got] == [True, False, False]


def snapshot(spark, rows):
    return spark.createDataFrame(rows, DNS_SCHEMA)


def versions(spark):
    def row(domain, host, hours, code=None):
        at = None if hours is None else NOW - timedelta(hours=hours)
        return (domain, None if code else [(host, 1)], code, None, None, at)

    return snapshot(
        spark,
        [
            row("kept.com", "old.", 5),
            row("kept.com", "new.", 1),
            row("kept.com", "live.", None),
            row("stale.com", "old.", 7),
            row("edge.com", "old.", 6),
            row("failed.com", "x.", 2, "ESERVFAIL"),
            row("failed.com", "good.", 3),
            row("live.com", "live.", None),
            row("livefail.com", "x.", None, "ESERVFAIL"),
        ],
    )


def test_usable_answers(spark):
    got = {r["domain"]: (r["kept"], r["mx"], r["resolver_failed"]) for r in usable_answers(versions(spark), instant(AS_OF)).collect()}
    assert got == {
        "kept.com": (True, "new", False),
        "failed.com": (True, "good", False),
        "live.com": (False, "live", False),
        "livefail.com": (False, None, True),
    }


def test_latest_kept_ignores_failures_and_live_answers(spark):
    got = {r["domain"]: r["mx"] for r in latest_kept(versions(spark)).collect()}
    assert got == {"kept.com": "new", "stale.com": "old", "edge.com": "old", "failed.com": "good"}


def contacts(spark, addresses):
    return spark.createDataFrame(list(enumerate(addresses)), "input_seq long, email string")


def test_hundred_contacts_one_lookup(spark):
    rows = contacts(spark, [f"usuario{i}@gmail.com" for i in range(100)])
    done = ps.validate(rows, dns=zone_frame(spark), order_by="input_seq")
    assert {r[0] for r in done.select("validation.recommendation").collect()} == {"accept"}
    counts = ps.lookup_counts(rows, dns=zone_frame(spark)).first()
    assert (counts["lookups"], counts["entries"]) == (1, 1)


def test_failures_are_asked_again(spark):
    counts = ps.lookup_counts(contacts(spark, ["a@caido.com", "b@caido.com"]), dns=zone_frame(spark)).first()
    assert (counts["lookups"], counts["entries"]) == (2, 0)


def test_a_sure_typo_asks_nothing(spark):
    rows = contacts(spark, ["maria@hotmial.com", "test@soloa.com", "x@mailinator.com", "sin-arroba"])
    assert ps.lookup_worklist(rows, dns=None).count() == 0
    counts = ps.lookup_counts(rows, dns=zone_frame(spark)).first()
    assert (counts["lookups"], counts["entries"]) == (0, 0)


def test_worklist_leaves_out_fresh_domains(spark):
    rows = contacts(spark, ["a@kept.com", "b@kept.com", "c@stale.com", "d@edge.com", "e@failed.com", "f@livefail.com", "g@new.org"])
    got = {tuple(r) for r in ps.lookup_worklist(rows, dns=versions(spark), as_of=AS_OF).collect()}
    assert got == {("stale.com", 1), ("edge.com", 1), ("livefail.com", 1), ("new.org", 1)}


def cached(spark, rows, dns, **more):
    done = ps.validate(rows, dns=dns, as_of=AS_OF, **more)
    return {r["input_seq"]: r["cached"] for r in done.select("input_seq", "validation.cached").collect()}


def test_cached_flag(spark):
    rows = contacts(spark, ["asdf@gmail.com", "a@gmail.com", "b@gmail.com", "a@caido.com", "b@caido.com", "sin-arroba"])
    got = cached(spark, rows, zone_frame(spark), order_by="input_seq")
    assert got == {0: False, 1: False, 2: True, 3: False, 4: False, 5: False}


def test_kept_answers_are_cached_from_the_first_contact_on(spark):
    kept = snapshot(spark, zone_rows(ZONE, NOW - timedelta(hours=1)))
    got = cached(spark, contacts(spark, ["a@gmail.com", "b@gmail.com"]), kept)
    assert got == {0: True, 1: True}
    expired = snapshot(spark, zone_rows(ZONE, NOW - timedelta(hours=6)))
    done = ps.validate(contacts(spark, ["a@gmail.com"]), dns=expired, as_of=AS_OF).select("validation.*").first()
    assert (done["status"], done["recommendation"], done["cached"]) == ("unknown", "confirm", False)


def test_time_to_live_is_an_option(spark):
    kept = snapshot(spark, zone_rows(ZONE, NOW - timedelta(hours=1)))
    short = ps.Options(cache_ttl_ms=60_000)
    assert cached(spark, contacts(spark, ["a@gmail.com"]), kept, options=short) == {0: False}
