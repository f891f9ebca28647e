"""The whole cascade on the zone: verdicts, fields, options, masking, custom rules."""

from __future__ import annotations

import pytest

import postsift as ps
from fixtures import ZONE, zone_frame
from postsift.plans.validate import VALIDATION_SCHEMA

AS_OF = "2026-08-20T16:38:09.370Z"


def run(spark, addresses, zone=ZONE, **more):
    rows = spark.createDataFrame(list(enumerate(addresses)), "input_seq long, email string")
    done = ps.validate(rows, dns=zone_frame(spark, zone), order_by="input_seq", as_of=AS_OF, **more)
    return [r["validation"] for r in done.orderBy("input_seq").collect()]


def verdict(v):
    return v["status"], v["sub_status"], v["recommendation"]


# The verdict of each address on the zone.
GOLDEN = {
    "juan.perez@gmail.com": ("valid", None, "accept", None),
    "juan@gmial.com": ("invalid", "possible_typo", "reject", "juan@gmail.com"),
    "maria@hotmial.com": ("invalid", "possible_typo", "reject", "maria@hotmail.com"),
    "brgtk58@hotmail.com": ("catch_all", None, "confirm", None),
    "asdf@asdf.com": ("invalid", "junk_local_part", "reject", None),
    "info@empresa.com.co": ("valid", None, "accept", None),
    "test@mailinator.com": ("do_not_mail", "disposable", "reject", None),
    "sin-arroba": ("invalid", "failed_syntax_check", "reject", None),
    "a@@b.com": ("invalid", "failed_syntax_check", "reject", None),
    ".juan@gmail.com": ("valid", None, "accept", None),
    "a" * 65 + "@gmail.com": ("invalid", "failed_syntax_check", "reject", None),
    "alguien@ymail.com": ("valid", None, "accept", None),
    "alguien@une.net.co": ("valid", None, "accept", None),
    "alguien@soloa.com": ("valid", None, "accept", None),
    "alguien@sincorreo.com": ("invalid", "domain_does_not_accept_mail", "reject", None),
    "alguien@dominio-que-no-existe-xyz.com": ("invalid", "no_dns_entries", "reject", None),
    "alguien@caido.com": ("unknown", "dns_unavailable", "confirm", None),
    "alguien@sin-respuesta.org": ("unknown", "dns_unavailable", "confirm", None),
    "postmaster@mailinator.com": ("do_not_mail", "disposable", "reject", None),
    "test@gmial.com": ("invalid", "junk_local_part", "reject", None),
    "qwerty@gmail.com": ("invalid", "junk_local_part", "reject", None),
    "xxxxxyyyy@gmail.com": ("do_not_mail", "suspicious_pattern", "manual_review", None),
    "a@b.com\u0085": ("invalid", "failed_syntax_check", "reject", None),
    ".@x.com": ("invalid", "failed_syntax_check", "reject", None),
    None: ("invalid", "field_not_found", "reject", None),
    "   ": ("invalid", "empty", "reject", None),
}


@pytest.mark.parametrize("way", ["settled", "lazy", "hot"])
def test_golden(spark, way, tmp_path_factory):
    if way == "settled":
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    more = {"settled": way == "settled"}
    if way == "hot":
        more["hot_keys"] = ps.HotKeys(min_rows=2, max_keys=2)
    got = run(spark, list(GOLDEN), **more)
    assert {a: (*verdict(v), v["suggestion"]) for a, v in zip(GOLDEN, got)} == GOLDEN


def test_schema(spark):
    rows = spark.createDataFrame([(1, "a@b.co")], "id long, email string")
    done = ps.validate(rows)
    names = [f"{f.name} {f.dataType.simpleString()}" for f in done.schema["validation"].dataType.fields]
    assert ", ".join(names) == VALIDATION_SCHEMA
    assert done.columns == ["id", "email", "validation"]


def test_fields_of_a_sendable_contact(spark):
    (v,) = run(spark, ["brgtk58@hotmail.com"])
    assert v.asDict() == {
        "email": "brgtk58@hotmail.com",
        "normalized": "brgtk58@hotmail.com",
        "send_to": "brgtk58@hotmail.com",
        "status": "catch_all",
        "sub_status": None,
        "recommendation": "confirm",
        "sendable": True,
        "suggestion": None,
        "account": "brgtk58",
        "domain": "hotmail.com",
        "free_email": True,
        "role_based": False,
        "disposable": False,
        "normalization_applied": False,
        "mx_found": True,
        "mx_record": "hotmail-com.olc.protection.outlook.com",
        "smtp_provider": "microsoft",
        "catch_all": True,
        "domain_age_days": None,
        "checked_at": AS_OF,
        "cached": False,
        "duration_ms": None,
        "field_searched": None,
    }


def test_normalisation_shows(spark):
    dotted, spaced, typo = run(spark, [".juan@gmail.com", "  Juan.Perez@Gmail.com  ", "juan@gmial.com"])
    assert (dotted["normalized"], dotted["send_to"], dotted["normalization_applied"]) == ("juan@gmail.com", "juan@gmail.com", True)
    assert (spaced["email"], spaced["normalized"]) == ("  Juan.Perez@Gmail.com  ", "juan.perez@gmail.com")
    assert (typo["sendable"], typo["send_to"], typo["suggestion"]) == (False, None, "juan@gmail.com")


def test_mx_fields(spark):
    only_a, many, google = run(spark, ["x@soloa.com", "a@multi.com", "a@gmail.com"])
    assert (only_a["mx_found"], only_a["mx_record"], only_a["smtp_provider"], only_a["catch_all"]) == (True, None, None, None)
    assert many["mx_record"] == "principal.example.com"
    assert (google["smtp_provider"], google["catch_all"]) == ("google", False)


def test_fields_stay_empty_until_their_rule_is_reached(spark):
    early, syntax, junk, typo, failed, null_mx = run(
        spark, [None, ".@x.com", "test@gmial.com", "info@hotmial.com", "a@caido.com", "a@sincorreo.com"]
    )
    assert (early["email"], early["normalized"], early["account"]) == ("", None, None)
    assert (syntax["normalized"], syntax["account"], syntax["domain"], syntax["normalization_applied"]) == ("@x.com", None, None, True)
    assert (junk["suggestion"], junk["account"], junk["cached"]) == (None, "test", False)
    assert (typo["suggestion"], typo["role_based"], typo["mx_found"], typo["mx_record"]) == ("info@hotmail.com", True, False, None)
    for v in (failed, null_mx):
        assert (v["mx_found"], v["mx_record"], v["smtp_provider"], v["catch_all"]) == (False, None, None, None)
    (system,) = run(spark, ["postmaster@mailinator.com"])
    assert (system["role_based"], system["disposable"]) == (True, True)


def test_unsure_typos_go_on(spark):
    zone = {
        "gmx.con": ([("mx.gmx.con.", 1)], None, None),
        "hotmall.com.mx": ([("a.protection.outlook.com.", 1)], None, None),
        "prton.me": (None, None, "ENOTFOUND"),
    }
    plain, takes_all, missing = run(spark, ["ana@gmx.con", "ana@hotmall.com.mx", "ana@prton.me"], zone)
    assert (*verdict(plain), plain["suggestion"]) == ("valid", "possible_typo", "confirm", "ana@gmx.com")
    assert (*verdict(takes_all), takes_all["suggestion"]) == ("catch_all", None, "confirm", "ana@hotmail.com.mx")
    assert (*verdict(missing), missing["suggestion"]) == ("invalid", "possible_typo", "reject", "ana@proton.me")


def test_own_domains_are_not_corrected(spark):
    assert run(spark, ["a@gmail.co"])[0]["suggestion"] == "a@gmail.com"
    (own,) = run(spark, ["a@gmail.co"], {"gmail.co": (None, ["192.0.2.4"], None)}, options=ps.Options(extra_domains=["Gmail.co"]))
    assert (*verdict(own), own["suggestion"]) == ("valid", None, "accept", None)
    for v in run(spark, ["a@ymail.com", "a@une.net.co", "a@hotmail.com"]):
        assert v["suggestion"] is None


SHARED = ["info@empresa.com", "ventas@empresa.com", "licitaciones@empresa.com", "contratacion@empresa.com"]


def test_shared_mailboxes_follow_the_option(spark):
    for v in run(spark, SHARED):
        assert (v["recommendation"], v["sendable"], v["role_based"], v["mx_found"]) == ("accept", True, True, True)
    for v in run(spark, SHARED, options=ps.Options(role_is_sendable=False)):
        assert (*verdict(v), v["role_based"]) == ("do_not_mail", "role_based", "manual_review", True)


def test_system_mailboxes_never_pass(spark):
    for v in run(spark, [f"{a}@empresa.com" for a in ("postmaster", "abuse", "noreply", "mailer-daemon")]):
        assert (*verdict(v), v["sendable"]) == ("do_not_mail", "system_mailbox", "reject", False)


def test_extra_roles_and_disposables(spark):
    assert run(spark, ["tesoreria@empresa.com.co"])[0]["role_based"] is False
    options = ps.Options(extra_roles="tesoreria, ", extra_disposable=["SoloA.com"], role_is_sendable=False)
    role, gone = run(spark, ["tesoreria@empresa.com.co", "x@soloa.com"], options=options)
    assert (role["role_based"], role["recommendation"]) == (True, "manual_review")
    assert verdict(gone) == ("do_not_mail", "disposable", "reject")


def test_other_options(spark):
    assert verdict(run(spark, ["xxxxxyyyy@gmail.com"], options=ps.Options(flag_suspicious_patterns=False))[0]) == ("valid", None, "accept")
    (v,) = run(spark, ["a@hotmail.com"], options=ps.Options(catch_all_is_sendable=False))
    assert (*verdict(v), v["send_to"]) == ("catch_all", None, "manual_review", None)


def test_long_extension_lists_become_joins(spark, monkeypatch):
    many = [f"basura{i}.com" for i in range(1500)]
    roles = [f"area{i}" for i in range(1500)]
    domains = [f"propio{i}.com" for i in range(1500)]
    options = ps.Options(extra_disposable=many, extra_roles=roles, extra_domains=domains, role_is_sendable=False)
    addresses = ["a@basura7.com", "area9@empresa.com", "a@propio1499.com", "juan@gmial.com", "a@prpoio77.com", "a@gmail.com"]
    got = run(spark, addresses, options=options)
    assert [v["sub_status"] for v in got] == ["disposable", "role_based", "dns_unavailable", "possible_typo", "dns_unavailable", None]
    assert [v["suggestion"] for v in got] == [None, None, None, "juan@gmail.com", "a@propio77.com", None]
    import postsift.operators.membership as membership

    monkeypatch.setattr(membership.flag_long_lists, "__defaults__", (1000, 10, None))
    assert [verdict(v) for v in run(spark, addresses, options=options)] == [verdict(v) for v in got]


VETO = ps.Rule("veto", cuts=lambda v: [ps.Cut(v.account.startswith("no."), "vetoed", "do_not_mail", "manual_review")])


def test_custom_rule(spark):
    addresses = ["no.ana@gmail.com", "ana@gmail.com", "no.ana@mailinator.com", "eva@gmail.com"]
    got = run(spark, addresses, rules=ps.insert_rule(VETO, before="junk-local-part"))
    assert [v["sub_status"] for v in got] == ["vetoed", None, "disposable", None]
    assert [v["cached"] for v in got] == [False, False, False, True]


def test_custom_rule_after_the_typo_lookup(spark):
    odd = ps.Rule(
        "odd",
        cuts=lambda v: [ps.Cut(v.looked_up["typo.suggestion"].isNotNull() & (v.account == "ana"), "odd", "do_not_mail", "manual_review")],
        lookups=frozenset({"typo"}),
    )
    zone = {"gmail.co": (None, ["192.0.2.4"], None), "gmx.con": ([("mx.gmx.con.", 1)], None, None)}
    addresses = ["ana@gmx.con", "eva@gmx.con", "luz@gmx.con", "ana@gmail.co"]
    got = run(spark, addresses, zone, rules=ps.insert_rule(odd, before="dns"))
    assert [v["sub_status"] for v in got] == ["odd", "possible_typo", "possible_typo", "possible_typo"]
    # ana@gmx.con was cut before mail routing, so eva is the first to ask.
    assert [v["cached"] for v in got] == [False, False, True, False]


def test_rules_can_be_replaced(spark):
    from postsift.plans.rules import classify

    (v,) = run(spark, ["postmaster@mailinator.com"], rules=[classify])
    assert (*verdict(v), v["disposable"], v["mx_found"]) == ("valid", None, "accept", True, False)


def test_ages_show_only_where_mail_routing_passed(spark):
    ages = spark.createDataFrame([("gmail.com", 11), ("sincorreo.com", 12), ("caido.com", 13)], "domain string, age_days int")
    addresses = ["a@gmail.com", "a@sincorreo.com", "a@caido.com", "a@soloa.com"]
    got = run(spark, addresses, ages=ages, options=ps.Options(include_domain_age=True))
    assert [v["domain_age_days"] for v in got] == [11, None, None, None]
    assert [v["domain_age_days"] for v in run(spark, addresses, ages=ages)] == [None] * 4


def test_plan_has_no_python_and_no_all_pairs_join(spark):
    rows = spark.createDataFrame([(1, "a@b.co")], "input_seq long, email string")
    done = ps.validate(rows, dns=zone_frame(spark), order_by="input_seq", settled=False)
    plan = done._jdf.queryExecution().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert word not in plan


def test_everyone_is_kept(spark):
    addresses = [f"ana{i % 7}@{'gmail.com' if i % 3 else f'd{i}.org'}" for i in range(300)]
    got = run(spark, addresses, settled=False, hot_keys=ps.HotKeys(min_rows=50, max_keys=1))
    assert [v["email"] for v in got] == addresses
    assert sum(v["status"] == "valid" for v in got) == 200


NAMES = ["first", "dns", "typo", "rows", "age_days", "domain", "sendable", "Email", "Validation"]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("settled", [True, False])
def test_any_payload_name(spark, tmp_path, name, settled):
    spark.sparkContext.setCheckpointDir(f"{tmp_path}/checkpoints")
    rows = spark.createDataFrame([(1, "ana@gmail.com", "mine")], f"input_seq long, address string, `{name}` string")
    ages = spark.createDataFrame([("gmail.com", 7), ("gmail.com", 9)], "domain string, age_days int")
    done = ps.validate(
        rows, "address", dns=zone_frame(spark), ages=ages, order_by="input_seq", settled=settled, options=ps.Options(include_domain_age=True)
    )
    (row,) = done.collect()
    assert (row["validation"]["status"], row["validation"]["domain_age_days"]) == ("valid", 9)
    if name.lower() not in ("email", "validation"):
        assert row[name] == "mine"
    done.write.parquet(f"{tmp_path}/plain")
    if name == "sendable":
        with pytest.raises(ValueError, match="sendable"):
            ps.write_routed(done, f"{tmp_path}/routed")
    ps.write_routed(done, f"{tmp_path}/other", column="way")
    assert spark.read.parquet(f"{tmp_path}/other").count() == 1


def test_both_ways_share_the_contacts(spark):
    """The clock is taken once, so no contact is on both ways or on neither."""
    from datetime import datetime, timedelta, timezone

    fetched = datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(hours=6) + timedelta(seconds=4)
    rows = spark.createDataFrame([(i, f"a{i}@gmail.com") for i in range(20)], "input_seq long, email string")
    done = ps.validate(rows, dns=zone_frame(spark, ZONE, fetched))
    one = ps.sendable(done).count()
    import time

    time.sleep(5)
    assert one + ps.discarded(done).count() == 20
    assert done.select("validation.checked_at").distinct().count() == 1


def test_rule_on_typos_holds_no_long_list(spark):
    mixed = ps.Rule(
        "mixed",
        cuts=lambda v: [ps.Cut(v.looked_up["typo.suggestion"].isNotNull() & (v.account == "ana"), "mixed", "do_not_mail", "manual_review")],
        lookups=frozenset({"typo"}),
    )
    rows = spark.createDataFrame([(1, "ana@prpoio77.com"), (2, "eva@prpoio77.com")], "input_seq long, email string")
    options = ps.Options(extra_domains=[f"propio{i}.com" for i in range(5000)])
    done = ps.validate(rows, order_by="input_seq", rules=ps.insert_rule(mixed, before="dns"), options=options)
    assert "propio4999" not in done._jdf.queryExecution().optimizedPlan().toString()
    assert [r["validation"]["sub_status"] for r in done.orderBy("input_seq").collect()] == ["mixed", "dns_unavailable"]


def test_lists_as_tables(spark):
    table = lambda *values: spark.createDataFrame([(v,) for v in values], "value string")
    options = ps.Options(
        extra_disposable=table(" SoloA.com", *[f"basura{i}.com" for i in range(1200)]),
        extra_roles=table("Tesoreria"),
        extra_domains=table("propio.com"),
        role_is_sendable=False,
    )
    addresses = ["a@soloa.com", "a@mailinator.com", "tesoreria@empresa.com", "info@empresa.com", "a@propoi.com", "a@gmail.com"]
    got = run(spark, addresses, options=options)
    assert [v["sub_status"] for v in got] == ["disposable", "disposable", "role_based", "role_based", "dns_unavailable", None]
    assert got[4]["suggestion"] == "a@propio.com"


@pytest.mark.parametrize("zone", ["America/New_York", "UTC", "Asia/Kathmandu"])
def test_session_zone_has_no_say(spark, zone):
    from pyspark.sql import functions as F

    from postsift.functions.registration import registration_age_days
    from postsift.functions.text import iso_instant
    from postsift.sources.mail_routing import instant

    body = '{"events": [{"eventAction": "registration", "eventDate": "2026-01-01"}]}'
    times = ["2024-03-10T02:30:00.123Z", "2024-11-03T05:30:00.000Z", "2024-11-03T06:30:00.000Z", "1969-12-31T23:59:59.999Z"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.range(1).select(*[iso_instant(instant(t)).alias(t) for t in times]).first()
        assert list(row) == times
        assert spark.range(1).select(registration_age_days(F.lit(body), instant("2026-01-11T00:00:00Z"))).first()[0] == 10
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_verdicts_are_counted_in_the_same_pass(spark):
    """The counters of one run are the report over its rows."""
    from pyspark.sql import Observation

    from catalog import inputs

    folder = "/root/testdata/sf0.001"
    seen = Observation("verdicts")
    rows = ps.validate(inputs.contacts(spark, folder), dns=inputs.dns_answers(spark, folder), as_of=inputs.AS_OF, observe=seen)
    kept = rows.select("validation.status", "validation.sub_status", "validation.recommendation").collect()
    report: dict = {}
    for row in kept:
        report[tuple(row)] = report.get(tuple(row), 0) + 1
    assert ps.verdict_counts(seen) == report
    assert len(report) > 5
