"""Column functions against literal tables."""

from __future__ import annotations

import random
import string

import pytest
from pyspark.sql import functions as F

import postsift as ps
from fixtures import plain_distance
from postsift.functions import (
    edit_distance,
    edit_distance_within,
    has_valid_syntax,
    iso_instant,
    list_values,
    looks_like_filler,
    match_provider,
    mx_host,
    normalize_email,
    registration_age_days,
    split_email,
    trim_edges,
)
from postsift.sources.lists import BASE_LISTS
from postsift.sources.mail_routing import instant


def column(spark, values, name="v", kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} {kind}")


def evaluate(spark, values, build, kind="string"):
    rows = column(spark, values, kind=kind).select("i", build(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


NORMALIZED = [
    (".juan@gmail.com", "juan@gmail.com", True),
    ("juan.@GMAIL.com", "juan@gmail.com", True),
    ("  Juan@Gmail.com ", "juan@gmail.com", False),
    ("juan@gmail.com", "juan@gmail.com", False),
    ("\t﻿ Ana@X.com　\r\n", "ana@x.com", False),
    ("@x.com", "@x.com", False),
    (".@x.com", "@x.com", True),
    ("..ana..@b@c.com", "ana..@b@c.com", True),
    ("sin-arroba.", "sin-arroba.", False),
    ("ana@b.com\u0085", "ana@b.com\u0085", False),
]


def test_normalize(spark):
    got = evaluate(spark, [r for r, _, _ in NORMALIZED], normalize_email)
    assert [(g["email"], g["changed"]) for g in got] == [(e, c) for _, e, c in NORMALIZED]


def test_normalize_twice_changes_nothing(spark):
    once = evaluate(spark, [r for r, _, _ in NORMALIZED[:5]], lambda c: normalize_email(c)["email"])
    again = evaluate(spark, once, normalize_email)
    assert [(a["email"], a["changed"]) for a in again] == [(o, False) for o in once]


def test_split_is_at_the_last_at(spark):
    got = evaluate(spark, ["a@b.co", "a@b@c.co"], split_email)
    assert [tuple(g) for g in got] == [("a", "b.co"), ("a@b", "c.co")]


VALID = ["a@b.co", "juan.perez@gmail.com", "o'brien@dominio.com", "a+tag@x.com", "a" * 64 + "@gmail.com"]
INVALID = [
    "sin-arroba",
    "a@@b.com",
    "a..b@x.com",
    "@x.com",
    "a@",
    "a@x",
    "a" * 65 + "@gmail.com",
    "a" * 250 + "@gmail.com",
    "a@b.com\u0085",
    "a@b.com\n",
    "a@" + "b" * 250 + ".com",
    "ñ@x.com",
    "a@b.c0",
]


def test_syntax(spark):
    assert evaluate(spark, VALID + INVALID, has_valid_syntax) == [True] * len(VALID) + [False] * len(INVALID)


def test_list_values(spark):
    assert evaluate(spark, [" A.com, ,b.COM ,", ""], list_values) == [["a.com", "b.com"], []]


def test_trim_leaves_inner_space(spark):
    assert evaluate(spark, [" a b ", "   "], trim_edges) == ["a b", ""]


def test_iso_instant_is_utc_in_any_zone(spark):
    def text():
        return spark.range(1).select(iso_instant(instant("2026-08-20T16:38:09.370Z"))).first()[0]

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Bogota"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert text() == "2026-08-20T16:38:09.370Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


# Names that must never be flagged, fillers that always must.
REAL_NAMES = (
    "juan.perez maria.gomez brgtk58 andresfernandez jmrodriguez c.martinez luisitog1228 ana_maria dcastano "
    "jgutierrez88 mvillegas sofia.ramirez kmontoya edwin.ospina yuli.zapata wbecerra nrestrepo jhon.jairo mgarcia "
    "pcardenas fsalazar cmvb jj ana lu contabilidad2024 jorge.andres.lopez maria-jose n.torres laura90 sebas pipe "
    "dahiana yeison brayan estiven deivid nikolle maryuri jsanchez rgiraldo licitaciones javiergarciay11 "
    "director.licitaciones"
).split()
FILLERS = (
    "xxxxxyyyy xxxxxx aaaaaa qwerty123 asdfghjk zxcvbnm1 111111 qqqqqq abababab xyxyxyxy wwwwww poiuytre lkjhgfds 12345678"
).split()


def test_filler(spark):
    names = REAL_NAMES + ["ab", "xxx", "aaaa", ""] + FILLERS + ["x.x.x_y-y+y", "bcdfghj", "abcccc.d", "QWERT"]
    expected = [False] * (len(REAL_NAMES) + 4) + [True] * (len(FILLERS) + 4)
    assert evaluate(spark, names, looks_like_filler) == expected


def test_filler_is_quick_on_long_runs(spark):
    long = ["a" * 60 + "bc", "a" * 5000 + "b", "ab" * 2500 + "c", "a" * 40 + "@" + "b" * 40 + "."]
    assert evaluate(spark, long, looks_like_filler) == [True, True, False, True]
    distinct = ["abcab", "ababa", "a-b.a_b+a", "aaaaa", "abcdo"]
    assert evaluate(spark, distinct, looks_like_filler) == [False, True, True, True, False]


KNOWN_DISTANCES = [
    ("gmial.com", "gmail.com", 1),
    ("hotmial.com", "hotmail.com", 1),
    ("gmail.com", "gmail.com", 0),
    ("gmail.comz", "gmail.com", 1),
    ("gmail.co", "gmail.com", 1),
    ("ymail.com", "gmail.com", 1),
    ("", "", 0),
    ("abc", "", 3),
    ("", "abc", 3),
    ("ca", "abc", 3),
    ("gmixal.com", "gmail.com", 3),
    ("abcd", "badc", 2),
]


def distances(spark, pairs, build):
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    rows = frame.select("i", build(F.col("a"), F.col("b")).alias("d")).orderBy("i").collect()
    return [r["d"] for r in rows]


def test_known_distances(spark):
    assert distances(spark, [(a, b) for a, b, _ in KNOWN_DISTANCES], edit_distance) == [d for _, _, d in KNOWN_DISTANCES]


def random_pairs(count, seed):
    rng, pairs = random.Random(seed), []
    for _ in range(count):
        a = [rng.choice("abc.") for _ in range(rng.randint(0, 9))]
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            move, at = rng.random(), rng.randrange(len(b) + 1)
            if move < 0.5 and at + 1 < len(b):
                b[at], b[at + 1] = b[at + 1], b[at]
            elif move < 0.7:
                b.insert(at, rng.choice("abcd"))
            elif at < len(b):
                b[at : at + 1] = [] if move < 0.85 else [rng.choice("abcd")]
        pairs.append(("".join(a), "".join(b)))
    return pairs


def test_distance_equals_the_plain_table(spark):
    pairs = random_pairs(1500, seed=11)
    assert distances(spark, pairs, edit_distance) == [plain_distance(a, b) for a, b in pairs]


@pytest.mark.parametrize("limit", [1, 2])
def test_bounded_distance_equals_the_plain_table(spark, limit):
    pairs = random_pairs(2500, seed=limit)
    want = [d if d <= limit else None for d in (plain_distance(a, b) for a, b in pairs)]
    assert distances(spark, pairs, lambda a, b: edit_distance_within(a, b, F.lit(limit))) == want
    assert {d for d in want} >= {0, 1, None}


def test_mx_host(spark):
    assert evaluate(spark, ["Mail.X.com.", ".", "", "a..", "b"], mx_host) == ["mail.x.com", "", "", "a.", "b"]


def test_providers(spark):
    hosts = [
        "hotmail-com.olc.protection.outlook.com",
        "x.outlook.com",
        "notgoogle.com",
        "mx.zoho.com",
        "mail.example.org",
        None,
        "mxs.mail.ru",
        "mta7.am0.yahoodns.net",
    ]
    got = evaluate(spark, hosts, lambda c: match_provider(c, BASE_LISTS))
    assert [tuple(g) for g in got] == [
        ("microsoft", True),
        ("microsoft", True),
        ("google", False),
        ("zoho", None),
        (None, None),
        (None, None),
        ("mailru", None),
        ("yahoo", False),
    ]


AGES = [
    ('{"events":[{"eventAction":"registration","eventDate":"2026-08-19T16:38:09.370Z"}]}', 1),
    ('{"events":[{"eventAction":"registration","eventDate":"2026-08-20T16:38:09.371Z"}]}', -1),
    ('{"events":[{"eventAction":"expiration","eventDate":"2020-01-01T00:00:00Z"}]}', None),
    ('{"events":[{"eventAction":"registration"},{"eventAction":"registration","eventDate":"2020-01-01T00:00:00Z"}]}', None),
    ('{"events":[{"eventAction":"registration","eventDate":"soon"}]}', None),
    ('{"events":[null,7,{"eventAction":"registration","eventDate":"1996-03-27T05:00:00Z"}]}', 11103),
    ('{"events":{}}', None),
    ("[]", None),
    ("<html>", None),
    (None, None),
    ('{"events":[{"eventAction":"registration","eventDate":null}]}', None),
    ('{"events":[{"eventAction":"registration","eventDate":"2026-08-20T10:00:00-05:00"}]}', 0),
]


def test_registration_age(spark):
    now = instant("2026-08-20T16:38:09.370Z")
    got = evaluate(spark, [b for b, _ in AGES], lambda c: registration_age_days(c, now))
    assert got == [a for _, a in AGES]


def test_syntax_alphabet_matches_ascii_classes(spark):
    accepted = set(string.ascii_letters + string.digits + "!#$%&'*+/=?^_`{|}~.-")
    letters = [chr(c) for c in range(33, 127) if chr(c) != "@"]
    got = evaluate(spark, [f"{c}x@b.co" for c in letters], has_valid_syntax)
    assert [c for c, ok in zip(letters, got) if ok] == [c for c in letters if c in accepted]


def test_sql_functions_are_the_columns(spark):
    ps.register_sql_functions(spark)
    texts = [None, "", " ", "  A.B@C.com\t", ".x.@y.org", "no at", "a@b@c.de", "a..b@c.de", "o'brien@x.com", "\u00a0\ufeffZ@z.io", "x" * 70 + "@y.com", "a@b.c\n"]
    accounts = ["asdfg", "aaaa1", "xkcdqwrt", "ok", "abab.ab", "brgtk58", "qwerty", "a\\1111", None, "12345", "anna"]
    frame = spark.createDataFrame([(t, a) for t in texts for a in accounts], "raw string, account string")
    normal = ps.normalize_email(F.col("raw"))
    columns = [normal["email"], normal["changed"], ps.has_valid_syntax(F.col("raw")), ps.split_email(F.col("raw"))["account"], ps.split_email(F.col("raw"))["domain"], ps.looks_like_filler(F.col("account"))]
    want = [tuple(r) for r in frame.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).collect()]
    got = spark.sql(
        "SELECT email_normalized(raw), email_changed(raw), email_has_valid_syntax(raw), email_account(raw), email_domain(raw), account_is_filler(account) FROM {t}", t=frame
    ).collect()
    assert [tuple(r) for r in got] == want
    assert spark.sql("SELECT recommendation_is_sendable('confirm'), recommendation_is_sendable('reject')").first() == (True, False)
