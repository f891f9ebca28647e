"""Joins with hot keys, typo search, lists as tables, registration."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import postsift as ps
from fixtures import plain_distance
from postsift.operators.attach import HotKeys, _marks, attach, attach_settled
from postsift.operators.counters import relative_error
from postsift.operators.membership import attach_listed, off_table, on_table, with_hint
from postsift.operators.once import computed_once
from postsift.operators.registration import (
    domain_ages,
    parent_suffixes,
    registration_requests,
    registry_servers,
)
from postsift.operators.snapshot import create_snapshot, merge_answers, open_snapshot, snapshot_answers
from postsift.operators.typo import deletion_variants, find_typos, find_typos_in, variant_rows
from postsift.sources.lists import (
    BASE_LISTS,
    build_lists,
    clean_values,
    extend_dimension,
    list_dimension,
)
from postsift.sources.mail_routing import DNS_SCHEMA, instant, latest_kept, usable_answers
from postsift.sources.registry import RDAP_SCHEMA, registration_ages, registry_from_bootstrap

# A third of all rows on one key, some rows without a key, some keys without a value.
SKEWED = [(i, None if i % 11 == 0 else "hot" if i % 3 == 0 else f"k{i % 40}") for i in range(900)]


@pytest.fixture
def skewed(spark):
    rows = spark.createDataFrame(SKEWED, "id int, key string")
    values = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(30)], "key string, value int")
    known = {"hot": 1, **{f"k{i}": i for i in range(30)}}
    want = sorted((i, k, known.get(k)) for i, k in SKEWED)
    return rows, values, sorted(want, key=lambda r: r[0])


@pytest.mark.parametrize("hot", [HotKeys(), HotKeys(1, 10_000), HotKeys(100, 5), HotKeys(1, 2), HotKeys(10**9, 1)])
def test_attach_is_a_left_join(skewed, hot):
    rows, values, want = skewed
    got = attach(rows, values, "key", hot_keys=hot).select("id", "key", "value").orderBy("id").collect()
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("bound", [5, 1000])
def test_attach_settled(skewed, bound):
    rows, values, want = skewed
    counts = rows.groupBy("key").count().withColumnRenamed("count", "n")
    weighed = counts.join(values, "key", "inner")
    got = attach_settled(rows, weighed, "key", "n", HotKeys(100, 5), broadcast_rows=bound)
    assert [tuple(r) for r in got.select("id", "key", "value").orderBy("id").collect()] == want


def test_attach_reads_rows_once_and_shares_hot_keys(spark, tmp_path):
    rows = spark.createDataFrame(SKEWED, "id int, key string").repartition(8)
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    values = spark.createDataFrame([("hot", 1, 300), ("k1", 2, 20)], "key string, value int, n int")
    got = attach(rows, values, "key", "n", HotKeys(100, 5))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    joined = attach(rows.withColumn("task", F.spark_partition_id()), values, "key", "n", HotKeys(100, 5))
    assert joined.where("key = 'hot' AND value = 1").count() == sum(k == "hot" for _, k in SKEWED)
    assert joined.count() == len(SKEWED)


def test_wide_values_are_not_broadcast(spark, skewed):
    rows, values, want = skewed
    weighed = rows.groupBy("key").agg(F.count("*").alias("n")).join(values, "key")
    got = attach_settled(rows, weighed, "key", "n", HotKeys(100, 5), broadcast_bytes=50)
    assert [tuple(r) for r in got.select("id", "key", "value").orderBy("id").collect()] == want
    assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString() or "ShuffledHashJoin" in got._jdf.queryExecution().toString()


def test_list_tables_of_any_size(spark, skewed):
    rows, _, _ = skewed
    table = spark.createDataFrame([("hot",), ("k1",), ("k1",), (None,)], "value string")
    on = {r["id"] for r in on_table(rows, "key", table, hot_keys=HotKeys(100, 5)).collect()}
    off = {r["id"] for r in off_table(rows, "key", table, hot_keys=HotKeys(100, 5)).collect()}
    assert on == {i for i, k in SKEWED if k in ("hot", "k1")} and off == {i for i, _ in SKEWED} - on


def test_common_domains_from_a_table(spark):
    domains = spark.createDataFrame([(d,) for d in (*DOMAINS, "miempersa.com.co", "propia.org", "prop1a.org", "pr0p1a.org")], "domain string")
    extra = spark.createDataFrame([(" MiEmpresa.com.co", 1), ("propia.org", 0), ("gmail.com", 2)], "value string, ordinal int")
    common = (*BASE_LISTS.common, "propia.org", "miempresa.com.co")
    want = {d: nearest(d, common, BASE_LISTS.tier1) for (d,) in domains.collect()}
    assert suggestions(find_typos(domains, BASE_LISTS, extra=extra)) == want
    assert want["pr0p1a.org"] == ("propia.org", False)


def test_no_registry_is_not_final(spark):
    rdap = spark.createDataFrame([("a.com", 404, None, None, None)], RDAP_SCHEMA)
    empty = spark.createDataFrame([], "tld string, base_url string")
    assert [tuple(r) for r in domain_ages(rdap, empty, instant("2026-01-11T00:00:00Z")).collect()] == [("a.com", None, False)]


def test_computed_once_is_not_copied_into_filters(spark):
    frame = spark.range(10).select(F.col("id").cast("string").alias("text"))
    done = computed_once(frame, up=F.upper("text")).where("up > '3' AND up < '7'")
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1
    assert [r["up"] for r in done.collect()] == ["4", "5", "6"]


DOMAINS = (
    "gmial.com gmail.com ymail.com une.net.co proton.me ffsoluciones.com alianzaestrategicasas.com miempresa.com.co "
    "universidad.edu.co gmail.co gmal.com hotmal.com yaho.es outlok.es me.co ma.com aol.co gmx.con gmxx.net x.co "
    "live.con icluod.com ahoo.com.mx hotmial.com.co hotmali.co.uk tutanot.com mail.rru ca.com yanxed.com gmixal.com"
).split()


def nearest(domain, common, tier1):
    if domain in common:
        return None, False
    limit = 1 if len(domain) <= 6 else 2
    ranked = sorted((plain_distance(domain, c), i, c) for i, c in enumerate(common))
    distance, _, best = ranked[0]
    return (best, distance == 1 and best in tier1) if distance <= limit else (None, False)


def suggestions(frame):
    return {r["domain"]: (r["typo"]["suggestion"], r["typo"]["high_confidence"]) for r in frame.collect()}


@pytest.mark.parametrize("inline_limit", [1000, 0])
def test_typo_search(spark, inline_limit):
    domains = spark.createDataFrame([(d,) for d in DOMAINS], "domain string")
    want = {d: nearest(d, BASE_LISTS.common, BASE_LISTS.tier1) for d in DOMAINS}
    assert suggestions(find_typos(domains, BASE_LISTS, inline_limit)) == want
    assert want["gmial.com"] == ("gmail.com", True)
    assert want["ffsoluciones.com"] == (None, False)


def test_long_list_search_over_dense_neighbours(spark):
    common = [f"sitio{i}.com" for i in range(0, 300, 2)]
    domains = [f"sitio{i}.com" for i in range(0, 300, 3)] + [f"siito{i}.com" for i in range(0, 300, 7)] + ["a.b", "x"]
    table = spark.createDataFrame([(c, i, False) for i, c in enumerate(common)], "candidate string, ordinal int, tier1 boolean")
    got = suggestions(find_typos_in(spark.createDataFrame([(d,) for d in domains], "domain string"), table))
    assert got == {d: nearest(d, common, ()) for d in domains}


def test_variants_that_no_listed_domain_has_are_not_shuffled(spark):
    common = [f"sitio{i}.com" for i in range(0, 3000, 3)]
    domains = [f"empresa{i}.com.co" for i in range(1000)] + [f"siito{i}.cmo" for i in range(0, 300, 7)]
    table = spark.createDataFrame([(c, i, False) for i, c in enumerate(common)], "candidate string, ordinal int, tier1 boolean")
    unknown = spark.createDataFrame([(d,) for d in domains], "domain string")
    left, right = variant_rows(unknown, table, 2, True)
    every, _ = variant_rows(unknown, table, 2, False)
    met = left.join(right, "variant")
    assert sorted(map(tuple, met.collect())) == sorted(map(tuple, every.join(right, "variant").collect())) and met.count()
    assert left.count() * 10 < every.count()
    assert suggestions(find_typos_in(unknown, table, hinted=True)) == suggestions(find_typos_in(unknown, table))
    # The filter stands below the exchange, so what it drops is never written.
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("ps_bits")


def test_variants_of_the_list_are_not_broadcast(spark):
    # Few rows, as Spark estimates them; exploded they are hundreds of times as many.
    numbers = spark.range(50)
    table = numbers.select(F.format_string("sitio%d.com", "id").alias("candidate"), F.col("id").alias("ordinal"), F.lit(False).alias("tier1"))
    domains = numbers.select(F.format_string("siito%d.cmo", "id").alias("domain"))
    for hinted in (True, False):
        found = find_typos_in(domains, table, hinted=hinted)
        assert suggestions(found) == {f"siito{i}.cmo": (f"sitio{i}.com", False) for i in range(50)}
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [variant" not in plan and plan.count("SortMergeJoin [variant") >= 2


def test_deletion_variants(spark):
    row = spark.range(1).select(
        deletion_variants(F.lit("abc"), F.lit(2)).alias("two"), deletion_variants(F.lit("abc"), F.lit(1)).alias("one")
    ).first()
    assert sorted(set(row["two"])) == ["a", "ab", "abc", "ac", "b", "bc", "c"]
    assert sorted(set(row["one"])) == ["ab", "abc", "ac", "bc"]


def test_lists():
    assert [len(getattr(BASE_LISTS, n)) for n in ("tier1", "free", "common", "disposable", "system", "roles", "junk", "providers")] == [
        9, 36, 41, 24, 10, 27, 28, 11,
    ]
    more = build_lists(domains=" Propio.com , ,gmail.com", roles=["Tesoreria", "info"])
    assert more.common == BASE_LISTS.common + ("propio.com",)
    assert more.free == BASE_LISTS.free and more.tier1 == BASE_LISTS.tier1
    assert more.roles == BASE_LISTS.roles + ("tesoreria",)
    assert clean_values("a, B ,,") == ("a", "b")
    assert build_lists() == BASE_LISTS


def test_list_table(spark):
    added = spark.createDataFrame(
        [("common", " Propio.COM", 0), ("common", "gmail.com", 1), ("common", " ", 2), ("roles", "caja", 0)], "list string, value string, ordinal int"
    )
    table = extend_dimension(list_dimension(spark), added)
    common = [r["value"] for r in table.where("list = 'common'").orderBy("ordinal").collect()]
    assert common == [*BASE_LISTS.common, "propio.com"]
    assert table.where("list = 'roles'").count() == 28


# --- registration -------------------------------------------------------------------

BOOTSTRAP = """{"services": [
  [["com", "NET"], ["https://rdap.com.example", "https://second.example/"]],
  [["uk"], ["https://uk.example/"]], [["co.uk"], ["https://co.uk.example/v1"]],
  [["empty"], []], [["nourl"]], "odd", null, 7, [[], ["https://none.example/"]],
  [["net"], ["https://later.example/"]]]}"""


def registry(spark, body=BOOTSTRAP):
    return registry_from_bootstrap(spark.createDataFrame([(body,)], "body string"))


def test_registry(spark):
    assert {tuple(r) for r in registry(spark).collect()} == {
        ("com", "https://rdap.com.example/"),
        ("net", "https://later.example/"),
        ("uk", "https://uk.example/"),
        ("co.uk", "https://co.uk.example/v1/"),
    }
    for broken in ("{}", "[]", "<html>", '{"services": {}}', '{"services": []}', None):
        assert registry(spark, broken).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_longest_suffix_wins(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("postsift.operators.registration.REGISTRY_BROADCAST_ROWS", 1)
    domains = spark.createDataFrame([(d,) for d in ("x.co.uk", "co.uk", "a.b.com", "com", "y.org")], "domain string")
    got = {tuple(r) for r in registry_servers(domains, registry(spark)).collect()}
    assert got == {
        ("x.co.uk", "https://co.uk.example/v1/"),
        ("co.uk", "https://uk.example/"),
        ("a.b.com", "https://rdap.com.example/"),
    }


def test_parent_suffixes(spark):
    row = spark.range(1).select(parent_suffixes(F.lit("a.b.c")), parent_suffixes(F.lit("c"))).first()
    assert list(row) == [["b.c", "c"], []]


NOW = datetime(2026, 8, 20, 12, 0, 0)
GOOD = '{"events":[{"eventAction":"registration","eventDate":"2026-08-10T12:00:00Z"}]}'
OLDER = '{"events":[{"eventAction":"registration","eventDate":"2026-08-01T12:00:00Z"}]}'


def answers(spark):
    def row(domain, status, body, error=None, hours=None):
        return (domain, status, body, error, None if hours is None else NOW - timedelta(hours=hours))

    return spark.createDataFrame(
        [
            row("good.com", 200, GOOD),
            row("none.com", 200, "{}"),
            row("broken.com", 200, "<html>"),
            row("gone.com", 404, None),
            row("slow.com", 429, GOOD),
            row("down.com", 503, GOOD),
            row("lost.com", None, None, "timeout"),
            row("kept.com", 200, GOOD, hours=23),
            row("kept.com", 429, None, hours=1),
            row("kept.com", 200, OLDER, hours=23.5),
            row("stale.com", 200, GOOD, hours=24),
            row("noserver.org", 200, GOOD),
        ],
        RDAP_SCHEMA,
    )


def test_registration_answers(spark):
    ages = {r["domain"]: (r["age_days"], r["cacheable"]) for r in registration_ages(answers(spark), instant("2026-08-20T12:00:00Z")).collect()}
    assert ages == {
        "good.com": (10, True),
        "none.com": (None, True),
        "broken.com": (None, False),
        "gone.com": (None, True),
        "slow.com": (None, False),
        "down.com": (None, False),
        "lost.com": (None, False),
        "kept.com": (10, True),
        "noserver.org": (10, True),
    }


def test_no_server_means_no_age(spark):
    ages = domain_ages(answers(spark), registry(spark), instant("2026-08-20T12:00:00Z"))
    got = {r["domain"]: (r["age_days"], r["cacheable"]) for r in ages.collect()}
    assert got["noserver.org"] == (None, True)
    assert got["good.com"] == (10, True)


def test_registration_requests(spark):
    domains = spark.createDataFrame([(d,) for d in ("kept.com", "stale.com", "noserver.org", "new.co.uk")], "domain string")
    got = registration_requests(domains, registry(spark), answers(spark), instant("2026-08-20T12:00:00Z"))
    assert {tuple(r) for r in got.collect()} == {
        ("stale.com", "https://rdap.com.example/domain/stale.com"),
        ("new.co.uk", "https://co.uk.example/v1/domain/new.co.uk"),
    }


def test_registration_worklist_asks_for_domains_that_take_mail(spark):
    from fixtures import zone_frame

    people = spark.createDataFrame([("a@gmail.com",), ("b@gmail.com",), ("a@sincorreo.com",), ("a@une.net.co",)], "email string")
    got = ps.registration_worklist(people, registry=registry(spark), dns=zone_frame(spark))
    assert {tuple(r) for r in got.collect()} == {("gmail.com", "https://rdap.com.example/domain/gmail.com")}


# --- snapshot upkeep ---------------------------------------------------------------------


def answers_frame(spark, rows):
    """(domain, exchange, code, time) as answers."""
    return spark.createDataFrame([(d, [(x, 1)] if x else [], c, None, "ENODATA", t) for d, x, c, t in rows], DNS_SCHEMA)


@pytest.fixture
def snapshot(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    create_snapshot(spark, "kept_answers", 8, str(tmp_path / "kept"))
    yield "kept_answers"
    spark.sql("DROP TABLE kept_answers")


def test_merged_snapshot_holds_the_newest_answers(spark, snapshot):
    day = lambda n: datetime(2026, 8, n)
    first = [("a.com", "mx1.a.com", None, day(1)), ("b.com", "mx.b.com", None, day(3)), ("c.com", None, "ESERVFAIL", day(3)), (None, "x.com", None, day(1)), ("now.com", "m.com", None, None)]
    second = [("a.com", "mx2.a.com", None, day(2)), ("b.com", "old.b.com", None, day(2)), ("b.com", None, "ESERVFAIL", day(9)), ("d.com", None, "NXDOMAIN", day(4))]
    assert merge_answers(spark, snapshot, answers_frame(spark, first)) == 2
    for _ in range(2):  # a merge that is repeated changes nothing
        merge_answers(spark, snapshot, answers_frame(spark, second))
        got = {(r["domain"], r["mx"][0]["exchange"] if r["mx"] else r["mx_code"]) for r in snapshot_answers(spark, snapshot).collect()}
        assert got == {("a.com", "mx2.a.com"), ("b.com", "mx.b.com"), ("d.com", "NXDOMAIN")}
    union = latest_kept(answers_frame(spark, first + second).where("domain IS NOT NULL"))
    assert {tuple(r) for r in latest_kept(snapshot_answers(spark, snapshot)).collect()} == {tuple(r) for r in union.collect()}
    assert merge_answers(spark, snapshot, answers_frame(spark, [("e.com", None, "ETIMEOUT", day(1))])) == 0


def test_a_merge_rewrites_touched_buckets_only(spark, snapshot, tmp_path):
    rows = [(f"d{i}.com", f"mx{i}.com", None, datetime(2026, 8, 1)) for i in range(200)]
    assert merge_answers(spark, snapshot, answers_frame(spark, rows)) == 8
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "kept").rglob("*.parquet")}
    before = files()
    assert merge_answers(spark, snapshot, answers_frame(spark, [("d7.com", "new.com", None, datetime(2026, 8, 2))])) == 1
    changed = {f.rsplit("/", 2)[1] for f in files().items() ^ before.items() for f in [f[0]]}
    assert len(changed) == 1
    # A new session finds it where it lies.
    open_snapshot(spark, "kept_again", 8, str(tmp_path / "kept"))
    assert spark.table("kept_again").count() == 200
    spark.sql("DROP TABLE kept_again")


def test_a_join_reads_the_snapshot_without_an_exchange(spark, snapshot):
    rows = [(f"d{i}.com", f"mx{i}.com", None, datetime(2026, 8, 1)) for i in range(50)]
    merge_answers(spark, snapshot, answers_frame(spark, rows))
    usable = usable_answers(snapshot_answers(spark, snapshot), instant("2026-08-01T01:00:00Z"))
    assert "Exchange" not in plan_of(usable)
    domains = spark.range(1000).select(F.concat(F.lit("d"), F.col("id") % 60, F.lit(".com")).alias("domain")).groupBy("domain").count()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "8")  # as many as buckets, so the domains are hashed once
    try:
        joined = domains.join(usable, "domain", "left")
        plan = plan_of(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert joined.where("kept").count() == 50


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# --- providers, counters -----------------------------------------------------------------


def test_providers_of_hosts(spark):
    table = spark.createDataFrame([(0, "google.com", "G", None), (1, ".com", "dot", True), (2, "mx.google.com", "late", False), (3, "google.com", "twice", True), (4, None, "none", None), (5, "x" * 300, "long", None)], "ordinal int, mx_suffix string, name string, catch_all boolean")
    hosts = ["mx.google.com", "google.com", "a.com", "com", ".com", "", None, "a.com", "x.org"]
    frame = spark.createDataFrame([(h, 1) for h in hosts], "mx string, provider int")
    got = {tuple(r) for r in ps.provider_matches(frame, table).collect()}
    assert got == {("mx.google.com", "G", None), ("google.com", "G", None), ("a.com", "dot", True), (".com", "dot", True)}
    assert ps.provider_matches(frame, table.limit(0)).count() == 0
    # One row per host and length that occurs: 4, 10 and 13 characters.
    plan = ps.provider_matches(frame, table)._jdf.queryExecution().optimizedPlan().toString()
    assert "[4,10,13]" in plan


def test_a_long_provider_table_is_not_broadcast(spark, monkeypatch):
    from postsift.operators import providers

    monkeypatch.setattr(providers, "PROVIDER_BROADCAST_ROWS", 1)
    table = spark.createDataFrame([(0, "google.com", "G", None), (1, ".com", "dot", True)], "ordinal int, mx_suffix string, name string, catch_all boolean")
    frame = spark.createDataFrame([("mx.google.com",), ("a.com",), ("b.org",)], "mx string")
    assert {r[:2] for r in map(tuple, ps.provider_matches(frame, table).collect())} == {("mx.google.com", "G"), ("a.com", "dot")}


def test_merged_sketches_count_like_one(spark):
    rows = spark.range(30_000).select((F.col("id") % 30).cast("int").alias("day"), F.concat(F.lit("d"), F.col("id") % 7000).alias("domain"))
    rows = rows.unionByName(spark.createDataFrame([(0, None)], "day int, domain string"))
    sketches = ps.domain_sketches(rows, ["day"])
    whole = ps.merged_counts(sketches).first()
    assert whole["requests"] == 30_000
    assert abs(whole["domains"] - 7000) <= 7000 * relative_error()
    assert 0.02 < relative_error() < 0.03
    weekly = ps.merged_counts(sketches, [F.floor(F.col("day") / 7).alias("week")])
    assert weekly.count() == 5 and weekly.agg(F.sum("requests")).first()[0] == 30_000


# --- hot keys by a sketch, long lists by a map of bits -----------------------------------


def test_sketch_marks_every_hot_key(spark):
    rows = spark.range(60_000).select(F.concat(F.lit("k"), F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, 1).otherwise(F.col("id"))).alias("key"))
    counts = {r["key"]: r["count"] for r in rows.groupBy("key").count().where("count >= 1000").collect()}
    marks = _marks(rows, rows, "key", None, HotKeys(1000, 50))
    got = {r["key"]: r["ps_shares"] for r in marks.collect()}
    assert got.keys() == counts.keys() == {"k0", "k1"}
    assert all(got[k] >= counts[k] // 1000 for k in counts)


def test_left_to_itself_attach_reads_both_sides_once(spark, tmp_path):
    for name, data in (("rows", SKEWED), ("values", [(f"k{i}", i) for i in range(30)])):
        spark.createDataFrame(data, "id int, key string" if name == "rows" else "key string, value int").write.parquet(f"{tmp_path}/{name}")
    rows, values = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("rows", "values"))
    joined = attach(rows, values, "key")
    assert plan_of(joined).count("FileScan parquet") == 2
    known = {f"k{i}": i for i in range(30)}
    assert sorted(map(tuple, joined.select("id", "value").collect()), key=lambda r: r[0]) == [(i, known.get(k)) for i, k in SKEWED]
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert "approx_top_k" in attach(rows, values, "key")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")


def test_hints_miss_no_value(spark):
    values = spark.range(0, 3000, 3).select(F.concat(F.lit("v"), F.col("id")).alias("key"))
    rows = spark.range(3000).select(F.concat(F.lit("v"), F.col("id")).alias("key"), "id").unionByName(spark.createDataFrame([(None, -1)], "key string, id bigint"))
    hinted = {r["id"]: r["ps_maybe"] for r in with_hint(rows, "key", values).collect()}
    assert all(hinted[i] for i in range(0, 3000, 3)) and hinted[-1] is False
    assert sum(hinted.values()) < 1010


def test_only_hits_are_shuffled(spark, tmp_path):
    """A list beyond the broadcast bound: rows without a hit reach the result without an exchange."""
    listed = spark.range(1000).select(F.concat(F.lit("d"), F.col("id"), F.lit(".com")).alias("value"))
    rows = spark.range(20_000).select(F.concat(F.lit("d"), F.col("id"), F.lit(".com")).alias("key"), "id")
    flagged = attach_listed(rows, listed.select(F.col("value").alias("key"), F.lit(True).alias("on")), "key", "on")
    assert flagged.where("on").count() == 1000 and flagged.count() == 20_000
    executed = flagged.where("id >= 0")
    executed.collect()
    text = executed._jdf.queryExecution().executedPlan().toString()
    second = text[text.rindex("BroadcastHashJoin") :]
    assert "SortMergeJoin" not in second and "ShuffledHashJoin" not in second
    assert {r["id"] for r in on_table(rows, "key", listed).collect()} == set(range(1000))
    assert off_table(rows, "key", listed).count() == 19_000
