"""The catalog: name -> (Spark query, SQL that checks it or None)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import postsift as ps
from catalog import inputs
from catalog.inputs import AS_OF, AS_OF_SQL, CONTACTS_SQL, DNS_CTES
from catalog.oracle import (
    ALIGNMENT_CTES,
    filler_sql,
    in_list,
    parsed_ctes,
    provider_sql,
    typo_ctes,
    validation_ctes,
)
from postsift.functions import list_values, match_provider
from postsift.functions.constants import text_array
from postsift.functions.registration import registration_age_days
from postsift.operators.counters import relative_error
from postsift.operators.membership import off_table, on_table
from postsift.operators.once import computed_once
from postsift.operators.registration import registry_servers
from postsift.operators.settle import checkpoint_folder, settle
from postsift.operators.typo import find_typos_in
from postsift.sources import lists
from postsift.sources.lists import extend_dimension, list_dimension, provider_dimension
from postsift.sources.mail_routing import domain_mail_status, instant, latest_kept
from postsift.sources.registry import registry_from_bootstrap
from postsift.streaming import start_refresh_requests, start_validation

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    spark: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def entry(name: str, sql: str | None):
    def register(query: Query) -> Query:
        CATALOG[name] = Entry(query, sql)
        return query

    return register


FIELDS = (
    "email", "normalized", "send_to", "status", "sub_status", "recommendation", "sendable",
    "suggestion", "account", "domain", "free_email", "role_based", "disposable",
    "normalization_applied", "mx_found", "mx_record", "smtp_provider", "catch_all", "cached",
)
VERDICT = ("status", "sub_status", "recommendation", "suggestion")


def fields(validated: DataFrame, *names: str) -> DataFrame:
    return validated.select("input_seq", *[F.col(f"validation.{n}") for n in names])


def validated(spark: SparkSession, sf_dir: str, **arguments) -> DataFrame:
    dns = inputs.dns_answers(spark, sf_dir)
    arguments.setdefault("settled", checkpoint_folder(spark) is not None)
    return ps.validate(inputs.contacts(spark, sf_dir), dns=dns, as_of=AS_OF, order_by="input_seq", **arguments)


def check(*names: str, where: str = "TRUE", **options) -> str:
    return f"WITH {validation_ctes(CONTACTS_SQL, **options)} SELECT input_seq, {', '.join(names)} FROM validated WHERE {where}"


# --- scalar functions over all contacts ---------------------------------------------


@entry("normalize_split", f"WITH {parsed_ctes(CONTACTS_SQL)} SELECT input_seq, normalized, changed, account, domain FROM parsed WHERE email IS NOT NULL")
def normalize_split(spark, sf_dir):
    tidy = inputs.contacts(spark, sf_dir).where("email IS NOT NULL").select("input_seq", ps.normalize_email(F.col("email")).alias("tidy"))
    halves = tidy.select("input_seq", "tidy.*", ps.split_email(F.col("tidy.email")).alias("halves"))
    return halves.select("input_seq", F.col("email").alias("normalized"), "changed", "halves.*")


@entry("syntax_gate", f"WITH {parsed_ctes(CONTACTS_SQL)} SELECT input_seq, ok FROM checked")
def syntax_gate(spark, sf_dir):
    address = ps.normalize_email(F.col("email"))["email"]
    return inputs.contacts(spark, sf_dir).select("input_seq", ps.has_valid_syntax(address).alias("ok"))


@entry("filler_flags", f"WITH {parsed_ctes(CONTACTS_SQL)} SELECT input_seq, account, {filler_sql('account')} AS filler FROM checked WHERE ok")
def filler_flags(spark, sf_dir):
    rows = parsed(inputs.contacts(spark, sf_dir))
    return rows.select("input_seq", "account", ps.looks_like_filler(F.col("account")).alias("filler"))


def parsed(contacts: DataFrame) -> DataFrame:
    """Account and domain of the contacts that pass the syntax gate."""
    tidy = contacts.select("input_seq", ps.normalize_email(F.col("email"))["email"].alias("address"))
    halves = ps.split_email(F.col("address"))
    split = computed_once(
        tidy, account=halves["account"], domain=halves["domain"], ok=ps.has_valid_syntax(F.col("address"))
    )
    return split.where("ok").select("input_seq", "account", "domain")


# Pairs from `part`: the name against itself with a swap, a loss, an addition, two edits,
# or against the type of the part.
PAIRS_SQL = """
    SELECT p_partkey, p_name AS a,
      CASE p_partkey % 7
        WHEN 0 THEN p_name
        WHEN 1 THEN substring(p_name, 1, spot) || substring(p_name, spot + 2, 1) || substring(p_name, spot + 1, 1) || substring(p_name, spot + 3)
        WHEN 2 THEN substring(p_name, 1, spot) || substring(p_name, spot + 2)
        WHEN 3 THEN substring(p_name, 1, spot) || 'x' || substring(p_name, spot + 1)
        WHEN 4 THEN substring(p_name, 1, spot) || substring(p_name, spot + 2, 1) || 'x' || substring(p_name, spot + 1, 1) || substring(p_name, spot + 3)
        WHEN 5 THEN lower(p_type)
        ELSE '' END AS b
    FROM (SELECT *, CAST(p_partkey % (length(p_name) - 2) AS INT) AS spot FROM part) spotted
"""


@entry(
    "edit_distance",
    f"WITH RECURSIVE pairs AS ({PAIRS_SQL}), {ALIGNMENT_CTES} SELECT p_partkey, p.a, p.b, distance FROM pairs p JOIN distances d ON p.a = d.a AND p.b = d.b",
)
def edit_distance(spark, sf_dir):
    pairs = inputs.run(spark, sf_dir, PAIRS_SQL, "part")
    return pairs.withColumn("distance", ps.edit_distance(F.col("a"), F.col("b")).cast("bigint"))


# --- list membership, typos ---------------------------------------------------------


@entry(
    "list_flags",
    f"""WITH {parsed_ctes(CONTACTS_SQL)}
    SELECT input_seq, domain IN {in_list(lists.FREE)} AS free_email, domain IN {in_list(lists.DISPOSABLE)} AS disposable,
           account IN {in_list(lists.SHARED_MAILBOXES + lists.SYSTEM_MAILBOXES)} AS role_based,
           account IN {in_list(lists.JUNK)} AS junk
    FROM checked WHERE ok""",
)
def list_flags(spark, sf_dir):
    rows, known = parsed(inputs.contacts(spark, sf_dir)), ps.BASE_LISTS
    account, domain = F.col("account"), F.col("domain")
    return rows.select(
        "input_seq",
        domain.isin(*known.free).alias("free_email"),
        domain.isin(*known.disposable).alias("disposable"),
        account.isin(*known.roles, *known.system).alias("role_based"),
        account.isin(*known.junk).alias("junk"),
    )


@entry(
    "on_disposable_list",
    f"WITH {parsed_ctes(CONTACTS_SQL)} SELECT input_seq, domain FROM checked WHERE ok AND domain IN {in_list(lists.DISPOSABLE)}",
)
def on_disposable_list(spark, sf_dir):
    table = list_dimension(spark).where("list = 'disposable'")
    return on_table(parsed(inputs.contacts(spark, sf_dir)), "domain", table).select("input_seq", "domain")


@entry(
    "off_role_lists",
    f"WITH {parsed_ctes(CONTACTS_SQL)} SELECT input_seq, account FROM checked WHERE ok AND account NOT IN {in_list(lists.SHARED_MAILBOXES + lists.SYSTEM_MAILBOXES)}",
)
def off_role_lists(spark, sf_dir):
    table = list_dimension(spark).where("list IN ('roles', 'system')")
    return off_table(parsed(inputs.contacts(spark, sf_dir)), "account", table).select("input_seq", "account")


SQL_DOMAINS = f"SELECT DISTINCT domain FROM checked WHERE ok"
COMMON = lists.FREE + lists.LOCAL_ISPS


@entry(
    "typo_suggest",
    f"""WITH {parsed_ctes(CONTACTS_SQL)}, {typo_ctes(SQL_DOMAINS, COMMON)}
    SELECT d.domain, suggestion, coalesce(sure, FALSE) AS high_confidence FROM ({SQL_DOMAINS}) d LEFT JOIN typos t ON d.domain = t.domain""",
)
def typo_suggest(spark, sf_dir):
    domains = parsed(inputs.contacts(spark, sf_dir)).select("domain").distinct()
    return ps.find_typos(domains, ps.BASE_LISTS).select("domain", "typo.*")


# A long list of common domains: the base list and the domains of all customers.
# Look-alikes are the domains of all customers with two neighbouring letters swapped.
LONG_LIST_SQL = "SELECT c_custkey, 'cliente' || CAST(c_custkey AS STRING) || '.com.co' AS domain FROM customer"
LOOK_ALIKE_SQL = "SELECT DISTINCT 'cleinte' || CAST(c_custkey AS STRING) || '.com.co' AS domain FROM customer"


@entry(
    "typo_long_list",
    f"""WITH listed AS (
      SELECT ordinal, value FROM (VALUES {", ".join(f"({i}, '{v}')" for i, v in enumerate(COMMON))}) AS t(ordinal, value)
      UNION ALL SELECT c_custkey + 1000, domain FROM ({LONG_LIST_SQL}) l),
    near AS (
      SELECT d.domain, ordinal, value, damerau_levenshtein(d.domain, value) AS distance
      FROM ({LOOK_ALIKE_SQL}) d, listed
      WHERE abs(length(d.domain) - length(value)) <= 2 AND levenshtein(d.domain, value) <= 4)
    SELECT domain, arg_min(value, (distance, ordinal)) AS suggestion,
           min(distance) = 1 AND arg_min(value, (distance, ordinal)) IN {in_list(lists.TIER1)} AS high_confidence
    FROM near WHERE distance <= 2 GROUP BY domain""",
)
def typo_long_list(spark, sf_dir):
    base = spark.createDataFrame([(v, i, v in lists.TIER1) for i, v in enumerate(COMMON)], "candidate string, ordinal bigint, tier1 boolean")
    grown = inputs.run(spark, sf_dir, LONG_LIST_SQL, "customer").select(
        F.col("domain").alias("candidate"), (F.col("c_custkey") + 1000).alias("ordinal"), F.lit(False).alias("tier1")
    )
    domains = inputs.run(spark, sf_dir, LOOK_ALIKE_SQL, "customer")
    return find_typos_in(domains, base.unionByName(grown), settled=checkpoint_folder(spark) is not None).select("domain", "typo.*")


# More domains than are listed: suppliers' domains, met by those of the customers.
SUPPLIER_LIST_SQL = "SELECT s_suppkey, 'proveedor' || CAST(s_suppkey AS STRING) || '.com.co' AS domain FROM supplier"
CUSTOMER_DOMAIN_SQL = """
    SELECT DISTINCT CASE WHEN c_custkey % 3 = 0 THEN 'provedor' ELSE 'proveedor' END || CAST(c_custkey AS STRING)
           || CASE WHEN c_custkey % 2 = 0 THEN '.com.cp' ELSE '.com.co' END AS domain FROM customer
"""


@entry(
    "typo_many_domains",
    f"""WITH listed AS ({SUPPLIER_LIST_SQL}), domains AS ({CUSTOMER_DOMAIN_SQL}),
    near AS (
      SELECT d.domain, s_suppkey, l.domain AS value, damerau_levenshtein(d.domain, l.domain) AS distance
      FROM domains d, listed l
      WHERE abs(length(d.domain) - length(l.domain)) <= 2 AND levenshtein(d.domain, l.domain) <= 4
        AND d.domain NOT IN (SELECT domain FROM listed)),
    best AS (SELECT domain, arg_min(value, (distance, s_suppkey)) AS suggestion FROM near WHERE distance <= 2 GROUP BY domain)
    SELECT d.domain, b.suggestion, b.suggestion IS NOT NULL AND FALSE AS high_confidence FROM domains d LEFT JOIN best b USING (domain)""",
)
def typo_many_domains(spark, sf_dir):
    listed = inputs.run(spark, sf_dir, SUPPLIER_LIST_SQL, "supplier").select(
        F.col("domain").alias("candidate"), F.col("s_suppkey").alias("ordinal"), F.lit(False).alias("tier1")
    )
    domains = inputs.run(spark, sf_dir, CUSTOMER_DOMAIN_SQL, "customer")
    found = find_typos_in(domains, listed, settled=checkpoint_folder(spark) is not None, hinted=True)
    return found.select("domain", F.col("typo.suggestion"), F.coalesce("typo.high_confidence", F.lit(False)).alias("high_confidence"))


# Extensions from the tables: the names of parts as roles, in untidy text.
EXTENSION_SQL = """
    SELECT 'roles' AS list, ' ' || upper(p_name) || ' , ' || p_name || ',,info' AS entries, p_partkey AS seq FROM part
"""


@entry(
    "list_extension",
    f"""WITH base AS (SELECT list, value, ordinal FROM (VALUES {", ".join(f"('{n}', '{v}', {i})" for n in lists.LIST_NAMES for i, v in enumerate(getattr(ps.BASE_LISTS, n)))}) AS t(list, value, ordinal)),
    added AS (SELECT list, lower(trim(unnest(string_split(entries, ',')))) AS value, seq FROM ({EXTENSION_SQL}) e),
    offsets AS (SELECT list, max(ordinal) + 1 AS start FROM base GROUP BY list),
    everything AS (SELECT list, value, ordinal FROM base
      UNION ALL SELECT a.list, a.value, a.seq + start FROM added a JOIN offsets o ON a.list = o.list WHERE a.value <> '')
    SELECT list, value, min(ordinal) AS ordinal FROM everything GROUP BY list, value""",
)
def list_extension(spark, sf_dir):
    entries = inputs.run(spark, sf_dir, EXTENSION_SQL, "part")
    added = entries.select("list", F.explode(list_values(F.col("entries"))).alias("value"), F.col("seq").alias("ordinal"))
    return extend_dimension(list_dimension(spark), added)


# --- mail routing -------------------------------------------------------------------


@entry("mail_status", f"WITH {DNS_CTES} SELECT domain, fetched_at, mx, accepts_mail, null_mx, domain_exists, resolver_failed FROM statuses")
def mail_status(spark, sf_dir):
    return domain_mail_status(inputs.dns_answers(spark, sf_dir))


@entry(
    "provider_match",
    f"WITH {DNS_CTES} SELECT domain, fetched_at, mx, {provider_sql('mx', 'name')} AS provider, CAST({provider_sql('mx', 'catch_all')} AS BOOLEAN) AS catch_all FROM statuses",
)
def provider_match(spark, sf_dir):
    status = domain_mail_status(inputs.dns_answers(spark, sf_dir))
    matched = match_provider(F.col("mx"), ps.BASE_LISTS)
    return status.select("domain", "fetched_at", "mx", matched["name"].alias("provider"), matched["catch_all"].alias("catch_all"))


@entry(
    "provider_join",
    f"WITH {DNS_CTES} SELECT domain, fetched_at, {provider_sql('mx', 'name')} AS provider FROM statuses WHERE {provider_sql('mx', 'name')} IS NOT NULL",
)
def provider_join(spark, sf_dir):
    """The same match against the provider table: equi-join on the ends of the host."""
    status = domain_mail_status(inputs.dns_answers(spark, sf_dir)).where("mx IS NOT NULL")
    return status.join(ps.provider_matches(status, provider_dimension(spark)), "mx").select("domain", "fetched_at", "provider")


@entry(
    "snapshot_latest",
    f"""WITH {DNS_CTES} SELECT domain, fetched_at, mx, accepts_mail, null_mx, domain_exists, resolver_failed FROM (
      SELECT *, row_number() OVER (PARTITION BY domain ORDER BY fetched_at DESC) AS n FROM statuses
      WHERE fetched_at IS NOT NULL AND NOT resolver_failed) s WHERE n = 1""",
)
def snapshot_latest(spark, sf_dir):
    return latest_kept(inputs.dns_answers(spark, sf_dir))


def kept_snapshot(spark: SparkSession, sf_dir: str, merges: int = 2) -> DataFrame:
    """The answers of the tables, merged into a new snapshot in several steps; by hash, so old ones come late too."""
    name = f"kept_{uuid.uuid4().hex}"
    ps.create_snapshot(spark, name, 8, f"{new_folder(spark)}/{name}")
    answers = inputs.dns_answers(spark, sf_dir)
    for k in range(merges):
        ps.merge_answers(spark, name, answers.where(F.pmod(F.xxhash64("domain", "fetched_at"), F.lit(merges)) == k))
    return ps.snapshot_answers(spark, name)


@entry("snapshot_merged", CATALOG["snapshot_latest"].sql)
def snapshot_merged(spark, sf_dir):
    """A snapshot that was merged twice holds the latest answers of all."""
    return latest_kept(kept_snapshot(spark, sf_dir))


KEPT_ONLY = DNS_CTES.replace("WHERE fetched_at IS NULL\n           OR (", "WHERE (")


@entry("verdicts_from_snapshot", f"WITH {validation_ctes(CONTACTS_SQL, dns_ctes=KEPT_ONLY)} SELECT input_seq, status, sub_status, recommendation, cached FROM validated")
def verdicts_from_snapshot(spark, sf_dir):
    """Contacts decided by the kept answers alone."""
    rows = ps.validate(inputs.contacts(spark, sf_dir), dns=kept_snapshot(spark, sf_dir), as_of=AS_OF, order_by="input_seq")
    return fields(rows, "status", "sub_status", "recommendation", "cached")


ASKING = f"""{validation_ctes(CONTACTS_SQL)},
    asking AS (SELECT domain, count(*) AS contacts FROM decided WHERE asks GROUP BY domain)"""


@entry(
    "lookup_worklist",
    f"WITH {ASKING} SELECT domain, contacts FROM asking WHERE domain NOT IN (SELECT domain FROM usable WHERE kept)",
)
def lookup_worklist(spark, sf_dir):
    return ps.lookup_worklist(inputs.contacts(spark, sf_dir), dns=inputs.dns_answers(spark, sf_dir), as_of=AS_OF)


@entry(
    "lookup_counts",
    f"""WITH {ASKING} SELECT
      CAST(sum(CASE WHEN u.kept THEN 0 WHEN coalesce(u.resolver_failed, TRUE) THEN contacts ELSE 1 END) AS BIGINT) AS lookups,
      count(*) FILTER (WHERE NOT coalesce(u.resolver_failed, TRUE)) AS entries
    FROM asking a LEFT JOIN usable u ON a.domain = u.domain""",
)
def lookup_counts(spark, sf_dir):
    return ps.lookup_counts(inputs.contacts(spark, sf_dir), dns=inputs.dns_answers(spark, sf_dir), as_of=AS_OF)


# --- the whole cascade --------------------------------------------------------------


@entry("validation", check(*FIELDS))
def validation(spark, sf_dir):
    return fields(validated(spark, sf_dir), *FIELDS)


@entry("verdicts", check(*VERDICT))
def verdicts(spark, sf_dir):
    return fields(validated(spark, sf_dir), *VERDICT)


@entry("verdicts_hot_domains", check(*VERDICT, "mx_record", "cached"))
def verdicts_hot_domains(spark, sf_dir):
    """The same, lazily and with the hot-domain way of the join in use at this size."""
    rows = validated(spark, sf_dir, settled=False, hot_keys=ps.HotKeys(min_rows=100, max_keys=5))
    return fields(rows, *VERDICT, "mx_record", "cached")


STRICT = ps.Options(
    role_is_sendable=False,
    catch_all_is_sendable=False,
    flag_suspicious_patterns=False,
    extra_domains="Gmail.co , empresa.com.co",
    extra_disposable=("soloa.com",),
    extra_roles="tesoreria, ",
)
STRICT_SQL = dict(
    role_is_sendable=False,
    catch_all_is_sendable=False,
    flag_suspicious=False,
    extra_domains=("gmail.co", "empresa.com.co"),
    extra_disposable=("soloa.com",),
    extra_roles=("tesoreria",),
)


@entry("verdicts_many_domains", check(*VERDICT, "mx_record", "cached"))
def verdicts_many_domains(spark, sf_dir):
    """The same, settled where the session can, with a domain table that counts as too large to broadcast."""
    rows = validated(spark, sf_dir, broadcast_rows=10, hot_keys=ps.HotKeys(min_rows=100, max_keys=5))
    return fields(rows, *VERDICT, "mx_record", "cached")


@entry("verdicts_strict", check(*VERDICT, "role_based", "disposable", **STRICT_SQL))
def verdicts_strict(spark, sf_dir):
    return fields(validated(spark, sf_dir, options=STRICT), *VERDICT, "role_based", "disposable")


VETO = ps.Rule("veto", cuts=lambda v: [ps.Cut(F.length(v.account) > 11, "vetoed", "do_not_mail", "manual_review")])


@entry("verdicts_custom_rule", check(*VERDICT, "cached", early_hook="WHEN length(account) > 11 THEN 'vetoed'"))
def verdicts_custom_rule(spark, sf_dir):
    rules = ps.insert_rule(VETO, before="domain-typo")
    return fields(validated(spark, sf_dir, rules=rules), *VERDICT, "cached")


@entry("cached_flag", check("domain", "cached", where="domain IS NOT NULL"))
def cached_flag(spark, sf_dir):
    return fields(validated(spark, sf_dir).where("validation.domain IS NOT NULL"), "domain", "cached")


@entry(
    "dns_down",
    f"""WITH {validation_ctes(CONTACTS_SQL, dns_ctes="usable AS (SELECT 'x' AS domain, CAST(NULL AS STRING) AS mx, FALSE AS kept, TRUE AS resolver_failed, FALSE AS null_mx, FALSE AS accepts_mail WHERE FALSE)")}
    SELECT input_seq, status, sub_status, recommendation, suggestion FROM validated""",
)
def dns_down(spark, sf_dir):
    """No answers at all: nobody is lost for it."""
    return fields(ps.validate(inputs.contacts(spark, sf_dir), as_of=AS_OF), *VERDICT)


@entry("route_sendable", check("send_to", "recommendation", where="sendable"))
def route_sendable(spark, sf_dir):
    return fields(ps.sendable(validated(spark, sf_dir)), "send_to", "recommendation")


@entry("route_discarded", check("email", "sub_status", "suggestion", where="NOT sendable"))
def route_discarded(spark, sf_dir):
    return fields(ps.discarded(validated(spark, sf_dir)), "email", "sub_status", "suggestion")


@entry(
    "output_fields",
    f"""WITH {validation_ctes(CONTACTS_SQL)} SELECT v.input_seq, s.priority, v.normalized AS email, v.email AS raw, v.status
    FROM validated v JOIN source s ON v.input_seq = s.input_seq""",
)
def output_fields(spark, sf_dir):
    """Other fields pass through; the top-level `email` is the normalised address."""
    return validated(spark, sf_dir).select("input_seq", "priority", "email", F.col("validation.email").alias("raw"), "validation.status")


@entry(
    "field_not_found",
    f"""SELECT input_seq, CAST(NULL AS STRING) AS email, 'field_not_found' AS sub_status, 'correo' AS field_searched
    FROM ({CONTACTS_SQL}) c""",
)
def field_not_found(spark, sf_dir):
    rows = ps.validate(inputs.contacts(spark, sf_dir).drop("email"), "correo", as_of=AS_OF)
    return rows.select("input_seq", "email", "validation.sub_status", "validation.field_searched")


@entry(
    "checked_at",
    f"""SELECT input_seq, '2024-06-01T12:00:00.000Z' AS checked_at FROM ({CONTACTS_SQL}) c""",
)
def checked_at(spark, sf_dir):
    return fields(validated(spark, sf_dir), "checked_at")


@entry(
    "payload_names",
    f"""WITH {validation_ctes(CONTACTS_SQL)} SELECT v.input_seq, s.priority AS first, s.owner AS dns, s.priority AS typo,
      s.owner AS rows, s.owner AS age_days, s.priority AS sendable, v.status, v.cached FROM validated v JOIN source s ON v.input_seq = s.input_seq""",
)
def payload_names(spark, sf_dir):
    """Contact columns may have any name but those starting with ps_."""
    named = {"first": "priority", "dns": "owner", "typo": "priority", "rows": "owner", "age_days": "owner", "sendable": "priority"}
    contacts = inputs.contacts(spark, sf_dir).select("input_seq", F.col("email").alias("Email"), *[F.col(c).alias(n) for n, c in named.items()])
    rows = ps.validate(contacts, "Email", dns=inputs.dns_answers(spark, sf_dir), as_of=AS_OF, order_by="input_seq")
    return rows.select("input_seq", *named, "validation.status", "validation.cached")


@entry("output_without_fields", f"WITH {validation_ctes(CONTACTS_SQL)} SELECT normalized AS email, status, sub_status FROM validated")
def output_without_fields(spark, sf_dir):
    return validated(spark, sf_dir, keep_fields=False).select("*").select("email", "validation.status", "validation.sub_status")


@entry("literal_address", f"SELECT input_seq, 'ana@gmail.com' AS email, 'dns_unavailable' AS sub_status FROM ({CONTACTS_SQL}) c")
def literal_address(spark, sf_dir):
    """The address is the same text for every row."""
    rows = ps.validate(inputs.contacts(spark, sf_dir).drop("email"), "Ana@Gmail.com", as_of=AS_OF)
    return rows.select("input_seq", "email", "validation.sub_status")


@entry(
    "expression_address",
    f"""WITH {validation_ctes(f"SELECT c_custkey AS input_seq, 'ana.' || lower(c_mktsegment) || '@cliente' || CAST(c_custkey AS STRING) || '.com.co' AS email FROM customer")}
    SELECT input_seq, normalized AS email, status, sub_status FROM validated""",
)
def expression_address(spark, sf_dir):
    """The address is an expression over other columns."""
    customers = inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("input_seq"), "c_mktsegment")
    address = F.concat(F.lit("ana."), F.lower("c_mktsegment"), F.lit("@cliente"), F.col("input_seq").cast("string"), F.lit(".com.co"))
    rows = ps.validate(customers, address, dns=inputs.dns_answers(spark, sf_dir), as_of=AS_OF)
    return rows.select("input_seq", "email", "validation.status", "validation.sub_status")


@entry(
    "replaced_rules",
    f"""WITH {parsed_ctes(CONTACTS_SQL)} SELECT input_seq,
      CASE WHEN email IS NULL THEN 'field_not_found' WHEN f = '' THEN 'empty' WHEN NOT ok THEN 'failed_syntax_check'
           WHEN length(domain) > 15 THEN 'long_domain' END AS sub_status,
      CASE WHEN ok AND f <> '' AND length(domain) <= 15 THEN 'accept' WHEN ok AND f <> '' THEN 'manual_review' ELSE 'reject' END AS recommendation
    FROM checked""",
)
def replaced_rules(spark, sf_dir):
    """A rule list of one's own in place of the default."""
    only = ps.Rule("length", cuts=lambda v: [ps.Cut(F.length(v.domain) > 15, "long_domain", "do_not_mail", "manual_review")])
    return fields(validated(spark, sf_dir, rules=[only]), "sub_status", "recommendation")


MIXED = ps.Rule(
    "mixed",
    cuts=lambda v: [ps.Cut(v.looked_up["typo.suggestion"].isNotNull() & (F.length(v.account) > 11), "mixed", "do_not_mail", "manual_review")],
    lookups=frozenset({"typo"}),
)


@entry(
    "verdicts_mixed_rule",
    f"""WITH {validation_ctes(CONTACTS_SQL)} SELECT input_seq,
      CASE WHEN early IS NULL AND NOT sure AND suggestion IS NOT NULL AND length(account) > 11 THEN 'mixed' ELSE sub_status END AS sub_status
    FROM decided""",
)
def verdicts_mixed_rule(spark, sf_dir):
    """A rule that reads account and typo together, between the typo and mail routing."""
    return fields(validated(spark, sf_dir, rules=ps.insert_rule(MIXED, before="dns")), "sub_status")


# Disposable domains and shared mailboxes from tables of their own: the domains of one
# customer in three, and the names of all parts.
LIST_SQL = "SELECT 'CLIENTE' || CAST(c_custkey AS STRING) || '.com.co ' AS value FROM customer WHERE c_custkey % 3 = 0"


@entry(
    "disposable_table",
    f"""WITH {parsed_ctes(CONTACTS_SQL)} SELECT input_seq,
      coalesce(ok AND (domain IN {in_list(lists.DISPOSABLE)} OR domain IN (SELECT lower(trim(value)) FROM ({LIST_SQL}) l)), FALSE) AS disposable
    FROM checked""",
)
def disposable_table(spark, sf_dir):
    table = inputs.run(spark, sf_dir, LIST_SQL, "customer")
    return fields(validated(spark, sf_dir, options=ps.Options(extra_disposable=table)), "disposable")


@entry(
    "domain_table",
    f"""WITH {parsed_ctes(CONTACTS_SQL)},
    listed AS (SELECT ordinal, value FROM (VALUES {", ".join(f"({i}, '{v}')" for i, v in enumerate(COMMON))}) AS t(ordinal, value)
      UNION ALL SELECT {len(COMMON)} + c_custkey, 'cliente' || CAST(c_custkey AS STRING) || '.com.co' FROM customer WHERE c_custkey % 2 = 0),
    near AS (
      SELECT d.domain, ordinal, value, damerau_levenshtein(d.domain, value) AS distance FROM ({SQL_DOMAINS}) d, listed
      WHERE abs(length(d.domain) - length(value)) <= 2 AND levenshtein(d.domain, value) <= 4 AND d.domain NOT IN (SELECT value FROM listed))
    SELECT d.domain, n.suggestion FROM ({SQL_DOMAINS}) d LEFT JOIN (
      SELECT domain, arg_min(value, (distance, ordinal)) AS suggestion FROM near
      WHERE distance <= CASE WHEN length(domain) <= 6 THEN 1 ELSE 2 END GROUP BY domain) n ON d.domain = n.domain""",
)
def domain_table(spark, sf_dir):
    """Typos against common domains from a table, where also only distance 2 hits."""
    customers = inputs.table(spark, sf_dir, "customer").where("c_custkey % 2 = 0")
    extra = customers.select(F.concat(F.lit("cliente"), F.col("c_custkey").cast("string"), F.lit(".com.co")).alias("value"), F.col("c_custkey").alias("ordinal"))
    domains = parsed(inputs.contacts(spark, sf_dir)).select("domain").distinct()
    return ps.find_typos(domains, ps.BASE_LISTS, extra=extra, settled=checkpoint_folder(spark) is not None).select("domain", F.col("typo.suggestion").alias("suggestion"))


# One contact per customer with all addresses of the customer's orders as an array.
@entry(
    "array_fanout",
    f"""WITH {validation_ctes(CONTACTS_SQL)}
    SELECT s.owner, v.email AS raw, v.normalized AS email, v.status, v.sub_status, v.recommendation
    FROM validated v JOIN source s ON v.input_seq = s.input_seq""",
)
def array_fanout(spark, sf_dir):
    # collect_list leaves nulls out; they are addresses that are missing, so keep them.
    grouped = inputs.contacts(spark, sf_dir).groupBy("owner").agg(F.collect_list(F.struct("email")).alias("items"))
    people = grouped.select("owner", F.transform("items", lambda i: i["email"]).alias("emails"))
    rows = ps.validate(people, "emails", dns=inputs.dns_answers(spark, sf_dir), as_of=AS_OF)
    return rows.select("owner", F.col("validation.email").alias("raw"), "email", "validation.status", "validation.sub_status", "validation.recommendation")


# JSON values of every type, from `orders`.
JSON_SQL = """
    SELECT o_orderkey AS input_seq,
      CASE o_orderkey % 8
        WHEN 0 THEN 'null' WHEN 1 THEN CAST(o_custkey AS STRING) WHEN 2 THEN 'true'
        WHEN 3 THEN '["a' || CAST(o_custkey AS STRING) || '@b.com","c"]'
        WHEN 4 THEN '{"email":"x"}' WHEN 5 THEN '"   "'
        WHEN 6 THEN '"ana@cliente' || CAST(o_custkey AS STRING) || '.com.co"'
        ELSE '"sin-arroba"' END AS body
    FROM orders
"""


@entry(
    "json_types",
    f"""SELECT input_seq,
      CASE input_seq % 8 WHEN 0 THEN '' WHEN 3 THEN json_extract_string(body, '$[0]') || ',c' WHEN 4 THEN '[object Object]'
        WHEN 1 THEN body WHEN 2 THEN body ELSE json_extract_string(body, '$') END AS email,
      CASE WHEN input_seq % 8 = 0 THEN 'field_not_found' WHEN input_seq % 8 IN (1, 2, 3, 4) THEN 'invalid_type'
        WHEN input_seq % 8 = 5 THEN 'empty' WHEN input_seq % 8 = 7 THEN 'failed_syntax_check' ELSE 'dns_unavailable' END AS sub_status
    FROM ({JSON_SQL}) j""",
)
def json_types(spark, sf_dir):
    items = inputs.run(spark, sf_dir, JSON_SQL, "orders").select("input_seq", F.parse_json("body").alias("value"))
    return fields(ps.validate(items, "value", as_of=AS_OF, fan_out=False), "email", "sub_status")


# --- addresses found in texts -------------------------------------------------------

FOUND_SQL = """
    SELECT doc_id * 2 AS input_seq, lower(e) AS email FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+')) AS e FROM documents) d
    UNION
    SELECT page_id * 2 + 1, lower(e) FROM (SELECT page_id, unnest(regexp_extract_all(html, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+')) AS e FROM pages) p
"""


@entry("extracted_contacts", f"WITH {validation_ctes(FOUND_SQL)} SELECT input_seq, normalized, status, sub_status, recommendation FROM validated")
def extracted_contacts(spark, sf_dir):
    def found(name: str, key, text: str) -> DataFrame:
        # Only pieces without white space that hold an `@` are searched: the pattern retries
        # every start of a long run of letters.
        texts = inputs.table(spark, sf_dir, name).where(F.contains(text, F.lit("@")))
        pieces = F.filter(F.split(text, "[^A-Za-z0-9._%+@-]+"), lambda w: F.contains(w, F.lit("@")))
        worded = texts.select(key.alias("input_seq"), F.explode(pieces).alias("piece"))
        address = F.regexp_extract_all("piece", F.lit("[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"), F.lit(0))
        return worded.select("input_seq", F.explode(address).alias("email"))

    documents = found("documents", F.col("doc_id") * 2, "text")
    pages = found("pages", F.col("page_id") * 2 + 1, "html")
    found_once = documents.unionByName(pages).select("input_seq", F.lower("email").alias("email")).distinct()
    # Searching the texts is the costly part, and validate reads its contacts twice.
    contacts = settle(found_once) if checkpoint_folder(spark) else found_once
    rows = ps.validate(contacts, dns=inputs.dns_answers(spark, sf_dir), as_of=AS_OF)
    return fields(rows, "normalized", "status", "sub_status", "recommendation")


# --- registration -------------------------------------------------------------------

REGISTRY_CTES = f"""
    documents_in AS ({inputs.BOOTSTRAP_SQL}),
    services AS (SELECT seq, unnest(range(0, CAST(json_array_length(body, '$.services') AS BIGINT))) AS pos, body FROM documents_in),
    mentions AS (
      SELECT seq, pos, lower(unnest(from_json(json_extract(body, '$.services[' || pos || '][0]'), '["VARCHAR"]'))) AS tld,
             json_extract_string(body, '$.services[' || pos || '][1][0]') AS url
      FROM services WHERE json_type(body, '$.services[' || pos || ']') = 'ARRAY'
    ),
    registry AS (
      SELECT tld, url || CASE WHEN url LIKE '%/' THEN '' ELSE '/' END AS base_url
      FROM (SELECT *, row_number() OVER (PARTITION BY tld ORDER BY seq DESC, pos DESC) AS n FROM mentions WHERE url IS NOT NULL) m WHERE n = 1
    ),
    rdap AS ({inputs.RDAP_SQL}),
    cuts AS (SELECT domain, unnest(range(2, len(string_split(domain, '.')) + 1)) AS spot FROM (SELECT DISTINCT domain FROM rdap)),
    served AS (
      SELECT domain, base_url FROM (
        SELECT c.domain, r.base_url, row_number() OVER (PARTITION BY c.domain ORDER BY spot) AS n
        FROM cuts c JOIN registry r ON r.tld = array_to_string(string_split(c.domain, '.')[spot:], '.')) s WHERE n = 1
    ),
    answers_r AS (
      SELECT *, error IS NULL AND http_status BETWEEN 200 AND 299 AND json_valid(body) AS usable_answer FROM rdap
      WHERE fetched_at IS NULL OR fetched_at + INTERVAL '24' HOUR > {AS_OF_SQL}
    ),
    aged AS (
      SELECT domain, fetched_at, usable_answer OR (error IS NULL AND http_status = 404) AS keepable,
        CASE WHEN usable_answer THEN TRY_CAST(json_extract_string(body, '$.events[#-1].eventDate') AS TIMESTAMP) END AS registered,
        CASE WHEN usable_answer THEN json_extract_string(body, '$.events[#-1].eventAction') END AS action
      FROM answers_r
    ),
    ages AS (
      SELECT a.domain,
        CASE WHEN s.base_url IS NOT NULL AND action = 'registration'
             THEN CAST(floor((epoch_ms({AS_OF_SQL}) - epoch_ms(registered)) / 86400000.0) AS INT) END AS age_days,
        s.base_url IS NULL OR keepable AS cacheable
      FROM aged a LEFT JOIN served s ON a.domain = s.domain WHERE fetched_at IS NULL OR keepable
    )
"""


@entry("tld_registry", f"WITH {REGISTRY_CTES} SELECT tld, base_url FROM registry")
def tld_registry(spark, sf_dir):
    return registry_from_bootstrap(inputs.bootstrap_documents(spark, sf_dir), order="seq")


@entry("tld_server", f"WITH {REGISTRY_CTES} SELECT domain, base_url FROM served")
def tld_server(spark, sf_dir):
    registry = registry_from_bootstrap(inputs.bootstrap_documents(spark, sf_dir), order="seq")
    return registry_servers(inputs.rdap_answers(spark, sf_dir).select("domain").distinct(), registry)


def ages(spark, sf_dir) -> DataFrame:
    registry = registry_from_bootstrap(inputs.bootstrap_documents(spark, sf_dir), order="seq")
    return ps.domain_ages(inputs.rdap_answers(spark, sf_dir), registry, instant(AS_OF))


@entry("domain_age", f"WITH {REGISTRY_CTES} SELECT domain, age_days, cacheable FROM ages")
def domain_age(spark, sf_dir):
    return ages(spark, sf_dir)


@entry(
    "domain_age_no_registry",
    f"WITH {REGISTRY_CTES} SELECT domain, CAST(NULL AS INT) AS age_days, FALSE AS cacheable FROM ages",
)
def domain_age_no_registry(spark, sf_dir):
    """Without any registry document nothing is known, and nothing is final."""
    registry = registry_from_bootstrap(inputs.bootstrap_documents(spark, sf_dir).where("seq < 0"), order="seq")
    return ps.domain_ages(inputs.rdap_answers(spark, sf_dir), registry, instant(AS_OF))


# Answers with two registration events: the first one counts.
TWO_EVENTS_SQL = """
    SELECT c_custkey AS seq, '{"events": [{"eventAction": "registration", "eventDate": "' || CAST(1990 + c_custkey % 30 AS STRING)
      || '-03-04' || CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'T13:00:00Z' END
      || '"}, {"eventAction": "registration", "eventDate": "2021-01-01T00:00:00Z"}]}' AS body FROM customer
"""


@entry(
    "first_registration_event",
    f"""SELECT seq, CAST(floor((epoch_ms({AS_OF_SQL}) - epoch_ms(CAST(json_extract_string(body, '$.events[0].eventDate') AS TIMESTAMP))) / 86400000.0) AS INT) AS age_days
    FROM ({TWO_EVENTS_SQL}) t""",
)
def first_registration_event(spark, sf_dir):
    bodies = inputs.run(spark, sf_dir, TWO_EVENTS_SQL, "customer")
    return bodies.select("seq", registration_age_days(F.col("body"), instant(AS_OF)).alias("age_days"))


# Contacts at the registered domains, which all have a mail server.
OWNERS_SQL = f"SELECT 'ana.maria@' || domain AS email FROM ({inputs.RDAP_SQL}) r"


@entry("validation_with_age", f"WITH {REGISTRY_CTES} SELECT 'ana.maria@' || r.domain AS send_to, age_days AS domain_age_days FROM rdap r LEFT JOIN ages a ON r.domain = a.domain")
def validation_with_age(spark, sf_dir):
    contacts = inputs.run(spark, sf_dir, OWNERS_SQL, "customer")
    rows = ps.validate(
        contacts, dns=owner_dns(spark, sf_dir), ages=ages(spark, sf_dir), as_of=AS_OF, options=ps.Options(include_domain_age=True)
    )
    return rows.select("validation.send_to", "validation.domain_age_days")


def owner_dns(spark, sf_dir) -> DataFrame:
    mx = F.array(F.struct(F.concat(F.lit("mx."), "domain").alias("exchange"), F.lit(1).alias("priority")))
    none = F.lit(None)
    return inputs.rdap_answers(spark, sf_dir).select(
        "domain",
        mx.alias("mx"),
        none.cast("string").alias("mx_code"),
        none.cast("array<string>").alias("a"),
        none.cast("string").alias("a_code"),
        none.cast("timestamp").alias("fetched_at"),
    )


@entry(
    "registration_requests",
    f"""WITH {REGISTRY_CTES} SELECT domain, base_url || 'domain/' || domain AS request_url FROM served
    WHERE domain NOT IN (SELECT domain FROM aged WHERE fetched_at IS NOT NULL AND keepable)""",
)
def registration_requests(spark, sf_dir):
    registry = registry_from_bootstrap(inputs.bootstrap_documents(spark, sf_dir), order="seq")
    return ps.registration_worklist(
        inputs.run(spark, sf_dir, OWNERS_SQL, "customer"),
        registry=registry,
        rdap=inputs.rdap_answers(spark, sf_dir),
        dns=owner_dns(spark, sf_dir),
        as_of=AS_OF,
    )


# --- streams ------------------------------------------------------------------------

EVENT_CONTACTS_SQL = inputs.addresses_sql("events", "event_id", "user_id", "ts")


def new_folder(spark: SparkSession) -> str:
    """A folder of its own for one run of a stream."""
    return f"{inputs.warehouse_folder(spark)}/stream-{uuid.uuid4()}"


def event_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = inputs.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return event_addresses(events)


def event_addresses(events: DataFrame) -> DataFrame:
    domain = F.get(text_array(inputs.DOMAINS), (F.col("event_id") % len(inputs.DOMAINS)).cast("int"))
    owner = F.concat(F.lit("cliente"), F.col("user_id").cast("string"), F.lit(".com.co"))
    account = F.get(text_array([a.replace("''", "'") for a in inputs.ACCOUNTS]), (F.col("event_id") % len(inputs.ACCOUNTS)).cast("int"))
    address = F.concat(account, F.lit("@"), F.when(domain == "*", owner).otherwise(domain))
    return events.select(F.col("event_id").alias("input_seq"), "ts", address.alias("email"))


EVENT_SQL = f"""
    SELECT event_id AS input_seq, account || '@' || CASE WHEN domain = '*' THEN 'cliente' || CAST(user_id AS STRING) || '.com.co' ELSE domain END AS email
    FROM events e
    JOIN (VALUES {inputs.ACCOUNT_VALUES}) AS a(i, account) ON e.event_id % {len(inputs.ACCOUNTS)} = a.i
    JOIN (VALUES {inputs.DOMAIN_VALUES}) AS d(i, domain) ON e.event_id % {len(inputs.DOMAINS)} = d.i
"""


@entry("stream_validate", f"WITH {validation_ctes(EVENT_SQL)} SELECT input_seq, status, sub_status, recommendation, suggestion, sendable FROM validated")
def stream_validate(spark, sf_dir):
    folder = new_folder(spark)
    query = start_validation(
        event_contacts(spark, sf_dir),
        lambda session: inputs.dns_answers(session, sf_dir),
        f"{folder}/out",
        checkpoint=f"{folder}/progress",
        available_now=True,
        as_of=AS_OF,
    )
    query.awaitTermination()
    return fields(spark.read.parquet(f"{folder}/out"), *VERDICT, "sendable")


@entry(
    "stream_refresh_requests",
    f"""WITH {validation_ctes(EVENT_SQL)}
    SELECT DISTINCT domain FROM decided WHERE asks AND domain NOT IN (SELECT domain FROM usable WHERE kept)""",
)
def stream_refresh_requests(spark, sf_dir):
    folder = new_folder(spark)
    query = start_refresh_requests(
        event_contacts(spark, sf_dir),
        lambda session: inputs.dns_answers(session, sf_dir),
        f"{folder}/out",
        checkpoint=f"{folder}/progress",
        available_now=True,
        as_of=AS_OF,
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("domain")


def event_batches(spark: SparkSession, sf_dir: str, folder: str, batches: int = 3) -> DataFrame:
    """The events as a stream of several micro-batches, in the order of their ids."""
    events = inputs.table(spark, sf_dir, "events")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    step = (high - low) // batches + 1
    for k in range(batches):
        part = events.where((F.col("event_id") >= low + k * step) & (F.col("event_id") < low + (k + 1) * step))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return event_addresses(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in"))


@entry("stream_cached", f"WITH {validation_ctes(EVENT_SQL)} SELECT input_seq, domain, status, cached FROM validated")
def stream_cached(spark, sf_dir):
    """`cached` over three micro-batches is that of one batch over all events."""
    folder = new_folder(spark)
    query = start_validation(
        event_batches(spark, sf_dir, folder),
        lambda session: inputs.dns_answers(session, sf_dir),
        f"{folder}/out",
        checkpoint=f"{folder}/progress",
        available_now=True,
        remember=True,
        order_by="input_seq",
        as_of=AS_OF,
    )
    query.awaitTermination()
    return fields(spark.read.parquet(f"{folder}/out"), "domain", "status", "cached")


@entry(
    "stream_requests_in_batches",
    f"""WITH {validation_ctes(EVENT_SQL)}
    SELECT DISTINCT domain FROM decided WHERE asks AND domain NOT IN (SELECT domain FROM usable WHERE kept)""",
)
def stream_requests_in_batches(spark, sf_dir):
    """Over three micro-batches within the time to live every domain is asked once."""
    folder = new_folder(spark)
    query = start_refresh_requests(
        event_batches(spark, sf_dir, folder),
        lambda session: inputs.dns_answers(session, sf_dir),
        f"{folder}/out",
        checkpoint=f"{folder}/progress",
        available_now=True,
        as_of=AS_OF,
    )
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("domain")


# --- counters and SQL text ------------------------------------------------------------


@entry(
    "domains_per_day",
    f"""SELECT CAST(e.ts AS DATE) AS day, count(*) AS requests, count(DISTINCT split_part(a.email, '@', 2)) AS domains, TRUE AS within
    FROM ({EVENT_SQL}) a JOIN events e ON e.event_id = a.input_seq GROUP BY 1""",
)
def domains_per_day(spark, sf_dir):
    """Sketches per hour, merged to days; the estimate is checked against the exact count."""
    asked = event_addresses(inputs.table(spark, sf_dir, "events")).select("ts", F.substring_index("email", "@", -1).alias("domain"))
    hourly = ps.domain_sketches(asked, [F.date_trunc("hour", "ts").alias("hour")])
    daily = ps.merged_counts(hourly, [F.to_date("hour").alias("day")])
    exact = asked.groupBy(F.to_date("ts").alias("day")).agg(F.count_distinct("domain").alias("exact"))
    within = F.abs(F.col("domains") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * relative_error())
    return daily.join(exact, "day").select("day", "requests", F.col("exact").alias("domains"), within.alias("within"))


@entry(
    "sql_functions",
    f"""WITH {parsed_ctes(CONTACTS_SQL)} SELECT input_seq, normalized, changed, loc AS account, domain, ok, {filler_sql("loc")} AS filler
    FROM checked WHERE email IS NOT NULL""",
)
def sql_functions(spark, sf_dir):
    """The same functions, called from SQL text."""
    ps.register_sql_functions(spark)
    return spark.sql(
        """SELECT input_seq, email_normalized(email) AS normalized, email_changed(email) AS changed, email_account(email_folded(email)) AS account,
          email_domain(email_folded(email)) AS domain, email_has_valid_syntax(email_normalized(email)) AS ok,
          account_is_filler(email_account(email_folded(email))) AS filler
        FROM {contacts} WHERE email IS NOT NULL""",
        contacts=inputs.contacts(spark, sf_dir),
    )


# --- flagship -----------------------------------------------------------------------


@entry(
    "verdict_report",
    f"WITH {validation_ctes(CONTACTS_SQL)} SELECT status, sub_status, recommendation, count(*) AS contacts, count(DISTINCT domain) AS domains FROM validated GROUP BY ALL",
)
def verdict_report(spark, sf_dir):
    """How much of the list can be sent to, and why not the rest."""
    rows = validated(spark, sf_dir).select("validation.*")
    return rows.groupBy("status", "sub_status", "recommendation").agg(
        F.count("*").alias("contacts"), F.count_distinct("domain").alias("domains")
    )
