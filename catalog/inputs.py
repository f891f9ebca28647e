"""Inputs of the catalog, derived from the given tables.

The tables hold no addresses, so contacts come from `orders` (one address per order),
mail-routing and registration answers from `customer`. The texts below are SQL that
Spark and DuckDB read alike, so both sides of a check start from the same contacts.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.operators.settle import checkpoint_folder
from postsift.sources.mail_routing import DNS_SCHEMA

AS_OF = "2024-06-01T12:00:00Z"
AS_OF_SQL = "TIMESTAMP '2024-06-01 12:00:00'"

ACCOUNTS = (
    "juan.perez", "maria.gomez", "info", "asdf", "xxxxxyyyy", "postmaster", "brgtk58",
    "test", "ventas", "licitaciones", "qwertyui", "ana_maria", "kmbtrwx", "o''brien",
    "a..b", "sofia.ramirez", "noreply", "tesoreria", "jj", "zzzzzz1", "abuse",
    "n.torres", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
)

# Fixed values below: domains and answers that the tests use as well.
# `*` stands for a domain of the order's customer, so the number of domains grows with
# the data; gmail.com takes a large share, as it does in real lists.
DOMAINS = (
    "gmail.com", "*", "hotmail.com", "gmial.com", "gmail.com", "empresa.com.co", "*",
    "hotmial.com", "gmail.com", "mailinator.com", "ymail.com", "*", "une.net.co",
    "gmail.com", "soloa.com", "sincorreo.com", "*", "caido.com", "gmail.com", "*",
    "dominio-que-no-existe-xyz.com", "gmail.co", "gmail.com", "outlok.es", "*",
    "yahooo.com", "gmail.com", "proton.mee", "live.con", "*", "multi.com", "aol.co",
    "gmail.com", "localhost", "icloud.com", "yopmail.com", "gmxx.net",
)

# Mail-routing zone: domain, MX records as host/priority, IPv4 address, resolver code.
ZONE = (
    ("gmail.com", (("gmail-smtp-in.l.google.com.", 5), ("alt1.gmail-smtp-in.l.google.com.", 10)), None, None),
    ("hotmail.com", (("hotmail-com.olc.protection.outlook.com.", 2),), None, None),
    ("ymail.com", (("mta7.am0.yahoodns.net.", 1),), None, None),
    ("une.net.co", (("mail.une.net.co.", 10),), None, None),
    ("empresa.com.co", (("mail.empresa.com.co.", 10),), None, None),
    ("mailinator.com", (("mail.mailinator.com.", 1),), None, None),
    ("hotmial.com", (("mail.h-email.net.", 5),), None, None),
    ("gmial.com", (), "51.79.68.169", None),
    ("gmail.co", (), "192.0.2.2", None),
    ("soloa.com", (), "203.0.113.10", None),
    ("sincorreo.com", ((".", 0),), None, None),
    ("caido.com", (), None, "ESERVFAIL"),
    ("multi.com", (("alt.example.com.", 30), ("principal.example.com.", 5)), None, None),
    ("icloud.com", (("mx01.mail.icloud.com.", 10),), None, None),
    ("proton.mee", (("mail.proton.mee.", 10),), None, None),
    ("aol.co", (("mx.aol.co.", 10),), None, None),
    ("gmxx.net", (), None, "ENOTFOUND"),
)

# Kinds of answers for customer domains; `*` stands for the domain.
KINDS = (
    ((("ASPMX.L.GOOGLE.COM.", 1), ("alt1.aspmx.l.google.com.", 5)), None, None, None),
    ((("*.mail.protection.outlook.com.", 0),), None, None, None),
    ((("mx2.*.", 20), ("mx1.*.", 10), ("mx0.*.", 10)), None, None, None),
    (((".", 0),), None, None, None),
    ((), "NXDOMAIN", None, None),
    ((), "ESERVFAIL", None, None),
    ((), "ENODATA", "203.0.113.7", None),
    ((), "ENODATA", None, "ENODATA"),
    ((), None, None, "ENOTFOUND"),
    ((), "ENODATA", None, "ETIMEOUT"),
    ((("smtp.secureserver.net", 5),), None, None, None),
)


def _text(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else f"'{value}'"


def values(rows) -> str:
    """Rows as the body of a VALUES list."""
    return ", ".join("(" + ", ".join(str(c) if isinstance(c, int) else _text(c) for c in row) + ")" for row in rows)


ACCOUNT_VALUES = values(enumerate(ACCOUNTS))
DOMAIN_VALUES = values(enumerate(DOMAINS))


def addresses_sql(table: str, key: str, owner: str, extra: str) -> str:
    """One raw address per row of `table`, in every state a contact list can be in."""
    return f"""
    SELECT {key} AS input_seq, {extra},
           CASE WHEN {key} % 101 = 0 THEN CAST(NULL AS STRING)
                WHEN {key} % 103 = 0 THEN '   '
                WHEN {key} % 107 = 0 THEN account || ' at ' || domain
                WHEN {key} % 7 = 0 THEN '  ' || upper(account || '@' || domain) || chr(9)
                WHEN {key} % 7 = 1 THEN '.' || account || '.@' || domain
                WHEN {key} % 7 = 2 THEN account || CAST({key} AS STRING) || '@' || domain
                ELSE account || '@' || domain END AS email
    FROM (
      SELECT t.*, a.account,
             CASE WHEN d.domain = '*' THEN 'cliente' || CAST(t.{owner} AS STRING) || '.com.co'
                  ELSE d.domain END AS domain
      FROM {table} t
      JOIN (VALUES {ACCOUNT_VALUES}) AS a(i, account) ON t.{key} % {len(ACCOUNTS)} = a.i
      JOIN (VALUES {DOMAIN_VALUES}) AS d(i, domain) ON t.{key} % {len(DOMAINS)} = d.i
    ) addressed
    """


CONTACTS_SQL = addresses_sql("orders", "o_orderkey", "o_custkey", "o_orderpriority AS priority, o_custkey AS owner")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def warehouse_folder(spark: SparkSession) -> str:
    """Where a stream keeps its output and progress: the session's checkpoint folder, else its warehouse."""
    return checkpoint_folder(spark) or spark.conf.get("spark.sql.warehouse.dir")


def run(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    """One of the shared texts in Spark, over the one given table it names."""
    escaped = sql.replace("{", "{{").replace("}", "}}")
    return spark.sql(re.sub(rf"\b{name}\b", "{given}", escaped), given=table(spark, sf_dir, name))


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, CONTACTS_SQL, "orders")


# --- mail-routing answers -----------------------------------------------------------

# Each customer domain has a newest answer and, every fourth one, an older one. Every
# seventh customer has no answer at all. `fetched_at` null is an answer of this run.
CUSTOMER_LOOKUPS_SQL = f"""
    SELECT 'cliente' || CAST(c_custkey AS STRING) || '.com.co' AS domain, c_custkey % {len(KINDS)} AS kind,
           CASE WHEN c_custkey % 5 = 0 THEN CAST(NULL AS TIMESTAMP)
                ELSE {AS_OF_SQL} - (c_custkey % 10) * INTERVAL '1' HOUR END AS fetched_at
    FROM customer WHERE c_custkey % 7 <> 3
    UNION ALL
    SELECT 'cliente' || CAST(c_custkey AS STRING) || '.com.co', (c_custkey + 1) % {len(KINDS)},
           {AS_OF_SQL} - (c_custkey % 10 + 2) * INTERVAL '1' HOUR
    FROM customer WHERE c_custkey % 7 <> 3 AND c_custkey % 4 = 0
"""

KIND_CODE_VALUES = values(
    (k, mx_code, address, a_code) for k, (_, mx_code, address, a_code) in enumerate(KINDS)
)
KIND_MX_VALUES = values((k, i, host, p) for k, kind in enumerate(KINDS) for i, (host, p) in enumerate(kind[0]))
ZONE_CODE_VALUES = values(
    (d, code or (None if mx else "ENODATA"), a, code or (None if a else "ENODATA")) for d, mx, a, code in ZONE
)
ZONE_MX_VALUES = values((d, i, host, p) for d, mx, _, _ in ZONE for i, (host, p) in enumerate(mx))


def dns_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers table of the library, from `customer` and the zone."""
    kinds = spark.createDataFrame(
        [(k, list(mx), mx_code, [a] if a else None, a_code) for k, (mx, mx_code, a, a_code) in enumerate(KINDS)],
        "kind int, mx array<struct<exchange:string,priority:int>>, mx_code string, a array<string>, a_code string",
    )
    lookups = run(spark, sf_dir, CUSTOMER_LOOKUPS_SQL, "customer")
    named = F.transform(
        "mx", lambda r: F.struct(F.replace(r["exchange"], F.lit("*"), F.col("domain")).alias("exchange"), r["priority"])
    )
    # Eleven kinds.
    grown = lookups.join(F.broadcast(kinds), "kind").select("domain", named.alias("mx"), "mx_code", "a", "a_code", "fetched_at")
    zone = spark.createDataFrame(
        [
            (d, list(mx), code or (None if mx else "ENODATA"), [a] if a else None, code or (None if a else "ENODATA"), None)
            for d, mx, a, code in ZONE
        ],
        DNS_SCHEMA,
    )
    return grown.unionByName(zone)


# The same answers in SQL: `answers` (one row per lookup) and `records` (its MX records).
DNS_CTES = f"""
    lookups AS ({CUSTOMER_LOOKUPS_SQL}),
    answers AS (
      SELECT l.domain, l.fetched_at, k.mx_code, k.address, k.a_code, l.kind
      FROM lookups l JOIN (VALUES {KIND_CODE_VALUES}) AS k(kind, mx_code, address, a_code) ON l.kind = k.kind
      UNION ALL
      SELECT domain, CAST(NULL AS TIMESTAMP), mx_code, address, a_code, -1
      FROM (VALUES {ZONE_CODE_VALUES}) AS z(domain, mx_code, address, a_code)
    ),
    records AS (
      SELECT l.domain, l.fetched_at, m.pos, replace(m.host, '*', l.domain) AS host, m.priority
      FROM lookups l JOIN (VALUES {KIND_MX_VALUES}) AS m(kind, pos, host, priority) ON l.kind = m.kind
      UNION ALL
      SELECT domain, CAST(NULL AS TIMESTAMP), pos, host, priority
      FROM (VALUES {ZONE_MX_VALUES}) AS z(domain, pos, host, priority)
    ),
    best AS (
      SELECT domain, fetched_at, lower(regexp_replace(host, '\\.$', '')) AS host
      FROM (SELECT *, row_number() OVER (PARTITION BY domain, fetched_at ORDER BY priority, pos) AS n FROM records) r
      WHERE n = 1
    ),
    statuses AS (
      SELECT a.domain, a.fetched_at,
        CASE WHEN a.mx_code IS NULL AND b.host IS NOT NULL AND b.host NOT IN ('', '.') THEN b.host END AS mx,
        CASE WHEN a.mx_code IS NULL AND b.host IS NOT NULL THEN b.host NOT IN ('', '.')
             WHEN a.mx_code IS NULL OR a.mx_code = 'ENODATA' THEN a.a_code IS NULL AND a.address IS NOT NULL
             ELSE FALSE END AS accepts_mail,
        (a.mx_code IS NULL AND b.host IS NOT NULL AND b.host IN ('', '.')) AS null_mx,
        CASE WHEN a.mx_code IS NULL AND b.host IS NOT NULL THEN TRUE
             WHEN a.mx_code IS NULL OR a.mx_code = 'ENODATA' THEN a.a_code IS NULL OR a.a_code = 'ENODATA'
             ELSE FALSE END AS domain_exists,
        CASE WHEN a.mx_code IS NULL AND b.host IS NOT NULL THEN FALSE
             WHEN a.mx_code IN ('ENOTFOUND', 'NXDOMAIN') THEN FALSE
             WHEN a.mx_code IS NOT NULL AND a.mx_code <> 'ENODATA' THEN TRUE
             ELSE a.a_code IS NOT NULL AND a.a_code NOT IN ('ENODATA', 'ENOTFOUND', 'NXDOMAIN') END AS resolver_failed
      FROM answers a LEFT JOIN best b ON a.domain = b.domain AND a.fetched_at IS NOT DISTINCT FROM b.fetched_at
    ),
    usable AS (
      SELECT *, fetched_at IS NOT NULL AS kept FROM (
        SELECT *, row_number() OVER (PARTITION BY domain ORDER BY fetched_at DESC NULLS LAST) AS n
        FROM statuses
        WHERE fetched_at IS NULL
           OR (fetched_at + INTERVAL '6' HOUR > {AS_OF_SQL} AND NOT resolver_failed)
      ) s WHERE n = 1
    )
"""


# --- registration answers -----------------------------------------------------------

# One bootstrap document per nation: a label of its own (in letters) plus shared ones, some services
# without URLs, some URLs without the closing slash, labels in upper case.
BOOTSTRAP_SQL = """
    SELECT n_nationkey AS seq,
      '{"services": [[["com", "N' || translate(CAST(n_nationkey AS STRING), '0123456789', 'abcdefghij') || '"], ["https://rdap.n' || translate(CAST(n_nationkey AS STRING), '0123456789', 'abcdefghij')
      || '.example", "https://spare.example/"]], [["none' || translate(CAST(n_nationkey AS STRING), '0123456789', 'abcdefghij') || '"], []], "odd", [["co.n'
      || translate(CAST(n_nationkey AS STRING), '0123456789', 'abcdefghij') || '"], ["https://co.n' || translate(CAST(n_nationkey AS STRING), '0123456789', 'abcdefghij') || '.example/"]]]}' AS body
    FROM nation
"""

# Registration answers for one domain per customer, under the labels of its nation.
RDAP_SQL = f"""
    SELECT 'd' || CAST(c_custkey AS STRING)
             || CASE c_custkey % 4 WHEN 0 THEN '.com' WHEN 1 THEN '.n' WHEN 2 THEN '.co.n' ELSE '.org.zz' END
             || CASE WHEN c_custkey % 4 IN (1, 2) THEN translate(CAST(c_nationkey AS STRING), '0123456789', 'abcdefghij') ELSE '' END AS domain,
           CASE c_custkey % 9 WHEN 5 THEN 404 WHEN 6 THEN 429 WHEN 7 THEN 503 ELSE 200 END AS http_status,
           CASE c_custkey % 9
             WHEN 1 THEN '{{"events": [{{"eventAction": "last changed", "eventDate": "2020-01-01T00:00:00Z"}}]}}'
             WHEN 2 THEN '{{"events": [{{"eventAction": "registration", "eventDate": "soon"}}]}}'
             WHEN 3 THEN '{{"events": [{{"eventAction": "registration", "eventDate": "2031-02-03T04:05:06Z"}}]}}'
             WHEN 4 THEN '<html>'
             ELSE '{{"events": [{{"eventAction": "transfer"}}, {{"eventAction": "registration", "eventDate": "'
               || CAST(1990 + c_custkey % 30 AS STRING) || '-03-04T13:00:00Z"}}]}}' END AS body,
           CASE WHEN c_custkey % 9 = 8 THEN 'timeout' END AS error,
           CASE WHEN c_custkey % 3 = 0 THEN CAST(NULL AS TIMESTAMP)
                ELSE {AS_OF_SQL} - (c_custkey % 40) * INTERVAL '1' HOUR END AS fetched_at
    FROM customer
"""


def bootstrap_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, BOOTSTRAP_SQL, "nation")


def rdap_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, RDAP_SQL, "customer")
