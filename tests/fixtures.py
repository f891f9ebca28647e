"""Test data: the mail-routing zone and small helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postsift.sources.mail_routing import DNS_SCHEMA

# Domain -> (mx records, ipv4 addresses, resolver code of both questions).
ZONE = {
    "gmail.com": ([("gmail-smtp-in.l.google.com.", 5)], None, None),
    "hotmail.com": ([("hotmail-com.olc.protection.outlook.com.", 2)], None, None),
    "ymail.com": ([("mta7.am0.yahoodns.net.", 1)], None, None),
    "une.net.co": ([("mail.une.net.co.", 10)], None, None),
    "empresa.com.co": ([("mail.empresa.com.co.", 10)], None, None),
    "empresa.com": ([("mail.empresa.com.", 10)], None, None),
    "mailinator.com": ([("mail.mailinator.com.", 1)], None, None),
    "asdf.com": ([("mail.asdf.com.", 10)], None, None),
    "hotmial.com": ([("mail.h-email.net.", 5)], None, None),
    "gmial.com": (None, ["51.79.68.169"], None),
    "soloa.com": (None, ["203.0.113.10"], None),
    "sincorreo.com": ([(".", 0)], None, None),
    "caido.com": (None, None, "ESERVFAIL"),
    "multi.com": ([("alt.example.com.", 30), ("principal.example.com.", 5)], None, None),
    "dominio-que-no-existe-xyz.com": (None, None, "ENOTFOUND"),
}


def zone_rows(zone=ZONE, fetched_at=None):
    rows = []
    for domain, (mx, a, code) in zone.items():
        mx_code = code or (None if mx is not None else "ENODATA")
        a_code = code or (None if a is not None else "ENODATA")
        rows.append((domain, mx, mx_code, a, a_code, fetched_at))
    return rows


def zone_frame(spark: SparkSession, zone=ZONE, fetched_at=None) -> DataFrame:
    return spark.createDataFrame(zone_rows(zone, fetched_at), DNS_SCHEMA)


def plain_distance(a: str, b: str) -> int:
    """Textbook table, to check the column expression against."""
    rows = [list(range(len(b) + 1))]
    for i in range(1, len(a) + 1):
        row = [i]
        for j in range(1, len(b) + 1):
            best = min(rows[i - 1][j] + 1, row[j - 1] + 1, rows[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                best = min(best, rows[i - 2][j - 2] + 1)
            row.append(best)
        rows.append(row)
    return rows[-1][-1]
