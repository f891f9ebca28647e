"""The cascade as one SQL statement for DuckDB, written apart from the library."""

from __future__ import annotations

from catalog.inputs import DNS_CTES
from postsift.sources import lists

# The accepted addresses and the rows of a keyboard.
PATTERN = "[A-Za-z0-9!#$%&''*+/=?^_`{|}~.-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"
ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890")
RUNS = [r[i : i + 5] for row in ROWS for r in (row, row[::-1]) for i in range(len(r) - 4)]


def in_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def ranked(values) -> str:
    return "VALUES " + ", ".join(f"({i}, '{v}')" for i, v in enumerate(values))


def filler_sql(account: str) -> str:
    bare = f"regexp_replace(lower({account}), '[._+-]', '', 'g')"
    letters = f"string_split({bare}, '')"
    repeated = (
        f"len(list_filter(range(1, length({bare}) - 2), lambda i: {bare}[i] = {bare}[i + 1] "
        f"AND {bare}[i] = {bare}[i + 2] AND {bare}[i] = {bare}[i + 3])) > 0"
    )
    return (
        f"(length({bare}) >= 5 AND (len(list_distinct({letters})) <= 2 OR {repeated} "
        f"OR regexp_matches({bare}, '{'|'.join(RUNS)}') "
        f"OR (length({bare}) >= 7 AND NOT regexp_matches({bare}, '[aeiou0-9]'))))"
    )


def parsed_ctes(source: str) -> str:
    """`source` needs input_seq and email."""
    return f"""
    source AS ({source}),
    folded AS (SELECT *, lower(trim(email, ' ' || chr(9))) AS f FROM source),
    halves AS (
      SELECT *, string_split(f, '@')[-1] AS host, left(f, greatest(length(f) - length(string_split(f, '@')[-1]) - 1, 0)) AS loc
      FROM folded
    ),
    parsed AS (
      SELECT *, CASE WHEN loc = '' THEN f ELSE trim(loc, '.') || '@' || host END AS normalized,
             trim(loc, '.') AS account, host AS domain, trim(loc, '.') <> loc AS changed
      FROM halves
    ),
    checked AS (
      SELECT *, length(normalized) <= 254 AND NOT contains(normalized, '..')
                AND regexp_full_match(normalized, '{PATTERN}') AND length(account) <= 64 AS ok
      FROM parsed
    )"""


def typo_ctes(domains: str, common) -> str:
    """`domains` is a select of distinct domains; gives `typos`."""
    return f"""
    common AS (SELECT * FROM ({ranked(common)}) AS t(ordinal, value)),
    measured AS (
      SELECT d.domain, c.ordinal, c.value, damerau_levenshtein(d.domain, c.value) AS distance,
             CASE WHEN length(d.domain) <= 6 THEN 1 ELSE 2 END AS cap
      FROM ({domains}) d, common c
      WHERE d.domain NOT IN {in_list(common)}
        AND abs(length(d.domain) - length(c.value)) <= CASE WHEN length(d.domain) <= 6 THEN 1 ELSE 2 END
    ),
    typos AS (
      SELECT domain, value AS suggestion, distance = 1 AND value IN {in_list(lists.TIER1)} AS sure
      FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY distance, ordinal) AS n FROM measured WHERE distance <= cap)
      WHERE n = 1
    )"""


def provider_sql(mx: str, what: str) -> str:
    branches = []
    for p in lists.PROVIDERS:
        value = f"'{p.name}'" if what == "name" else ("NULL" if p.catch_all is None else str(p.catch_all).upper())
        branches.append(f"WHEN {mx} LIKE '%{p.mx_suffix}' THEN {value}")
    return "CASE " + " ".join(branches) + " END"


def validation_ctes(
    source: str,
    *,
    role_is_sendable=True,
    catch_all_is_sendable=True,
    flag_suspicious=True,
    extra_domains=(),
    extra_disposable=(),
    extra_roles=(),
    dns_ctes: str = DNS_CTES,
    early_hook: str = "",
) -> str:
    """Everything up to `validated`; `early_hook` adds a WHEN before the typo check."""
    disposable = lists.DISPOSABLE + tuple(extra_disposable)
    roles = lists.SHARED_MAILBOXES + tuple(extra_roles)
    common = lists.FREE + lists.LOCAL_ISPS + tuple(extra_domains)
    pattern = f"WHEN {filler_sql('account')} THEN 'suspicious_pattern'" if flag_suspicious else ""
    role = "" if role_is_sendable else f"WHEN account IN {in_list(roles)} THEN 'role_based'"
    catch_all_advice = "confirm" if catch_all_is_sendable else "manual_review"
    return f"""
    {parsed_ctes(source)},
    {dns_ctes},
    early AS (
      SELECT *,
        CASE WHEN email IS NULL THEN 'field_not_found'
             WHEN f = '' THEN 'empty'
             WHEN NOT ok THEN 'failed_syntax_check'
             WHEN domain IN {in_list(disposable)} THEN 'disposable'
             WHEN account IN {in_list(lists.SYSTEM_MAILBOXES)} THEN 'system_mailbox'
             WHEN account IN {in_list(lists.JUNK)} THEN 'junk_local_part'
             {pattern}
             {role}
             {early_hook} END AS early
      FROM checked
    ),
    {typo_ctes("SELECT DISTINCT domain FROM early WHERE early IS NULL", common)},
    typed AS (
      SELECT e.*, CASE WHEN early IS NULL THEN account || '@' || t.suggestion END AS suggestion,
             early IS NULL AND coalesce(t.sure, FALSE) AS sure
      FROM early e LEFT JOIN typos t ON e.domain = t.domain
    ),
    routed AS (
      SELECT t.*, early IS NULL AND NOT sure AS asks, u.mx, coalesce(u.kept, FALSE) AS kept,
             coalesce(u.resolver_failed, TRUE) AS failed, coalesce(u.null_mx, FALSE) AS null_mx,
             coalesce(u.accepts_mail, FALSE) AS accepts
      FROM typed t LEFT JOIN usable u ON t.domain = u.domain
    ),
    arrived AS (
      SELECT *, asks AND NOT failed AND accepts AS works,
             row_number() OVER (PARTITION BY domain, asks ORDER BY input_seq) > 1 AS later
      FROM routed
    ),
    facts AS (
      SELECT *, CASE WHEN works THEN {provider_sql("mx", "name")} END AS provider,
             CASE WHEN works THEN {provider_sql("mx", "catch_all")} END AS takes_all
      FROM arrived
    ),
    decided AS (
      SELECT *,
        CASE WHEN early IS NOT NULL THEN early
             WHEN sure THEN 'possible_typo'
             WHEN failed THEN 'dns_unavailable'
             WHEN null_mx THEN 'domain_does_not_accept_mail'
             WHEN NOT accepts THEN CASE WHEN suggestion IS NOT NULL THEN 'possible_typo' ELSE 'no_dns_entries' END
             WHEN takes_all THEN NULL
             WHEN suggestion IS NOT NULL THEN 'possible_typo' END AS sub_status,
        CASE WHEN early IN ('disposable', 'system_mailbox', 'suspicious_pattern', 'role_based', 'vetoed') THEN 'do_not_mail'
             WHEN early IS NOT NULL OR sure THEN 'invalid'
             WHEN failed THEN 'unknown'
             WHEN null_mx OR NOT accepts THEN 'invalid'
             WHEN takes_all THEN 'catch_all' ELSE 'valid' END AS status,
        CASE WHEN early IN ('suspicious_pattern', 'role_based', 'vetoed') THEN 'manual_review'
             WHEN early IS NOT NULL OR sure THEN 'reject'
             WHEN failed THEN 'confirm'
             WHEN null_mx OR NOT accepts THEN 'reject'
             WHEN takes_all THEN '{catch_all_advice}'
             WHEN suggestion IS NOT NULL THEN 'confirm' ELSE 'accept' END AS recommendation
      FROM facts
    ),
    validated AS (
      SELECT input_seq, coalesce(email, '') AS email,
        CASE WHEN email IS NOT NULL AND f <> '' THEN normalized END AS normalized,
        CASE WHEN recommendation IN ('accept', 'confirm') THEN normalized END AS send_to,
        status, sub_status, recommendation, recommendation IN ('accept', 'confirm') AS sendable,
        suggestion,
        CASE WHEN ok AND f <> '' THEN account END AS account, CASE WHEN ok AND f <> '' THEN domain END AS domain,
        coalesce(ok AND domain IN {in_list(lists.FREE)}, FALSE) AS free_email,
        coalesce(ok AND (account IN {in_list(roles)} OR account IN {in_list(lists.SYSTEM_MAILBOXES)}), FALSE) AS role_based,
        coalesce(ok AND domain IN {in_list(disposable)}, FALSE) AS disposable,
        coalesce(f <> '' AND changed, FALSE) AS normalization_applied,
        works AS mx_found, CASE WHEN works THEN mx END AS mx_record, provider AS smtp_provider,
        takes_all AS catch_all,
        asks AND (kept OR (later AND NOT failed)) AS cached
      FROM decided
    )"""


# Optimal string alignment by rows: `t` is the row before insertions, then the cheapest
# way to reach each cell from the left.
ALIGNMENT_CTES = """
    dp(a, b, i, above, line) AS (
      SELECT a, b, 0, range(0, length(b) + 1), range(0, length(b) + 1) FROM (SELECT DISTINCT a, b FROM pairs)
      UNION ALL
      SELECT a, b, i + 1, line,
        [i + 1] || list_transform(range(1, length(b) + 1),
          lambda j: least(i + 1 + j, list_min(list_transform(range(1, j + 1), lambda k: t[k] + j - k))))
      FROM (
        SELECT *, list_transform(range(1, length(b) + 1), lambda j: least(
            line[j + 1] + 1,
            line[j] + CASE WHEN a[i + 1] = b[j] THEN 0 ELSE 1 END,
            CASE WHEN i > 0 AND j > 1 AND a[i + 1] = b[j - 1] AND a[i] = b[j] THEN above[j - 1] + 1 ELSE 1000000 END
          )) AS t
        FROM dp WHERE i < length(a)
      )
    ),
    distances AS (SELECT a, b, line[length(b) + 1] AS distance FROM dp WHERE i = length(a))
"""
