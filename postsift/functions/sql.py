"""The pure functions as SQL functions of a session, for users who write SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from postsift.functions.filler import IGNORED_MARKS, MIN_JUDGED_LENGTH, MIN_VOWELLESS_LENGTH, keyboard_runs
from postsift.functions.text import ADDRESS_PATTERN, EDGE_SPACE, MAX_ACCOUNT_LENGTH, MAX_ADDRESS_LENGTH


def quoted_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_functions() -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, type, body); a function may call those before it."""
    marks = quoted_text(IGNORED_MARKS)
    without_first_kind = "replace({0}, left({0}, 1), '')".format
    bare = f"translate(lower(account), {marks}, '')"
    two_letters = without_first_kind(without_first_kind("bare")) + " = ''"
    runs = quoted_text("|".join(keyboard_runs()))
    return {
        "email_folded": ("raw STRING", "STRING", f"lower(btrim(raw, {quoted_text(EDGE_SPACE)}))"),
        "email_domain": ("address STRING", "STRING", "substring_index(address, '@', -1)"),
        "email_account": ("address STRING", "STRING", "substring(address, 1, greatest(length(address) - length(email_domain(address)) - 1, 0))"),
        "email_rejoined": (
            "folded STRING",
            "STRING",
            "CASE WHEN email_account(folded) = '' THEN folded ELSE concat(btrim(email_account(folded), '.'), '@', email_domain(folded)) END",
        ),
        "email_normalized": ("raw STRING", "STRING", "email_rejoined(email_folded(raw))"),
        "email_changed": (
            "raw STRING",
            "BOOLEAN",
            "btrim(email_account(email_folded(raw)), '.') <> email_account(email_folded(raw))",
        ),
        "email_has_valid_syntax": (
            "address STRING",
            "BOOLEAN",
            f"length(address) <= {MAX_ADDRESS_LENGTH} AND NOT contains(address, '..') AND rlike(address, {quoted_text(ADDRESS_PATTERN)}) "
            f"AND length(email_account(address)) <= {MAX_ACCOUNT_LENGTH}",
        ),
        "filler_of_bare": (
            "bare STRING",
            "BOOLEAN",
            f"length(bare) >= {MIN_JUDGED_LENGTH} AND ({two_letters} OR rlike(bare, {quoted_text(r'(?s)(.)\1{3}')}) OR rlike(bare, {runs}) "
            f"OR (length(bare) >= {MIN_VOWELLESS_LENGTH} AND NOT rlike(bare, '[aeiou0-9]')))",
        ),
        "account_is_filler": ("account STRING", "BOOLEAN", f"filler_of_bare({bare})"),
        "recommendation_is_sendable": ("recommendation STRING", "BOOLEAN", "recommendation IN ('accept', 'confirm')"),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions in this session; an earlier one of the same name is replaced."""
    functions = sql_functions()
    for name, (parameters, kind, body) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return list(functions)
