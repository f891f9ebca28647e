"""Does an account look like keyboard filler? Built-in text functions, linear in its length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyboard rows and the thresholds of the detector.
KEYBOARD_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890")
KEYBOARD_RUN = 5
MIN_JUDGED_LENGTH = 5
MIN_VOWELLESS_LENGTH = 7
IGNORED_MARKS = "._+-"


def keyboard_runs() -> list[str]:
    """Every run of five neighbouring keys, in both directions."""
    both_ways = [r for row in KEYBOARD_ROWS for r in (row, row[::-1])]
    return [row[i : i + KEYBOARD_RUN] for row in both_ways for i in range(len(row) - KEYBOARD_RUN + 1)]


def _without_first_kind(text: Column) -> Column:
    """Text without any occurrence of its first character."""
    return F.replace(text, F.left(text, F.lit(1)), F.lit(""))


def looks_like_filler(account: Column) -> Column:
    bare = F.translate(F.lower(account), IGNORED_MARKS, "")
    # No more than two different characters: nothing is left without the first two kinds.
    two_letters = _without_first_kind(_without_first_kind(bare)) == ""
    four_in_a_row = bare.rlike(r"(?s)(.)\1{3}")
    key_run = bare.rlike("|".join(keyboard_runs()))
    no_vowel_or_digit = (F.length(bare) >= MIN_VOWELLESS_LENGTH) & ~bare.rlike("[aeiou0-9]")
    return (F.length(bare) >= MIN_JUDGED_LENGTH) & (
        two_letters | four_in_a_row | key_run | no_vowel_or_digit
    )
