"""Edit distance with adjacent transpositions (optimal string alignment).

Spark has `levenshtein` but counts a transposition as two edits, so `gmial` would
be two away from `gmail`. `edit_distance` is the exact measure for any two texts;
`edit_distance_within` is the same measure cut off at one or two edits; it never fills the
table, and decides nearly every pair with the native `levenshtein` alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def edit_distance(a: Column, b: Column) -> Column:
    """Insert, delete, substitute and adjacent swap cost 1; no substring edited twice.

    A fold over the characters of `a` that carries the last two rows of the usual
    table (`above`, `row`), each an array of length(b) + 1.
    """

    def char(text: Column, i: Column) -> Column:
        return F.substring(text, i, F.lit(1))

    def next_row(acc: Column, i: Column) -> Column:
        row, above = acc["row"], acc["above"]

        def append(built: Column, j: Column) -> Column:
            cost = F.when(char(a, i) == char(b, j), 0).otherwise(1)
            plain = F.least(
                F.get(row, j) + 1,
                F.get(built, j - 1) + 1,
                F.get(row, j - 1) + cost,
            )
            swapped = (
                (i > 1) & (j > 1) & (char(a, i) == char(b, j - 1)) & (char(a, i - 1) == char(b, j))
            )
            best = F.when(swapped, F.least(plain, F.get(above, j - 2) + 1)).otherwise(plain)
            return F.concat(built, F.array(best))

        built = F.aggregate(F.sequence(F.lit(1), F.length(b)), F.array(i), append)
        return F.struct(row.alias("above"), built.alias("row"))

    first = F.sequence(F.lit(0), F.length(b))
    filled = F.aggregate(
        F.sequence(F.lit(1), F.length(a)),
        F.struct(first.alias("above"), first.alias("row")),
        next_row,
        lambda acc: F.element_at(acc["row"], -1),
    )
    return (
        F.when(a == b, F.lit(0))
        .when(F.length(a) == 0, F.length(b))
        .when(F.length(b) == 0, F.length(a))
        .otherwise(filled)
    )


# Two edits are at most four for `levenshtein`, which counts a swap as two.
ROUGH_LIMIT = 4


def edit_distance_within(a: Column, b: Column, limit: Column) -> Column:
    """`edit_distance(a, b)` where it is at most `limit` (1 or 2), else null."""
    distance = refine(F.levenshtein(a, b, ROUGH_LIMIT), a, b)
    return F.when(distance <= limit, distance)


def refine(rough: Column, a: Column, b: Column) -> Column:
    """Exact distance up to two from `rough` = `levenshtein(a, b, 4)`; null above two.

    An alignment with t swaps and e other edits measures t + e here and at most
    2t + e in `levenshtein`, and no more than e characters of one text can be
    missing from the other. So, for distances up to two:

    * levenshtein 0 or 1 is already the answer;
    * levenshtein 2 is 1 for a lone swap, else 2;
    * levenshtein 3 or 4 is 2 for two swaps, and 3 also for a swap and one other edit.

    The searches for swaps run only where the stray characters leave room for them.
    """
    stray = F.greatest(_strays(a, b), _strays(b, a))
    return (
        F.when(rough < 0, F.lit(None))
        .when(rough <= 1, rough)
        .when(rough == 2, F.when((stray == 0) & _swap_first(a, b, _equal), 1).otherwise(2))
        .when(stray > ROUGH_LIMIT - rough, F.lit(None))
        .when(_swap_first(a, b, lambda x, y: _one_edit(x, y) | _swap_first(x, y, _equal)), 2)
        .when(_swap_first(F.reverse(a), F.reverse(b), _one_edit), 2)
    )


Test = Callable[[Column, Column], Column]


def _equal(a: Column, b: Column) -> Column:
    return a == b


def _one_edit(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b, 1) >= 0


def _swap_first(a: Column, b: Column, rest_holds: Test) -> Column:
    """Is the first difference a swap, and does `rest_holds` for what follows it?

    Where a swap is the first of two edits it sits at the first difference; where it is
    the last, it sits at the first difference of the reversed texts.
    """
    size = F.greatest(F.least(F.length(a), F.length(b)), F.lit(1))
    same = F.transform(
        F.sequence(F.lit(1), size), lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))
    )

    def swapped(i: Column) -> Column:
        ours, theirs = F.substring(a, i, F.lit(2)), F.substring(b, i, F.lit(2))
        rest = rest_holds(F.substring(a, i + 2, F.length(a)), F.substring(b, i + 2, F.length(b)))
        return (i > 0) & (F.length(theirs) == 2) & (ours == F.reverse(theirs)) & rest

    # The one-element array evaluates the position once. Zero means no difference.
    position = F.array_position(same, False).cast("int")
    return F.exists(F.array(position), swapped)


def _strays(a: Column, b: Column) -> Column:
    """How many characters of `a` do not occur in `b` at all."""
    return F.length(F.call_function("translate", a, b, F.lit("")))
