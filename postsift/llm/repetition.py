"""Quality rules by repetition coverage.

Words are hashed once; rolling hashes of several n-gram lengths then tell, in numpy, how
many characters of a text lie inside n-grams and lines that occurred before in it. The first
occurrence does not count: a passage said twice is half redundant.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from postsift.llm.texthash import (
    SPACES,
    covered,
    later,
    mixed,
    ngram_hashes,
    per_row,
    repeated,
    span_hashes,
    text_slices,
    words_of,
)


@dataclass(frozen=True)
class RepetitionLimits:
    """Largest shares (percent of a text's word characters) a kept text may reach."""

    ngrams: tuple[tuple[int, int], ...] = ((5, 15), (6, 14), (7, 13), (8, 12), (9, 11), (10, 10))
    lines: int = 20
    least_words: int = 10
    repeat_words: int = 20


LIMITS = RepetitionLimits()

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def measure(buf: np.ndarray, bounds: np.ndarray, limits: RepetitionLimits) -> dict[str, np.ndarray]:
    """All measures of the texts between `bounds`, one value per text."""
    rows = len(bounds) - 1
    seeds = mixed(np.arange(1, rows + 1, dtype=np.uint64))
    starts, ends, row = words_of(buf, bounds)
    words = span_hashes(buf, starts, ends)
    of_row = np.searchsorted(row, np.arange(rows + 1))
    chars_before = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(((buf & 0xC0) != 0x80) & ~SPACES[buf], out=chars_before[1:])
    chars = chars_before[ends] - chars_before[starts]

    out = {"n_words": np.diff(of_row), "word_chars": per_row(chars, of_row), "n_symbols": per_row(SYMBOLS[buf], bounds)}

    cuts = np.flatnonzero(buf == 0x0A)
    heads = np.union1d(bounds[:-1][bounds[:-1] < len(buf)], cuts + 1)
    heads = heads[heads < len(buf)]
    tails = np.append(heads[1:], len(buf)) if len(heads) else heads
    tails = np.where((tails > heads) & (buf[tails - 1] == 0x0A), tails - 1, tails)
    line_row = np.searchsorted(bounds, heads, "right") - 1
    line_chars = chars_before[tails] - chars_before[heads]
    dup = later(span_hashes(buf, heads, tails) ^ seeds[line_row]) & (line_chars > 0)
    out["n_dup_lines"] = np.bincount(line_row[dup], minlength=rows)
    out["dup_line_chars"] = np.bincount(line_row[dup], line_chars[dup], rows).astype(np.int64)

    at = np.arange(len(words))
    for n in sorted({5, *(n for n, _ in limits.ngrams)}):
        # A longer n-gram can only repeat where a shorter one does.
        at = at[at + n <= len(words)]
        at = at[row[at] == row[at + n - 1]]
        keys = ngram_hashes(words, n, at) ^ seeds[row[at]]
        twice = repeated(keys)
        if n == 5:
            out["n_repeat_words"] = per_row(covered(len(words), at[twice], n), of_row)
        again = covered(len(words), at[later(keys)], n)
        out[f"dup_{n}gram_chars"] = per_row(np.where(again, chars, 0), of_row)
        at = at[twice]
    return out


def judged(got: dict[str, np.ndarray], limits: RepetitionLimits) -> dict[str, np.ndarray]:
    failed = (got["n_words"] < limits.least_words) | (100 * got["n_repeat_words"] > limits.repeat_words * got["n_words"])
    over = 100 * got["dup_line_chars"] > limits.lines * got["word_chars"]
    for n, most in limits.ngrams:
        over |= 100 * got[f"dup_{n}gram_chars"] > most * got["word_chars"]
    return got | {"base_failed": failed, "kept": ~failed & ~over}


def measures(limits: RepetitionLimits = LIMITS) -> list[str]:
    return [*BASE, "dup_line_chars", *(f"dup_{n}gram_chars" for n, _ in limits.ngrams), "base_failed", "kept"]


def with_repetition(docs: DataFrame, *, text: str = "text", limits: RepetitionLimits = LIMITS) -> DataFrame:
    """`docs` with the columns of `measures()` added, in one pass without a shuffle.

    A null text has no words and so fails the base rules; so does an empty one. Texts are
    measured whole, one by one, so repeated rows get equal values and row order has no
    effect. Columns of the input that bear the name of a measure give way to it; all
    others pass through.
    """
    names = measures(limits)
    taken = {n.lower() for n in names}
    docs = docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in taken])
    boolean = {"base_failed", "kept"}
    schema = T.StructType(
        [*docs.schema.fields, *(T.StructField(n, T.BooleanType() if n in boolean else T.LongType()) for n in names)]
    )
    place = docs.columns.index(text)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for _, _, buf, bounds in text_slices(batch.column(place)):
                parts.append(judged(measure(buf, bounds, limits), limits))
            if parts:
                new = [pa.array(np.concatenate([p[n] for p in parts])) for n in names]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    return docs.mapInArrow(added, schema)
