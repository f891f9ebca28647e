"""Helpers for work on whole texts inside Arrow batches: byte buffers, hashes of spans, runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken in slices of about so many bytes, so that memory does not follow the batch;
#: arrays of 64-bit numbers per byte make it up to 60 times that.
SLICE_BYTES = 1 << 20
#: Prefix sums for hashes span about so many bytes at a time.
HASH_BYTES = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, HASH_BYTES + 1024), np.uint64(base))
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _powers[base] = known
    return known[:n]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span; the spans' starts and ends must both ascend."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + HASH_BYTES, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        n = max(hi - lo, 0)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[buf[lo:hi]] * powers(_BASE, n), out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * powers(_INVERSE, n + 1)[s] + (e - s).astype(np.uint64)
        i = j
    return mixed(out)


def ngram_hashes(tokens: np.ndarray, n: int, at: np.ndarray) -> np.ndarray:
    """Hash of the n tokens (64-bit values) from every place of `at` on."""
    out = tokens[at]
    for k in range(1, n):
        out *= np.uint64(_BASE)
        out += tokens[at + k]
    return mixed(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column one after the other, and the bounds of its texts; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) for runs of rows of about `limit` bytes, one row at least."""
    buf, bounds = text_bytes(column)
    i, n = 0, len(column)
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(bounds, bounds[i] + limit, "right")) - 1))
        yield i, j, buf[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
        i = j


def words_of(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the runs of bytes other than 0x20 and 0x09 to 0x0D; none crosses a bound."""
    if not len(buf):
        return (np.empty(0, np.int64),) * 3
    inside = ~SPACES[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(buf))]
    first[edges] |= inside[edges]
    last[edges - 1] |= inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of `flags` between neighbouring bounds."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Whether a key occurs twice or more."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    coarse = np.zeros(1 << 16, bool)
    coarse[twice >> np.uint64(48)] = True
    out = coarse[keys >> np.uint64(48)]
    at = np.flatnonzero(out)
    out[at] = twice[np.minimum(np.searchsorted(twice, keys[at]), len(twice) - 1)] == keys[at]
    return out


def later(keys: np.ndarray) -> np.ndarray:
    """Whether a key occurred before."""
    out = np.zeros(len(keys), bool)
    at = np.flatnonzero(repeated(keys))
    order = at[np.argsort(keys[at], kind="stable")]
    out[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return out


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of n places lie in a window of `width` from one of `starts`."""
    steps = np.zeros(n + 1, np.int64)
    steps[: n + 1] += np.bincount(starts, minlength=n + 1)[: n + 1]
    steps -= np.bincount(np.minimum(starts + width, n), minlength=n + 1)[: n + 1]
    return np.cumsum(steps[:n]) > 0
