"""Where the pieces begin that a byte-level BPE tokenizer encodes one by one.

The tokenizer cuts a text at its special strings and then by the pattern
`'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`. Whether a
piece begins at a character depends on its class and on two neighbours to either side,
so all beginnings in a buffer are found at once.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import regex

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4


@cache
def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    low, high = (
        "".join(map(chr, range(0xD800))),
        "".join(map(chr, range(0xE000, 0x110000))),
    )
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for text, base in ((low, 0), (high, 0xE000)):
            for found in regex.finditer(pattern, text):
                out[base + found.start() : base + found.end()] = kind
    return out


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte place and code point of every character of valid UTF-8."""
    place = np.flatnonzero((buf & 0xC0) != 0x80)
    lead = buf[place]
    points = lead.astype(np.int32)
    if len(place) == len(buf):
        return place, points
    padded = np.concatenate([buf, np.zeros(3, np.uint8)])
    for least, most, mask, extra in ((0xC0, 0xDF, 0x1F, 1), (0xE0, 0xEF, 0x0F, 2), (0xF0, 0xFF, 0x07, 3)):
        at = np.flatnonzero((lead >= least) & (lead <= most))
        point = (lead[at] & mask).astype(np.int32)
        for k in range(1, extra + 1):
            point = (point << 6) | (padded[place[at] + k] & 0x3F)
        points[at] = point
    return place, points


def pieces(buf: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte places at which a piece begins; no piece crosses one of the ascending bounds."""
    place, points = code_points(buf)
    n = len(place)
    if not n:
        return np.empty(0, np.int64)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)
    edges = np.searchsorted(place, np.unique(bounds[bounds < len(buf)]))
    first[edges] = True
    first[[0, n]] = True
    before = np.concatenate([[0], kind[:-1]]).astype(np.uint8)
    before[first[:n]] = 0
    after = np.concatenate([kind[1:], [0]]).astype(np.uint8)
    after[first[1:]] = 0
    blank = kind == SPACE
    after_blank = np.zeros(n, bool)
    after_blank[1:] = points[:-1] == 0x20
    after_blank &= before != 0
    start = np.where(blank, (before != SPACE) | ((after != SPACE) & (after != 0)), ~after_blank & (before != kind))

    quotes = np.flatnonzero((points == 0x27) & start)
    if len(quotes):
        ahead = np.concatenate([points, [0, 0, 0]])
        limit = np.flatnonzero(first)
        room = limit[np.searchsorted(limit, quotes, "right")] - quotes
        one, two = ahead[quotes + 1], ahead[quotes + 2]
        short = (room >= 2) & np.isin(one, [ord(c) for c in "stmd"])
        long = (room >= 3) & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
        for at, size in ((quotes[short], 2), (quotes[long], 3)):
            for k in range(1, size):
                start[at + k] = False
            end = at + size
            start[end[(end < n) & (end < limit[np.searchsorted(limit, at, "right")])]] = True
    return place[start]


def special_cuts(buf: np.ndarray, special: tuple[bytes, ...]) -> list[tuple[int, int]]:
    """Spans of special strings, from left to right, without overlap."""
    if not special:
        return []
    pattern = regex.compile(b"|".join(regex.escape(s, special_only=True) for s in sorted(special, key=len, reverse=True)))
    return [m.span() for m in pattern.finditer(buf.tobytes())]


def segments(buf: np.ndarray, bounds: np.ndarray, special: tuple[bytes, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(bounds of texts cut further at special strings, spans of those strings that lie in one text)."""
    spans = np.array(special_cuts(buf, special), np.int64).reshape(-1, 2)
    if len(spans):
        inside = np.searchsorted(bounds, spans[:, 0], "right") == np.searchsorted(bounds, spans[:, 1], "left")
        spans = spans[inside]
    return np.unique(np.concatenate([bounds, spans.ravel()])), spans
