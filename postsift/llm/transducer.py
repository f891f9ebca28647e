"""Token counts by a tokenizer compiled into a finite-state transducer.

Inside a piece the transducer reads bytes. Its state is what later bytes can depend on:
the longest suffix that begins some token, and for each place inside that suffix the last
token of the encoding that ends there with its count. A byte moves it to the next state
and emits the change of the token count. States are compiled when first met.

A buffer is cut into chunks of equal length that are run side by side, one numpy step per
byte column. Each chunk is a map from the state it is entered in to the state it is left in
and the tokens it emits. Where a piece begins inside a chunk, the state it is left in is
the same for all; what it emits ahead of that beginning waits for its entry. A chunk that
runs on throughout has a table of entries. Its entries are guessed by starting anew at a few
places near the end of the chunk before, since encodings soon fall into step, and chunks of
the same bytes share one table. The tables are composed pairwise upwards and the true
states handed downwards, which takes a logarithm of steps; a state that was not guessed is
run as well and the scan repeated, so guesses cost time only and never change a count.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.llm.pretokens import pieces, segments
from postsift.llm.texthash import text_slices

#: Bytes of a chunk.
CHUNK = 256
#: Places at which the end of a chunk is started anew to guess what state it is left in, and the bytes after the last.
GUESSES, LEAD = 8, 40
#: Compiled states kept at once; beyond it compilation starts anew, which costs time only.
MOST_STATES = 250_000

ROOT, WAITING = 0, 1
#: More than any state number; a chunk and a state make one number.
BASE = np.int64(1) << 32


def byte_alphabet() -> dict[str, int]:
    """The printable character by which byte-level vocabularies write each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Tokens, merges and special strings of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_alphabet()
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = tuple(t["content"].encode() for t in spec["added_tokens"])
        named = {t["content"] for t in spec["added_tokens"]}
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in named}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
        #: What some longer token begins with.
        self.prefixes = {t[:k] for t in self.ids for k in range(1, len(t))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}

    def encode(self, piece: bytes) -> list[bytes]:
        """Tokens of one piece, merge by merge."""
        parts = [piece[k : k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            ranks = [self.ranks.get(pair, 1 << 30) for pair in zip(parts, parts[1:], strict=False)]
            least = min(ranks)
            if least == 1 << 30:
                break
            k = ranks.index(least)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def follows(self, before: bytes, token: bytes) -> bool:
        """Whether `token` can come right after `before` (empty at the start) in an encoding."""
        known = self.pairs.get((before, token))
        if known is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            known = self.encode(before + token) == ([before, token] if before else [token])
            self.pairs[before, token] = known
        return known


class Transducer:
    """Transitions over bytes with the change of the token count on each."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        #: Column of every byte in the tables, given out as bytes are met; most never are.
        self.column, self.bytes, self.width = np.full(256, -1, np.int32), [], 128
        self.restart()

    def restart(self) -> None:
        # A state: the suffix, and for 0 .. len(suffix) bytes back (last token, count less the present
        # one), or None where no token can begin.
        self.states = [(b"", ((b"", 0),)), None]
        self.numbers = {self.states[0]: ROOT}
        self.next = np.full(4096 * self.width, -1, np.int32)
        self.emits = np.zeros(4096 * self.width, np.int8)
        self.next[WAITING * self.width : (WAITING + 1) * self.width] = WAITING

    def columns_of(self, buf: np.ndarray) -> np.ndarray:
        """The buffer as columns of the tables."""
        for byte in np.flatnonzero((np.bincount(buf, minlength=256) > 0) & (self.column < 0)):
            if len(self.bytes) == self.width:
                self.width = 256
                self.restart()
            self.column[byte] = len(self.bytes)
            self.bytes.append(bytes([byte]))
        return self.column.astype(np.uint8)[buf]

    def compile(self, at: int) -> None:
        state, column = divmod(at, self.width)
        suffix, ends = self.states[state]
        grown = suffix + self.bytes[column]
        vocabulary = self.vocabulary
        for size in range(len(grown), 0, -1):
            token, before = grown[len(grown) - size :], ends[size - 1]
            if before is not None and token in vocabulary.ids and vocabulary.follows(before[0], token):
                break
        else:
            raise ValueError("the vocabulary lacks a byte")
        change = before[1] + 1
        begun = [k for k in range(1, len(grown) + 1) if grown[len(grown) - k :] in vocabulary.prefixes]
        keep = begun[-1] if begun else 0
        known = [(t, c - change) if k + 1 in begun else None for k, (t, c) in enumerate(e or (b"", 0) for e in ends[:keep])]
        new = ((token, 0), *known)
        key = (grown[len(grown) - keep :], new)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            if number * self.width >= len(self.next):
                self.next = np.concatenate([self.next, np.full(len(self.next), -1, np.int32)])
                self.emits = np.concatenate([self.emits, np.zeros(len(self.emits), np.int8)])
        self.next[at] = number
        self.emits[at] = change

    def step(self, states: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and emitted changes for one byte (as a column of the tables) in every lane."""
        at = states * self.width + column
        after = self.next[at]
        if after.min(initial=0) < 0:
            for key in np.unique(at[after < 0]):
                self.compile(int(key))
            after = self.next[at]
        return after, self.emits[at]

    def changes(self, buf: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The change of the token count at every byte; begins: a piece begins here."""
        if len(self.states) > MOST_STATES:
            self.restart()
        lanes = -(-len(buf) // CHUNK)
        bytes_ = np.zeros((lanes, CHUNK), np.uint8)
        bytes_.ravel()[: len(buf)] = self.columns_of(buf)
        goes_on = np.zeros((lanes, CHUNK), bool)
        goes_on.ravel()[: len(buf)] = ~begins
        columns, runs_on = np.ascontiguousarray(bytes_.T), np.ascontiguousarray(goes_on.T)
        out = np.zeros((CHUNK, lanes), np.int16)

        state = np.full(lanes, WAITING, np.int32)
        for j in range(CHUNK):
            state, out[j] = self.step(state * runs_on[j], columns[j])

        # Heads: bytes ahead of a lane's first beginning, in the state the lane is entered in. No text
        # ends inside a head, so what it emits may stand at its first byte.
        head = np.where(goes_on.all(axis=1), CHUNK, goes_on.argmin(axis=1))
        entered = np.concatenate([[ROOT], state[:-1]]).astype(np.int32)
        through = np.flatnonzero(head == CHUNK)
        if len(through):
            left, out[0, through] = self.scan(columns, through, entered)
            after = through + 1 < lanes
            entered[through[after] + 1] = left[after]
        ahead = np.flatnonzero((head > 0) & (head < CHUNK))
        _, out[0, ahead] = self.run(entered[ahead], columns, ahead, head[ahead])
        return out.T.ravel()[: len(buf)]

    def run(self, states: np.ndarray, columns: np.ndarray, of: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after the first `sizes` bytes of the lanes `of`, and what is emitted on the way."""
        states, total = states.astype(np.int32), np.zeros(len(states), np.int64)
        live = np.arange(len(states))
        for j in range(int(sizes.max(initial=0))):
            live = live[sizes[live] > j]
            states[live], emitted = self.step(states[live], columns[j, of[live]])
            total[live] += emitted
        return states, total

    def scan(self, columns: np.ndarray, lanes: np.ndarray, entered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State in which each of the ascending `lanes` is left, and what it emits; a piece begins in none of them.

        `entered` holds for the lane right after one that is not listed the state it is entered in.
        """
        first = np.diff(lanes, prepend=-2) > 1
        run_starts = np.flatnonzero(first)
        run_of = np.cumsum(first) - 1
        place = np.arange(len(lanes)) - run_starts[run_of]
        room = np.diff(run_starts, append=len(lanes))[run_of] - place
        _, example, kind = np.unique(np.ascontiguousarray(columns[:, lanes].T), axis=0, return_index=True, return_inverse=True)
        example = lanes[example]

        # Tables of chunks: number of (kind of chunk, entry) -> state it is left in, tokens.
        guesses = np.empty((GUESSES, len(example)), np.int64)
        for k in range(GUESSES):
            size = LEAD + k
            guesses[k], _ = self.run(np.full(len(example), ROOT), columns[CHUNK - size :], example, np.full(len(example), size))
        later = np.flatnonzero(~first)
        wanted = [kind[first] * BASE + entered[lanes[first]], (kind[later] * BASE + guesses[:, kind[later - 1]]).ravel()]
        keys, left, tokens = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64)
        while True:
            new = np.unique(np.concatenate(wanted))
            ends, emitted = self.run(new % BASE, columns, example[new // BASE], np.full(len(new), CHUNK))
            order = np.argsort(np.concatenate([keys, new]))
            keys = np.concatenate([keys, new])[order]
            left = np.concatenate([left, ends])[order]
            tokens = np.concatenate([tokens, emitted])[order]

            at = np.where(first, entered[lanes], -1).astype(np.int64)
            for (node, ends), size in zip(*composed(keys, left, kind, place, room), strict=True):
                here = np.flatnonzero((place % (2 * size) == 0) & (room > size) & (at >= 0))
                row, found = sought(node, here * BASE + at[here])
                at[here[found] + size] = ends[row[found]]
            known = np.flatnonzero(at >= 0)
            row, found = sought(keys, kind[known] * BASE + at[known])
            if found.all():
                return left[row], tokens[row]
            wanted = [(kind[known] * BASE + at[known])[~found]]


def sought(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of every wanted number among the ascending keys, whether it is there)."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    row = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return row, keys[row] == wanted


def composed(keys: np.ndarray, left: np.ndarray, kind: np.ndarray, place: np.ndarray, room: np.ndarray) -> tuple[list, list]:
    """Maps of 1, 2, 4, ... chunks in a row as ((chunk, entry) ascending, state after), the longest first, and those lengths.

    Maps begin at every place of a run that their length divides and end within the run.
    """
    begin, end = np.searchsorted(keys, kind * BASE), np.searchsorted(keys, (kind + 1) * BASE)
    chunk = np.repeat(np.arange(len(kind)), end - begin)
    row = np.arange(len(chunk)) - np.repeat(np.cumsum(end - begin) - (end - begin) - begin, end - begin)
    maps, sizes = [(chunk * BASE + keys[row] % BASE, left[row])], [1]
    while True:
        (node, ends), size = maps[-1], sizes[-1]
        chunk = node // BASE
        longer = (place[chunk] % (2 * size) == 0) & (room[chunk] >= 2 * size)
        if not longer.any():
            return maps[::-1], sizes[::-1]
        row, found = sought(node, (chunk[longer] + size) * BASE + ends[longer])
        maps.append((node[longer][found], ends[row[found]]))
        sizes.append(2 * size)


@cache
def compiled(path: str) -> Transducer:
    """One transducer per worker process and file."""
    return Transducer(Vocabulary(path))


def count_tokens(buf: np.ndarray, bounds: np.ndarray, transducer: Transducer) -> np.ndarray:
    """Tokens of every text between `bounds`."""
    cuts, special = segments(buf, bounds, transducer.vocabulary.special)
    begins = np.zeros(len(buf), bool)
    begins[pieces(buf, cuts)] = True
    emitted = transducer.changes(buf, begins).astype(np.int64) if len(buf) else np.empty(0, np.int64)
    for start, end in special:
        emitted[start:end] = 0
        emitted[start] = 1
    sums = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(emitted, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def token_counts(docs: DataFrame, *, path: str, text: str = "text", limit: int = 512, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` with n_bytes, n_tokens and over_limit of every whole text.

    One pass without a shuffle; the file at `path` must be readable on every executor. A
    text is taken whole, with some 25 bytes of arrays for each of its own. A null text counts as empty: no bytes, no tokens. Special strings inside a text count as
    one token each, as the tokenizer's default has it. Rows are counted one by one, so
    repeated rows get equal counts; other columns are not read.
    """
    rows: list[Column] = [docs[f"`{c}`"] for c in keep]
    chosen = docs.select(*rows, docs[f"`{text}`"].alias("llm_text"))
    schema = chosen.drop("llm_text").schema.add("n_bytes", "long").add("n_tokens", "long")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(path)
        for batch in batches:
            sizes, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for _, _, buf, bounds in text_slices(batch.column(len(keep))):
                sizes.append(np.diff(bounds))
                counts.append(count_tokens(buf, bounds, transducer))
            new = [pa.array(np.concatenate(sizes)), pa.array(np.concatenate(counts))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *new], schema.names)

    return chosen.mapInArrow(counted, schema).withColumn("over_limit", F.col("n_tokens") > limit)
