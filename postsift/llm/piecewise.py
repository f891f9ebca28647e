"""SentencePiece encoding and decoding with merge-type vocabularies.

A text is cut where no piece of the vocabulary joins two neighbouring characters, so what lies
between two cuts is encoded by itself and equal segments are encoded once. A segment keeps an
agenda of its adjacent symbol pairs ordered by the score of the merged piece, ties by place;
the best pair is merged and its two neighbours enter the agenda anew, until none is left. Short
segments run in step, one numpy operation for all of them; long ones use a heap. Characters
without a piece become byte pieces. Every segment is compared with the sentencepiece library
when it is first met in an Arrow batch.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

#: The library's mark of white space, a fixed value.
MARK = "▁"
#: Symbols of the longest segment that runs in step with others; longer ones use a heap.
STEP_SYMBOLS = 32
#: Segments that are merged in step at once.
STEP_ROWS = 1 << 14
#: Segments whose ids are remembered; beyond it a worker starts anew, which costs time only.
MOST_SEGMENTS = 1 << 20
#: Longer segments are not remembered.
LONGEST_KEPT = 256
#: Texts are taken in slices of about so many characters.
SLICE_CHARS = 1 << 20

NONE = np.iinfo(np.int32).max


def _each_byte(error: UnicodeError):
    """One replacement character for every byte that is no UTF-8, as the library has it."""
    return "�" * (error.end - error.start), error.end


codecs.register_error("llm-each-byte", _each_byte)


class Vocabulary:
    """Pieces, scores and byte pieces of a model file of merge type.

    Symbols are numbered: pieces by their id, other characters of pieces after them, and any
    other character c as -1 - ord(c).
    """

    def __init__(self, path: str):
        self.library = model = SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        kinds = [(model.is_byte(i), model.is_control(i) or model.is_unknown(i), model.is_unused(i)) for i in range(n)]
        names = [model.id_to_piece(i) for i in range(n)]
        if any(unused for _, _, unused in kinds):
            raise ValueError("vocabularies with unused pieces are not supported")
        if model.normalize("   ﬁ́  ") != MARK + "   ﬁ́  ".replace(" ", MARK):
            raise ValueError("vocabularies that normalise texts are not supported")
        self.end = model.eos_id()
        self.byte = {int(names[i][3:5], 16): i for i in range(n) if kinds[i][0]}
        if len(self.byte) != 256:
            raise ValueError("the vocabulary needs a piece for every byte")
        self.byte_ids = frozenset(self.byte.values())
        self.control = frozenset(i for i in range(n) if kinds[i][1])
        self.pieces = {names[i]: i for i in range(n) if not (kinds[i][0] or kinds[i][1])}
        scores = sorted({model.get_score(i) for i in self.pieces.values()}, reverse=True)
        place = {s: k for k, s in enumerate(scores)}
        self.rank = {p: place[model.get_score(i)] for p, i in self.pieces.items()}
        self.surface = [bytes([int(names[i][3:5], 16)]) if kinds[i][0] else b"" if i in self.control else names[i].replace(MARK, " ").encode() for i in range(n)]

        #: Neighbours inside a piece; a text is cut between any others.
        self.joined = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        self.by_words = not any(pair[1] == MARK and pair[0] != MARK for pair in self.joined)
        letters = sorted({c for p in self.pieces for c in p} - self.pieces.keys())
        number = self.pieces | {c: n + k for k, c in enumerate(letters)}
        self.n_symbols = n + len(letters)
        single = {ord(s): k for s, k in number.items() if len(s) == 1}
        self.known_chars = np.array(sorted(single), np.int64)
        self.char_symbols = np.array([single[c] for c in sorted(single)], np.int64)
        merges = {}
        for piece, rank in self.rank.items():
            for k in range(1, len(piece)):
                left, right = number.get(piece[:k]), number.get(piece[k:])
                if left is not None and right is not None:
                    merges[left * self.n_symbols + right] = (rank, self.pieces[piece])
        self.pairs = np.array(sorted(merges), np.int64)
        self.pair_rank = np.array([merges[k][0] for k in sorted(merges)], np.int32)
        self.pair_piece = np.array([merges[k][1] for k in sorted(merges)], np.int64)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """The symbol of every character."""
        at = np.minimum(np.searchsorted(self.known_chars, codes), len(self.known_chars) - 1)
        return np.where(self.known_chars[at] == codes, self.char_symbols[at], -1 - codes)

    def merged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the piece that two symbols make (NONE without one), and its place in the table."""
        key = left * self.n_symbols + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.pair_rank[at], NONE), at

    def ids_of(self, symbols: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of final symbols with the bounds of every row; a symbol without a piece becomes its bytes."""
        strange = np.flatnonzero((symbols < 0) | (symbols >= len(self.surface)))
        if len(strange):
            by_number = {int(s): chr(int(c)) for c, s in zip(self.known_chars, self.char_symbols, strict=True)}
            sizes, spelled = np.ones(len(symbols), np.int64), []
            for k in strange:
                s = int(symbols[k])
                raw = (chr(-1 - s) if s < 0 else by_number[s]).encode("utf-8", "surrogatepass")
                spelled.append([self.byte[b] for b in raw])
                sizes[k] = len(raw)
            ends = np.cumsum(sizes)
            out = np.repeat(symbols, sizes)
            for k, ids in zip(strange, spelled, strict=True):
                out[ends[k] - len(ids) : ends[k]] = ids
            symbols, rows = out, np.repeat(rows, sizes)
        bounds = np.zeros(n_rows + 1, np.int64)
        np.cumsum(np.bincount(rows, minlength=n_rows), out=bounds[1:])
        return symbols.astype(np.int32), bounds

    def in_step(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and bounds of segments of at most STEP_SYMBOLS characters, one merge each a step."""
        n = len(segments)
        sizes = np.fromiter(map(len, segments), np.int64, n)
        width = int(sizes.max())
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        inside = np.arange(width) < sizes[:, None]
        sym = np.zeros((n, width + 1), np.int64)
        sym[:, :width][inside] = self.symbols(codes)
        alive = np.zeros((n, width + 1), bool)
        alive[:, :width] = inside
        after = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
        before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
        agenda = np.full((n, width + 1), NONE, np.int32)
        pair = inside[:, 1:] if width > 1 else np.zeros((n, 0), bool)
        r, c = np.nonzero(pair)
        agenda[r, c] = self.merged(sym[r, c], sym[r, c + 1])[0]
        rows = np.arange(n)
        while len(rows):
            best = agenda[rows].argmin(axis=1)  # the leftmost of equal ranks
            found = agenda[rows, best] < NONE
            rows, best = rows[found], best[found]
            if not len(rows):
                break
            right = after[rows, best]
            at = self.merged(sym[rows, best], sym[rows, right])[1]
            sym[rows, best] = self.pair_piece[at]
            alive[rows, right] = False
            agenda[rows, right] = NONE
            following = after[rows, right]
            after[rows, best] = following
            more = following < sizes[rows]
            before[rows[more], following[more]] = best[more]
            agenda[rows, best] = NONE
            r, p, q = rows[more], best[more], following[more]
            agenda[r, p] = self.merged(sym[r, p], sym[r, q])[0]
            p = before[rows, best]
            more = p >= 0
            r, p, q = rows[more], p[more], best[more]
            agenda[r, p] = self.merged(sym[r, p], sym[r, q])[0]
        r, c = np.nonzero(alive)
        return self.ids_of(sym[r, c], r, n)

    def by_heap(self, segment: str) -> np.ndarray:
        """Ids of one segment of any length."""
        rank, n = self.rank, len(segment)
        symbols: list[str | None] = list(segment)
        after, before = np.arange(1, n + 1).tolist(), np.arange(-1, n - 1).tolist()
        agenda = [r << 40 | k for k in range(n - 1) if (r := rank.get(segment[k : k + 2])) is not None]
        heapify(agenda)
        while agenda:
            key = heappop(agenda)
            at, wanted = key & (1 << 40) - 1, key >> 40
            left, right = symbols[at], after[at]
            if left is None or right == n:
                continue
            both = left + symbols[right]
            if rank.get(both) != wanted:
                continue  # one of the two was merged meanwhile
            symbols[at], symbols[right] = both, None
            following = after[at] = after[right]
            if following < n:
                before[following] = at
                if (r := rank.get(both + symbols[following])) is not None:
                    heappush(agenda, r << 40 | at)
            if (previous := before[at]) >= 0 and (r := rank.get(symbols[previous] + both)) is not None:
                heappush(agenda, r << 40 | previous)
        ids: list[int] = []
        for s in symbols:
            if s is not None:
                known = self.pieces.get(s)
                ids += [known] if known is not None else [self.byte[b] for b in s.encode("utf-8", "surrogatepass")]
        return np.array(ids, np.int32)

    def segments(self, text: str) -> list[str]:
        """`text` with its mark in front, cut where no piece joins two neighbours; nothing for no text."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        parts = WORDS.findall(marked) if self.by_words else [marked]
        if max(map(len, parts)) <= STEP_SYMBOLS:
            return parts
        out = []
        for part in parts:
            if len(part) <= STEP_SYMBOLS:
                out.append(part)
                continue
            begin = 0
            for k in range(1, len(part)):
                if part[k - 1 : k + 1] not in self.joined:
                    out.append(part[begin:k])
                    begin = k
            out.append(part[begin:])
        return out


WORDS = re.compile(f"{MARK}+[^{MARK}]*")


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Numbers(dict):
    """A number for every segment; those that get one are listed in `new`."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, segment: str) -> int:
        self.new.append(segment)
        number = self[segment] = len(self)
        return number


class Encoder:
    """Encodes texts; remembers the ids of segments it has met, and whether the library agreed."""

    def __init__(self, vocabulary: Vocabulary, checked: bool = True):
        self.vocabulary, self.checked = vocabulary, checked
        self.forget()

    def forget(self) -> None:
        self.number = Numbers()
        self.starts, self.sizes, self.agrees = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        self.ids = np.empty(0, np.int32)

    def agreed(self, segments: list[str], ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the library gives every segment the same ids.

        The library puts a mark in front of a text. A segment without one (cut inside a word) is
        compared behind a new line, which no piece joins to anything. A lone mark is the
        library's empty text.
        """
        n = len(segments)
        if not self.checked:
            return np.ones(n, bool)
        library = self.vocabulary.library
        lead = library.encode("\n")
        given = library.encode([s[1:] if s[0] == MARK else "\n" + s for s in segments], num_threads=1)
        for k, s in enumerate(segments):
            if s == MARK:
                given[k] = library.encode("\n" + MARK)[len(lead) :]
            elif s[0] != MARK:
                given[k] = given[k][len(lead) :]
        lengths = np.fromiter(map(len, given), np.int64, n)
        out = lengths == sizes
        owner = np.repeat(np.arange(n), sizes)
        flat = np.fromiter(chain.from_iterable(g if same else [-1] * int(size) for g, same, size in zip(given, out, sizes, strict=True)), np.int32, len(ids))
        out[owner[flat != ids]] = False
        return out

    def learn(self, new: list[str]) -> None:
        """Encode segments not met before; they follow those known in this order."""
        order = sorted(range(len(new)), key=lambda k: len(new[k]))
        ids, sizes, agrees = [], [], []
        at = 0
        while at < len(order):
            part = [new[k] for k in order[at : at + STEP_ROWS]]
            if len(part[0]) > STEP_SYMBOLS:
                part = part[:1]
                own = self.vocabulary.by_heap(part[0])
                bounds = np.array([0, len(own)])
            else:
                part = [s for s in part if len(s) <= STEP_SYMBOLS]
                own, bounds = self.vocabulary.in_step(part)
            ids.append(own)
            sizes.append(np.diff(bounds))
            agrees.append(self.agreed(part, own, sizes[-1]))
            at += len(part)
        size = np.empty(len(new), np.int64)
        start, agree = np.empty(len(new), np.int64), np.empty(len(new), bool)
        size[order] = found = np.concatenate(sizes)
        start[order] = np.cumsum(found) - found + len(self.ids)
        agree[order] = np.concatenate(agrees)
        self.starts, self.sizes = np.concatenate([self.starts, start]), np.concatenate([self.sizes, size])
        self.agrees, self.ids = np.concatenate([self.agrees, agree]), np.concatenate([self.ids, *ids])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts with the end id, the bounds of every text, and whether the library agreed."""
        n = len(texts)
        if len(self.number) > MOST_SEGMENTS:
            self.forget()
        cut = [self.vocabulary.segments(t) for t in texts]
        counts = np.fromiter(map(len, cut), np.int64, n)
        n_used = int(counts.sum())
        used = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, n_used)
        new, self.number.new = self.number.new, []
        if new:
            self.learn(new)
        owner = np.repeat(np.arange(n), counts)
        sizes = self.sizes[used]
        ends = np.cumsum(sizes)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, sizes, n).astype(np.int64) + 1)])
        ids = np.full(int(bounds[-1]), self.vocabulary.end, np.int32)
        open_places = np.ones(len(ids), bool)
        open_places[bounds[1:] - 1] = False
        ids[open_places] = self.ids[np.arange(int(sizes.sum())) + np.repeat(self.starts[used] - (ends - sizes), sizes)]
        agrees = np.bincount(owner[~self.agrees[used]], minlength=n) == 0
        if any(len(s) > LONGEST_KEPT for s in new):
            self.forget()
        return ids, bounds, agrees


def spelled(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text of any ids, piece by piece: bytes make characters only within one run of byte pieces."""
    out, raw, at_start, dropped = [], bytearray(), True, False
    for i in [*ids, None]:
        if i in vocabulary.byte_ids:
            raw += vocabulary.surface[i]
            continue
        if raw:
            out.append(raw.decode("utf-8", "llm-each-byte"))
            raw.clear()
        if i is None:
            break
        at_start = at_start and not dropped and not out
        text = vocabulary.surface[i].decode()
        dropped = at_start and text.startswith(" ")
        if text[dropped:]:
            out.append(text[dropped:])
    return "".join(out)


def decode(ids: np.ndarray, bounds: np.ndarray, vocabulary: Vocabulary) -> list[str]:
    """The texts of ids, row by row.

    Control ids say nothing, a mark in front of the first piece is dropped, and every byte that
    makes no character becomes U+FFFD.
    """
    out, end, space = [], vocabulary.end, vocabulary.byte[0x20]
    for k in range(len(bounds) - 1):
        row = ids[bounds[k] : bounds[k + 1]].tolist()
        if row and row[-1] == end:
            row.pop()
        try:
            if vocabulary.control.isdisjoint(row):
                raw = b"".join(map(vocabulary.surface.__getitem__, row)).decode()
                out.append(raw[1:] if raw[:1] == " " and row[0] != space else raw)
                continue
        except UnicodeDecodeError:
            pass
        out.append(spelled(row, vocabulary))
    return out


def slices(texts: pa.Array) -> Iterator[list[str]]:
    """The texts of a batch (null: empty) in slices of about SLICE_CHARS characters, one text at least."""
    part, size = [], 0
    for text in texts:
        part.append(text.as_py() or "")
        size += len(part[-1])
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def with_pieces(docs: DataFrame, *, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), check: str | None = "segments") -> DataFrame:
    """The columns `keep` with ids (array, an end id last), decoded (the text of these ids) and library_agrees.

    One pass without a shuffle; the file at `path` must be readable on every executor. A null or
    empty text has the end id alone and decodes to an empty text. Texts are encoded whole and one
    by one, so repeated rows get equal results; other columns are not read. A text may be as
    long as a column holds: memory follows the text (about 60 bytes a character) and, for a
    segment without a cut, its agenda (about 200 bytes a character).

    `check`: "segments" compares every distinct segment of a worker with the library, "texts"
    every whole text with its ids and the library's decoding, None nothing (library_agrees is
    then null). The ids are always the agenda's.
    """
    if check not in ("segments", "texts", None):
        raise ValueError("check must be 'segments', 'texts' or None")
    chosen = docs.select(*(docs[f"`{c}`"] for c in keep), docs[f"`{text}`"].alias("llm_text"))
    schema = chosen.drop("llm_text").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string").add("library_agrees", "boolean")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        encoder = Encoder(known, check == "segments")
        for batch in batches:
            at = 0
            for texts in slices(batch.column(len(keep))):
                ids, bounds, agrees = encoder.encode(texts)
                decoded = decode(ids, bounds, known)
                if check == "texts":
                    given = known.library.encode(texts, add_eos=True, num_threads=1)
                    agrees = np.array([ids[a:b].tolist() == g and d == known.library.decode(g) for a, b, g, d in zip(bounds, bounds[1:], given, decoded, strict=False)], bool)
                listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
                told = pa.array(agrees) if check else pa.nulls(len(texts), pa.bool_())
                kept = [c.slice(at, len(texts)) for c in batch.columns[: len(keep)]]
                yield pa.RecordBatch.from_arrays([*kept, listed, pa.array(decoded, pa.string()), told], schema.names)
                at += len(texts)

    return chosen.mapInArrow(encoded, schema)
