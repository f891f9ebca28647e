"""Packing tokenized documents into sequences by the sum-of-squares rule.

Documents arrive one after the other. A document longer than a sequence first fills whole
sequences; what is left of it goes into a partly filled sequence of the level that makes the
sum over all levels of (number of sequences filled that far) squared smallest. That keeps
all levels in stock, so later documents find a gap of their size.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from postsift.llm.pretokens import pieces, segments
from postsift.llm.texthash import span_hashes, text_slices

#: Pieces whose ids a worker keeps; beyond it the memory starts anew, which costs time only.
MOST_PIECES = 500_000
#: Partly filled sequences that are kept open; beyond it they are closed by cutting documents.
MOST_OPEN = 4096


class PieceEncoder:
    """Ids of whole buffers: each distinct piece goes to the tokenizer once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.restart()

    def restart(self) -> None:
        self.known: dict[int, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.bounds = np.zeros(1 << 16, np.int64)

    def learn(self, keys: list[int], texts: list[str]) -> None:
        for key, got in zip(keys, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            n = len(self.known)
            if n + 2 > len(self.bounds):
                self.bounds = np.concatenate([self.bounds, np.zeros(len(self.bounds), np.int64)])
            begin = int(self.bounds[n])
            end = begin + len(got.ids)
            while end > len(self.flat):
                self.flat = np.concatenate([self.flat, np.empty(len(self.flat), np.uint32)])
            self.flat[begin:end] = got.ids
            self.bounds[n + 1] = end
            self.known[key] = n

    def encode(self, buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the bounds of each text's ids."""
        if len(self.known) > MOST_PIECES:
            self.restart()
        cuts, special = segments(buf, bounds, self.special)
        starts = pieces(buf, cuts)
        ends = np.append(starts[1:], len(buf))
        if len(special):
            span = np.searchsorted(special[:, 0], starts, "right") - 1
            inside = (span >= 0) & (starts < special[np.maximum(span, 0), 1])
            whole = inside & (starts == special[np.maximum(span, 0), 0])
            ends = np.where(whole, special[np.maximum(span, 0), 1], ends)
            starts, ends = starts[~inside | whole], ends[~inside | whole]
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(bounds), np.int64)
        codes, distinct = pd.factorize(span_hashes(buf, starts, ends))
        keys = distinct.tolist()
        new = [k for k, key in enumerate(keys) if key not in self.known]
        if new:
            first = np.empty(len(keys), np.int64)
            first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
            texts = [buf[starts[first[k]] : ends[first[k]]].tobytes().decode() for k in new]
            self.learn([keys[k] for k in new], texts)
        number = np.array([self.known[key] for key in keys])[codes]
        begin, size = self.bounds[number], self.bounds[number + 1] - self.bounds[number]
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        ids = self.flat[np.repeat(begin - total[:-1], size) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, bounds)]


@cache
def encoder(path: str) -> PieceEncoder:
    """One per worker process and file."""
    return PieceEncoder(path)


class Packer:
    """Sequences of one stream of documents. A piece is (document, its ids before, ids)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.level = np.zeros(capacity + 1, np.int64)  # partly filled sequences by fill
        self.open: dict[int, list[list[tuple]]] = {}
        self.closed: list[list[tuple]] = []

    def add(self, document, ids: np.ndarray) -> None:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self.closed.append([(document, start, ids[start : start + self.capacity])])
        if whole < len(ids):
            self.place([(document, whole, ids[whole:])], len(ids) - whole)

    def place(self, pieces: list[tuple], size: int) -> None:
        """Into the level with the smallest sum of squares after it; the fullest one of equals."""
        fit = self.capacity - size
        after = self.level[size:].copy() * 2 + 1
        after[-1] = 0
        change = after - 2 * self.level[: fit + 1] + 1
        change[0] = after[0]
        change[1:][self.level[1 : fit + 1] == 0] = np.iinfo(np.int64).max
        best = fit - int(np.argmin(change[::-1]))
        sequence = []
        if best:
            sequence = self.open[best].pop()
            self.level[best] -= 1
        sequence.extend(pieces)
        if best + size == self.capacity:
            self.closed.append(sequence)
        else:
            self.open.setdefault(best + size, []).append(sequence)
            self.level[best + size] += 1
            if self.level.sum() > MOST_OPEN:
                self.close()

    def close(self, end: bool = False) -> None:
        """Fill the open sequences up, fullest first, by cutting documents of the emptiest.

        The rest that fills no sequence stays open; at the end it goes into sequences of
        powers of two, which need no padding.
        """
        left = [p for fill in sorted(self.open, reverse=True) for sequence in self.open[fill] for p in sequence]
        self.open, self.level = {}, np.zeros(self.capacity + 1, np.int64)
        rest = sum(len(ids) for _, _, ids in left)
        room, sequence = 0, []
        for document, start, ids in left:
            while len(ids):
                if not room:
                    if rest >= self.capacity:
                        room = self.capacity
                    else:
                        room = 1 << (rest.bit_length() - 1) if end else rest
                    sequence, wanted = [], room
                taken = ids[:room]
                sequence.append((document, start, taken))
                start, ids = start + len(taken), ids[len(taken) :]
                room, rest = room - len(taken), rest - len(taken)
                if not room:
                    if wanted == self.capacity or end:
                        self.closed.append(sequence)
                    else:
                        self.open[wanted] = [sequence]
                        self.level[wanted] = 1

    def take(self) -> list[list[tuple]]:
        out, self.closed = self.closed, []
        return out


def pack(docs: DataFrame, *, path: str, capacity: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset and `ids`.

    `ids` holds the piece's token ids as little-endian unsigned 32-bit numbers. Every
    document ends with `end_id`; a null or empty text is that id alone. Each row of `docs`
    is a document of its own, also when it repeats a doc_id. A sequence is full or has a
    power of two of ids, so nothing is padded. No rows give no pieces. Other columns are
    not read.

    Each partition of the scan is one online stream with a level array of its own and
    leaves at most as many short sequences as `capacity` has bits. There is no shuffle; a
    sequence is named by its partition and its place there, so a repeated task names alike.
    """
    chosen = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"

    def rows(sequences: list[list[tuple]], first: int, names: list[str], key: pa.DataType) -> pa.RecordBatch:
        docs_, start, length, tokens, sequence, offset, ids = [], [], [], [], [], [], []
        for k, content in enumerate(sequences):
            place = 0
            for (doc, total), begin, part in content:
                docs_.append(doc)
                start.append(begin)
                length.append(len(part))
                tokens.append(total)
                sequence.append(first + k)
                offset.append(place)
                ids.append(part.astype("<u4").tobytes())
                place += len(part)
        longs = [pa.array(x, pa.int64()) for x in (start, length, tokens, sequence, offset)]
        return pa.RecordBatch.from_arrays([pa.array(docs_, key), *longs, pa.array(ids, pa.binary())], names)

    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 40
        packer, key = Packer(capacity), pa.int64()
        for batch in batches:
            key, doc_ids = batch.column(0).type, batch.column(0).to_pylist()
            for i, j, buf, bounds in text_slices(batch.column(1)):
                ids, cuts = encoder(path).encode(buf, bounds)
                for k in range(i, j):
                    own = np.append(ids[cuts[k - i] : cuts[k - i + 1]], np.uint32(end_id))
                    packer.add((doc_ids[k], len(own)), own)
                done = packer.take()
                if done:
                    yield rows(done, number, names, key)
                    number += len(done)
        packer.close(end=True)
        done = packer.take()
        if done:
            yield rows(done, number, names, key)
        # The worker goes on with other tasks, maybe of other stages.
        encoder(path).restart()

    return chosen.mapInArrow(packed, schema)
