"""Removal of repeated passages by suffix arrays.

A byte goes if it lies in a string of `width` bytes that also starts earlier. Equal strings
are brought together by a fingerprint that depends on nothing but the string (its least
hashed k-gram), so strings are only compared where a fingerprint is shared. The places with
the same fingerprint come with the bytes around them; equal surroundings are settled by
counting, and over the different ones that are left a suffix array is built by the
difference-cover algorithm: sort the triples at sampled places, recurse on their names,
merge the remaining suffixes, compare adjacent prefixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsift.llm.tables import settled, stored, with_row_key
from postsift.llm.texthash import BYTE_VALUES, _BASE, _INVERSE, mixed, powers, repeated, text_slices

#: Bytes of the k-gram that names a string.
GRAM = 24
#: Bytes put into one suffix array; three symbols of it fit into 63 bits.
ARRAY_BYTES = 1 << 20
#: Different surroundings of a fingerprint that are compared in one task; more are compared
#: string by string, by a sort on their hashes.
MOST_CONTEXTS = 4096
#: A fingerprint with more than one mark in HOT_SHARE is hot, so there are fewer than HOT_SHARE. Marks
#: are counted in chunks of at least HOT_CHUNK, or of a task.
HOT_SHARE, HOT_CHUNK = 10_000, 1 << 20
#: Shares of a string that is compared by its hash.
STRING_SHARES = 64
#: Symbols of one suffix array: the names of two thirds of them must fit into 21 bits. A group
#: that would not fit beside ARRAY_BYTES is compared string by string too.
MOST_SYMBOLS = 3_000_000


def suffix_order(symbols: np.ndarray, width: int) -> np.ndarray:
    """Places of `symbols` (from 1 on) ordered by at least the next `width` symbols."""
    n = len(symbols)
    if n > MOST_SYMBOLS:
        raise ValueError(f"a suffix array takes at most {MOST_SYMBOLS} symbols")
    size = -(-n // 3) * 3 + 3
    s = np.zeros(size + 3, np.int64)
    s[:n] = symbols
    sampled = np.concatenate([np.arange(1, size, 3), np.arange(2, size, 3)])
    triples = (s[sampled] << 42) | (s[sampled + 1] << 21) | s[sampled + 2]
    order = np.argsort(triples)
    ordered = triples[order]
    names = np.empty(len(sampled), np.int64)
    names[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
    if names.max() < len(sampled) and width > 3:
        # The names of the triples are a text a third as long to read; its order is theirs.
        order = suffix_order(names, -(-width // 3))
    rank = np.zeros(size + 4, np.int64)
    rank[sampled[order]] = np.arange(1, len(sampled) + 1)
    if not width > 3:
        rank[sampled] = names
    rest = np.arange(0, size, 3)
    rest_keys = (s[rest] << 21) | rank[rest + 1]
    rest = rest[np.argsort(rest_keys)]
    # Merge: where each sampled suffix comes among the rest, by symbols and a sampled rank.
    near = (s[rest] << 21) | rank[rest + 1]
    far = (s[rest] << 42) | (s[rest + 1] << 21) | rank[rest + 2]
    places = sampled[order]
    one = places % 3 == 1
    before = np.empty(len(places), np.int64)
    before[one] = np.searchsorted(near, (s[places[one]] << 21) | rank[places[one] + 1])
    two = places[~one]
    before[~one] = np.searchsorted(far, (s[two] << 42) | (s[two + 1] << 21) | rank[two + 2])
    before = np.maximum.accumulate(before)
    out = np.empty(size, np.int64)
    at = np.arange(len(places)) + before
    taken = np.zeros(size, bool)
    taken[at] = True
    out[at] = places
    out[~taken] = rest
    return out[out < n]


def repeats(buf: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of `starts` (in order of precedence) begin a string that an earlier one begins too."""
    precedence = np.full(len(buf), -1, np.int64)
    precedence[starts] = np.arange(len(starts))
    order = suffix_order(buf.astype(np.int64) + 1, width)
    order = order[precedence[order] >= 0]
    eight = np.zeros(len(buf), np.uint64)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k : k + len(buf)]
    same = np.ones(max(0, len(order) - 1), bool)
    offsets = [*range(0, width - 7, 8), width - 8] if width >= 8 else []
    for k in offsets:
        at = np.flatnonzero(same)
        same[at] = eight[order[at] + k] == eight[order[at + 1] + k]
    for k in range(width if width < 8 else 0):
        same &= buf[order[:-1] + k] == buf[order[1:] + k]
    begins = np.flatnonzero(np.concatenate([[True], ~same])) if len(order) else np.empty(0, np.int64)
    earliest = np.minimum.reduceat(precedence[order], begins) if len(order) else np.empty(0, np.int64)
    out = np.ones(len(starts), bool)
    out[earliest] = False
    return out


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbouring keys."""
    n = len(keys)
    if n < width:
        return np.empty(0, keys.dtype)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:n] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Hashed:
    """Prefix sums over a buffer that give the hash of any of its spans."""

    def __init__(self, buf: np.ndarray):
        self.inverse = powers(_INVERSE, len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[buf] * powers(_BASE, len(buf)), out=self.sums[1:])

    def every(self, width: int) -> np.ndarray:
        m = max(0, len(self.sums) - width)
        return mixed((self.sums[width:] - self.sums[:m]) * self.inverse[:m])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def gram_runs(hashed: Hashed, bounds: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(row, fingerprint, first string, place of the k-gram, last string), one per run of strings with one k-gram."""
    grams = hashed.every(GRAM)
    keys = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    place = (sliding_least(keys, width - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(len(place))
    row = np.searchsorted(bounds, start, "right") - 1
    whole = start + width <= bounds[row + 1]
    start, place, row = start[whole], place[whole], row[whole]
    if not len(start):
        return row, grams[:0].view(np.int64), start, place, start
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = start[np.append(new[1:] - 1, len(start) - 1)]
    return row[new], grams[place[new]].view(np.int64), start[new], place[new], last


def anchors(buf: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, fingerprint, surroundings, first string, place of the k-gram, last string), one per run of strings with one k-gram.

    Strings with the same k-gram follow each other; the surroundings are the hash of all
    bytes from the first of them to the end of the last, and of where the k-gram lies.
    """
    if len(buf) < width:
        return
    hashed = Hashed(buf)
    row, fp, first, place, last = gram_runs(hashed, bounds, width)
    if not len(row):
        return
    around = mixed(hashed.spans(first, last + width) ^ mixed((place - first).astype(np.uint64) << np.uint64(20) | (last - first).astype(np.uint64)))
    base = bounds[row]
    yield row, fp, around.view(np.int64), first - base, place - base, last - base


def hot_fingerprints(texts: DataFrame, width: int) -> np.ndarray:
    """Fingerprints of more than 1 / HOT_SHARE of all marks, sorted; surely those of more than 2 / HOT_SHARE.

    A chunk reports the fingerprints above the share among its own marks, so it withholds of any
    other no more than the share. What is reported is summed up; fewer than HOT_SHARE can pass.
    """

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def told() -> pa.RecordBatch:
            fps, counts = np.unique(np.concatenate(held), return_counts=True)
            at = np.flatnonzero(counts * HOT_SHARE > n)
            # The row without a fingerprint counts all marks of the chunk.
            return pa.RecordBatch.from_arrays([pa.array([None, *fps[at].tolist()], pa.int64()), pa.array([n, *counts[at].tolist()], pa.int64())], ["fp", "n"])

        for batch in batches:
            for _, _, buf, bounds in text_slices(batch.column(0)):
                if len(buf) >= width:
                    held.append(gram_runs(Hashed(buf), bounds, width)[1])
                    n += len(held[-1])
                if n >= HOT_CHUNK:
                    yield told()
                    held, n = [], 0
        if n:
            yield told()

    counted = settled(texts.select("text").mapInArrow(often, "fp bigint, n bigint").groupBy("fp").agg(F.sum("n").alias("n")))
    n = counted.where("fp IS NULL").agg(F.sum("n")).first()[0] or 0
    hot = counted.where(F.col("fp").isNotNull() & (F.col("n") > 1) & (F.col("n") * HOT_SHARE > n)).select("fp").collect()
    return np.sort(np.array([r["fp"] for r in hot], np.int64))


def repeated_passages(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = 100, keep: tuple[str, ...] = (), decoded: bool = False
) -> DataFrame:
    """doc_id, text, n_bytes, n_removed, n_spans, spans and kept for every document.

    Texts are UTF-8 bytes, null is empty. A byte is removed if it lies in a string of `width`
    bytes that also starts at a smaller doc_id, or earlier in the same document; all strings
    are judged on the input, and none crosses documents. `spans` lists the removed runs as
    (start, end), `kept` is what remains, in bytes; if `decoded`, it is a string without the
    characters of which a part was removed. Columns in `keep` pass through; they must not
    have the name of another one. A text shorter than `width` loses
    nothing. Rows that repeat a doc_id are documents of their own, in the order of the digests
    of their texts, with a row each in the result; null ids take no part. `width` is from 25 to
    65,559. Further columns are not read.

    Texts are dealt by doc_id once. What is moved besides is one narrow row per run of strings
    with the same k-gram (about one for 39 bytes), the bytes around those k-grams only that
    occur in different surroundings, and the runs to remove. A passage that a large part of all
    documents share has hot fingerprints, which are counted over all texts beforehand: their
    marks are dealt by fingerprint and surroundings, and their kinds are counted afterwards.
    """
    if not GRAM < width < GRAM + (1 << 16):
        raise ValueError(f"width must be from {GRAM + 1} to {GRAM + (1 << 16) - 1}")
    given = docs.select(docs[f"`{doc_id}`"].cast("bigint").alias("llm_id"), F.coalesce(docs[f"`{text}`"], F.lit("")).alias("text"), *[docs[f"`{c}`"] for c in keep])
    # Ids are counted first: where each is alone, texts need no sorting out.
    texts, unique = with_row_key(given, "llm_id", "text", "doc_id")
    texts = texts.select("doc_id", "text", *keep, *([] if unique else ["llm_id"]))
    most_contexts = min(MOST_CONTEXTS, (MOST_SYMBOLS - ARRAY_BYTES) // (2 * width))

    def marked(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = batch.column(0).to_numpy(zero_copy_only=False), []
            for i, j, buf, bounds in text_slices(batch.column(1)):
                for row, fp, around, *at in anchors(buf, bounds, width):
                    parts.append((fp, around, ids[i:j][row], *at))
            if not parts:
                continue
            fp, around, doc, first, place, last = (np.concatenate(c) for c in zip(*parts, strict=True))
            # Where the strings of a run start, relative to the first of them.
            at = first << 32 | place - first << 16 | last - first
            # What this batch has earlier is a repeat already; it is not dealt by its fingerprint.
            key = mixed(fp.view(np.uint64) ^ mixed(around.view(np.uint64)))
            told = np.flatnonzero(repeated(key))
            told = told[np.lexsort((at[told], doc[told], key[told]))]
            again = np.zeros(len(key), bool)
            again[told[1:]] = key[told[1:]] == key[told[:-1]]
            deal = np.where(again, mixed(doc.view(np.uint64) ^ mixed(at.view(np.uint64))).view(np.int64), fp)
            # A hot fingerprint is dealt with its surroundings, and named.
            often = ~again & np.isin(fp, hot)
            deal = np.where(often, key.view(np.int64), deal)
            columns = [pa.array(c) for c in (deal, around, doc, at, again)] + [pa.array(fp, mask=~often)]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["fp", "around", "doc_id", "at", "again", "hot"]

    def marks(hot: np.ndarray) -> DataFrame:
        schema = "fp bigint, around bigint, doc_id bigint, at bigint, again boolean, hot bigint"
        return texts.select("doc_id", "text").mapInArrow(lambda batches: marked(batches, hot), schema)

    # Dealt by one column alone, which serves both windows.
    packed = marks(hot_fingerprints(texts, width)).repartition("fp")
    by_fp, by_both = W.partitionBy("fp"), W.partitionBy("fp", "around").orderBy("doc_id", "at")
    numbered = packed.withColumn("copy", F.row_number().over(by_both))
    told = numbered.withColumn("kinds", F.sum((F.col("copy") == 1).cast("int")).over(by_fp)).where("again OR copy > 1 OR kinds > 1 OR hot IS NOT NULL")
    # Settled, so that the marks of all texts are dealt once.
    first = ~F.col("again") & (F.col("copy") == 1)
    fingerprint, own_kinds = F.coalesce("hot", "fp"), F.when(F.col("hot").isNull(), F.col("kinds"))
    kept = stored(told.select("doc_id", "at", F.when(first, fingerprint).alias("fp"), F.when(first, own_kinds).alias("kinds")))
    # At most HOT_SHARE rows; every other fingerprint has its kinds already.
    of_hot = kept.where("fp IS NOT NULL AND kinds IS NULL").groupBy("fp").agg(F.count("*").alias("hot_kinds"))
    counted = kept.join(F.broadcast(of_hot), "fp", "left").withColumn("kinds", F.coalesce("kinds", "hot_kinds"))
    unpacked = counted.where("fp IS NULL OR kinds > 1").select(
        "fp", "doc_id", "kinds", F.shiftright("at", 32).alias("first"), (F.shiftright("at", 16) % 65536).alias("ahead"), (F.col("at") % 65536).alias("more")
    )

    # Equal surroundings: all but the first are repeats throughout.
    copies = unpacked.where("fp IS NULL").select("doc_id", "first", (F.col("first") + F.col("more")).alias("last"))

    compare = unpacked.where("fp IS NOT NULL").groupBy("doc_id").agg(F.collect_list(F.struct("fp", "kinds", "first", "more")).alias("marks"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_numpy(zero_copy_only=False), []
            for i, j, buf, bounds in text_slices(batch.column(1)):
                hashed = None
                for k, list_ in enumerate(batch.column(2).slice(i, j - i)):
                    for mark in list_.values.to_pylist():
                        begin = int(bounds[k]) + mark["first"]
                        if mark["kinds"] <= most_contexts:
                            out.append((mark["fp"], 0, ids[i + k], mark["first"], buf[begin : begin + mark["more"] + width].tobytes()))
                            continue
                        hashed = hashed or Hashed(buf)
                        starts = begin + np.arange(mark["more"] + 1)
                        strings = hashed.spans(starts, starts + width).view(np.int64)
                        out += [(mark["fp"], int(h), ids[i + k], mark["first"] + m, None) for m, h in enumerate(strings)]
                for begin in range(0, len(out), 20_000):
                    columns = list(zip(*out[begin : begin + 20_000], strict=True))
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["fp", "string", "doc_id", "first", "bytes"])
                out = []

    around = texts.join(compare, "doc_id").select("doc_id", "text", "marks").mapInArrow(cut_out, "fp bigint, string bigint, doc_id bigint, first bigint, bytes binary")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs(rows: list[tuple]) -> pa.RecordBatch:
            rows.sort(key=lambda r: (r[1], r[2]))
            buf = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
            sizes = np.array([len(r[3]) for r in rows])
            base = np.cumsum(sizes) - sizes
            strings = sizes - width + 1
            row = np.repeat(np.arange(len(rows)), strings)
            within = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
            again = repeats(buf, base[row] + within, width)
            row, within = row[again], within[again]
            ids, first = (np.array([r[k] for r in rows], np.int64) for k in (1, 2))
            new = np.concatenate([[True], (row[1:] != row[:-1]) | (within[1:] != within[:-1] + 1)]) if len(row) else np.empty(0, bool)
            at = np.flatnonzero(new)
            end = np.append(at[1:] - 1, len(row) - 1) if len(at) else at
            columns = [ids[row[at]], first[row[at]] + within[at], first[row[at]] + within[end]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "first", "last"])

        held, size, group, of_group = [], 0, None, 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != group:
                    if size > ARRAY_BYTES:
                        yield runs(held)
                        held, size = [], 0
                    group = row[0]
                held.append(row)
                size += len(row[3])
        if held:
            yield runs(held)

    near = around.where("bytes IS NOT NULL").select("fp", "doc_id", "first", "bytes").repartition("fp").sortWithinPartitions("fp")
    sorted_out = near.mapInArrow(compared, "doc_id bigint, first bigint, last bigint")
    # All but the first of a share repeat a string; then the firsts of the shares meet.
    dealt = around.where("bytes IS NULL").withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(STRING_SHARES)))
    in_order = W.partitionBy("fp", "string", "share").orderBy("doc_id", "first")
    firsts = dealt.withColumn("copy", F.row_number().over(in_order)).withColumn("share", F.when(F.col("copy") > 1, F.col("share")).otherwise(-1))
    one_by_one = (
        firsts.withColumn("again", (F.row_number().over(in_order) > 1) | (F.col("share") >= 0))
        .where("again")
        .select("doc_id", "first", F.col("first").alias("last"))
    )
    found = copies.unionByName(sorted_out).unionByName(one_by_one)
    per_doc = found.groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("runs"))

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, spans, kept = [], [], [], [], []
            for i, j, buf, bounds in text_slices(batch.column(1)):
                for k, runs in enumerate(batch.column(len(passed)).slice(i, j - i)):
                    own = buf[bounds[k] : bounds[k + 1]]
                    steps = np.zeros(len(own) + 1, np.int32)
                    if runs.is_valid:
                        struct = runs.values
                        np.add.at(steps, struct.field("first").to_numpy(zero_copy_only=False), 1)
                        np.add.at(steps, struct.field("last").to_numpy(zero_copy_only=False) + width, -1)
                    gone = np.cumsum(steps[:-1]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    n_bytes.append(len(own))
                    n_removed.append(int(gone.sum()))
                    n_spans.append(len(edges) // 2)
                    spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                    rest = own[~gone].tobytes()
                    kept.append(rest.decode("utf-8", "ignore") if decoded else rest)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string() if decoded else pa.binary())
            new = [pa.array(c, t) for c, t in zip((n_bytes, n_removed, n_spans, spans, kept), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(passed)], *new], schema.names)

    passed = texts.columns
    added = f"n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start: bigint, end: bigint>>, kept {'string' if decoded else 'binary'}"
    schema = T.StructType([*texts.schema.fields, *T.StructType.fromDDL(added).fields])
    found = texts.join(per_doc, "doc_id", "left").select(*passed, "runs").mapInArrow(removed, schema)
    return found if unique else found.drop("doc_id").select(F.col("llm_id").alias("doc_id"), *[c for c in found.columns if c not in ("doc_id", "llm_id")])
