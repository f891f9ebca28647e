"""N-gram Jaccard join by chosen paths.

The set of a document are its word n-grams. A minhash sketch stands for the set: two sets
agree in one of its places with the probability of their Jaccard similarity. A run starts
with all sets in one bucket and splits a bucket by sampling places of the sketch, a few on
average: sets with the same token in a sampled place share a child bucket. Small buckets
are compared by brute force, large ones are split further, and runs are repeated until a
pair at the threshold is found with the target recall. What the buckets find are candidate
links; groups of candidates are then compared exactly, on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm.components import components
from postsift.llm.tables import settled, with_row_key
from postsift.llm.texthash import mixed, ngram_hashes, span_hashes, text_slices, words_of

#: Cells of a matrix over sets that are taken at a time, and of a table of sets and n-grams. In
#: one piece a task needs only 4 bytes for each pair of sets, and one for whether it is linked.
STRIP_CELLS, TABLE_CELLS = 1 << 18, 1 << 22
#: Rows with texts that are taken out of an Arrow batch at a time.
TEXT_ROWS = 256


@dataclass(frozen=True)
class JoinOptions:
    """n-gram length, threshold, and how the search goes about it."""

    n: int = 5
    threshold: float = 0.8
    #: Recall of a pair exactly at the threshold; above it more.
    recall: float = 0.999999
    places: int = 64
    #: Children of a bucket that two sets at the threshold share on average.
    shared_children: float = 2.0
    levels: int = 4
    small_bucket: int = 2048
    #: Sets (in n-grams) that are compared in one task; larger groups go in blocks of so many.
    block_grams: int = 400_000
    #: Sets of a block at most, on average: a task has matrices over the sets of two blocks.
    block_sets: int = 2_000

    @property
    def sampling(self) -> float:
        """Probability of a place to be sampled for a bucket."""
        return min(1.0, self.shared_children / (self.threshold * self.places))

    @property
    def runs(self) -> int:
        """Found in a run: one of the shared children finds the pair, over all levels."""
        found = 1.0
        for _ in range(self.levels):
            found = 1 - (1 - self.sampling * self.threshold * found) ** self.places
        return math.ceil(math.log(1 - self.recall) / math.log(1 - found))

    @property
    def likely(self) -> int:
        """Places in which two sets at the threshold agree but for five standard deviations."""
        spread = math.sqrt(self.threshold * (1 - self.threshold) * self.places)
        return max(1, math.floor(self.threshold * self.places - 5 * spread))


def gram_sets(buf: np.ndarray, bounds: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted n-gram hashes of each text; a text with fewer words, but one, is one n-gram."""
    starts, ends, row = words_of(buf, bounds)
    words = span_hashes(buf, starts, ends)
    of_row = np.searchsorted(row, np.arange(len(bounds)))
    at = np.arange(max(0, len(words) - n + 1))
    grams = ngram_hashes(words, n, at)
    for lo, hi in zip(of_row[:-1], of_row[1:], strict=True):
        if hi - lo >= n:
            yield np.unique(grams[lo : hi - n + 1])
        elif hi > lo:
            yield ngram_hashes(words[lo:hi], int(hi - lo), np.zeros(1, np.int64)) ^ np.uint64(hi - lo)
        else:
            yield np.empty(0, np.uint64)


def multipliers(places: int) -> np.ndarray:
    return mixed(np.arange(1, places + 1, dtype=np.uint64)) | np.uint64(1)


def sketch(grams: np.ndarray, multiplier: np.ndarray) -> np.ndarray:
    """The minhash of every place, as 32 bits."""
    least = np.full(len(multiplier), np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(grams), 8192):
        some = grams[begin : begin + 8192]
        for k, m in enumerate(multiplier):
            least[k] = min(least[k], (some * m ^ (some >> np.uint64(29))).min())
    return (mixed(least) >> np.uint64(32)).astype(np.uint32)


def sketched(docs: DataFrame, options: JoinOptions) -> DataFrame:
    """doc_id, a 128-bit name of its set in two halves, number of n-grams and sketch."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multiplier = multipliers(options.places)
        for batch in batches:
            one, two, size, marks = [], [], [], []
            for _, _, buf, bounds in text_slices(batch.column(1)):
                for grams in gram_sets(buf, bounds, options.n):
                    with np.errstate(over="ignore"):
                        one.append(int(mixed(mixed(grams ^ np.uint64(11)).sum(dtype=np.uint64) + np.uint64(len(grams))).view(np.int64)))
                        two.append(int(mixed(mixed(grams ^ np.uint64(23)).sum(dtype=np.uint64)).view(np.int64)))
                    size.append(len(grams))
                    marks.append(sketch(grams, multiplier).astype("<u4").tobytes())
            arrays = [batch.column(0), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(size, pa.int64()), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "set_a", "set_b", "grams", "sketch"])

    return docs.mapInArrow(measured, "doc_id bigint, set_a bigint, set_b bigint, grams bigint, sketch binary")


def children(sets: DataFrame, options: JoinOptions, level: int) -> DataFrame:
    """(path, rep, sketch) to (path, rep) of the child buckets; level 0 starts all runs."""
    places, sampling = options.places, options.sampling

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, limit = ["path", "rep"], np.uint64(min(int(sampling * 2.0**64), 2**64 - 1))
        place = mixed(np.arange(1, places + 1, dtype=np.uint64))
        for batch in batches:
            reps = batch.column(1).to_numpy(zero_copy_only=False)
            marks = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u4").reshape(-1, places)
            paths = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            starts = [mixed(np.uint64(1000 + run)) for run in range(options.runs)] if level == 0 else [None]
            for start in starts:
                path = np.full(len(reps), start) if start is not None else paths
                sampled = mixed(path[:, None] ^ place[None, :]) <= limit
                row, at = np.nonzero(sampled)
                token = marks[row, at].astype(np.uint64) + (at.astype(np.uint64) << np.uint64(32))
                child = mixed(path[row] + np.uint64(1)) ^ mixed(token)
                yield pa.RecordBatch.from_arrays([pa.array(mixed(child).view(np.int64)), pa.array(reps[row])], names)

    return sets.select("path", "rep", "sketch").mapInArrow(split, "path bigint, rep bigint")


def strips(shape: tuple[int, int]) -> Iterator[slice]:
    """Rows of a matrix, about STRIP_CELLS at a time, one row at least."""
    step = max(1, STRIP_CELLS // max(1, shape[1]))
    for begin in range(0, shape[0], step):
        yield slice(begin, begin + step)


def least_linked(linked: np.ndarray, root: np.ndarray, most: int) -> np.ndarray:
    """The least root among the columns linked to each row; `most` where there is none."""
    out = np.full(len(linked), most)
    for s in strips(linked.shape):
        out[s] = np.where(linked[s], root[None, :], most).min(axis=1, initial=most)
    return out


def copies_linked(linked: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """The sum of `copies` over the columns linked to each row."""
    out = np.zeros(len(linked), np.int64)
    for s in strips(linked.shape):
        out[s] = linked[s] @ copies
    return out


def star(rep: np.ndarray, linked: np.ndarray, cut: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every set to the smallest one of its component.

    `linked` is a symmetric matrix over all sets or, given `cut`, has the sets before it as rows
    and the others as columns.
    """
    root = np.arange(len(rep))
    while True:
        if cut is None:
            new = least_linked(linked, root, len(rep))
        else:
            new = np.concatenate([least_linked(linked, root[cut:], len(rep)), least_linked(linked.T, root[:cut], len(rep))])
        new = np.minimum(root, new)
        new = new[new]
        if (new == root).all():
            break
        root = new
    least = np.full(len(rep), np.iinfo(np.int64).max)
    np.minimum.at(least, root, rep)
    return rep, least[root]


def bucket_edges(rows: DataFrame, options: JoinOptions, checked: bool) -> DataFrame:
    """Candidate links of buckets: by agreement of sketches, or, unchecked, all to the smallest."""
    if not checked:
        least = rows.groupBy("path").agg(F.min("rep").alias("b"))
        return rows.join(least, "path").select(F.col("rep").alias("a"), "b")
    likely, places = options.likely, options.places

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(path_rows) -> pa.RecordBatch:
            rep = np.array([r for r, _ in path_rows])
            marks = np.frombuffer(b"".join(m for _, m in path_rows), "<u4").reshape(-1, places)
            agree = np.zeros((len(rep), len(rep)), np.int16)
            for k in range(places):
                agree += marks[:, k][:, None] == marks[:, k][None, :]
            a, b = star(rep, agree >= likely)
            own = a != b
            return pa.RecordBatch.from_arrays([pa.array(a[own]), pa.array(b[own])], ["a", "b"])

        now, held = None, []
        for batch in batches:
            for path, rep, marks in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if path != now and held:
                    yield edges(held)
                    held = []
                now = path
                held.append((rep, marks))
        if held:
            yield edges(held)

    near = rows.select("path", "rep", "sketch").repartition("path").sortWithinPartitions("path")
    return near.mapInArrow(compared, "a bigint, b bigint")


def candidate_links(sets: DataFrame, options: JoinOptions) -> DataFrame:
    """Candidate links (a, b) between sets (rep, sketch), all runs at once, level by level."""
    at = sets.select(F.lit(0).cast("bigint").alias("path"), "rep", "sketch")
    found = None
    for level in range(options.levels):
        rows = settled(children(at, options, level))
        counts = rows.groupBy("path").count().where("count > 1")
        shared = settled(rows.join(counts, "path").join(sets, "rep").select("path", "rep", "count", "sketch"))
        small = bucket_edges(shared.where(F.col("count") <= options.small_bucket), options, checked=True)
        found = small if found is None else found.unionByName(small)
        at = shared.where(F.col("count") > options.small_bucket).select("path", "rep", "sketch")
        if not at.limit(1).count():
            return found
    return found.unionByName(bucket_edges(at, options, checked=False))


def exact_links(groups: DataFrame, options: JoinOptions) -> DataFrame:
    """(rep, other, links) for sets in candidate groups: links to sets, weighted by their copies.

    `groups`: grp, i, j, half, rep, copies, text; the pairs of block i (half 0) with block j
    (half 1) of a group are compared, within i if i = j. `other` is the smallest set of the
    own component among those compared, so no pair leaves the task.
    """
    need = options.threshold

    def pairs(sets: list[np.ndarray], cut: int | None) -> np.ndarray:
        """Whether sets are linked: each with each or, given `cut`, those before it with the others."""
        sizes = np.array([len(s) for s in sets])
        grams, code = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        shared = np.bincount(code, minlength=len(grams))
        keep = shared[code] > 1
        owner, code = owner[keep], np.unique(code[keep], return_inverse=True)[1]
        rows, columns = (slice(None), slice(None)) if cut is None else (slice(0, cut), slice(cut, None))
        together = np.zeros((len(sizes[rows]), len(sizes[columns])), np.float32)
        width = int(code.max()) + 1 if len(code) else 0
        step = max(1, TABLE_CELLS // max(1, len(sets)))
        order = np.argsort(code, kind="stable")
        owner, code = owner[order], code[order]
        for begin in range(0, width, step):
            lo, hi = np.searchsorted(code, [begin, begin + step])
            table = np.zeros((len(sets), min(step, width - begin)), np.float32)
            table[owner[lo:hi], code[lo:hi] - begin] = 1
            together += table[rows] @ table[columns].T
        linked = np.empty(together.shape, bool)
        for s in strips(together.shape):
            some = together[s]
            union = sizes[rows][s, None] + sizes[None, columns] - some
            near = (some >= need * union - 1e-3) & (union > 0)
            # Counts are whole numbers below 2**24, so the comparison can be made exact.
            near &= some.astype(np.int64) * 1000 >= np.int64(round(need * 1000)) * np.round(union).astype(np.int64)
            linked[s] = near
        if cut is None:
            np.fill_diagonal(linked, False)
        return linked

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: list[tuple], same: bool) -> pa.RecordBatch:
            seen: dict[tuple[int, int], tuple] = {}
            for row in rows:
                seen.setdefault((row[0], row[1]), row)
            rows = list(seen.values())
            half, rep, copies = (np.array([r[k] for r in rows], np.int64) for k in range(3))
            sets = []
            for _, _, buf, bounds in text_slices(pa.array([r[3] for r in rows], pa.string())):
                sets += list(gram_sets(buf, bounds, options.n))
            # Rows come by half, so the sets of the first block precede those of the second.
            cut = None if same else int((half == 0).sum())
            linked = pairs(sets, cut)
            a, b = star(rep, linked, cut)
            if same:
                counts = copies_linked(linked, copies)
            else:
                counts = np.concatenate([copies_linked(linked, copies[cut:]), copies_linked(linked.T, copies[:cut])])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(counts)], ["rep", "other", "links"])

        now, held = None, []
        for batch in (b.slice(k, TEXT_ROWS) for b in batches for k in range(0, b.num_rows, TEXT_ROWS)):
            for *key, half, rep, copies, text in zip(*(batch.column(c).to_pylist() for c in range(7)), strict=True):
                if key != now and held:
                    yield links(held, now[1] == now[2])
                    held = []
                now = key
                held.append((half, rep, copies, text))
        if held:
            yield links(held, now[1] == now[2])

    near = groups.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "half", "rep")
    return near.mapInArrow(compared, "rep bigint, other bigint, links bigint")


def block_counts(sized: DataFrame, options: JoinOptions) -> DataFrame:
    """(grp, n_blocks) of groups of sets (grp, grams): bounded by n-grams and by sets."""
    needed = F.greatest(F.sum("grams") / options.block_grams, F.count("*") / options.block_sets)
    return sized.groupBy("grp").agg(F.ceil(needed).cast("int").alias("n_blocks"))


def jaccard_join(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", options: JoinOptions = JoinOptions()) -> DataFrame:
    """doc_id, class_id, n_links and set_id for every document.

    Two documents are linked if the Jaccard similarity of their sets of word n-grams is at
    least the threshold. `class_id` is the smallest doc_id that links lead to, `n_links` the
    number of documents linked to this one, exact copies included, and `set_id` the smallest
    doc_id with exactly the same set.

    Words are runs of characters other than 0x20 and 0x09 to 0x0D. A text with fewer words
    than n is one n-gram by itself, so it is linked to texts of the same words only. Null
    and wordless texts are in no link and each a class of its own. Rows that repeat a doc_id
    are documents of their own, with a row each in the result. Null ids take no part.

    Copies are counted by an aggregate and never paired; large groups are compared in blocks.
    """
    chosen = docs.select(docs[f"`{doc_id}`"].cast("bigint").alias("llm_id"), docs[f"`{text}`"].alias("text"))
    rows, unique = with_row_key(chosen, "llm_id", "text", "doc_id")
    found = _joined(rows.select("doc_id", "text"), options)
    if unique:
        return found
    # The keys follow the ids, so the smallest key of a class has its smallest id.
    for name in ("doc_id", "class_id", "set_id"):
        ids = rows.select(F.col("doc_id").alias("llm_key"), "llm_id")
        found = found.withColumnRenamed(name, "llm_key").join(ids, "llm_key").drop("llm_key").withColumnRenamed("llm_id", name)
    return found.select("doc_id", "class_id", "n_links", "set_id")


def _joined(given: DataFrame, options: JoinOptions) -> DataFrame:
    """`jaccard_join` of rows (doc_id, text) whose ids are unique."""
    named = settled(sketched(given, options))
    one = named.select("doc_id", "set_a", "set_b", "grams")
    worded = one.where("grams > 0")
    reps = settled(worded.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("grams").alias("grams")))
    marks = named.select(F.col("doc_id").alias("rep"), "sketch")
    sets = settled(reps.join(marks, "rep").select("rep", "sketch"))

    groups = components(candidate_links(sets, options)).withColumnRenamed("node", "rep").withColumnRenamed("root", "grp")
    sized = groups.join(reps, "rep")
    blocks = block_counts(sized, options)
    blocked = sized.join(blocks, "grp").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("n_blocks")).cast("int"))
    texts = given.withColumnRenamed("doc_id", "rep").join(blocked.select("rep", "grp", "copies", "block", "n_blocks"), "rep")
    every = F.sequence(F.lit(0), F.col("n_blocks") - 1)
    other = texts.select("*", F.explode(every).alias("other"))
    tasks = other.select(
        "grp",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("half"),
        "rep",
        "copies",
        "text",
    )
    found = settled(exact_links(tasks, options))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")))

    classes = (
        reps.join(links, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("set_a", "set_b", "rep", F.coalesce("root", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    )
    return one.join(classes, ["set_a", "set_b"], "left").select(
        "doc_id",
        F.coalesce(F.when(F.col("grams") > 0, F.col("class_id")), F.col("doc_id")).alias("class_id"),
        F.coalesce(F.when(F.col("grams") > 0, F.col("n_links")), F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce(F.when(F.col("grams") > 0, F.col("rep")), F.col("doc_id")).alias("set_id"),
    )
