"""Spelling variants of words, grouped under their most frequent form.

Two words that differ by one edit are met by asymmetric q-chunks: the shorter word (of equally
long ones the smaller) contributes its two halves, the other all the positional grams that a
half can still be found at. One edit leaves one half as it is, in place or shifted by the
difference of the lengths, so a join on (length, half, gram) finds every pair; the join verifies
it. Every word then points to its most frequent near word, and pointers are followed by doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.llm.tables import settled

#: A word of a text.
RUN = re.compile("[a-zÀ-ÿ]+")
#: One in so many places of a word (by hash) loses a letter.
ONE_IN = 97
#: Distinct words a task counts before it hands them on.
COUNTED = 1 << 18
#: Longer texts are read run by run.
LONG_TEXT = 1 << 20


def runs_of(text: str) -> Counter:
    """Counts of the maximal runs of letters, A-Z lower-cased."""
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # of bytes: A-Z only
    if len(lowered) <= LONG_TEXT:
        return Counter(RUN.findall(lowered))
    return Counter(m[0] for m in RUN.finditer(lowered))


def with_slips(run: str, prefix: int) -> str:
    """The run as the contract has it: where its hash says so, a letter is missing."""
    h = zlib.crc32(run.encode(), prefix)
    if h % ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, *, key: str, text: str, shortest: int) -> DataFrame:
    """word and n over all texts; words are counted in the task before they are shuffled."""
    chosen = docs.select(F.coalesce(docs[f"`{key}`"].cast("string"), F.lit("")), docs[f"`{text}`"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc, given in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                prefix = zlib.crc32(f"{doc}:".encode())
                for run, n in runs_of(given.as_py() or "").items():
                    if len(run) >= shortest:
                        word = with_slips(run, prefix)
                        if len(word) >= shortest:
                            seen[word] += n
                if len(seen) >= COUNTED:
                    yield told()
                    seen.clear()
        if seen:
            yield told()

    return chosen.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def halves(word: Column, length: Column, of: Column) -> list[Column]:
    """The two halves that a word of length `of` would have, at the start and at the end of `word`."""
    first = F.floor(of / 2).cast("int")
    gram = lambda half, start, size: F.struct(of.alias("of"), F.lit(half).alias("half"), F.substring(word, start, size).alias("gram"))
    return [gram(0, F.lit(1), first), gram(1, length - of + first + 1, of - first)]


def near_pairs(words: DataFrame) -> DataFrame:
    """Every unordered pair of words that differ by one edit, once: word, n, other, other_n."""
    length = F.char_length("word").cast("int")
    sized = words.select("word", "n", length.alias("length"))
    w, size = F.col("word"), F.col("length")
    chunks = sized.select("word", "n", "length", F.inline(F.array(*halves(w, size, size))))
    grams = sized.select(
        F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("length").alias("other_length"), F.inline(F.array(*halves(w, size, size), *halves(w, size, size - 1)))
    )
    c, g = chunks.alias("c"), grams.alias("g")
    met = (F.col("c.of") == F.col("g.of")) & (F.col("c.half") == F.col("g.half")) & (F.col("c.gram") == F.col("g.gram"))
    later = (F.col("g.other_length") > F.col("c.length")) | (F.col("c.word") < F.col("g.other"))
    start = lambda column: F.substring(column, F.lit(1), F.floor(F.col("c.length") / 2).cast("int"))
    # An edit between the halves leaves both; it is met at the first.
    once = (F.col("c.half") == 0) | (start(F.col("c.word")) != start(F.col("g.other")))
    edit = F.levenshtein(F.col("c.word"), F.col("g.other"), 1) == 1
    return c.join(g, met & later & once & edit).select("c.word", "c.n", "g.other", "g.other_n")


def roots(forms: DataFrame) -> DataFrame:
    """word and root (the last form) of every word that has a form; pointers are doubled until none moves."""
    reached = settled(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = settled(reached.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        reached = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shortest: int = 5, least: int = 3, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of at least `shortest` letters and `least` occurrences.

    A null or empty text has no word; a null key counts as empty in the hash. Repeated rows count
    again. Texts are read whole, and runs are counted within a text first, so long texts cost
    the memory of their own characters and distinct words. Of near words with the same n the
    smallest in code-point order is the form. A form has at least `times` (2 or more) the n of its word, so
    chains end and are at most the binary logarithm of the largest n long. An empty table gives
    no row. Other columns are not read.
    """
    if times < 2:
        raise ValueError("a form needs at least twice the occurrences, or chains may not end")
    words = settled(word_counts(docs, key=key, text=text, shortest=shortest).where(F.col("n") >= least))
    pairs = near_pairs(words)
    ways = F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    both = pairs.select(F.inline(ways))
    best = F.min_by(F.struct("other", "other_n"), F.struct(-F.col("other_n"), F.col("other")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    chosen = words.join(near, "word", "left")
    taken = F.col("best.other_n") >= times * F.col("n")
    formed = settled(
        chosen.select(
            "word", F.when(taken, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("best.other_n")).alias("form_n")
        )
    )
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
