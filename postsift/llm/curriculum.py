"""Mixing sources to target weights over training time.

Each source gets a target number of words. Its weight changes over training time; the
integral of that schedule says how many words the source has delivered at any time, and
its inverse gives the time at which a given word is due. Documents lie in a fixed random
order inside their source, so the words before a document give its training position.
Everything is a DataFrame expression, a sum or a window; no Python runs on executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Relative weight of a source at the start and at the end of training, linear between.
SCHEDULES = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))
WEIGHTS = (3, 1, 2)
COLUMNS = ("mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_takes", "mix_position")


def word_count(text: Column) -> Column:
    """Number of runs of characters other than 0x20 and 0x09 to 0x0D; 0 for null."""
    marks = F.regexp_replace(text, "[^\\x20\\x09-\\x0D]+", "x")
    return F.coalesce(F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("bigint")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    pieces = F.regexp_extract_all(text, F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def cyclic(rank: Column, values: Sequence[float]) -> Column:
    """values[(rank - 1) % len(values)] for ranks from 1."""
    return F.get(F.array(*map(F.lit, values)), ((rank - 1) % len(values)).cast("int"))


def source_targets(sizes: DataFrame, *, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source with its target, from rows of (source, source_size).

    Sources in code point order, null last, take `weights` in turn and divide `share` times
    the total by them. A target ends at `cap` times its source; what is left over goes to
    the others by weight. That is one water level: with sources by the level that fills
    them, the first one whose level is not exceeded by what is left sets it. The windows
    run over one row per source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    weighed = ranked.withColumn("weight", cyclic(F.col("rank"), [int(w) for w in weights]))
    full = F.col("source_size") * F.lit(cap)
    by_level = W.orderBy(full / F.col("weight"), "rank")
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = (
        weighed.withColumn("fills_at", full / F.col("weight"))
        .withColumn("filled", F.coalesce(F.sum("source_size").over(by_level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(by_level.rowsBetween(W.currentRow, W.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(everything))
    )
    here = (F.col("total") * F.lit(share) - F.col("filled") * F.lit(cap)) / F.col("open_weight")
    level = F.min(F.when(here <= F.col("fills_at"), F.struct(F.col("fills_at"), F.col("rank"), here.alias("level")))).over(everything)["level"]
    target = F.when(F.col("fills_at") <= level, full).otherwise(F.col("weight") * level)
    return levels.select("source", "source_size", "rank", target.cast("double").alias("target"))


def due(part: Column, rank: Column, schedules) -> Column:
    """Training time in [0, 1] at which a source has delivered this part of its target.

    With a weight from a to b the delivered part at time t is (a t + (b - a) t^2 / 2) over
    (a + b) / 2; this is the root in [0, 1], in a form that also holds for a = b.
    """
    a, b = cyclic(rank, [float(s[0]) for s in schedules]), cyclic(rank, [float(s[1]) for s in schedules])
    return part * (a + b) / (a + F.sqrt(a * a + (b * b - a * a) * part))


def curriculum_mix(
    docs: DataFrame,
    *,
    size: Column,
    doc_id: str = "doc_id",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.5,
    cap: float = 2.0,
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
    ordered: bool = True,
) -> DataFrame:
    """`docs` with its mix, range-sorted by training position unless `ordered` is false.

    Adds mix_size, mix_source_size, mix_target, mix_taken, mix_takes (one struct of words,
    source_words before it and position for each time the document is taken) and
    mix_position (of the first; null if the mix takes nothing of it). Sources are read from
    the start as often as their target asks; the last document reached gives its first
    words only, so the words taken are the target, rounded.

    A null source is a source of its own. Null and empty texts have no words and are never
    taken; if no document has words every target is 0. Rows that repeat a doc_id are mixed
    each for itself. Columns of the input named like the added ones give way to them. The
    order inside a source is that of md5(doc_id), then doc_id and size; rows without an id follow,
    by a hash of what they hold. So reruns agree.

    Words before a document: a sum over 4,096 ranges of the order per source, then a window
    inside each range, so that a source with a third of all rows is spread over as many tasks.
    """
    size = size.cast("bigint")
    taken_names = {c.lower() for c in COLUMNS}
    payload = [c for c in docs.columns if c.lower() not in taken_names]
    # Rows without an id are spread by what they hold.
    held = [docs[f"`{f.name}`"] for f in docs.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    unnamed = F.concat(F.lit("n"), F.md5(F.xxhash64(*held).cast("string")))
    digest = F.coalesce(F.md5(docs[f"`{doc_id}`"].cast("string")), unnamed)
    # One struct, so that no name of the input meets a name used here.
    rows = docs.select(
        F.struct(F.lit(None).alias("none"), *[docs[f"`{c}`"].alias(f"c{k}") for k, c in enumerate(payload)]).alias("mix_payload"),
        size.alias("mix_size"),
        F.coalesce(F.concat(F.lit("s"), docs[f"`{source}`"]), F.lit("n")).alias("mix_key"),
        F.substring(digest, 1, 3).alias("mix_range"),
        digest.alias("mix_digest"),
        docs[f"`{doc_id}`"].alias("mix_doc"),
    )

    ranges = rows.groupBy("mix_key", "mix_range").agg(F.sum("mix_size").alias("words"))
    of_source = ranges.groupBy("mix_key").agg(F.sum("words").alias("source_size"))
    named = of_source.withColumn("source", F.when(F.col("mix_key") != "n", F.substring("mix_key", 2, 1 << 30)))
    targets = source_targets(named, weights=weights, share=share, cap=cap)
    targets = targets.withColumn("mix_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    before = F.sum("words").over(W.partitionBy("mix_key").orderBy("mix_range").rowsBetween(W.unboundedPreceding, -1))
    begun = (
        ranges.withColumn("mix_begun", F.coalesce(before, F.lit(0)))
        .join(targets.drop("source"), "mix_key")
        .select(
            "mix_key", "mix_range", "mix_begun", F.col("source_size").alias("mix_source_size"),
            F.col("target").alias("mix_target"), F.col("rank").alias("mix_rank"),
        )
    )

    inside = W.partitionBy("mix_key", "mix_range").orderBy("mix_digest", "mix_doc", "mix_size")
    earlier = F.coalesce(F.sum("mix_size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("mix_earlier", earlier).join(begun, ["mix_key", "mix_range"])

    start = F.col("mix_begun") + F.col("mix_earlier")
    goal = F.round("mix_target").cast("bigint")

    def take(lap: Column) -> Column:
        at = lap * F.col("mix_source_size") + start
        words = F.greatest(F.least(goal - at, F.col("mix_size")), F.lit(0).cast("bigint"))
        part = (at + words / F.lit(2)) / F.col("mix_target")
        when = F.round(due(part, F.col("mix_rank"), schedules), 9)
        return F.struct(words.alias("words"), at.alias("source_words"), F.when(words > 0, when).alias("position"))

    laps = F.sequence(F.lit(0).cast("bigint"), F.lit(int(-(-cap // 1)) - 1).cast("bigint"))
    takes = F.filter(F.transform(laps, take), lambda t: t["words"] > 0)
    mixed = placed.withColumn("mix_takes", takes).withColumns(
        {
            "mix_taken": F.aggregate("mix_takes", F.lit(0).cast("bigint"), lambda s, t: s + t["words"]),
            "mix_position": F.array_min(F.transform("mix_takes", lambda t: t["position"])),
        }
    )
    if ordered:
        # The digest spreads documents that are never taken over many ranges.
        mixed = mixed.orderBy(F.col("mix_position").asc_nulls_last(), "mix_digest", "mix_doc")
    return mixed.select(*[F.col("mix_payload")[f"c{k}"].alias(c) for k, c in enumerate(payload)], *COLUMNS)
