"""Nearest common domain within one or two edits.

Runs on distinct domains, never per contact. Two exact forms with equal results:

* a list that fits into the plan is searched in place, without any join;
* a longer list is met by an equi-join on deletion variants: two texts at most k edits
  apart (swaps included) become equal after deleting at most k characters from each. With many
  domains, those of their variants that no listed domain has are told by a bitmap of fixed size
  and not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions.constants import text_array
from postsift.functions.distance import ROUGH_LIMIT, refine
from postsift.operators.membership import with_hint
from postsift.operators.once import computed_once
from postsift.operators.settle import settle
from postsift.functions.text import clean_value
from postsift.sources.lists import ReferenceLists

# Longest list that is written into the plan as literals.
INLINE_LIMIT = 1000

# Domains up to six characters may be one edit off, longer ones two.
SHORT_DOMAIN = 6


def edit_limit(domain: Column) -> Column:
    return F.when(F.length(domain) <= SHORT_DOMAIN, 1).otherwise(2)


def _as_typo(nearest: Column) -> Column:
    """struct<suggestion, high_confidence> from the nearest candidate, null if there is none."""
    sure = (nearest["distance"] == 1) & nearest["tier1"]
    return F.struct(
        nearest["candidate"].alias("suggestion"), F.coalesce(sure, F.lit(False)).alias("high_confidence")
    )


def nearest_common(domain: Column, lists: ReferenceLists) -> Column:
    """struct<distance, ordinal, candidate, tier1> of the nearest listed domain, or null.

    A domain on the list is never corrected. Otherwise the smallest (distance, list
    position) wins.
    """
    limit = edit_limit(domain)
    common, tier1 = text_array(lists.common), text_array(lists.tier1)

    def rough(c: Column) -> Column:
        return F.levenshtein(domain, c, ROUGH_LIMIT)

    similar = F.filter(common, lambda c: (F.abs(F.length(c) - F.length(domain)) <= limit) & (rough(c) >= 0))
    measured = F.transform(similar, lambda c: F.struct(rough(c).alias("rough"), c.alias("candidate")))
    exact = F.transform(
        measured,
        lambda m: F.struct(
            refine(m["rough"], domain, m["candidate"]).alias("distance"),
            F.array_position(common, m["candidate"]).alias("ordinal"),
            m["candidate"].alias("candidate"),
            F.array_contains(tier1, m["candidate"]).alias("tier1"),
        ),
    )
    near = F.filter(exact, lambda c: c["distance"] <= limit)
    return F.when(~domain.isin(*lists.common), F.array_min(near))


def typo_match(domain: Column, lists: ReferenceLists) -> Column:
    """In-place search as one expression: struct<suggestion, high_confidence>.

    Confidence is high one edit away from a tier-1 domain.
    """
    return _as_typo(nearest_common(domain, lists))


def find_typos(
    domains: DataFrame, lists: ReferenceLists, inline_limit: int = INLINE_LIMIT, extra: DataFrame | None = None, settled: bool = False
) -> DataFrame:
    """Add `typo` = struct<suggestion, high_confidence> to a table of distinct domains.

    `extra` is a table of further common domains (`value`, and `ordinal` if their order
    matters); it never passes through the driver. `settled`: see `find_typos_in`.
    """
    if extra is None and len(lists.common) <= inline_limit:
        found = computed_once(domains, nearest=nearest_common(F.col("domain"), lists))
        return found.withColumn("typo", _as_typo(F.col("nearest"))).drop("nearest")
    tier1 = set(lists.tier1)
    common = domains.sparkSession.createDataFrame(
        [(c, i, c in tier1) for i, c in enumerate(lists.common)],
        "candidate string, ordinal bigint, tier1 boolean",
    )
    if extra is not None:
        place = F.col("ordinal") if "ordinal" in extra.columns else F.lit(0)
        added = extra.select(
            clean_value(F.col("value")).alias("candidate"), (place + len(lists.common)).cast("bigint").alias("ordinal"), F.lit(False).alias("tier1")
        )
        everything = common.unionByName(added.where("candidate <> ''"))
        common = everything.groupBy("candidate").agg(F.min("ordinal").alias("ordinal"), F.max("tier1").alias("tier1"))
    return find_typos_in(domains, common, settled)


def find_typos_in(domains: DataFrame, common: DataFrame, settled: bool = False, hinted: bool | None = None) -> DataFrame:
    """The same search against a list of any length (candidate, ordinal, tier1).

    First with one deletion on either side, which finds every pair one edit apart. Such a
    hit beats any at two edits, so only domains without one, and long enough for two, go on
    to two deletions, where keys are many. The domains are needed by both searches and by the
    result; `settled` writes them, what the first search found, and the list to the checkpoint
    folder, so that where they come from is read once.

    `hinted` drops variants that no listed domain has before they are shuffled, at the price of
    going over the list's variants once more. Left open, a settled search does so where it has
    more domains to look up than are listed, and one that is not settled does not.
    """
    domain = F.col("domain")
    kept = settle if settled else lambda frame: frame
    common = kept(common.select("candidate", "ordinal", "tier1"))
    listed = common.count() if settled and hinted is None else 0

    def pays(unknown: DataFrame) -> bool:
        return hinted if hinted is not None else settled and unknown.count() > listed

    known = common.select(F.col("candidate").alias("domain"), F.lit(True).alias("ps_known"))
    told = kept(domains.join(known, "domain", "left").withColumn("ps_known", F.col("ps_known").isNotNull()))
    strange = told.where("NOT ps_known").select("domain")
    one = _nearest_within(strange, common, 1, pays(strange))
    searched = kept(told.join(one, "domain", "left"))
    rest = searched.where(~F.col("ps_known") & F.col("nearest").isNull() & (F.length(domain) > SHORT_DOMAIN)).select("domain")
    two = _nearest_within(rest, common, 2, pays(rest)).withColumnRenamed("nearest", "ps_two")
    found = searched.join(two, "domain", "left").withColumn("typo", _as_typo(F.coalesce("nearest", "ps_two")))
    return found.drop("nearest", "ps_two", "ps_known")


def _nearest_within(unknown: DataFrame, common: DataFrame, limit: int, hinted: bool) -> DataFrame:
    """(domain, nearest) for domains at most `limit` edits from a candidate."""
    domain, candidate = F.col("domain"), F.col("candidate")
    left, right = variant_rows(unknown, common, limit, hinted)
    # Spark takes an exploded list for no larger than the list and would broadcast it.
    met = left.join(right.hint("merge"), "variant").where(F.abs(F.length(domain) - F.length(candidate)) <= limit)
    rough = computed_once(met.drop("variant"), rough=F.levenshtein(domain, candidate, ROUGH_LIMIT)).where("rough >= 0")
    # A pair shares many variants and is measured once.
    measured = computed_once(rough.distinct(), distance=refine(F.col("rough"), domain, candidate))
    return (
        measured.where(F.col("distance") <= limit)
        .groupBy("domain")
        .agg(F.min(F.struct("distance", "ordinal", "candidate", "tier1")).alias("nearest"))
    )


def variant_rows(unknown: DataFrame, common: DataFrame, limit: int, hinted: bool) -> tuple[DataFrame, DataFrame]:
    """(domain, variant) and (candidate, ordinal, tier1, variant), to be joined on hashed variants.

    A domain has a variant for every choice of deleted characters, and hardly any of them is one
    of a listed domain too. With `hinted`, the hashes of the list's variants set bits in a map of
    fixed size, and only a domain's variants that meet a set bit are kept. The longer the list,
    the more bits are set: 9 % at 100,000 listed domains of 15 characters and two deletions.
    """

    def keys(text: Column) -> Column:
        # Hashes are short keys; a collision only adds a pair that the distance rejects.
        hashes = F.transform(deletion_variants(text, F.lit(limit)), lambda v: F.xxhash64(v))
        return F.explode(F.array_distinct(hashes)).alias("variant")

    left = unknown.select("domain", keys(F.col("domain")))
    right = common.select("candidate", "ordinal", "tier1", keys(F.col("candidate")))
    if hinted:
        left = with_hint(left, "variant", right.select("variant")).where("ps_maybe").drop("ps_maybe")
    return left, right


def deletion_variants(text: Column, limit: Column) -> Column:
    """Texts left after deleting up to `limit` (1 or 2) characters, with repetitions."""

    def without_one(value: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(value), F.lit(1))),
            lambda i: F.concat(F.substring(value, F.lit(1), i - 1), F.substring(value, i + 1, F.length(value))),
        )

    once = without_one(text)
    twice = F.when(limit >= 2, F.flatten(F.transform(once, without_one))).otherwise(
        F.array().cast("array<string>")
    )
    return F.concat(F.array(text), once, twice)
