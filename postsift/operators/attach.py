"""Left join that survives hot keys.

A few mail providers hold most of a contact list, so hashing contacts on their domain
would send a third of all rows to one task. `attach` is one shuffle join on (key, share):

* rows without a key are dealt out over shares;
* left to itself, every key has one share, and the adaptive skew join splits the rows of a hot
  one while the join runs: rows and values are read once;
* with `HotKeys`, keys with many rows are marked beforehand by one broadcast of (key, number of
  shares). A row with a hot key goes to the share of its own input task, and the values of
  such a key are repeated for each share. The marks come from a weight that `values` carries,
  or from a sketch of frequent items over the rows, which costs one more read of the key.

The marks are bounded in number. Keys beyond that bound keep a single share and are left
to the adaptive skew join too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HotKeys:
    """From how many rows on a key is shared out, and how many such keys are marked at most."""

    min_rows: int = 1_000_000
    max_keys: int = 100_000


DEFAULT_HOT_KEYS = HotKeys()

# Keys the sketch of frequent items tracks in a task, and reports at most. It reports every
# key with more than 7 / SKETCH_KEYS of all rows, and none with fewer than half of that.
SKETCH_KEYS = 100_000
MOST_MARKS = 10_000

# A settled table within both bounds is broadcast whole.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024

# Shares of rows without a key.
KEYLESS_SHARES = 1024


def attach_settled(
    rows: DataFrame,
    values: DataFrame,
    key: str,
    weight: str,
    hot_keys: HotKeys = DEFAULT_HOT_KEYS,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`attach` for values that are computed already, so that their size can be checked.

    Within the bounds on rows and on their size as text all of `values` is broadcast and
    `rows` is not shuffled; beyond them, `attach` takes over.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(c) for c in values.columns]))))
    count, octets = values.agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    if count <= broadcast_rows and octets <= broadcast_bytes:
        return rows.join(F.broadcast(values.drop(weight)), key, "left")
    return attach(rows, values, key, weight, hot_keys)


def attach(
    rows: DataFrame,
    values: DataFrame,
    key: str,
    weight: str | None = None,
    hot_keys: HotKeys | None = None,
) -> DataFrame:
    """`rows` left join `values` on `key`; `values` holds each key once.

    `weight` names a column of `values` with the number of rows on each key (it is dropped).
    Without `hot_keys` the adaptive skew join deals with hot keys; a session that has it
    switched off gets the default marks.
    """
    if hot_keys is None and not _splits_skew(rows):
        hot_keys = DEFAULT_HOT_KEYS
    parts, shares = F.lit(1), F.lit(1)
    given = values if weight is None else values.drop(weight)
    if hot_keys is not None:
        hot = _marks(rows, values, key, weight, hot_keys)
        rows, given = rows.join(F.broadcast(hot), key, "left"), given.join(F.broadcast(hot), key, "left")
        parts = shares = F.coalesce("ps_shares", F.lit(1))
    # The input task and not a random number: a repeated task deals its rows out alike.
    dealt = rows.withColumn("ps_share", F.pmod(F.spark_partition_id(), F.when(F.col(key).isNull(), F.lit(KEYLESS_SHARES)).otherwise(parts)))
    repeated = given.withColumn("ps_share", F.explode(F.sequence(F.lit(0), shares - 1)))
    return dealt.drop("ps_shares").join(repeated.drop("ps_shares"), [key, "ps_share"], "left").drop("ps_share")


def _splits_skew(rows: DataFrame) -> bool:
    names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(rows.sparkSession.conf.get(name, "true") == "true" for name in names)


def _marks(rows: DataFrame, values: DataFrame, key: str, weight: str | None, hot_keys: HotKeys) -> DataFrame:
    """(key, ps_shares) of the hottest keys."""
    if weight is not None:
        counted = values.select(F.col(key), F.col(weight).alias("ps_weight"))
        hottest = counted.where(F.col("ps_weight") >= hot_keys.min_rows).orderBy(F.desc("ps_weight"), key).limit(hot_keys.max_keys)
    else:
        most = min(hot_keys.max_keys, MOST_MARKS)
        top = F.call_function("approx_top_k", F.col(key), F.lit(most), F.lit(SKETCH_KEYS))
        counted = rows.where(F.col(key).isNotNull()).agg(top.alias("top")).select(F.inline("top"))
        hottest = counted.where(F.col("count") >= hot_keys.min_rows).select(F.col("item").alias(key), F.col("count").alias("ps_weight"))
    return hottest.select(key, (F.ceil(F.col("ps_weight") / hot_keys.min_rows) + 1).cast("int").alias("ps_shares"))
