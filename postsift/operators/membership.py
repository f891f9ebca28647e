"""Is a value on a reference list?

Lists of ordinary length are literals in the plan (a hash set inside generated code).
Longer ones, which only user extensions can cause, become a column through a join: a
broadcast while the list is within a checked size. Beyond it, a bitmap of hashed list values,
broadcast at a fixed size, tells most rows apart that are not on the list, and only the others
are shuffled; their join stays exact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions.text import clean_value
from postsift.operators.attach import HotKeys, attach
from postsift.sources.lists import ReferenceLists

LITERAL_LIMIT = 1000
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024

# Lists a user can extend and that are looked up per contact, with what is looked up.
EXTENDABLE = {"disposable": "ps_domain", "roles": "ps_account"}


# Bits of the map of hashed list values (16 MB), in blocks of BLOCK_BITS, a fixed value of the
# functions that build them. A list of ten million values sets at most 8 % of the bits.
MAP_BITS = 1 << 27
BLOCK_BITS = 32768


def with_hint(rows: DataFrame, key: str, values: DataFrame, flag: str = "ps_maybe") -> DataFrame:
    """Add `flag`: false only where `key` is surely not among `values` (a column of the same name); false without a key.

    The map has one row per block, at most MAP_BITS / BLOCK_BITS of BLOCK_BITS / 8 bytes each, so
    its broadcast does not grow with the list.
    """
    place = F.pmod(F.xxhash64(key), F.lit(MAP_BITS))
    block, bit = F.floor(place / BLOCK_BITS).cast("int"), (place % BLOCK_BITS).cast("int")
    blocks = values.where(F.col(key).isNotNull()).groupBy(block.alias("ps_block")).agg(F.bitmap_construct_agg(bit).alias("ps_bits"))
    byte = F.conv(F.hex(F.substring("ps_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, bit % 8).bitwiseAND(F.lit(1)) == 1
    met = rows.withColumn("ps_block", block).join(F.broadcast(blocks), "ps_block", "left")
    told = F.col(key).isNotNull() & F.coalesce(is_set, F.lit(False))
    return met.withColumn(flag, told).drop("ps_block", "ps_bits")


def attach_listed(rows: DataFrame, values: DataFrame, key: str, flag: str, hot_keys: HotKeys | None = None) -> DataFrame:
    """`rows` with the column `flag` of `values` (each key once), null where a key is not among them.

    Rows are read twice, and only those with a hit in the map of hashed values are shuffled.
    """
    hinted = with_hint(rows, key, values.select(key))
    hits = attach(hinted.where("ps_maybe").drop("ps_maybe"), values, key, hot_keys=hot_keys)
    misses = hinted.where("NOT ps_maybe").drop("ps_maybe").withColumn(flag, F.lit(None).cast(values.schema[flag].dataType))
    return hits.unionByName(misses)


def membership(lists: ReferenceLists, flags: dict[str, Column]) -> Callable[[str, Column], Column]:
    """(list name, value) -> is it on the list; `flags` replaces long lists by a column."""

    def on_list(name: str, value: Column) -> Column:
        if name in flags:
            return flags[name]
        return value.isin(*getattr(lists, name))

    return on_list


def flag_long_lists(
    contacts: DataFrame,
    lists: ReferenceLists,
    literal_limit: int = LITERAL_LIMIT,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    tables: Mapping[str, DataFrame] | None = None,
) -> tuple[DataFrame, dict[str, Column]]:
    """Add one boolean column per list that is too long for literals or given as a table."""
    flags = {}
    for name, key in EXTENDABLE.items():
        values, table = getattr(lists, name), (tables or {}).get(name)
        listed = F.lit(False)
        if len(values) <= literal_limit:
            if table is None:
                continue
            listed = F.col(key).isin(*values)
        else:
            own = contacts.sparkSession.createDataFrame([(v,) for v in values], "value string")
            table = own if table is None else own.unionByName(table.select("value"))
        flag = f"ps_on_{name}"
        cleaned = table.select(clean_value(F.col("value")).alias(key)).where(F.col(key) != "").distinct().withColumn(flag, F.lit(True))
        size = cleaned.agg(F.coalesce(F.sum(F.octet_length(key)), F.lit(0))).first()[0]
        contacts = contacts.join(F.broadcast(cleaned), key, "left") if size <= broadcast_limit else attach_listed(contacts, cleaned, key, flag)
        flags[name] = F.coalesce(F.col(flag), F.lit(False)) | F.coalesce(listed, F.lit(False))
    return contacts, flags


def on_table(rows: DataFrame, key: str, table: DataFrame, value: str = "value", hot_keys: HotKeys | None = None) -> DataFrame:
    """Rows whose key is in a list table of any size; rows with no hit in the map of its values are not shuffled."""
    values = _values(table, value, key)
    hits = with_hint(rows, key, values).where("ps_maybe").drop("ps_maybe")
    return attach(hits, values.withColumn("ps_listed", F.lit(True)), key, hot_keys=hot_keys).where("ps_listed").drop("ps_listed")


def off_table(rows: DataFrame, key: str, table: DataFrame, value: str = "value", hot_keys: HotKeys | None = None) -> DataFrame:
    """Rows whose key is not in a list table of any size; rows without a key are among them."""
    values = _values(table, value, key).withColumn("ps_listed", F.lit(True))
    return attach_listed(rows, values, key, "ps_listed", hot_keys).where("ps_listed IS NULL").drop("ps_listed")


def _values(table: DataFrame, value: str, key: str) -> DataFrame:
    return table.select(F.col(value).alias(key)).where(F.col(key).isNotNull()).distinct()
