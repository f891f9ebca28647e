"""The prefix trie of conversations, by vertical bitmaps.

Conversations are dealt into shards of whole blocks of ids. A shard indexes every (position,
turn) to the bitset of the conversations that have it there; starting from the bitset of all,
the intersection of a node's bitset with the postings of the next position yields its children,
their popcounts and the lists of conversations that end there. Shards are then merged by the
digest of the prefix. What a shard says about a node that no other shard has is final; for the
nodes that several shards share (the top of the trie), counts are corrected for what was counted
once per shard.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsift.llm.tables import stored

#: Conversations whose ids agree but for the last two digits share a beginning.
BLOCK = 100
#: A conversation takes fewer than so many first turns from the first of its block.
MOST_SHARED = 6
#: Ids of a shard, whole blocks.
SHARD_IDS = 10 * BLOCK

ROOT = bytes(16)
NOTHING = hashlib.sha256(b"").hexdigest()
ENDS = ("ends_0", "ends_1", "ends_2", "ends_3")

NODES = T.StructType(
    [
        T.StructField("shard", T.LongType()),
        T.StructField("place", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("node", T.BinaryType()),
        T.StructField("parent", T.BinaryType()),
        T.StructField("depth", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("parent_conv_id", T.LongType()),
        T.StructField("n_convs", T.LongType()),
        T.StructField("n_children", T.LongType()),
        T.StructField("n_leaves", T.LongType()),
        T.StructField("saved", T.LongType()),
        *(T.StructField(name, T.LongType()) for name in ENDS),
        T.StructField("first_end", T.LongType()),
        T.StructField("ends", T.StringType()),
    ]
)

Turn = tuple[bytes, int]


@dataclass
class Shard:
    """Conversations of one shard as lists of (digest, code points) per turn."""

    number: int
    turns: dict[int, list[Turn]] = field(default_factory=dict)

    def rebuilt(self) -> dict[int, list[Turn]]:
        """Every conversation behind the first turns of the first one of its block, ids ascending."""
        out = {}
        for c in sorted(self.turns):
            first = c - (abs(c) % BLOCK if c >= 0 else -(abs(c) % BLOCK))
            h = zlib.crc32(str(c).encode()) % MOST_SHARED
            out[c] = self.turns.get(first, [])[:h] + self.turns[c][h:]
        return out

    def nodes(self) -> list[tuple]:
        """The trie of the shard, parents ahead of children, as rows of NODES."""
        convs = self.rebuilt()
        ids, paths = list(convs), list(convs.values())
        postings: list[dict[bytes, int]] = [{} for _ in range(max(map(len, paths), default=0))]
        ended: list[int] = [0] * (len(postings) + 1)
        for k, path in enumerate(paths):
            ended[len(path)] |= 1 << k
            for index, (turn, _) in zip(postings, path, strict=False):
                index[turn] = index.get(turn, 0) | 1 << k
        rows: list[list] = []
        todo = [((1 << len(ids)) - 1, 0, -1, ROOT, 0)] if ids else []
        while todo:
            members, depth, above, node, n_chars = todo.pop()
            place = len(rows)
            smallest = ids[(members & -members).bit_length() - 1]
            here = members & ended[depth]
            rest, n_children = members ^ here, 0
            while rest:
                turn, size = paths[(rest & -rest).bit_length() - 1][depth]
                child = rest & postings[depth][turn]
                todo.append((child, depth + 1, place, hashlib.blake2b(node + turn, digest_size=16).digest(), size))
                rest ^= child
                n_children += 1
            n_convs = members.bit_count()
            ends = ",".join(str(ids[k]) for k in bits(here)) if here else None
            sums = np.frombuffer(hashlib.sha256(ends.encode()).digest(), ">i8").tolist() if here else [None] * 4
            first = ids[(here & -here).bit_length() - 1] if here else None
            parent, parent_conv = (rows[above][3], rows[above][7]) if above >= 0 else (None, None)
            rows.append([self.number, place, above, node, parent, depth, n_chars, smallest, parent_conv, n_convs, n_children,
                         int(n_children == 0), (n_convs - 1) * n_chars, *sums, first, ends])
        last = list(range(len(rows)))
        for place in range(len(rows) - 1, 0, -1):
            row, above = rows[place], rows[place][2]
            upper = rows[above]
            upper[11] += row[11]
            upper[12] += row[12]
            last[above] = max(last[above], last[place])
        for place, row in enumerate(rows):
            row[2] = last[place]
        return rows


def bits(members: int) -> Iterator[int]:
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


def shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tries of all shards of a partition that is sorted by shard, conversation and turn."""
    names = NODES.names
    kinds = [pa.binary() if f.dataType == T.BinaryType() else pa.string() if f.dataType == T.StringType() else pa.int64() for f in NODES]

    def told(shard: Shard) -> pa.RecordBatch:
        columns = zip(*shard.nodes(), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    shard = None
    for batch in batches:
        for number, conv, turn, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if shard is None or shard.number != number:
                if shard is not None:
                    yield told(shard)
                shard = Shard(number)
            shard.turns.setdefault(conv, []).append((turn, size))
    if shard is not None:
        yield told(shard)


def joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lists of each node, which come in order; no list is held whole."""
    node, running = None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()])], ["node", "joined"])

    for batch in batches:
        for key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key == node:
                running.update(b",")
            else:
                if node is not None:
                    yield told()
                node, running = key, hashlib.sha256()
            running.update(part.encode())
    if node is not None:
        yield told()


def subtree_corrections(part: pa.Table) -> pa.Table:
    """Sums of the corrections below every shared node of one shard."""
    part = part.sort_by("place")
    place, last = (part.column(c).to_numpy() for c in ("place", "last"))
    end = np.searchsorted(place, last, "right")
    begin = np.arange(len(place))
    sums = []
    for name in ("saved", "leaves"):
        total = np.concatenate([[0], np.cumsum(part.column(name).to_numpy())])
        sums.append(pa.array(total[end] - total[begin], pa.int64()))
    return pa.table([part.column("node"), *sums], ["node", "saved", "leaves"])


def prefix_trie(conversations: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations.

    Turns are ordered by `turn` (null first), then role and text; a null role or text is empty.
    Repeated rows are turns of their own. Rows without a conversation id take no part. An empty
    table has no node, not even a root. Texts are read whole, and only their digests (SHA-256)
    reach a trie, so a long text costs no memory there. A conversation is held by one task, with
    some 500 bytes a turn. Other columns are not read.

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and node and parent, the digests that name a prefix.
    """
    c, r, t = F.col("conv_id"), F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    given = conversations.select(
        conversations[f"`{key}`"].cast("bigint").alias("conv_id"),
        conversations[f"`{turn}`"].alias("turn"),
        conversations[f"`{role}`"].alias("role"),
        conversations[f"`{text}`"].alias("text"),
    ).where("conv_id IS NOT NULL")
    first_of_block = c - c % BLOCK
    dealt = given.select(F.floor(first_of_block / SHARD_IDS).alias("shard"), c, "turn", r.alias("role"), t.alias("text"))
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "conv_id", F.asc_nulls_first("turn"), "role", "text")
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    turns = ordered.select("shard", "conv_id", said.alias("said"), F.length("text").cast("bigint").alias("n_chars"))
    found = stored(turns.mapInArrow(shard_nodes, NODES))

    nodes = stored(
        found.groupBy("node", "parent", "depth", "n_chars").agg(
            F.min("conv_id").alias("conv_id"),
            F.min("parent_conv_id").alias("parent_conv_id"),
            F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("childless"),
            F.sum("saved").alias("saved"),
            F.count("*").alias("n_shards"),
            F.count("first_end").alias("n_ends"),
            *(F.max(name).alias(name) for name in ENDS),
        )
    )
    shared = nodes.where("n_shards > 1")

    # A child that k shards have was counted k times as a child of its parent.
    twice = shared.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.sum(F.col("n_shards") - 1).alias("twice"))
    counted = stored(shared.join(twice, "node", "left").withColumn("n_children", F.col("n_children") - F.coalesce("twice", F.lit(0))).drop("twice"))

    # Each shard left out one member of the node, and a node may be childless in some shards only.
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(0) - F.col("childless")
    wanted = counted.select("node", F.col("conv_id").alias("owner"), ((F.col("n_shards") - 1) * F.col("n_chars")).alias("saved"), leaves.alias("leaves"))
    owned = F.col("conv_id") == F.col("owner")
    placed = found.select("shard", "place", "last", "node", "conv_id").join(wanted, "node")
    placed = placed.select("shard", "place", "last", "node", *(F.when(owned, F.col(n)).otherwise(0).cast("bigint").alias(n) for n in ("saved", "leaves")))
    below = placed.groupBy("shard").applyInArrow(subtree_corrections, "node binary, saved bigint, leaves bigint")
    below = below.groupBy("node").agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))

    lists = found.where("ends IS NOT NULL").select("node", "ends", "first_end").join(counted.where("n_ends > 1").select("node"), "node")
    lists = lists.repartition("node").sortWithinPartitions("node", "first_end").select("node", "ends")
    joined = lists.mapInArrow(joined_ends, "node binary, joined string")

    alone = F.when(F.col("n_ends") == 0, F.lit(NOTHING)).otherwise(F.lower(F.concat(*(F.lpad(F.hex(name), 16, "0") for name in ENDS))))
    corrected = counted.join(below, "node", "left").join(joined, "node", "left")
    columns = ["node", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children"]
    whole = corrected.select(
        *columns,
        (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"),
        (F.col("saved") + F.col("more_saved")).alias("saved_tokens"),
        F.coalesce("joined", alone).alias("ends_sha256"),
    ).unionByName(nodes.where("n_shards = 1").select(*columns, "n_leaves", F.col("saved").alias("saved_tokens"), alone.alias("ends_sha256")))

    # The smallest member of a shared parent may be known to another shard only.
    parents = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("smallest"))
    return whole.join(parents, "parent", "left").select(
        "conv_id", "depth", F.coalesce("smallest", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "node", "parent"
    )
