"""Exact top-k by inner product with pivot-table elimination.

Every vector keeps its distances to a few pivots. For a query the largest difference of
pivot distances bounds the distance from below, and with |q - x|^2 = |q|^2 + |x|^2 - 2 q x
the inner product from above. Candidates are evaluated in the order of that bound until it
falls below the k-th score found; nothing after that can change the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postsift.llm.tables import settled

#: Vectors in a block, queries in a block, data blocks that meet a query block in one task.
DATA_BLOCK, QUERY_BLOCK, BLOCKS_A_TASK = 4096, 2048, 4
#: Rows the pivots are chosen from, and pivots.
PIVOT_SAMPLE, PIVOTS = 512, 64
#: Pivots tried on all candidates; the others only on those that these leave, and only where
#: these have eliminated at least such a share: else a bound costs more than the score it saves.
FIRST_PIVOTS, PAYS = 16, 0.25


def whole_vectors(vector: Column, scale: float) -> Column:
    """floor(scale * component) of a usable vector; null if it or a component is null or not finite."""
    usable = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(usable, F.transform(vector, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("double")))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first from the longest vector on."""
    if not len(sample):
        return sample
    chosen = [int(np.argmax((sample**2).sum(axis=1)))]
    far = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


class Best:
    """The k best so far of every query of a block; ties go to the smaller id."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, x, k
        self.far, self.square = distances(x, pivots), (x**2).sum(axis=1)
        self.found = [(np.empty(0), np.empty(0, np.int64)) for _ in ids]
        #: Candidates met, and those of them whose score was computed.
        self.offered = self.evaluated = 0

    def meet(self, ids: np.ndarray, x: np.ndarray, far: np.ndarray) -> None:
        square, first = (x**2).sum(axis=1), np.ascontiguousarray(far[:, :FIRST_PIVOTS])
        for i in range(len(self.ids)):
            size = self.square[i] + square
            scores, partners = self.found[i]
            # Distances carry rounding errors, scores of whole numbers do not.
            slack = 1e-9 * size + 1e-6
            gap = np.abs(first - self.far[i, :FIRST_PIVOTS]).max(axis=1, initial=0)
            bound = (size - gap**2) / 2 + slack
            full = len(scores) == self.k
            left = np.flatnonzero(bound >= scores[-1]) if full else np.arange(len(ids))
            if full and len(left) <= (1 - PAYS) * len(ids):
                gap = np.abs(far[left, FIRST_PIVOTS:] - self.far[i, FIRST_PIVOTS:]).max(axis=1, initial=0)
                bound[left] = np.minimum(bound[left], (size[left] - gap**2) / 2 + slack[left])
                left = left[bound[left] >= scores[-1]]
            left = left[np.argsort(-bound[left], kind="stable")]
            self.offered += len(ids)
            done, step = 0, 4 * self.k
            while done < len(left) and (len(scores) < self.k or bound[left[done]] >= scores[-1]):
                now = left[done : done + step]
                now = now[ids[now] != self.ids[i]]
                scores = np.concatenate([scores, x[now] @ self.x[i]])
                partners = np.concatenate([partners, ids[now]])
                order = np.lexsort((partners, -scores))[: self.k]
                scores, partners = scores[order], partners[order]
                self.evaluated += len(now)
                done, step = done + step, 2 * step
            self.found[i] = scores, partners

    def rows(self, names: list[str]) -> pa.RecordBatch:
        query = np.repeat(self.ids, [len(s) for s, _ in self.found])
        scores = np.concatenate([s for s, _ in self.found])
        partners = np.concatenate([p for _, p in self.found])
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(partners), pa.array(scores.astype(np.int64))], names)


def exact_top_k(rows: DataFrame, is_query: Column, *, k: int = 20, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding", n_pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best candidates of every query.

    Vectors are rounded to floor(scale * component). Queries are the rows for which
    `is_query` holds, candidates all rows but the query's own; with fewer than k of them all
    are returned, so a single row gives none. Vectors that are null or hold a null or
    non-finite component take no part. Of rows that repeat a key the one with the smallest
    vector counts. Shorter vectors count as filled up with zeros. Other columns are not read.

    Vectors and queries are packed into blocks and every query block meets every data block
    by a join on (query block, group of data blocks); only the k best of a group leave its
    task. The pivots, `n_pivots` from a sample of PIVOT_SAMPLE rows, are all the driver sees. More
    of them eliminate more and cost more per candidate: vectors in clusters want hundreds, for
    vectors without any structure a bound costs more than the score it saves.
    """
    usable = rows.select(rows[f"`{key}`"].cast("bigint").alias("vec_id"), whole_vectors(rows[f"`{vector}`"], scale).alias("x"), is_query.alias("asks"))
    once = usable.where("x IS NOT NULL AND vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("x").alias("x"), F.max("asks").alias("asks"))
    once = settled(once)
    largest = F.max(F.greatest(F.array_max("x"), -F.array_min("x")))
    sizes = once.agg(F.count("*"), F.count_if("asks"), F.max(F.size("x")), largest).first()
    n, n_queries, width = (int(v or 0) for v in sizes[:3])
    # Rounded components mostly fit into 16 bits, so blocks travel at a quarter of their size.
    stored_as = "<i2" if (sizes[3] or 0) < 1 << 15 else "<f8"
    sample = once.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("x").collect()

    def matrix(lists: list) -> np.ndarray:
        out = np.zeros((len(lists), width))
        for i, values in enumerate(lists):
            out[i, : len(values)] = values
        return out

    pivots = choose_pivots(matrix([r["x"] for r in sample]), n_pivots)
    groups = max(1, math.ceil(n / (DATA_BLOCK * BLOCKS_A_TASK)))
    query_blocks = max(1, math.ceil(n_queries / QUERY_BLOCK))

    def blocks(limit: int, names: list[str]):
        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                of, ids = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
                x = batch.column(2)
                for number in np.unique(of):
                    at = np.flatnonzero(of == number)
                    for begin in range(0, len(at), limit):
                        some = at[begin : begin + limit]
                        data = matrix(x.take(pa.array(some)).to_pylist())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([number], pa.int32()), pa.array([ids[some].astype("<i8").tobytes()], pa.binary()), pa.array([data.astype(stored_as).tobytes()], pa.binary())], names
                        )

        return packed

    def numbered(frame: DataFrame, parts: int, limit: int, number: str, ids: str, data: str) -> DataFrame:
        dealt = frame.select(F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias(number), "vec_id", "x")
        near = dealt.repartition(parts, number) if parts > 1 else dealt.coalesce(1)
        return near.mapInArrow(blocks(limit, [number, ids, data]), f"{number} int, {ids} binary, {data} binary")

    data = numbered(once, groups, DATA_BLOCK, "grp", "data_ids", "data")
    queries = numbered(once.where("asks"), query_blocks, QUERY_BLOCK, "part", "query_ids", "queries")
    data = data.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = queries.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    names = ["query_id", "vec_id", "score"]

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, now = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, q_x, d_ids, d_x = (batch.column(c)[row].as_buffer() for c in range(4))
                q = np.frombuffer(q_ids, "<i8")
                if best is None or now != q_ids:
                    if best is not None:
                        yield best.rows(names)
                    best, now = Best(q, np.frombuffer(q_x, stored_as).reshape(len(q), -1).astype(float), pivots, k), q_ids
                ids = np.frombuffer(d_ids, "<i8")
                x = np.frombuffer(d_x, stored_as).reshape(len(ids), -1).astype(float)
                best.meet(ids, x, distances(x, pivots))
        if best is not None:
            yield best.rows(names)

    pairs = queries.join(data, ["part", "grp"]).sortWithinPartitions("part", "grp")
    found = pairs.select("query_ids", "queries", "data_ids", "data").mapInArrow(met, "query_id bigint, vec_id bigint, score bigint")
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
