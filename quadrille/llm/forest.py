"""Operator 5: approximate nearest neighbours with a forest of hash prefixes.

Vectors are dealt to blocks of bounded size. In a block every tree is a sorted
array of long hash strings, one bit for each random direction: whether the
projection is above the block's median. A query descends in each tree to its
longest matching prefixes, by binary search in the sorted array. Then all trees
ascend together, one bit at a time; a row gains a point in each tree and level
where it lies below the query's prefix, so a row's points are the lengths of
the prefixes that it shares with the query, summed over the trees. The ascent
ends when the trees together hold `reach` places for each row that may be
compared, and the rows with the most points are compared exactly, in double
precision: at most a share of the block.

In a cluster prefixes are long and the ascent ends deep, so few rows are
touched; vectors without any structure share short prefixes only, and there the
points are what singles out the near ones.

Equal vectors share all prefixes and lead the points, so of a crowd of equal
vectors a query meets those with the smallest ids: of each vector only as many
rows as can be neighbours, those with the smallest ids, are indexed at all. A
vector that a third of all rows have is a few rows for each task and no more.

The stated query set is compared with every block: a task holds one block and
one chunk of queries, so each vector is sent once for each chunk and each query
once for each block, and both are large. The best of all blocks are merged by
query.

Vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do rows without an id. Rows that repeat
id and vector are one candidate, and one query. A row with the query's id is
not a candidate of it. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TREES, BITS = 96, 32
#: Of a block's rows, the share that a query is compared with at most, and how many places (in all trees) the ascent
#: gathers for each row of the block.
SHARE, REACH = 0.15, 12.0
#: A query is compared with this many rows of a block at least.
FEWEST = 256


def usable(vector: Column, dims: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dims) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Forest:
    """The trees of one block."""

    def __init__(self, vectors: np.ndarray, trees: int, bits: int, seed: int = 7):
        self.trees, self.bits = trees, bits
        rng = np.random.default_rng(seed)
        self.directions = rng.standard_normal((vectors.shape[1], trees * bits)).astype(np.float32)
        scale = np.abs(vectors).max() if len(vectors) else 0
        self.scale = scale if scale > 0 else 1.0
        self.cuts = np.empty(trees * bits, np.float32)
        self.sorted = np.empty((trees, len(vectors)), np.uint64)
        self.order = np.empty((trees, len(vectors)), np.int32)
        small = (vectors / self.scale).astype(np.float32)
        for t in range(trees):  # one tree's projections at a time
            part = slice(t * bits, (t + 1) * bits)
            projected = small @ self.directions[:, part]
            self.cuts[part] = np.median(projected, axis=0)
            strings = self._strings(projected, part)
            self.order[t] = np.argsort(strings, kind="stable")
            self.sorted[t] = strings[self.order[t]]

    def _strings(self, projected: np.ndarray, part: slice) -> np.ndarray:
        ones = np.packbits(projected > self.cuts[part], axis=-1)
        wide = np.zeros((*ones.shape[:-1], 8), np.uint8)
        wide[..., : ones.shape[-1]] = ones
        return wide.view(">u8")[..., 0].astype(np.uint64)  # the first bit is the highest

    def candidates(self, queries: np.ndarray, most: int, reach: float) -> Iterator[np.ndarray]:
        """For each query, at most `most` rows (more where the last have equal points), those with the longest common prefixes."""
        n = self.sorted.shape[1]
        projected = (queries / self.scale).astype(np.float32) @ self.directions
        lows = np.empty((self.bits + 1, len(queries), self.trees), np.int32)
        highs = np.empty_like(lows)
        for t in range(self.trees):
            part = slice(t * self.bits, (t + 1) * self.bits)
            strings = self._strings(projected[:, part], part)
            for level in range(self.bits + 1):
                rest = np.uint64(0xFFFFFFFFFFFFFFFF) >> np.uint64(level) if level else np.uint64(0xFFFFFFFFFFFFFFFF)
                lows[level, :, t] = np.searchsorted(self.sorted[t], strings & ~rest)
                highs[level, :, t] = np.searchsorted(self.sorted[t], strings | rest, "right")
        held = (highs - lows).sum(axis=2, dtype=np.int64)
        enough = min(reach * n, float(n) * self.trees)
        deepest = (held >= enough).sum(axis=0) - 1  # held shrinks with depth
        for q, stop in enumerate(deepest.tolist()):
            points = np.zeros(n, np.int32)
            for level in range(self.bits, max(stop, 1) - 1, -1):
                spans = [self.order[t, a:b] for t, (a, b) in enumerate(zip(lows[level, q].tolist(), highs[level, q].tolist())) if a < b]
                if spans:
                    points += np.bincount(np.concatenate(spans), minlength=n).astype(np.int32)
            if n > most:
                least = np.partition(points, n - most)[n - most]
                yield np.flatnonzero(points >= max(least, 1)) if least > 0 else np.flatnonzero(points)
            else:
                yield np.arange(n)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(rows), -1) if len(rows) else flat.reshape(0, 0)


def search(embeddings: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 1 << 15, chunk_rows: int = 1 << 15, trees: int = TREES, bits: int = BITS, share: float = SHARE, reach: float = REACH) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest found of every query."""
    sizes = embeddings.where(F.col(vector_col).isNotNull()).groupBy(F.size(vector_col).alias("n")).agg(F.count("*").alias("c"))
    most = sizes.orderBy(F.desc("c"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if most is None or not most.n:
        return embeddings.sparkSession.createDataFrame([], schema)
    blocks = -(-most.c // block_rows)
    rows = embeddings.where(F.col(id_col).isNotNull() & usable(F.col(vector_col), most.n))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("is_query"))
    asked = rows.where("is_query").select("vec_id", "v").distinct()
    chunks = max(1, -(-asked.count() // chunk_rows))
    # Of equal vectors the k + 1 smallest ids: one of them may be the query itself. Limited by task before the shuffle.
    alike = Window.partitionBy(F.xxhash64("v"), "v").orderBy("vec_id")
    indexed = rows.select("vec_id", "v", F.dense_rank().over(alike).alias("r")).where(F.col("r") <= k + 1).select("vec_id", "v").distinct()

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    chunk = F.pmod(F.xxhash64(F.lit(1), F.col("vec_id")), F.lit(chunks)).cast("int")
    index = indexed.select(block.alias("block"), every(chunks).alias("chunk"), "vec_id", "v")
    queries = asked.select(every(blocks).alias("block"), chunk.alias("chunk"), "vec_id", "v")

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if len(left) and len(right):
            ids, vectors = left["vec_id"].to_numpy(), _matrix(left["v"])
            by_id = np.argsort(ids, kind="stable")  # so that a block is the same in whatever order its rows come
            ids, vectors = ids[by_id], vectors[by_id]
            forest = Forest(vectors, trees, bits)
            asked_ids, asked_vectors = right["vec_id"].to_numpy(), _matrix(right["v"])
            enough = max(FEWEST, k + 1, int(share * len(ids)))
            for start in range(0, len(asked_ids), 64):
                part = slice(start, start + 64)
                for q, v, found in zip(asked_ids[part], asked_vectors[part], forest.candidates(asked_vectors[part], enough, reach)):
                    found = found[ids[found] != q]
                    with np.errstate(over="ignore"):
                        d = np.sqrt(((vectors[found] - v) ** 2).sum(axis=1))
                    if len(found) > k:
                        near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
                        found, d = found[near], d[near]
                    best = np.lexsort((ids[found], d))[:k]
                    out[0] += [q] * len(best)
                    out[1] += ids[found[best]].tolist()
                    out[2] += d[best].tolist()
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(out, kinds)], names=["query_id", "vec_id", "score"])

    found = index.groupBy("block", "chunk").cogroup(queries.groupBy("block", "chunk")).applyInArrow(match, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    # One id may have several vectors: its nearest counts, once.
    nearest = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = nearest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
