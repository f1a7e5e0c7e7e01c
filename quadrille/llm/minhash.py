"""Operator 3: near-duplicate detection with ProbMinHash.

A document is the multiset of its word 5-shingles, weighted by how often each
occurs (fewer than five words: one shingle of them all). Every shingle starts a
Poisson process whose rate is its weight; its points arrive at exponential
distances and fall into one of the signature's slots, and each slot keeps the
shingle of its earliest point. A shingle is done as soon as its next point
comes later than the latest of all slots. Two documents agree in a slot with
the probability of their probability Jaccard similarity.

Candidates come from bands of the signature. Documents of equal words are one
node before any pair is made. A band key's nodes are not paired with each
other but with two hubs, the node that shares the most keys with others and one
that is another in every bucket. A pair goes through a comparison of short
signatures and then an exact computation of the similarity from the texts.
Classes are the connected components of the exact links.

What hubs leave open are buckets that still hold several classes. Their nodes
are compared with each other inside tasks, block by block where a bucket is
large: short signatures first, which keep the nodes that have a near partner in
another class, then the exact similarity from these nodes' texts. A task returns
links between classes only, and none between classes that it has linked
already, so pairs are never rows. A pair that shares several bands is looked at
in one of them. Such links join classes to classes, not nodes to nodes.

Null texts and texts without words have no shingles; each is a class of its
own. Rows with equal ids are rows of their own; a class is named by its
smallest id (null if it has none). A node is named by a 64-bit hash of its words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import U64

SHINGLE, SLOTS, BANDED, ROWS = 5, 256, 128, 4  # bands are made of the first BANDED slots
BLOCK, BLOCK_BYTES = 4096, 8 << 20  # nodes of a bucket, and bytes of their texts, that a task compares with as many others
PAIRS = 1 << 15  # pairs of nodes compared at once
_GOLDEN = U64(0x9E3779B97F4A7C15)


def shingles(words: common.Words, hashes: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts: (text, hash, count), ordered by text and hash."""
    text_of = words.text_of()
    n = len(hashes)
    grams = common.ngram_hashes(hashes, size)
    whole = np.arange(n)[: len(grams)] + size <= words.offsets[1:][text_of[: len(grams)]] if n else np.zeros(0, bool)
    t, h = text_of[: len(grams)][whole], grams[whole]
    for k in np.flatnonzero((words.counts > 0) & (words.counts < size)):
        part = hashes[words.offsets[k] : words.offsets[k + 1]]
        t = np.append(t, k)
        h = np.append(h, common.ngram_hashes(part, len(part), seed=len(part)))
    order = np.lexsort((h, t))
    t, h = t[order], h[order]
    first = np.ones(len(h), bool)
    first[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
    where = np.flatnonzero(first)
    return t[where], h[where], np.diff(np.append(where, len(h)))


def prob_minhash(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (n x slots, the winning elements) of weighted sets given as (text, element, weight)."""
    earliest = np.full(n * slots, np.inf)
    winner = np.zeros(n * slots, U64)
    rate = weight.astype(np.float64)
    at = np.zeros(len(element))
    step = 0
    while len(element):
        # Several points at once where few shingles are left, within a bound on the arrays.
        points = max(1, min(16, (1 << 16) // len(element)))
        index = np.arange(step + 1, step + points + 1, dtype=U64)
        draw = common.mix(element[:, None] + index[None, :] * _GOLDEN)
        gap = -np.log(((draw >> U64(24)).astype(np.float64) + 0.5) / float(1 << 40)) / rate[:, None]
        arrival = at[:, None] + np.cumsum(gap, axis=1)
        slot = ((draw & U64(0xFFFFFF)) * U64(slots)) >> U64(24)
        latest = earliest.reshape(n, slots).max(axis=1)
        early = arrival < latest[text][:, None]
        flat = (text[:, None] * slots + slot.astype(np.int64))[early]
        when = arrival[early]
        who = np.broadcast_to(element[:, None], arrival.shape)[early]
        np.minimum.at(earliest, flat, when)
        won = earliest[flat] == when
        winner[flat[won]] = who[won]
        at = arrival[:, -1]
        latest = earliest.reshape(n, slots).max(axis=1)
        going = at < latest[text]
        text, element, rate, at = text[going], element[going], rate[going], at[going]
        step += points
    return winner.reshape(n, slots)


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    n, slots = signatures.shape
    bands = signatures.reshape(n, slots // rows, rows)
    out = np.zeros((n, slots // rows), U64)
    for k in range(rows):
        out = common.mix(out * U64(3) + bands[:, :, k])
    return common.mix(out + np.arange(slots // rows, dtype=U64) * _GOLDEN)


def probability_jaccard(x: dict[int, int] | tuple, y: dict[int, int] | tuple) -> float:
    """The exact probability Jaccard similarity of two weighted sets, as (sorted elements, weights)."""
    (a, p), (b, q) = ((np.array(sorted(v), np.uint64), np.array([v[k] for k in sorted(v)])) if isinstance(v, dict) else v for v in (x, y))
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    j = np.flatnonzero(a[at] == b)
    if not len(j):
        return 0.0
    i = at[j]
    if len(a) == p.sum() and len(b) == q.sum():  # all weights are 1: plain Jaccard
        return len(j) / (len(a) + len(b) - len(j))
    u, v = p[i].astype(np.float64), q[j].astype(np.float64)
    only_x, only_y = p.sum() - u.sum(), q.sum() - v.sum()
    # For element i the sum over j of max(x_j / x_i, y_j / y_i): j with at least i's ratio x / y count by x, others by y.
    ratio = u / v
    order = np.argsort(ratio, kind="stable")
    u, v, ratio = u[order], v[order], ratio[order]
    from_here = np.searchsorted(ratio, ratio, "left")
    x_above = only_x + (u.sum() - np.concatenate([[0.0], np.cumsum(u)])[from_here])
    y_below = only_y + np.concatenate([[0.0], np.cumsum(v)])[from_here]
    return float((1.0 / (x_above / u + y_below / v)).sum())


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    common.make_room("minhash")
    for batch in batches:
        texts = common.Texts(batch.column("text"))
        for i, j in texts.chunks():
            words = common.Words(texts, i, j)
            hashes = words.hashes()
            t, h, w = shingles(words, hashes)
            made = prob_minhash(t, h, w, j - i)
            total = np.concatenate([np.zeros(1, U64), np.cumsum(common.mix(hashes + np.arange(len(hashes), dtype=U64) * _GOLDEN - (words.offsets[:-1].astype(U64) * _GOLDEN)[words.text_of()]))])
            node = common.mix(total[words.offsets[1:]] - total[words.offsets[:-1]] + words.counts.astype(U64))
            keys = band_keys(made[:, :BANDED])
            blank = pa.array(words.counts == 0)
            keep = [batch.column(k)[i:j] for k in ("__id", "__rk", "doc_id")]
            size = pa.array(np.diff(texts.offsets[i : j + 1]))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * keys.shape[1]), pa.array(common.signed(keys.ravel()), pa.int64()))
            # Four bits of every slot, as four planes of one bit each.
            planes = np.hstack([np.packbits(((made >> U64(k)) & U64(1)).astype(bool), axis=1).view(np.int64) for k in range(4)])
            planes = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * planes.shape[1]), pa.array(planes.ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([*keep, blank, pa.array(common.signed(node)), size, lists, planes], names=["__id", "__rk", "doc_id", "blank", "node", "size", "bands", "planes"])


_SIGNED = "__id long, __rk long, doc_id long, blank boolean, node long, size long, bands array<long>, planes array<long>"


def _verify(least: float, rows: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.make_room("minhash")
        for whole in batches:
            for start in range(0, whole.num_rows, rows):  # the shingles of a few hundred pairs at a time
                batch = whole.slice(start, rows)
                sides = [_weighted(common.Texts(batch.column(name))) for name in ("text_a", "text_b")]
                similarity = np.array([probability_jaccard(x, y) for x, y in zip(*sides)])
                kept = pa.array(similarity >= least - 1e-12)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(similarity, pa.float64())], names=["a", "b", "similarity"]).filter(kept)

    return run


def _weighted(texts: common.Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """The weighted shingles of each text."""
    out: list[tuple] = []
    for i, j in texts.chunks():
        words = common.Words(texts, i, j)
        t, h, w = shingles(words, words.hashes())
        cut = np.searchsorted(t, np.arange(j - i + 1))
        out += [(h[a:b], w[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    return out


def far(least: float) -> int:
    """How many slots may differ in their lowest four bits for a closer look: five deviations over what is expected at similarity `least` (80 at 0.8)."""
    differ = (1 - least) * 15 / 16
    return min(SLOTS, math.ceil(SLOTS * differ + 5 * math.sqrt(SLOTS * differ * (1 - differ))))


def _near(a: str, b: str, least: float) -> Column:
    """Whether two short signatures (columns of planes) differ in so few slots that the similarity may be `least`."""
    width = SLOTS // 64
    differ = [F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))) for i in range(4 * width)]
    return reduce(Column.__add__, [F.bit_count(reduce(Column.bitwiseOR, differ[k::width])) for k in range(width)]) <= far(least)


def _hub_pairs(buckets: DataFrame) -> DataFrame:
    """Pairs (a, b) of every node of a bucket with its two hubs; buckets: (key, node, n)."""
    weight = buckets.groupBy("node").agg(F.sum("n").alias("w"))
    other = F.struct(F.xxhash64("key", "node").alias("h"), "node")
    hubs = buckets.join(weight, "node").groupBy("key").agg(F.max(F.struct("w", "node")).alias("x"), F.max(other).alias("y"))
    hubs = hubs.select("key", F.explode(F.array_distinct(F.array("x.node", "y.node"))).alias("hub"))
    return buckets.join(hubs, "key").where("node != hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


_OPEN = "key long, low int, high int, node long, root long, block int, band int, major long, bands array<long>, planes array<long>"
_GROUP = ["key", "low", "high"]


def _open_rows(classed: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows (_OPEN) of the nodes of buckets (key, node, band, size, root) that hold several classes, once for each pair of blocks.

    Two nodes that are a whole bucket were node and hub. major is the class with most of a bucket's nodes.
    """
    per_class = classed.groupBy("key", "root").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    several = per_class.groupBy("key").agg(F.count("*").alias("classes"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "root")).alias("most")).where("classes > 1 and n > 2")
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES, F.lit(1.0))).cast("int")
    rows = classed.join(several.select("key", blocks.alias("blocks"), F.col("most.root").alias("major")), "key")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("block", "met"), "high": F.greatest("block", "met")})
    return rows.join(nodes.select("node", "bands", "planes"), "node").select(*[c.split()[0] for c in _OPEN.split(", ")])


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP)


class _Open:
    """The nodes of one group of _OPEN rows as arrays."""

    def __init__(self, group: pa.Table):
        self.node, self.root, self.block, major, band, low, high = (group[k].to_numpy() for k in ("node", "root", "block", "major", "band", "low", "high"))
        self.bands, self.planes = (group[k].combine_chunks().flatten().to_numpy().view(U64).reshape(len(group), -1) for k in ("bands", "planes"))
        self.minor = np.flatnonzero(self.root != major)
        self.is_minor = self.root != major
        self.band, self.across = int(band[0]), low[0] != high[0]

    def candidates(self, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of positions in different classes whose short signatures differ in at most `most` slots, with that number."""
        n, width = len(self.node), SLOTS // 64
        step = max(1, PAIRS // n)
        for start in range(0, len(self.minor), step):
            i = self.minor[start : start + step]
            # One of two is in a minor class; where both are, the pair is met once.
            fits = (self.root[i][:, None] != self.root[None, :]) & (~self.is_minor[None, :] | (i[:, None] < np.arange(n)[None, :]))
            if self.across:
                fits &= self.block[i][:, None] != self.block[None, :]
            x, j = np.nonzero(fits)
            i = i[x]
            parts = [self.planes[i, k * width : (k + 1) * width] ^ self.planes[j, k * width : (k + 1) * width] for k in range(4)]
            differ = np.bitwise_count(parts[0] | parts[1] | parts[2] | parts[3]).sum(axis=1)
            near = np.flatnonzero(differ <= most)
            i, j, differ = i[near], j[near], differ[near]
            # Of the bands that both share, one that their names settle.
            low, high = np.minimum(self.node[i], self.node[j]).view(U64), np.maximum(self.node[i], self.node[j]).view(U64)
            turn = common.mix((low * U64(3) + high)[:, None] + np.arange(self.bands.shape[1], dtype=U64)[None, :] * _GOLDEN) >> U64(1)
            turn = np.where(self.bands[i] == self.bands[j], turn, ~U64(0))
            here = turn.argmin(axis=1) == self.band if len(i) else np.zeros(0, bool)
            yield i[here], j[here], differ[here]


def _with_partners(most: int):
    """Rows of nodes that have a candidate in their group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.make_room("minhash")
        for group in common.groups(batches, _GROUP):
            marked = np.zeros(len(group), bool)
            for i, j, _ in _Open(group).candidates(most):
                marked[i] = marked[j] = True
            if marked.any():
                yield from group.filter(pa.array(marked)).to_batches()

    return run


def _class_links(least: float, most: int):
    """Links (a, b) between classes, from groups of _OPEN rows with texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.make_room("minhash")
        for group in common.groups(batches, _GROUP):
            made = _Open(group)
            shingled = _weighted(common.Texts(group["text"]))
            over: dict[int, int] = {}

            def top(x: int) -> int:
                while x in over:
                    x = over[x]
                return x

            found: list[tuple[int, int]] = []
            for i, j, differ in made.candidates(most):
                for k in np.argsort(differ, kind="stable").tolist():
                    p, q = int(i[k]), int(j[k])
                    a, b = top(int(made.root[p])), top(int(made.root[q]))
                    if a != b and probability_jaccard(shingled[p], shingled[q]) >= least - 1e-12:
                        found.append((int(made.root[p]), int(made.root[q])))
                        over[max(a, b)] = min(a, b)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (__id, __rk, doc_id, class_id, class_size, keep): one for each row of docs.

    keep marks one row of each class: the one with the smallest id (nulls
    last), and of equal rows any one.
    """
    keyed = common.row_keys(docs, id_col, text_col)
    signed = common.materialize(keyed.mapInArrow(_sign, _SIGNED), "signatures")
    solid = signed.where("not blank")

    # Copies of a document are one node; whatever stands beside a node's name is the same in all of them, or any one.
    row = F.struct("__id", "__rk")
    nodes = common.materialize(solid.groupBy("node").agg(F.min(row).alias("r"), F.min("size").alias("size"), F.min("bands").alias("bands"), F.min("planes").alias("planes")).select("node", "r.*", "size", "bands", "planes"), "nodes")
    rows = nodes.select(F.posexplode("bands").alias("band", "key"), "node", "size")
    shared = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = common.materialize(rows.join(shared, "key"), "buckets")

    met = nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "__id", "__rk")
    wanted = common.key_filter(met, "__rk")
    texts = common.filtered_texts(keyed, wanted, ["__id", "__rk", "text"]).join(met, ["__id", "__rk"]).dropDuplicates(["node"])
    texts = common.materialize(texts.select("node", "text"), "node-texts")

    def sides(pairs: DataFrame, table: DataFrame, name: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(table.select(F.col("node").alias(side), F.col(name).alias(f"{name}_{side}")), side)
        return pairs

    near = sides(_hub_pairs(buckets), nodes, "planes").where(_near("planes_a", "planes_b", least)).select("a", "b")
    links = sides(common.materialize(near, "hub-pairs"), texts, "text").select("a", "b", "text_a", "text_b")
    links = common.materialize(links.mapInArrow(_verify(least), "a long, b long, similarity double"), "links")
    roots = common.components(links)

    classed = buckets.join(roots, "node", "left").select("key", "node", "band", "size", F.coalesce("root", "node").alias("root"))
    opened = _dealt(_open_rows(classed, nodes)).mapInArrow(_with_partners(far(least)), _OPEN)
    opened = _dealt(opened.join(texts, "node").select(*opened.columns, "text"))
    more, seen = common.observed(opened.mapInArrow(_class_links(least, far(least)), "a long, b long"), "class-links", {"n": F.count(F.lit(1))}, small=True)

    classed = solid.select("__id", "__rk", "doc_id", "node").join(roots, "node", "left").select("__id", "__rk", "doc_id", F.coalesce("root", "node").alias("root"))
    if seen["n"]:
        joined = common.components(more).select(F.col("node").alias("root"), F.col("root").alias("joined"))
        classed = classed.join(joined, "root", "left").select("__id", "__rk", "doc_id", F.coalesce("joined", "root").alias("root"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__rk")
    sums = classed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.min(order).alias("first"))
    out = classed.join(sums, "root").select("__id", "__rk", "doc_id", "class_id", "class_size", (order == F.col("first")).alias("keep"))
    single = signed.where("blank").select("__id", "__rk", "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("keep"))
    return out.unionByName(single)


def keep_one(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without all but one row of each class of near duplicates; columns as they were, whatever their names."""
    names = dict(zip(docs.columns, inner := [f"c{k}" for k in range(len(docs.columns))]))
    rows = docs.toDF(*inner)
    found = near_duplicates(rows, least, names[id_col], names[text_col])
    # Rows that repeat id and text are one row of the class.
    marks = found.groupBy("__id", "__rk").agg(F.max("keep").alias("keep"), F.max("class_size").alias("size"), F.count("*").alias("n"))
    marks, seen = common.observed(marks.where("not keep or (n > 1 and size > 1)"), "marks", {"most": F.max(F.when(F.col("keep"), F.col("n")))}, small=True)
    rest = rows.withColumns({"__id": F.coalesce(F.col(names[id_col]).cast("long"), F.lit(-1)), "__rk": F.xxhash64(names[id_col], names[text_col])})
    key = ["__id", "__rk"]
    kept = rest.join(marks.where("not keep").select(*key), key, "left_anti")
    if seen["most"]:  # equal rows: any one of them
        again = marks.where("keep").select(*key)
        kept = kept.join(again, key, "left_anti").unionByName(kept.join(again, key, "left_semi").dropDuplicates(key))
    return kept.select(*inner).toDF(*docs.columns)
