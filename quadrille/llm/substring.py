"""Operator 1: substring deduplication by seed and extend.

Seeds. Of every `least` consecutive words the run of `seed` words with the
smallest hash (the leftmost of equals) is the anchor, so equal windows have
equal anchors at equal places. Anchors are counted over the whole corpus; only
places of anchors that occur twice or more go on.

Extension. An anchor serves a run of windows; the longest stretch around it
that they cover is its context, to the left and to the right. Anchors are
joined on the anchor and its context at once: where two are equal throughout,
the whole stretch is a repeat and is settled without looking at windows. Where
the contexts of an anchor differ, the match ends inside, and the windows of
one place for each distinct context are compared to find how far it reaches.
Counting (anchor, context) and windows by partial aggregates means that a
passage that a third of all documents hold is one row for each task, and no
pairs of places are ever made.

Repeats of at least `least` words are the unions of repeated windows, so the
words to remove are those that a repeated window covers. Windows are judged
on the input. Contents are named by two 64-bit hashes: anchor and context, or two of a
window.

Null is the empty text and has no words. Rows that repeat id and text count as
places of their own, so each is a copy of the other. Rows with equal ids and
other texts are told apart. Texts with fewer words than `least` lose nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .common import U64


class _Anchors:
    """The windows of some texts, and the anchor of each."""

    def __init__(self, texts: common.Texts, i: int, j: int, least: int, seed: int):
        self.words = words = common.Words(texts, i, j)
        self.hashes = words.hashes()
        self.least = least
        n = len(self.hashes)
        self.grams = common.ngram_hashes(self.hashes, seed)
        span = least - seed + 1  # seeds in a window
        index = np.arange(len(self.grams))
        size = 1
        while size * 2 <= span:
            index = self._lower(index, size)
            size *= 2
        if size < span:
            index = self._lower(index, span - size)
        self.text_of = words.text_of()
        starts = np.arange(len(index))
        fits = starts + least <= words.offsets[1:][self.text_of[: len(index)]] if n else np.zeros(0, bool)
        self.starts = starts[fits]  # windows that lie within a text
        self.anchor_of = index[fits]  # never falls from one window to the next within a text

    def _lower(self, index: np.ndarray, shift: int) -> np.ndarray:
        if len(index) <= shift:
            return index[:0]
        left, right = index[:-shift], index[shift:]
        return np.where(self.grams[right] < self.grams[left], right, left)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each anchor place with the first and last of the windows it serves."""
        new = np.ones(len(self.starts), bool)
        if len(new):
            new[1:] = (self.anchor_of[1:] != self.anchor_of[:-1]) | (self.text_of[self.starts[1:]] != self.text_of[self.starts[:-1]])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(new)) - 1 if len(first) else first
        return self.anchor_of[first], self.starts[first], self.starts[last]

    def stretch_hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of the words from window `first` to the end of window `last`, by length."""
        out = np.zeros(len(first), U64)
        lengths = last - first + self.least
        for length in np.unique(lengths):
            mine = lengths == length
            out[mine] = common.ngram_hashes(self.hashes, int(length), seed=5)[first[mine]]
        return out


_PLACES = "anchor long, context long, __id long, __rk long, first int, last int"


def _places(least: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.make_room("substring")
        for batch in batches:
            texts = common.Texts(batch.column("text"))
            ids, rks = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("__id", "__rk"))
            for i, j in texts.chunks():
                a = _Anchors(texts, i, j, least, seed)
                at, first, last = a.runs()
                if not len(at):
                    continue
                context = a.stretch_hashes(first, last)
                t = a.text_of[first]
                base = a.words.offsets[t]
                columns = [common.signed(a.grams[at]), common.signed(context), ids[i:j][t], rks[i:j][t], (first - base).astype(np.int32), (last - base).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in _PLACES.split(", ")])

    return run


_WINDOWS = "w1 long, w2 long, __id long, __rk long, start int, n long"


def _windows(least: int, seed: int):
    """Windows of the listed runs (first, last, n) of each text, with how many places each stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.make_room("substring")
        for batch in batches:
            texts = common.Texts(batch.column("text"))
            ids, rks = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("__id", "__rk"))
            listed = batch.column("runs").to_pylist()
            for i, j in texts.chunks():
                words = common.Words(texts, i, j)
                hashes = words.hashes()
                both = [common.ngram_hashes(hashes, least, seed=5 + k) for k in (0, 1)]
                start, owner, n = [], [], []
                for k in range(i, j):
                    for r in listed[k]:
                        span = np.arange(r["first"], r["last"] + 1)
                        start.append(span)
                        owner.append(np.full(len(span), k - i))
                        n.append(np.full(len(span), r["n"]))
                if not start:
                    continue
                start, owner, n = np.concatenate(start), np.concatenate(owner), np.concatenate(n)
                # A row key stands for one text, so every listed run lies within it.
                where = start + words.offsets[owner]
                columns = [common.signed(both[0][where]), common.signed(both[1][where]), ids[i:j][owner], rks[i:j][owner], start.astype(np.int32), n.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in _WINDOWS.split(", ")])

    return run


def repeated_runs(keyed: DataFrame, least: int, seed: int) -> DataFrame:
    """Rows (__id, __rk, first, last): runs of window starts of a row's text whose windows also start elsewhere."""
    places = common.materialize(keyed.select("__id", "__rk", "text").mapInArrow(_places(least, seed), _PLACES), "anchors")
    # Written, so that the join's sides are plain shuffles, whose hot partitions Spark can split.
    twice = common.materialize(places.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "repeated-anchors")
    seeds = common.materialize(places.join(twice, "anchor"), "seeds")

    # Extension: anchors with equal contexts are repeats as a whole.
    whole = seeds.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.struct("__id", "__rk", "first", "last")).alias("one"))
    whole = common.materialize(whole, "contexts")
    mixed = common.materialize(whole.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1").select("anchor"), "mixed-anchors")
    settled = seeds.join(whole.where("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi").select("__id", "__rk", "first", "last")

    # Where they differ: the windows of one place for each context stand for all places with it.
    ends = whole.join(mixed, "anchor").select("one.*", "n")
    ends = common.materialize(ends.groupBy("__id", "__rk").agg(F.collect_set(F.struct("first", "last", "n")).alias("runs")), "ends")
    wanted = common.key_filter(ends, "__rk")
    texts = common.filtered_texts(keyed, wanted, ["__id", "__rk", "text"]).join(ends, ["__id", "__rk"])
    # Rows that repeat id and text are one text here; their places are counted in n.
    windows = common.materialize(texts.dropDuplicates(["__id", "__rk"]).mapInArrow(_windows(least, seed), _WINDOWS), "windows")
    again = common.materialize(windows.groupBy("w1", "w2").agg(F.sum("n").alias("n")).where("n > 1").select("w1", "w2"), "repeated-windows")
    # Places of contexts that occur once are decided here; the others are settled already.
    single = windows.where("n = 1").join(again, ["w1", "w2"], "left_semi").select("__id", "__rk", F.col("start").alias("first"), F.col("start").alias("last"))
    return settled.unionByName(single)


def _cut(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.make_room("substring")
        for batch in (whole.slice(start, common.BATCH_ROWS) for whole in batches for start in range(0, whole.num_rows, common.BATCH_ROWS)):
            counts, gone, digests, kept_texts = [], [], [], []
            for text, runs in zip(batch.column("__text"), batch.column("__runs")):
                words = (text.as_py() or "").encode().split()
                n, removed = len(words), 0
                if runs.is_valid and len(runs):
                    edge = np.zeros(n + 1, np.int64)
                    for r in runs.as_py():
                        edge[r["first"]] += 1
                        edge[r["last"] + least] -= 1
                    keep = np.cumsum(edge)[:n] == 0
                    words = list(compress(words, keep))
                    removed = n - len(words)
                kept = b" ".join(words)
                counts.append(n)
                gone.append(removed)
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept.decode() if removed else None)
            rest = [c for c, name in zip(batch.columns, batch.schema.names) if name not in ("__runs", "__text")]
            names = [name for name in batch.schema.names if name not in ("__runs", "__text")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string()), pa.array(kept_texts, pa.string())], names=[*names, "__n_words", "__n_removed", "__sha256", "__kept"])

    return run


def remove_repeats(docs: DataFrame, least: int = 35, seed: int = 12, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For each row of docs the columns in carry, __n_words, __n_removed, __sha256 of the kept words joined by spaces and, where words were removed, __kept (these words; else null)."""
    runs = repeated_runs(common.row_keys(docs, id_col, text_col), least, seed).groupBy("__id", "__rk").agg(F.collect_set(F.struct("first", "last")).alias("__runs"))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("__id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("__rk"), F.col(text_col).alias("__text"), *carry)
    joined = rows.join(runs, ["__id", "__rk"], "left").select("__text", "__runs", *carry)
    schema = T.StructType([*joined.select(*carry).schema.fields, *T._parse_datatype_string("__n_words long, __n_removed long, __sha256 string, __kept string").fields])
    return joined.mapInArrow(_cut(least), schema)


def cut_repeats(docs: DataFrame, least: int = 35, seed: int = 12, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """docs with the repeats taken out of their texts (the words left, joined by spaces); texts that lose nothing stay as they are."""
    names = dict(zip(docs.columns, inner := [f"c{k}" for k in range(len(docs.columns))]))  # whatever the columns are called
    found = remove_repeats(docs.toDF(*inner), least, seed, names[id_col], names[text_col], tuple(inner))
    text = names[text_col]
    out = found.withColumn(text, F.coalesce(F.col("__kept"), F.col(text)))
    if size_col in names:
        size = names[size_col]
        out = out.withColumn(size, F.when(F.col("__n_removed") > 0, F.length(text).cast(docs.schema[size_col].dataType)).otherwise(F.col(size)))
    return out.select(*inner).toDF(*docs.columns)
