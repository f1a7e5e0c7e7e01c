"""Operator 4: bulk-synchronous best-fit packing of token sequences.

Documents are range-sorted by length as counted runs, one for each length, and
the gaps of open sequences as runs of equal gaps. A superstep takes the runs of
a range of lengths, longest first. Its sweep goes down the lengths, and each
run is matched with its successors among the sorted gaps, the smallest that
hold it; ranks within the run settle which document goes to which sequence;
what finds no gap opens sequences; the gaps are updated. Then the next range
follows, until no document is left. The ranges halve: documents over half a
sequence, over a quarter, and so on.

Runs, gaps and matches are tables in the shared folder, and a superstep is one
job on them; its sweep is one task, as both lists are bounded by the capacity C
whatever the data: at most C lengths, and a length splits at most one run in
three, so there are at most 3 C runs of gaps. A sequence holds at most sqrt(2 C)
different lengths, so there are at most 3 C sqrt(2 C) matches in all (under
400,000 for C = 2048), and these are broadcast. Everything per document is
distributed: documents are tokenised, cut and ranked by length within their
task in one pass, written to the shared folder, and find their place by binary
search in the matches. No length is a shuffle key, so a length that a third of
all documents have is no hot spot.

The result is that of best-fit decreasing, taken one document after the other.

Null texts are empty texts; an empty text is one piece (the end id alone).
Rows with equal or null ids are packed one by one, so repeated rows are pieces
of their own. A text of any length is cut into pieces of the capacity.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe, common

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
#: One table for a superstep's outcome: matches (kind 0), runs of gaps (1), and sequences opened so far (2).
_STATE = "kind int, a long, b long, c long, d long, e long, f long"


class Gaps:
    """Runs of sequences with equal gaps, in the order of their gaps."""

    def __init__(self, runs: list[tuple[int, int, int]], sequences: int):
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, sequences)
        self.sorted: list[int] = []
        self.sequences = sequences
        for gap, first, n in runs:
            self.put(gap, first, n)

    def put(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if not self.runs[gap]:
                bisect.insort(self.sorted, gap)
            self.runs[gap].append((first, n))

    def successor(self, length: int) -> tuple[int, int, int] | None:
        """Takes out a run of the smallest gap that holds a length."""
        at = bisect.bisect_left(self.sorted, length)
        if at == len(self.sorted):
            return None
        gap = self.sorted[at]
        first, n = self.runs[gap].pop()
        if not self.runs[gap]:
            self.sorted.pop(at)
        return gap, first, n

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n


def sweep(counts: dict[int, int], gaps: Gaps, capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Matches (length, first rank, ranks, first sequence, documents a sequence, offset in it) of counted lengths, longest first; updates the gaps."""
    out = []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            found = gaps.successor(length)
            if found is None:
                each = capacity // length
                n = -(-left // each)
                found = capacity, gaps.open(n), n
            gap, first, n = found
            each = gap // length
            full = min(n, left // each)
            if full:
                out.append((length, rank, full * each, first, each, capacity - gap))
                gaps.put(gap - each * length, first, full)
                rank, left, first, n = rank + full * each, left - full * each, first + full, n - full
            if n and left:  # fewer than `each` are left: they share one sequence
                out.append((length, rank, left, first, left, capacity - gap))
                gaps.put(gap - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            gaps.put(gap, first, n)
    return out


def _superstep(capacity: int):
    def run(key, lengths: pa.Table, state: pa.Table) -> pa.Table:
        rows = sorted(zip(*(state[c].to_pylist() for c in ("kind", "a", "b", "c"))))
        opened = next((a for kind, a, _, _ in rows if kind == 2), 0)
        gaps = Gaps([(a, b, c) for kind, a, b, c in rows if kind == 1], opened)
        out = [(0, *m) for m in sweep(dict(zip(lengths["length"].to_pylist(), lengths["n"].to_pylist())), gaps, capacity)]
        out += [(1, gap, first, n, 0, 0, 0) for gap in gaps.sorted for first, n in gaps.runs[gap]]
        out.append((2, gaps.sequences, 0, 0, 0, 0, 0))
        names = [c.split()[0] for c in _STATE.split(", ")]
        return pa.table([pa.array(c, pa.int32() if k == 0 else pa.int64()) for k, c in enumerate(zip(*out))], names=names)

    return run


def match(runs: DataFrame, capacity: int) -> DataFrame:
    """Rows (length, first_rank, ranks, sequence, each, offset) for runs (length, n), range of lengths by range."""
    spark = runs.sparkSession
    one = F.lit(0).alias("one")
    state = spark.createDataFrame([], _STATE)
    parts = []
    high = capacity
    while high:
        low = high // 2
        lengths = runs.where((F.col("length") > low) & (F.col("length") <= high)).select(one, "length", "n")
        before = state.where("kind > 0").select(one, "kind", "a", "b", "c")
        made = lengths.groupBy("one").cogroup(before.groupBy("one")).applyInArrow(_superstep(capacity), _STATE)
        state = common.materialize(made, "superstep", small=True)
        parts.append(state.where("kind = 0"))
        high = low
    both = parts[0]
    for p in parts[1:]:
        both = both.unionAll(p)
    return both.toDF("kind", "length", "first_rank", "ranks", "sequence", "each", "offset").drop("kind")


def _pieces(vocabulary: str, end_id: int, capacity: int, words_kept: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.load(vocabulary, words_kept)
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = encoder.encode(text.as_py()) + end
                for k, i in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[i : i + 4 * capacity]
                    n = len(part) // 4
                    rows.append((doc_id, k, i // 4, n, zlib.crc32(part), task, seen[n]))
                    seen[n] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, kinds)], names=[c.split()[0] for c in PIECES.split(", ")])

    return run


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", words_kept: int = bpe.WordBpe.KEEP) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one for each piece; other columns of docs are not read."""
    spark = docs.sparkSession
    vocabulary = bpe.ship(spark, vocabulary)
    made = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_pieces(vocabulary, end_id, capacity, words_kept), PIECES)
    pieces = common.materialize(made, "pieces")
    by_task = common.materialize(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths-by-task", small=True)
    # A group of this window has one row for each task, not for each document.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    runs = common.materialize(by_task.groupBy("length").agg(F.sum("n").alias("n")), "lengths", small=True)
    table = match(runs, capacity).toArrow()  # bounded by the capacity
    matches = np.stack([table[c].to_numpy() for c in table.column_names], axis=1).astype(np.int64).reshape(-1, 6)
    matches = matches[np.lexsort((matches[:, 1], matches[:, 0]))]
    shared = spark.sparkContext.broadcast(matches)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        known = (table[:, 0] << 40) + table[:, 1]  # ascending by length and first rank
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(known, (length << 40) + rank, "right") - 1
            index = rank - table[at, 1]
            each = table[at, 4]
            extra = [pa.array(table[at, 3] + index // each, pa.int64()), pa.array(table[at, 5] + index % each * length, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(5)] + extra, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    # Merged: the bases grow with the number of tasks, so they are never sent to all of them.
    ranked = pieces.join(bases.hint("merge"), ["task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
