"""Operator 8: language-model scores from a log-frequency Bloom filter.

Counting. Tasks count words, pairs and triples of words in chunks of the texts
and send them on packed by hash range; a range adds up the counts of the
training texts. All counts are over the whole training corpus.

Filter. A count is quantised to a level, 1 + floor(log(count / least) / log(base)),
and an entry is stored once for each level up to its own, so a lookup probes
level 1, 2, ... until one is missing, and the last one found gives the mean
count of its level. Every hash range has a segment of its own, which is sized by
the range's entries, built where its counts are and probed there: chunks of texts
ask every range for the words, pairs and triples they hold and get levels back.
All of them enter, those seen once as well, and the filter grows with the input.
Within its range an entry is named by 40 bits more.

A caller may bound the filter instead (`filter_bits`): it holds words and pairs
and is broadcast then, and entries of small counts (pairs seen once, and more
when the bits do not suffice) are left to the smoothing, by one threshold for
each order, chosen from the histogram of all counts.

Model. P(w | v) = (1 - l) P1(w) + l c(v w) / c(v), where P1 is the additive
unigram model and l depends on the level of c(v). P(w | u v) interpolates
c(u v w) / c(u v) with P(w | v) in the same way. The weights are fitted on all
training texts, order by order, each token with its own occurrence taken out,
from a histogram of the ratio of both estimates. Words are lower-cased (A-Z); a
text is its words and one end token; the first word follows an end token, and
has no longer context.

Base score. Exact counts, which come back with the levels. With a bounded filter
those of frequent words (at most `head` of them) are broadcast, and those of all
other words are joined by hash.

Null is the empty text, which is its end token alone. A row without an id is
a training row. Rows that repeat id and text are scored and counted one by one.
Only id and text of a row are read. A text longer than a chunk is a chunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .common import U64

END = U64(0x5851F42D4C957F2D)
_PAIR = U64(0x2545F4914F6CDD1D)
_TRIPLE = U64(0x9FB21C651E98DF25)
_GOLDEN = U64(0x9E3779B97F4A7C15)
CHUNK = 8 << 20
LEVELS, RATIOS = 64, 64
SPARSE = 1 / 16  # of a segment's bits that are set; with four probes 1 of 65,000 lookups of nothing finds something


def tokens(texts: common.Texts, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of texts i..j-1 with an end after each, the hash before each token, and text offsets."""
    words = common.Words(texts, i, j)
    offsets = words.offsets + np.arange(j - i + 1)
    out = np.empty(words.n + j - i, U64)
    ends = np.zeros(len(out), bool)
    ends[offsets[1:] - 1] = True
    out[ends] = END
    out[~ends] = words.hashes(lower=True)
    before = np.empty_like(out)
    before[1:] = out[:-1]  # the token before a text's first one is an end, too
    before[:1] = END
    return out, before, offsets


def pairs(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return common.mix(before * _PAIR + token)


def triples(before: np.ndarray, token: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of all tokens but the first of each text, with the two tokens before."""
    inner = np.ones(len(token), bool)
    inner[offsets[:-1]] = False
    at = np.flatnonzero(inner)
    return at, common.mix(pairs(before[at - 1], before[at]) * _TRIPLE + token[at])


def placed(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The range (of n) of each hash, and its name there: the upper 40 bits of what is left. Both ascend as the hashes do."""
    wide = U64(n)
    high = (hashes >> U64(32)) * wide + (((hashes & U64(0xFFFFFFFF)) * wide) >> U64(32))
    return (high >> U64(32)).astype(np.int64), (hashes * wide) >> U64(24)


def pack(names: np.ndarray) -> bytes:
    """Ascending names of 40 bits: their differences, byte by byte of equal weight, compressed."""
    steps = np.diff(names, prepend=U64(0)).astype("<u8")
    return _squeeze(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :5].T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_spread(data), np.uint8).reshape(5, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :5] = planes.T
    return np.cumsum(steps.view("<u8")[:, 0].astype(U64), dtype=U64)


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _spread(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def ranges(hashes: np.ndarray, n: int) -> np.ndarray:
    return (((hashes >> U64(40)) * U64(n)) >> U64(24)).astype(np.int64)


def add_up(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, with their summed counts."""
    if counts is None:
        ordered = np.sort(hashes)
    else:
        order = np.argsort(hashes, kind="stable")
        ordered, counts = hashes[order], counts[order]
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(first)
    if counts is None:
        return ordered[at], np.diff(np.append(at, len(ordered)))
    return ordered[at], np.add.reduceat(counts, at) if len(at) else counts[:0]


_PACKED = "kind int, bucket int, hashes binary, counts binary"


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = common.Texts(batch.column(0))
            for i, j in texts.chunks(CHUNK):
                token, before, _ = tokens(texts, i, j)
                for kind, keys in ((0, token), (1, pairs(before, token))):
                    h, n = add_up(keys)
                    cut = np.searchsorted(ranges(h, buckets), np.arange(buckets + 1))
                    some = np.flatnonzero(np.diff(cut))
                    n = n.astype("<u4")
                    spans = [(cut[b], cut[b + 1]) for b in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), kind, np.int32)), pa.array(some.astype(np.int32)), pa.array([h[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([n[a:b].tobytes() for a, b in spans], pa.binary())],
                        names=["kind", "bucket", "hashes", "counts"],
                    )

    return run


def _merge(table: pa.Table) -> pa.Table:
    h = np.frombuffer(b"".join(table["hashes"].to_pylist()), U64)
    n = np.frombuffer(b"".join(table["counts"].to_pylist()), "<u4").astype(np.int64)
    h, n = add_up(h, n)
    kind, bucket = table["kind"][0].as_py(), table["bucket"][0].as_py()
    # Pairs seen once never enter the filter; only their number matters.
    kept = n >= (1 if kind == 0 else 2)
    histogram = np.bincount(np.floor(np.log2(n)).astype(np.int64), minlength=LEVELS)
    made = [kind, bucket, h[kept].tobytes(), n[kept].astype("<i8").tobytes(), len(n), int(n.sum()), histogram.tolist()]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return pa.table([pa.array([x], t) for x, t in zip(made, kinds)], names=["kind", "bucket", "hashes", "counts", "distinct", "total", "histogram"])


_MERGED = "kind int, bucket int, hashes binary, counts binary, distinct long, total long, histogram array<long>"


@dataclass
class Shape:
    """What describes a filter: thresholds, quantisation, segments."""

    buckets: int
    bits: tuple[int, int]  # of a segment, by kind
    least: tuple[int, int]
    base: float = 1.5
    probes: int = 4

    def level(self, counts: np.ndarray, kind: int) -> np.ndarray:
        return 1 + np.floor(np.log(np.maximum(counts, 1) / self.least[kind]) / math.log(self.base) + 1e-9).astype(np.int64)

    def spots(self, hashes: np.ndarray, level: int | np.ndarray, kind: int) -> Iterator[np.ndarray]:
        """Bits within the segment of each hash for a level, one array for each probe."""
        first, step = self.walk(hashes, level)
        for k in range(self.probes):
            yield (first + U64(k) * step) % U64(self.bits[kind])

    def walk(self, hashes: np.ndarray, level: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the probes of each hash for a level begin, and their steps."""
        h = common.mix(hashes + np.asarray(level).astype(U64) * _GOLDEN)
        return h & U64(0xFFFFFFFF), (h >> U64(32)) | U64(1)


@dataclass
class Model:
    shape: Shape
    words: tuple[np.ndarray, np.ndarray]  # the filter's bytes by kind, segment after segment
    means: np.ndarray  # kind x level: the mean count
    total: int
    distinct: int
    head: tuple[np.ndarray, np.ndarray]  # hashes and exact counts of frequent words
    head_least: int
    weights: np.ndarray = field(default_factory=lambda: np.zeros(LEVELS))

    def levels(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        """The stored level of each hash, 0 if there is none: repeated membership probes."""
        data, bits = self.words[kind], self.shape.bits[kind]
        out = np.zeros(len(hashes), np.int8)
        left = np.arange(len(hashes))
        base = ranges(hashes, self.shape.buckets) * bits
        for level in range(1, LEVELS):
            first, step = self.shape.walk(hashes[left], level)
            for k in range(self.shape.probes):  # what a probe does not find is not probed again
                p = base[left] + ((first + U64(k) * step) % U64(bits)).astype(np.int64)
                there = (data[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
                left, first, step = left[there], first[there], step[there]
            if not len(left):
                break
            out[left] = level
        return out

    @property
    def scale(self) -> float:
        return self.total + 0.1 * (self.distinct + 1)

    def estimates(self, token: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, tuple]:
        """P1, the pair's stored count, the context's stored count and level of each token, and (distinct tokens, inverse)."""
        unique, inverse = np.unique(token, return_inverse=True)
        level = self.levels(unique, 0)
        count = self.means[0][level]
        p1 = ((count + 0.1) / self.scale)[inverse]
        # A context is the token before, or an end.
        place = np.empty(len(token), np.int64)
        place[1:] = inverse[:-1]
        end = int(np.searchsorted(unique, END))
        place[:1] = end
        pair = self.means[1][self.levels(pairs(before, token), 1)]
        return p1, pair, count[place], level[place], (unique, inverse)


def _segments(shape: Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, bucket, hashes, counts in zip(*(batch.column(k).to_pylist() for k in ("kind", "bucket", "hashes", "counts"))):
                h, n = np.frombuffer(hashes, U64), np.frombuffer(counts, "<i8")
                kept = n >= shape.least[kind]
                h, n = h[kept], n[kept]
                level = shape.level(n, kind)
                flags = np.zeros(shape.bits[kind], np.uint8)
                for k in range(1, int(level.max()) + 1 if len(level) else 0):
                    for spot in shape.spots(h[level >= k], k, kind):
                        flags[spot.astype(np.int64)] = 1
                sums = np.bincount(level, weights=n, minlength=LEVELS)[:LEVELS]
                sizes = np.bincount(level, minlength=LEVELS)[:LEVELS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind], pa.int32()), pa.array([bucket], pa.int32()), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary()), pa.array([sums.tolist()], pa.list_(pa.float64())), pa.array([sizes.tolist()], pa.list_(pa.int64()))],
                    names=["kind", "bucket", "bits", "sums", "sizes"],
                )

    return run


def _unpack(below: int):
    """Rows (hash, count) of words whose counts are below a bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, counts in zip(batch.column("hashes").to_pylist(), batch.column("counts").to_pylist()):
                h, n = np.frombuffer(hashes, np.int64), np.frombuffer(counts, "<i8")
                kept = n < below
                yield pa.RecordBatch.from_arrays([pa.array(h[kept]), pa.array(n[kept])], names=["hash", "count"])

    return run


def _calibrate(shared):
    """For each level of the context, how often the ratio of the pair's estimate to P1 falls into each bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        counts = np.zeros((LEVELS, RATIOS), np.int64)
        for batch in batches:
            texts = common.Texts(batch.column(0))
            for i, j in texts.chunks(CHUNK // 4):
                token, before, _ = tokens(texts, i, j)
                p1, pair, context, level, _ = model.estimates(token, before)
                counts += _ratios(p1, pair, context, level, model.shape.least[1])
        yield _binned(counts)

    return run


def _ratios(p1: np.ndarray, pair: np.ndarray, context: np.ndarray, level: np.ndarray, least: int) -> np.ndarray:
    # Without the token's own occurrence, a pair must still reach the filter's threshold.
    pair = np.where(pair - 1 >= least - 1e-9, pair - 1, 0)
    p2 = np.minimum(1.0, pair / np.maximum(1.0, context - 1))
    bins = np.where(p2 > 0, np.clip(np.round(4 * np.log2(np.maximum(p2, 1e-12) / p1)).astype(np.int64) + 16, 1, RATIOS - 1), 0)
    return np.bincount(level.astype(np.int64) * RATIOS + bins, minlength=LEVELS * RATIOS).reshape(LEVELS, RATIOS)


def _binned(counts: np.ndarray) -> pa.RecordBatch:
    spot = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array((spot // RATIOS).astype(np.int32)), pa.array((spot % RATIOS).astype(np.int32)), pa.array(counts.ravel()[spot])], names=["level", "bin", "n"])


def fit_weights(counts: np.ndarray) -> np.ndarray:
    """The mixture weight of each level that makes the counted ratios likeliest."""
    ratio = np.concatenate([[0.0], 2.0 ** ((np.arange(1, RATIOS) - 16) / 4)])
    out = np.zeros(len(counts))
    for level, n in enumerate(counts):
        if level and n.sum():
            w = 0.5
            for _ in range(200):
                w = float((n * (w * ratio / (w * ratio + 1 - w))).sum() / n.sum())
                w = min(max(w, 1e-6), 0.99)
            out[level] = w
    return out


_SCORED = "__id long, __rk long, doc_id long, n_tokens long, n_head long, head_sum double, score double, tail array<long>"


def _score(shared, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        head, exact = model.head
        for batch in batches:
            texts = common.Texts(batch.column("text"))
            for i, j in texts.chunks(CHUNK // 4):
                token, before, offsets = tokens(texts, i, j)
                p1, pair, context, level, (unique, inverse) = model.estimates(token, before)
                weight = np.where(context > 0, weights[level], 0.0)
                p2 = np.minimum(1.0, pair / np.maximum(1.0, context))
                logs = np.log10((1 - weight) * p1 + weight * p2)
                at = np.minimum(np.searchsorted(head, unique), max(0, len(head) - 1))
                common_word = head[at] == unique if len(head) else np.zeros(len(unique), bool)
                value = np.where(common_word, np.log10((exact[at] if len(head) else np.zeros(len(unique))) + 0.1), 0.0)[inverse]
                frequent = common_word[inverse]
                cut = offsets[:-1]
                tail = np.flatnonzero(~frequent)
                tails = pa.ListArray.from_arrays(pa.array(np.searchsorted(tail, offsets).astype(np.int32)), pa.array(common.signed(token[tail])))
                columns = [batch.column(k)[i:j] for k in ("__id", "__rk", "doc_id")]
                columns += [pa.array(np.diff(offsets)), pa.array(np.add.reduceat(frequent.astype(np.int64), cut)), pa.array(np.add.reduceat(value, cut)), pa.array(np.add.reduceat(logs, cut)), tails]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _SCORED.split(", ")])

    return run


def train(texts: DataFrame, filter_bits: int = 1 << 29, head: int = 1 << 20, full: float = 0.5) -> tuple[Model, DataFrame, Broadcast]:
    """The model of a DataFrame (text), the table of its packed counts, and the broadcast filter (a Model without weights)."""
    spark = texts.sparkSession
    buckets = 8 * common.parallelism(texts)
    packed = texts.select("text").mapInArrow(_count(buckets), _PACKED)
    merged = common.materialize(packed.groupBy("kind", "bucket").applyInArrow(_merge, _MERGED), "counts")
    sums = {r.kind: r for r in merged.groupBy("kind").agg(F.sum("distinct").alias("distinct"), F.sum("total").alias("total")).collect()}
    shares = merged.select("kind", F.posexplode("histogram").alias("power", "n")).groupBy("kind", "power").agg(F.sum("n").alias("n")).where("n > 0").collect()
    by_kind = [np.zeros(LEVELS, np.int64), np.zeros(LEVELS, np.int64)]
    for r in shares:
        by_kind[r.kind][r.power] = r.n

    shape = Shape(buckets, tuple(max(64, int(filter_bits * part) // buckets // 8 * 8) for part in (0.375, 0.625)), (1, 2))
    least = [1, 2]
    for kind in (0, 1):
        # Each entry of count c sets probes * level bits at most; half of a segment's bits may be set.
        room = math.log(1 / (1 - full)) * shape.bits[kind] * buckets
        for power in range(kind, LEVELS):
            least[kind] = 1 << power
            levels = 1 + np.floor(np.maximum(0, np.arange(LEVELS) + 1 - power) * math.log(2) / math.log(shape.base))
            if (by_kind[kind][power:] * levels[power:]).sum() * shape.probes <= room:
                break
    shape.least = tuple(least)

    # Frequent words: as many powers of two as fit into `head` entries.
    power = next(p for p in range(LEVELS + 1) if by_kind[0][p:].sum() <= head)
    head_least = 1 << min(power, 62)
    frequent = merged.where("kind = 0").select("hashes", "counts").mapInArrow(_above(head_least), "hashes binary, counts binary").collect()
    h = np.frombuffer(b"".join(bytes(r.hashes) for r in frequent), U64)
    n = np.frombuffer(b"".join(bytes(r.counts) for r in frequent), "<i8")
    order = np.argsort(h)

    words = tuple(np.zeros(shape.bits[k] * buckets // 8, np.uint8) for k in (0, 1))
    total, size = np.zeros((2, LEVELS)), np.zeros((2, LEVELS))
    for r in merged.select("kind", "bucket", "hashes", "counts").mapInArrow(_segments(shape), "kind int, bucket int, bits binary, sums array<double>, sizes array<long>").collect():  # filter_bits bits
        step = shape.bits[r.kind] // 8
        words[r.kind][r.bucket * step : (r.bucket + 1) * step] = np.frombuffer(bytes(r.bits), np.uint8)
        total[r.kind] += r.sums
        size[r.kind] += r.sizes
    means = np.divide(total, size, out=np.zeros_like(total), where=size > 0)
    model = Model(shape, words, means, sums[0].total if 0 in sums else 0, sums[0].distinct if 0 in sums else 0, (h[order], n[order]), head_least)
    shared = spark.sparkContext.broadcast(model)
    counts = np.zeros((LEVELS, RATIOS), np.int64)
    for r in texts.select("text").mapInArrow(_calibrate(shared), "level int, bin int, n long").groupBy("level", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r.level, r.bin] = r.n
    model.weights = fit_weights(counts)
    return model, merged, shared


def _above(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs, ns = [], []
            for hashes, counts in zip(batch.column("hashes").to_pylist(), batch.column("counts").to_pylist()):
                h, n = np.frombuffer(hashes, U64), np.frombuffer(counts, "<i8")
                hs.append(h[n >= least].tobytes())
                ns.append(n[n >= least].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(hs, pa.binary()), pa.array(ns, pa.binary())], names=["hashes", "counts"])

    return run


# ---------------------------------------------------------------- the whole filter, by hash range


ORDERS = 3
_CHUNKS = "chunk long, doc_ids array<long>, held array<boolean>, data binary, offsets binary"


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, held, text) as one row for each chunk of texts, compressed."""
    common.make_room("lm")
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        texts = common.Texts(batch.column("text"))
        for i, j in texts.chunks(CHUNK // 2, rows=1 << 16):
            ends = pa.array([0, j - i], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, batch.column(k)[i:j]) for k in ("doc_id", "held")]
            lo, hi = texts.offsets[i], texts.offsets[j]
            data = zstandard.ZstdCompressor(level=3).compress(texts.data[lo:hi].tobytes())
            offsets = _squeeze((texts.offsets[i : j + 1] - lo).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), *lists, pa.array([data], pa.binary()), pa.array([offsets], pa.binary())], names=["chunk", "doc_ids", "held", "data", "offsets"])
            chunk += 1


def _texts_of(data: pa.Scalar, offsets: pa.Scalar) -> common.Texts:
    return common.Texts.of(_spread(data.as_py()), np.frombuffer(_spread(offsets.as_py()), "<i8"))


def _orders(texts: common.Texts) -> tuple[np.ndarray, list[tuple[np.ndarray | None, np.ndarray]]]:
    """Text offsets in tokens, and for each order the positions (None: all) and hashes of its entries."""
    token, before, offsets = tokens(texts, 0, texts.n)
    return offsets, [(None, token), (None, pairs(before, token)), triples(before, token, offsets)]


_ASKED = "kind int, bucket int, chunk long, names binary, counts binary"


def _ask(buckets: int):
    """The distinct words, pairs and triples of each chunk by hash range, with their counts in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.make_room("lm")
        for batch in batches:
            for k in range(batch.num_rows):
                offsets, orders = _orders(_texts_of(batch.column("data")[k], batch.column("offsets")[k]))
                held = batch.column("held")[k].values.to_numpy(zero_copy_only=False)
                learnt = np.repeat(~held.astype(bool), np.diff(offsets)).astype(np.int64)
                for kind, (at, keys) in enumerate(orders):
                    h, n = add_up(keys, learnt if at is None else learnt[at])
                    bucket, name = placed(h, buckets)
                    cut = np.searchsorted(bucket, np.arange(buckets + 1))
                    some = np.flatnonzero(np.diff(cut))
                    n = n.astype("<u4")
                    spans = [(cut[b], cut[b + 1]) for b in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), kind, np.int32)),
                            pa.array(some.astype(np.int32)),
                            pa.array(np.full(len(some), batch.column("chunk")[k].as_py(), np.int64)),
                            pa.array([pack(name[a:b]) for a, b in spans], pa.binary()),
                            pa.array([_squeeze(n[a:b].tobytes()) for a, b in spans], pa.binary()),
                        ],
                        names=["kind", "bucket", "chunk", "names", "counts"],
                    )

    return run


def _set(data: np.ndarray, spots: np.ndarray, page: int = 1 << 24) -> None:
    """Set bits of a byte array, the lowest of a byte first; one page of bits at a time lies open as bytes."""
    spots = np.sort(spots)
    bits = 8 * len(data)
    flags = np.zeros(min(page, bits), np.uint8)
    for start in range(0, bits, page):
        part = spots[np.searchsorted(spots, start) : np.searchsorted(spots, start + page)] - start
        flags[part] = 1
        here = data[start // 8 : (start + page) // 8]
        here |= np.packbits(flags, bitorder="little")[: len(here)]
        flags[part] = 0


def segment(h: np.ndarray, n: np.ndarray) -> Model:
    """The filter of one hash range, with room for every entry."""
    shape = Shape(1, (64, 64), (1, 1))
    level = shape.level(n, 0)
    bits = max(64, math.ceil(shape.probes * int(level.sum()) / SPARSE / 64) * 64)
    shape.bits = (bits, bits)
    data = np.zeros(bits // 8, np.uint8)
    waiting, room = [], 0
    for k in range(1, int(level.max()) + 1 if len(level) else 0):
        for spot in shape.spots(h[level >= k], k, 0):
            waiting.append(spot.astype(np.int64))
            room += len(spot)
        if room >= 1 << 22:
            _set(data, np.concatenate(waiting))
            waiting, room = [], 0
    if waiting:
        _set(data, np.concatenate(waiting))
    sums = np.bincount(level, weights=n, minlength=LEVELS)[:LEVELS]
    sizes = np.bincount(level, minlength=LEVELS)[:LEVELS]
    return Model(shape, (data, data), np.array([sums, sizes]), int(n.sum()), len(n), (h[:0], n[:0]), 1)


_ANSWERED = "kind int, bucket int, chunk long, levels binary, counts binary, distinct long, total long, sums array<double>, sizes array<long>"


def _answer(table: pa.Table) -> pa.Table:
    """A hash range: counts added up, the segment built, and the levels of each chunk's entries; one more row (without chunk) sums up."""
    common.make_room("lm")
    names = [unpack(x) for x in table["names"].to_pylist()]
    h, n = add_up(np.concatenate(names), np.concatenate([np.frombuffer(_spread(x), "<u4") for x in table["counts"].to_pylist()]).astype(np.int64))
    made = segment(h[n > 0], n[n > 0])
    level = made.levels(h, 0)
    kind, bucket, rows = table["kind"][0].as_py(), table["bucket"][0].as_py(), table.num_rows
    levels, counts = [], []
    for x in names:
        at = np.searchsorted(h, x)
        levels.append(_squeeze(level[at].tobytes()))
        counts.append(_squeeze(n[at].astype("<i8").tobytes()) if kind == 0 else None)
    columns = [[kind] * (rows + 1), [bucket] * (rows + 1), [*table["chunk"].to_pylist(), None], [*levels, None], [*counts, None]]
    columns += [[None] * rows + [x] for x in (made.distinct, made.total, made.means[0].tolist(), made.means[1].astype(np.int64).tolist())]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64())]
    return pa.table([pa.array(x, t) for x, t in zip(columns, kinds)], names=[c.split()[0] for c in _ANSWERED.split(", ")])


_LEVELLED = "doc_id long, held boolean, n_tokens long, n_known long, base double, words binary, pairs binary, triples binary"


def _level(chunk: pa.Table, answers: pa.Table) -> pa.Table:
    """One row for each text of a chunk: sums over exact counts, and the levels of its tokens, pairs and triples."""
    common.make_room("lm")
    answers = answers.sort_by([("kind", "ascending"), ("bucket", "ascending")])
    kind = answers["kind"].to_numpy()
    levels = answers["levels"]
    # Ranges ascend as hashes do, so that the answers stand in the order of the chunk's distinct hashes.
    found = [np.frombuffer(b"".join(_spread(levels[k].as_py()) for k in np.flatnonzero(kind == x).tolist()), np.int8) for x in range(ORDERS)]
    count = np.frombuffer(b"".join(_spread(answers["counts"][k].as_py()) for k in np.flatnonzero(kind == 0).tolist()), "<i8")
    ids, held = (chunk[k].combine_chunks()[0].values for k in ("doc_ids", "held"))
    offsets, orders = _orders(_texts_of(chunk["data"][0], chunk["offsets"][0]))
    out = []
    for order, (at, keys) in enumerate(orders):
        place = np.unique(keys, return_inverse=True)[1]
        if at is None:
            out.append(found[order][place])
        else:
            out.append(np.zeros(offsets[-1], np.int8))
            out[-1][at] = found[order][place]
        if order == 0:
            count = count[place]
    cut = offsets[:-1]
    spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
    columns = [ids, held, np.diff(offsets), np.add.reduceat((count > 0).astype(np.int64), cut), np.add.reduceat(np.log10(count + 0.1), cut)]
    columns += [pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in out]
    return pa.table(columns, names=[c.split()[0] for c in _LEVELLED.split(", ")])


@dataclass
class Looked:
    """What is known of the tokens of a batch's texts: P1, and for the orders two and three the entry's and the context's count and the context's level."""

    p1: np.ndarray
    two: tuple[np.ndarray, np.ndarray, np.ndarray]
    three: tuple[np.ndarray, np.ndarray, np.ndarray]
    offsets: np.ndarray


def _looked_up(batch: pa.RecordBatch, means: np.ndarray, scale: float) -> Looked:
    word, pair, triple = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.int8) for k in ("words", "pairs", "triples"))
    offsets = np.concatenate([[0], np.cumsum(batch.column("n_tokens").to_numpy())])
    single = np.empty_like(word)
    single[1:] = word[:-1]
    single[offsets[:-1]] = word[offsets[1:] - 1]  # before a text's first token is an end, as at its own end
    double = np.empty_like(word)
    double[1:] = pair[:-1]
    double[offsets[:-1]] = 0  # a text's first token has no longer context
    return Looked((means[0][word] + 0.1) / scale, (means[1][pair], means[0][single], single), (means[2][triple], means[1][double], double), offsets)


def mixed(lower: np.ndarray, entry: np.ndarray, context: np.ndarray, level: np.ndarray, weights: np.ndarray, own: int = 0) -> np.ndarray:
    """(1 - l) lower + l entry / context; own: occurrences that are taken out of both counts."""
    weight = np.where(context > own, weights[level], 0.0)
    return (1 - weight) * lower + weight * np.minimum(1.0, np.maximum(0.0, entry - own) / np.maximum(1.0, context - own))


def _calibrate_levels(means: np.ndarray, scale: float, weights: np.ndarray | None):
    """Histograms for the weights of order two or, where those are given, of order three."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((LEVELS, RATIOS), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                x = _looked_up(batch.slice(i, 1000), means, scale)
                counts += _ratios(x.p1, *x.two, 1) if weights is None else _ratios(mixed(x.p1, *x.two, weights, 1), *x.three, 1)
        yield _binned(counts)

    return run


_WHOLE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score_levels(means: np.ndarray, scale: float, total: int, weights: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1000):
                batch = whole.slice(i, 1000)
                x = _looked_up(batch, means, scale)
                logs = np.log10(mixed(mixed(x.p1, *x.two, weights[0]), *x.three, weights[1]))
                base = batch.column("base").to_numpy() - np.diff(x.offsets) * math.log10(scale)
                columns = [batch.column(k) for k in ("doc_id", "held", "n_tokens", "n_known")]
                columns += [pa.array(np.full(batch.num_rows, total)), pa.array(base), pa.array(np.add.reduceat(logs, x.offsets[:-1]))]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _WHOLE.split(", ")])

    return run


def _score_whole(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    rows = common.row_keys(docs, id_col, text_col).select("doc_id", held_out.alias("held"), "text")
    chunks = common.materialize(rows.mapInArrow(_chunk, _CHUNKS), "chunks")
    asked = chunks.mapInArrow(_ask(2 * common.parallelism(docs)), _ASKED)
    answered = common.materialize(asked.groupBy("kind", "bucket").applyInArrow(_answer, _ANSWERED), "levels")
    sums = answered.where("chunk is null")
    of = {r.kind: r for r in sums.groupBy("kind").agg(F.sum("distinct").alias("distinct"), F.sum("total").alias("total")).collect()}
    by_level = sums.select("kind", F.posexplode(F.arrays_zip("sums", "sizes")).alias("level", "s")).groupBy("kind", "level").agg(F.sum("s.sums").alias("total"), F.sum("s.sizes").alias("n")).where("n > 0").collect()
    means = np.zeros((ORDERS, LEVELS))
    for r in by_level:
        means[r.kind][r.level] = r.total / r.n
    total, distinct = (of[0].total, of[0].distinct) if of else (0, 0)
    scale = total + 0.1 * (distinct + 1)

    answers = answered.where("chunk is not null").select("kind", "bucket", "chunk", "levels", "counts")
    levelled = common.materialize(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_level, _LEVELLED), "token-levels")
    weights: list[np.ndarray] = []
    for _ in range(ORDERS - 1):
        counts = np.zeros((LEVELS, RATIOS), np.int64)
        found = levelled.where("not held").mapInArrow(_calibrate_levels(means, scale, weights[0] if weights else None), "level int, bin int, n long")
        for r in found.groupBy("level", "bin").agg(F.sum("n").alias("n")).collect():  # LEVELS x RATIOS rows at most
            counts[r.level, r.bin] = r.n
        weights.append(fit_weights(counts))
    return levelled.mapInArrow(_score_levels(means, scale, total, weights), _WHOLE)


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", filter_bits: int | None = None, **options) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one for each row of docs.

    held_out is a condition on doc_id; the model learns from all other rows.
    filter_bits bounds the filter at the price of small counts; without it all counts enter.
    """
    held_out = F.coalesce(held_out, F.lit(False))
    if filter_bits is None:
        return _score_whole(docs, held_out, id_col, text_col)
    keyed = common.row_keys(docs, id_col, text_col)
    model, merged, shared = train(keyed.where(~held_out).select("text"), filter_bits, **options)
    scored = common.materialize(keyed.mapInArrow(_score(shared, model.weights), _SCORED), "scores")

    # Rare words: their counts are joined by hash. Rows that repeat id and text are scored once and repeated.
    rare = merged.where("kind = 0").select("hashes", "counts").mapInArrow(_unpack(model.head_least), "hash long, count long")
    once = scored.groupBy("__id", "__rk").agg(F.count("*").alias("copies"))
    asked = scored.select("__id", "__rk", F.explode("tail").alias("hash"))
    found = asked.join(rare, "hash", "left").select("__id", "__rk", F.coalesce("count", F.lit(0)).alias("count"))
    sums = found.groupBy("__id", "__rk").agg(F.sum(F.log10(F.col("count") + F.lit(0.1))).alias("tail_sum"), F.sum((F.col("count") > 0).cast("long")).alias("n_tail"))
    sums = once.join(sums, ["__id", "__rk"]).select("__id", "__rk", (F.col("tail_sum") / F.col("copies")).alias("tail_sum"), (F.col("n_tail") / F.col("copies")).cast("long").alias("n_tail"))
    joined = scored.drop("tail").join(sums, ["__id", "__rk"], "left")
    base = F.col("head_sum") + F.coalesce("tail_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(model.scale))
    return joined.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
