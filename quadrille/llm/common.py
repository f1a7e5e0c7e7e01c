"""What several text operators share: shared-folder tables, word spans and word hashes.

All hashing here is vectorised over Arrow buffers: a batch's texts stay one
UTF-8 buffer, words are found as byte ranges and hashed without making a
Python object for each word.
"""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


# ---------------------------------------------------------------- tables


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); in a local session without one, a temporary folder."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="quadrille-")
        sc.getConf().set("spark.checkpoint.dir", found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared folder; it is removed when the driver ends."""
    path = f"{shared_dir(spark)}/quadrille/{tag}-{uuid.uuid4().hex}"
    atexit.register(remove_path, spark, path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM has gone: nothing is left to do
        pass


def materialize(df: DataFrame, tag: str, small: bool = False) -> DataFrame:
    """Cut lineage: write df once to the shared folder and read it back.

    A small table (links, classes: few rows for each document) is written by an
    eighth of the usual number of tasks, as every file has a price of its own.
    """
    return observed(df, tag, {"rows": F.count(F.lit(1))}, small)[0]


def observed(df: DataFrame, tag: str, metrics: dict[str, Column], small: bool = False) -> tuple[DataFrame, dict]:
    """materialize, and aggregates of what was written, which come with the same job."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    seen = Observation()
    watched = df.observe(seen, *[c.alias(n) for n, c in metrics.items()])
    # Not zstd: its native buffers are freed only with the JVM's garbage, and many short tables are read here.
    (watched.coalesce(max(8, parallelism(df) // 8)) if small else watched).write.option("compression", "snappy").parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get


BATCH_ROWS = 1024
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand whole texts to Python some thousand at a time, where the session has its default of ten thousand."""
    if spark.conf.get(_BATCHES, "10000") == "10000":
        spark.conf.set(_BATCHES, str(BATCH_ROWS))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    while name in df.columns:
        name += "_"
    return name


def parallelism(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


#: What this worker process keeps between tasks, by operator: a function that drops it.
_KEPT: dict[str, Callable[[], None]] = {}


def make_room(operator: str) -> None:
    """Called where an operator starts in a worker: drop what other operators kept there."""
    for name in [n for n in _KEPT if n != operator]:
        _KEPT.pop(name)()
    trim()


def trim() -> None:
    """Give memory that this worker process no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def keeps(operator: str, drop: Callable[[], None]) -> None:
    _KEPT[operator] = drop


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of batches that are sorted by long or int keys, one table each; a group may span batches."""
    held: list[pa.RecordBatch] = []

    def ends(batch: pa.RecordBatch) -> tuple:
        return tuple(batch.column(k)[-1].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = not held or ends(held[-1]) != tuple(c[0] for c in columns)
        cuts = np.flatnonzero(new).tolist()
        if cuts and held:
            head = batch.slice(0, cuts[0])
            yield pa.Table.from_batches([*held, head] if head.num_rows else held)
            held = []
        for a, b in zip(cuts, cuts[1:]):
            yield pa.Table.from_batches([batch.slice(a, b - a)])
        held.append(batch.slice(cuts[-1] if cuts else 0))
    if held:
        yield pa.Table.from_batches(held)


# ---------------------------------------------------------------- Arrow texts


class Texts:
    """A batch's texts as one byte buffer with 64-bit offsets; null is the empty text."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        array = pc.fill_null(column.cast(pa.large_binary()), b"")
        _, offsets, data = array.buffers()
        self.n = len(array)
        self.offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + self.n + 1] if self.n else np.zeros(1, np.int64)
        self.data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)

    @classmethod
    def of(cls, data: bytes, offsets: np.ndarray) -> Texts:
        """Texts that lie one after the other in a buffer."""
        made = cls.__new__(cls)
        made.n, made.offsets, made.data = len(offsets) - 1, offsets.astype(np.int64), np.frombuffer(data, np.uint8)
        return made

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def chunks(self, most: int = 1 << 20, rows: int = 4096):
        """Ranges of at most `rows` texts and about `most` bytes each; a longer text is a range of its own."""
        i = 0
        while i < self.n:
            j = int(np.searchsorted(self.offsets, self.offsets[i] + most, "right")) - 1
            j = min(max(j, i + 1), i + rows, self.n)
            yield i, j
            i = j


class Words:
    """Words ([^\\x20\\x09-\\x0D]+) of texts i..j-1: byte starts and ends in the buffer, and word offsets by text."""

    def __init__(self, texts: Texts, i: int, j: int):
        lo, hi = int(texts.offsets[i]), int(texts.offsets[j])
        self.buf = texts.data[lo:hi]
        bounds = texts.offsets[i : j + 1] - lo
        word = ~_SPACE[self.buf]
        before = np.empty_like(word)
        after = np.empty_like(word)
        if len(word):
            before[0], before[1:] = False, word[:-1]
            after[-1], after[:-1] = False, word[1:]
            inner = bounds[bounds < len(word)]
            before[inner] = False
            after[bounds[bounds > 0] - 1] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.offsets = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.offsets)
        self.n = len(self.starts)

    def text_of(self) -> np.ndarray:
        """For each word, the text it belongs to, from 0."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        return word_hashes(self.buf, self.starts, self.ends, lower)


_BASE = U64(0x9E3779B97F4A7C15 | 1)
_POWERS: list[np.ndarray] = []
_LONG = 64  # bytes; longer words are hashed one by one
_SLICE = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, _SLICE)
        inverse = U64(pow(int(_BASE), -1, 1 << 64))
        one = np.ones(1, U64)
        _POWERS[:] = [np.cumprod(np.concatenate([one, np.full(size, x, U64)])) for x in (_BASE, inverse)]
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte ranges (ascending, disjoint); lower: of their text with A-Z lower-cased."""
    out = np.empty(len(starts), U64)
    if lower:
        buf = np.where((buf >= 65) & (buf <= 90), buf | 32, buf).astype(np.uint8)
    lengths = ends - starts
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + _SLICE, "right"))
        if j > i:
            lo, hi = int(starts[i]), int(ends[j - 1])
            power, inverse = _powers(_SLICE)
            total = np.empty(hi - lo + 1, U64)
            total[0] = 0
            np.cumsum((buf[lo:hi].astype(U64) + U64(1)) * power[: hi - lo], out=total[1:])
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = (total[e] - total[s]) * inverse[s]
        else:
            j = i + 1  # a word longer than a slice, hashed below
        i = j
    out = mix(out ^ (lengths.astype(U64) * U64(0xD6E8FEB86659FD93)))
    for k in np.flatnonzero(lengths > _LONG):
        out[k] = xxhash.xxh3_64_intdigest(buf[starts[k] : ends[k]].tobytes())
    return out


def ngram_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of n consecutive word hashes (len(words) - n + 1 of them), by doubling."""
    if len(words) < n:
        return np.empty(0, U64)
    base = U64((0xC2B2AE3D27D4EB4F + 2 * seed) | 1)
    part, size, power = words, 1, base
    have: np.ndarray | None = None
    done, have_power = 0, U64(1)
    left = n
    with np.errstate(over="ignore"):
        while True:
            if left & 1:
                if have is None:
                    have = part
                else:
                    m = len(words) - (done + size) + 1
                    have = have[:m] + have_power * part[done : done + m]
                done += size
                have_power = U64(int(have_power) * int(power) % (1 << 64))
            left >>= 1
            if not left:
                break
            m = len(words) - 2 * size + 1
            part = part[:m] + power * part[size : size + m]
            size *= 2
            power = U64(int(power) * int(power) % (1 << 64))
    return mix(have ^ U64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def row_keys(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns __id and __rk, which name a row by its id and text: rows of one id with other texts stay apart."""
    small_batches(df.sparkSession)
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("__id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("__rk"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


# ---------------------------------------------------------------- a filter of fixed size


def key_filter(keys: DataFrame, column: str, bits: int = 1 << 23):
    """A broadcast Bloom filter (two probes, `bits` bits whatever the input) of a long column.

    It is or-ed together by word in Spark, so at most bits / 64 rows reach the
    driver, as Arrow batches. Others than the keys may pass; a key always does.
    """
    spot = F.col(column).bitwiseAND(F.lit(bits - 1))
    other = F.shiftrightunsigned(F.col(column), 32).bitwiseAND(F.lit(bits - 1))
    spots = keys.select(F.explode(F.array(spot, other)).alias("p"))
    words = spots.select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    found = np.zeros(bits // 64, np.int64)
    rows = words.toArrow()
    found[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(found)


def may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the int64 keys may be in a key_filter's words."""
    mask = len(words) * 64 - 1
    bits = words.view(U64)

    def probe(p: np.ndarray) -> np.ndarray:
        return (bits[(p >> U64(6)).astype(np.int64)] >> (p & U64(63))) & U64(1)

    unsigned = keys.view(U64)
    return (probe(unsigned & U64(mask)) & probe((unsigned >> U64(32)) & U64(mask))).astype(bool)


def filtered_texts(docs: DataFrame, keys, columns: list[str]) -> DataFrame:
    """Rows of docs whose long column __rk may be in the filter, before they are shuffled."""
    part = docs.select(*columns)
    at = columns.index("__rk")

    def run(batches):
        words = keys.value
        for batch in batches:
            yield batch.filter(pa.array(may_hold(words, batch.column(at).to_numpy(zero_copy_only=False))))

    return part.mapInArrow(run, part.schema)


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 30) -> DataFrame:
    """Rows (node, root) for all nodes of undirected edges; root is the smallest node of the component.

    Large-star and small-star steps in turn, each a minimum by node joined back
    to the node's edges, until a round changes nothing, so that
    every node hangs on its root (an error if that takes over `most` rounds). A
    round is one job, written to the shared folder, and a checksum that comes
    with it tells whether anything changed; a lost executor costs one round.
    """
    state = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    checksum = {"n": F.count(F.lit(1)), "x": F.bit_xor(F.xxhash64("u", "v"))}
    before = None
    for _ in range(most):
        state, after = observed(_stars(state), "edges", checksum, small=True)
        if after == before or not after["n"]:
            break
        before = after
    else:
        raise RuntimeError(f"components: not converged after {most} rounds")
    tops = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(tops)


def _stars(state: DataFrame) -> DataFrame:
    """A large-star and a small-star step on edges (u, v), u > v."""
    both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    large = large.where("u != v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return small.where("u != v").distinct()
