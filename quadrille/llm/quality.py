"""Operator 9: a quality classifier by nearest-neighbour voting in a latent-semantic space.

Fitting. A bounded sample of labelled rows (`sample_rows`, those with the
smallest hashes of their ids) gives feature vectors, made on the executors:
square roots of relative frequencies of hashed words and of hashed byte pairs,
and a few shape shares (capitals, signs, digits, repeated words). A truncated
singular value decomposition of the sample, weighted by inverse document
frequency, is the latent space; the sample's vectors in it, with their labels,
are broadcast: at most sample_rows x rank numbers.

Scoring. Every whole text is projected, and its cosines with all labelled
vectors are computed in blocks. The `neighbours` nearest vote with weights that
grow steeply with the cosine; the score is the weighted share of label 1.

Only the text is an input of a score. Null is the empty text; a text without
words has the score that a vote of the whole sample gives. Labels that are
null take no part; a document with several labels counts with their mean,
1 from one half upward. Labels without a document do nothing. Of equally near
neighbours those earlier in the sample vote (it is in the order of the ids'
hashes), so equal texts have equal scores wherever they stand. Rows that repeat
an id are scored one by one; in the sample each of them is a neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WORDS, PAIRS, SHAPES = 512, 512, 8
HASHED = WORDS + PAIRS
WIDTH = HASHED + SHAPES


def features(texts: common.Texts, i: int, j: int) -> np.ndarray:
    """Feature rows (float32) of texts i..j-1."""
    words = common.Words(texts, i, j)
    n = j - i
    lo = texts.offsets[i]
    bounds = texts.offsets[i : j + 1] - lo
    buf = words.buf
    sizes = np.diff(bounds)
    out = np.zeros((n, WIDTH), np.float32)
    if not len(buf):
        return out
    doc = np.repeat(np.arange(n), sizes)
    pair = (buf[:-1].astype(np.int64) * 257 + buf[1:].astype(np.int64) * 31 + (buf[:-1] >> 3)) & (PAIRS - 1)
    within = doc[:-1] == doc[1:]

    def frequencies(owner: np.ndarray, bucket: np.ndarray, size: int) -> np.ndarray:
        counts = np.bincount(owner * size + bucket, minlength=n * size).reshape(n, size)
        return np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))

    lowered = words.hashes(lower=True)
    out[:, :WORDS] = 0.7 * frequencies(words.text_of(), ((lowered >> np.uint64(20)) & np.uint64(WORDS - 1)).astype(np.int64), WORDS)
    out[:, WORDS:HASHED] = frequencies(doc[:-1][within], pair[within], PAIRS)

    def share(mask: np.ndarray, of: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(1, of)

    letters = ((buf | 32) >= 97) & ((buf | 32) <= 122) | (buf >= 128)
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    digits = (buf >= 48) & (buf <= 57)
    upper = (buf >= 65) & (buf <= 90)
    hashes = words.hashes()
    text_of = words.text_of()
    order = np.lexsort((hashes, text_of))
    h, t = hashes[order], text_of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    distinct = np.bincount(t[new], minlength=n)
    # Distinct words fall short of all words in any long text; the exponent makes texts of other lengths alike.
    variety = np.where(words.counts > 0, distinct / np.maximum(1, words.counts) ** 0.85, 0)
    again = np.zeros(n)
    if len(hashes) > 1:
        again = np.bincount(text_of[1:][(hashes[1:] == hashes[:-1]) & (text_of[1:] == text_of[:-1])], minlength=n) / np.maximum(1, words.counts)
    shapes = [
        again,
        share(upper, sizes),
        share(~letters & ~blank & ~digits, sizes),
        share(digits, sizes),
        np.minimum(1, variety),
        share(blank, sizes),
        np.minimum(1, (sizes / np.maximum(1, words.counts)) / 20),
        np.minimum(1, np.log1p(words.counts) / 10),
    ]
    out[:, HASHED:] = np.stack(shapes, axis=1) * np.array([4, 4, 4, 2, 2, 1, 1, 0.5])
    return out


BLOCK = 512  # rows that are multiplied at once


def _same_shape(rows: np.ndarray, by: np.ndarray) -> np.ndarray:
    """rows @ by, always computed as a product of BLOCK rows, so that a row's result does not depend on the rows beside it."""
    padded = np.zeros((BLOCK, rows.shape[1]), np.float32)
    padded[: len(rows)] = rows
    return (padded @ by)[: len(rows)]


def nearest(cosines: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest values of each row, in ascending order of position; ties go to the earlier position."""
    bound = np.partition(cosines, cosines.shape[1] - k, axis=1)[:, -k, None]
    above = cosines > bound
    ties = cosines == bound
    free = k - above.sum(axis=1, keepdims=True)
    chosen = above | (ties & (np.cumsum(ties, axis=1) <= free))
    return np.nonzero(chosen)[1].reshape(len(cosines), k)


@dataclass
class Model:
    """idf weights, latent directions, and the sample's unit vectors with labels."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    sharpness: float

    def project(self, rows: np.ndarray) -> np.ndarray:
        latent = np.concatenate([_same_shape(rows[i : i + BLOCK] * self.weights, self.directions) for i in range(0, len(rows), BLOCK)]) if len(rows) else np.zeros((0, self.directions.shape[1]), np.float32)
        norm = np.linalg.norm(latent, axis=1, keepdims=True)
        return np.divide(latent, norm, out=np.zeros_like(latent), where=norm > 0)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.labels.mean() if len(self.labels) else 0.5)
        if not len(self.labels):
            return out
        latent = self.project(rows)
        k = min(self.neighbours, len(self.labels))
        for start in range(0, len(rows), BLOCK):
            part = latent[start : start + BLOCK]
            cosines = _same_shape(part, self.vectors.T)
            near = nearest(cosines, k)
            cos = np.take_along_axis(cosines, near, axis=1).astype(np.float64)
            # Relative to the nearest, so that the weights never vanish.
            weight = np.exp((cos - cos.max(axis=1, keepdims=True)) * self.sharpness)
            vote = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
            out[start : start + BLOCK] = np.where((part != 0).any(axis=1), vote, out[start : start + BLOCK])
        return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = 4096, rank: int = 64, neighbours: int = 9, sharpness: float = 30.0) -> Model:
    """A model from the labelled rows that `learn` (a condition on doc_id) lets in."""
    common.small_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & learn)
    rows = known.groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    chosen = common.materialize(rows, "labels")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most sample_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.make_room("quality")
        for batch in batches:
            texts = common.Texts(batch.column(1))
            for i, j in texts.chunks(rows=BLOCK):
                made = features(texts, i, j)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(2)[i:j], pa.array([r.tobytes() for r in made], pa.binary())], names=["doc_id", "y", "f"])

    found = texts.select("doc_id", "text", "y").mapInArrow(run, "doc_id long, y double, f binary")
    # Ids may be repeated in docs, so the bound is kept once more, in the same order.
    kept = found.orderBy(F.xxhash64("doc_id"), "doc_id", "f").limit(sample_rows).collect()
    matrix = np.frombuffer(b"".join(bytes(r.f) for r in kept), np.float32).reshape(-1, WIDTH)
    y = np.array([r.y for r in kept])
    present = (matrix > 0).sum(axis=0)
    weights = np.sqrt(np.log((1 + len(matrix)) / (1 + present)) + 1).astype(np.float32)
    weights[HASHED:] = 1.0
    if not len(matrix):
        return Model(weights, np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), y, neighbours, sharpness)
    weighted = (matrix * weights).astype(np.float64)
    values, vectors = np.linalg.eigh(weighted.T @ weighted)
    directions = vectors[:, ::-1][:, : min(rank, len(matrix))].astype(np.float32)
    model = Model(weights, directions, np.zeros((0, directions.shape[1]), np.float32), y, neighbours, sharpness)
    model.vectors = model.project(matrix)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with a column of scores, in the place of one of that name if there is one; all other columns stay as they are."""
    common.small_batches(docs.sparkSession)
    if name in docs.columns and name != text_col:
        docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # sample_rows x rank numbers
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.make_room("quality")
        model = shared.value
        for batch in batches:
            texts = common.Texts(batch.column(at))
            found = [model.scores(features(texts, i, j)) for i, j in texts.chunks(rows=BLOCK)]
            scores = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def remainder(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % n
