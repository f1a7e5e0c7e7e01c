"""The corpus pipeline: quality, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All stages but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import minhash, packing, quality, substring
from quadrille.llm.common import free_name, materialize, table
from quadrille.llm.queries import vocabulary_path

KEEP_FROM = 0.7


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours vote at least KEEP_FROM for; the model never sees rows held out for testing."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), quality.remainder(F.col("doc_id"), 4) != 2)
    name = free_name(docs, "score")
    return quality.score(docs, model, name=name).where(F.col(name) >= KEEP_FROM).drop(name)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 35 words and more that also stand elsewhere; no document goes."""
    return substring.cut_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 tokens, one row for each piece of a document."""
    # A smaller table of encoded words than for packing alone: the worker has served other stages before.
    return packing.pack(docs, vocabulary_path(), words_kept=100_000)


STAGES = [("quality", keep_good), ("near-duplicates", one_of_each), ("repeats", without_repeats), ("packing", packed)]

#: No stage can be put as SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
