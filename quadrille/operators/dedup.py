"""Deduplication within (cell, year) buckets, with every tie settled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = ["grid_partition", "year"]


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key (null is a key like any other) by an order.

    One shuffle by the keys; a key's rows are sorted by Spark, which spills, so
    a key with very many rows costs time but not memory.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def latest(df: DataFrame, by: str = "updated", ties: list[Column] | None = None, scope: list[str] | None = None, id_col: str = "id") -> DataFrame:
    """The row with the largest `by` of each id in its bucket, rows without one last; without the column, df as it is."""
    if by not in df.columns:
        return df
    scope = BUCKET if scope is None else scope
    rest = ties or [F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])]
    return first_by(df, [*scope, id_col], [F.col(by).desc_nulls_last(), *rest])


def first_seen(df: DataFrame, order: list[str], scope: list[str] | None = None, id_col: str = "id") -> DataFrame:
    """The row that comes first by explicit order columns (file, line)."""
    return first_by(df, [*(BUCKET if scope is None else scope), id_col], [F.col(c).asc_nulls_last() for c in order])


def strictly_latest(df: DataFrame, by: str, order: list[str], id_col: str = "id") -> DataFrame:
    """A later row replaces an earlier one only if its `by` text is strictly greater; missing ids are one group, missing texts the least."""
    keyed = df.withColumn("__key", F.coalesce(F.col(id_col), F.lit("")))
    return first_by(keyed, ["__key"], [F.coalesce(F.col(by), F.lit("")).desc(), *[F.col(c).asc() for c in order]]).drop("__key")


def newest_of_sources(sources: list[DataFrame], key: str, order: list[str]) -> DataFrame:
    """Rows of several sources by key: earlier sources win, within a source the last by order."""
    ranked = [s.withColumn("__source", F.lit(i)) for i, s in enumerate(sources)]
    both = ranked[0]
    for s in ranked[1:]:
        both = both.unionByName(s, allowMissingColumns=True)
    return first_by(both, [key], [F.col("__source").asc(), *[F.col(c).desc_nulls_last() for c in order]]).drop("__source")


def distinct_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.select(id_col).distinct()
