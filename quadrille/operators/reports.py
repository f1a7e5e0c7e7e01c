"""Statistics, audits and validation as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import bucket_of_href, decade, file_class, item_key_of, key_of_href, percent
from . import joins


def duplicates(rows: DataFrame, keys: list[str] | None = None, id_col: str = "id") -> DataFrame:
    """(keys, total, unique, duplicates, duplicate_pct)."""
    found = rows.groupBy(*(keys or [])).agg(F.count("*").alias("total"), F.countDistinct(id_col).alias("unique"))
    return found.withColumn("duplicates", F.col("total") - F.col("unique")).withColumn("duplicate_pct", percent(F.col("total") - F.col("unique"), F.col("total")))


def top_cells(rows: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """(grid_partition, years, unique, duplicates, total) of the n cells with most ids."""
    found = rows.groupBy("grid_partition").agg(F.countDistinct("year").alias("years"), F.countDistinct(id_col).alias("unique"), F.count("*").alias("total"))
    return found.select("grid_partition", "years", "unique", (F.col("total") - F.col("unique")).alias("duplicates"), "total").orderBy(F.desc("unique"), "grid_partition").limit(n)


def monthly(rows: DataFrame, moment: str = "datetime") -> DataFrame:
    return rows.groupBy(F.date_trunc("month", moment).alias("month")).agg(F.count("*").alias("items")).orderBy("month")


def cell_years(rows: DataFrame) -> DataFrame:
    return rows.groupBy("grid_partition", "year").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "grid_partition", "year")


def decades(df: DataFrame, n: str) -> DataFrame:
    """How many rows have a value of each power of ten; zeros are a class of their own."""
    name = F.coalesce(decade(F.col(n)).cast("string"), F.lit("zero"))
    return df.groupBy(name.alias("decade")).agg(F.count("*").alias("buckets"))


def files_per_bucket(files: DataFrame) -> DataFrame:
    per = files.groupBy("grid_partition", "year").agg(F.count("*").alias("files"))
    return per.groupBy("files").agg(F.count("*").alias("buckets"))


def year_shares(files: DataFrame) -> DataFrame:
    """(year, rows, files, share in percent) from manifest rows."""
    found = files.groupBy("year").agg(F.sum("rows").alias("rows"), F.count("*").alias("files"))
    # One row for each year: the window's single task holds some dozens of rows.
    return found.withColumn("share", F.col("rows") * 100.0 / F.sum("rows").over(Window.partitionBy()))


def summary(files: DataFrame, unique_items: int | None = None) -> DataFrame:
    found = files.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.countDistinct("grid_partition").alias("cells"), F.countDistinct("year").alias("years"))
    return found if unique_items is None else found.withColumn("fan_out", F.when(F.lit(unique_items) > 0, F.col("rows") / F.lit(unique_items)).otherwise(0.0))


def largest_buckets(files: DataFrame, n: int = 15) -> DataFrame:
    found = files.groupBy("grid_partition", "year").agg(F.sum("rows").alias("rows"), F.count("*").alias("files"))
    return found.orderBy(F.desc("rows"), "grid_partition", "year").limit(n)


def fragmented(files: DataFrame) -> DataFrame:
    """(buckets, rows, share in percent) of buckets with more than one file."""
    found = files.groupBy("grid_partition", "year").agg(F.sum("rows").alias("rows"), F.count("*").alias("files"))
    many = F.col("files") > 1
    return found.agg(F.count_if(many).alias("buckets"), F.coalesce(F.sum(F.when(many, F.col("rows"))), F.lit(0)).alias("rows"), percent(F.coalesce(F.sum(F.when(many, F.col("rows"))), F.lit(0)), F.sum("rows")).alias("share"))


def lengths(df: DataFrame, text: str) -> DataFrame:
    return df.agg(F.min(F.length(text)).alias("min_length"), F.max(F.length(text)).alias("max_length"), F.avg(F.length(text)).cast("int").alias("avg_length"))


def prefixes(df: DataFrame, text: str, mark: str = "_", n: int = 10) -> DataFrame:
    """The n most frequent prefixes up to a mark (the whole text without one)."""
    return df.groupBy(F.substring_index(text, mark, 1).alias("prefix")).agg(F.count("*").alias("items")).orderBy(F.desc("items"), "prefix").limit(n)


def whole_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Whether every non-null value of each column is whole."""
    return df.agg(*[F.coalesce(F.bool_and(F.col(c).isNull() | (F.col(c) == F.floor(c))), F.lit(True)).alias(c) for c in columns])


def contiguous_prefix(numbers: DataFrame, n: str, start: int = 0) -> DataFrame:
    """The largest number up to which none is missing from start on, as (last); start - 1 if there is none.

    A number lies in the prefix if as many distinct numbers are below it as
    should be. Counts by blocks of numbers are summed first, so that only the
    block where the gap lies is ordered.
    """
    distinct = numbers.select(F.col(n).cast("long").alias("n")).where(F.col("n") >= start).distinct()
    size = 1 << 16
    blocks = distinct.groupBy(F.floor((F.col("n") - start) / size).alias("block")).agg(F.count("*").alias("have"))
    full = blocks.where(F.col("have") == size)
    at = full.withColumn("r", F.row_number().over(Window.orderBy("block")) - 1).where("r = block").agg(F.coalesce(F.max("block") + 1, F.lit(0)).alias("open"))
    inside = distinct.join(F.broadcast(at), F.floor((F.col("n") - start) / size) == F.col("open"))
    ranked = inside.withColumn("r", F.row_number().over(Window.partitionBy("open").orderBy("n")) - 1)
    last = ranked.where(F.col("n") == F.col("r") + F.col("open") * size + start).agg(F.max("n").alias("last"))
    return last.crossJoin(at).select(F.coalesce("last", F.col("open") * size + start - 1).alias("last"))


def next_part(files: DataFrame) -> DataFrame:
    """The next number for `part_<n>` files of each bucket; the digits must be the whole number."""
    number = F.regexp_extract("path", r"part_(\d+)(?:[_.]|$)", 1).try_cast("int")
    return files.groupBy("grid_partition", "year").agg((F.coalesce(F.max(number), F.lit(-1)) + 1).alias("next_part"))


def audit(inventory: DataFrame, database: DataFrame, warehouse: DataFrame) -> DataFrame:
    """(id, inventoried, in_database, in_warehouse) of all ids of three sources."""
    return joins.membership({"inventoried": inventory, "in_database": database, "in_warehouse": warehouse})


def audit_delta(flags: DataFrame, inventory: DataFrame, database: DataFrame) -> DataFrame:
    """(bucket, key) of ids that the warehouse lacks: from the inventory where it has them, else from the database's links."""
    lacking = flags.where("not in_warehouse")
    listed = inventory.join(lacking.where("inventoried").select("id"), "id", "left_semi").select("bucket", "key")
    linked = database.join(lacking.where("not inventoried and in_database").select("id"), "id", "left_semi")
    return listed.unionAll(linked.select(bucket_of_href(F.col("href")).alias("bucket"), item_key_of(key_of_href(F.col("href"))).alias("key")))


def blank_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.where(F.col(id_col).isNull() | (F.col(id_col) == ""))


def validate(catalog) -> dict[str, DataFrame]:
    """Reports on a catalogue: classes of files, missing and unregistered files, ids in all, by year and by cell."""
    files, stored, rows = catalog.files(), catalog.describe_files(), catalog.read()
    return {
        "classes": files.groupBy(file_class(F.col("path")).alias("kind")).agg(F.count("*").alias("files"), F.sum("rows").alias("rows")),
        "unmatched": joins.unmatched(files, stored, "path"),
        "ids": duplicates(rows),
        "years": duplicates(rows, ["year"]),
        "cells": top_cells(rows, 20),
        "summary": summary(files),
    }


def bucket_report(buckets: DataFrame, results: DataFrame) -> DataFrame:
    """Compaction results for all buckets, zeros where there is none."""
    values = [c for c in results.columns if c not in ("grid_partition", "year")]
    return buckets.select("grid_partition", "year").distinct().join(results, ["grid_partition", "year"], "left").na.fill(0, values)


def rollup_by_year(results: DataFrame) -> DataFrame:
    """(year, buckets, unique, duplicates, duplicate_pct) from rows (grid_partition, year, input_rows, output_rows) of compactions."""
    found = results.groupBy("year").agg(F.count("*").alias("buckets"), F.sum("output_rows").alias("unique"), F.sum(F.col("input_rows") - F.col("output_rows")).alias("duplicates"))
    return found.withColumn("duplicate_pct", percent(F.col("duplicates"), F.col("unique") + F.col("duplicates")))


def rollup_by_cell(results: DataFrame, n: int) -> DataFrame:
    """(grid_partition, years, unique, duplicate_pct) of the n cells with most rows after compaction."""
    found = results.groupBy("grid_partition").agg(F.count("*").alias("years"), F.sum("output_rows").alias("unique"), F.sum("input_rows").alias("rows"))
    return found.select("grid_partition", "years", "unique", percent(F.col("rows") - F.col("unique"), F.col("rows")).alias("duplicate_pct")).orderBy(F.desc("unique"), "grid_partition").limit(n)


def compare_sources(a: DataFrame, b: DataFrame, id_col: str = "id", samples: int = 10) -> dict[str, DataFrame]:
    """Two lists of ids against each other: counts, samples of what only one has, lengths and prefixes of those."""
    only_a, only_b = (joins.missing_from(x.select(id_col).distinct(), y, id_col) for x, y in ((a, b), (b, a)))
    flags = joins.membership({"in_a": a, "in_b": b}, id_col)
    counts = flags.agg(F.count_if(F.col("in_a")).alias("a"), F.count_if(F.col("in_b")).alias("b"), F.count_if(F.col("in_a") & F.col("in_b")).alias("both"), F.count_if(F.col("in_a") & ~F.col("in_b")).alias("only_a"), F.count_if(~F.col("in_a") & F.col("in_b")).alias("only_b"))
    return {
        "counts": counts,
        "only_a": only_a.orderBy(id_col).limit(samples),
        "only_b": only_b.orderBy(id_col).limit(samples),
        "lengths": lengths(only_a, id_col),
        "prefixes": prefixes(only_a, id_col),
        "blank": blank_ids(a, id_col),
    }


def describe(catalog) -> dict[str, DataFrame]:
    """What a catalogue holds, from its manifest alone."""
    files = catalog.files()
    return {"summary": summary(files), "years": year_shares(files), "largest": largest_buckets(files), "fragmented": fragmented(files), "files_per_bucket": files_per_bucket(files)}
