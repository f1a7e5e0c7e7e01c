"""The daily delta: inventory rows whose ids the index does not have, merged with what is pending."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import id_of_key, is_item_key, with_id_hash
from ..sources import files as io
from . import hashindex
from .dedup import first_by


def hashed_inventory(inventory: DataFrame) -> DataFrame:
    """(bucket, key, id_hash, n): item keys with the hash of their id; n numbers rows as they come."""
    rows = inventory.where(is_item_key(F.col("key"))).select("bucket", "key", id_of_key(F.col("key")).alias("id"), F.monotonically_increasing_id().alias("n"))
    return with_id_hash(rows).select("bucket", "key", "id_hash", "n")


def new_rows(hashed: DataFrame, index: DataFrame) -> DataFrame:
    """Rows whose hash is not in the index: an anti join that Spark plans by size, spilling where it must."""
    return hashed.join(index.select("id_hash").distinct(), "id_hash", "left_anti")


def merge_pending(fresh: DataFrame, pending: list[DataFrame]) -> DataFrame:
    """One row for each hash: new rows before pending ones, of new rows the last, of pending deltas the oldest."""
    parts = [fresh.select("bucket", "key", "id_hash", F.lit(0).alias("source"), (-F.col("n")).alias("turn"))]
    parts += [p.select("bucket", "key", "id_hash", F.lit(i + 1).alias("source"), F.lit(0).cast("long").alias("turn")) for i, p in enumerate(pending)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return first_by(both, ["id_hash"], [F.col("source").asc(), F.col("turn").asc(), F.col("bucket").asc(), F.col("key").asc()]).select("bucket", "key", "id_hash")


def daily_delta(spark: SparkSession, inventory: DataFrame | None, index_path: str, folder: str, date: str) -> dict:
    """Write folder/delta_<date>.parquet unless it is there; the hashed inventory is kept and used again."""
    target, cache = f"{folder}/delta_{date}.parquet", f"{folder}/inventory_{date}.parquet"
    if io.exists(spark, f"{target}/_SUCCESS"):
        return {"status": "exists", "path": target, "rows": spark.read.parquet(target).count()}
    reused = io.exists(spark, f"{cache}/_SUCCESS")
    if not reused:
        hashed_inventory(inventory).write.mode("overwrite").option("compression", "zstd").parquet(cache)
    hashed = spark.read.parquet(cache)
    older = [p for p in io.pending_deltas(spark, folder) if p != target]
    fresh = new_rows(hashed, hashindex.read_index(spark, index_path))
    n_new = fresh.select("id_hash").distinct().count()
    merged = merge_pending(fresh, [spark.read.schema(io.DELTA).parquet(p) for p in older])
    wrote = io.write_parquet(merged, target, if_rows=True)
    rows = spark.read.parquet(target).count() if wrote else 0
    if wrote:
        for p in older:  # their rows are in the new one
            io.remove(spark, p)
    return {"status": "written" if wrote else "empty", "path": target if wrote else None, "rows": rows, "new": n_new, "superseded": len(older) if wrote else 0, "inventory_reused": reused}
