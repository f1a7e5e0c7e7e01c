"""Ingest: inventory to committed files, as one plan; failed items become dead letters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import fanout
from ..operators.dedup import latest
from ..sources import fetch as fetching
from ..sources import files as io
from ..sources.inventory import read_inventory
from .catalog import Catalog


def ingest_documents(catalog: Catalog, documents: DataFrame, deduplicate: str | None = "updated", action: str = "append", **write) -> dict:
    """Documents (body) into the catalogue as one snapshot: parse, cells, fan-out, dedup in a bucket, sorted files."""
    rows = fanout.fan_out(fanout.parse_items(documents.select("body")), catalog.grid())
    if deduplicate:
        rows = latest(rows, deduplicate)
    added = catalog.write_rows(rows, **write)
    snapshot = catalog.change(lambda files: files.unionByName(added), action)
    total = added.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("*").alias("files"), F.countDistinct("grid_partition").alias("cells"), F.countDistinct("year").alias("years")).first()
    return {"snapshot": snapshot, **total.asDict()}


def ingest_inventory(catalog: Catalog, inventory: str, make_reader: Callable, since: str | None = None, limit: int | None = None, dead_letters: str | None = None, fetch: dict | None = None, **options) -> dict:
    """Read an inventory, fetch its items, ingest them; failures go to the dead-letter folder."""
    keys = read_inventory(catalog.spark, inventory, since, limit)
    fetched = fetching.fetch(keys.repartition("key"), make_reader, **(fetch or {})).persist(StorageLevel.DISK_ONLY)  # each item is fetched once
    try:
        report = ingest_documents(catalog, fetched.where("error is null"), **options)
        counts = fetched.agg(F.count("*").alias("source_items"), F.count("error").alias("failed")).first()
        if dead_letters and counts.failed:
            fetching.failures(fetched).write.mode("append").parquet(dead_letters)
        items = counts.source_items - counts.failed
        return report | counts.asDict() | {"avg_fan_out": round(report["rows"] / items, 4) if items else 0.0, "overhead_pct": round(100.0 * (report["rows"] - items) / items, 2) if items else 0.0}
    finally:
        fetched.unpersist()


def backfill(catalog: Catalog, inventory: str, make_reader: Callable, staging: str, chunk_rows: int = 100_000, since: str | None = None, fetch: dict | None = None, **options) -> dict:
    """A resumable ingest: numbered chunks of the inventory, each one commit that bears the chunk's name.

    A chunk folder counts when its write was completed. A chunk is done when its
    marker is there and nothing of it is pending, or when its commit is there
    (the run died before the marker). Keys that failed are pending; the next run
    asks for them again in one commit of their own, and forgets those that came.
    """
    spark = catalog.spark
    chunks = f"{staging}/chunks"
    if not io.exists(spark, f"{chunks}/_SUCCESS"):
        keys = read_inventory(spark, inventory, since)
        # Numbered by hash, so no global order is needed: a chunk has about chunk_rows keys.
        n = max(1, -(-keys.count() // chunk_rows))
        keys.withColumn("chunk", F.pmod(F.xxhash64("bucket", "key"), F.lit(n)).cast("int")).write.mode("overwrite").partitionBy("chunk").parquet(chunks)
    numbers = sorted(int(x[6:]) for x in io.list_names(spark, chunks) if x.startswith("chunk="))
    done = {int(x.split(".")[0]) for x in io.list_names(spark, f"{staging}/done")}
    reports = []

    def run(keys: DataFrame, action: str, failed: str) -> None:
        fetched = fetching.fetch(keys, make_reader, **(fetch or {})).persist(StorageLevel.DISK_ONLY)
        try:
            if not catalog.committed(action):
                reports.append(ingest_documents(catalog, fetched.where("error is null"), action=action, **options))
            io.remove(spark, failed)
            io.write_parquet(fetching.failures(fetched), failed, if_rows=True)
        finally:
            fetched.unpersist()

    for k in numbers:
        if k not in done:
            run(spark.read.schema("bucket string, key string").parquet(f"{chunks}/chunk={k}"), f"backfill {staging} chunk {k}", f"{staging}/pending/chunk={k}")
            io.write_text(spark, f"{staging}/done/{k}.json", "{}")
    retried = 0
    for k in sorted(done & set(numbers)):
        waiting = f"{staging}/pending/chunk={k}"
        if io.exists(spark, f"{waiting}/_SUCCESS"):
            # Each retry writes and commits under a name of its own; what failed again takes the old list's place.
            keys = spark.createDataFrame(spark.read.parquet(waiting).select("bucket", "key").collect(), "bucket string, key string")  # at most a chunk's keys
            retried += keys.count()
            run(keys, f"backfill {staging} chunk {k} again {uuid.uuid4().hex[:8]}", waiting)
    return {"chunks": len(numbers), "skipped": len(done & set(numbers)), "retried": retried, "rows": sum(r["rows"] for r in reports), "files": sum(r["files"] for r in reports)}


def pending(catalog: Catalog, staging: str) -> DataFrame:
    """Keys that failed in a backfill and that its next run asks for again."""
    return io.read_or_empty(catalog.spark, f"{staging}/pending", "bucket string, key string, error string, timestamp string")


def clean_up(catalog: Catalog, staging: str) -> None:
    """Remove markers and pending failures; chunks stay."""
    for name in ("done", "pending"):
        io.remove(catalog.spark, f"{staging}/{name}")
