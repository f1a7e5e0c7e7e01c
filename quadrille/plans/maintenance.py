"""Maintenance: compaction, consolidation, repair, and what is no longer needed.

New files first, then one commit; files that the commit drops stay for readers
that began before it. `expire` forgets snapshots that have been out of date for
a grace period, and `remove_orphans` deletes files that no snapshot lists.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import file_class, year_of
from ..operators import fanout
from ..operators.dedup import BUCKET, latest
from ..schema import BOUNDS, STORED
from ..sources import files as io
from .catalog import Catalog


def candidates(files: DataFrame, threshold: int = 2) -> DataFrame:
    """Buckets with at least `threshold` files: (grid_partition, year, files, rows, bytes)."""
    return files.groupBy(*BUCKET).agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).where(F.col("files") >= threshold)


def _rewrite(catalog: Catalog, old: DataFrame, by: str | None, action: str, dedup: Callable[[DataFrame], DataFrame] | None = None, **write) -> dict:
    """Rewrite the rows of some files bucket by bucket in one job: dedup, sort, new files, check, commit.

    The rows read must be as many as the manifest says, and the rows written as
    many as there are ids in the buckets (or as many as read, without dedup);
    else nothing is changed.
    """
    listed = old.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count("*")).first()
    rows = catalog.read(old)
    keep = dedup or ((lambda df: latest(df, by)) if by and by in rows.columns else None)
    ids = rows.groupBy(*BUCKET, "id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_in, n_ids = ids
    if n_in != listed[0]:
        raise RuntimeError(f"the manifest lists {listed[0]} rows and {n_in} were read; nothing is changed")
    added = catalog.write_rows(keep(rows) if keep else rows, kind="compacted", missing_last=True, **write)
    n_out, files_after = added.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count("*")).first()
    if n_out != (n_ids if keep else n_in):
        raise RuntimeError(f"{n_in} rows of {n_ids} ids were read and {n_out} written; nothing is changed")
    catalog.replace_files(old, added, action)
    return {"files_before": listed[1], "files_after": files_after, "input_rows": n_in, "output_rows": n_out, "duplicates_removed": n_in - n_out}


def _fixed(catalog: Catalog, files: DataFrame) -> DataFrame:
    """Manifest rows as a table of their own, so that a plan made from them does not follow the current manifest."""
    path = f"{catalog.meta}/written/chosen-{time.time_ns():x}"
    files.write.parquet(path)
    return catalog.spark.read.schema(files.schema).parquet(path)


def compact(catalog: Catalog, threshold: int = 2, by: str = "updated", rows_per_file: int = 1_000_000, dry_run: bool = False, codec: str = "zstd") -> dict:
    """Rewrite every bucket of at least `threshold` files to one sorted `compacted_` file (more beyond rows_per_file) without repeated ids.

    A bucket that holds one file already stays as it is.
    """
    files = catalog.files()
    scanned = files.select(*BUCKET).distinct().count()
    chosen = candidates(files, threshold).select(*BUCKET)
    old = files.join(chosen, BUCKET, "left_semi")
    report = {"buckets_scanned": scanned, "buckets_compacted": chosen.count(), "files_before": old.count(), "files_after": 0, "input_rows": 0, "output_rows": 0, "duplicates_removed": 0}
    if dry_run or not report["buckets_compacted"]:
        return report
    return report | _rewrite(catalog, _fixed(catalog, old.select(*files.columns)), by, "compact", rows_per_file=rows_per_file, codec=codec)


def finish(catalog: Catalog, by: str = "updated", rows_per_file: int = 1_000_000, codec: str = "zstd") -> dict:
    """The last compaction: every bucket that is not one compacted file becomes one, a lone part as well."""
    files = catalog.files()
    state = files.groupBy(*BUCKET).agg(F.count("*").alias("files"), F.bool_and(file_class(F.col("path")) == "compacted").alias("done"))
    todo = state.where("not (done and files = 1)").select(*BUCKET)
    old = _fixed(catalog, files.join(todo, BUCKET, "left_semi").select(*files.columns))
    if old.isEmpty():
        return {"files_before": 0, "files_after": 0, "input_rows": 0, "output_rows": 0, "duplicates_removed": 0}
    return _rewrite(catalog, old, by, "finish", rows_per_file=rows_per_file, codec=codec)


def tail_plan(files: DataFrame, rows_per_file: int, threshold: int = 2) -> DataFrame:
    """Files to merge: in a bucket ordered by path, the first with fewer than rows_per_file rows and all after it, where that is `threshold` or more."""
    numbered = files.withColumn("at", F.row_number().over(Window.partitionBy(*BUCKET).orderBy("path")))
    first = numbered.where(F.col("rows") < rows_per_file).groupBy(*BUCKET).agg(F.min("at").alias("from"))
    tail = numbered.join(first, BUCKET).where(F.col("at") >= F.col("from"))
    enough = tail.groupBy(*BUCKET).agg(F.count("*").alias("n")).where(F.col("n") >= threshold).select(*BUCKET)
    return tail.join(enough, BUCKET, "left_semi").drop("at", "from")


def consolidate(catalog: Catalog, rows_per_file: int = 100_000, threshold: int = 2, by: str = "updated", dry_run: bool = False) -> dict:
    """Merge the tails of buckets; full leading files are not touched. Commits only if something changes."""
    files = catalog.files()
    old = tail_plan(files, rows_per_file, threshold).select(*files.columns)
    n = old.agg(F.count("*").alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.countDistinct(*BUCKET).alias("buckets")).first()
    report = {"partitions_scanned": files.select(*BUCKET).distinct().count(), "partitions_consolidated": n.buckets, "files_merged": n.files, "rows_merged": n.rows}
    if dry_run or not n.files:
        return report
    return report | _rewrite(catalog, _fixed(catalog, old), by, "consolidate", rows_per_file=rows_per_file)


def migrate_legacy(catalog: Catalog, path: str) -> DataFrame:
    """Rows in the stored schema from files that keep whole documents; cells and years as the documents say."""
    rows = fanout.parse_items(io.read_legacy(catalog.spark, path))
    return rows.select(*[F.col(f"`{n}`") for n in STORED.fieldNames()], *BOUNDS, year_of(F.col("datetime")).alias("year"))


def repair_status(columns: list[str], codecs: set[str], bbox_kind: str | None) -> str:
    """What a stored file needs, the first that applies: raw-document, recompress, bbox, cell, none."""
    if "raw_stac" in columns:
        return "raw-document"
    if codecs - {"ZSTD"}:
        return "recompress"
    if bbox_kind == "object":
        return "bbox"
    if "grid_partition" not in columns:
        return "cell"
    return "none"


def repair(rows: DataFrame) -> DataFrame:
    """Rows in the stored schema: bbox objects to arrays, missing cells from the path, missing columns null, declared types."""
    have = set(rows.columns)
    path_cell = F.regexp_extract(F.col("_metadata.file_path"), "/grid_partition=([^/]*)/", 1)
    out = []
    for f in STORED.fields:
        c = F.col(f"`{f.name}`") if f.name in have else F.lit(None)
        if f.name == "grid_partition":
            c = F.coalesce(c, F.nullif(path_cell, F.lit("")))
        elif f.name == "bbox":
            as_struct = F.from_json(c.cast("string"), "xmin double, ymin double, xmax double, ymax double")
            c = F.when(F.trim(c.cast("string")).startswith("{"), F.to_json(F.array(*[as_struct[k] for k in BOUNDS]))).otherwise(c)
        out.append(c.cast(f.dataType).alias(f.name))
    return rows.select(*out)


def repair_plan(catalog: Catalog) -> DataFrame:
    """(path, status) of every listed file whose footer calls for a repair, read file by file on the executors."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                store, where = io.arrow_store(path)
                with store.open_input_file(where) as f:
                    found = pq.ParquetFile(f)
                    meta, schema = found.metadata, found.schema_arrow
                    codecs = {meta.row_group(g).column(c).compression for g in range(meta.num_row_groups) for c in range(meta.num_columns)}
                kind = "object" if "bbox" in schema.names and pa.types.is_struct(schema.field("bbox").type) else None
                names = list(schema.names)
                coded = "grid_partition" in names and pa.types.is_dictionary(schema.field("grid_partition").type)
                out.append(repair_status([n for n in names if not (coded and n == "grid_partition")], codecs - {"UNCOMPRESSED"} if not meta.num_rows else codecs, kind))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["path", "status"])

    listed = catalog.files().select("path")
    # A cell that only the path names is this engine's own layout and no fault.
    return listed.repartition("path").mapInArrow(run, "path string, status string").where("status not in ('none', 'cell')")


def repair_files(catalog: Catalog, rows_per_file: int = 1_000_000) -> dict:
    """Rewrite the files that repair_plan names, in place as to bucket: documents are parsed, other faults mended; one commit.

    Run again, it finds nothing to do.
    """
    spark = catalog.spark
    plan = _fixed(catalog, repair_plan(catalog))
    counts = {r.status: r.n for r in plan.groupBy("status").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {"files": 0, "statuses": {}, "rows": 0}
    old = _fixed(catalog, catalog.files().join(plan.select("path"), "path", "left_semi").select(*catalog.files().columns))
    parts = []
    for raw in (True, False):
        paths = [r.path for r in plan.where((F.col("status") == "raw-document") == raw).select("path").collect()]  # the files at fault only
        if not paths:
            continue
        rows = spark.read.option("basePath", catalog.data).option("mergeSchema", True).parquet(*paths)
        place = rows.select("*", F.regexp_extract(F.col("_metadata.file_path"), "/grid_partition=([^/]*)/", 1).alias("__cell"))
        if raw:
            made = fanout.parse_items(place.select(F.col("raw_stac").alias("body"), "__cell"))
            made = made.withColumn("grid_partition", F.coalesce("grid_partition", F.nullif("__cell", F.lit("")))).select(*[F.col(f"`{n}`") for n in STORED.fieldNames()])
        else:
            made = repair(rows)
        parts.append(made.withColumn("year", year_of(F.col("datetime"))))
    fixed = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    added = catalog.write_rows(fixed, rows_per_file=rows_per_file, kind="part")
    n_out = added.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    n_in = old.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if n_in != n_out:
        raise RuntimeError(f"the manifest lists {n_in} rows and {n_out} were written; nothing is changed")
    catalog.replace_files(old, added, "repair")
    return {"files": sum(counts.values()), "statuses": counts, "rows": n_out}


def expire(catalog: Catalog, grace_hours: float = 24.0) -> int:
    """Forget snapshots that another one replaced more than the grace period ago; how many. The current one stays."""
    found = catalog.snapshots()
    late = time.time() - grace_hours * 3600
    gone = [s for s, after in zip(found, found[1:]) if datetime.fromisoformat(after["at"]).timestamp() <= late]
    for s in gone:
        io.remove(catalog.spark, f"{catalog.meta}/snapshots/{s['id']:08d}.json")
        io.remove(catalog.spark, s["manifest"])
    for name in io.list_names(catalog.spark, f"{catalog.meta}/written"):  # what writers listed before their commits
        if io.modified_at(catalog.spark, f"{catalog.meta}/written/{name}") <= late:
            io.remove(catalog.spark, f"{catalog.meta}/written/{name}")
    return len(gone)


def remove_orphans(catalog: Catalog, dry_run: bool = True, grace_hours: float = 24.0) -> DataFrame:
    """(path) of data files that no snapshot lists and that are older than the grace period: left by failed writers or replaced before `expire`.

    Younger ones may belong to a writer that has not committed yet.
    """
    spark = catalog.spark
    if not io.exists(spark, catalog.data):
        return spark.createDataFrame([], "path string")
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(catalog.data)
    found = stored.where(F.col("modificationTime") <= F.timestamp_seconds(F.lit(time.time() - grace_hours * 3600))).select(F.url_decode(F.col("_metadata.file_path")).alias("path"))
    for s in catalog.snapshots():
        found = found.join(catalog.files(s["id"]).select("path"), "path", "left_anti")
    orphans = _fixed(catalog, found)
    if not dry_run:
        for r in orphans.toLocalIterator():
            io.remove(spark, r.path)
    return orphans


def stragglers(files: DataFrame) -> DataFrame:
    """Files to merge in buckets of an imported warehouse that were not finished: the part files where there are some, else temporary and compacted ones."""
    name = F.element_at(F.split("path", "/"), -1)
    marked = files.withColumn("kind", F.when(name.startswith("tmp_"), "temporary").otherwise(file_class(F.col("path"))))
    has = marked.groupBy(*BUCKET).agg(F.bool_or(F.col("kind") == "part").alias("parts"), F.bool_or(F.col("kind") == "temporary").alias("temporaries"))
    joined = marked.join(has, BUCKET)
    wanted = F.when(F.col("parts"), F.col("kind") == "part").when(F.col("temporaries"), F.col("kind").isin("temporary", "compacted")).otherwise(F.lit(False))
    return joined.where(wanted).select(*files.columns)
