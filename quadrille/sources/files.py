"""Other sources and all sinks that are not the warehouse."""

from __future__ import annotations

import json

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C

DELTA = "bucket string, key string, id_hash binary"


def hadoop(spark: SparkSession, path: str):
    """(file system, Path) of a path, through Hadoop."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = hadoop(spark, path)
    return fs.exists(where)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, where = hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, where = hadoop(spark, path)
    if not fs.exists(where):
        return None
    return spark.read.text(path, wholetext=True).first().value


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> bool:
    """Write a small file; without overwrite, False if it is there already."""
    fs, where = hadoop(spark, path)
    if not overwrite:
        try:
            out = fs.create(where, False)
        except Exception as e:
            if fs.exists(where):
                return False
            raise e
    else:
        out = fs.create(where, True)
    out.write(bytearray(text.encode()))
    out.close()
    return True


def modified_at(spark: SparkSession, path: str) -> float:
    """When a path was last changed, in seconds."""
    fs, where = hadoop(spark, path)
    return fs.getFileStatus(where).getModificationTime() / 1000


def arrow_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """(Arrow file system, path in it) of a path as Spark writes it; Hadoop's names for S3 are Arrow's `s3`."""
    scheme, mark, rest = uri.partition("://")
    if mark and scheme != "file":
        return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")
    return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else uri


def remove(spark: SparkSession, path: str) -> None:
    fs, where = hadoop(spark, path)
    fs.delete(where, True)


def rename(spark: SparkSession, a: str, b: str) -> None:
    fs, where = hadoop(spark, a)
    target = hadoop(spark, b)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(where, target):
        raise OSError(f"cannot rename {a} to {b}")


# ---------------------------------------------------------------- sources


def read_ndjson(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, line, body) of item documents, one a line; blank lines are skipped."""
    rows = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"), F.col("value").alias("body"))
    return rows.where(F.trim("body") != "").drop("block")


def read_legacy(spark: SparkSession, path: str) -> DataFrame:
    """(body) of files that keep whole documents in raw_stac."""
    rows = spark.read.parquet(path)
    if "raw_stac" not in rows.columns:
        raise ValueError(f"{path} has no raw_stac column")
    return rows.select(F.col("raw_stac").alias("body"))


def read_typed_csv(spark: SparkSession, path: str, schema: str = "id string") -> DataFrame:
    """Headerless typed CSV, also gzipped."""
    return spark.read.schema(schema).csv(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of Parquet files, or no rows where there is none; any other fault is an error."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def pending_deltas(spark: SparkSession, folder: str) -> list[str]:
    return [f"{folder}/{n}" for n in list_names(spark, folder) if n.startswith("delta_") and n.endswith(".parquet")]


def chunk_numbers(spark: SparkSession, folder: str) -> list[int]:
    names = [n for n in list_names(spark, folder) if n.startswith("chunk_") and n.endswith(".parquet")]
    return sorted(int(n[6:-8]) for n in names if n[6:-8].isdigit())


# ---------------------------------------------------------------- sinks


def write_parquet(df: DataFrame, path: str, if_rows: bool = False, codec: str = "zstd") -> bool:
    """Overwrite path; with if_rows only when there are rows."""
    if if_rows and df.isEmpty():
        return False
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return True


def write_csv(df: DataFrame, path: str, header: bool = True, quote_all: bool = False) -> None:
    df.write.mode("overwrite").option("header", header).option("quoteAll", quote_all).csv(path)


def append_ndjson(df: DataFrame, path: str, body: str = "body") -> None:
    """Append documents, one a line; existing files are not rewritten."""
    df.select(F.col(body)).write.mode("append").text(path)


def write_ids(df: DataFrame, path: str) -> None:
    df.select("id").write.mode("overwrite").text(path)


def write_chunks(df: DataFrame, path: str, rows: int) -> None:
    """Inventory rows in files of at most `rows` rows, a checkpoint for resumed runs."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)


def write_report(spark: SparkSession, path: str, report: dict) -> None:
    write_text(spark, path, json.dumps(report, indent=2, default=str))


def read_report(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, path)
    return None if text is None else json.loads(text)
