"""Object inventories: CSV, gzipped CSV, Parquet, and manifests of either."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C

MODIFIED = "last_modified_date"


def _first_line(spark: SparkSession, path: str) -> str:
    lines = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
    return lines[0].value if lines else ""


def read_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """(bucket, key, last_modified text) of CSV, also gzipped; several files are one read and have one layout, the first file's.

    Bucket and key are the first two columns whatever the header calls them. A
    first row whose first field is `bucket` is a header and may place the time
    of modification; without a header there is none. Blank rows are skipped.
    """
    head = [h.strip().strip('"').lower() for h in _first_line(spark, paths[0]).split(",")]
    has_header = head[0] == "bucket"
    names = [f"_{i}" for i in range(max(2, len(head)))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.schema(schema).option("header", has_header).option("enforceSchema", True).option("escape", '"').csv(list(paths))
    modified = F.col(f"_{head.index(MODIFIED)}") if has_header and MODIFIED in head else F.lit(None).cast("string")
    return rows.select(F.col("_0").alias("bucket"), F.col("_1").alias("key"), modified.alias("last_modified")).where("coalesce(bucket, '') != '' or coalesce(key, '') != ''")


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    rows = spark.read.parquet(*paths)
    modified = F.col(MODIFIED) if MODIFIED in rows.columns else F.lit(None).cast("string")
    return rows.select("bucket", "key", modified.alias("last_modified"))


def parse_manifest(text: str) -> dict:
    """Data files (bucket, key, md5, size) and format of a manifest document."""
    doc = json.loads(text)
    arn = doc.get("destinationBucket") or ""
    bucket = arn.rpartition(":::")[2] or arn
    files = [{"bucket": bucket or doc.get("sourceBucket"), "key": f["key"], "md5": f.get("MD5checksum"), "size": f.get("size")} for f in doc.get("files", [])]
    return {"format": (doc.get("fileFormat") or "CSV").upper(), "files": files}


def manifest_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows (position, key, md5, size) of a manifest, in its order."""
    doc = spark.read.text(path, wholetext=True)
    files = F.from_json(F.get_json_object("value", "$.files"), "array<struct<key:string,MD5checksum:string,size:bigint>>")
    return doc.select(F.posexplode(files).alias("position", "f")).select("position", F.col("f.key").alias("key"), F.col("f.MD5checksum").alias("md5"), F.col("f.size").alias("size"))


def read_manifest(spark: SparkSession, path: str, resolve=None) -> DataFrame:
    """Rows of all data files of a manifest; resolve(bucket, key) gives a file's path (default: beside the manifest)."""
    found = parse_manifest(spark.read.text(path, wholetext=True).first().value)
    top = path.rsplit("/", 1)[0]
    resolve = resolve or (lambda bucket, key: f"{top}/{key}")
    paths = [resolve(f["bucket"], f["key"]) for f in found["files"]]
    if not paths:
        return spark.createDataFrame([], "bucket string, key string, last_modified string")
    if found["format"] == "PARQUET" or paths[0].endswith(".parquet"):
        return read_parquet(spark, *paths)
    return read_csv(spark, *paths)


def read_inventory(spark: SparkSession, path: str, since: str | None = None, limit: int | None = None, resolve=None) -> DataFrame:
    """Item keys (bucket, key, last_modified) of an inventory, by the kind of its path.

    `since` keeps rows modified at or after a moment and those without a
    readable time. `limit` counts item keys; None is no limit.
    """
    name = path.rstrip("/")
    if name.endswith("manifest.json"):
        rows = read_manifest(spark, path, resolve)
    elif name.endswith(".parquet"):
        rows = read_parquet(spark, path)
    else:
        rows = read_csv(spark, path)
    kind = rows.schema["last_modified"].dataType
    moment = C.utc_timestamp(F.col("last_modified")) if isinstance(kind, T.StringType) else F.col("last_modified").cast("timestamp")
    rows = rows.withColumn("last_modified", moment).where(C.is_item_key(F.col("key")) & C.fresh(F.col("last_modified"), since))
    return rows if limit is None else rows.limit(limit)


def keys_with_ids_of(rows: DataFrame) -> DataFrame:
    """(id, bucket, key) of inventory rows."""
    return rows.select(C.id_of_key(F.col("key")).alias("id"), "bucket", "key")


def inventory_of(spark: SparkSession, folder: str, bucket: str, limit: int | None = None) -> DataFrame:
    """(bucket, key) of the JSON files below a folder, by name: an inventory for tests."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(folder)
    top = F.lit(folder.rstrip("/").split(":", 1)[-1].replace("//", "") + "/")
    rows = files.select(F.lit(bucket).alias("bucket"), F.element_at(F.split("path", top), -1).alias("key")).orderBy("key")
    return rows if limit is None else rows.limit(limit)
