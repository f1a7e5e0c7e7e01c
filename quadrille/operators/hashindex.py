"""The index of known ids: sorted 16-byte hashes as Parquet, in versions.

An index is a folder with v-<name>/ folders of files and pointers
versions/<n>.txt, each of which is created once and names a version; the
largest number is current. An update writes a new version beside the current
one and then its pointer, so a crash between leaves the old index in force. The
version before stays for readers that began with it. A plain folder of files is
an index as well. A broken index is an error; only an absent one is empty.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import id_of_key, with_id_hash
from ..sources import files as io

INDEX = "id_hash binary"


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    return [(int(n[:-4]), io.read_text(spark, f"{path}/versions/{n}").strip()) for n in io.list_names(spark, f"{path}/versions") if n.endswith(".txt")]


def read_index(spark: SparkSession, path: str) -> DataFrame:
    found = _versions(spark, path)
    if found:
        return spark.read.schema(INDEX).parquet(f"{path}/{found[-1][1]}")
    names = io.list_names(spark, path)
    if not [n for n in names if not n.startswith(("v-", "versions"))]:  # absent, or its first version was never finished
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).parquet(path if path.rstrip("/").rpartition("/")[2] in names else f"{path}/*.parquet")


def hashes_of(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Distinct hashes of the ids that are not null."""
    known = ids.select(F.col(id_col).alias("id")).where("id is not null")
    return with_id_hash(known).select("id_hash").distinct()


def write_index(hashes: DataFrame, path: str) -> int:
    """Make distinct hashes, in order (range-partitioned, so files follow each other), the current version; how many there are."""
    spark = hashes.sparkSession
    before = _versions(spark, path)
    name = f"v-{uuid.uuid4().hex[:12]}"
    hashes.select("id_hash").where("id_hash is not null").distinct().orderBy("id_hash").write.option("compression", "zstd").parquet(f"{path}/{name}")
    total = spark.read.schema(INDEX).parquet(f"{path}/{name}").count()
    n = before[-1][0] + 1 if before else 1
    if not io.write_text(spark, f"{path}/versions/{n:08d}.txt", name, overwrite=False):
        io.remove(spark, f"{path}/{name}")
        raise RuntimeError(f"another writer made version {n} of the index first")
    for old, folder in before[:-1]:
        io.remove(spark, f"{path}/versions/{old:08d}.txt")
        io.remove(spark, f"{path}/{folder}")
    return total


def merge_index(spark: SparkSession, path: str, new_ids: DataFrame, id_col: str = "id") -> dict:
    """Add ids to an index."""
    old = read_index(spark, path)
    before = old.count()
    total = write_index(old.unionByName(hashes_of(new_ids, id_col)), path)
    return {"before": before, "added": total - before, "total": total}


def merge_from_keys(spark: SparkSession, path: str, keys: DataFrame) -> dict:
    return merge_index(spark, path, keys.select(id_of_key(F.col("key")).alias("id")))


def rebuild_index(catalog, path: str) -> int:
    """From the whole warehouse: only the id column is read."""
    return write_index(hashes_of(catalog.read().select("id")), path)
