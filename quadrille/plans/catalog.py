"""The catalogue: a warehouse folder with versioned manifests.

root/
  data/grid_partition=<cell>/year=<year>/*.parquet   the files
  meta/properties.json                               grid and other properties
  meta/manifest-<n>/                                 the files of snapshot n, as Parquet
  meta/snapshots/<n>.json                            what snapshot n is; the largest n is current

A commit writes its manifest, then creates snapshots/<n>.json, which fails if
another writer was first; `change` then reads the newer manifest and tries
again, so no commit is lost. Data files are written straight into the data
folder and count from the commit that lists them. They are only removed by
maintenance, when no snapshot that a reader may still use lists them.
"""

from __future__ import annotations

import json
import os
import socket
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.grids import Grid, make_grid
from ..schema import BOUNDS, STORED
from ..sources import files as io
from . import geoparquet
from .geoparquet import FILES


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


class CatalogLocked(RuntimeError):
    pass


class Conflict(RuntimeError):
    """Another commit came first."""


class Catalog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.data, self.meta = f"{self.root}/data", f"{self.root}/meta"
        #: Writes data files wherever rows are written (ingest, streams, maintenance); any function like this one may take its place.
        self.writer: Callable[..., DataFrame] = geoparquet.write_files
        # Spark lists files with a task for each path, up to 10,000 of them; a few for each core do that faster.
        if spark.conf.get(_LISTING, "10000") == "10000":
            spark.conf.set(_LISTING, str(4 * spark.sparkContext.defaultParallelism))

    # -- opening and properties

    @classmethod
    def create(cls, spark: SparkSession, root: str, grid: Grid | None = None, **properties: str) -> Catalog:
        """Open or create; properties that are missing are filled in, existing ones stay."""
        self = cls(spark, root)
        wanted = {**(grid.properties() if grid else {}), **{k: str(v) for k, v in properties.items()}}
        have = self.properties()
        if {**wanted, **have} != have or not have:
            io.write_text(spark, f"{self.meta}/properties.json", json.dumps({**wanted, **have}))
        return self

    def properties(self) -> dict[str, str]:
        return io.read_report(self.spark, f"{self.meta}/properties.json") or {}

    def grid(self) -> Grid:
        p = self.properties()
        resolution = p.get("grid.resolution")
        return make_grid(self.spark, p.get("grid.type", "latlon"), int(resolution) if resolution else None, p.get("grid.boundaries_path"), p.get("grid.id_field", "id"))

    # -- snapshots

    def snapshots(self) -> list[dict]:
        names = [n for n in io.list_names(self.spark, f"{self.meta}/snapshots") if n.endswith(".json")]
        return [io.read_report(self.spark, f"{self.meta}/snapshots/{n}") for n in names]

    def current(self) -> dict | None:
        names = [n for n in io.list_names(self.spark, f"{self.meta}/snapshots") if n.endswith(".json")]
        return io.read_report(self.spark, f"{self.meta}/snapshots/{names[-1]}") if names else None

    def files(self, snapshot: int | None = None) -> DataFrame:
        """The manifest of a snapshot (default: the current one)."""
        return self._listed(self.current() if snapshot is None else next(s for s in self.snapshots() if s["id"] == snapshot))

    def _listed(self, snapshot: dict | None) -> DataFrame:
        return self.spark.read.schema(FILES).parquet(snapshot["manifest"]) if snapshot else self.spark.createDataFrame([], FILES)

    def commit(self, files: DataFrame, action: str, based_on: int | None = None) -> int:
        """Make a manifest the current one."""
        now = self.current()
        last = now["id"] if now else 0
        if based_on is not None and based_on != last:
            raise Conflict(f"snapshot {last} came after {based_on}")
        n = last + 1
        manifest = f"{self.meta}/manifest-{n:08d}-{uuid.uuid4().hex[:8]}"
        files.select(*[c.split()[0] for c in FILES.split(", ")]).coalesce(1).write.parquet(manifest)
        made = {"id": n, "parent": last or None, "action": action, "manifest": manifest, "at": datetime.now(timezone.utc).isoformat()}
        if not io.write_text(self.spark, f"{self.meta}/snapshots/{n:08d}.json", json.dumps(made), overwrite=False):
            io.remove(self.spark, manifest)
            raise Conflict(f"snapshot {n} is there already")
        return n

    def change(self, make: Callable[[DataFrame], DataFrame], action: str, attempts: int = 20) -> int:
        """Commit what `make` makes of the current manifest; again from the newer one if another commit came first."""
        for attempt in range(attempts):
            now = self.current()
            try:
                return self.commit(make(self._listed(now)), action, now["id"] if now else 0)
            except Conflict:
                if attempt + 1 == attempts:
                    raise
        raise Conflict("no attempt was allowed")

    def committed(self, action: str) -> bool:
        """Whether a snapshot with this action is there: what makes a batch or chunk of that name run once."""
        return any(s["action"] == action for s in self.snapshots())

    # -- writing

    def describe_files(self, paths: DataFrame | None = None) -> DataFrame:
        """Manifest rows of all data files that lie in the folder, or of some (path): those alone are read."""
        if paths is not None:
            listed = [r.path for r in paths.select("path").distinct().collect()]  # the new files only
            return self._described(self.spark.read.schema("datetime timestamp").option("basePath", self.data).parquet(*listed)) if listed else self.spark.createDataFrame([], FILES)
        if not io.exists(self.spark, self.data):
            return self.spark.createDataFrame([], FILES)
        return self._described(self.spark.read.schema("datetime timestamp").parquet(self.data))

    def _described(self, rows: DataFrame) -> DataFrame:
        found = rows.select(F.url_decode(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_size").alias("bytes"), "datetime")
        summed = found.groupBy("path").agg(F.count("*").alias("rows"), F.max("bytes").alias("bytes"), F.min("datetime").alias("min_datetime"), F.max("datetime").alias("max_datetime"))
        return summed.select("path", F.regexp_extract("path", "/grid_partition=([^/]*)/", 1).alias("grid_partition"), F.regexp_extract("path", "/year=([^/]*)/", 1).alias("year"), "rows", "bytes", "min_datetime", "max_datetime")

    def write_rows(self, rows: DataFrame, write: Callable[..., DataFrame] | None = None, **options) -> DataFrame:
        """Write fanned-out rows to new files, by `write` or the catalogue's writer, and return their manifest rows; nothing is committed yet."""
        now = self.current()
        listing = f"{self.meta}/written/{uuid.uuid4().hex[:12]}"
        return (write or self.writer)(rows, self.data, listing, number=(now["id"] if now else 0) + 1, **options)

    def append(self, rows: DataFrame, action: str = "append", **options) -> int:
        added = self.write_rows(rows, **options)
        return self.change(lambda files: files.unionByName(added), action)

    def replace_files(self, gone: DataFrame, added: DataFrame, action: str) -> int:
        """Put new files in the place of some, all of which must still be listed (else Conflict)."""
        n = gone.count()

        def replaced(files: DataFrame) -> DataFrame:
            if files.join(gone.select("path"), "path", "left_semi").count() != n:
                raise RuntimeError("files that were to be replaced are no longer listed; nothing is changed")
            return files.join(gone.select("path"), "path", "left_anti").unionByName(added)

        return self.change(replaced, action)

    def register(self, action: str = "register") -> int:
        """Make the files that lie in the folder the current manifest (a rebuild)."""
        return self.commit(self.describe_files(), action)

    def register_new(self, paths: DataFrame, index: str | None = None) -> int:
        """Add files (path) that lie in the folder and are not in the manifest; with `index`, their ids enter that hash index as well."""

        def added(files: DataFrame) -> DataFrame:
            new = paths.select("path").distinct().join(files.select("path"), "path", "left_anti")
            return files.unionByName(self.describe_files(new))

        made = self.change(added, "register-delta")
        if index is not None:
            from ..operators import hashindex

            hashindex.merge_index(self.spark, index, self.read(paths).select("id"))
        return made

    # -- reading

    def read(self, files: DataFrame | None = None) -> DataFrame:
        """Rows of the current files, or of some of them."""
        listed = [r.path for r in (self.files() if files is None else files).select("path").collect()]  # paths of the pruned files only
        columns = [f for f in STORED.fields if f.name != "grid_partition"] + [T.StructField(b, T.DoubleType()) for b in BOUNDS]
        schema = T.StructType([*columns, T.StructField("grid_partition", T.StringType()), T.StructField("year", T.StringType())])
        if not listed:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.data).parquet(*listed)

    def statistics(self) -> DataFrame:
        """(grid_partition, year, rows, files, bytes) from the manifest alone."""
        return self.files().groupBy("grid_partition", "year").agg(F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("bytes").alias("bytes")).orderBy("grid_partition", "year")

    # -- lock

    def lock(self, owner: str, ttl_hours: float = 12.0) -> Lock:
        return Lock(self, owner, ttl_hours)


class Lock:
    """A lock file that one writer creates; one older than its own time to live is stale and taken over."""

    def __init__(self, catalog: Catalog, owner: str, ttl_hours: float = 12.0):
        self.catalog, self.owner, self.ttl_hours = catalog, owner, ttl_hours
        self.path = f"{catalog.meta}/lock.json"

    def acquire(self) -> Lock:
        spark = self.catalog.spark
        mine = json.dumps({"owner": self.owner, "pid": os.getpid(), "hostname": socket.gethostname(), "acquired": time.time(), "ttl_hours": self.ttl_hours})
        if io.write_text(spark, self.path, mine, overwrite=False):
            return self
        other = io.read_report(spark, self.path) or {}
        if time.time() - other.get("acquired", 0) < other.get("ttl_hours", 12.0) * 3600:
            raise CatalogLocked(f"held by {other.get('owner')} on {other.get('hostname')}")
        io.remove(spark, self.path)
        if not io.write_text(spark, self.path, mine, overwrite=False):
            raise CatalogLocked("taken by another writer")
        return self

    def release(self) -> None:
        io.remove(self.catalog.spark, self.path)

    __enter__ = acquire

    def __exit__(self, *_) -> None:
        self.release()
