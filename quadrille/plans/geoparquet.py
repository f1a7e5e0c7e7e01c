"""The writer of data files: sorted rows, one open file in each task, with footer keys that describe the geometry.

Rows come sorted by bucket; a file is closed where the bucket changes or it is
full. Files are written straight into the data folder, each under a name that
only its attempt uses: they count for nothing until a commit lists them, so no
file is renamed or read again, and what a lost task leaves is an orphan. A
task's manifest rows (counts and times as written) go to the shared metadata
folder with the same job; nothing per file passes the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.fanout import ordered
from ..schema import BOUNDS, STORED
from ..sources.files import arrow_store

FILES = "path string, grid_partition string, year string, rows long, bytes long, min_datetime timestamp, max_datetime timestamp"

# Keys of the footer's documents.
GEO = {"version": "1.1.0", "primary_column": "geometry", "columns": {"geometry": {"encoding": "WKB", "geometry_types": []}}}
ITEMS = {"stac-geoparquet:version": "1.0.0", "collections": {}}
FOOTER = {"geo": json.dumps(GEO), "stac-geoparquet": json.dumps(ITEMS)}


def write_files(rows: DataFrame, data: str, listing: str, kind: str = "part", number: int = 0, rows_per_file: int = 1_000_000, codec: str = "zstd", missing_last: bool = False) -> DataFrame:
    """Write fanned-out rows below the folder `data`, and the manifest rows of the new files to the folder `listing`; these rows.

    Files are named kind_number_…, so files of a later number come later by name.
    """
    names = [*STORED.fieldNames(), *[b for b in BOUNDS if b in rows.columns], "year"]
    head = data if "://" in data or data.startswith("file:") else "file:" + data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = arrow_store(data)
        task = TaskContext.get().partitionId()
        writer = bucket = name = None
        low = high = None
        count = 0

        def close():
            nonlocal writer
            writer.close()
            writer = None
            made = [f"{head}/{name}", bucket[0], bucket[1], count, store.get_file_info(f"{top}/{name}").size, low, high]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.timestamp("us", "UTC"), pa.timestamp("us", "UTC")]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(made, kinds)], names=[c.split()[0] for c in FILES.split(", ")])

        for batch in batches:
            cells, years = batch.column("grid_partition").to_pylist(), batch.column("year").to_pylist()
            start = 0
            while start < batch.num_rows:
                here = (cells[start], years[start])
                if writer is not None and (here != bucket or count >= rows_per_file):
                    yield close()
                if writer is None:
                    bucket, count, low, high = here, 0, None, None
                    folder = f"grid_partition={here[0]}/year={here[1]}"
                    store.create_dir(f"{top}/{folder}", recursive=True)
                    name = f"{folder}/{kind}_{number:06d}_{task:06d}-{uuid.uuid4().hex[:12]}.parquet"
                    kept = [i for i, n in enumerate(batch.schema.names) if n not in ("grid_partition", "year")]
                    schema = pa.schema([batch.schema.field(i) for i in kept], metadata=FOOTER)
                    writer = pq.ParquetWriter(f"{top}/{name}", schema, filesystem=store, compression=codec)
                end = start
                while end < batch.num_rows and (cells[end], years[end]) == bucket and end - start + count < rows_per_file:
                    end += 1
                part = batch.slice(start, end - start)
                writer.write_batch(pa.RecordBatch.from_arrays([part.column(i) for i in kept], schema=schema))
                times = pc.min_max(part.column("datetime")).as_py()
                low = min((t for t in (low, times["min"]) if t is not None), default=None)
                high = max((t for t in (high, times["max"]) if t is not None), default=None)
                count += end - start
                start = end
        if writer is not None:
            yield close()

    out = ordered(rows, missing_last).select(*[F.col(f"`{n}`") for n in names])
    out.mapInArrow(run, FILES).write.parquet(listing)
    return rows.sparkSession.read.schema(FILES).parquet(listing)


def footer(path: str, key: str = "geo") -> dict | None:
    found = pq.read_schema(path).metadata or {}
    return json.loads(found[key.encode()]) if key.encode() in found else None
