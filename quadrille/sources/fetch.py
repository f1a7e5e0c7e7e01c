"""Fetching item documents: a bounded pool in each task, retries, errors as a column."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import arrow_store

FETCHED = "bucket string, key string, body string, error string"
_BUSY = ("SlowDown", "<Error>")


class NotThere(Exception):
    """The object does not exist; asking again does not help."""


def object_reader(root: str) -> Callable[[str, str], bytes]:
    """A reader of root/bucket/key through any file system that Arrow knows."""
    store, top = arrow_store(root)

    def read(bucket: str, key: str) -> bytes:
        try:
            with store.open_input_stream(f"{top}/{bucket}/{key}") as f:
                return f.read()
        except FileNotFoundError as e:
            raise NotThere(str(e)) from e

    return read


def fetch_one(read: Callable[[str, str], bytes], bucket: str, key: str, retries: int = 3, wait: float = 0.5, sleep=time.sleep) -> tuple[str | None, str | None]:
    """(body, error): absent objects and answers that are no document are (None, 'unknown'); a denial is not asked again."""
    error = "unknown"
    for attempt in range(retries + 1):
        try:
            text = read(bucket, key).decode()
            if text.lstrip().startswith("{"):
                return text, None
            if not any(x in text for x in _BUSY):
                return None, "unknown"
            error = "busy"
        except NotThere:
            return None, "unknown"
        except PermissionError as e:
            return None, f"denied: {e}"
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
        if attempt < retries:
            sleep(wait * 2**attempt)
    return None, error


def fetch(keys: DataFrame, make_reader: Callable[[], Callable[[str, str], bytes]], concurrency: int = 64, retries: int = 3, wait: float = 0.5) -> DataFrame:
    """Rows (bucket, key, body, error) for keys (bucket, key), in their order within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = make_reader()
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
                for start in range(0, len(pairs), 1024):  # bodies of 1024 items at a time
                    part = pairs[start : start + 1024]
                    got = list(pool.map(lambda p: fetch_one(read, *p, retries=retries, wait=wait), part))
                    columns = [[p[0] for p in part], [p[1] for p in part], [g[0] for g in got], [g[1] for g in got]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["bucket", "key", "body", "error"])

    return keys.select("bucket", "key").mapInArrow(run, FETCHED)


def failures(fetched: DataFrame) -> DataFrame:
    """Dead letters (bucket, key, error, timestamp)."""
    return fetched.where("error is not null").select("bucket", "key", "error", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"))


def read_documents(spark, paths: str | list[str]) -> DataFrame:
    """Item files read by Spark itself: (path, body)."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def document_ids(fetched: DataFrame) -> DataFrame:
    """(id) as the documents themselves say, of all that could be fetched."""
    return fetched.where("error is null").select(F.get_json_object("body", "$.id").alias("id"))
