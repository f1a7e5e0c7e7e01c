"""Incremental ingest as a stream: new inventory or document files, each micro-batch one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import fanout
from ..operators.dedup import latest
from ..plans.catalog import Catalog


def document_stream(spark, folder: str, files_per_batch: int = 500) -> DataFrame:
    """A stream of (body) of item documents, one a line, from files that arrive in a folder."""
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_batch).text(folder).withColumnRenamed("value", "body")


def start(catalog: Catalog, documents: DataFrame, checkpoint: str, deduplicate: str | None = "updated", available_now: bool = True) -> StreamingQuery:
    """Ingest a stream of (body). A batch that is run again after a failure is found by its number and not committed twice."""

    def commit(batch: DataFrame, number: int) -> None:
        action = f"stream {checkpoint} batch {number}"
        if catalog.committed(action):
            return
        rows = fanout.fan_out(fanout.parse_items(batch.where("trim(body) != ''").select("body")), catalog.grid())
        rows = latest(rows, deduplicate) if deduplicate else rows
        catalog.append(rows, action)

    writer = documents.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
