"""Operator 2: WARC archives compressed record by record with an embedded dictionary.

Writing. A Zstandard dictionary is trained once, from a bounded sample of the
records that are archived (parameters sample_records and sample_bytes). Every
archive begins with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, then has one Zstandard frame for each record, so a record can be
read by itself and an archive without anything beside it. Of records with
equal payloads of at least `least` bytes, the one with the largest page id is
the response and the others are revisits that refer to it and hold no payload.

Payload digests are made and compared in Spark: a partial aggregate by digest
finds the groups (a payload that a third of all pages share is one row for
each task there), and only pages of groups of two or more are joined again.
A task writes its archives under a name of its own and renames each when it is
whole; a task that runs again writes the same names with the same bytes.

Reading. Archives are read as Spark's binary files, and records come back
from the archives alone.

Null html is an empty payload. A null url is kept as an absent target. A null
page id counts as smaller than all others. Rows that repeat page id and
payload are one response and revisits, of which the response is any one of
them. Columns beside page_id, url and html are not archived. A record of any
length is one frame, and an archive that it fills is closed.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Fixed values of the formats: a skippable frame for dictionaries, and line ends.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
CRLF = b"\r\n"
SLICE = 1 << 14
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page_id}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One uncompressed WARC/1.1 record."""
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-Id: {refers_to}")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + CRLF + CRLF + block + CRLF + CRLF


def parse_record(data: bytes) -> dict:
    """Headers (lower-case names) and payload of one uncompressed record."""
    head, _, rest = data.partition(CRLF + CRLF)
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    headers["payload"] = block.partition(CRLF + CRLF)[2]
    return headers


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def read_archive(data: bytes) -> Iterator[bytes]:
    """The uncompressed records of one archive, in order."""
    view, at, known = memoryview(data), 0, None
    if len(data) >= 8:
        magic, size = struct.unpack_from("<II", data)
        if magic == DICTIONARY_MAGIC:
            known, at = zstandard.ZstdCompressionDict(bytes(view[8 : 8 + size])), 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    while at < len(data):
        # In slices, as what lies behind a frame's end is copied each time.
        frame, out = reader.decompressobj(), []
        while not frame.eof and at < len(data):
            part = view[at : at + SLICE]
            out.append(frame.decompress(part))
            at += len(part) - len(frame.unused_data)
        if not frame.eof:
            raise ValueError("the archive ends within a record")
        yield b"".join(out)


def train_dictionary(samples: list[bytes], size: int = 65536) -> bytes:
    """A dictionary for the samples; none if they are too few or too small to train one."""
    if len(samples) < 8 or sum(map(len, samples)) < 8 * 1024:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    """(Arrow file system, path in it) of a folder as Spark names it."""
    name = _arrow_name(folder)
    return pafs.FileSystem.from_uri(name) if "://" in name else (pafs.LocalFileSystem(), name)


def _arrow_name(folder: str) -> str:
    """A folder's name in Arrow: local paths without a scheme; Hadoop's schemes for S3 are `s3`."""
    scheme, mark, rest = folder.partition("://")
    if mark and scheme != "file":
        return f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}"
    return "/" + folder.removeprefix("file:").lstrip("/") if folder.startswith("file:") else folder


def write_archives(pages: DataFrame, folder: str, least: int = 1000, records_per_archive: int = 4096, bytes_per_archive: int = 16 << 20, sample_records: int = 256, sample_bytes: int = 16384, level: int = 3, broadcast_groups: int = 100_000) -> DataFrame:
    """Write all pages; rows (archive, records, bytes), one for each archive.

    The dictionary is trained from the `sample_records` records with the
    smallest page hashes, of each at most its first `sample_bytes` bytes.
    """
    spark = pages.sparkSession
    common.small_batches(spark)
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
    )
    keyed = base.withColumn("__d", F.unhex(F.sha1("payload"))).withColumn("__big", F.octet_length("payload") >= least)
    rows = keyed.where("__big").groupBy("__d", "page_id", F.xxhash64("url").alias("__u")).agg(F.count("*").alias("__c"))
    order = F.struct(F.coalesce(F.col("page_id"), F.lit(-(1 << 63))).alias("k"), "__u", "page_id", "__c")
    groups = common.materialize(
        rows.groupBy("__d").agg(F.sum("__c").alias("__n"), F.max(order).alias("__top")).where("__n > 1").select("__d", F.col("__top.page_id").alias("__to"), F.col("__top.__u").alias("__tu"), F.col("__top.__c").alias("__c")),
        "payload-groups",
    )
    n_groups, repeated = groups.agg(F.count("*"), F.coalesce(F.max("__c"), F.lit(1))).first()
    # Sent to all executors only up to a fixed number of groups; beyond that the join shuffles.
    joined = keyed.join(F.broadcast(groups) if n_groups <= broadcast_groups else groups, "__d", "left")
    grouped = F.col("__big") & F.col("__c").isNotNull()
    joined = joined.select("__d", "page_id", "url", "payload", grouped.alias("grouped"), F.col("__to").alias("refers_to"), (grouped & F.col("page_id").eqNullSafe(F.col("__to")) & (F.xxhash64("url") == F.col("__tu"))).alias("is_top"))
    if repeated > 1:  # the very row that is a response is there several times: the first by place, found without payloads
        joined = common.materialize(joined.withColumn("__row", F.monotonically_increasing_id()), "repeated-pages")
        first = joined.where("is_top").groupBy("__d").agg(F.min("__row").alias("__row")).select("__row", F.lit(True).alias("__first"))
        joined = joined.join(first, "__row", "left").withColumn("is_top", F.col("is_top") & F.col("__first").isNotNull())
    revisit = F.col("grouped") & ~F.col("is_top")
    joined = joined.select("page_id", "url", "payload", F.when(revisit, F.col("refers_to")).alias("refers_to"), revisit.alias("revisit"))

    # Which records are sampled is settled on hashes alone, so tasks send few bytes; then these few records are read.
    chosen = base.select(F.xxhash64("page_id", "url").alias("__h")).distinct().orderBy("__h").limit(sample_records).collect()
    sample = base.where(F.xxhash64("page_id", "url").isin([r[0] for r in chosen])).select(F.substring("payload", 1, sample_bytes).alias("payload"), "page_id", "url").orderBy("page_id", "url").limit(2 * sample_records).collect() if chosen else []
    dictionary = train_dictionary([build_record(r.page_id, r.url, bytes(r.payload), None, False) for r in sample])
    shared = spark.sparkContext.broadcast(dictionary)  # at most 64 KB

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(folder)
        task = TaskContext.get()
        known = shared.value
        packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(known) if known else None)
        number, frames, room = 0, [], 0

        def close():
            nonlocal number, frames, room
            name = f"{top}/part-{task.partitionId():06d}-{number:05d}.warc.zst"
            rough = f"{top}/.{name.rpartition('/')[2]}.{task.taskAttemptId()}"
            with store.open_output_stream(rough) as f:
                f.write((dictionary_frame(known) if known else b"") + b"".join(frames))
            store.move(rough, name)
            done = (name, len(frames), room)
            number, frames, room = number + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in done], names=["archive", "records", "bytes"])

        for batch in batches:
            for page_id, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                frame = packer.compress(build_record(page_id, url, payload, refers_to, revisit))
                frames.append(frame)
                room += len(frame)
                if len(frames) >= records_per_archive or room >= bytes_per_archive:
                    yield close()
        if frames:
            yield close()

    store, top = _store(folder)
    store.create_dir(top, recursive=True)
    return joined.select("page_id", "url", "payload", "refers_to", "revisit").mapInArrow(write, "archive string, records long, bytes long")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of all records."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for content in batch.column(0):
                rows, room = [], 0
                for data in read_archive(content.as_py()):
                    h = parse_record(data)
                    digest = base64.b32decode(h["warc-payload-digest"].partition(":")[2]).hex()
                    if h["warc-type"] == "response" and hashlib.sha1(h["payload"]).hexdigest() != digest:
                        raise ValueError(f"record {h['warc-record-id']} does not match its digest")
                    rows.append((number(h.get("x-page-id")), h.get("warc-target-uri"), h["warc-type"], number(h.get("x-refers-to-page-id")), int(h["x-payload-length"]), digest, h["payload"]))
                    room += len(h["payload"])
                    if room > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                        rows, room = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    return files.mapInArrow(read, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")
