"""Column functions for keys, times and ids."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEM_SUFFIX = ".stac.json"
HASH_SEED = 42
HASH_BYTES = 16


def is_item_key(key: Column) -> Column:
    return F.coalesce(key.endswith(ITEM_SUFFIX), F.lit(False))


def id_of_key(key: Column) -> Column:
    """The last path segment without the item suffix."""
    last = F.element_at(F.split(key, "/"), -1)
    return F.when(last.endswith(ITEM_SUFFIX), F.substring(last, F.lit(1), F.length(last) - len(ITEM_SUFFIX))).otherwise(last)


def bucket_of_href(href: Column) -> Column:
    """`scheme://bucket/key` -> bucket."""
    return F.split_part(F.regexp_replace(href, r"^[a-z0-9]+://", ""), F.lit("/"), F.lit(1))


def key_of_href(href: Column) -> Column:
    """`scheme://bucket/key` -> key."""
    return F.regexp_replace(F.regexp_replace(href, r"^[a-z0-9]+://", ""), "^[^/]*/?", "")


def item_key_of(key: Column) -> Column:
    """Keys of data files lead to their item documents."""
    return F.when(key.endswith(".nc"), F.concat(key, F.lit(ITEM_SUFFIX))).otherwise(key)


def utc_timestamp(text: Column) -> Column:
    """ISO text as a timestamp; a trailing Z or an explicit offset is read as UTC wall time; bad text is null."""
    bare = F.regexp_replace(F.trim(text), r"(?i)(z|[+-]\d{2}:?\d{2})$", "")
    return F.try_to_timestamp(bare)


def year_of(moment: Column) -> Column:
    """The UTC year as text, or a fixed word without one."""
    from ..schema import NO_YEAR

    return F.coalesce(F.year(moment).cast("string"), F.lit(NO_YEAR))


def year_prefix(text: Column) -> Column:
    return F.substring(text, 1, 4).try_cast("int")


def fresh(modified: Column, since: Column | str | None) -> Column:
    """modified >= since; rows without a readable time pass."""
    if since is None:
        return F.lit(True)
    bound = F.lit(since).cast("timestamp") if isinstance(since, str) else since
    return modified.isNull() | (modified >= bound)


def file_class(path: Column) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return F.when(name.startswith("compacted_"), "compacted").when(name.startswith("part_"), "part").otherwise("other")


def decade(n: Column) -> Column:
    """floor(log10(n)) as bigint; null for n <= 0."""
    return F.when(n > 0, F.floor(F.log10(n)).cast("bigint"))


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))


# ---------------------------------------------------------------- id hashes


def hash_id(item_id: str) -> bytes:
    return xxhash.xxh3_128_digest(item_id.encode(), seed=HASH_SEED)


def with_id_hash(df: DataFrame, id_col: str = "id", name: str = "id_hash") -> DataFrame:
    """df with the 16-byte hash of an id column (null for null): Arrow batches, no row-wise Python call boundary."""
    from pyspark.sql import types as T

    at = df.columns.index(id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            made = [None if x is None else digest(x.encode(), seed=HASH_SEED) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType())]))
