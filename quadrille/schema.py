"""The stored schema: one fixed, nullable column set for every catalogue file."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _TS, _B = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType(), T.BinaryType()

# Column names and their order in stored files.
FIELDS: list[tuple[str, T.DataType]] = [
    ("id", _S),
    ("grid_partition", _S),
    ("geometry", _B),
    ("datetime", _TS),
    ("platform", _S),
    ("percent_valid_pixels", _L),
    ("date_dt", _L),
    ("proj:code", _S),
    ("assets", _S),
    ("links", _S),
    ("stac_version", _S),
    ("type", _S),
    ("start_datetime", _TS),
    ("version", _S),
    ("sat:orbit_state", _S),
    ("scene_1_id", _S),
    ("scene_2_id", _S),
    ("scene_1_frame", _S),
    ("scene_2_frame", _S),
    ("mid_datetime", _S),
    ("created", _TS),
    ("updated", _TS),
    ("end_datetime", _TS),
    ("stac_extensions", _S),
    ("collection", _S),
    ("latitude", _D),
    ("longitude", _D),
    ("bbox", _S),
]

STORED = T.StructType([T.StructField(n, t, True) for n, t in FIELDS])

#: Columns beside the stored ones that let Parquet statistics prune by space.
BOUNDS = ["xmin", "ymin", "xmax", "ymax"]

TOP_LEVEL = {"id", "geometry", "assets", "links", "stac_version", "type", "stac_extensions", "collection", "bbox", "grid_partition"}
PROPERTY_FIELDS = [(n, t) for n, t in FIELDS if n not in TOP_LEVEL]

NO_CELL = "__none__"
NO_YEAR = "unknown"
