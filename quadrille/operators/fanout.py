"""Items to rows: parse item documents, assign cells, fan out."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import geometry as geo
from ..schema import BOUNDS, FIELDS, NO_CELL, PROPERTY_FIELDS
from .grids import Grid

_SHAPE = "struct<wkb:binary,xmin:double,ymin:double,xmax:double,ymax:double>"


def _shapes(value: pd.Series) -> pd.DataFrame:
    rows = []
    for text in value:
        try:
            g = geo.from_geojson(text)
            rows.append((geo.to_wkb(g), *geo.bounds(g)))
        except (ValueError, TypeError, KeyError, IndexError):
            rows.append((None, None, None, None, None))
    return pd.DataFrame(rows, columns=["wkb", *BOUNDS])


def parse_items(documents: DataFrame, body: str = "body") -> DataFrame:
    """Stored columns and bounds of item documents (JSON text); unreadable geometry leaves geometry null.

    The JSON functions read each field where it is; properties become typed
    columns, and assets, links and extensions stay JSON text. Numbers that are
    not whole are rounded down to the stored whole type only by an explicit
    cast, as every file has the same types.
    """
    shape = F.pandas_udf(_shapes, _SHAPE)
    top = documents.select(
        *[c for c in documents.columns if c != body],
        F.get_json_object(body, "$.id").alias("id"),
        F.get_json_object(body, "$.geometry").alias("__geometry"),
        F.from_json(F.get_json_object(body, "$.properties"), "map<string,string>").alias("__p"),
        *[F.get_json_object(body, f"$.{c}").alias(c) for c in ("assets", "links", "stac_version", "type", "stac_extensions", "collection")],
        F.get_json_object(body, "$.bbox").alias("__bbox"),
    ).withColumn("__s", shape("__geometry"))

    def promoted(name: str, kind) -> Column:
        value = F.try_element_at(F.col("__p"), F.lit(name))
        if kind.simpleString() == "timestamp":
            return C.utc_timestamp(value)
        if kind.simpleString() == "bigint":
            return value.try_cast("double").cast("bigint")
        return value if kind.simpleString() == "string" else value.try_cast(kind.simpleString())

    own_box = F.to_json(F.array(*[F.col(f"__s.{b}") for b in BOUNDS]))
    made = {n: promoted(n, t) for n, t in PROPERTY_FIELDS}
    made |= {"geometry": F.col("__s.wkb"), "grid_partition": F.try_element_at(F.col("__p"), F.lit("grid_partition")), "bbox": F.coalesce(F.col("__bbox"), F.when(F.col("__s.wkb").isNotNull(), own_box))}
    carried = [c for c in documents.columns if c != body and c not in {n for n, _ in FIELDS}]
    return top.select(*carried, *[made.get(n, F.col(f"`{n}`")).alias(n) for n, _ in FIELDS], *[F.col(f"__s.{b}").alias(b) for b in BOUNDS])


def fan_out(items: DataFrame, grid: Grid) -> DataFrame:
    """One row for each item and cell, with grid_partition and year set.

    Items without a readable geometry give no row; items that touch no cell get
    one row in a cell of that name.
    """
    solid = items.where(F.col("geometry").isNotNull()) if "geometry" in items.columns else items
    cells = F.coalesce(grid.cells(solid), F.array().cast("array<string>"))
    named = F.when(F.size("__cells") == 0, F.array(F.lit(NO_CELL))).otherwise(F.col("__cells"))
    rest = [c for c in items.columns if c not in ("grid_partition", "year")]
    return solid.withColumn("__cells", cells).select(*[F.col(f"`{c}`") for c in rest], F.explode(named).alias("grid_partition"), C.year_of(F.col("datetime")).alias("year"))


def rejected(items: DataFrame) -> DataFrame:
    """Items that fan_out leaves out."""
    return items.where(F.col("geometry").isNull())


def histogram(rows: DataFrame) -> DataFrame:
    """How many items have how many cells: (fan_out, items)."""
    per_item = rows.groupBy("id").agg(F.countDistinct("grid_partition").alias("fan_out"))
    return per_item.groupBy("fan_out").agg(F.count("*").alias("items"))


def ordered(rows: DataFrame, missing_last: bool = False) -> DataFrame:
    """Rows dealt to (cell, year) and sorted there by platform and time, those without first (or last).

    The deal is a rebalance: Spark splits a bucket that is much larger than the
    others over several tasks, and gives small buckets to one task.
    """
    keys = [F.col("grid_partition"), F.col("year")]
    within = [F.col("platform").asc_nulls_last(), F.col("datetime").asc_nulls_last()] if missing_last else [F.coalesce("platform", F.lit("")), F.col("datetime").asc_nulls_first()]
    return rows.hint("rebalance", *keys).sortWithinPartitions(*keys, *within)


def footprint_filter(rows: DataFrame, geometry: dict) -> DataFrame:
    """Rows whose footprint meets a geometry: bounds first (pushed to the scan), then the exact test."""
    x0, y0, x1, y1 = geo.bounds(geometry)
    near = rows.where((F.col("xmin") <= x1) & (F.col("xmax") >= x0) & (F.col("ymin") <= y1) & (F.col("ymax") >= y0))
    text = json.dumps(geometry)

    @F.pandas_udf("boolean")
    def meets(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        target = json.loads(text)
        boxed = geo.is_box(target)
        for wkb in parts:
            # Two rectangles whose bounds meet do meet; other shapes are tested one by one.
            settled = geo.boxes_of(wkb) if boxed else np.zeros(len(wkb), bool)
            yield pd.Series([s or geo.wkb_intersects(d, target) for s, d in zip(settled, wkb)], dtype=bool)

    return near.where(meets("geometry"))
