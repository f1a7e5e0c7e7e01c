"""Joins of the catalogue: set membership, precedence, differences, regions."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo


def missing_from(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of left whose key right does not have; null keys stay."""
    return left.join(right.select(key).distinct(), key, "left_anti")


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """SQL's NOT IN: a null in right leaves nothing, and a null key in left is dropped unless right is empty."""
    spark = left.sparkSession
    return spark.sql(f"select * from {{l}} where `{key}` not in (select `{key}` from {{r}})", l=left, r=right)


def within(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key).distinct(), key, "left_semi")


def membership(sources: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """All keys of all sources with one flag for each source, in one aggregate instead of a join for each."""
    marked = [df.select(key).distinct().withColumns({n: F.lit(n == name) for n in sources}) for name, df in sources.items()]
    return reduce(DataFrame.union, marked).groupBy(key).agg(*[F.bool_or(n).alias(n) for n in sources])


def regions_of_venn(flags: DataFrame, names: list[str]) -> DataFrame:
    return flags.groupBy(*names).agg(F.count("*").alias("ids"))


def compare(left: DataFrame, right: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Full outer comparison: (key, status) with status same, changed, added or removed."""
    a = left.select(key, *[F.col(v).alias(f"{v}__a") for v in values], F.lit(True).alias("__a"))
    b = right.select(key, *[F.col(v).alias(f"{v}__b") for v in values], F.lit(True).alias("__b"))
    same = reduce(Column.__and__, [F.col(f"{v}__a").eqNullSafe(F.col(f"{v}__b")) for v in values], F.lit(True))
    status = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(same, "same").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, status.alias("status"), *[f"{v}__a" for v in values], *[f"{v}__b" for v in values])


def unmatched(registered: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has: (key, status missing or unregistered)."""
    lost = missing_from(registered.select(key), stored, key).withColumn("status", F.lit("missing"))
    extra = missing_from(stored.select(key), registered, key).withColumn("status", F.lit("unregistered"))
    return lost.union(extra)


def region_join(items: DataFrame, regions: DataFrame, cell_degrees: float = 10.0) -> DataFrame:
    """Pairs (items, key) of items whose footprint meets a region (key, geometry GeoJSON).

    Both sides are dealt to coarse lat/lon cells and joined on them, so neither
    has to be small; the bounds and the exact test follow.
    """
    shape = F.pandas_udf(_region_shapes, "struct<wkb:binary,xmin:double,ymin:double,xmax:double,ymax:double>")
    shaped = regions.withColumn("__r", shape("geometry")).select("key", *[F.col(f"__r.{c}").alias(f"r_{c}") for c in ("wkb", "xmin", "ymin", "xmax", "ymax")]).where("r_wkb is not null")

    def tiles(x0: str, y0: str, x1: str, y1: str) -> Column:
        span = lambda a, b: F.sequence(F.floor(F.col(a) / cell_degrees).cast("int"), F.floor(F.col(b) / cell_degrees).cast("int"))
        return F.explode(F.flatten(F.transform(span(x0, x1), lambda x: F.transform(span(y0, y1), lambda y: F.struct(x.alias("x"), y.alias("y"))))))

    a = items.withColumn("__t", tiles("xmin", "ymin", "xmax", "ymax"))
    b = shaped.withColumn("__t", tiles("r_xmin", "r_ymin", "r_xmax", "r_ymax"))
    near = a.join(b, "__t").where("xmin <= r_xmax and xmax >= r_xmin and ymin <= r_ymax and ymax >= r_ymin")
    # A pair that shares several tiles is kept in the tile of the overlap's lower left corner.
    corner = F.struct(F.floor(F.greatest("xmin", "r_xmin") / cell_degrees).cast("int").alias("x"), F.floor(F.greatest("ymin", "r_ymin") / cell_degrees).cast("int").alias("y"))
    near = near.where(F.col("__t") == corner)

    @F.pandas_udf("boolean")
    def meets(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        regions: dict[bytes, dict] = {}  # the regions of a task, each read once
        for a, b in parts:
            settled = geo.boxes_of(a) & geo.boxes_of(b)  # bounds have met already
            out = settled.tolist()
            for k in np.flatnonzero(~settled).tolist():
                key = bytes(b.iloc[k])
                if key not in regions:
                    if len(regions) >= 1000:
                        regions.clear()
                    regions[key] = geo.from_wkb(key)
                out[k] = geo.wkb_intersects(a.iloc[k], regions[key])
            yield pd.Series(out, dtype=bool)

    return near.where(meets("geometry", "r_wkb")).drop("__t", "r_wkb", "r_xmin", "r_ymin", "r_xmax", "r_ymax")


def _region_shapes(value: pd.Series) -> pd.DataFrame:
    rows = []
    for text in value:
        try:
            g = geo.from_geojson(text)
            rows.append((geo.to_wkb(g), *geo.bounds(g)))
        except (ValueError, TypeError, KeyError, IndexError):
            rows.append((None, None, None, None, None))
    return pd.DataFrame(rows, columns=["wkb", "xmin", "ymin", "xmax", "ymax"])
