"""Grids: which cells a footprint touches.

A grid gives the cells of an item as an array column, so that assignment is a
projection and fan-out an explode. LatLonGrid is pure column arithmetic;
RegionGrid takes named polygons (a checked, bounded set, sent to the tasks);
H3Grid needs the h3 package and says so when it is absent.
"""

from __future__ import annotations

import json
import math
from abc import ABC, abstractmethod
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as geo

DEFAULT_RESOLUTION = 1


class Grid(ABC):
    """A grid: cells of items as a column, cells of a query geometry on the driver."""

    kind: str
    resolution: int | None = None
    boundaries_path: str | None = None
    id_field: str | None = None

    @abstractmethod
    def cells(self, df: DataFrame) -> Column:
        """array<string> of the cells that a row (xmin, ymin, xmax, ymax, geometry) touches, without repeats."""

    @abstractmethod
    def cover(self, geometry: dict) -> list[str]:
        """The cells that a query geometry may touch, sorted."""

    @abstractmethod
    def outline(self, cell: str) -> str:
        """A cell's boundary as WKT."""

    def properties(self) -> dict[str, str]:
        found = {"grid.type": self.kind, "grid.resolution": self.resolution, "grid.boundaries_path": self.boundaries_path, "grid.id_field": self.id_field}
        return {k: str(v) for k, v in found.items() if v is not None}


class LatLonGrid(Grid):
    """Square cells of 10 / resolution degrees, named by their south-west corner's indices (`x17y4`).

    A box whose xmin exceeds its xmax crosses the antimeridian and is split there.
    Latitudes beyond the poles are cut; contact with a cell's edge counts.
    """

    kind = "latlon"

    def __init__(self, resolution: int = DEFAULT_RESOLUTION):
        if resolution < 1:
            raise ValueError("resolution must be at least 1")
        self.resolution = resolution
        self.size = 10.0 / resolution
        self.columns, self.rows = 36 * resolution, 18 * resolution

    def _span(self, low: Column, high: Column, origin: float, n: int) -> Column:
        # An edge on a cell border touches the cell below it as well.
        first = F.ceil((low - origin) / self.size) - 1
        last = F.floor((high - origin) / self.size)
        clamp = lambda c: F.greatest(F.lit(0), F.least(F.lit(n - 1), c.cast("int")))
        return F.sequence(clamp(first), clamp(last))

    def cells(self, df: DataFrame) -> Column:
        x0, y0, x1, y1 = (F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
        across = F.concat(self._span(x0, F.lit(180.0), -180.0, self.columns), self._span(F.lit(-180.0), x1, -180.0, self.columns))
        xs = F.when(x0 > x1, across).otherwise(self._span(x0, x1, -180.0, self.columns))
        ys = self._span(y0, y1, -90.0, self.rows)
        name = lambda x, y: F.concat(F.lit("x"), x.cast("string"), F.lit("y"), y.cast("string"))
        return F.array_distinct(F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: name(x, y)))))

    def _range(self, low: float, high: float, origin: float, n: int) -> range:
        clamp = lambda v: max(0, min(n - 1, v))
        return range(clamp(math.ceil((low - origin) / self.size) - 1), clamp(math.floor((high - origin) / self.size)) + 1)

    def cover(self, geometry: dict) -> list[str]:
        found = set()
        for part in geo.simple_parts(geometry):
            x0, y0, x1, y1 = geo.bounds(part)
            for x in self._range(x0, x1, -180.0, self.columns):
                for y in self._range(y0, y1, -90.0, self.rows):
                    if geo.intersects(part, self._box(x, y)):
                        found.add(f"x{x}y{y}")
        return sorted(found)

    def _box(self, x: int, y: int) -> dict:
        west, south = -180 + x * self.size, -90 + y * self.size
        return geo.box(west, south, west + self.size, south + self.size)

    def outline(self, cell: str) -> str:
        x, _, y = cell[1:].partition("y")
        return geo.to_wkt(self._box(int(x), int(y)))


class RegionGrid(Grid):
    """Cells are named regions of a GeoJSON FeatureCollection; most_bytes bounds what the tasks are sent."""

    kind = "geojson"

    def __init__(self, regions: dict[str, dict], boundaries_path: str | None = None, id_field: str = "id", most_bytes: int = 64 << 20):
        self.regions = regions
        self.boundaries_path, self.id_field = boundaries_path, id_field
        self.check_size(sum(len(json.dumps(g)) for g in regions.values()), most_bytes)
        self.boxes = {k: geo.bounds(g) for k, g in regions.items()}

    @classmethod
    def load(cls, spark: SparkSession, path: str, id_field: str = "id") -> RegionGrid:
        rows = read_regions(spark, path, id_field)
        size = rows.agg(F.coalesce(F.sum(F.length("geometry")), F.lit(0))).first()[0]
        cls.check_size(size)
        return cls({r.key: geo.from_geojson(r.geometry) for r in rows.collect()}, path, id_field)

    @staticmethod
    def check_size(size: int, most: int = 64 << 20) -> None:
        if size > most:
            raise ValueError(f"regions take {size} bytes, over {most}; join them with operators.joins.region_join")

    def cells(self, df: DataFrame) -> Column:
        shared = df.sparkSession.sparkContext.broadcast((self.regions, self.boxes))

        @F.pandas_udf("array<string>")
        def touching(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            regions, boxes = shared.value
            names = sorted(boxes)
            bounds = np.array([boxes[k] for k in names], float).reshape(-1, 4)
            plain = np.array([geo.is_box(regions[k]) for k in names], bool)
            for wkb in parts:
                boxed = geo.boxes_of(wkb)
                out = []
                for data, simple in zip(wkb, boxed):
                    try:
                        g = None if data is None else geo.from_wkb(bytes(data))
                    except geo.BadGeometry:
                        g = None
                    if g is None:
                        out.append(None)
                        continue
                    x0, y0, x1, y1 = geo.bounds(g)
                    near = np.flatnonzero((bounds[:, 0] <= x1) & (bounds[:, 2] >= x0) & (bounds[:, 1] <= y1) & (bounds[:, 3] >= y0))
                    out.append([names[k] for k in near if simple and plain[k] or geo.intersects(g, regions[names[k]])])
                yield pd.Series(out)

        return touching(F.col("geometry"))

    def cover(self, geometry: dict) -> list[str]:
        return sorted(k for k, g in self.regions.items() if geo.intersects(geometry, g))

    def outline(self, cell: str) -> str:
        return geo.to_wkt(self.regions[cell])


class H3Grid(Grid):
    """Hexagonal cells through the h3 package: centres inside, and all cells that the outline passes."""

    kind = "h3"

    def __init__(self, resolution: int = DEFAULT_RESOLUTION, step: float = 0.1):
        try:
            import h3  # noqa: F401
        except ImportError as e:
            raise ImportError("H3Grid needs the h3 package; LatLonGrid works without it") from e
        self.resolution, self.step = resolution, step

    def cover(self, geometry: dict) -> list[str]:
        import h3

        found: set[str] = set()
        for part in geo.simple_parts(geometry):
            c = part["coordinates"]
            if part["type"] == "Point":
                found.add(h3.latlng_to_cell(c[1], c[0], self.resolution))
            elif part["type"] == "Polygon":
                found.update(h3.geo_to_cells(part, self.resolution))
                for (x1, y1), (x2, y2) in zip(c[0], c[0][1:]):
                    n = max(2, math.ceil(math.hypot(x2 - x1, y2 - y1) / self.step))
                    found.update(h3.latlng_to_cell(y1 + (y2 - y1) * i / n, x1 + (x2 - x1) * i / n, self.resolution) for i in range(n + 1))
        return sorted(found)

    def cells(self, df: DataFrame) -> Column:
        grid = self

        @F.pandas_udf("array<string>")
        def touching(wkb: pd.Series) -> pd.Series:
            return wkb.map(lambda d: None if d is None else grid.cover(geo.from_wkb(bytes(d))))

        return touching(F.col("geometry"))

    def outline(self, cell: str) -> str:
        import h3

        ring = [[lng, lat] for lat, lng in h3.cell_to_boundary(cell)]
        return geo.to_wkt({"type": "Polygon", "coordinates": [[*ring, ring[0]]]})


def read_regions(spark: SparkSession, path: str, id_field: str = "id") -> DataFrame:
    """Rows (key, geometry as GeoJSON text) of a FeatureCollection."""
    text = spark.read.text(path, wholetext=True)
    features = F.from_json(F.get_json_object("value", "$.features"), "array<string>")
    rows = text.select(F.explode(features).alias("f"))
    return rows.select(F.get_json_object("f", f"$.properties['{id_field}']").alias("key"), F.get_json_object("f", "$.geometry").alias("geometry")).where("key is not null and geometry is not null")


def make_grid(spark: SparkSession | None, kind: str = "latlon", resolution: int | None = None, boundaries_path: str | None = None, id_field: str = "id") -> Grid:
    if kind == "latlon":
        return LatLonGrid(resolution or DEFAULT_RESOLUTION)
    if kind == "geojson":
        if not boundaries_path:
            raise ValueError("a geojson grid needs boundaries_path")
        return RegionGrid.load(spark, boundaries_path, id_field or "id")
    if kind == "h3":
        return H3Grid(resolution or DEFAULT_RESOLUTION)
    if kind == "s2":
        raise NotImplementedError("s2 grids are not available")
    raise ValueError(f"unknown grid type: {kind}")


def cell_list_sql(cells: list[str]) -> str:
    """A fragment for `IN (...)`; without cells one that matches nothing."""
    quoted = ", ".join("'" + c.replace("'", "''") + "'" for c in cells)
    return f"({quoted or 'NULL'})"
