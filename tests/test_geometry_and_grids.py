import json
import random

import pytest
from pyspark.sql import functions as F

from quadrille.functions import geometry as geo
from quadrille.operators import fanout, joins
from quadrille.operators.grids import H3Grid, LatLonGrid, RegionGrid, cell_list_sql, make_grid, read_regions

SHAPES = [
    {"type": "Point", "coordinates": [1.5, -2]},
    {"type": "LineString", "coordinates": [[0, 0], [5, 5], [7, -1.25]]},
    {"type": "Polygon", "coordinates": [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]], [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]]},
    {"type": "MultiPoint", "coordinates": [[0, 0], [3, 4]]},
    {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]},
    {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}, {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}]},
]


@pytest.mark.parametrize("shape", SHAPES, ids=lambda s: s["type"])
def test_round_trips(shape):
    same = lambda a, b: json.loads(json.dumps(a), parse_int=float) == json.loads(json.dumps(b), parse_int=float)
    assert same(geo.from_wkb(geo.to_wkb(shape)), shape)
    assert same(geo.from_wkt(geo.to_wkt(shape)), shape)
    assert same(geo.as_geometry(json.dumps(shape)), shape)


@pytest.mark.parametrize("bad", ['{"type": "Polygon", "coordinates": []}', "{}", "null", "[]", "x", '{"type": "Point", "coordinates": []}', '{"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [0, 0]]]}'])
def test_bad_geometry(bad):
    with pytest.raises((ValueError, TypeError)):
        geo.from_geojson(bad)


def test_wkb_with_more_dimensions():
    import struct

    z = struct.pack("<BIddd", 1, 1001, 1.0, 2.0, 9.0)
    flagged = struct.pack("<BIIdddd", 1, 0x80000000 | 0x40000000 | 0x20000000 | 1, 4326, 1.0, 2.0, 9.0, 8.0)
    ring = struct.pack("<BIII", 1, 1003, 1, 4) + b"".join(struct.pack("<ddd", *p, 5.0) for p in ((0, 0), (1, 0), (1, 1), (0, 0)))
    assert geo.from_wkb(z) == geo.from_wkb(flagged) == {"type": "Point", "coordinates": [1.0, 2.0]}
    assert geo.from_wkb(ring)["coordinates"] == [[[0, 0], [1, 0], [1, 1], [0, 0]]]
    for bad in (b"", b"\x01", b"\x01\x63\x00\x00\x00", struct.pack("<BII", 1, 2, 1000)):
        with pytest.raises(geo.BadGeometry):
            geo.from_wkb(bad)
        assert not geo.wkb_intersects(bad, SHAPES[2])


def test_boxes_in_batches():
    rnd = random.Random(3)
    corners = [(x, y, x + rnd.random(), y + rnd.random()) for x, y in ((rnd.uniform(-9, 9), rnd.uniform(-9, 9)) for _ in range(50))]
    assert geo.boxes_to_wkb(*map(list, zip(*corners))) == [geo.to_wkb(geo.box(*c)) for c in corners]
    other = {"type": "Polygon", "coordinates": [[[0, 0], [1, 1], [1, 2], [0, 1], [0, 0]]]}
    mixed = [geo.to_wkb(geo.box(0, 0, 1, 1)), None, b"bad", geo.to_wkb(other), *map(geo.to_wkb, SHAPES)]
    assert geo.boxes_of(mixed).tolist() == [True] + [False] * (len(mixed) - 1)
    assert geo.is_box(geo.box(0, 0, 2, 1)) and not geo.is_box(other)


def test_footprints_of_any_shape(spark):
    shapes = [("box", geo.to_wkb(geo.box(0, 0, 1, 1))), ("slant", geo.to_wkb({"type": "Polygon", "coordinates": [[[0, 0], [10, 10], [10, 11], [0, 1], [0, 0]]]})), ("bad", b"zz"), ("none", None)]
    rows = spark.createDataFrame([(k, w, 0.0, 0.0, 10.0, 11.0) for k, w in shapes], "id string, geometry binary, xmin double, ymin double, xmax double, ymax double")
    meets = lambda g: {r.id for r in fanout.footprint_filter(rows, g).collect()}
    assert meets(geo.box(0.5, 0.5, 0.6, 0.6)) == {"box", "slant"}
    assert meets({"type": "Point", "coordinates": [9, 0.5]}) == set()


def test_intersects():
    outer = SHAPES[2]
    assert geo.intersects(outer, {"type": "Point", "coordinates": [1, 1]})
    assert not geo.intersects(outer, {"type": "Point", "coordinates": [5, 5]})  # in the hole
    assert geo.intersects(outer, {"type": "Point", "coordinates": [4, 5]})  # on the hole's edge
    assert geo.intersects(outer, geo.box(10, 10, 12, 12))  # corners touch
    assert not geo.intersects(outer, geo.box(10.01, 0, 12, 12))
    assert geo.intersects(geo.box(-5, 4.5, 20, 5.5), outer)  # crosses without a corner inside
    assert geo.intersects(outer, geo.box(-90, -90, 90, 90)) and geo.intersects(geo.box(-90, -90, 90, 90), outer)
    assert not geo.intersects(outer, geo.box(4.5, 4.5, 5.5, 5.5))  # wholly in the hole
    assert geo.intersects({"type": "LineString", "coordinates": [[-1, -1], [11, 11]]}, outer)


def test_boxes_agree_with_arithmetic():
    rnd = random.Random(0)
    for _ in range(300):
        a, b = [[rnd.randint(0, 8) for _ in range(4)] for _ in range(2)]
        (ax, bx), (ay, by) = sorted((a[0], a[1] + 9)), sorted((a[2], a[3] + 9))
        (cx, dx), (cy, dy) = sorted((b[0] + 7, b[1] + 9)), sorted((b[2] + 7, b[3] + 9))
        if ax < bx and ay < by and cx < dx and cy < dy:
            assert geo.intersects(geo.box(ax, ay, bx, by), geo.box(cx, cy, dx, dy)) == (ax <= dx and cx <= bx and ay <= dy and cy <= by)


def boxes(spark, rows):
    return spark.createDataFrame(rows, "id string, xmin double, ymin double, xmax double, ymax double").withColumn("datetime", F.lit("2021-06-15").cast("timestamp"))


def test_latlon_cells(spark):
    grid = LatLonGrid(1)
    rows = boxes(spark, [("point", 5.0, 5.0, 5.0, 5.0), ("edge", 10.0, 5.0, 10.0, 5.0), ("wide", -10.0, 60.0, 10.0, 70.0), ("dateline", 175.0, 0.5, -175.0, 0.6), ("pole", 0.5, 85.0, 0.6, 95.0), ("corner", -180.0, -90.0, -180.0, -90.0)])
    got = {r.id: set(r.c) for r in rows.select("id", grid.cells(rows).alias("c")).collect()}
    assert got["point"] == {"x18y9"}
    assert got["edge"] == {"x18y9", "x19y9"}
    assert got["wide"] == {f"x{x}y{y}" for x in (16, 17, 18, 19) for y in (14, 15, 16)}
    assert got["dateline"] == {"x35y9", "x0y9"} and got["pole"] == {"x18y17"} and got["corner"] == {"x0y0"}
    assert set(grid.cover(geo.box(-10, 60, 10, 70))) == got["wide"]
    assert all(len(r.c) == len(set(r.c)) for r in rows.select(grid.cells(rows).alias("c")).collect())
    fine = LatLonGrid(4)
    assert rows.select(F.size(fine.cells(rows)).alias("n")).agg(F.sum("n")).first()[0] > sum(map(len, got.values()))
    assert geo.bounds(geo.from_wkt(grid.outline("x18y9"))) == (0, 0, 10, 10)


def test_fan_out(spark):
    rows = boxes(spark, [("a", 1.0, 1.0, 12.0, 2.0), ("b", 1.0, 1.0, 2.0, 2.0)]).withColumn("geometry", F.lit(b"x"))
    rows = rows.unionByName(boxes(spark, [("bad", None, None, None, None)]).withColumn("geometry", F.lit(None).cast("binary")))
    got = fanout.fan_out(rows, LatLonGrid(1))
    assert sorted((r.id, r.grid_partition, r.year) for r in got.collect()) == [("a", "x18y9", "2021"), ("a", "x19y9", "2021"), ("b", "x18y9", "2021")]
    assert {(r.fan_out, r["items"]) for r in fanout.histogram(got).collect()} == {(2, 1), (1, 1)}
    assert fanout.rejected(rows).count() == 1


@pytest.fixture
def regions_file(tmp_path):
    features = [{"type": "Feature", "properties": {"id": k, "name": k.upper()}, "geometry": geo.box(*b)} for k, b in (("west", (-10, 0, 0, 10)), ("east", (0, 0, 10, 10)), ("north", (-10, 10, 10, 20)))]
    path = tmp_path / "regions.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    return str(path)


def test_region_grid_and_join(spark, regions_file):
    grid = make_grid(spark, "geojson", boundaries_path=regions_file)
    assert isinstance(grid, RegionGrid) and set(grid.regions) == {"west", "east", "north"}
    items = [("in", geo.box(1, 1, 2, 2)), ("both", geo.box(-1, 1, 1, 2)), ("touch", geo.box(5, 10, 6, 10.5)), ("none", geo.box(50, 50, 51, 51))]
    rows = spark.createDataFrame([(k, geo.to_wkb(g), *geo.bounds(g)) for k, g in items], "id string, geometry binary, xmin double, ymin double, xmax double, ymax double")
    want = {("in", "east"), ("both", "east"), ("both", "west"), ("touch", "east"), ("touch", "north")}
    fanned = fanout.fan_out(rows.withColumn("datetime", F.lit(None).cast("timestamp")), grid).collect()
    assert {(r.id, r.grid_partition) for r in fanned} == want | {("none", "__none__")} and {r.year for r in fanned} == {"unknown"}
    joined = [(r.id, r.key) for r in joins.region_join(rows, read_regions(spark, regions_file)).collect()]
    assert sorted(joined) == sorted(want)
    assert grid.cover(geo.box(1, 1, 2, 2)) == ["east"] and make_grid(spark, "geojson", boundaries_path=regions_file, id_field="name").cover(geo.box(1, 1, 2, 2)) == ["EAST"]


def test_grid_factory(spark):
    with pytest.raises(ValueError):
        make_grid(spark, "geojson")
    with pytest.raises(NotImplementedError):
        make_grid(spark, "s2")
    with pytest.raises(ValueError):
        make_grid(spark, "other")
    try:
        import h3  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError):
            H3Grid()
    assert make_grid(spark).properties() == {"grid.type": "latlon", "grid.resolution": "1"}
    assert cell_list_sql(["a", "b'c"]) == "('a', 'b''c')" and cell_list_sql([]) == "(NULL)"
