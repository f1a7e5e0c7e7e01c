"""Planar geometry without a geometry library: GeoJSON, WKT and WKB, bounds, and an exact intersects.

A geometry is (kind, parts): points are [[x, y], ...]; a line is a list of
points; a polygon is a list of closed rings, the first its outer one. Boundary
contact counts as intersecting.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import numpy as np

# WKB type codes.
WKB_CODES = {"Point": 1, "LineString": 2, "Polygon": 3, "MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6, "GeometryCollection": 7}
HAS_Z, HAS_M, HAS_SRID = 0x80000000, 0x40000000, 0x20000000
_NAMES = {v: k for k, v in WKB_CODES.items()}


class BadGeometry(ValueError):
    pass


def from_geojson(value: str | dict) -> dict:
    geometry = json.loads(value) if isinstance(value, str) else value
    if not isinstance(geometry, dict) or geometry.get("type") not in WKB_CODES:
        raise BadGeometry(f"not a geometry: {str(value)[:80]}")
    points = 0
    for part in simple_parts(geometry):
        arrays = [part["coordinates"]] if part["type"] == "Point" else part["coordinates"] if part["type"] == "Polygon" else [part["coordinates"]]
        for a in arrays:
            array = np.asarray(a, float)
            if array.size == 0 or array.shape[-1] < 2 or not np.isfinite(array).all():
                raise BadGeometry("empty or broken coordinates")
            if part["type"] == "Polygon" and len(array) < 4:
                raise BadGeometry("a ring needs four points")
            points += 1
        if part["type"] == "Polygon" and not arrays:
            raise BadGeometry("a polygon without rings")
    if not points:
        raise BadGeometry("no coordinates")
    return geometry


def simple_parts(geometry: dict) -> Iterator[dict]:
    kind = geometry["type"]
    if kind == "GeometryCollection":
        for g in geometry.get("geometries", []):
            yield from simple_parts(g)
    elif kind.startswith("Multi"):
        for c in geometry["coordinates"]:
            yield {"type": kind[5:], "coordinates": c}
    else:
        yield geometry


def bounds(geometry: dict) -> tuple[float, float, float, float]:
    points = []
    for part in simple_parts(geometry):
        c = part["coordinates"]
        points += [c] if part["type"] == "Point" else c[0] if part["type"] == "Polygon" else c
    array = np.asarray([p[:2] for p in points], float)
    return (*array.min(axis=0).tolist(), *array.max(axis=0).tolist())


# ---------------------------------------------------------------- WKB and WKT


def to_wkb(geometry: dict) -> bytes:
    """Little-endian, two dimensions."""
    kind = geometry["type"]
    head = struct.pack("<BI", 1, WKB_CODES[kind])

    def run(points) -> bytes:
        return struct.pack("<I", len(points)) + b"".join(struct.pack("<dd", p[0], p[1]) for p in points)

    if kind == "Point":
        return head + struct.pack("<dd", *geometry["coordinates"][:2])
    if kind == "LineString":
        return head + run(geometry["coordinates"])
    if kind == "Polygon":
        return head + struct.pack("<I", len(geometry["coordinates"])) + b"".join(run(r) for r in geometry["coordinates"])
    parts = geometry["geometries"] if kind == "GeometryCollection" else [{"type": kind[5:], "coordinates": c} for c in geometry["coordinates"]]
    return head + struct.pack("<I", len(parts)) + b"".join(map(to_wkb, parts))


def from_wkb(data: bytes) -> dict:
    """The geometry in two dimensions; heights, measures (ISO codes or flags) and a reference system's number are skipped."""
    try:
        return _read_wkb(data)
    except (struct.error, KeyError, IndexError) as e:
        raise BadGeometry(f"not WKB: {data[:16].hex()}") from e


def _read_wkb(data: bytes) -> dict:
    def read(at: int) -> tuple[dict, int]:
        order = "<" if data[at] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", data, at + 1)
        at += 9 if code & HAS_SRID else 5
        plain = code & 0x0FFFFFFF
        kind = _NAMES[plain % 1000]
        size = 2 + {0: 0, 1: 1, 2: 1, 3: 2}[plain // 1000] + bool(code & HAS_Z) + bool(code & HAS_M)

        def count(at: int) -> tuple[int, int]:
            return struct.unpack_from(order + "I", data, at)[0], at + 4

        def run(at: int) -> tuple[list, int]:
            n, at = count(at)
            flat = struct.unpack_from(f"{order}{size * n}d", data, at)
            return [list(p) for p in zip(flat[::size], flat[1::size])], at + 8 * size * n

        if kind == "Point":
            return {"type": kind, "coordinates": list(struct.unpack_from(order + "dd", data, at))}, at + 8 * size
        if kind == "LineString":
            points, at = run(at)
            return {"type": kind, "coordinates": points}, at
        n, at = count(at)
        items = []
        for _ in range(n):
            item, at = run(at) if kind == "Polygon" else read(at)
            items.append(item)
        if kind == "Polygon":
            return {"type": kind, "coordinates": items}, at
        if kind == "GeometryCollection":
            return {"type": kind, "geometries": items}, at
        return {"type": kind, "coordinates": [g["coordinates"] for g in items]}, at

    return read(0)[0]


def to_wkt(geometry: dict) -> str:
    def text(c, depth: int) -> str:
        if depth == 0:
            return f"{c[0]:.15g} {c[1]:.15g}"
        return "(" + ", ".join(text(x, depth - 1) for x in c) + ")"

    kind = geometry["type"]
    if kind == "GeometryCollection":
        return "GEOMETRYCOLLECTION (" + ", ".join(map(to_wkt, geometry["geometries"])) + ")"
    depth = {"Point": 0, "LineString": 1, "MultiPoint": 1, "Polygon": 2, "MultiLineString": 2, "MultiPolygon": 3}[kind]
    body = text(geometry["coordinates"], depth)
    return f"{kind.upper()} {body if depth else '(' + body + ')'}"


def from_wkt(value: str) -> dict:
    match = re.match(r"\s*([A-Za-z]+)\s*(?:Z|M|ZM)?\s*(\(.*\))\s*$", value, re.S)
    names = {n.upper(): n for n in WKB_CODES}
    if not match or match[1].upper() not in names:
        raise BadGeometry(f"not WKT: {value[:80]}")
    kind = names[match[1].upper()]
    if kind == "GeometryCollection":
        inner, depth, start, parts = match[2][1:-1], 0, 0, []
        for i, c in enumerate(inner + ","):
            depth += (c == "(") - (c == ")")
            if c == "," and depth == 0:
                parts.append(from_wkt(inner[start:i]))
                start = i + 1
        return {"type": kind, "geometries": parts}
    number = r"[-+0-9.eE]+"
    text = re.sub(rf"({number})\s+({number})(?:\s+{number})*", r"[\1,\2]", match[2])
    data = json.loads(re.sub(r"(?<![0-9.eE\]])\+", "", text.replace("(", "[").replace(")", "]")))
    if kind == "Point":
        data = data[0]
    elif kind == "MultiPoint":
        data = [p[0] if isinstance(p[0], list) else p for p in data]
    return {"type": kind, "coordinates": data}


def box(xmin: float, ymin: float, xmax: float, ymax: float) -> dict:
    return {"type": "Polygon", "coordinates": [[[xmin, ymin], [xmax, ymin], [xmax, ymax], [xmin, ymax], [xmin, ymin]]]}


_BOX_BYTES = 93  # a polygon of one ring of five points
_BOX_HEAD = struct.pack("<BIII", 1, WKB_CODES["Polygon"], 1, 5)


def boxes_to_wkb(x0, y0, x1, y1) -> list[bytes]:
    """The WKB of box(x0, y0, x1, y1) for arrays of corners."""
    corners = np.stack([x0, y0, x1, y0, x1, y1, x0, y1, x0, y0], axis=1).astype("<f8")
    rows = np.empty((len(corners), _BOX_BYTES), np.uint8)
    rows[:, :13] = np.frombuffer(_BOX_HEAD, np.uint8)
    rows[:, 13:] = corners.view(np.uint8).reshape(len(corners), 80)
    data = rows.tobytes()
    return [data[i : i + _BOX_BYTES] for i in range(0, len(data), _BOX_BYTES)]


def boxes_of(wkb) -> np.ndarray:
    """Which of a sequence of WKB values (or None) are rectangles along the axes, decoded as one array."""
    values = list(wkb)
    sized = np.array([d is not None and len(d) == _BOX_BYTES for d in values], bool)
    if not sized.any():
        return sized
    rows = np.frombuffer(b"".join(bytes(d) for d, s in zip(values, sized) if s), np.uint8).reshape(-1, _BOX_BYTES)
    right = (rows[:, :13] == np.frombuffer(_BOX_HEAD, np.uint8)).all(axis=1)
    p = np.ascontiguousarray(rows[:, 13:]).view("<f8").reshape(-1, 5, 2)
    closed = (p[:, 0] == p[:, 4]).all(axis=1)
    x, y = p[:, :, 0], p[:, :, 1]
    one = (x[:, 1] == x[:, 2]) & (x[:, 3] == x[:, 0]) & (y[:, 0] == y[:, 1]) & (y[:, 2] == y[:, 3])
    two = (x[:, 0] == x[:, 1]) & (x[:, 2] == x[:, 3]) & (y[:, 1] == y[:, 2]) & (y[:, 3] == y[:, 0])
    sized[sized] = right & closed & (one | two)
    return sized


def is_box(geometry: dict) -> bool:
    return bool(boxes_of([to_wkb(geometry)])[0])


def wkb_intersects(data: bytes | None, other: dict) -> bool:
    """intersects of a WKB value; a missing or broken one meets nothing."""
    if data is None:
        return False
    try:
        return intersects(from_wkb(bytes(data)), other)
    except BadGeometry:
        return False


def as_geometry(value: dict | str | bytes | tuple) -> dict:
    """A geometry from GeoJSON (dict or text), WKT, WKB or (xmin, ymin, xmax, ymax)."""
    if isinstance(value, (bytes, bytearray)):
        return from_wkb(bytes(value))
    if isinstance(value, (tuple, list)):
        return box(*value)
    if isinstance(value, dict):
        return from_geojson(value)
    return from_geojson(value) if value.lstrip().startswith("{") else from_wkt(value)


# ---------------------------------------------------------------- intersects


def _segments(part: dict) -> np.ndarray:
    """n x 4 array of a part's segments; a point is a segment of no length."""
    c = part["coordinates"]
    if part["type"] == "Point":
        return np.array([[*c[:2], *c[:2]]], float)
    lines = c if part["type"] == "Polygon" else [c]
    out = []
    for line in lines:
        a = np.asarray([p[:2] for p in line], float)
        out.append(np.hstack([a[:-1], a[1:]]) if len(a) > 1 else np.hstack([a, a]))
    return np.vstack(out)


def _cross(ax, ay, bx, by):
    return ax * by - ay * bx


def _touch(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether any segment of a meets any of b (ends and overlaps included)."""
    p, r = a[:, None, :2], a[:, None, 2:] - a[:, None, :2]
    q, s = b[None, :, :2], b[None, :, 2:] - b[None, :, :2]

    def side(o, d, t):
        return np.sign(_cross(d[..., 0], d[..., 1], t[..., 0] - o[..., 0], t[..., 1] - o[..., 1]))

    d1, d2 = side(p, r, q), side(p, r, q + s)
    d3, d4 = side(q, s, p), side(q, s, p + r)
    proper = (d1 * d2 <= 0) & (d3 * d4 <= 0)
    lo = np.maximum(np.minimum(a[:, None, :2], a[:, None, 2:]), np.minimum(b[None, :, :2], b[None, :, 2:]))
    hi = np.minimum(np.maximum(a[:, None, :2], a[:, None, 2:]), np.maximum(b[None, :, :2], b[None, :, 2:]))
    return bool((proper & (lo <= hi).all(axis=-1)).any())


def _inside(point: np.ndarray, polygon: dict) -> bool:
    """Even-odd rule over all rings (so holes are outside); the boundary is found by _touch."""
    x, y = point
    odd = False
    for ring in polygon["coordinates"]:
        a = np.asarray([p[:2] for p in ring], float)
        x1, y1, x2, y2 = a[:-1, 0], a[:-1, 1], a[1:, 0], a[1:, 1]
        crosses = (y1 > y) != (y2 > y)
        with np.errstate(divide="ignore", invalid="ignore"):
            at = (x2 - x1) * (y - y1) / (y2 - y1) + x1
        odd ^= bool((crosses & (x < at)).sum() % 2)
    return odd


def intersects(a: dict, b: dict) -> bool:
    ba, bb = bounds(a), bounds(b)
    if ba[0] > bb[2] or bb[0] > ba[2] or ba[1] > bb[3] or bb[1] > ba[3]:
        return False
    for x in simple_parts(a):
        sx = _segments(x)
        for y in simple_parts(b):
            sy = _segments(y)
            if _touch(sx, sy):
                return True
            if y["type"] == "Polygon" and _inside(sx[0, :2], y) or x["type"] == "Polygon" and _inside(sy[0, :2], x):
                return True
    return False
