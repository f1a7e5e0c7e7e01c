"""Space and time queries: geometry and period to files, then rows.

Cells of the geometry and the years of the period prune the manifest; only the
files that are left are read, with bounds and times pushed to their statistics;
an exact test of the footprint comes last.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..operators.dedup import first_by
from ..operators.fanout import footprint_filter
from .catalog import Catalog


def moment(value: str | datetime | None) -> datetime | None:
    """ISO text or a datetime as UTC; without a zone it is UTC, and a date alone is its midnight."""
    if value is None:
        return None
    found = datetime.fromisoformat(value.replace("Z", "+00:00")) if isinstance(value, str) else value
    return found.replace(tzinfo=timezone.utc) if found.tzinfo is None else found.astimezone(timezone.utc)


def plan_files(catalog: Catalog, geometry=None, start=None, end=None) -> DataFrame:
    """Manifest rows of the files that may hold matching items; a geometry that touches no cell gives none."""
    files = catalog.files()
    if geometry is not None:
        cells = catalog.grid().cover(geo.as_geometry(geometry))
        files = files.where(F.col("grid_partition").isin(cells)) if cells else files.where(F.lit(False))
    start, end = moment(start), moment(end)
    year = F.col("year").try_cast("int")
    if start:
        files = files.where((year >= start.year) & (F.col("max_datetime") >= F.lit(start)))
    if end:
        files = files.where((year <= end.year) & (F.col("min_datetime") <= F.lit(end)))
    return files


def file_paths(catalog: Catalog, geometry=None, start=None, end=None) -> list[str]:
    return [r.path for r in plan_files(catalog, geometry, start, end).select("path").orderBy("path").collect()]


def search(catalog: Catalog, geometry=None, start=None, end=None, where: str | Column | None = None, columns: list[str] | None = None, distinct_items: bool = False, exact: bool = True) -> DataFrame:
    """Rows that match. An item lies in every cell that it touches; distinct_items gives it once, from its first cell by name."""
    files = plan_files(catalog, geometry, start, end)
    rows = catalog.read(files)
    start, end = moment(start), moment(end)
    if geometry is not None:
        # File names are settled already; this lets the scan prune partitions as well.
        cells = catalog.grid().cover(geo.as_geometry(geometry))
        rows = rows.where(F.col("grid_partition").isin(cells)) if cells else rows.where(F.lit(False))
    if start:
        rows = rows.where(F.col("datetime") >= F.lit(start))
    if end:
        rows = rows.where(F.col("datetime") <= F.lit(end))
    if where is not None:
        rows = rows.where(where)
    if geometry is not None and exact:
        rows = footprint_filter(rows, geo.as_geometry(geometry))
    if distinct_items:
        rows = first_by(rows, ["id"], [F.col("grid_partition").asc(), F.col("updated").desc_nulls_last(), F.col("bbox").asc_nulls_last()])
    return rows.select(*[F.col(f"`{c}`") for c in columns]) if columns else rows


_CQL = re.compile(r"\s*(?:(?P<number>-?\d+(?:\.\d+)?)|(?P<text>'(?:[^']|'')*')|(?P<sign><=|>=|<>|=|<|>|\(|\)|,)|(?P<word>[A-Za-z_][\w:]*))")


def cql(text: str) -> Column:
    """A filter in a subset of CQL2 text: comparisons, IN, BETWEEN, LIKE, IS [NOT] NULL, AND, OR, NOT, parentheses."""
    items, at = [], 0
    while text[at:].strip():
        m = _CQL.match(text, at)
        if not m:
            raise ValueError(f"cannot read filter at: {text[at : at + 20]!r}")
        items.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    items.append(("end", ""))
    pos = 0

    def word() -> str:
        return items[pos][1].upper() if items[pos][0] == "word" else ""

    def take(expected: str | None = None):
        nonlocal pos
        kind, value = items[pos]
        if expected and value.upper() != expected:
            raise ValueError(f"expected {expected}, found {value!r}")
        pos += 1
        return kind, value

    def literal() -> Column:
        kind, value = take()
        if kind == "number":
            return F.lit(float(value) if "." in value else int(value))
        if kind == "text":
            return F.lit(value[1:-1].replace("''", "'"))
        raise ValueError(f"expected a value, found {value!r}")

    def either() -> Column:
        left = both()
        while word() == "OR":
            take()
            left = left | both()
        return left

    def both() -> Column:
        left = negated()
        while word() == "AND":
            take()
            left = left & negated()
        return left

    def negated() -> Column:
        if word() == "NOT":
            take()
            return ~negated()
        if items[pos] == ("sign", "("):
            take()
            inner = either()
            take(")")
            return inner
        kind, name = take()
        if kind != "word":
            raise ValueError(f"expected a property, found {name!r}")
        column = F.col(f"`{name}`")
        if items[pos][0] == "sign":
            sign = take()[1]
            value = literal()
            return {"=": column == value, "<>": column != value, "<": column < value, "<=": column <= value, ">": column > value, ">=": column >= value}[sign]
        no = word() == "NOT" and bool(take())
        keyword = take()[1].upper()
        if keyword == "IN":
            take("(")
            values = [literal()]
            while items[pos] == ("sign", ","):
                take()
                values.append(literal())
            take(")")
            found = column.isin(*values)
        elif keyword == "BETWEEN":
            low = literal()
            take("AND")
            found = column.between(low, literal())
        elif keyword == "LIKE":
            kind, pattern = take()
            if kind != "text":
                raise ValueError("LIKE needs a text")
            found = column.like(pattern[1:-1])
        elif keyword == "IS":
            no = word() == "NOT" and bool(take())
            take("NULL")
            found = column.isNull()
        else:
            raise ValueError(f"unknown operator {keyword!r}")
        return ~found if no else found

    out = either()
    if items[pos][0] != "end":
        raise ValueError(f"cannot read filter from {items[pos][1]!r} on")
    return out
