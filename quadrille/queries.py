"""The catalogue's operators over the driver's tables, each with its SQL.

Scenes are made from orders: an item with a box footprint, a platform and a
time for each order. All queries run over whole tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import columns as C
from .functions.geometry import box, boxes_to_wkb
from .operators import dedup, delta, fanout, hashindex, joins, reports
from .operators.grids import LatLonGrid
from .plans import maintenance, query
from .schema import BOUNDS

GRID = LatLonGrid(1)

#: The same scenes in SQL.
SCENES = """scenes AS (
  SELECT 'S' || CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS platform, o_orderdate AS dt, xmin, ymin,
         xmin + CAST(o_orderkey % 25 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS xmax, ymin + CAST(o_orderkey % 13 AS DOUBLE) + CAST(0.5 AS DOUBLE) AS ymax
  FROM (SELECT *, CAST((o_custkey * 37) % 360 - 180 AS DOUBLE) AS xmin, CAST((o_custkey * 53) % 170 - 85 AS DOUBLE) AS ymin FROM orders))"""

_CELLS = """fan AS (
  SELECT id, platform, dt, xmin, ymin, xmax, ymax, CAST(year(dt) AS VARCHAR) AS year, 'x' || CAST(cx AS VARCHAR) || 'y' || CAST(cy AS VARCHAR) AS cell
  FROM (SELECT *, unnest(range(GREATEST(0, LEAST(17, CAST(ceil((ymin + 90) / 10) AS BIGINT) - 1)), GREATEST(0, LEAST(17, CAST(floor((ymax + 90) / 10) AS BIGINT))) + 1)) AS cy
        FROM (SELECT *, unnest(range(GREATEST(0, LEAST(35, CAST(ceil((xmin + 180) / 10) AS BIGINT) - 1)), GREATEST(0, LEAST(35, CAST(floor((xmax + 180) / 10) AS BIGINT))) + 1)) AS cx FROM scenes)))"""
_FAN = f"WITH {SCENES}, {_CELLS}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    xmin = ((F.col("o_custkey") * 37) % 360 - 180).cast("double")
    ymin = ((F.col("o_custkey") * 53) % 170 - 85).cast("double")
    return o.select(
        F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderpriority").alias("platform"),
        F.col("o_orderdate").cast("timestamp").alias("datetime"),
        xmin.alias("xmin"),
        ymin.alias("ymin"),
        (xmin + (F.col("o_orderkey") % 25).cast("double") + 0.5).alias("xmax"),
        (ymin + (F.col("o_orderkey") % 13).cast("double") + 0.5).alias("ymax"),
    )


def fanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fanout.fan_out(scenes(spark, sf_dir), GRID)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def registered(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- cells and statistics


@registered(f"{_FAN} SELECT id, cell, year FROM fan")
def fanout_cells(spark, sf_dir):
    return fanned(spark, sf_dir).select("id", F.col("grid_partition").alias("cell"), "year")


@registered(f"{_FAN} SELECT CAST(k AS BIGINT) AS fan_out, count(*) AS items FROM (SELECT count(DISTINCT cell) AS k FROM fan GROUP BY id) GROUP BY k")
def fanout_histogram(spark, sf_dir):
    return fanout.histogram(fanned(spark, sf_dir))


@registered(f"{_FAN} SELECT cell, year, count(*) AS rows, count(DISTINCT id) AS items, count(DISTINCT platform) AS platforms FROM fan GROUP BY cell, year")
def partition_stats(spark, sf_dir):
    rows = fanned(spark, sf_dir)
    return rows.groupBy(F.col("grid_partition").alias("cell"), "year").agg(F.count("*").alias("rows"), F.countDistinct("id").alias("items"), F.countDistinct("platform").alias("platforms"))


_BOX, _FROM, _TO = (-60.0, 60.0, -30.0, 80.0), "1996-03-01", "1999-06-30"


def _boxed(rows: DataFrame) -> DataFrame:
    cells = GRID.cover(box(*_BOX))
    x0, y0, x1, y1 = _BOX
    near = (F.col("xmin") <= x1) & (F.col("xmax") >= x0) & (F.col("ymin") <= y1) & (F.col("ymax") >= y0)
    start, end = query.moment(_FROM), query.moment(_TO)
    return rows.where(F.col("grid_partition").isin(cells) & near & (F.col("datetime") >= F.lit(start)) & (F.col("datetime") <= F.lit(end)))


# The box's cells: x 11..15, y 14..17 (edges included).
_WHERE = "xmin <= -30 AND xmax >= -60 AND ymin <= 80 AND ymax >= 60 AND dt >= TIMESTAMP '1996-03-01' AND dt <= TIMESTAMP '1999-06-30' AND cell IN (" + ", ".join(f"'x{x}y{y}'" for x in range(11, 16) for y in range(14, 18)) + ")"


@registered(f"{_FAN} SELECT id, cell, year, platform FROM fan WHERE {_WHERE}")
def spatial_temporal_query(spark, sf_dir):
    return _boxed(fanned(spark, sf_dir)).select("id", F.col("grid_partition").alias("cell"), "year", "platform")


@registered(f"{_FAN} SELECT DISTINCT id, platform FROM fan WHERE {_WHERE}")
def distinct_items_query(spark, sf_dir):
    rows = dedup.first_by(_boxed(fanned(spark, sf_dir)), ["id"], [F.col("grid_partition").asc()])
    return rows.select("id", "platform")


@registered(f"{_FAN} SELECT id, cell FROM fan WHERE platform IN ('1-URGENT', '2-HIGH') AND xmax > 0 AND NOT (cell LIKE 'x1%')")
def attribute_filter(spark, sf_dir):
    rows = fanned(spark, sf_dir).withColumnRenamed("grid_partition", "cell")
    return rows.where(query.cql("platform IN ('1-URGENT', '2-HIGH') AND xmax > 0 AND NOT cell LIKE 'x1%'")).select("id", "cell")


@registered(f"WITH {SCENES} SELECT CAST(date_trunc('month', dt) AS TIMESTAMP) AS month, count(*) AS items FROM scenes GROUP BY 1")
def monthly_timeseries(spark, sf_dir):
    return reports.monthly(scenes(spark, sf_dir)).select(F.col("month").cast("timestamp_ntz").alias("month"), "items")


@registered(f"{_FAN} SELECT cell, count(DISTINCT year) AS years, count(DISTINCT id) AS unique_ids, count(*) - count(DISTINCT id) AS duplicates, count(*) AS total FROM fan GROUP BY cell ORDER BY unique_ids DESC, cell LIMIT 20")
def top_cells_by_unique(spark, sf_dir):
    return reports.top_cells(fanned(spark, sf_dir), 20).select(F.col("grid_partition").alias("cell"), "years", F.col("unique").alias("unique_ids"), "duplicates", "total")


@registered(f"{_FAN} SELECT cell, year, count(*) AS n FROM fan GROUP BY cell, year ORDER BY n DESC, cell, year LIMIT 15")
def largest_cell_years(spark, sf_dir):
    return reports.cell_years(fanned(spark, sf_dir)).limit(15).select(F.col("grid_partition").alias("cell"), "year", "n")


_TWICE = f"WITH {SCENES}, twice AS (SELECT id, CAST(year(dt) AS VARCHAR) AS year FROM scenes UNION ALL SELECT id, CAST(year(dt) AS VARCHAR) FROM scenes WHERE platform = '5-LOW')"


def _twice(spark, sf_dir):
    s = scenes(spark, sf_dir).withColumn("year", C.year_of(F.col("datetime")))
    return s.unionByName(s.where("platform = '5-LOW'"))


@registered(f"{_TWICE} SELECT year, count(*) AS total, count(DISTINCT id) AS unique_ids, count(*) - count(DISTINCT id) AS duplicates FROM twice GROUP BY year")
def per_year_duplicates(spark, sf_dir):
    return reports.duplicates(_twice(spark, sf_dir), ["year"]).select("year", "total", F.col("unique").alias("unique_ids"), "duplicates")


@registered(f"{_TWICE} SELECT count(*) AS total, count(DISTINCT id) AS unique_ids, count(*) - count(DISTINCT id) AS duplicates FROM twice")
def overall_duplicates(spark, sf_dir):
    return reports.duplicates(_twice(spark, sf_dir)).select("total", F.col("unique").alias("unique_ids"), "duplicates")


@registered("SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n_rows, CAST(floor(CAST(count(*) AS DOUBLE) * 100000 / (SELECT count(*) FROM orders) + 0.000001) AS BIGINT) AS share_1000 FROM orders GROUP BY 1")
def year_share(spark, sf_dir):
    files = scenes(spark, sf_dir).select(C.year_of(F.col("datetime")).alias("year"), F.lit(1).cast("long").alias("rows"))
    found = reports.year_shares(files)
    return found.select("year", F.col("rows").alias("n_rows"), F.floor(F.col("share") * 1000.0 + 1e-6).cast("long").alias("share_1000"))


# ---------------------------------------------------------------- deduplication


_EV = ["user_id", "event_type"]


def _latest(name: str) -> str:
    return f"SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY {name}) AS r FROM events) WHERE r = 1"


@registered(_latest("ts DESC NULLS LAST, event_id"))
def latest_by_updated(spark, sf_dir):
    e = _table(spark, sf_dir, "events").withColumnRenamed("ts", "updated")
    return dedup.latest(e, "updated", [F.col("event_id").asc()], ["user_id"], "event_type").select(*_EV, "event_id")


@registered(_latest("CASE WHEN value > 50 THEN ts END DESC NULLS LAST, event_id"))
def latest_by_created(spark, sf_dir):
    e = _table(spark, sf_dir, "events").withColumn("created", F.when(F.col("value") > 50, F.col("ts")))
    return dedup.latest(e, "created", [F.col("event_id").asc()], ["user_id"], "event_type").select(*_EV, "event_id")


@registered(_latest("event_id"))
def first_seen(spark, sf_dir):
    return dedup.first_seen(_table(spark, sf_dir, "events"), ["event_id"], ["user_id"], "event_type").select(*_EV, "event_id")


@registered("SELECT CAST(user_id AS VARCHAR) AS id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CAST(CAST(ts AS DATE) AS VARCHAR) DESC, event_id) AS r FROM events) WHERE r = 1")
def strict_latest_tie_first(spark, sf_dir):
    e = _table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("id"), "event_id", F.col("ts").cast("date").cast("string").alias("day"))
    return dedup.strictly_latest(e, "day", ["event_id"]).select("id", "event_id")


@registered("SELECT DISTINCT user_id FROM events")
def distinct_ids(spark, sf_dir):
    return dedup.distinct_ids(_table(spark, sf_dir, "events"), "user_id")


# ---------------------------------------------------------------- inventories


def _inventory(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    key = F.concat(F.lit("items/"), F.col("o_orderpriority"), F.lit("/S"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 5 == 0, ".json").otherwise(".stac.json"))
    modified = F.when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return o.select(F.lit("b").alias("bucket"), key.alias("key"), modified.alias("modified"))


_INV = """WITH inv AS (SELECT 'b' AS bucket, 'items/' || o_orderpriority || '/S' || CAST(o_orderkey AS VARCHAR) || CASE WHEN o_orderkey % 5 = 0 THEN '.json' ELSE '.stac.json' END AS key,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS modified FROM orders)"""


@registered(f"{_INV} SELECT key, CAST(modified AS TIMESTAMP) AS modified FROM inv WHERE key LIKE '%.stac.json' AND (modified IS NULL OR modified >= TIMESTAMP '1998-01-01')")
def inventory_filter_since(spark, sf_dir):
    rows = _inventory(spark, sf_dir).withColumn("modified", C.utc_timestamp(F.col("modified")))
    kept = rows.where(C.is_item_key(F.col("key")) & C.fresh(F.col("modified"), "1998-01-01"))
    return kept.select("key", F.col("modified").cast("timestamp_ntz").alias("modified"))


@registered(rf"{_INV} SELECT key, regexp_replace(split_part(key, '/', 3), '\.stac\.json$', '') AS id FROM inv")
def key_to_id(spark, sf_dir):
    return _inventory(spark, sf_dir).select("key", C.id_of_key(F.col("key")).alias("id"))


@registered("SELECT page_id, split_part(regexp_replace(url, '^[a-z0-9]+://', ''), '/', 1) AS bucket, regexp_replace(regexp_replace(url, '^[a-z0-9]+://', ''), '^[^/]*/?', '') AS key FROM pages")
def href_split(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", C.bucket_of_href(F.col("url")).alias("bucket"), C.key_of_href(F.col("url")).alias("key"))


@registered("SELECT o_orderkey AS id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def delta_anti_join(spark, sf_dir):
    new = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return joins.missing_from(new, _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")), "id")


@registered("SELECT id, source, total FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY source, total DESC NULLS LAST) AS r FROM (SELECT o_custkey AS id, 0 AS source, o_totalprice AS total FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_custkey, 1, o_totalprice FROM orders WHERE o_orderstatus <> 'O')) WHERE r = 1")
def delta_merge_precedence(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("total"), "o_orderstatus")
    parts = [o.where("o_orderstatus = 'O'").withColumn("source", F.lit(0)), o.where("o_orderstatus <> 'O'").withColumn("source", F.lit(1))]
    return dedup.newest_of_sources(parts, "id", ["total"]).select("id", "source", "total")


@registered("SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')")
def not_in_null_aware(spark, sf_dir):
    ids = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return joins.not_in(ids, _table(spark, sf_dir, "orders").where("o_orderdate >= '1998-01-01'").select(F.col("o_custkey").alias("id")), "id")


@registered("SELECT c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderkey % 100 <> 0 THEN o_custkey END FROM orders)")
def not_in_with_null(spark, sf_dir):
    ids = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return joins.not_in(ids, _table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 100 != 0, F.col("o_custkey")).alias("id")), "id")


@registered("SELECT o_orderkey AS id, o_totalprice AS total FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def membership_semi_join(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("total"))
    return joins.within(o, _table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id")), "id")


_FLAGS = """WITH a AS (SELECT DISTINCT o_orderkey AS id FROM orders WHERE o_orderkey % 3 > 0), b AS (SELECT DISTINCT l_orderkey AS id FROM lineitem), c AS (SELECT DISTINCT c_custkey AS id FROM customer),
  flags AS (SELECT id, id IN (SELECT id FROM a) AS inventoried, id IN (SELECT id FROM b) AS in_database, id IN (SELECT id FROM c) AS in_warehouse FROM (SELECT id FROM a UNION SELECT id FROM b UNION SELECT id FROM c))"""


def _flags(spark, sf_dir):
    a = _table(spark, sf_dir, "orders").where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("id"))
    b = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    c = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return reports.audit(a, b, c)


@registered(f"{_FLAGS} SELECT * FROM flags")
def audit_flags(spark, sf_dir):
    return _flags(spark, sf_dir)


@registered(f"{_FLAGS} SELECT inventoried, in_database, in_warehouse, count(*) AS ids FROM flags GROUP BY ALL")
def venn_regions(spark, sf_dir):
    return joins.regions_of_venn(_flags(spark, sf_dir), ["inventoried", "in_database", "in_warehouse"])


@registered(
    """WITH inv AS (SELECT o_orderkey AS id, 'b' AS bucket, 'items/' || CAST(o_orderkey AS VARCHAR) || '.stac.json' AS key FROM orders WHERE o_orderkey % 3 > 0),
  db AS (SELECT DISTINCT l_orderkey AS id, 's3://c/data/' || CAST(l_orderkey AS VARCHAR) || CASE WHEN l_orderkey % 2 = 0 THEN '.nc' ELSE '.txt' END AS href FROM lineitem), wh AS (SELECT c_custkey AS id FROM customer)
  SELECT bucket, key FROM inv WHERE id NOT IN (SELECT id FROM wh)
  UNION ALL SELECT 'c', CASE WHEN href LIKE '%.nc' THEN replace(href, 's3://c/', '') || '.stac.json' ELSE replace(href, 's3://c/', '') END FROM db WHERE id NOT IN (SELECT id FROM wh) AND id NOT IN (SELECT id FROM inv)"""
)
def delta_inventory_union(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").where("o_orderkey % 3 > 0")
    inv = o.select(F.col("o_orderkey").alias("id"), F.lit("b").alias("bucket"), F.concat(F.lit("items/"), F.col("o_orderkey").cast("string"), F.lit(".stac.json")).alias("key"))
    n = F.col("l_orderkey").cast("string")
    db = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.concat(F.lit("s3://c/data/"), n, F.when(F.col("l_orderkey") % 2 == 0, ".nc").otherwise(".txt")).alias("href")).distinct()
    wh = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return reports.audit_delta(reports.audit(inv.select("id"), db.select("id"), wh), inv, db)


@registered(
    """WITH a AS (SELECT p_partkey AS key, p_size AS size FROM part WHERE p_partkey % 4 > 0), b AS (SELECT p_partkey AS key, CASE WHEN p_partkey % 10 = 0 THEN p_size + 1 ELSE p_size END AS size FROM part WHERE p_partkey % 5 > 0 OR p_partkey % 10 = 0)
  SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NULL THEN 'added' WHEN b.key IS NULL THEN 'removed' WHEN a.size IS NOT DISTINCT FROM b.size THEN 'same' ELSE 'changed' END AS status FROM a FULL JOIN b ON a.key = b.key"""
)
def manifest_diff(spark, sf_dir):
    p = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_size").alias("size"))
    b = p.where("key % 5 > 0 or key % 10 = 0").withColumn("size", F.when(F.col("key") % 10 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return joins.compare(p.where("key % 4 > 0"), b, "key", ["size"]).select("key", "status")


@registered(
    """WITH a AS (SELECT p_partkey AS path FROM part WHERE p_partkey % 7 > 0), b AS (SELECT DISTINCT l_partkey AS path FROM lineitem WHERE l_partkey % 5 > 0)
  SELECT path, 'missing' AS status FROM a WHERE path NOT IN (SELECT path FROM b) UNION ALL SELECT path, 'unregistered' FROM b WHERE path NOT IN (SELECT path FROM a)"""
)
def missing_and_unregistered(spark, sf_dir):
    a = _table(spark, sf_dir, "part").where("p_partkey % 7 > 0").select(F.col("p_partkey").alias("path"))
    b = _table(spark, sf_dir, "lineitem").where("l_partkey % 5 > 0").select(F.col("l_partkey").alias("path")).distinct()
    return joins.unmatched(a, b, "path")


# ---------------------------------------------------------------- reports


@registered("SELECT CAST(min(length(p_name)) AS BIGINT) AS min_length, CAST(max(length(p_name)) AS BIGINT) AS max_length, CAST(floor(avg(length(p_name))) AS BIGINT) AS avg_length FROM part")
def id_length_stats(spark, sf_dir):
    found = reports.lengths(_table(spark, sf_dir, "part"), "p_name")
    return found.select(*[F.col(c).cast("long").alias(c) for c in found.columns])


@registered("SELECT split_part(p_name, ' ', 1) AS prefix, count(*) AS items FROM part GROUP BY 1 ORDER BY items DESC, prefix LIMIT 10")
def prefix_top10(spark, sf_dir):
    return reports.prefixes(_table(spark, sf_dir, "part"), "p_name", " ", 10)


@registered("SELECT CASE WHEN n_chars > 0 THEN CAST(CAST(floor(log10(n_chars)) AS BIGINT) AS VARCHAR) ELSE 'zero' END AS decade, count(*) AS buckets FROM documents GROUP BY 1")
def size_decades(spark, sf_dir):
    return reports.decades(_table(spark, sf_dir, "documents"), "n_chars")


_FILES = """WITH files AS (SELECT 'c' || CAST(l_suppkey % 40 AS VARCHAR) AS cell, CAST(year(l_shipdate) AS VARCHAR) AS year, 'part_' || lpad(CAST(l_linenumber AS VARCHAR), 6, '0') AS path, count(*) AS n FROM lineitem GROUP BY ALL)"""


def _files(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem")
    cell = F.concat(F.lit("c"), (F.col("l_suppkey") % 40).cast("string"))
    path = F.concat(F.lit("part_"), F.lpad(F.col("l_linenumber").cast("string"), 6, "0"))
    return li.groupBy(cell.alias("grid_partition"), F.year("l_shipdate").cast("string").alias("year"), path.alias("path")).agg(F.count("*").alias("rows")).withColumn("bytes", F.col("rows") * 100)


@registered(f"{_FILES} SELECT cell, year, count(*) AS files, CAST(sum(n) AS BIGINT) AS n_rows FROM files GROUP BY cell, year HAVING count(*) >= 6")
def compaction_candidates(spark, sf_dir):
    return maintenance.candidates(_files(spark, sf_dir), 6).select(F.col("grid_partition").alias("cell"), "year", "files", F.col("rows").alias("n_rows"))


@registered(
    f"""{_FILES}, numbered AS (SELECT *, row_number() OVER (PARTITION BY cell, year ORDER BY path) AS pos FROM files),
  small AS (SELECT cell, year, min(pos) AS lo FROM numbered WHERE n < 40 GROUP BY cell, year), tail AS (SELECT n.* FROM numbered n JOIN small s ON n.cell = s.cell AND n.year = s.year AND n.pos >= s.lo)
  SELECT cell, year, path, n AS n_rows FROM tail WHERE (cell, year) IN (SELECT (cell, year) FROM tail GROUP BY cell, year HAVING count(*) >= 2)"""
)
def consolidate_plan(spark, sf_dir):
    return maintenance.tail_plan(_files(spark, sf_dir), 40).select(F.col("grid_partition").alias("cell"), "year", "path", F.col("rows").alias("n_rows"))


@registered(f"{_FILES} SELECT k AS files, count(*) AS buckets FROM (SELECT count(*) AS k FROM files GROUP BY cell, year) GROUP BY k")
def files_per_bucket(spark, sf_dir):
    return reports.files_per_bucket(_files(spark, sf_dir))


@registered(f"{_FILES} SELECT cell, year, max(CAST(substr(path, 6) AS INTEGER)) + 1 AS next_part FROM files GROUP BY cell, year")
def next_part_number(spark, sf_dir):
    return reports.next_part(_files(spark, sf_dir)).select(F.col("grid_partition").alias("cell"), "year", "next_part")


@registered(f"{_FILES} SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS files, CAST(sum(n * 100) AS BIGINT) AS n_bytes, count(DISTINCT cell) AS cells, count(DISTINCT year) AS years FROM files")
def catalog_summary(spark, sf_dir):
    return reports.summary(_files(spark, sf_dir)).select(F.col("rows").alias("n_rows"), "files", F.col("bytes").alias("n_bytes"), "cells", "years")


@registered("SELECT p_partkey AS id, p_name AS name, p_retailprice AS price, CAST(NULL AS DOUBLE) AS balance FROM part UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def schema_promotion_union(spark, sf_dir):
    p = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))
    s = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return p.unionByName(s, allowMissingColumns=True).select("id", "name", "price", "balance")


@registered("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS none FROM events")
def props_promotion(spark, sf_dir):
    e = _table(spark, sf_dir, "events").withColumn("p", F.from_json("props", "map<string,string>"))
    return e.select("event_id", F.try_element_at("p", F.lit("k")).try_cast("long").alias("k"), F.try_element_at("p", F.lit("none")).alias("none"))


@registered("SELECT bool_and(l_quantity IS NULL OR l_quantity = floor(l_quantity)) AS l_quantity, bool_and(l_tax IS NULL OR l_tax = floor(l_tax)) AS l_tax FROM lineitem")
def whole_number_check(spark, sf_dir):
    return reports.whole_numbers(_table(spark, sf_dir, "lineitem"), ["l_quantity", "l_tax"])


@registered("SELECT CAST(coalesce(max(k), 0) AS BIGINT) AS last FROM (SELECT k, row_number() OVER (ORDER BY k) AS r FROM (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderkey >= 1 AND o_orderkey % 500 <> 0)) WHERE k = r")
def contiguous_prefix(spark, sf_dir):
    return reports.contiguous_prefix(_table(spark, sf_dir, "orders").where("o_orderkey % 500 <> 0"), "o_orderkey", 1)


_REGIONS = [("north", -180, 60, 180, 90), ("atlantic", -60, -40, -10, 60), ("india", 65, 5, 90, 35), ("pacific", 150, -50, 180, 10), ("equator", -180, -5, 180, 5)]


@registered(f"WITH {SCENES}, r(key, x0, y0, x1, y1) AS (VALUES " + ", ".join(f"('{k}', {a}, {b}, {c}, {d})" for k, a, b, c, d in _REGIONS) + ") SELECT id, key FROM scenes JOIN r ON xmin <= x1 AND xmax >= x0 AND ymin <= y1 AND ymax >= y0")
def region_join(spark, sf_dir):
    regions = spark.createDataFrame([(k, json.dumps(box(*b))) for k, *b in _REGIONS], "key string, geometry string")
    s = scenes(spark, sf_dir)
    items = s.withColumn("geometry", F.pandas_udf(_wkb_of_boxes, "binary")(*BOUNDS))
    return joins.region_join(items, regions).select("id", "key")


def _wkb_of_boxes(x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.Series:
    return pd.Series(boxes_to_wkb(x0, y0, x1, y1))


@registered()
def hash_index(spark, sf_dir):
    ids = scenes(spark, sf_dir).select("id")
    return hashindex.hashes_of(ids).select(F.lower(F.hex("id_hash")).alias("id_hash"))


@registered("SELECT count(*) AS new_rows FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey % 5 > 0 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A'))")
def hash_anti_join(spark, sf_dir):
    hashed = delta.hashed_inventory(_inventory(spark, sf_dir))
    known = _table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").select(F.concat(F.lit("S"), F.col("l_orderkey").cast("string")).alias("id"))
    return delta.new_rows(hashed, hashindex.hashes_of(known)).select("id_hash").distinct().agg(F.count("*").alias("new_rows"))


@registered(f"WITH {SCENES} SELECT id, platform, CAST(dt AS TIMESTAMP) AS datetime FROM scenes ORDER BY dt, id LIMIT 100")
def ordered_limit(spark, sf_dir):
    return scenes(spark, sf_dir).select("id", "platform", F.col("datetime").cast("timestamp_ntz").alias("datetime")).orderBy("datetime", "id").limit(100)


@registered("SELECT o_orderkey AS key, o_totalprice AS total FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'")
def datetime_between(spark, sf_dir):
    o = _table(spark, sf_dir, "orders").where(F.col("o_orderdate").between("1996-01-01", "1996-12-31"))
    return o.select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("total"))


@registered("SELECT p_partkey AS id FROM part WHERE p_partkey % 3 = 0 INTERSECT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def key_intersection(spark, sf_dir):
    p = _table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("id"))
    return p.intersect(_table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("id")))


@registered("SELECT p_partkey AS id FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45")
def key_difference(spark, sf_dir):
    p = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    return p.subtract(_table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("id")))


@registered(f"{_FAN} SELECT cell, year, count(*) AS n_rows FROM fan WHERE cell = 'x17y9' GROUP BY cell, year")
def pruned_partition(spark, sf_dir):
    rows = fanned(spark, sf_dir).where("grid_partition = 'x17y9'")
    return rows.groupBy(F.col("grid_partition").alias("cell"), "year").agg(F.count("*").alias("n_rows"))


@registered(f"""{_FILES}, named AS (SELECT cell, year, CASE WHEN n % 3 = 0 THEN 'compacted_' || path WHEN n % 3 = 1 THEN 'tmp_' || path ELSE path END AS path FROM files),
  has AS (SELECT cell, year, bool_or(path LIKE 'part%') AS p, bool_or(path LIKE 'tmp%') AS t FROM named GROUP BY cell, year)
  SELECT cell, year, path FROM named JOIN has USING (cell, year) WHERE CASE WHEN p THEN path LIKE 'part%' WHEN t THEN path LIKE 'tmp%' OR path LIKE 'compacted%' ELSE false END""")
def straggler_files(spark, sf_dir):
    n = F.col("rows") % 3
    files = _files(spark, sf_dir).withColumn("path", F.when(n == 0, F.concat(F.lit("compacted_"), "path")).when(n == 1, F.concat(F.lit("tmp_"), "path")).otherwise(F.col("path")))
    return maintenance.stragglers(files).select(F.col("grid_partition").alias("cell"), "year", "path")


@registered(f"""{_FILES} SELECT CASE WHEN n % 2 = 0 THEN 'compacted' ELSE 'part' END AS kind, count(*) AS files, CAST(sum(n) AS BIGINT) AS n_rows FROM files GROUP BY 1""")
def file_classes(spark, sf_dir):
    files = _files(spark, sf_dir).withColumn("path", F.when(F.col("rows") % 2 == 0, F.concat(F.lit("d/compacted_"), "path")).otherwise(F.concat(F.lit("d/"), "path")))
    return files.groupBy(C.file_class(F.col("path")).alias("kind")).agg(F.count("*").alias("files"), F.sum("rows").alias("n_rows"))


@registered("SELECT count(*) FILTER (a) AS a, count(*) FILTER (b) AS b, count(*) FILTER (a AND b) AS both, count(*) FILTER (a AND NOT b) AS only_a, count(*) FILTER (b AND NOT a) AS only_b FROM (SELECT bool_or(k = 0) AS a, bool_or(k = 1) AS b FROM (SELECT o_orderkey AS id, 0 AS k FROM orders WHERE o_orderkey % 3 > 0 UNION ALL SELECT l_orderkey, 1 FROM lineitem) GROUP BY id)")
def compare_sources(spark, sf_dir):
    a = _table(spark, sf_dir, "orders").where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("id"))
    return reports.compare_sources(a, _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id")))["counts"]


@registered(f"""{_FILES} SELECT cell, year, CAST(coalesce(sum(n) FILTER (year >= '1998'), 0) AS BIGINT) AS merged FROM files GROUP BY cell, year""")
def empty_bucket_report(spark, sf_dir):
    files = _files(spark, sf_dir)
    done = files.where("year >= '1998'").groupBy("grid_partition", "year").agg(F.sum("rows").alias("merged"))
    return reports.bucket_report(files, done).select(F.col("grid_partition").alias("cell"), "year", "merged")


@registered(f"""{_FILES} SELECT count(*) FILTER (k > 6) AS buckets, CAST(coalesce(sum(s) FILTER (k > 6), 0) AS BIGINT) AS n_rows FROM (SELECT count(*) AS k, sum(n) AS s FROM files GROUP BY cell, year)""")
def fragmented_buckets(spark, sf_dir):
    per = _files(spark, sf_dir).groupBy("grid_partition", "year").agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))
    split = per.select("grid_partition", "year", F.col("rows"), F.explode(F.sequence(F.lit(1), F.when(F.col("files") > 6, 2).otherwise(1))).alias("i"))
    halves = split.select("grid_partition", "year", F.when(F.col("i") == 1, F.col("rows")).otherwise(F.lit(0)).alias("rows"))
    return reports.fragmented(halves).select("buckets", F.col("rows").alias("n_rows"))


@registered("SELECT event_id FROM events WHERE user_id IS NULL OR event_type = ''")
def blank_ids(spark, sf_dir):
    e = _table(spark, sf_dir, "events").withColumn("id", F.when(F.col("user_id").isNotNull(), F.col("event_type")))
    return reports.blank_ids(e).select("event_id")


def _load() -> None:
    from . import warehouse_queries  # noqa: F401  (registers its queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
