"""Sources, sinks and operations of the catalogue as queries over the driver's tables, each with its SQL.

Every query writes what it needs to a scratch folder, runs the operation there
on whole tables and returns rows. Items are the scenes of queries.py; cells are
the five named regions, so that buckets are few and large.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import columns as C
from .functions.geometry import box
from .operators import delta, fanout, hashindex, reports
from .operators.grids import LatLonGrid, RegionGrid
from .plans import ingest, maintenance, query
from .plans.catalog import Catalog
from .queries import _INV, _REGIONS, SCENES, _inventory, _table, _wkb_of_boxes, registered, scenes
from .schema import BOUNDS, STORED
from .scratch import scratch
from .sources import fetch, files, inventory
from .streaming import ingest as stream

_R = "r(key, x0, y0, x1, y1) AS (VALUES " + ", ".join(f"('{k}', {a}, {b}, {c}, {d})" for k, a, b, c, d in _REGIONS) + ")"
_MEET = "xmin <= x1 AND xmax >= x0 AND ymin <= y1 AND ymax >= y0"
#: Scenes fanned out to regions; a scene that meets none lies in a cell of that name.
_RF = f"""WITH {SCENES}, {_R}, rf AS (SELECT id, platform, dt, xmin, ymin, xmax, ymax, CAST(year(dt) AS VARCHAR) AS year, key AS cell FROM scenes JOIN r ON {_MEET}
  UNION ALL SELECT id, platform, dt, xmin, ymin, xmax, ymax, CAST(year(dt) AS VARCHAR), '__none__' FROM scenes WHERE NOT EXISTS (SELECT 1 FROM r WHERE {_MEET}))"""


class _Regions(RegionGrid):
    """The named regions, without a file that holds them."""

    def properties(self) -> dict[str, str]:
        return {"grid.type": self.kind}


class _RegionCatalog(Catalog):
    def grid(self) -> RegionGrid:
        return _Regions({k: box(*b) for k, *b in _REGIONS})


def _stored(spark: SparkSession, sf_dir: str, version: str) -> DataFrame:
    rows = scenes(spark, sf_dir).withColumn("geometry", F.pandas_udf(_wkb_of_boxes, "binary")(*BOUNDS))
    rows = rows.withColumns({"updated": F.col("datetime"), "version": F.lit(version)})
    return rows.select(*[(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in STORED.fields], *BOUNDS)


def _catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """Two commits: all scenes, then those of one platform once more with a later update."""
    catalog = _RegionCatalog.create(spark, scratch(spark, "catalog"), _Regions({}))
    catalog.append(fanout.fan_out(_stored(spark, sf_dir, "1"), catalog.grid()))
    again = _stored(spark, sf_dir, "2").where("platform = '5-LOW'").withColumn("updated", F.col("updated") + F.expr("interval 1 day"))
    catalog.append(fanout.fan_out(again, catalog.grid()), "update")
    return catalog


_CATALOGS: dict[tuple, Catalog] = {}


def _shared_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """The same for queries that only read."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CATALOGS:
        _CATALOGS[key] = _catalog(spark, sf_dir)
    return _CATALOGS[key]


def _cell(df: DataFrame, *rest) -> DataFrame:
    return df.select(F.col("grid_partition").alias("cell"), *rest)


# ---------------------------------------------------------------- the catalogue


@registered(f"{_RF} SELECT id, cell, year, '1' AS version FROM rf UNION ALL SELECT id, cell, year, '2' FROM rf WHERE platform = '5-LOW'")
def catalog_rows(spark, sf_dir):
    return _shared_catalog(spark, sf_dir).read().select("id", F.col("grid_partition").alias("cell"), "year", "version")


@registered(f"{_RF} SELECT cell, year, CAST(count(*) + count(*) FILTER (platform = '5-LOW') AS BIGINT) AS n_rows FROM rf GROUP BY cell, year")
def catalog_statistics(spark, sf_dir):
    return _cell(_shared_catalog(spark, sf_dir).statistics(), "year", F.col("rows").alias("n_rows"))


@registered(f"{_RF} SELECT cell, year, CAST(min(dt) AS TIMESTAMP) AS first, CAST(max(dt) AS TIMESTAMP) AS last FROM rf GROUP BY cell, year")
def catalog_manifest_times(spark, sf_dir):
    found = _shared_catalog(spark, sf_dir).files().groupBy("grid_partition", "year").agg(F.min("min_datetime").alias("a"), F.max("max_datetime").alias("b"))
    return _cell(found, "year", F.col("a").cast("timestamp_ntz").alias("first"), F.col("b").cast("timestamp_ntz").alias("last"))


@registered(f"{_RF} SELECT 1 AS snapshot, 'append' AS action, CAST(count(*) AS BIGINT) AS n_rows FROM rf UNION ALL SELECT 2, 'update', CAST(count(*) + count(*) FILTER (platform = '5-LOW') AS BIGINT) FROM rf")
def catalog_history(spark, sf_dir):
    catalog = _shared_catalog(spark, sf_dir)
    parts = [catalog.files(s["id"]).agg(F.lit(s["id"]).alias("snapshot"), F.lit(s["action"]).alias("action"), F.sum("rows").alias("n_rows")) for s in catalog.snapshots()]
    return parts[0].union(parts[1])


_AREA, _FROM, _TO = (-60.0, 50.0, -30.0, 80.0), "1996-03-01", "1999-06-30"
_WITHIN = "xmin <= -30 AND xmax >= -60 AND ymin <= 80 AND ymax >= 50 AND dt >= TIMESTAMP '1996-03-01' AND dt <= TIMESTAMP '1999-06-30' AND cell IN ('atlantic', 'north')"


@registered(f"{_RF} SELECT id, cell FROM rf WHERE {_WITHIN} AND platform = '1-URGENT'")
def catalog_search(spark, sf_dir):
    found = query.search(_shared_catalog(spark, sf_dir), _AREA, _FROM, _TO, query.cql("platform = '1-URGENT' AND version = '1'"))
    return found.select("id", F.col("grid_partition").alias("cell"))


@registered(f"{_RF} SELECT DISTINCT id FROM rf WHERE {_WITHIN}")
def catalog_distinct_items(spark, sf_dir):
    return query.search(_shared_catalog(spark, sf_dir), _AREA, _FROM, _TO, distinct_items=True).select("id")


@registered(f"{_RF} SELECT cell, year FROM rf WHERE cell IN ('atlantic', 'north') AND year BETWEEN '1996' AND '1999' GROUP BY cell, year HAVING max(dt) >= TIMESTAMP '1996-03-01' AND min(dt) <= TIMESTAMP '1999-06-30'")
def catalog_pruned_buckets(spark, sf_dir):
    found = query.plan_files(_shared_catalog(spark, sf_dir), _AREA, _FROM, _TO)
    return _cell(found, "year").distinct()


@registered(f"{_RF} SELECT id, cell, CASE WHEN platform = '5-LOW' THEN '2' ELSE '1' END AS version FROM rf")
def catalog_compact(spark, sf_dir):
    catalog = _catalog(spark, sf_dir)
    maintenance.compact(catalog)
    return catalog.read().select("id", F.col("grid_partition").alias("cell"), "version")


@registered(f"{_RF} SELECT 'compacted' AS kind, CAST(count(DISTINCT (cell, year)) AS BIGINT) AS buckets, CAST(count(*) AS BIGINT) AS n_rows FROM rf")
def catalog_finish(spark, sf_dir):
    catalog = _catalog(spark, sf_dir)
    maintenance.finish(catalog)
    named = catalog.files().withColumn("kind", C.file_class(F.col("path")))
    return named.groupBy("kind").agg(F.countDistinct("grid_partition", "year").alias("buckets"), F.sum("rows").alias("n_rows"))


@registered(f"{_RF} SELECT cell, year, CAST(count(*) AS BIGINT) AS n_rows, CAST(1 AS BIGINT) AS files FROM rf GROUP BY cell, year")
def catalog_consolidate(spark, sf_dir):
    catalog = _catalog(spark, sf_dir)
    maintenance.consolidate(catalog, rows_per_file=1_000_000, threshold=1)
    return _cell(catalog.statistics(), "year", F.col("rows").alias("n_rows"), "files")


@registered(f"{_RF} SELECT cell, year, CAST(count(*) + count(*) FILTER (platform = '5-LOW') AS BIGINT) AS n_rows FROM rf GROUP BY cell, year")
def catalog_register(spark, sf_dir):
    catalog = _catalog(spark, sf_dir)
    for name in files.list_names(spark, f"{catalog.meta}/snapshots"):  # the manifests are lost
        files.remove(spark, f"{catalog.meta}/snapshots/{name}")
    catalog.register()
    return _cell(catalog.statistics(), "year", F.col("rows").alias("n_rows"))


@registered(f"{_RF} SELECT cell, year, CAST(count(*) AS BIGINT) AS n_rows FROM rf WHERE year >= '1995' GROUP BY cell, year")
def catalog_register_new(spark, sf_dir):
    catalog = _catalog(spark, sf_dir)
    first = catalog.files(1).where("year >= '1995'")
    catalog.commit(first.where("year = '1995'"), "start over")
    catalog.register_new(first.select("path"))
    return _cell(catalog.statistics(), "year", F.col("rows").alias("n_rows"))


@registered(f"{_RF} SELECT CAST(count(DISTINCT id) AS BIGINT) AS unique_ids, CAST(count(*) + count(*) FILTER (platform = '5-LOW') AS BIGINT) AS total, CAST(0 AS BIGINT) AS unmatched FROM rf")
def catalog_validate(spark, sf_dir):
    found = reports.validate(_shared_catalog(spark, sf_dir))
    return found["ids"].select(F.col("unique").alias("unique_ids"), "total").crossJoin(found["unmatched"].agg(F.count("*").alias("unmatched")))


@registered(f"{_RF} SELECT CAST(2 AS BIGINT) AS expired, CAST(count(*) AS BIGINT) AS n_rows, true AS only_listed FROM rf")
def catalog_expire(spark, sf_dir):
    catalog = _catalog(spark, sf_dir)
    maintenance.compact(catalog, threshold=1)
    gone = maintenance.expire(catalog, 0.0)
    maintenance.remove_orphans(catalog, dry_run=False, grace_hours=0.0)
    same = catalog.describe_files().select("path").exceptAll(catalog.files().select("path")).isEmpty()
    return catalog.read().agg(F.lit(gone).cast("long").alias("expired"), F.count("*").alias("n_rows"), F.lit(same).alias("only_listed"))


@registered(f"{_RF} SELECT 'recompress' AS status, CAST(count(DISTINCT cell) AS BIGINT) AS buckets, CAST(count(*) AS BIGINT) AS n_rows FROM rf WHERE year = '1997'")
def catalog_repair(spark, sf_dir):
    catalog = _RegionCatalog.create(spark, scratch(spark, "repair"), _Regions({}))
    catalog.append(fanout.fan_out(_stored(spark, sf_dir, "1").where("year(datetime) != 1997"), catalog.grid()))
    catalog.append(fanout.fan_out(_stored(spark, sf_dir, "1").where("year(datetime) = 1997"), catalog.grid()), codec="snappy")
    plan = maintenance.repair_plan(catalog).join(catalog.files(), "path")
    found = plan.groupBy("status").agg(F.countDistinct("grid_partition").alias("buckets"), F.sum("rows").alias("n_rows"))
    found = spark.createDataFrame(found.collect(), found.schema)
    maintenance.repair_files(catalog)
    assert maintenance.repair_plan(catalog).isEmpty()
    return found


@registered(f"{_RF}, b AS (SELECT cell, year, count(*) AS n FROM rf GROUP BY cell, year) SELECT year, CAST(count(*) AS BIGINT) AS buckets, CAST(sum(n) AS BIGINT) AS unique_rows, CAST(sum(n % 7) AS BIGINT) AS duplicates FROM b GROUP BY year")
def compaction_by_year(spark, sf_dir):
    per = fanout.fan_out(_stored(spark, sf_dir, "1"), _Regions({k: box(*b) for k, *b in _REGIONS})).groupBy("grid_partition", "year").agg(F.count("*").alias("output_rows"))
    found = reports.rollup_by_year(per.withColumn("input_rows", F.col("output_rows") + F.col("output_rows") % 7))
    return found.select("year", "buckets", F.col("unique").alias("unique_rows"), "duplicates")


@registered(f"{_RF} SELECT cell, CAST(count(DISTINCT year) AS BIGINT) AS years, CAST(count(*) AS BIGINT) AS unique_rows FROM rf GROUP BY cell ORDER BY unique_rows DESC, cell LIMIT 3")
def compaction_by_cell(spark, sf_dir):
    per = fanout.fan_out(_stored(spark, sf_dir, "1"), _Regions({k: box(*b) for k, *b in _REGIONS})).groupBy("grid_partition", "year").agg(F.count("*").alias("output_rows"))
    return _cell(reports.rollup_by_cell(per.withColumn("input_rows", F.col("output_rows")), 3), "years", F.col("unique").alias("unique_rows"))


# ---------------------------------------------------------------- sources


_LISTED = f"{_INV} SELECT key, CAST(modified AS TIMESTAMP) AS modified FROM inv WHERE key LIKE '%.stac.json' AND (modified IS NULL OR modified >= TIMESTAMP '1996-06-01')"


def _since(rows: DataFrame) -> DataFrame:
    return rows.select("key", F.col("last_modified").cast("timestamp_ntz").alias("modified"))


def _dated(spark, sf_dir) -> DataFrame:
    return _inventory(spark, sf_dir).withColumnRenamed("modified", inventory.MODIFIED)


@registered(_LISTED)
def source_csv(spark, sf_dir):
    path = scratch(spark, "inventory")
    files.write_csv(_dated(spark, sf_dir), path, quote_all=True)
    return _since(inventory.read_inventory(spark, path, "1996-06-01"))


@registered(f"{_INV} SELECT bucket, key FROM inv WHERE key LIKE '%.stac.json'")
def source_gzip_without_header(spark, sf_dir):
    path = scratch(spark, "inventory")
    _inventory(spark, sf_dir).select("bucket", "key").write.option("compression", "gzip").csv(path)
    return inventory.read_inventory(spark, path, "1996-06-01").select("bucket", "key")


@registered(_LISTED)
def source_parquet(spark, sf_dir):
    path = f"{scratch(spark, 'inventory')}.parquet"
    files.write_parquet(_dated(spark, sf_dir), path)
    return _since(inventory.read_inventory(spark, path, "1996-06-01"))


def _manifest(spark, sf_dir, kind: str) -> str:
    top = scratch(spark, "manifest")
    rows = _dated(spark, sf_dir).repartition(4, "key")
    rows.write.option("header", True).csv(f"{top}/data") if kind == "CSV" else rows.write.parquet(f"{top}/data")
    names = [n for n in files.list_names(spark, f"{top}/data") if n.startswith("part-")]
    files.write_report(spark, f"{top}/manifest.json", {"sourceBucket": "b", "fileFormat": kind, "files": [{"key": f"data/{n}", "size": k} for k, n in enumerate(names)]})
    return f"{top}/manifest.json"


@registered(_LISTED)
def source_csv_manifest(spark, sf_dir):
    return _since(inventory.read_inventory(spark, _manifest(spark, sf_dir, "CSV"), "1996-06-01"))


@registered(_LISTED)
def source_parquet_manifest(spark, sf_dir):
    return _since(inventory.read_inventory(spark, _manifest(spark, sf_dir, "Parquet"), "1996-06-01"))


def _documents(spark, sf_dir) -> DataFrame:
    """(body): scenes as item documents."""
    s = scenes(spark, sf_dir)
    corner = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax"), corner("xmin", "ymin"))
    when = F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    props = F.struct(when.alias("datetime"), "platform", when.alias("updated"), F.lit("81.0").alias("percent_valid_pixels"))
    return s.select(F.to_json(F.struct("id", F.lit("Feature").alias("type"), shape.alias("geometry"), props.alias("properties"))).alias("body"))


_ITEMS = f"WITH {SCENES} SELECT id, platform, CAST(dt AS TIMESTAMP) AS datetime, CAST(81 AS BIGINT) AS pixels, xmin, ymax FROM scenes"


def _parsed(rows: DataFrame) -> DataFrame:
    return rows.select("id", "platform", F.col("datetime").cast("timestamp_ntz").alias("datetime"), F.col("percent_valid_pixels").alias("pixels"), "xmin", "ymax")


@registered(_ITEMS)
def source_ndjson(spark, sf_dir):
    path = scratch(spark, "ndjson")
    files.append_ndjson(_documents(spark, sf_dir), path)
    return _parsed(fanout.parse_items(files.read_ndjson(spark, path).select("body")))


@registered(_ITEMS)
def source_legacy(spark, sf_dir):
    path = scratch(spark, "legacy")
    _documents(spark, sf_dir).withColumnRenamed("body", "raw_stac").write.parquet(path)
    catalog = Catalog.create(spark, scratch(spark, "catalog"), LatLonGrid(1))
    return _parsed(maintenance.migrate_legacy(catalog, path))


def _scripted():
    """A reader whose answer depends on the key's number: most are documents, some are absent, denied, busy at first, or no document."""
    asked: dict[str, int] = {}

    def read(bucket: str, key: str) -> bytes:
        n = int(key.rsplit("/S", 1)[1].split(".")[0])
        asked[key] = asked.get(key, 0) + 1
        if n % 11 == 0:
            raise fetch.NotThere(key)
        if n % 13 == 0:
            raise PermissionError(key)
        if n % 17 == 0:
            return b"<html>"
        if n % 19 == 0 and asked[key] == 1:
            return b"<Error>SlowDown"
        return json.dumps({"id": f"S{n}", "type": "Feature", "geometry": box(0, 0, 1, 1), "properties": {"datetime": "2020-01-01T00:00:00Z"}}).encode()

    return read


_ERROR = "CASE WHEN n % 11 = 0 THEN 'unknown' WHEN n % 13 = 0 THEN 'denied' WHEN n % 17 = 0 THEN 'unknown' END"
_KEYED = f"{_INV}, keyed AS (SELECT key, CAST(split_part(split_part(key, '/S', 2), '.', 1) AS BIGINT) AS n FROM inv WHERE key LIKE '%.stac.json')"


@registered(f"{_KEYED} SELECT key, CASE WHEN {_ERROR} IS NULL THEN 'S' || CAST(n AS VARCHAR) END AS id, {_ERROR} AS error FROM keyed")
def fetch_documents(spark, sf_dir):
    keys = _inventory(spark, sf_dir).where(C.is_item_key(F.col("key")))
    found = fetch.fetch(keys, _scripted, wait=0.0)
    return found.select("key", F.get_json_object("body", "$.id").alias("id"), F.split_part("error", F.lit(":"), F.lit(1)).alias("error"))


@registered(f"{_KEYED} SELECT CAST(count(*) FILTER ({_ERROR} IS NULL) * 4 AS BIGINT) AS n_rows, CAST(count(*) FILTER ({_ERROR} IS NOT NULL) AS BIGINT) AS pending, CAST(3 AS BIGINT) AS chunks, CAST(0 AS BIGINT) AS rows_of_second_run FROM keyed WHERE n <= 2000")
def backfill_with_failures(spark, sf_dir):
    top = scratch(spark, "backfill")
    rows = _inventory(spark, sf_dir).where(F.regexp_extract("key", r"/S(\d+)\.", 1).cast("long") <= 2000)
    rows.select("bucket", "key").write.csv(f"{top}/inventory")
    catalog = Catalog.create(spark, f"{top}/catalog", LatLonGrid(1))
    n = rows.where(C.is_item_key(F.col("key"))).count()
    run = lambda: ingest.backfill(catalog, f"{top}/inventory", _scripted, f"{top}/staging", chunk_rows=-(-n // 3), fetch={"wait": 0.0})
    first, second = run(), run()
    waiting = ingest.pending(catalog, f"{top}/staging").count()
    schema = "n_rows long, pending long, chunks long, rows_of_second_run long"
    return spark.createDataFrame([(catalog.read().count(), waiting, first["chunks"], second["rows"])], schema)


@registered(f"{_RF} SELECT id, cell, year FROM rf")
def stream_ingest(spark, sf_dir):
    top = scratch(spark, "stream")
    _documents(spark, sf_dir).repartition(4).write.text(f"{top}/in")
    catalog = _RegionCatalog.create(spark, f"{top}/catalog", _Regions({}))
    stream.start(catalog, stream.document_stream(spark, f"{top}/in", 2), f"{top}/checkpoint").awaitTermination()
    return catalog.read().select("id", F.col("grid_partition").alias("cell"), "year")


# ---------------------------------------------------------------- hash index and deltas


@registered("SELECT CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_distinct, CAST(16 AS BIGINT) AS bytes, true AS in_order FROM orders")
def hash_index_counts(spark, sf_dir):
    path = scratch(spark, "index")
    hashindex.write_index(hashindex.hashes_of(scenes(spark, sf_dir).select("id")), path)
    found = hashindex.read_index(spark, path)
    where = found.select("id_hash", F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.min("id_hash").alias("a"), F.max("id_hash").alias("b"))
    spans = [(bytes(r.a), bytes(r.b)) for r in where.orderBy("a").collect()]  # one row a file
    in_order = all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    return found.agg(F.count("*").alias("n"), F.countDistinct("id_hash").alias("n_distinct"), F.max(F.octet_length("id_hash")).cast("long").alias("bytes"), F.lit(in_order).alias("in_order"))


@registered("SELECT CAST(count(*) FILTER (o_orderkey % 3 > 0) AS BIGINT) AS before, CAST(count(*) FILTER (o_orderkey % 3 = 0) AS BIGINT) AS added, CAST(count(*) AS BIGINT) AS total FROM orders")
def hash_index_merge(spark, sf_dir):
    path = scratch(spark, "index")
    ids = scenes(spark, sf_dir).select("id")
    hashindex.write_index(hashindex.hashes_of(ids.where("cast(substring(id, 2) as long) % 3 > 0")), path)
    found = hashindex.merge_index(spark, path, ids.unionByName(ids).union(spark.createDataFrame([(None,)], "id string")))
    return spark.createDataFrame([tuple(found[k] for k in ("before", "added", "total"))], "before long, added long, total long")


@registered(f"""{_KEYED}, known AS (SELECT DISTINCT l_orderkey AS n FROM lineitem WHERE l_returnflag = 'A') SELECT key FROM keyed WHERE n NOT IN (SELECT n FROM known) AND (n % 2 = 0 OR n % 3 = 0)""")
def daily_delta(spark, sf_dir):
    """Two days: the second delta takes over what the first left pending."""
    top = scratch(spark, "delta")
    known = _table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").select(F.concat(F.lit("S"), F.col("l_orderkey").cast("string")).alias("id"))
    hashindex.write_index(hashindex.hashes_of(known), f"{top}/index")
    n = F.regexp_extract("key", r"/S(\d+)\.", 1).cast("long")
    for day, step in (("2026-01-01", 2), ("2026-01-02", 3)):
        delta.daily_delta(spark, _inventory(spark, sf_dir).where(n % step == 0), f"{top}/index", f"{top}/pending", day)
    (last,) = files.pending_deltas(spark, f"{top}/pending")
    return spark.read.schema(files.DELTA).parquet(last).select("key")


# ---------------------------------------------------------------- sinks, grids, geometry


@registered("WITH n AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders) SELECT kind, n, keys FROM n, (VALUES ('chunks'), ('csv'), ('ids'), ('ndjson'), ('parquet')) AS k(kind)")
def sink_round_trips(spark, sf_dir):
    top = scratch(spark, "sinks")
    ids = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"))
    body = ids.select(F.to_json(F.struct("id")).alias("body"))
    files.write_csv(ids, f"{top}/csv")
    files.append_ndjson(body.where("length(body) % 2 = 0"), f"{top}/ndjson")
    files.append_ndjson(body.where("length(body) % 2 = 1"), f"{top}/ndjson")
    files.write_ids(ids, f"{top}/ids")
    files.write_parquet(ids, f"{top}/parquet", if_rows=True)
    files.write_chunks(ids, f"{top}/chunks", 1000)
    read = {
        "csv": spark.read.option("header", True).schema("id string").csv(f"{top}/csv"),
        "ndjson": files.read_ndjson(spark, f"{top}/ndjson").select(F.get_json_object("body", "$.id").alias("id")),
        "ids": files.read_typed_csv(spark, f"{top}/ids"),
        "parquet": spark.read.parquet(f"{top}/parquet"),
        "chunks": spark.read.parquet(f"{top}/chunks"),
    }
    out = None
    for kind, df in read.items():
        part = df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.sum(F.col("id").cast("long")).alias("keys"))
        out = part if out is None else out.union(part)
    return out


@registered(
    f"WITH {_R} SELECT key, 'x' || CAST(cx AS VARCHAR) || 'y' || CAST(cy AS VARCHAR) AS cell FROM (SELECT *, unnest(range(GREATEST(0, LEAST(17, CAST(ceil((y0 + 90) / 10.0) AS BIGINT) - 1)), GREATEST(0, LEAST(17, CAST(floor((y1 + 90) / 10.0) AS BIGINT))) + 1)) AS cy"
    " FROM (SELECT *, unnest(range(GREATEST(0, LEAST(35, CAST(ceil((x0 + 180) / 10.0) AS BIGINT) - 1)), GREATEST(0, LEAST(35, CAST(floor((x1 + 180) / 10.0) AS BIGINT))) + 1)) AS cx FROM r))"
)
def grid_cover(spark, sf_dir):
    grid = LatLonGrid(1)
    return spark.createDataFrame([(k, c) for k, *b in _REGIONS for c in grid.cover(box(*b))], "key string, cell string")


@registered(f"{_RF} SELECT id, cell FROM rf")
def region_cells(spark, sf_dir):
    rows = fanout.fan_out(_stored(spark, sf_dir, "1"), _Regions({k: box(*b) for k, *b in _REGIONS}))
    return rows.select("id", F.col("grid_partition").alias("cell"))


@registered(f"WITH {SCENES} SELECT id FROM scenes WHERE xmin <= 20 AND xmax >= -20 AND ymin <= 60 AND ymax >= 30")
def footprint_filter(spark, sf_dir):
    return fanout.footprint_filter(_stored(spark, sf_dir, "1"), box(-20, 30, 20, 60)).select("id")


@registered(f"""{_RF}, p AS (SELECT DISTINCT cell, year, platform FROM rf) SELECT cell, year, CAST(row_number() OVER (PARTITION BY cell, year ORDER BY platform) AS BIGINT) AS place, platform FROM p""")
def order_within_files(spark, sf_dir):
    """Rows of a file come by platform: the order in which platforms first appear in each bucket's file."""
    rows = _shared_catalog(spark, sf_dir)
    found = rows.read(rows.files(1)).select("grid_partition", "year", "platform", F.monotonically_increasing_id().alias("n"), F.col("_metadata.file_path").alias("file"))
    first = found.groupBy("grid_partition", "year", "file", "platform").agg(F.min("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("grid_partition", "year", "file").orderBy("n")).cast("long")
    return _cell(first.withColumn("place", place), "year", "place", "platform").distinct()
