import gzip
import json

import pytest
from pyspark.sql import functions as F

from quadrille import cli, config
from quadrille.functions import columns as C
from quadrille.functions import geometry as geo
from quadrille.operators import dedup, delta, fanout, hashindex, reports
from quadrille.operators.grids import LatLonGrid
from quadrille.plans import geoparquet, ingest, maintenance, query
from quadrille.plans.catalog import Catalog, CatalogLocked, Conflict
from quadrille.schema import STORED
from quadrille.sources import fetch, files, inventory
from quadrille.streaming import ingest as stream


def item(name, year=2021, x=0.0, updated=None, **properties):
    return {"id": name, "type": "Feature", "stac_version": "1.0.0", "geometry": geo.box(x - 10, 60, x + 10, 70), "properties": {"datetime": f"{year}-06-15T00:00:00Z", "platform": "P1", "percent_valid_pixels": 80.0, "proj:code": "EPSG:3413", "updated": updated or f"{year}-07-01T00:00:00Z"} | properties, "assets": {"data": {"href": "s3://b/x.nc"}}, "links": []}


def documents(spark, *items):
    return spark.createDataFrame([(json.dumps(i),) for i in items], "body string")


@pytest.fixture
def catalog(spark, tmp_path):
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    return Catalog.create(spark, str(tmp_path / "cat"), LatLonGrid(1))


# ---------------------------------------------------------------- inventories


def test_csv_inventories(spark, tmp_path):
    rows = ["b,a/1.stac.json,2026-01-01T00:00:00.000Z", "", "b,a/2.stac.json,2026-04-20T00:00:00.000Z", '"b","a/3.stac.json",', "b,a/4.nc,2026-04-20T00:00:00.000Z", "b,a/5.stac.json,never"]
    head = tmp_path / "head.csv"
    head.write_text("\n".join(['"Bucket",key,last_modified_date', *rows]))
    bare = tmp_path / "bare.csv"
    bare.write_text("\n".join(rows))
    packed = tmp_path / "head.csv.gz"
    packed.write_bytes(gzip.compress(head.read_bytes()))
    keys = lambda path, **k: sorted(r.key[2] for r in inventory.read_inventory(spark, str(path), **k).collect())
    for path in (head, bare, packed):
        assert keys(path) == ["1", "2", "3", "5"]
    assert keys(head, since="2026-04-01") == keys(packed, since="2026-04-01") == ["2", "3", "5"]
    assert keys(bare, since="2026-04-01") == ["1", "2", "3", "5"]  # no header, no times
    assert keys(head, since="2026-04-20") == ["2", "3", "5"]  # at the moment itself
    assert len(keys(head, limit=2)) == 2 and keys(head, limit=0) == []


def test_parquet_and_manifest_inventories(spark, tmp_path):
    rows = spark.createDataFrame([("b", "x/1.stac.json", "2026-01-01T00:00:00Z"), ("b", "x/2.stac.json", None)], "bucket string, key string, last_modified_date string")
    rows.write.parquet(str(tmp_path / "one.parquet"))
    rows.select("bucket", "key", F.to_timestamp("last_modified_date").alias("last_modified_date")).write.parquet(str(tmp_path / "two.parquet"))
    rows.select("bucket", "key").write.parquet(str(tmp_path / "three.parquet"))
    for name, n in (("one", 1), ("two", 1), ("three", 2)):
        assert inventory.read_inventory(spark, str(tmp_path / f"{name}.parquet"), since="2026-02-01").count() == n
    manifest = {"sourceBucket": "s", "destinationBucket": "arn:aws:s3:::dest", "fileFormat": "Parquet", "files": [{"key": "one.parquet", "MD5checksum": "m", "size": 3}, {"key": "three.parquet", "MD5checksum": "n"}]}
    (tmp_path / "manifest.json").write_text(json.dumps(manifest, indent=1))
    assert inventory.parse_manifest(json.dumps(manifest))["files"][0] == {"bucket": "dest", "key": "one.parquet", "md5": "m", "size": 3}
    assert [(r.position, r.key, r.md5, r["size"]) for r in inventory.manifest_files(spark, str(tmp_path / "manifest.json")).collect()] == [(0, "one.parquet", "m", 3), (1, "three.parquet", "n", None)]
    (tmp_path / "manifest.json").write_text(json.dumps(manifest | {"files": [{"key": "one.parquet"}, {"key": "two.parquet"}]}))
    with pytest.raises(Exception):
        inventory.read_inventory(spark, str(tmp_path / "nothing.parquet")).count()


def test_column_functions(spark):
    rows = spark.createDataFrame([("a/b/item-1.stac.json",), ("x.nc",), (None,)], "key string")
    got = [tuple(r) for r in rows.select(C.is_item_key(F.col("key")), C.id_of_key(F.col("key")), C.item_key_of(F.col("key"))).collect()]
    assert got == [(True, "item-1", "a/b/item-1.stac.json"), (False, "x.nc", "x.nc.stac.json"), (False, None, None)]
    times = spark.createDataFrame([("2021-12-31T23:30:00-02:00",), ("2020-01-02T03:04:05.678Z",), ("2020-01-02",), ("bad",), (None,)], "t string")
    assert [None if r[0] is None else r[0] for r in times.select(C.utc_timestamp(F.col("t")).cast("string")).collect()] == ["2021-12-31 23:30:00", "2020-01-02 03:04:05.678", "2020-01-02 00:00:00", None, None]
    assert C.hash_id("item-1").hex() == "531fdc248680ebb5a14d3481f4a2b986"
    assert [r.id_hash for r in C.with_id_hash(spark.createDataFrame([("item-1",), (None,)], "id string")).collect()] == [C.hash_id("item-1"), None]


# ---------------------------------------------------------------- fetch


def test_fetch_retries_and_errors():
    calls = []

    def scripted(answers):
        answers = list(answers)

        def read(bucket, key):
            calls.append(key)
            a = answers.pop(0)
            if isinstance(a, Exception):
                raise a
            return a

        return read

    ask = lambda *answers: fetch.fetch_one(scripted(answers), "b", "k", sleep=lambda s: None)
    assert ask(b'{"id": 1}') == ('{"id": 1}', None)
    assert ask(b"<Error>SlowDown", OSError("net"), b"{}") == ("{}", None)
    assert ask(b"<html>") == (None, "unknown") and ask(fetch.NotThere()) == (None, "unknown")
    calls.clear()
    assert ask(PermissionError("no"))[1].startswith("denied") and len(calls) == 1
    calls.clear()
    assert ask(*[OSError("net")] * 4)[1] == "OSError: net" and len(calls) == 4


def test_ingest_from_objects(spark, catalog, tmp_path):
    store = tmp_path / "objects" / "b"
    store.mkdir(parents=True)
    for k in range(5):
        (store / f"i{k}.stac.json").write_text(json.dumps(item(f"i{k}", 2020 + k % 2, 20.0 * k)))
    (store / "bad.stac.json").write_text("<html>")
    (tmp_path / "inv.csv").write_text("\n".join(["bucket,key", *[f"b,i{k}.stac.json" for k in range(5)], "b,bad.stac.json", "b,gone.stac.json", "b,readme.txt"]))
    root = str(tmp_path / "objects")
    report = ingest.ingest_inventory(catalog, str(tmp_path / "inv.csv"), lambda: fetch.object_reader(root), dead_letters=str(tmp_path / "dead"))
    assert report["source_items"] == 7 and report["failed"] == 2 and report["snapshot"] == 1
    assert {r.id for r in catalog.read().select("id").collect()} == {f"i{k}" for k in range(5)}
    assert catalog.read().count() == report["rows"] == catalog.files().agg(F.sum("rows")).first()[0]
    assert {r.key for r in spark.read.parquet(str(tmp_path / "dead")).collect()} == {"bad.stac.json", "gone.stac.json"}
    other = Catalog.create(spark, str(tmp_path / "cat2"), LatLonGrid(1))
    first = ingest.backfill(other, str(tmp_path / "inv.csv"), lambda: fetch.object_reader(root), str(tmp_path / "stage"), chunk_rows=3)
    assert first["chunks"] >= 2 and first["rows"] == report["rows"]
    again = ingest.backfill(other, str(tmp_path / "inv.csv"), lambda: fetch.object_reader(root), str(tmp_path / "stage"), chunk_rows=3)
    assert again["skipped"] == first["chunks"] and again["rows"] == 0
    assert ingest.pending(other, str(tmp_path / "stage")).count() == 2
    # A run that died before its marker commits nothing twice.
    for name in (tmp_path / "stage" / "done").iterdir():
        name.unlink()
    snapshots = len(other.snapshots())
    assert ingest.backfill(other, str(tmp_path / "inv.csv"), lambda: fetch.object_reader(root), str(tmp_path / "stage"), chunk_rows=3)["rows"] == 0 and len(other.snapshots()) == snapshots
    # What failed is asked for again, and is pending no more once it has come.
    (store / "gone.stac.json").write_text(json.dumps(item("late", 2021, 40.0)))
    assert ingest.backfill(other, str(tmp_path / "inv.csv"), lambda: fetch.object_reader(root), str(tmp_path / "stage"), chunk_rows=3)["retried"] == 2
    assert {r.key for r in ingest.pending(other, str(tmp_path / "stage")).collect()} == {"bad.stac.json"} and other.read().where("id = 'late'").count() > 0
    # A chunk folder whose write was not completed is made again.
    (tmp_path / "stage2" / "chunks" / "chunk=0").mkdir(parents=True)
    third = Catalog.create(spark, str(tmp_path / "cat3"), LatLonGrid(1))
    assert ingest.backfill(third, str(tmp_path / "inv.csv"), lambda: fetch.object_reader(root), str(tmp_path / "stage2"), chunk_rows=100)["rows"] > report["rows"]
    ingest.clean_up(other, str(tmp_path / "stage"))
    assert ingest.pending(other, str(tmp_path / "stage")).count() == 0


# ---------------------------------------------------------------- catalogue


def test_round_trip_keeps_types(spark, catalog):
    odd = item("odd", platform=None, percent_valid_pixels=12.0, **{"sat:orbit_state": "ascending", "latitude": 65.0})
    bad = item("bad") | {"geometry": {"type": "Polygon", "coordinates": []}}
    timeless = item("timeless")
    timeless["properties"] = {}
    report = ingest.ingest_documents(catalog, documents(spark, item("a"), odd, bad, timeless, item("far", 2019, 100.0)))
    rows = catalog.read()
    assert rows.columns[: len(STORED) - 1] == [f.name for f in STORED if f.name != "grid_partition"]
    got = {r.id: r for r in rows.where("grid_partition = 'x17y15'").collect()}
    assert set(got) == {"a", "odd", "timeless"} and got["a"].percent_valid_pixels == 80 and got["odd"].latitude == 65.0
    assert got["timeless"].year == "unknown" and got["a"].year == "2021" and got["a"]["proj:code"] == "EPSG:3413"
    assert json.loads(got["a"].assets)["data"]["href"] == "s3://b/x.nc" and json.loads(got["a"].bbox) == [-10, 60, 10, 70]
    assert geo.from_wkb(bytes(got["a"].geometry))["type"] == "Polygon"
    per_item = {r.id: r.n for r in rows.groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert per_item["a"] == 12 and report["rows"] == sum(per_item.values())
    assert catalog.statistics().agg(F.sum("rows")).first()[0] == report["rows"]
    assert catalog.files().agg(F.sum("rows")).first()[0] == rows.count()


def test_snapshots_conflicts_and_register(spark, catalog):
    assert catalog.current() is None and catalog.files().count() == 0 and catalog.read().count() == 0
    ingest.ingest_documents(catalog, documents(spark, item("a")))
    ingest.ingest_documents(catalog, documents(spark, item("b", 2022)))
    assert [s["id"] for s in catalog.snapshots()] == [1, 2] and catalog.files(1).count() < catalog.files().count()
    with pytest.raises(Conflict):
        catalog.commit(catalog.files(), "late", based_on=1)
    before = {tuple(r) for r in catalog.files().select("path", "rows", "grid_partition", "year").collect()}
    catalog.register()
    assert {tuple(r) for r in catalog.files().select("path", "rows", "grid_partition", "year").collect()} == before
    some = catalog.files().limit(2)
    catalog.commit(catalog.files(1).limit(0), "empty")
    catalog.register_new(some.select("path"))
    assert catalog.files().count() == 2
    again = Catalog.create(spark, catalog.root, LatLonGrid(3), note="x")
    assert again.properties()["grid.resolution"] == "1" and again.properties()["note"] == "x" and again.grid().resolution == 1


def test_queries_prune_and_find(spark, catalog):
    items = [item(f"s{i}", 2018 + i % 4, -50.0 + 5 * i) for i in range(10)]
    ingest.ingest_documents(catalog, documents(spark, *items))
    area = geo.box(-60, 60, -30, 80)
    want = {i["id"] for i in items if geo.intersects(i["geometry"], area)}
    rows = query.search(catalog, area)
    assert {r.id for r in rows.select("id").collect()} == want
    assert query.search(catalog, area, distinct_items=True).count() == len(want) < rows.count()
    assert query.search(catalog, geo.box(170, -10, 175, 0)).count() == 0 and query.file_paths(catalog, geo.box(170, -10, 175, 0)) == []
    every, some, late = query.file_paths(catalog), query.file_paths(catalog, area), query.file_paths(catalog, area, start="2020-01-01")
    assert set(late) < set(some) < set(every)
    assert {r.year for r in query.search(catalog, area, "2020-01-01", "2020-12-31").select("year").collect()} == {"2020"}
    assert query.search(catalog, area, start="2021-06-15", end="2021-06-15T00:00:00Z").count() > 0  # both ends included
    assert query.search(catalog, where=query.cql("platform = 'P1' AND percent_valid_pixels > 79")).count() == catalog.read().count()
    assert query.search(catalog, where=query.cql("NOT (platform LIKE 'P%') OR id IN ('none')")).count() == 0
    plan = query.search(catalog, area, "2020-01-01")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(grid_partition" in plan or "PartitionFilters: [grid_partition" in plan
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(datetime" in plan
    with pytest.raises(ValueError):
        query.cql("platform ~ 3")


def test_lock(catalog):
    with catalog.lock("one"):
        with pytest.raises(CatalogLocked):
            catalog.lock("two").acquire()
    catalog.lock("old", ttl_hours=-1).acquire()
    with catalog.lock("new") as held:
        report = files.read_report(catalog.spark, held.path)
        assert report["owner"] == "new" and {"pid", "hostname", "acquired", "ttl_hours"} <= set(report)
    assert not files.exists(catalog.spark, held.path)


# ---------------------------------------------------------------- maintenance


def test_compact(spark, catalog):
    for day, names in ((1, "abc"), (2, "ade")):
        ingest.ingest_documents(catalog, documents(spark, *[item(n, updated=f"2021-08-0{day}T00:00:00Z", version=str(day)) for n in names]))
    buckets = catalog.files().select("grid_partition", "year").distinct().count()
    dry = maintenance.compact(catalog, dry_run=True)
    assert dry["buckets_compacted"] == buckets and catalog.files().count() == 2 * buckets
    report = maintenance.compact(catalog)
    assert report["files_after"] == buckets and report["duplicates_removed"] == buckets
    rows = catalog.read()
    assert {r.id for r in rows.select("id").collect()} == set("abcde") and rows.groupBy("grid_partition", "year", "id").count().where("count > 1").count() == 0
    assert {r.version for r in rows.where("id = 'a'").select("version").collect()} == {"2"}
    assert catalog.properties()["grid.resolution"] == "1" and {r.kind for r in catalog.files().select(C.file_class(F.col("path")).alias("kind")).collect()} == {"compacted"}
    assert maintenance.compact(catalog)["buckets_compacted"] == 0
    # Old files stay until their snapshots are out of grace.
    assert maintenance.expire(catalog, 1.0) == 0 and maintenance.remove_orphans(catalog, False, 0.0).count() == 0
    assert catalog.read(catalog.files(1)).count() > 0 and maintenance.expire(catalog, 0.0) == 2
    assert maintenance.remove_orphans(catalog, False, 1.0).count() == 0
    assert maintenance.remove_orphans(catalog, False, 0.0).count() == 2 * buckets
    assert catalog.describe_files().count() == buckets and catalog.read().count() == report["output_rows"]
    found = reports.validate(catalog)
    assert found["unmatched"].count() == 0 and found["ids"].first().unique == 5


def test_readers_keep_their_files_while_others_compact(spark, catalog):
    for n in "ab":
        ingest.ingest_documents(catalog, documents(spark, item(n)))
    rows = catalog.read()
    before = rows.count()
    maintenance.compact(catalog)
    assert rows.count() == before > 0


def test_commits_that_come_between_are_not_lost(spark, catalog):
    ingest.ingest_documents(catalog, documents(spark, item("a")))
    made = fanout.fan_out(fanout.parse_items(documents(spark, item("b"))), catalog.grid())
    added = catalog.write_rows(made)
    turns = []

    def slow(listed):
        if not turns:  # another writer commits after this one has read the manifest
            turns.append(1)
            ingest.ingest_documents(catalog, documents(spark, item("c")))
        return listed.unionByName(added)

    catalog.change(slow, "slow")
    assert {r.id for r in catalog.read().select("id").collect()} == set("abc")
    gone = catalog.files().limit(1)
    listed = spark.createDataFrame(gone.collect(), gone.schema)
    catalog.replace_files(listed, listed.limit(0), "drop")
    with pytest.raises(RuntimeError):
        catalog.replace_files(listed, listed.limit(0), "drop again")


def test_compaction_checks_what_it_read_and_wrote(spark, catalog):
    for n in "ab":
        ingest.ingest_documents(catalog, documents(spark, item(n)))
    now = catalog.current()["id"]
    with pytest.raises(RuntimeError):  # a dedup that loses rows
        maintenance._rewrite(catalog, maintenance._fixed(catalog, catalog.files()), "updated", "bad", dedup=lambda df: df.where("id = 'a'"))
    first = catalog.files().first().path
    files.remove(spark, first)
    with pytest.raises(Exception):
        maintenance.compact(catalog)
    assert catalog.current()["id"] == now


def test_finish_makes_one_compacted_file_of_every_bucket(spark, catalog):
    ingest.ingest_documents(catalog, documents(spark, item("a"), item("b", 2022)))
    maintenance_report = maintenance.finish(catalog)
    assert maintenance_report["files_before"] == maintenance_report["files_after"] == 24
    assert maintenance.finish(catalog)["files_before"] == 0
    results = spark.createDataFrame([("c1", "2021", 10, 8), ("c1", "2022", 5, 5), ("c2", "2021", 2, 1)], "grid_partition string, year string, input_rows long, output_rows long")
    assert {r.year: (r.buckets, r.unique, r.duplicates) for r in reports.rollup_by_year(results).collect()} == {"2021": (2, 9, 3), "2022": (1, 5, 0)}
    top = reports.rollup_by_cell(results, 1).first()
    assert (top.grid_partition, top.years, top.unique) == ("c1", 2, 13) and abs(top.duplicate_pct - 100 * 2 / 15) < 1e-9


def test_part_numbers_follow_commits(spark, catalog):
    for n in "ab":
        ingest.ingest_documents(catalog, documents(spark, item(n)))
    assert {r.next_part for r in reports.next_part(catalog.files()).collect()} == {3}
    odd = spark.createDataFrame([("c", "2021", "x/part_4adb.parquet"), ("c", "2021", "x/part_000002.parquet")], "grid_partition string, year string, path string")
    assert reports.next_part(odd).first().next_part == 3


def test_repair_in_place(spark, catalog):
    ingest.ingest_documents(catalog, documents(spark, item("a"), item("b", 2022)))
    where = f"{catalog.data}/grid_partition=x17y15/year=2021"
    documents(spark, item("raw")).withColumnRenamed("body", "raw_stac").coalesce(1).write.mode("append").parquet(where)
    plain = catalog.read().where("grid_partition = 'x17y15' and year = '2021'").drop("grid_partition", "year")
    plain.withColumn("id", F.lit("soft")).coalesce(1).write.mode("append").option("compression", "snappy").parquet(where)
    catalog.register()
    before = catalog.files().agg(F.sum("rows")).first()[0]
    assert {r.status for r in maintenance.repair_plan(catalog).collect()} == {"raw-document", "recompress"}
    report = maintenance.repair_files(catalog)
    assert report["files"] == 2 and report["rows"] == 2 and catalog.files().agg(F.sum("rows")).first()[0] == before
    got = {r.id: r for r in catalog.read().where("grid_partition = 'x17y15' and year = '2021'").collect()}
    assert set(got) == {"a", "raw", "soft"} and got["raw"].platform == "P1"
    assert maintenance.repair_files(catalog)["files"] == 0


def manifest(spark, counts):
    return spark.createDataFrame([(f"part_{i:06d}", "c", "2021", n, 1, None, None) for i, n in enumerate(counts)], "path string, grid_partition string, year string, rows long, bytes long, min_datetime timestamp, max_datetime timestamp")


@pytest.mark.parametrize("counts,limit,merged", [((5, 3, 2), 10, 3), ((100, 3), 10, 0), ((100, 24, 2), 100, 2), ((5,), 10, 0), ((100, 3, 100), 100, 2)])
def test_tail_plan(spark, counts, limit, merged):
    assert maintenance.tail_plan(manifest(spark, counts), limit).count() == merged


def test_consolidate(spark, catalog):
    for k in range(3):
        ingest.ingest_documents(catalog, documents(spark, item(f"i{k}"), item("shared")))
    report = maintenance.consolidate(catalog, rows_per_file=10)
    assert report["partitions_consolidated"] == 12 and report["output_rows"] == 12 * 4 and catalog.files().count() == 12
    assert maintenance.consolidate(catalog, rows_per_file=10)["files_merged"] == 0


def test_rows_per_file(spark, catalog):
    rows = fanout.fan_out(fanout.parse_items(documents(spark, *[item(f"i{k}", x=175.0) for k in range(5)])), catalog.grid()).where("grid_partition = 'x35y15'")
    added = catalog.write_rows(rows, rows_per_file=2)
    assert sorted(r.rows for r in added.collect()) == [1, 2, 2]


def test_migration_and_repair(spark, catalog, tmp_path):
    old = documents(spark, item("a", grid_partition="cell0"), item("b")).withColumnRenamed("body", "raw_stac")
    old.write.parquet(str(tmp_path / "old"))
    rows = maintenance.migrate_legacy(catalog, str(tmp_path / "old"))
    assert {r.id: r.grid_partition for r in rows.collect()} == {"a": "cell0", "b": None} and "raw_stac" not in rows.columns
    with pytest.raises(ValueError):
        files.read_legacy(_parquet(spark, tmp_path), str(tmp_path / "plain"))
    broken = spark.createDataFrame([("a", '{"xmin": 1, "ymin": 2, "xmax": 3, "ymax": 4}', 5.0), ("b", "[1,2,3,4]", None)], "id string, bbox string, date_dt double")
    broken.write.parquet(str(tmp_path / "w/grid_partition=c1/year=2021"))
    fixed = maintenance.repair(spark.read.parquet(str(tmp_path / "w/grid_partition=c1/year=2021")))
    assert fixed.schema == STORED
    got = {r.id: r for r in fixed.collect()}
    assert json.loads(got["a"].bbox) == [1, 2, 3, 4] and got["a"].grid_partition == "c1" and got["a"].date_dt == 5
    assert maintenance.repair_status(["raw_stac"], {"ZSTD"}, None) == "raw-document" and maintenance.repair_status(["id"], {"SNAPPY"}, None) == "recompress"
    assert maintenance.repair_status(["grid_partition"], {"ZSTD"}, "object") == "bbox" and maintenance.repair_status(["id"], {"ZSTD"}, None) == "cell"


def _parquet(spark, tmp_path):
    spark.range(1).write.mode("overwrite").parquet(str(tmp_path / "plain"))
    return spark


def test_geo_footer_writer(spark, catalog):
    rows = fanout.fan_out(fanout.parse_items(documents(spark, *[item(f"i{k}", x=10.0 * k) for k in range(6)])), catalog.grid())
    added = catalog.write_rows(rows, rows_per_file=2)
    catalog.commit(added, "append")
    assert catalog.read().count() == rows.count() == added.agg(F.sum("rows")).first()[0]
    assert added.agg(F.max("rows")).first()[0] == 2
    first = added.first()
    assert geoparquet.footer(first.path.removeprefix("file:"))["primary_column"] == "geometry"
    assert "stac-geoparquet:version" in geoparquet.footer(first.path.removeprefix("file:"), "stac-geoparquet")
    assert query.search(catalog, geo.box(-5, 61, 5, 62), distinct_items=True).count() == 2
    described = {r.path.split("/data/")[1]: r.rows for r in catalog.describe_files().collect()}
    assert described == {r.path.split("/data/")[1]: r.rows for r in added.collect()}
    assert catalog.write_rows(rows.limit(0)).count() == 0
    seen = []

    def own_writer(rows, data, listing, **options):
        seen.append(options["kind"])
        return geoparquet.write_files(rows, data, listing, **options)

    assert catalog.write_rows(rows, own_writer, kind="other").count() > 0 and seen == ["other"]
    catalog.writer = own_writer
    catalog.append(rows, kind="part")
    maintenance.compact(catalog)
    assert seen == ["other", "part", "compacted"]


def test_reports_of_a_catalogue(spark, catalog, tmp_path):
    ingest.ingest_documents(catalog, documents(spark, item("a"), item("b", 2022)))
    found = reports.describe(catalog)
    assert found["summary"].first().files == 24 and found["fragmented"].first().buckets == 0
    assert found["largest"].count() == 15 and {r.year for r in found["years"].collect()} == {"2021", "2022"}
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    both = reports.compare_sources(ids("p_1", "p_2", "q_3", ""), ids("p_1", "z"))
    assert both["counts"].first().asDict() == {"a": 4, "b": 2, "both": 1, "only_a": 3, "only_b": 1}
    assert [r.prefix for r in both["prefixes"].collect()] == ["", "p", "q"] and both["blank"].count() == 1
    (tmp_path / "j").mkdir()
    for n in ("b.json", "a.json", "c.txt"):
        (tmp_path / "j" / n).write_text('{"id": "%s"}' % n)
    assert [tuple(r) for r in inventory.inventory_of(spark, str(tmp_path / "j"), "bk").collect()] == [("bk", "a.json"), ("bk", "b.json")]


# ---------------------------------------------------------------- dedup, index, delta


def test_dedup_rules(spark):
    rows = spark.createDataFrame([("c", "2021", "a", "2024-01-01", 1), ("c", "2021", "a", "2024-06-01", 2), ("c", "2021", "b", None, 3), ("d", "2021", "a", "2023-01-01", 4), ("c", "2021", None, "x", 5), ("c", "2021", None, "y", 6)], "grid_partition string, year string, id string, updated string, n int")
    kept = lambda df: sorted(r.n for r in df.collect())
    assert kept(dedup.latest(rows)) == [2, 3, 4, 6]
    assert kept(dedup.first_seen(rows, ["n"])) == [1, 3, 4, 5]
    assert kept(dedup.strictly_latest(rows, "updated", ["n"])) == [2, 3, 6]
    assert dedup.latest(rows, "created").count() == 6


def test_hash_index_and_delta(spark, tmp_path):
    index, folder = str(tmp_path / "index.parquet"), str(tmp_path / "pending")
    assert hashindex.read_index(spark, index).count() == 0
    known = spark.createDataFrame([("i1",), ("i2",), ("i2",), (None,)], "id string")
    assert hashindex.merge_index(spark, index, known) == {"before": 0, "added": 2, "total": 2}
    hashes = [bytes(r.id_hash) for r in hashindex.read_index(spark, index).collect()]
    assert hashes == sorted(hashes) and all(len(h) == 16 for h in hashes)
    # A version without its pointer (the writer died) changes nothing.
    spark.createDataFrame([(b"x" * 16,)], "id_hash binary").write.parquet(f"{index}/v-dead")
    assert hashindex.read_index(spark, index).count() == 2
    assert hashindex.merge_from_keys(spark, index, spark.createDataFrame([("p/i2.stac.json",), ("p/i9.stac.json",)], "key string"))["added"] == 1
    inv = lambda *names: spark.createDataFrame([("b", f"p/{n}.stac.json") for n in names], "bucket string, key string")
    one = delta.daily_delta(spark, inv("i1", "i2", "i3"), index, folder, "2026-01-01")
    assert one["status"] == "written" and one["new"] == 1 and one["rows"] == 1
    assert delta.daily_delta(spark, inv("i8"), index, folder, "2026-01-01")["status"] == "exists"
    two = delta.daily_delta(spark, inv("i3", "i4", "i1"), index, folder, "2026-01-02")
    assert two["rows"] == 2 and two["superseded"] == 1 and files.pending_deltas(spark, folder) == [two["path"]]
    files.remove(spark, two["path"])
    assert delta.daily_delta(spark, None, index, folder, "2026-01-02")["inventory_reused"]
    assert delta.daily_delta(spark, inv("i1"), str(index), str(tmp_path / "other"), "2026-01-03")["status"] == "empty"


def test_audit(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    flags = reports.audit(ids("a", "b"), ids("b", "c"), ids("c", "d"))
    assert {tuple(r) for r in flags.collect()} == {("a", True, False, False), ("b", True, True, False), ("c", False, True, True), ("d", False, False, True)}
    inv = spark.createDataFrame([("a", "bk", "k/a.stac.json"), ("b", "bk", "k/b.stac.json")], "id string, bucket string, key string")
    db = spark.createDataFrame([("b", "s3://z/b.nc"), ("c", "s3://z/c.nc")], "id string, href string")
    assert sorted(tuple(r) for r in reports.audit_delta(flags, inv, db).collect()) == [("bk", "k/a.stac.json"), ("bk", "k/b.stac.json")]
    numbers = lambda *x: reports.contiguous_prefix(spark.createDataFrame([(i,) for i in x], "n int"), "n").first().last
    assert numbers(0, 1, 2, 4) == 2 and numbers(3) == -1 and numbers(0, 0, 1) == 1
    long = spark.range(0, 200_000).where("id != 150000").toDF("n")
    assert reports.contiguous_prefix(long, "n").first().last == 149_999


# ---------------------------------------------------------------- stream, CLI, config


def test_stream(spark, catalog, tmp_path):
    folder, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")
    folder.mkdir()
    (folder / "1.ndjson").write_text("\n".join(json.dumps(item(n)) for n in "ab") + "\n\n")
    for n in (2, 2):
        q = stream.start(catalog, stream.document_stream(spark, str(folder)), checkpoint)
        q.awaitTermination(120)
        assert catalog.read().select("id").distinct().count() == n and len(catalog.snapshots()) == 1
    (folder / "2.ndjson").write_text(json.dumps(item("c")))
    stream.start(catalog, stream.document_stream(spark, str(folder)), checkpoint).awaitTermination(120)
    assert catalog.read().select("id").distinct().count() == 3 and len(catalog.snapshots()) == 2


def test_cli(spark, catalog, tmp_path, capsys):
    ingest.ingest_documents(catalog, documents(spark, item("a"), item("b", 2022)))
    run = lambda *a: (cli.main(["--root", catalog.root, *a], spark), json.loads(capsys.readouterr().out.strip().splitlines()[-1]))[1]
    assert run("stats")["files"] == 24
    assert {r["id"] for r in run("query", "--geometry", "POINT (1 65)", "--start", "2022-01-01", "--distinct")} == {"b"}
    assert run("compact", "--dry-run")["buckets_scanned"] == 24
    assert run("index", str(tmp_path / "ix"))["hashes"] == 2
    assert run("register")["snapshot"] == 2
    assert run("finish")["files_after"] == 24 and run("expire", "--grace-hours", "0")["files"] == 24
    assert run("repair", "--dry-run") == [] and {"summary", "ids"} <= set(run("validate"))
    (tmp_path / "a.csv").write_text("bucket,key\nb,p/a.stac.json\nb,p/z.stac.json\n")
    (tmp_path / "b.csv").write_text("bucket,key\nb,p/a.stac.json\n")
    spark.createDataFrame([("b", "s3://k/b.nc")], "id string, href string").write.parquet(str(tmp_path / "db.parquet"))
    assert run("index-update", str(tmp_path / "ix"), str(tmp_path / "a.csv")) == {"before": 2, "added": 1, "total": 3}
    assert run("compare", "--a", str(tmp_path / "a.csv"), "--b", str(tmp_path / "b.csv"))["counts"][0]["only_a"] == 1
    assert len(run("audit", "--inventory", str(tmp_path / "a.csv"), "--database", str(tmp_path / "db.parquet"), "--out", str(tmp_path / "lack.parquet"))) == 3
    assert [r.key for r in spark.read.parquet(str(tmp_path / "lack.parquet")).collect()] == ["p/z.stac.json"]
    for name, sizes in (("m1", (1, 2)), ("m2", (1, 3))):
        (tmp_path / f"{name}.json").write_text(json.dumps({"files": [{"key": f"k{i}", "MD5checksum": "m", "size": n} for i, n in enumerate(sizes)]}))
    assert run("diff", str(tmp_path / "m1.json"), str(tmp_path / "m2.json")) == [{"status": "changed", "files": 1}, {"status": "same", "files": 1}]


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("place: {root: r, resolution: 2}\nwriting: {rows_per_file: 5}\n")
    s = config.read({"reading": {"retries": 1}}, config.load(str(tmp_path / "c.yaml")))
    assert s.place.root == "r" and s.place.resolution == 2 and s.write_options() == {"rows_per_file": 5, "codec": "zstd"}
    assert s.fetch_options() == {"concurrency": 64, "retries": 1, "wait": 0.5}
    for bad in ({"place": {"x": 1}}, {"other": {}}):
        with pytest.raises(ValueError):
            config.read(bad)


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", "b,c")], "id string, body string")
    files.write_csv(rows, str(tmp_path / "c"), quote_all=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first().body == "b,c"
    for _ in range(2):
        files.append_ndjson(rows, str(tmp_path / "n"))
    assert files.read_ndjson(spark, str(tmp_path / "n")).count() == 2
    files.write_ids(rows, str(tmp_path / "i"))
    assert files.read_typed_csv(spark, str(tmp_path / "i")).first().id == "a"
    assert not files.write_parquet(rows.limit(0), str(tmp_path / "e"), if_rows=True)
    files.write_report(spark, str(tmp_path / "r.json"), {"n": 1})
    assert files.read_report(spark, str(tmp_path / "r.json")) == {"n": 1} and files.read_report(spark, str(tmp_path / "none.json")) is None
    files.write_chunks(spark.range(5).coalesce(1), str(tmp_path / "k"), 2)
    assert spark.read.parquet(str(tmp_path / "k")).count() == 5
