"""Command line of the catalogue; every command prints one JSON line."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from . import config
from .operators import delta, hashindex, joins, reports
from .operators.grids import make_grid
from .plans import ingest, maintenance, query
from .plans.catalog import Catalog
from .session import build_session
from .sources import files as io
from .sources.fetch import object_reader
from .sources.inventory import keys_with_ids_of, manifest_files, read_inventory

#: Options that stand for settings: (option, group, name, type).
SETTINGS = [("--resolution", "place", "resolution", int), ("--concurrency", "reading", "concurrency", int), ("--retries", "reading", "retries", int), ("--chunk-rows", "reading", "chunk_rows", int), ("--rows-per-file", "writing", "rows_per_file", int), ("--codec", "writing", "codec", str), ("--keep", "writing", "keep", str)]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quadrille", description=__doc__)
    p.add_argument("--config")
    p.add_argument("--root", help="the catalogue's folder")
    for option, _, _, kind in SETTINGS:
        p.add_argument(option, type=kind)
    commands = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: str, needed: tuple[str, ...] = (), flags: tuple[str, ...] = (), numbers: dict[str, int | float | None] | None = None, places: tuple[str, ...] = ()) -> None:
        c = commands.add_parser(name)
        for x in places:
            c.add_argument(x)
        for x in needed:
            c.add_argument(x, required=True)
        for x in options:
            c.add_argument(x)
        for x in flags:
            c.add_argument(x, action="store_true")
        for x, value in (numbers or {}).items():
            c.add_argument(x, type=float if isinstance(value, float) else int, default=value)

    command("ingest", "--since", "--dead-letters", needed=("--objects",), numbers={"--limit": None}, places=("inventory",))
    command("backfill", "--since", needed=("--objects", "--staging"), places=("inventory",))
    command("query", "--geometry", "--start", "--end", "--filter", flags=("--distinct",), numbers={"--limit": 20})
    command("compact", flags=("--dry-run",), numbers={"--threshold": 2})
    command("finish")
    command("consolidate", flags=("--dry-run",), numbers={"--rows": 100_000, "--threshold": 2})
    command("repair", flags=("--dry-run",))
    command("expire", flags=("--dry-run",), numbers={"--grace-hours": 24.0})
    command("delta", needed=("--index", "--folder", "--date"), places=("inventory",))
    command("audit", "--out", needed=("--inventory", "--database"))
    command("compare", needed=("--a", "--b"))
    command("diff", "--out", places=("old", "new"))
    command("index", places=("path",))
    command("index-update", places=("path", "inventory"))
    command("register", "--files", "--index")
    command("validate")
    command("stats")
    return p


def _ids(spark, path: str):
    """(id) of an inventory, or of a text or Parquet list of ids."""
    if path.endswith((".csv", ".csv.gz", "manifest.json")):
        return keys_with_ids_of(read_inventory(spark, path)).select("id")
    return spark.read.parquet(path).select("id") if path.endswith(".parquet") else io.read_typed_csv(spark, path)


def _rows(df, n: int = 20) -> list[dict]:
    return [r.asDict() for r in df.limit(n).collect()]


def main(argv: list[str] | None = None, spark=None) -> int:
    a = parser().parse_args(argv)
    given: dict[str, dict] = {"place": {"root": a.root} if a.root else {}}
    for option, group, name, _ in SETTINGS:
        value = getattr(a, option[2:].replace("-", "_"))
        if value is not None:
            given.setdefault(group, {})[name] = value
    s = config.read(given, config.load(a.config) if a.config else config.Settings())
    spark = spark or build_session()
    place = s.place
    catalog = Catalog.create(spark, place.root, make_grid(spark, place.grid, place.resolution, place.regions, place.region_id))
    write = s.write_options()

    def reader():
        return object_reader(a.objects)

    if a.command == "ingest":
        with catalog.lock("ingest"):
            out = ingest.ingest_inventory(catalog, a.inventory, reader, a.since, a.limit, a.dead_letters, s.fetch_options(), deduplicate=s.writing.keep, **write)
    elif a.command == "backfill":
        with catalog.lock("backfill"):
            out = ingest.backfill(catalog, a.inventory, reader, a.staging, s.reading.chunk_rows, a.since, s.fetch_options(), deduplicate=s.writing.keep, **write)
    elif a.command == "query":
        rows = query.search(catalog, a.geometry, a.start, a.end, query.cql(a.filter) if a.filter else None, ["id", "datetime", "platform", "grid_partition", "year"], a.distinct)
        out = _rows(rows.orderBy("datetime", "id"), a.limit)
    elif a.command == "compact":
        with catalog.lock("compact"):
            out = maintenance.compact(catalog, a.threshold, s.writing.keep, dry_run=a.dry_run, **write)
    elif a.command == "finish":
        with catalog.lock("finish"):
            out = maintenance.finish(catalog, s.writing.keep, **write)
    elif a.command == "consolidate":
        with catalog.lock("consolidate"):
            out = maintenance.consolidate(catalog, a.rows, a.threshold, s.writing.keep, a.dry_run)
    elif a.command == "repair":
        with catalog.lock("repair"):
            out = _rows(maintenance.repair_plan(catalog).groupBy("status").agg(F.count("*").alias("files"))) if a.dry_run else maintenance.repair_files(catalog, s.writing.rows_per_file)
    elif a.command == "expire":
        with catalog.lock("expire"):
            n = 0 if a.dry_run else maintenance.expire(catalog, a.grace_hours)
            out = {"snapshots": n, "files": maintenance.remove_orphans(catalog, a.dry_run, a.grace_hours).count()}
    elif a.command == "delta":
        out = delta.daily_delta(spark, read_inventory(spark, a.inventory), a.index, a.folder, a.date)
    elif a.command == "audit":
        inventory, database = keys_with_ids_of(read_inventory(spark, a.inventory)), spark.read.parquet(a.database)
        flags = reports.audit(inventory.select("id"), database.select("id"), catalog.read().select("id"))
        out = _rows(joins.regions_of_venn(flags, ["inventoried", "in_database", "in_warehouse"]))
        if a.out:
            io.write_parquet(reports.audit_delta(flags, inventory, database), a.out)
    elif a.command == "compare":
        out = {k: _rows(v) for k, v in reports.compare_sources(_ids(spark, a.a), _ids(spark, a.b)).items()}
    elif a.command == "diff":
        found = joins.compare(manifest_files(spark, a.old), manifest_files(spark, a.new), "key", ["md5", "size"])
        out = _rows(found.groupBy("status").agg(F.count("*").alias("files")).orderBy("status"))
        if a.out:
            io.write_csv(found.where("status != 'same'"), a.out)
    elif a.command == "index":
        out = {"hashes": hashindex.rebuild_index(catalog, a.path)}
    elif a.command == "index-update":
        out = hashindex.merge_from_keys(spark, a.path, read_inventory(spark, a.inventory))
    elif a.command == "register":
        out = {"snapshot": catalog.register_new(spark.read.text(a.files).select(F.col("value").alias("path")), a.index) if a.files else catalog.register()}
    elif a.command == "validate":
        out = {k: _rows(v) for k, v in reports.validate(catalog).items()}
    else:
        out = reports.summary(catalog.files()).first().asDict() | {"snapshot": (catalog.current() or {}).get("id")}
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
