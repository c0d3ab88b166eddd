"""Command line: save-tasks, run, publish-tasks, generate-cache, generate-mosaic, locate-grids."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from chronocell.functions.parsing import load_config, merge_config, parse_range2d
from chronocell.functions.periods import Period
from chronocell.operators import planner, polygons, spatial
from chronocell.operators.summaries import resolve
from chronocell.plans.tasks import FREQUENCY_NAMES, SaveOptions, mosaic, plan_tasks, run_tasks
from chronocell.sources import catalogue_items, catalogue_store, scene_store, sinks

SAVE_KEYS = {"products", "frequency", "temporal_range", "tiles", "properties", "gqa", "category", "optional", "ignore_time", "grid", "crs"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chronocell")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("save-tasks")
    a.add_argument("scenes", help="Parquet, the output of generate-cache, or table:NAME")
    a.add_argument("output")
    a.add_argument("--config")
    a.add_argument("--products")
    a.add_argument("--frequency", choices=FREQUENCY_NAMES)
    a.add_argument("--temporal-range")
    a.add_argument("--tiles")
    a.add_argument("--gqa", type=float)
    a.add_argument("--grid", help="tile width,tile height,resolution")
    a.add_argument("--crs", help="of the grid, for the tiles' longitude (EPSG:4326 by default; 3857, 6933, 3577)")
    a = sub.add_parser("run")
    for name in ("tasks", "scenes", "pixels", "output", "summary"):
        a.add_argument(name)
    a.add_argument("selectors", nargs="*")
    a.add_argument("--config")
    a.add_argument("--overwrite", action="store_true")
    a.add_argument("--dryrun", action="store_true")
    a.add_argument("--product", default="", help="with --location: checksums, processing, dataset and item documents follow the results; a task is done once it has its item")
    a.add_argument("--crs", help="of the grid (EPSG:4326 by default)")
    a.add_argument("--location", default="")
    a.add_argument("--grid", default="1,1,1", help="tile width,tile height,resolution")
    a = sub.add_parser("publish-tasks")
    for name in ("tasks", "queue"):
        a.add_argument(name)
    a.add_argument("selectors", nargs="*")
    a.add_argument("--geojson-filter", help="tasks whose tile meets the file's first feature, with all its parts and without its holes")
    a.add_argument("--grid", default="1,1,1", help="tile width,tile height,resolution")
    a.add_argument("--dryrun", action="store_true")
    a = sub.add_parser("generate-cache", help="a later call reads what is new or changed")
    for name in ("glob", "output"):
        a.add_argument(name)
    a.add_argument("--lines", action="store_true", help="files have an item a line")
    a = sub.add_parser("generate-mosaic")
    for name in ("results", "output", "bands"):
        a.add_argument(name)
    a.add_argument("--factor", type=int, default=4)
    a = sub.add_parser("locate-grids")
    for name in ("grid", "extent"):
        a.add_argument(name)
    a.add_argument("csv", nargs="?", help="where the numbers go, a line a grid box; else they are printed")
    a.add_argument("--attr-filter", help="SQL condition on the extent's columns")
    return p


def save_tasks(spark: SparkSession, a: argparse.Namespace) -> int:
    given = {k: getattr(a, k) for k in ("products", "frequency", "temporal_range", "tiles", "gqa", "grid", "crs")}
    c = merge_config(load_config(a.config, spark) if a.config else {}, given, SAVE_KEYS)
    if not c.get("products"):
        return 1
    try:
        width, height, resolution = map(float, str(c.get("grid", "1,1,1")).split(","))
        options = SaveOptions(c["products"], c.get("frequency") or "annual", Period.parse(c["temporal_range"]) if c.get("temporal_range") else None, parse_range2d(c["tiles"]) if c.get("tiles") else None, c.get("properties") or {}, c.get("gqa"), c.get("category"), tuple(c.get("optional") or ()), tuple(c.get("ignore_time") or ()))
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    grid = spatial.Grid((width, height), resolution, crs=c.get("crs") or "EPSG:4326")
    if width > 360 and grid.crs.upper() in ("EPSG:4326", "4326"):
        print("a grid in metres needs its --crs", file=sys.stderr)
        return 2
    try:
        binned = plan_tasks(scene_store.source(spark, a.scenes), grid, options)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    sinks.write_tasks(planner.tasks_of(binned), f"{a.output}/tasks")
    sinks.write_csv(planner.task_counts(binned), f"{a.output}/csv")
    sinks.write_documents(planner.period_features(binned, grid), f"{a.output}/geojson", "geojson")
    sinks.write_documents(planner.tile_features(binned, grid), f"{a.output}/tiles", "geojson")
    return 0


def _grid(text: str, crs: str | None = None) -> spatial.Grid:
    width, height, resolution = map(float, text.split(","))
    return spatial.Grid((width, height), resolution, crs=crs or "EPSG:4326")


def run(spark: SparkSession, a: argparse.Namespace, tasks) -> None:
    config = load_config(a.config, spark) if a.config else {}
    tasks = tasks.drop("_nth").dropDuplicates(["period", "x", "y"])  # a task that is chosen twice runs once
    done = sinks.existing(spark, f"{a.output}/_documents") if a.product else sinks.finished(spark, a.output)
    scenes = scene_store.source(spark, a.scenes)
    if a.dryrun:
        for r in planner.dry_run(tasks, done, a.overwrite, scenes=scenes).orderBy("period", "x", "y").toLocalIterator():
            print(f"{r.period}/{r.x:+04d}/{r.y:+04d} days={r.days} datasets={r.datasets} {r.state}")
        return
    new = tasks if a.overwrite else planner.pending(tasks, done)
    result = run_tasks(spark, new, scenes, scene_store.source(spark, a.pixels), a.summary, **config)
    if a.product:
        sinks.write_outputs(new, result, a.output, a.product, a.location, _grid(a.grid, a.crs), config, [("chronocell", "", resolve(a.summary).name)])
    else:
        sinks.write_bands(result, a.output, mode="overwrite" if a.overwrite else "append")


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.getOrCreate()
    if a.command == "save-tasks":
        return save_tasks(spark, a)
    if a.command in ("run", "publish-tasks"):
        try:
            tasks = spark.read.parquet(a.tasks)
            if a.selectors:
                tasks = planner.selected(tasks, a.selectors)
        except ValueError as e:
            print(e, file=sys.stderr)
            return 1
    if a.command == "run":
        run(spark, a, tasks)
    elif a.command == "publish-tasks":
        from chronocell.streaming.tasks import publish

        order = ["_nth", "period", "x", "y"] if a.selectors else ["period", "x", "y"]
        if a.geojson_filter:
            area = catalogue_items.read_features(spark, a.geojson_filter).where("feature = 0")
            tasks = polygons.tiles_meeting(tasks, area, _grid(a.grid))
        if a.dryrun:
            for r in tasks.orderBy(*order).select("period", "x", "y").toLocalIterator():
                print(f"{r.period}/{r.x:+04d}/{r.y:+04d}")
        else:  # files are named in order, so a queue that takes them by name keeps it
            publish(tasks.orderBy(*order), a.tasks, a.queue)
    elif a.command == "generate-cache":
        read, gone = catalogue_store.refresh(spark, a.glob, a.output, lines=a.lines)
        print(f"{read} files read, {gone} gone")
    elif a.command == "generate-mosaic":
        sinks.write_bands(mosaic(spark.read.parquet(a.results), a.bands.split(","), a.factor), a.output)
    elif a.command == "locate-grids":
        shapes = lambda path: catalogue_items.read_shapes(spark, path, outlines=True) if path.endswith(".shp") else spark.read.parquet(path)
        found = spatial.regions_touched(shapes(a.grid), shapes(a.extent), a.attr_filter)
        lines = found.orderBy("region_code").select(F.concat_ws(",", "numbers").alias("line"))
        if a.csv:
            sinks.write_documents(lines, a.csv, "line")
        else:
            print(json.dumps([r.line.split(",") for r in lines.toLocalIterator()]))
    return 0


if __name__ == "__main__":
    sys.exit(main())
