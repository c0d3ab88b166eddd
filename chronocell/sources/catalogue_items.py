"""Sources: catalogue items (JSON), GeoJSON, observation tables, task tables."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronocell.functions.periods import Period
from chronocell.operators.polygons import box

ITEM = "id string, collection string, bbox array<double>, geometry struct<type:string,coordinates:string>, properties map<string,string>, assets map<string,struct<href:string>>"


def item_globs(root: str, tiles: tuple[tuple[int, int], tuple[int, int]] | None = None) -> list[str]:
    """One glob a tile, or one for all."""
    if tiles is None:
        return [f"{root.rstrip('/')}/*/*/*"]
    return [f"{root.rstrip('/')}/x{x}/y{y}/*" for x in range(*tiles[0]) for y in range(*tiles[1])]


def scene_columns() -> list[Column]:
    """A scene's columns from an item's."""
    return [
        "id",
        F.col("collection").alias("product"),
        F.to_timestamp(F.col("properties")["datetime"]).alias("center_time"),
        F.col("properties")["odc:region_code"].alias("region_code"),
        F.col("properties")["title"].alias("label"),
        F.col("properties")["proj:code"].alias("crs"),
        F.transform_values("assets", lambda _, a: a["href"]).alias("measurements"),
        "properties",
        *[F.col("bbox")[i].alias(n) for i, n in enumerate(("min_x", "min_y", "max_x", "max_y"))],
        F.coalesce(geometry_rings("geometry"), F.when(F.size("bbox") == 4, box(*(F.col("bbox")[i] for i in range(4))))).alias("rings"),
    ]


def read_items(spark: SparkSession, paths: str | Sequence[str], pattern: str = "*.stac-item.json", period: Period | None = None) -> DataFrame:
    """Catalogue items as scenes; files are chosen by glob, times by the closed period."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    items = spark.read.schema(ITEM).option("multiLine", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", True).json(paths)
    scenes = items.select(*scene_columns())
    return scenes if period is None else scenes.where(period.covers(F.col("center_time")))


def geometry_rings(geometry: str) -> Column:
    """The rings of a GeoJSON geometry (type, coordinates as text); null if it is no polygon. Further parts and holes are rings like any other."""
    c = f"{geometry}.coordinates"
    one, many = f"from_json({c}, 'array<array<array<double>>>')", f"flatten(from_json({c}, 'array<array<array<array<double>>>>'))"
    rings = f"CASE {geometry}.type WHEN 'Polygon' THEN {one} WHEN 'MultiPolygon' THEN {many} END"
    return F.expr(f"transform({rings}, r -> transform(r, p -> struct(p[0] AS x, p[1] AS y)))")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(feature, properties, rings) of a GeoJSON collection; feature numbers a file's features from 0."""
    kind = "features array<struct<geometry:struct<type:string,coordinates:string>,properties:map<string,string>>>"
    f = spark.read.schema(kind).option("multiLine", True).json(path).select(F.posexplode("features").alias("feature", "f"))
    return f.select("feature", "f.properties", geometry_rings("f.geometry").alias("rings"))


def read_polygons(spark: SparkSession, path: str) -> list[list[list[tuple[float, float]]]]:
    """All polygons of a GeoJSON file with all their rings, the outer one first (a small driver-side input)."""
    import json

    kind = "features array<struct<geometry:struct<type:string,coordinates:string>>>"
    out = []
    for row in spark.read.schema(kind).option("multiLine", True).json(path).toLocalIterator():
        for f in row.features or []:
            c = json.loads(f.geometry.coordinates)
            out += [[[(x, y) for x, y, *_ in ring] for ring in polygon] for polygon in (c if f.geometry.type == "MultiPolygon" else [c])]
    return out


def _shapes(data: bytes) -> Iterator[tuple[tuple[float, float, float, float], list[list[dict]]] | None]:
    """Box and rings of a shape file's records, in order; a line's parts count as rings of no use, and null shapes and points are None."""
    at = 100
    while at + 12 <= len(data):
        size = 2 * int.from_bytes(data[at + 4 : at + 8], "big")
        kind = int.from_bytes(data[at + 8 : at + 12], "little")
        if kind in (5, 15, 25):  # polygons, also with heights or measures after the points
            parts, points = struct.unpack("<2i", data[at + 44 : at + 52])
            start = [*struct.unpack(f"<{parts}i", data[at + 52 : at + 52 + 4 * parts]), points]
            xy = struct.unpack(f"<{2 * points}d", data[at + 52 + 4 * parts : at + 52 + 4 * parts + 16 * points])
            yield struct.unpack("<4d", data[at + 12 : at + 44]), [[{"x": xy[2 * i], "y": xy[2 * i + 1]} for i in range(a, b)] for a, b in zip(start, start[1:], strict=False)]
        else:
            yield (struct.unpack("<4d", data[at + 12 : at + 44]), []) if kind in (3, 8, 13, 18, 23, 28) else None
        at += 8 + size


def _fields(data: bytes) -> list[tuple[str, int]]:
    """Column names and widths of a dBASE table."""
    out, at = [], 32
    while data[at] != 0x0D:
        out.append((data[at : at + 11].split(b"\0")[0].decode("latin-1"), data[at + 16]))
        at += 32
    return out


def _attributes(data: bytes) -> Iterator[list[str | None]]:
    """Rows of a dBASE table; blank values are None."""
    count, start, width = struct.unpack("<IHH", data[4:12])
    for i in range(count):
        place, values = start + i * width + 1, []
        for _, n in _fields(data):
            values.append(data[place : place + n].decode("utf-8", "replace").strip() or None)
            place += n
        yield values


def read_shapes(spark: SparkSession, path: str, outlines: bool = False) -> DataFrame:
    """Boxes (min_x .. max_y) or, with outlines, rings of the shapes in path.shp, with the columns of path.dbf as text.

    A path may have globs; the files have the same columns. A file goes to one task, as its records have no index here.
    """
    base = path.removesuffix(".shp")
    files = spark.read.format("binaryFile").load([f"{base}.shp", f"{base}.dbf"]).select("path", "content")

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch({"names": pa.array([[n for n, _ in _fields(c)] for c in b.column("content").to_pylist()], pa.list_(pa.string()))})

    names = files.where("path like '%.dbf'").limit(1).mapInArrow(head, "names array<string>").first().names
    corners = ["min_x", "min_y", "max_x", "max_y"]
    ring = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))

    def run(t: pa.Table) -> pa.Table:
        content = dict(zip((p[-3:] for p in t.column("path").to_pylist()), t.column("content").to_pylist(), strict=True))
        rows = [((s[1],) if outlines else s[0]) + tuple(v) for s, v in zip(_shapes(content["shp"]), _attributes(content["dbf"]), strict=True) if s]
        kinds = ([ring] if outlines else [pa.float64()] * 4) + [pa.string()] * len(names)
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[*(["rings"] if outlines else corners), *names])

    shape = ["rings array<array<struct<x:double,y:double>>>"] if outlines else [f"{c} double" for c in corners]
    return files.groupBy(F.regexp_replace("path", r"\.(shp|dbf)$", "").alias("base")).applyInArrow(run, ", ".join([*shape, *(f"`{n}` string" for n in names)]))


def read_observations(spark: SparkSession, path: str, bands: Sequence[str], tiles: tuple | None = None, nodata: dict | None = None) -> DataFrame:
    """Observation rows with only the wanted bands; partition columns x, y prune by tile; sentinels become NULL."""
    from chronocell.functions.pixels import missing
    from chronocell.operators.planner import in_tiles

    obs = spark.read.parquet(path)
    obs = obs if tiles is None else obs.where(in_tiles(*tiles))
    keys = [c for c in ("period", "product", "dataset_id", "tile_x", "tile_y", "time", "solar_day", "y", "x") if c in obs.columns]
    return obs.select(*keys, *[missing(b, (nodata or {})[b]).alias(b) if b in (nodata or {}) else F.col(b) for b in bands])


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scenes_of(tasks: DataFrame, scenes: DataFrame) -> DataFrame:
    """A row a (task, scene)."""
    return tasks.select("period", "x", "y", F.explode("dataset_ids").alias("id")).join(scenes, "id")
