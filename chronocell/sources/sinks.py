"""Sinks: partitioned tables, item documents, checksum manifests, task tables, paths and ids."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronocell.functions.ids import NAMESPACE, deterministic_id, uuid5_column  # noqa: F401
from chronocell.functions.parsing import plain
from chronocell.functions.projections import between

#: Ends of the names of a task's documents.
DONE, DATASET, PROCESSING = "stac-item.json", "odc-metadata.yaml", "proc-info.yaml"


def _padded(number: Column, width: int) -> Column:
    """At least width characters, zeros after the sign; longer numbers stay whole."""
    digits = F.abs(number).cast("string")
    zeros = F.repeat(F.lit("0"), F.greatest(F.lit(0), width - F.length(digits) - (number < 0).cast("int")))
    return F.concat(F.when(number < 0, "-").otherwise(""), zeros, digits)


def region_code(x: Column | str = "x", y: Column | str = "y", width: int = 2) -> Column:
    number = lambda c, v: F.concat(F.lit(c), _padded(F.col(v) if isinstance(v, str) else v, width))
    return F.concat(number("x", x), number("y", y))


def output_path(location: str, short: str, band: str, extension: str = "tif", maturity: str | None = None) -> Column:
    """{location}/x../y../period/short_region_period[_maturity]_band.ext of columns period, x, y."""
    code = region_code()
    half = (F.length(code) / 2).cast("int")
    name = [F.lit(short), code, F.col("period"), *([F.lit(maturity)] if maturity else []), F.lit(band)]
    return F.concat(F.lit(location.rstrip("/") + "/"), F.substr(code, F.lit(1), half), F.lit("/"), F.substr(code, half + 1), F.lit("/"), F.col("period"), F.lit("/"), F.concat_ws("_", *name), F.lit(f".{extension}"))


def write_bands(result: DataFrame, path: str, keys: Sequence[str] = ("period", "tile_x", "tile_y"), mode: str = "error") -> None:
    """One directory a task; Spark's committer makes a task's files appear together. Overwriting replaces only the
    directories of the tasks in the result."""
    out = result.repartition(*keys).write.mode(mode).partitionBy(*keys).option("compression", "zstd")
    (out.option("partitionOverwriteMode", "dynamic") if mode == "overwrite" else out).parquet(path)


def _box(tasks: DataFrame, grid) -> dict[str, Column]:
    """Corners of the task's tile: of the grid, or columns."""
    if grid is not None:
        (w, h), (a, b) = grid.tile_size, grid.origin
        x, y = F.col("x") * F.lit(float(w)) + float(a), F.col("y") * F.lit(float(h)) + float(b)
        return {"min_x": x, "min_y": y, "max_x": x + float(w), "max_y": y + float(h)}
    names = ("min_x", "min_y", "max_x", "max_y")
    return {c: F.col(c) for c in names} if "min_x" in tasks.columns else {}


def _polygon(box: dict[str, Column]) -> Column:
    corner = lambda x, y: F.array(box[f"{x}_x"], box[f"{y}_y"])
    ring = F.array(corner("min", "min"), corner("min", "max"), corner("max", "max"), corner("max", "min"), corner("min", "min"))
    return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))


EDGE = 8  # points of each edge of a tile in degrees, as edges bend


def _in_degrees(tasks: DataFrame, box: dict[str, Column], crs: str) -> tuple[DataFrame, Column, Column]:
    """tasks, the outline in degrees east and north with points along its edges, and the box of these. Tiles over the 180th meridian are not split."""
    if crs.upper() in ("EPSG:4326", "4326"):
        return tasks, _polygon(box), F.array(*box.values())
    part = lambda lo, hi, i: box[lo] + (box[hi] - box[lo]) * (i / float(EDGE))
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    steps = F.sequence(F.lit(0), F.lit(EDGE - 1))
    edges = [F.transform(steps, f) for f in (
        lambda i: point(box["min_x"], part("min_y", "max_y", i)), lambda i: point(part("min_x", "max_x", i), box["max_y"]),
        lambda i: point(box["max_x"], part("max_y", "min_y", i)), lambda i: point(part("max_x", "min_x", i), box["min_y"]),
    )]
    lon, lat = between(crs, "EPSG:4326", "p.x", "p.y")
    tasks = tasks.withColumn("_points", F.concat(*edges)).withColumn("_ring", F.expr(f"transform(_points, p -> array({lon}, {lat}))"))
    ring = F.concat("_ring", F.slice("_ring", 1, 1))
    bound = lambda f, i: f(F.transform("_ring", lambda p: p[i]))
    return tasks, F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")), F.array(*(bound(f, i) for f in (F.array_min, F.array_max) for i in (0, 1)))


def _grid_of(box: dict[str, Column], resolution: float) -> list[Column]:
    """shape (rows, columns) and transform of the tile's pixels, the first row being the northernmost."""
    size = lambda c: F.rint((box[f"max_{c}"] - box[f"min_{c}"]) / resolution).cast("int")
    zero, step = F.lit(0.0), F.lit(float(resolution))
    return [F.array(size("y"), size("x")).alias("shape"), F.array(step, zero, box["min_x"], zero, -step, box["max_y"]).alias("transform")]


def _identity(tasks: DataFrame, product: str) -> tuple[Column, Column]:
    sources = F.col("lineage") if "lineage" in tasks.columns else F.col("dataset_ids")
    return sources, uuid5_column(F.concat_ws("\n", F.lit(product), region_code(), "period", F.array_join(F.array_sort(sources), ",")))


def _extension(path: Column, extension: str) -> Column:
    return F.regexp_replace(path, r"_document\.tif$", f".{extension}")


def item_documents(tasks: DataFrame, product: str, bands: Sequence[str], location: str, grid=None, href: str = "", processed: str | None = None, properties: dict | None = None) -> DataFrame:
    """period, x, y and the item document of each task (with start_datetime, end_datetime, lineage and box columns,
    where there). Geometry and box are in degrees; with a grid: code, shape and transform in its coordinates."""
    code, box = region_code(), _box(tasks, grid)
    if box:
        tasks, outline, bounds = _in_degrees(tasks, box, grid.crs if grid is not None else "EPSG:4326")
    sources, uid = _identity(tasks, product)
    own = output_path(location, product, "document")
    start = [F.col("start_datetime").alias("datetime")] if "start_datetime" in tasks.columns else []
    projection = [F.lit(grid.crs).alias("proj:code"), *(c.alias(f"proj:{n}") for c, n in zip(_grid_of(box, grid.resolution), ("shape", "transform"), strict=True))] if grid is not None else []
    links = [("product_overview", F.lit(href))] if href else []
    links = [F.struct(F.lit(rel).alias("rel"), F.lit("application/json").alias("type"), to.alias("href")) for rel, to in [*links, ("self", _extension(own, DONE))]]
    asset = lambda b: F.struct(output_path(location, product, b).alias("href"), F.lit("image/tiff; application=geotiff").alias("type"), F.lit(b).alias("title"), F.array(F.lit("data")).alias("roles"))
    doc = F.struct(
        F.lit("Feature").alias("type"),
        F.lit("1.0.0").alias("stac_version"),
        uid.alias("id"),
        F.lit(product).alias("collection"),
        *([outline.alias("geometry"), bounds.alias("bbox")] if box else []),
        F.struct(
            F.concat_ws("_", F.lit(product), code, "period").alias("title"), *start,
            F.lit(product).alias("odc:product"), code.alias("odc:region_code"), F.col("period").alias("dtr:period"),
            *[F.col(c).alias(f"dtr:{c}") for c in ("start_datetime", "end_datetime") if c in tasks.columns],
            *([F.lit(processed).alias("odc:processing_datetime")] if processed else []), *projection,
            *[F.lit(v).alias(k) for k, v in (properties or {}).items()],
        ).alias("properties"),
        F.struct(*[asset(b).alias(b) for b in bands]).alias("assets"),
        F.array(*links).alias("links"),
        F.struct(sources.alias("inputs")).alias("odc:lineage"),
    )
    return tasks.select("period", "x", "y", F.to_json(doc).alias("document"))


def dataset_documents(tasks: DataFrame, product: str, bands: Sequence[str], location: str, grid, version: str = "1.0.0", nodata: dict | None = None, properties: dict | None = None, classifier: str = "level3", schema: str = "eo3") -> DataFrame:
    """period, x, y and the dataset document of each task in EO3 form, as JSON (which is YAML): grids, measurements with
    nodata, accessories, and the sources under their classifier. Properties the sources share come as a column
    `shared` (a map), platform and instrument as columns of their own."""
    code, box = region_code(), _box(tasks, grid)
    sources, uid = _identity(tasks, product)
    own = output_path(location, product, "document")
    times = [F.col("start_datetime").alias("datetime")] if "start_datetime" in tasks.columns else []
    given = [F.col(c).alias(n) for c, n in (("start_datetime", "dtr:start_datetime"), ("end_datetime", "dtr:end_datetime"), ("platform", "eo:platform"), ("instrument", "eo:instrument")) if c in tasks.columns]
    fixed = F.from_json(F.to_json(F.struct(*times, *given, F.lit("GeoTIFF").alias("odc:file_format"), F.lit(version).alias("odc:dataset_version"), code.alias("odc:region_code"), *[F.lit(str(v)).alias(k) for k, v in (properties or {}).items()])), "map<string,string>")
    if "shared" in tasks.columns:
        given = fixed
        fixed = F.map_concat(F.map_filter("shared", lambda k, _: ~F.map_contains_key(given, k)), given)
    measurement = lambda b: F.struct(output_path(location, product, b).alias("path"), *([F.lit(nodata[b]).alias("nodata")] if b in (nodata or {}) else []))
    doc = F.struct(
        F.lit(schema).alias("$schema"),
        uid.alias("id"),
        F.concat_ws("_", F.lit(product), code, "period").alias("label"),
        F.struct(F.lit(product).alias("name")).alias("product"),
        F.lit(grid.crs).alias("crs"),
        _polygon(box).alias("geometry"),
        F.struct(F.struct(*_grid_of(box, grid.resolution)).alias("default")).alias("grids"),
        fixed.alias("properties"),
        F.struct(*[measurement(b).alias(b) for b in bands]).alias("measurements"),
        F.struct(F.struct(_extension(own, "sha1").alias("path")).alias("checksum:sha1"), F.struct(_extension(own, PROCESSING).alias("path")).alias("metadata:processor")).alias("accessories"),
        F.struct(sources.alias(classifier)).alias("lineage"),
    )
    return tasks.select("period", "x", "y", F.to_json(doc).alias("document"))


def processing_documents(tasks: DataFrame, products: Sequence[str], config: dict, software: Sequence[tuple[str, str, str]]) -> DataFrame:
    """period, x, y and a record of how each task was made: input products, configuration, and software with address and version."""
    doc = F.struct(
        F.array(*[F.lit(p) for p in sorted(products)]).alias("input-products"),
        F.lit(json.dumps(plain(config), sort_keys=True)).alias("config"),
        F.array(*[F.struct(F.lit(n).alias("name"), F.lit(u).alias("url"), F.lit(v).alias("version")) for n, u, v in software]).alias("software_versions"),
    )
    return tasks.select("period", "x", "y", F.to_json(doc).alias("document"))


def manifest(files: DataFrame) -> DataFrame:
    """`sha1  name` lines of (task keys.., name, content); a file that failed (NULL content) fails the manifest."""
    line = F.concat(F.sha1(F.coalesce("content", F.raise_error(F.concat(F.lit("not written: "), F.col("name"))).cast("binary"))), F.lit("  "), F.col("name"))
    return files.groupBy("period", "x", "y").agg(F.concat_ws("\n", F.array_sort(F.collect_list(line))).alias("manifest"))


def written_files(spark, path: str, tasks: DataFrame) -> DataFrame:
    """(period, x, y, name, content) of the files that write_bands made for the tasks."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)  # period, tile_x, tile_y are directories, so other tasks' files need not be read
    f = f.select(F.col("period").cast("string").alias("period"), F.col("tile_x").cast("int").alias("x"), F.col("tile_y").cast("int").alias("y"), F.regexp_extract("path", r"[^/]+$", 0).alias("name"), "content")
    return f.join(tasks.select("period", "x", "y"), ["period", "x", "y"], "left_semi").select("period", "x", "y", "name", "content")


def write_outputs(tasks: DataFrame, result: DataFrame, path: str, product: str, location: str, grid, config: dict | None = None, software: Sequence[tuple[str, str, str]] = ()) -> None:
    """All that a task leaves, each part once the one before is whole: bands, checksums of all files, how it was made, dataset document,
    item document. A run that ends early leaves no item of a task, so existing() lets the next run make it again: bands
    take the place of what is there, and a task's lines of an earlier, unfinished run are followed by equal ones."""
    spark, keys = tasks.sparkSession, ["period", "x", "y"]
    bands = [c for c in result.columns if c not in ("period", "tile_x", "tile_y", "y", "x")]
    write_bands(result, path, mode="overwrite")
    documents = {
        PROCESSING: processing_documents(tasks, [product], config or {}, software), DATASET: dataset_documents(tasks, product, bands, location, grid), DONE: item_documents(tasks, product, bands, location, grid),
    }
    files = written_files(spark, path, tasks)
    for ext, d in documents.items():
        name = F.concat(F.concat_ws("_", F.lit(product), region_code(), "period"), F.lit(f".{ext}"))
        files = files.unionByName(d.select(*keys, name.alias("name"), F.col("document").cast("binary").alias("content")))
    write_documents(manifest(files).select(*keys, F.to_json(F.struct(*keys, "manifest")).alias("document")), f"{path}/_sha1", mode="append")
    for ext, folder in ((PROCESSING, "_processing"), (DATASET, "_datasets"), (DONE, "_documents")):
        write_documents(documents[ext], f"{path}/{folder}", mode="append")


def existing(spark, path: str) -> DataFrame:
    """Keys of the tasks whose item document is there, as it is written last; none if nothing is there yet."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], "period string, x int, y int")
    kind = "properties struct<`dtr:period`:string,`odc:region_code`:string>"
    d = spark.read.schema(kind).json(path).select(F.col("properties.`dtr:period`").alias("period"), F.col("properties.`odc:region_code`").alias("r"))
    part = lambda i: F.regexp_extract("r", r"^x(-?\d+)y(-?\d+)$", i).cast("int")
    return d.select("period", part(1).alias("x"), part(2).alias("y")).dropDuplicates()


def finished(spark, path: str) -> DataFrame:
    """Keys of the tasks whose results write_bands put under the path; none if nothing is there yet."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root) or not any(s.isDirectory() and s.getPath().getName().startswith("period=") for s in files.listStatus(root)):
        return spark.createDataFrame([], "period string, x int, y int")
    keys = [F.col("period").cast("string").alias("period"), F.col("tile_x").cast("int").alias("x"), F.col("tile_y").cast("int").alias("y")]
    return spark.read.parquet(path).select(*keys).dropDuplicates()


def write_tasks(tasks: DataFrame, path: str) -> None:
    tasks.write.partitionBy("period").parquet(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.orderBy(*rows.columns[:3]).write.option("header", True).option("quoteAll", False).csv(path)


def write_documents(rows: DataFrame, path: str, column: str = "document", mode: str = "error") -> None:
    rows.select(column).write.mode(mode).text(path)
