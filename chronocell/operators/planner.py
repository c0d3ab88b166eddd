"""Scene planning: filters, joins, de-duplication and temporal bins over a scenes table.

scenes: id, product, center_time, region_code, label and, where wanted, properties (map) and a footprint box.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import timedelta
from functools import reduce as fold
from itertools import takewhile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronocell.functions.ids import uuid5_column
from chronocell.functions.parsing import parse_selector, render_task
from chronocell.functions.periods import FREQUENCIES, Period, annual_label, local_time, rolling_labels, rolling_rules, season_label, season_rules

SENSORS = ("ls5_sr", "ls7_sr", "ls8_sr", "ls9_sr")
PAD_DAYS = 0.6
KEY = ("center_time", "region_code")


def scan(scenes: DataFrame, products: Sequence[str], period: Period | None = None, pad_days: float = 0.0, properties: dict | None = None, ignore_time: Sequence[str] = ()) -> DataFrame:
    """Scenes of the products; the padded time range and property equalities reach the file scan."""
    timed = F.col("product").isin([p for p in products if p not in ignore_time])
    if period is not None:
        low, high = period.padded(pad_days)
        timed = timed & F.col("center_time").between(F.lit(low), F.lit(high))
    keep = timed | F.col("product").isin(list(ignore_time)) if ignore_time else timed
    for k, v in (properties or {}).items():
        keep = keep & (F.col("properties")[k] == str(v))
    return scenes.where(keep)


def quality(limit: float, value: Column | None = None) -> Column:
    return (F.col("properties")["gqa_iterative_mean_xy"].try_cast("double") if value is None else value) <= limit


def collection(category: str) -> Column:
    """Only the surface-reflectance products are held to the category."""
    return ~F.col("product").isin(*SENSORS) | (F.col("properties")["collection_category"] == category)


def in_tiles(x: tuple[int, int], y: tuple[int, int]) -> Column:
    return (F.col("x") >= x[0]) & (F.col("x") < x[1]) & (F.col("y") >= y[0]) & (F.col("y") < y[1])


def checker(text: str) -> Column:
    """`json|json`: any of them, each all of its properties; datetime means membership of a period."""

    def one(k: str, v) -> Column:
        return Period.parse(v).covers(F.col("center_time")) if k == "datetime" else F.coalesce(F.col("properties")[k] == str(v), F.lit(False))

    return fold(lambda a, b: a | b, [fold(lambda a, b: a & b, [one(k, v) for k, v in json.loads(part).items()], F.lit(True)) for part in text.split("|")])


def exact_prune(tile_scenes: DataFrame, period: Period) -> DataFrame:
    """The exact local-time filter after the padded scan."""
    return tile_scenes.where(period.covers(local_time(F.col("center_time"), F.col("utc_offset"))))


def fuse_join(scenes: DataFrame, joins: int, optional: Sequence[str] = (), keys: Sequence[str] = KEY) -> DataFrame:
    """Scenes of one key as a group of at least joins + 1, or enough others when the rest is optional.

    A product is optional if its name is part of one of the optional names, which may be paths.
    """
    is_optional = fold(lambda a, b: a | b, [F.lit(name).contains(F.col("product")) for name in optional], F.lit(False))
    need = joins + 1 - len(optional)
    g = scenes.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("product", "id"))).alias("members"), F.count(F.lit(1)).alias("n"), F.count_if(~is_optional).alias("n_required")
    )
    enough = F.col("n") >= joins + 1
    if optional:
        enough = enough | ((F.col("n") >= need) & (F.col("n_required") >= need))
    return g.where(enough)


def join_timeless(scenes: DataFrame, extra: DataFrame) -> DataFrame:
    """Each scene with the time-independent scenes of its region, which take its time and label."""
    e = extra.select("region_code", F.col("id").alias("extra_id"), F.col("product").alias("extra_product"))
    return scenes.join(e, "region_code")


def with_timeless(scenes: DataFrame, extra: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Scenes whose region has time-independent scenes, and for each of their keys a copy of those: with the group's
    time and datetime, and a label of the own product's name and the rest of the group's label."""
    lead = F.min_by(F.struct("product", "label", F.col("properties")["datetime"].alias("datetime")), F.struct("product", "id"))
    groups = scenes.groupBy(*keys).agg(lead.alias("lead"))
    kept = scenes.join(extra.select("region_code").dropDuplicates(), "region_code", "left_semi")
    time = next(k for k in keys if k != "region_code")
    copies = groups.join(extra.drop(time), "region_code")
    label = F.concat(F.col("product"), F.replace(F.col("lead.label"), F.col("lead.product"), F.lit("")))
    when = F.create_map(F.lit("datetime"), F.col("lead.datetime"))
    properties = F.map_concat(F.map_filter("properties", lambda k, _: k != "datetime"), when)
    return kept.unionByName(copies.withColumns({"label": label, "properties": properties}).select(*scenes.columns))


def fuse_products(products: Sequence[dict]) -> dict:
    """One product of several (name, metadata_type, measurements, and where known description and file_format).

    Fails unless there are two, all are of type eo3, no band name occurs twice, and the file formats agree, as far as
    they are given without a gap; the first one's holds.
    """
    if len(products) < 2:
        raise ValueError("two products at least are fused")
    if any(p["metadata_type"] != "eo3" for p in products):
        raise ValueError("products of metadata type eo3 are fused")
    bands = [m for p in products for m in p["measurements"]]
    if len({m["name"] for m in bands}) < len(bands):
        raise ValueError("products to be fused share a band")
    form = products[0].get("file_format")
    told = list(takewhile(lambda f: f is not None, (p.get("file_format") for p in products)))
    if len(set(told)) > 1:
        raise ValueError("products to be fused have different file formats")
    name = "fused__" + "__".join(p["name"] for p in products)
    about = ",".join(p.get("description") or f"non_indexed_{i}" for i, p in enumerate(products))
    return {"name": name, "metadata_type": "eo3", "description": f"Fused products: {about}", "measurements": bands, **({"file_format": form} if form is not None else {})}


def fuse_scenes(scenes: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """One scene a key of those with columns id, product, label, schema, crs, grids (map of name to struct of shape and
    transform), measurements and properties: the union of grids and measurements, the properties all agree on.

    A key fails if it has one scene only, grids of a name differ (of the transform six numbers count), a label is
    missing or labels differ after their product's name, or schema, crs (letter case aside) or datetime differ.
    """
    when = F.regexp_replace(F.col("properties")["datetime"], "Z", "+00:00")
    s = scenes.withColumns({"_rest": F.replace("label", "product", F.lit("")), "_when": when})
    grid = F.transform_values("grids", lambda _, g: F.struct(g["shape"].alias("shape"), F.slice(g["transform"], 1, 6).alias("transform")))
    different = lambda c: F.countDistinct(c) > 1
    whole = s.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("product", "id"))).alias("m"), F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"),
        different("_rest").alias("labels"), different(F.lower("schema")).alias("schemas"), different(F.lower("crs")).alias("crss"), different("_when").alias("times"),
        F.min_by(F.struct("_rest", "schema", "crs", "_when"), F.struct("product", "id")).alias("first"),
    )
    entries = lambda c, v: s.select(*keys, F.explode(c).alias("k", "v")).groupBy(*keys, "k").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("v").alias("different"), F.min("v").alias("v"))
    as_map = lambda rows, name: rows.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(name))
    grids = entries(grid, "v")
    grids = grids.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("grids"), (F.max("different") > 1).alias("gridded"))
    bands = as_map(entries("measurements", "v"), "measurements")
    common = entries("properties", "v").join(whole.select(*keys, F.col("n").alias("of")), list(keys)).where("n = of and different = 1 and k <> 'datetime'")
    out = whole.join(grids, list(keys), "left").join(bands, list(keys), "left").join(as_map(common, "properties"), list(keys), "left")
    wrong = F.when(F.col("n") < 2, "two scenes at least are fused")
    for flag, what in (("gridded", "grids"), ("labels", "labels"), ("schemas", "schemas"), ("crss", "coordinate systems"), ("times", "datetimes")):
        wrong = wrong.when(F.col(flag), f"{what} differ")
    wrong = wrong.when(F.col("labelled") < F.col("n"), "a label is missing")
    product = F.coalesce(F.when(wrong.isNotNull(), F.raise_error(wrong)).cast("string"), F.concat(F.lit("fused__"), F.array_join(F.transform("m", lambda x: x["product"]), "__")))
    sources = F.transform("m", lambda x: x["id"].cast("string"))
    name = F.lower(F.concat_ws("\n", product, F.lit("0.0.0"), F.lit(""), F.array_join(F.array_sort(sources), "\n")))
    fixed = F.create_map(F.lit("datetime"), F.col("first._when"), F.lit("fused"), F.lit("True"))
    properties = F.map_concat(F.map_filter(F.coalesce("properties", F.create_map().cast("map<string,string>")), lambda k, _: k != "fused"), fixed)
    return out.select(*keys, uuid5_column(name).alias("id"), product.alias("product"), F.concat(product, F.col("first._rest")).alias("label"), F.col("first.schema").alias("schema"), F.col("first.crs").alias("crs"), F.col("first._when").alias("datetime"), "grids", "measurements", properties.alias("properties"), sources.alias("sources"))


def aligned(products: dict[str, DataFrame], keys: Sequence[str] = ("y", "x"), tile: Sequence[str] = ()) -> DataFrame:
    """Bands of several products side by side where all have the pixel, named product.band where a name repeats."""
    count: dict[str, int] = {}
    on = [*tile, *keys]
    for df in products.values():
        for c in df.columns:
            count[c] = count.get(c, 0) + (c not in on)
    parts = [df.select(*on, *[F.col(c).alias(f"{name}.{c}" if count[c] > 1 else c) for c in df.columns if c not in on]) for name, df in products.items()]
    return fold(lambda a, b: a.join(b, on), parts)


def merge_documents(scenes: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """One merged scene a key: all measurements, the properties on which all agree, the sources. Needs two products at least."""
    s = scenes.select(*keys, "id", "product", F.col("crs"), "measurements", F.explode(F.map_entries("properties")).alias("p"))
    counts = scenes.groupBy(*keys).agg(F.countDistinct("id").alias("n"), F.countDistinct("product").alias("products"), F.array_sort(F.collect_set("id")).alias("sources"), F.array_sort(F.collect_set("product")).alias("names"), F.countDistinct(F.lower("crs")).alias("crs_n"), F.min("crs").alias("crs"))
    common = s.groupBy(*keys, F.col("p.key").alias("k")).agg(F.countDistinct("id").alias("holders"), F.countDistinct("p.value").alias("values"), F.min("p.value").alias("v"))
    common = common.join(counts.select(*keys, "n"), list(keys)).where("holders = n and values = 1").groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("properties"))
    bands = scenes.select(*keys, F.explode("measurements").alias("b", "path")).groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("b", "path")))).alias("measurements"))
    ok = F.when((F.col("products") < 2) | (F.col("crs_n") > 1), F.raise_error(F.concat(F.lit("cannot merge "), F.to_json("names"))).cast("string"))
    out = counts.join(bands, list(keys), "left").join(common, list(keys), "left")
    return out.select(*keys, F.coalesce(ok, F.concat(F.lit("fused__"), F.concat_ws("__", "names"))).alias("product"), "crs", "sources", "measurements", "properties", F.lit(True).alias("fused"))


def named_bins(scenes: DataFrame, bins: dict[str, Period], time: Column | str = "center_time") -> DataFrame:
    """A row a scene and bin that holds it (bins may overlap). The bins are a list of literals, not a table."""
    t = F.col(time) if isinstance(time, str) else time
    hits = F.array_compact(F.array(*[F.when(p.covers(t), F.lit(name)) for name, p in bins.items()]))
    return scenes.withColumn("period", F.explode(hits))


def binned(tile_scenes: DataFrame, frequency: str, period: Period | None = None) -> DataFrame:
    """tile scenes (with utc_offset) with their period label, by --frequency."""
    local = local_time(F.col("center_time"), F.col("utc_offset"))
    if frequency == "all":
        if period is not None:
            return named_bins(tile_scenes, {period.short: period})
        span = tile_scenes.agg(F.concat(F.year(F.min("center_time")).cast("string"), F.lit("--P"), (F.year(F.max("center_time")) - F.year(F.min("center_time")) + 1).cast("string"), F.lit("Y"))).scalar()
        return tile_scenes.withColumn("period", span)
    if frequency == "rolling-3months":
        if period.start.day > 1:
            return named_bins(tile_scenes, rolling_rules(period, 3, 1), local)
        return tile_scenes.withColumn("period", F.explode(rolling_labels(local, period, 3, 1)))
    if frequency == "3month-seasons":
        return tile_scenes.withColumn("period", season_label(local, season_rules(3, period.start.month))).where("period is not null")
    if frequency in FREQUENCIES:
        rules, months, anchor = FREQUENCIES[frequency]
        return tile_scenes.withColumn("period", season_label(local, rules(months, anchor))).where("period is not null")
    if frequency == "annual" or period is None:
        return tile_scenes.withColumn("period", annual_label(local))
    return named_bins(tile_scenes, {period.short: period})


def newest_version(scenes: DataFrame, keys: Sequence[str] = KEY) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped): the last label of each key stays."""
    ranked = scenes.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("label"), F.desc("id"))))
    return ranked.where("_r = 1").drop("_r"), ranked.where("_r > 1").drop("_r")


def pending(tasks: DataFrame, done: DataFrame, keys: Sequence[str] = ("period", "x", "y")) -> DataFrame:
    return tasks.join(done, list(keys), "left_anti")


def numbered(tasks: DataFrame) -> DataFrame:
    """tasks with _at, their number from 0 in order of period, x, y. Only counts of (period, x) meet in one task; a column of tiles is numbered by itself."""
    counts = tasks.groupBy("period", "x").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("period", "x").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select("period", "x", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("period", "x").orderBy("y"))
    return tasks.join(start, ["period", "x"]).withColumn("_at", F.col("_start") + own - 1).select(*tasks.columns, "_at")


def selected(tasks: DataFrame, selectors: Sequence[str]) -> DataFrame:
    """The tasks that indexes, slices and ids choose, with _nth (selector, place in it): in its order they stand as chosen, repeats kept.

    ValueError for a selector that fits no task. What reaches the driver is one count, and a row for each id that is given.
    """
    given = [parse_selector(s) for s in selectors]
    spark = tasks.sparkSession
    ids = [(k, *s) for k, s in enumerate(given) if not isinstance(s, (int, slice))]
    parts: list[DataFrame] = []
    nth = lambda k, at: F.struct(k.cast("int").alias("selector"), at.cast("long").alias("place")).alias("_nth")
    if ids:
        wanted = spark.createDataFrame(ids, "_k int, period string, x int, y int")
        if missing := {i[1:] for i in ids} - {(r.period, r.x, r.y) for r in tasks.join(F.broadcast(wanted), ["period", "x", "y"], "left_semi").select("period", "x", "y").distinct().collect()}:
            raise ValueError(f"no task {', '.join(render_task(t) for t in sorted(missing))}")
        parts.append(tasks.join(F.broadcast(wanted), ["period", "x", "y"]).select(*tasks.columns, nth(F.col("_k"), F.lit(0))))
    if len(ids) < len(given):
        total, placed = tasks.count(), numbered(tasks)
        for k, s in enumerate(given):
            if isinstance(s, int):
                if not -total <= s < total:
                    raise ValueError(f"no task number {s}")
                s = slice(s, s + 1 or None)
            if isinstance(s, slice):
                r = range(*s.indices(total))
                step = (F.col("_at") - r.start) / r.step
                parts.append(placed.where((step >= 0) & (step < len(r)) & (step == F.floor(step))).select(*tasks.columns, nth(F.lit(k), step)))
    return fold(DataFrame.unionByName, parts)


def tasks_of(binned_scenes: DataFrame) -> DataFrame:
    """A row a (period, x, y) with its distinct scene ids."""
    return binned_scenes.select("period", "x", "y", "id").dropDuplicates().groupBy("period", "x", "y").agg(F.array_sort(F.collect_list("id")).alias("dataset_ids"))


def task_counts(binned_scenes: DataFrame) -> DataFrame:
    """T, X, Y, datasets, days (UTC dates)."""
    d = binned_scenes.select("period", "x", "y", "id", F.to_date("center_time").alias("day"))
    c = d.groupBy("period", "x", "y").agg(F.countDistinct("id").alias("datasets"), F.countDistinct("day").alias("days"))
    return c.select(F.col("period").alias("T"), F.format_string("%+05d", "x").alias("X"), F.format_string("%+05d", "y").alias("Y"), "datasets", "days")


def _geometry(grid) -> list[Column]:
    """The tile's box as a polygon in the grid's coordinates, where the grid is known."""
    if grid is None:
        return []
    (w, h), (a, b) = grid.tile_size, grid.origin
    x0, y0 = F.col("x") * F.lit(float(w)) + float(a), F.col("y") * F.lit(float(h)) + float(b)
    ring = F.array(*[F.array(x, y) for x, y in ((x0, y0), (x0, y0 + h), (x0 + w, y0 + h), (x0 + w, y0), (x0, y0))])
    return [F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry")]


def tile_features(tile_scenes: DataFrame, grid=None) -> DataFrame:
    """x, y and a GeoJSON feature a tile: title, region code, indexes, offset and number of scenes. Indexes are as wide
    as the longest one's digits."""
    t = tile_scenes.groupBy("x", "y").agg(F.countDistinct("id").alias("total"), F.first("utc_offset").alias("utc_offset"))
    width = t.agg(F.length(F.max(F.greatest(F.abs("x"), F.abs("y"))).cast("string")).alias("w")).scalar()
    number = lambda c: F.concat(F.when(F.col(c) < 0, "-").otherwise(""), F.lpad(F.abs(c).cast("string"), width - (F.col(c) < 0).cast("int"), F.lit("0")))
    number = lambda c, n=number: F.when(F.length(F.col(c).cast("string")) >= width, F.col(c).cast("string")).otherwise(n(c))
    properties = F.struct(F.concat(number("x"), F.lit(","), number("y")).alias("title"), F.concat(F.lit("x"), number("x"), F.lit("y"), number("y")).alias("region_code"), F.col("x").alias("ix"), F.col("y").alias("iy"), "utc_offset", "total")
    return t.select("x", "y", F.to_json(F.struct(F.lit("Feature").alias("type"), *_geometry(grid), properties.alias("properties"))).alias("geojson"))


def period_features(binned_scenes: DataFrame, grid=None) -> DataFrame:
    """A GeoJSON feature collection a period; days are local dates; boxes where the grid is given."""
    local = F.to_date(local_time(F.col("center_time"), F.col("utc_offset")))
    d = binned_scenes.groupBy("period", "x", "y").agg(F.countDistinct("id").alias("total"), F.countDistinct(local).alias("days"), F.first("utc_offset").alias("utc_offset"))
    f = F.struct(F.lit("Feature").alias("type"), *_geometry(grid), F.struct(F.format_string("%+04d,%+04d", "x", "y").alias("title"), F.col("x").alias("ix"), F.col("y").alias("iy"), "utc_offset", "total", "days").alias("properties"))
    by_tile = F.array_sort(F.collect_list(F.struct("x", "y", f.alias("f"))))
    return d.groupBy("period").agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.transform(by_tile, lambda s: s["f"]).alias("features"))).alias("geojson"))


def time_extent(scenes: DataFrame) -> DataFrame:
    return scenes.agg(F.min("center_time").alias("start"), F.max("center_time").alias("end"))


def run_totals(results: DataFrame) -> DataFrame:
    """total, finished, skipped and errored of a result log (location, skipped, error)."""
    return results.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("error").isNull() & ~F.col("skipped")).alias("finished"), F.count_if(F.col("skipped")).alias("skipped"), F.count_if(F.col("error").isNotNull()).alias("errored"))


def dry_run(tasks: DataFrame, done: DataFrame, overwrite: bool = False, keys: Sequence[str] = ("period", "x", "y"), scenes: DataFrame | None = None) -> DataFrame:
    """tasks with the state a run would give them, and their number of UTC days where the scenes are given."""
    d = done.select(*keys).dropDuplicates().withColumn("_done", F.lit(True))
    state = F.when(F.col("_done").isNull(), "new").otherwise("recompute" if overwrite else "skip")
    t = tasks.join(d, list(keys), "left").select(*keys, "dataset_ids", F.size("dataset_ids").alias("datasets"), state.alias("state"))
    if scenes is None:
        return t.drop("dataset_ids")
    when = scenes.select("id", F.to_date("center_time").alias("day"))
    days = t.select(*keys, F.explode("dataset_ids").alias("id")).join(when, "id").groupBy(*keys).agg(F.countDistinct("day").alias("days"))
    return t.drop("dataset_ids").join(days, list(keys), "left").withColumn("days", F.coalesce("days", F.lit(0).cast("long")))


def lineage(task_scenes: DataFrame, fused: bool) -> DataFrame:
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))) if fused else F.array_sort(F.collect_set("id"))
    return task_scenes.groupBy("period", "x", "y").agg(ids.alias("lineage"))


def platforms(task_scenes: DataFrame) -> DataFrame:
    joined = lambda c, by: F.concat_ws(by, F.array_sort(F.collect_set(c)))
    return task_scenes.groupBy("period", "x", "y").agg(joined("platform", ",").alias("platform"), joined("instrument", "_").alias("instrument"))
