"""Plans: scenes to tasks, and tasks to results, each one lazy job over all tasks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronocell.functions.parsing import parse_products
from chronocell.functions.periods import Period
from chronocell.operators import planner, reproject, spatial
from chronocell.operators.summaries import Summary, execute, resolve

FREQUENCY_NAMES = ("all", "annual", "annual-fy", "semiannual", "seasonal", "quartely", "3month-seasons", "rolling-3months", "nov-mar", "apr-oct")


@dataclass(frozen=True)
class SaveOptions:
    products: str
    frequency: str = "annual"
    period: Period | None = None
    tiles: tuple[tuple[int, int], tuple[int, int]] | None = None
    properties: dict = field(default_factory=dict)
    gqa: float | None = None
    category: str | None = None
    optional: tuple[str, ...] = ()
    ignore_time: tuple[str, ...] = ()
    predicate: Column | None = None  # of scenes, after the joins

    def __post_init__(self):
        if self.frequency not in FREQUENCY_NAMES:
            raise ValueError(f"frequency must be one of {', '.join(FREQUENCY_NAMES)}")
        if self.frequency in ("rolling-3months", "3month-seasons") and self.period is None:
            raise ValueError(f"{self.frequency} needs a temporal range")


def plan_tasks(scenes: DataFrame, grid: spatial.Grid, options: SaveOptions, longitude=None) -> DataFrame:
    """scenes (with footprint boxes) to binned tile scenes: scan, join, filter, tile, prune, bin. Nothing runs yet, but for a look at whether there are time-independent scenes. longitude: of the tile, its centre's by default."""
    names, joins = parse_products(options.products)
    s = planner.scan(scenes, [n for n, _ in names], options.period, planner.PAD_DAYS, options.properties, options.ignore_time)
    if options.category is not None:
        s = s.where(planner.collection(options.category))
    elif options.gqa is not None:
        s = s.where(planner.quality(options.gqa))
    if options.tiles is not None:
        s = s.where(spatial.boxes_meet(grid.extent(*options.tiles)))
    if joins:
        if options.ignore_time:
            timeless = F.col("product").isin(list(options.ignore_time))
            s, extra = s.where(~timeless), s.where(timeless)
            if not extra.isEmpty():
                s = planner.with_timeless(s, extra)
        groups = planner.fuse_join(s, joins, options.optional)
        s = s.join(groups.select(*planner.KEY), list(planner.KEY), "left_semi")
    elif options.ignore_time:  # a union has no time to give them
        s = s.where(~F.col("product").isin(list(options.ignore_time)))
    if options.predicate is not None:
        s = s.where(options.predicate)
    t = spatial.to_tiles(s, grid)
    t = spatial.with_offset(t, grid.longitude(F.col("x"), F.col("y")) if longitude is None else longitude)
    if options.tiles is not None:
        t = t.where(planner.in_tiles(*options.tiles))
    if options.period is not None:
        t = planner.exact_prune(t, options.period)
    return planner.binned(t, options.frequency, options.period)


def run_tasks(spark: SparkSession, tasks: DataFrame, scenes: DataFrame, pixels: DataFrame, summary: str | Summary, done: DataFrame | None = None, group_by: str | None = None, native=None, resampling: tuple[str, float] | None = None, rasters: dict | None = None, grid: spatial.Grid | None = None, area: DataFrame | None = None, **config) -> DataFrame:
    """Results of all tasks in one job: their scenes' pixels (dataset_id, tile_x, tile_y, y, x, bands) summarised by task.

    With rasters (by crs) and grid, pixels are as they were taken (dataset_id, crs, y, x, bands) and are projected to the grid,
    by resampling[0] (nearest by default), after native has seen them and inside area (polygons), if given.
    """
    plugin = summary if isinstance(summary, Summary) else resolve(summary)(**config)
    if done is not None:
        tasks = planner.pending(tasks, done)
    chosen = tasks.select("period", F.col("x").alias("tile_x"), F.col("y").alias("tile_y"), F.explode("dataset_ids").alias("dataset_id"))
    tile = ["period", "tile_x", "tile_y"]
    if rasters is not None:
        taken = pixels if native is None else native(pixels)
        bands = [c for c in taken.columns if c not in ("dataset_id", "crs", "y", "x", "time", "solar_day", group_by)]
        obs = reproject.load_native(tasks, taken, rasters, grid, bands, resampling[0] if resampling else "nearest", area)
    else:
        obs = pixels.join(chosen, ["tile_x", "tile_y", "dataset_id"])
        if native is not None:  # on pixels as they were taken, before they are resampled
            obs = native(obs)
    if resampling is not None and rasters is None:
        obs = resampled(obs, list(plugin.bands), *resampling)
    if group_by is not None:  # what fuses: a column of pixels beside or instead of the solar day
        obs = obs.withColumn("solar_day", F.col(group_by))
    return plugin.run(obs, tile=tile) if hasattr(plugin, "run") else execute(obs, plugin, tile=tile)


def resampled(obs: DataFrame, bands: list[str], how: str, scale: float) -> DataFrame:
    """Observations on a grid scale times coarser: nearest (any type), or average, of each scene by itself."""
    if how == "nearest":
        return spatial.nearest(obs, scale)
    if how != "average" or scale != int(scale):
        raise ValueError("nearest, or average by a whole factor")
    keys = [c for c in obs.columns if c not in (*bands, "y", "x")]
    return spatial.average_down(obs, bands, int(scale), keys)


def mosaic(results: DataFrame, bands: list[str], factor: int) -> DataFrame:
    """Overview of results over all tiles."""
    return spatial.average_down(results, bands, factor, ["period", "tile_x", "tile_y"])
