"""Pixels of one affine grid on another, in any two of the known systems, without joins.

A source pixel finds the target pixels it gives to: its outline in the target's system bounds a few candidates, and each
candidate's centre is taken back to the source to see whether it lies there. So nearest and bilinear give what a
lookup from the target would give, but the observations are read once, in place; nearest shuffles nothing, bilinear and
average add up partial sums. average is the mean of the source pixels whose centre lies in the target pixel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronocell.functions.projections import between, number, projection
from chronocell.operators.spatial import Grid

MARGIN = 0.05  # of a source pixel, around its outline: edges are a little bent in the other system


@dataclass(frozen=True)
class Raster:
    """Pixel (row y, column x) covers origin + (x, y) * step up to the next; the first row is the northernmost where step[1] < 0."""

    crs: str
    origin: tuple[float, float]
    step: tuple[float, float]

    @classmethod
    def of(cls, grid: Grid) -> Raster:
        return cls(grid.crs, grid.origin, (grid.resolution, -grid.resolution))

    def point(self, column: str, row: str) -> tuple[str, str]:
        return tuple(f"({number(o)} + {number(s)} * {c})" for o, s, c in zip(self.origin, self.step, (column, row), strict=True))

    def place(self, x: str, y: str) -> tuple[str, str]:
        """Column and row of a point, with fractions."""
        return tuple(f"(({c} - {number(o)}) / {number(s)})" for o, s, c in zip(self.origin, self.step, (x, y), strict=True))


def _moved(df: DataFrame, source: Raster, target: Raster, points: Mapping[str, tuple[str, str]]) -> DataFrame:
    """df with {name}_u, {name}_v: column and row on the target of points on the source (column and row as SQL).

    A column for each step, as steps are used more than once. The last one is made by inline(): conditions on it are not
    pushed below, where each would have the text of all steps, many times over.
    """
    put = lambda frame, pairs: frame.withColumns({f"{n}_{c}": F.expr(e) for n, p in pairs.items() for c, e in zip("uv", p, strict=True)})
    df = put(df, {n: source.point(*p) for n, p in points.items()})
    if source.crs.upper() != target.crs.upper():
        df = put(df, {n: projection(source.crs).inverse(f"{n}_u", f"{n}_v") for n in points})
        df = put(df, {n: projection(target.crs).forward(f"{n}_u", f"{n}_v") for n in points})
    last = [F.expr(e).alias(f"{n}_{c}") for n in points for c, e in zip("uv", target.place(f"{n}_u", f"{n}_v"), strict=True)]
    return df.select(*[c for c in df.columns if c not in {f"{n}_{c}" for n in points for c in "uv"}], F.inline(F.array(F.struct(*last))))


def _candidates(obs: DataFrame, source: Raster, target: Raster, reach: float, y: str, x: str) -> DataFrame:
    """obs for each target pixel (_ty, _tx) whose centre may be within reach of the source pixel, with that centre's place on the source (_back_u, _back_v)."""
    span = {f"_c{i}{j}": (f"(`{x}` + {number(0.5 + i * reach)})", f"(`{y}` + {number(0.5 + j * reach)})") for i in (-1, 1) for j in (-1, 1)}
    named = {k.replace("-", "m"): v for k, v in span.items()}
    df = _moved(obs, source, target, named)

    def between_(c: str) -> Column:
        ends = [f"{n}_{c}" for n in named]
        lo, hi = F.ceil(F.least(*ends) - 0.5), F.floor(F.greatest(*ends) - 0.5)
        return F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))

    df = df.select("*", F.explode(between_("v")).alias("_ty"))
    df = df.select(*obs.columns, "_ty", F.explode(between_("u")).alias("_tx"))
    return _moved(df, target, source, {"_back": ("(_tx + 5e-1)", "(_ty + 5e-1)")})


def reproject(obs: DataFrame, source: Raster, target: Raster, bands: Sequence[str], how: str = "nearest", keys: Sequence[str] = (), y: str = "y", x: str = "x") -> DataFrame:
    """keys, y, x and bands on the target's grid, from obs with at most one row a key and pixel. nearest keeps types; missing
    values stay missing there, and are left out of bilinear and average."""
    obs = obs.select(*keys, y, x, *bands)
    if how == "average":
        df = _moved(obs, source, target, {"_to": (f"(`{x}` + 5e-1)", f"(`{y}` + 5e-1)")})
        place = [F.floor("_to_v").alias(y), F.floor("_to_u").alias(x)]
        return df.groupBy(*keys, *place).agg(*[F.avg(b).alias(b) for b in bands])
    at = [F.col("_ty").alias(y), F.col("_tx").alias(x)]
    if how == "nearest":
        df = _candidates(obs, source, target, 0.5 + MARGIN, y, x)
        return df.where((F.floor("_back_u") == F.col(x)) & (F.floor("_back_v") == F.col(y))).select(*keys, *at, *bands)
    if how != "bilinear":
        raise ValueError("nearest, bilinear or average")
    df = _candidates(obs, source, target, 1 + MARGIN, y, x)
    off = lambda back, c: 1 - F.abs(F.col(back) - (F.col(c) + 0.5))
    df = df.withColumns({"_wu": off("_back_u", x), "_wv": off("_back_v", y)}).where("_wu > 0 AND _wv > 0").withColumn("_w", F.col("_wu") * F.col("_wv"))
    mean = lambda b: F.try_divide(F.sum(F.col(b) * F.col("_w")), F.sum(F.when(F.col(b).isNotNull(), F.col("_w"))))
    return df.groupBy(*keys, *at).agg(*[mean(b).alias(b) for b in bands])


def in_tiles(pixels: DataFrame, grid: Grid) -> DataFrame:
    """Pixels of the whole grid (Raster.of) as tile_x, tile_y and y, x in the tile, whose first row is the northernmost."""
    n = [round(s / grid.resolution) for s in grid.tile_size]
    up = -F.col("y") - 1  # rows counted from the south
    tile = {"tile_x": F.floor(F.col("x") / n[0]).cast("int"), "tile_y": F.floor(up / n[1]).cast("int")}
    df = pixels.withColumns(tile)
    return df.withColumns({"x": F.col("x") - F.col("tile_x") * n[0], "y": n[1] - 1 - (up - F.col("tile_y") * n[1])})


def load_native(tasks: DataFrame, native: DataFrame, rasters: Mapping[str, Raster], grid: Grid, bands: Sequence[str], how: str = "nearest", area: DataFrame | None = None) -> DataFrame:
    """The tasks' observations on their grid: native (dataset_id, crs, y, x, time, bands and what else goes with a scene), whose y, x
    count on the raster of its crs. area: polygons (rings, in the grid's system) outside which pixels are left out.

    Only scenes that a task has are projected, each crs by its own expressions; a pixel goes to the task of the tile it falls in.
    """
    chosen = tasks.select("period", F.col("x").alias("tile_x"), F.col("y").alias("tile_y"), F.explode("dataset_ids").alias("dataset_id"))
    wanted = native.join(chosen.select("dataset_id").distinct(), "dataset_id", "left_semi")
    keys = [c for c in native.columns if c not in ("crs", "y", "x", *bands)]
    parts = [reproject(wanted.where(F.upper("crs") == crs.upper()), raster, Raster.of(grid), bands, how, keys) for crs, raster in rasters.items()]
    pixels = in_tiles(reduce(DataFrame.unionByName, parts), grid)
    obs = pixels.join(chosen, ["dataset_id", "tile_x", "tile_y"])
    if area is None:
        return obs
    from chronocell.operators import polygons

    n = round(grid.tile_size[1] / grid.resolution)
    px = (F.col("tile_x") * float(grid.tile_size[0]) + (F.col("x") + 0.5) * grid.resolution) + grid.origin[0]
    py = (F.col("tile_y") * float(grid.tile_size[1]) + (n - 0.5 - F.col("y")) * grid.resolution) + grid.origin[1]
    place = obs.select("tile_x", "tile_y", "y", "x").distinct().withColumns({"_px": px, "_py": py})
    inside = polygons.points_within(place, "_px", "_py", area.select("rings").withColumn("_of", F.monotonically_increasing_id()), ["_of"], polygons.Cells.of(grid))
    return obs.join(inside, ["tile_x", "tile_y", "y", "x"], "left_semi")


def geographic(df: DataFrame, crs: str, x: str, y: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """df with degrees east and north of a point in crs."""
    east, north = between(crs, "EPSG:4326", f"`{x}`", f"`{y}`")
    return df.withColumns({lon: F.expr(east), lat: F.expr(north)})
