"""Grids, footprints, polygons and resampling as key arithmetic."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    tile_size: tuple[float, float]  # x, y
    resolution: float
    origin: tuple[float, float] = (0.0, 0.0)
    crs: str = "EPSG:4326"

    def longitude(self, x: Column, y: Column) -> Column:
        """Degrees east of a tile's centre."""
        return to_longitude(self.crs, *((c + 0.5) * self.tile_size[i] + self.origin[i] for i, c in enumerate((x, y))))

    def tile(self, axis: int, coordinate: Column) -> Column:
        return F.floor((coordinate - self.origin[axis]) / self.tile_size[axis]).cast("int")

    def extent(self, x: tuple[int, int], y: tuple[int, int]) -> tuple[float, float, float, float]:
        """min x, min y, max x, max y of half-open tile ranges."""
        (w, h), (a, b) = self.tile_size, self.origin
        return a + x[0] * w, b + y[0] * h, a + x[1] * w, b + y[1] * h


#: Radius and squared eccentricity of WGS 84 and GRS 80 (to the digits that matter here).
RADIUS, E2 = 6378137.0, 0.00669438


def to_longitude(crs: str, x: Column, y: Column) -> Column:
    """Degrees east, -180 to 180, of a point in degrees, in cylindrical equal area (6933), web Mercator or Australian Albers (3577)."""
    code = crs.upper().removeprefix("EPSG:")
    if code == "4326":
        east = x
    elif code == "3857":
        east = F.degrees(x / RADIUS)
    elif code == "6933":  # true at 30 degrees
        k = math.cos(math.radians(30)) / math.sqrt(1 - E2 * 0.25)
        east = F.degrees(x / (RADIUS * k))
    elif code == "3577":  # parallels 18 and 36 south, origin at 0, 132 east
        e = math.sqrt(E2)
        sine = [math.sin(math.radians(p)) for p in (-18, -36)]
        m1, m2 = (math.sqrt((1 - s * s) / (1 - E2 * s * s)) for s in sine)
        q1, q2 = ((1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e)) for s in sine)
        n = (m1 * m1 - m2 * m2) / (q2 - q1)
        rho = RADIUS * math.sqrt(m1 * m1 + n * q1) / n  # of latitude 0
        east = 132 + F.degrees(F.atan2(-x, y - rho) / n)  # n and rho are negative in the south
    else:
        raise ValueError(f"no longitude of {crs}")
    return F.pmod(east + 180.0, F.lit(360.0)) - 180.0


def to_tiles(scenes: DataFrame, grid: Grid) -> DataFrame:
    """A row a tile that a scene's footprint (rings; of scenes without that column, the box min_x, min_y, max_x, max_y) overlaps. Scenes with rings have one row an id."""
    if "rings" in scenes.columns:
        from chronocell.operators.polygons import polygon_tiles

        return scenes.join(polygon_tiles(scenes, ["id"], grid), "id").select(*scenes.columns, "x", "y")
    span = lambda axis, lo, hi: F.sequence(grid.tile(axis, F.col(lo)), grid.tile(axis, F.col(hi)))
    t = scenes.withColumn("x", F.explode(span(0, "min_x", "max_x"))).withColumn("y", F.explode(span(1, "min_y", "max_y")))
    return t


def with_offset(tile_scenes: DataFrame, longitude: Column) -> DataFrame:
    """Solar offset from the tile's longitude: a whole hour each 15 degrees (our choice)."""
    return tile_scenes.withColumn("utc_offset", F.rint(longitude / 15.0))


def boxes_meet(box: Sequence[float], names: Sequence[str] = ("min_x", "min_y", "max_x", "max_y")) -> Column:
    a, b, c, d = (F.col(n) for n in names)
    return (a <= box[2]) & (c >= box[0]) & (b <= box[3]) & (d >= box[1])


def inside(px: Column, py: Column, ring: Sequence[tuple[float, float]]) -> Column:
    """Even-odd test of a point against one ring, as an expression."""
    ring = [tuple(map(float, p[:2])) for p in ring]
    if ring[0] == ring[-1]:
        ring = ring[:-1]
    crossings = F.lit(0)
    for (x0, y0), (x1, y1) in zip(ring, [*ring[1:], ring[0]], strict=True):
        if y0 != y1:
            spans = (F.lit(y0) > py) != (F.lit(y1) > py)
            crossings = crossings + F.when(spans & (px < (py - y0) * ((x1 - x0) / (y1 - y0)) + x0), 1).otherwise(0)
    return crossings % 2 == 1


def inside_polygons(px: Column, py: Column, polygons: Sequence[Sequence[Sequence[tuple[float, float]]]]) -> Column:
    """Whether a point lies in one of the polygons; a polygon's further rings are holes."""
    hit = F.lit(False)
    for rings in polygons:
        odd = F.lit(False)
        for ring in rings:
            odd = odd != inside(px, py, ring)
        hit = hit | odd
    return hit


def rasterize(pixels: DataFrame, rings: Sequence[Sequence[tuple[float, float]]], cx: str = "cx", cy: str = "cy") -> DataFrame:
    """extent: whether a pixel's centre lies in one of the polygons."""
    hit = F.lit(False)
    for ring in rings:
        hit = hit | inside(F.col(cx), F.col(cy), ring)
    return pixels.withColumn("extent", hit)


def regions_touched(grid: DataFrame, extent: DataFrame, where: str | None = None, cell: float | None = None) -> DataFrame:
    """Numbers in the region codes of grid features that meet an extent (of those that pass the attribute filter).

    Features have rings, or boxes (min_x, min_y, max_x, max_y). Two tables of boxes are dealt to cells and meet by
    equality of the cell; cell: its width, by default the widest grid box. With rings on a side, outlines meet exactly; then
    the cell is by default as wide as the grid's features are on average.
    """
    box = ["min_x", "min_y", "max_x", "max_y"]
    e = extent if where is None else extent.where(where)
    if "rings" in grid.columns or "rings" in e.columns:
        from chronocell.operators import polygons

        outlined = lambda df: df if "rings" in df.columns else df.withColumn("rings", polygons.box(*map(F.col, box)))
        g = outlined(grid)
        if cell is None:
            span = lambda c: F.array_max(F.transform(F.flatten("rings"), lambda p: p[c])) - F.array_min(F.transform(F.flatten("rings"), lambda p: p[c]))
            cell = g.agg(F.avg(F.greatest(span("x"), span("y")))).first()[0] or 1.0
        hit = polygons.touched(g, outlined(e), ["region_code"], polygons.Cells(cell, cell))
        return hit.select("region_code", F.regexp_extract_all("region_code", F.lit(r"-?\d+"), 0).alias("numbers"))
    if cell is None:
        cell = grid.agg(F.max(F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")))).first()[0] or 1.0
    over = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    celled = lambda df: df.withColumn("_cx", F.explode(over("min_x", "max_x"))).withColumn("_cy", F.explode(over("min_y", "max_y")))
    e = celled(e.select(*box)).select("_cx", "_cy", *[F.col(c).alias(f"_{c}") for c in box])
    meets = (F.col("min_x") <= F.col("_max_x")) & (F.col("max_x") >= F.col("_min_x")) & (F.col("min_y") <= F.col("_max_y")) & (F.col("max_y") >= F.col("_min_y"))
    g = celled(grid.select("region_code", *box)).withColumnsRenamed({"_cx": "_gx", "_cy": "_gy"})
    hit = g.join(e, (F.col("_gx") == F.col("_cx")) & (F.col("_gy") == F.col("_cy")) & meets, "left_semi").select("region_code").dropDuplicates()
    return hit.select("region_code", F.regexp_extract_all("region_code", F.lit(r"-?\d+"), 0).alias("numbers"))


def average_down(obs: DataFrame, bands: Sequence[str], factor: int, keys: Sequence[str] = (), y: str = "y", x: str = "x") -> DataFrame:
    """Mean of factor by factor blocks of pixels."""
    return obs.groupBy(*keys, F.floor(F.col(y) / factor).alias(y), F.floor(F.col(x) / factor).alias(x)).agg(*[F.avg(b).alias(b) for b in bands])


def nearest(obs: DataFrame, scale: float, keys: Sequence[str] = (), y: str = "y", x: str = "x") -> DataFrame:
    """Source pixels for a target grid scale times coarser: the one that holds each target's centre."""
    centre = lambda c: F.floor((F.col(f"t_{c}") + 0.5) * scale)
    t = obs.withColumns({f"t_{c}": F.floor(F.col(c) / scale) for c in (y, x)})
    return t.where((F.col(y) == centre(y)) & (F.col(x) == centre(x))).drop(y, x).withColumnsRenamed({f"t_{y}": y, f"t_{x}": x})


def bilinear(obs: DataFrame, bands: Sequence[str], dy: float, dx: float, keys: Sequence[str] = (), y: str = "y", x: str = "x") -> DataFrame:
    """Values at (y + dy, x + dx), 0 <= dy, dx < 1: each pixel gives its weight to four targets; missing ones are left out."""
    corners = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit((dy if i else 1 - dy) * (dx if j else 1 - dx)).alias("w")) for i in (0, 1) for j in (0, 1)])
    s = obs.select(*keys, *bands, y, x, F.explode(corners).alias("o")).where("o.w > 0")
    total = lambda b: F.sum(F.col(b) * F.col("o.w")) / F.sum(F.when(F.col(b).isNotNull(), F.col("o.w")))
    return s.groupBy(*keys, (F.col(y) - F.col("o.i")).alias(y), (F.col(x) - F.col("o.j")).alias(x)).agg(*[total(b).alias(b) for b in bands])
