"""Exact joins of polygons: their edges are cut to cells, cells meet by equality, and each cell is settled by itself.

A polygon is an array of closed or open rings (arrays of points x, y) under the even-odd rule, so holes and further parts are
rings like any other. Its cover has a row for every cell that an edge passes: the edges there and whether the cell's
centre is inside; between two such cells of a row lies a run of cells that are all inside or all outside. Runs inside
are cut to blocks of 1, 8, 64, ... cells. Two polygons meet where edges share a cell and cross there or lie in each
other there (a point is followed from the centre, so the edges of one cell are enough), or where a cell with an edge
of one lies in a block of the other. What a polygon costs grows with its outline in cells, not with its area, and no whole
polygon is copied to a pair.

Coordinates are finite numbers. Null or empty polygons and rings of less than three points meet nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronocell.operators.spatial import Grid

RINGS = "array<array<struct<x:double,y:double>>>"
LEVELS = 7  # blocks of up to 8 ** 6 cells


@dataclass(frozen=True)
class Cells:
    width: float
    height: float
    x: float = 0.0  # a corner
    y: float = 0.0

    @classmethod
    def of(cls, grid: Grid) -> Cells:
        return cls(*grid.tile_size, *grid.origin)

    def centre(self, i: Column, j: Column) -> tuple[Column, Column]:
        return (i + 0.5) * self.width + self.x, (j + 0.5) * self.height + self.y


def box(min_x: Column, min_y: Column, max_x: Column, max_y: Column) -> Column:
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(point(min_x, min_y), point(max_x, min_y), point(max_x, max_y), point(min_x, max_y)))


def edges(polygons: DataFrame, keys: Sequence[str], rings: str = "rings") -> DataFrame:
    """(keys, _x0, _y0, _x1, _y1), a row an edge."""
    r = polygons.select(*keys, F.explode(rings).alias("_r")).where("size(_r) > 2")
    pairs = F.expr("transform(sequence(0, size(_r) - 1), i -> struct(get(_r, i) AS a, get(_r, (i + 1) % size(_r)) AS b))")
    e = r.select(*keys, F.explode(pairs).alias("_e"))
    e = e.select(*keys, *(F.col(f"_e.{p}.{c}").cast("double").alias(f"_{c}{k}") for k, p in enumerate("ab") for c in "xy"))
    return e.where("_x0 <> _x1 OR _y0 <> _y1")


def _from_to(lo: Column, hi: Column, kind: str) -> Column:
    """Indices of unit cells that a range has points in: of open cells, closed cells, or cells with their lower borders."""
    first = F.ceil(lo) - 1 if kind == "closed" else F.floor(lo)
    last = F.ceil(hi) - 1 if kind == "open" else F.floor(hi)
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))


def _pieces(e: DataFrame, cells: Cells, kind: str) -> DataFrame:
    """A row for each cell (_i, _j) that an edge passes, with the part of the edge there (_xa to _xb, _lo to _hi) and, in the cell
    where the edge crosses the row's centre line, where (_cross)."""
    x0, y0, x1, y1, j = (F.col(c) for c in ("_x0", "_y0", "_x1", "_y1", "_j"))
    unit = lambda v, o, s: (v - o) / s
    at = lambda y: F.when(y == y1, x1).otherwise(F.coalesce(x0 + (y - y0) * ((x1 - x0) / F.nullif(y1 - y0, F.lit(0.0))), x0))
    left, right = F.least(x0, x1), F.greatest(x0, x1)
    rows = e.withColumn("_j", F.explode(_from_to(unit(F.least(y0, y1), cells.y, cells.height), unit(F.greatest(y0, y1), cells.y, cells.height), kind)))
    rows = rows.withColumns({"_lo": F.greatest(F.least(y0, y1), cells.y + j * cells.height), "_hi": F.least(F.greatest(y0, y1), cells.y + (j + 1) * cells.height)})
    a, b = at(F.col("_lo")), at(F.col("_hi"))
    level = y0 == y1
    middle = (j + 0.5) * cells.height + cells.y
    rows = rows.withColumns({
        "_xa": F.when(level, left).otherwise(F.greatest(left, F.least(a, b))), "_xb": F.when(level, right).otherwise(F.least(right, F.greatest(a, b))),
        "_cross": F.when((y0 > middle) != (y1 > middle), at(middle)),
    })
    lo, hi = (unit(f(c, F.coalesce("_cross", c)), cells.x, cells.width) for f, c in ((F.least, F.col("_xa")), (F.greatest, F.col("_xb"))))
    return rows.withColumn("_i", F.explode(_from_to(lo, hi, kind)))


def cover(polygons: DataFrame, keys: Sequence[str], cells: Cells, rings: str = "rings") -> DataFrame:
    """(keys, _j, _i, _s, _in, _from, _to): the cells with edges, the edges there with a point of each in the cell, whether the
    centre is inside, and the run of inside cells that follows, if any. One shuffle."""
    p = _pieces(edges(polygons, keys, rings), cells, "lower").repartition(*keys, "_j")
    x0, y0, x1, y1, i = (F.col(c) for c in ("_x0", "_y0", "_x1", "_y1", "_i"))
    mx = (F.greatest(F.col("_xa"), cells.x + i * cells.width) + F.least(F.col("_xb"), cells.x + (i + 1) * cells.width)) / 2
    my = F.coalesce(y0 + (mx - x0) * ((y1 - y0) / F.nullif(x1 - x0, F.lit(0.0))), (F.col("_lo") + F.col("_hi")) / 2)
    s = F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), mx.alias("mx"), F.least(F.greatest(my, F.col("_lo")), F.col("_hi")).alias("my"))
    here = F.floor((F.col("_cross") - cells.x) / cells.width) == i
    centre, _ = cells.centre(i, F.col("_j"))
    of_cell = p.groupBy(*keys, "_j", "_i").agg(F.collect_list(s).alias("_s"), F.count_if(here).alias("_n"), F.count_if(here & (F.col("_cross") <= centre)).alias("_l"))
    row = Window.partitionBy(*keys, "_j").orderBy("_i")
    before = F.coalesce(F.sum("_n").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    c = of_cell.withColumns({"_before": before, "_next": F.lead("_i").over(row)})
    run = ((F.col("_before") + F.col("_n")) % 2 == 1) & (F.col("_next") > F.col("_i") + 1)
    return c.select(*keys, "_j", "_i", "_s", ((F.col("_before") + F.col("_l")) % 2 == 1).alias("_in"), F.when(run, F.col("_i") + 1).alias("_from"), F.when(run, F.col("_next") - 1).alias("_to"))


def blocks(covered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _j, _l, _n): the runs of cells inside, cut to blocks n of 8 ** l cells."""

    some = lambda lo, hi: f"if({hi} >= {lo}, transform(sequence({lo}, {hi}), n -> struct(l AS _l, n AS _n)), array())"
    up, down = "shiftright(r.a + 7, 3)", "(shiftright(r.b + 1, 3) - 1)"  # whole blocks of the next level
    ends = f"concat(r.done, {some('r.a', f'({up} * 8 - 1)')}, {some(f'(({down} + 1) * 8)', 'r.b')})"
    step = f"if({up} <= {down} AND l < {LEVELS - 1}, struct({up} AS a, {down} AS b, {ends} AS done), struct(0L AS a, -1L AS b, concat(r.done, {some('r.a', 'r.b')}) AS done))"
    start = "struct(_from AS a, _to AS b, cast(array() AS array<struct<_l:int,_n:bigint>>) AS done)"
    cut = F.expr(f"aggregate(sequence(0, {LEVELS - 1}), {start}, (r, l) -> {step}, r -> r.done)")
    return covered.where("_to is not null").select(*keys, "_j", F.explode(cut).alias("_b")).select(*keys, "_j", "_b._l", "_b._n")


def within_blocks(cells: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """(keys, _j, _l, _n): the blocks of all levels that hold a cell (_i, _j)."""
    up = F.expr(f"transform(sequence(0, {LEVELS - 1}), l -> struct(l AS _l, shiftright(_i, l * 3) AS _n))")
    return cells.select(*keys, "_j", F.explode(up).alias("_b")).select(*keys, "_j", "_b._l", "_b._n")


def _turn(s: str, x: str, y: str) -> str:
    return f"(({s}.x1 - {s}.x0) * ({y} - {s}.y0) - ({s}.y1 - {s}.y0) * ({x} - {s}.x0))"


def _cross(s: str, t: str) -> str:
    """Whether two edges have a point in common."""
    near = " AND ".join(f"greatest({p}.{c}0, {p}.{c}1) >= least({q}.{c}0, {q}.{c}1)" for c in "xy" for p, q in ((s, t), (t, s)))
    side = lambda p, q: f"signum({_turn(p, f'{q}.x0', f'{q}.y0')}) * signum({_turn(p, f'{q}.x1', f'{q}.y1')}) <= 0"
    return f"({near} AND {side(s, t)} AND {side(t, s)})"


def _inside(x: str, y: str, s: str, inside: str, centre: tuple[str, str]) -> str:
    """Whether a point of a cell is inside, from whether the centre is and the edges that are crossed on the way: up or down, then along.

    All points count as a little farther right and a far smaller bit higher, so a tie on the way up is settled by the slope.
    """
    cx, cy = centre
    across = lambda a, b, at: f"(e.{b}0 + ({at} - e.{a}0) * ((e.{b}1 - e.{b}0) / nullif(e.{a}1 - e.{a}0, 0D)))"
    up = across("x", "y", cx)
    above = lambda v: f"({up} > {v} OR ({up} = {v} AND (e.y1 > e.y0) = (e.x1 > e.x0) AND e.y1 <> e.y0))"
    right = lambda v: f"({across('y', 'x', y)} > {v})"
    legs = " + ".join(f"CASE WHEN (e.{a}0 > {at}) <> (e.{a}1 > {at}) AND {side(start)} <> {side(end)} THEN 1 ELSE 0 END" for a, at, side, start, end in (("x", cx, above, cy, y), ("y", y, right, cx, x)))
    return f"({inside} <> (aggregate({s}, 0, (n, e) -> n + {legs}) % 2 = 1))"


def _cell_meets(cells: Cells) -> Column:
    """Of a cell with edges of two polygons (_s, _in and _t, _out)."""
    centre = (f"((_i + 0.5D) * {cells.width}D + {cells.x}D)", f"((_j + 0.5D) * {cells.height}D + {cells.y}D)")
    in_s, in_t = _inside("b.mx", "b.my", "_s", "_in", centre), _inside("a.mx", "a.my", "_t", "_out", centre)
    return F.expr(f"exists(_s, a -> exists(_t, b -> {_cross('a', 'b')})) OR exists(_t, b -> {in_s}) OR exists(_s, a -> {in_t})")


def _other(covered: DataFrame, keys: Sequence[str]) -> DataFrame:
    return covered.select(*keys, F.col("_j").alias("_oj"), F.col("_i").alias("_oi"), F.col("_s").alias("_t"), F.col("_in").alias("_out"))


def _outlines(polygons: DataFrame, keys: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(keys, name): the digest of each polygon's outline; and (name, rings): each different outline once."""
    p = polygons.where("rings is not null").withColumn(name, F.unhex(F.sha2(F.to_json("rings"), 256)))
    return p.select(*keys, name), p.select(name, "rings").dropDuplicates([name])


def _meet(a: DataFrame, b: DataFrame, a_keys: Sequence[str], b_keys: Sequence[str], cells: Cells, how: str) -> DataFrame:
    """The keys of the covers that meet, with repeats. Merge joins: a cover grows with outlines that Spark's estimates don't know, so
    one that counts as small may be too large to go through the driver."""
    ca, cb, block = cover(a, a_keys, cells), cover(b, b_keys, cells), ["_j", "_l", "_n"]
    keys = [*a_keys, *b_keys] if how == "inner" else a_keys
    same = (F.col("_j") == F.col("_oj")) & (F.col("_i") == F.col("_oi"))
    found = ca.join(_other(cb, b_keys).hint("merge"), same & _cell_meets(cells), how).select(*keys)
    found = found.unionByName(within_blocks(ca, a_keys).join(blocks(cb, b_keys).hint("merge"), block, how).select(*keys))
    return found.unionByName(blocks(ca, a_keys).join(within_blocks(cb, b_keys).hint("merge"), block, how).select(*keys))


def _repeat(df: DataFrame, keys: Sequence[str]) -> bool:
    return not df.groupBy(*keys).count().where("count > 1").isEmpty()


def meeting(a: DataFrame, b: DataFrame, a_keys: Sequence[str], b_keys: Sequence[str], cells: Cells) -> DataFrame:
    """(a_keys, b_keys) of the polygons that have a point in common, borders included; a row a pair.

    Different outlines meet first, each once; their pairs become those of the polygons that have them, without a shuffle of the latter
    by pair unless keys repeat.
    """
    if clash := set(a_keys) & set(b_keys):
        raise ValueError(f"both sides have the keys {sorted(clash)}")
    (ka, oa), (kb, ob) = _outlines(a, a_keys, "_of_a"), _outlines(b, b_keys, "_of_b")
    found = _meet(oa, ob, ["_of_a"], ["_of_b"], cells, "inner").distinct()
    out = found.join(kb.hint("merge"), "_of_b").join(ka.hint("merge"), "_of_a").select(*a_keys, *b_keys)
    return out.distinct() if _repeat(ka, a_keys) or _repeat(kb, b_keys) else out


def touched(a: DataFrame, b: DataFrame, a_keys: Sequence[str], cells: Cells) -> DataFrame:
    """The a_keys of polygons that have a point in common with one of b at least. Semi joins: a cell stops at the first that meets."""
    (ka, oa), (_, ob) = _outlines(a, a_keys, "_of_a"), _outlines(b, [], "_of_b")
    found = _meet(oa, ob, ["_of_a"], ["_of_b"], cells, "left_semi").distinct()
    return ka.join(found.hint("merge"), "_of_a", "left_semi").select(*a_keys).distinct()


def points_within(points: DataFrame, px: str, py: str, polygons: DataFrame, keys: Sequence[str], cells: Cells) -> DataFrame:
    """Points with the keys of each polygon they lie in (even-odd; of a border the lower and left one belongs)."""
    index = lambda c, o, s: F.floor((F.col(c) - o) / s)
    p = points.withColumns({"_pi": index(px, cells.x, cells.width), "_pj": index(py, cells.y, cells.height)})
    c = cover(polygons, keys, cells)
    inside = F.expr(_inside(f"`{px}`", f"`{py}`", "_s", "_in", (f"((_pi + 0.5D) * {cells.width}D + {cells.x}D)", f"((_pj + 0.5D) * {cells.height}D + {cells.y}D)")))
    near = p.join(c.hint("merge"), (F.col("_pi") == F.col("_i")) & (F.col("_pj") == F.col("_j")) & inside).select(*points.columns, *keys)
    up = within_blocks(p.withColumnsRenamed({"_pi": "_i", "_pj": "_j"}), points.columns)
    return near.unionByName(up.join(blocks(c, keys).hint("merge"), ["_j", "_l", "_n"]).select(*points.columns, *keys))


def _tile_cells(polygons: DataFrame, keys: Sequence[str], cells: Cells, touching: bool) -> tuple[DataFrame, DataFrame]:
    """Cells at the border or with the centre inside, and the cover."""
    c = cover(polygons, keys, cells)
    border = _pieces(edges(polygons, keys), cells, "closed" if touching else "open").select(*keys, "_i", "_j")
    return border.unionByName(c.where("_in").select(*keys, "_i", "_j")), c


def polygon_tiles(polygons: DataFrame, keys: Sequence[str], grid: Grid, touching: bool = False) -> DataFrame:
    """(keys, x, y): the tiles that a polygon overlaps (touching: or only touches), a row each."""
    border, c = _tile_cells(polygons, keys, Cells.of(grid), touching)
    runs = c.where("_to is not null").select(*keys, F.explode(F.sequence("_from", "_to")).alias("_i"), "_j")
    tile = lambda n, alias: F.col(n).cast("int").alias(alias)
    return border.unionByName(runs).select(*keys, tile("_i", "x"), tile("_j", "y")).distinct()


def tiles_meeting(tasks: DataFrame, polygons: DataFrame, grid: Grid, touching: bool = True) -> DataFrame:
    """The tasks whose tile (x, y) has a point in common with one of the polygons; tiles without tasks are never made."""
    polygons = polygons.select("rings").withColumn("_of", F.monotonically_increasing_id())
    border, c = _tile_cells(polygons, ["_of"], Cells.of(grid), touching)
    tiles = tasks.select("x", "y").distinct().withColumns({"_i": F.col("x").cast("bigint"), "_j": F.col("y").cast("bigint")})
    found = tiles.join(border.hint("merge"), ["_i", "_j"], "left_semi").select("x", "y")
    found = found.unionByName(within_blocks(tiles, ["x", "y"]).join(blocks(c, []).hint("merge"), ["_j", "_l", "_n"], "left_semi").select("x", "y")).distinct()
    return tasks.join(found, ["x", "y"], "left_semi").select(*tasks.columns)
