"""Queries of polygons and of grids in other projections, with the same in SQL: every pair of edges, every cell of a box."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronocell.catalogue import SCENES, query, scenes
from chronocell.functions.projections import projection
from chronocell.operators import polygons, reproject, spatial

#: Outlines as (shape, ring, points): concave; two parts; with a hole that holds whole tiles.
SHAPES = (
    (0, 0, ((0, 0), (14, 0), (14, 9), (7, 2), (0, 9))),
    (1, 0, ((0, 0), (3, 0), (0, 3))), (1, 1, ((9, 9), (13, 9), (13, 13))),
    (2, 0, ((0, 0), (24, 0), (24, 24), (0, 24))), (2, 1, ((2, 2), (22, 2), (22, 22), (2, 22))),
)
EDGES = ", ".join(f"({k}, {r}, {', '.join(str(float(c)) + '::DOUBLE' for c in (*a, *b))})" for k, r, p in SHAPES for a, b in zip(p, (*p[1:], p[0]), strict=True))
OUTLINES = f"outline(k, r, ux, uy, vx, vy) AS (VALUES {EDGES})"


def placed(df: DataFrame, kind, x, y, scale: float = 1.0) -> DataFrame:
    """df with rings: the outline of its kind, scaled, at x, y."""
    point = lambda p: F.struct((x + p[0] * scale).alias("x"), (y + p[1] * scale).alias("y"))
    outline = lambda k: F.array(*(F.array(*map(point, p)) for n, _, p in SHAPES if n == k))
    return df.withColumn("rings", F.when(kind == 0, outline(0)).when(kind == 1, outline(1)).otherwise(outline(2)))


def edge_sql(name: str, table: str, key: str, kind: str, x: str, y: str, scale: float = 1.0) -> str:
    return f"{name} AS (SELECT {key} AS k, {x} + ux * {scale} AS ux, {y} + uy * {scale} AS uy, {x} + vx * {scale} AS vx, {y} + vy * {scale} AS vy FROM {table} JOIN outline ON outline.k = {kind})"


def footprints(spark, sf) -> DataFrame:
    s = scenes(spark, sf).select("id")
    return placed(s, F.col("id") % 3, (F.col("id") % 53) * 1.75, (F.col("id") % 31) * 2.375)


FOOTPRINTS = SCENES + ", " + OUTLINES + ", " + edge_sql("e", "scenes", "scenes.id", "scenes.id % 3", "scenes.id % 53 * 1.75::DOUBLE", "scenes.id % 31 * 2.375::DOUBLE")


@query("j6_polygon_tiles", FOOTPRINTS + """, box AS (SELECT k, floor(min(ux) / 10)::INT AS i0, floor(max(ux) / 10)::INT AS i1, floor(min(uy) / 10)::INT AS j0, floor(max(uy) / 10)::INT AS j1 FROM e GROUP BY k),
tile AS (SELECT *, unnest(generate_series(i0, i1)) AS x FROM (SELECT k, i0, i1, unnest(generate_series(j0, j1)) AS y FROM box)),
t AS (SELECT k, x, y, CASE WHEN ux = vx THEN CASE WHEN ux > x * 10 AND ux < x * 10 + 10 THEN 0 ELSE 2 END ELSE least((x * 10 - ux) / (vx - ux), (x * 10 + 10 - ux) / (vx - ux)) END AS a0,
        CASE WHEN ux = vx THEN 1 ELSE greatest((x * 10 - ux) / (vx - ux), (x * 10 + 10 - ux) / (vx - ux)) END AS a1,
        CASE WHEN uy = vy THEN CASE WHEN uy > y * 10 AND uy < y * 10 + 10 THEN 0 ELSE 2 END ELSE least((y * 10 - uy) / (vy - uy), (y * 10 + 10 - uy) / (vy - uy)) END AS b0,
        CASE WHEN uy = vy THEN 1 ELSE greatest((y * 10 - uy) / (vy - uy), (y * 10 + 10 - uy) / (vy - uy)) END AS b1,
        (uy > y * 10 + 5) <> (vy > y * 10 + 5) AND x * 10 + 5 < ux + (y * 10 + 5 - uy) * (vx - ux) / nullif(vy - uy, 0) AS ray FROM tile JOIN e USING (k))
SELECT k AS id, x::INT AS x, y::INT AS y FROM t GROUP BY ALL HAVING bool_or(greatest(a0, b0, 0) < least(a1, b1, 1)) OR count(*) FILTER (ray) % 2 = 1""")
def j6_polygons(spark, sf):
    return polygons.polygon_tiles(footprints(spark, sf), ["id"], spatial.Grid((10.0, 10.0), 1.0))


REGIONS = OUTLINES + """, parts AS (SELECT p_partkey AS k, p_partkey % 3 AS kind, p_partkey % 157 * 4.25::DOUBLE AS x, p_partkey % 83 * 6.5::DOUBLE AS y FROM part),
areas AS (SELECT s_suppkey AS k, (s_suppkey + 1) % 3 AS kind, s_suppkey * 7 % 101 * 6.5::DOUBLE AS x, s_suppkey % 29 * 18.25::DOUBLE AS y, s_acctbal FROM supplier), """ + edge_sql("g", "parts", "parts.k", "parts.kind", "parts.x", "parts.y", 0.25) + ", " + edge_sql("e", "areas", "areas.k", "areas.kind", "areas.x", "areas.y", 1.5)
#: Pairs whose boxes meet, then edges that have a point in common, then a corner of one in the other.
MEETING = REGIONS + """, gb AS (SELECT k, min(ux) AS x0, max(ux) AS x1, min(uy) AS y0, max(uy) AS y1 FROM g GROUP BY k), eb AS (SELECT k, min(ux) AS x0, max(ux) AS x1, min(uy) AS y0, max(uy) AS y1 FROM e GROUP BY k),
near AS (SELECT gb.k AS region, eb.k AS area FROM gb JOIN eb ON gb.x0 <= eb.x1 AND gb.x1 >= eb.x0 AND gb.y0 <= eb.y1 AND gb.y1 >= eb.y0),
both_ AS (SELECT region, area, g.ux AS gax, g.uy AS gay, g.vx AS gbx, g.vy AS gby, e.ux, e.uy, e.vx, e.vy FROM near JOIN g ON g.k = region JOIN e ON e.k = area),
turn AS (SELECT *, sign((gbx - gax) * (uy - gay) - (gby - gay) * (ux - gax)) * sign((gbx - gax) * (vy - gay) - (gby - gay) * (vx - gax)) AS one, sign((vx - ux) * (gay - uy) - (vy - uy) * (gax - ux)) * sign((vx - ux) * (gby - uy) - (vy - uy) * (gbx - ux)) AS two,
         greatest(gax, gbx) >= least(ux, vx) AND greatest(ux, vx) >= least(gax, gbx) AND greatest(gay, gby) >= least(uy, vy) AND greatest(uy, vy) >= least(gay, gby) AS close FROM both_),
g_in AS (SELECT region, area FROM both_ GROUP BY region, area, gax, gay HAVING count(*) FILTER ((uy > gay) <> (vy > gay) AND gax < ux + (gay - uy) * (vx - ux) / nullif(vy - uy, 0)) % 2 = 1),
e_in AS (SELECT region, area FROM both_ GROUP BY region, area, ux, uy HAVING count(*) FILTER ((gay > uy) <> (gby > uy) AND ux < gax + (uy - gay) * (gbx - gax) / nullif(gby - gay, 0)) % 2 = 1),
pair AS (SELECT region, area FROM turn WHERE one <= 0 AND two <= 0 AND close UNION SELECT * FROM g_in UNION SELECT * FROM e_in)"""


def regions(spark, sf) -> tuple[DataFrame, DataFrame]:
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    p = spark.read.parquet(f"{sf}/part.parquet").select(k.alias("region"), F.format_string("x%dy%d", k % 157, k % 83).alias("region_code"))
    p = placed(p, F.col("region") % 3, F.col("region") % 157 * 4.25, F.col("region") % 83 * 6.5, 0.25)
    a = spark.read.parquet(f"{sf}/supplier.parquet").select(s.alias("area"), "s_acctbal")
    return p, placed(a, (F.col("area") + 1) % 3, F.col("area") * 7 % 101 * 6.5, F.col("area") % 29 * 18.25, 1.5)


@query("j10_polygon_pairs", MEETING + " SELECT region, area FROM pair")
def j10_pairs(spark, sf):
    p, a = regions(spark, sf)
    return polygons.meeting(p, a, ["region"], ["area"], polygons.Cells(6.0, 6.0))


@query("j10_polygon_regions", MEETING + " SELECT DISTINCT 'x' || region % 157 || 'y' || region % 83 AS region_code FROM pair JOIN areas ON area = areas.k WHERE s_acctbal > 0")
def j10_polygons(spark, sf):
    return spatial.regions_touched(*regions(spark, sf), "s_acctbal > 0", 6.0).select("region_code")


CITIES = OUTLINES + ", nations AS (SELECT n_nationkey AS k, n_nationkey % 3 AS kind, n_nationkey * 37 % 300 * 1.0::DOUBLE AS x, n_nationkey * 53 % 200 * 1.0::DOUBLE AS y FROM nation), " + edge_sql("e", "nations", "nations.k", "nations.kind", "nations.x", "nations.y", 4.0)


def nations(spark, sf) -> DataFrame:
    n = F.col("n_nationkey")
    return placed(spark.read.parquet(f"{sf}/nation.parquet").select(n), n % 3, n * 37 % 300 * 1.0, n * 53 % 200 * 1.0, 4.0)


@query("j9_polygon_tasks", CITIES + """, t AS (SELECT o_orderkey AS id, (o_orderkey % 47 - 3)::INT AS x, (o_orderkey % 31 - 2)::INT AS y FROM orders), u AS (SELECT DISTINCT x, y FROM t),
c AS (SELECT x, y, k, bool_or(greatest(least((x * 10 - ux) / nullif(vx - ux, 0), (x * 10 + 10 - ux) / nullif(vx - ux, 0)), least((y * 10 - uy) / nullif(vy - uy, 0), (y * 10 + 10 - uy) / nullif(vy - uy, 0)), 0)
        <= least(greatest((x * 10 - ux) / nullif(vx - ux, 0), (x * 10 + 10 - ux) / nullif(vx - ux, 0)), greatest((y * 10 - uy) / nullif(vy - uy, 0), (y * 10 + 10 - uy) / nullif(vy - uy, 0)), 1)
        AND (ux <> vx OR ux BETWEEN x * 10 AND x * 10 + 10) AND (uy <> vy OR uy BETWEEN y * 10 AND y * 10 + 10)) AS border,
        count(*) FILTER ((uy > y * 10 + 5) <> (vy > y * 10 + 5) AND x * 10 + 5 < ux + (y * 10 + 5 - uy) * (vx - ux) / nullif(vy - uy, 0)) % 2 = 1 AS inside FROM u, e GROUP BY ALL)
SELECT id, x, y FROM t SEMI JOIN (SELECT * FROM c WHERE border OR inside) AS hit USING (x, y)""")
def j9_polygons(spark, sf):
    o = F.col("o_orderkey")
    t = spark.read.parquet(f"{sf}/orders.parquet").select(o.alias("id"), (o % 47 - 3).cast("int").alias("x"), (o % 31 - 2).cast("int").alias("y"))
    return polygons.tiles_meeting(t, nations(spark, sf), spatial.Grid((10.0, 10.0), 1.0))


@query("j11_points_in_polygons", CITIES + """, p AS (SELECT c_custkey, c_custkey % 397 * 1.0625::DOUBLE AS x, c_custkey % 311 * 1.1875::DOUBLE AS y FROM customer)
SELECT c_custkey, k AS n_nationkey FROM p, e WHERE (uy > y) <> (vy > y) AND x < ux + (y - uy) * (vx - ux) / nullif(vy - uy, 0) GROUP BY ALL HAVING count(*) % 2 = 1""")
def j11_points(spark, sf):
    c = F.col("c_custkey")
    p = spark.read.parquet(f"{sf}/customer.parquet").select(c, (c % 397 * 1.0625).alias("px"), (c % 311 * 1.1875).alias("py"))
    return polygons.points_within(p, "px", "py", nations(spark, sf), ["n_nationkey"], polygons.Cells(8.0, 8.0)).select("c_custkey", "n_nationkey")


ZONE, ALBERS = "EPSG:32755", "EPSG:3577"
NATIVE = reproject.Raster(ZONE, (520000.0, 6110000.0), (30.0, -30.0))
FINE, COARSE = (reproject.Raster(ALBERS, (0.0, 0.0), (s, -s)) for s in (20.0, 100.0))
PIXELS = "px AS (SELECT l_orderkey % 160 AS y, l_partkey % 140 AS x, sum(l_quantity * 100)::BIGINT AS v, (CASE WHEN count(*) % 3 > 0 THEN min(l_suppkey) END)::BIGINT AS s FROM lineitem GROUP BY ALL)"


def native_pixels(spark, sf) -> DataFrame:
    t = spark.read.parquet(f"{sf}/lineitem.parquet")
    n = F.count(F.lit(1))
    return t.groupBy((F.col("l_orderkey") % 160).alias("y"), (F.col("l_partkey") % 140).alias("x")).agg(F.sum(F.col("l_quantity") * 100).cast("bigint").alias("v"), F.when(n % 3 > 0, F.min("l_suppkey")).cast("bigint").alias("s"))


def steps_sql(name: str, table: str, source: reproject.Raster, target: reproject.Raster, x: str, y: str, keep: str) -> str:
    """CTEs that take points (column x, row y) of table from one raster to the other: {name} has keep, u and v."""
    a, b = source.point(x, y)
    lon, lat = projection(source.crs).inverse("u", "v")
    c, d = projection(target.crs).forward("u", "v")
    e, f = target.place("u", "v")
    keep = keep + ", " if keep else ""
    return f"{name}1 AS (SELECT {keep}{a} AS u, {b} AS v FROM {table}), {name}2 AS (SELECT {keep}{lon} AS u, {lat} AS v FROM {name}1), {name}3 AS (SELECT {keep}{c} AS u, {d} AS v FROM {name}2), {name} AS (SELECT {keep}{e} AS u, {f} AS v FROM {name}3)"


def pulled(target: reproject.Raster) -> str:
    """Every target pixel (i, j) of the data's range with its centre's place u, v on the source."""
    there = steps_sql("there", "(SELECT y, x FROM px)", NATIVE, target, "(x + 0.5)", "(y + 0.5)", "")
    grid = "r AS (SELECT floor(min(u))::BIGINT - 9 AS i0, ceil(max(u))::BIGINT + 9 AS i1, floor(min(v))::BIGINT - 9 AS j0, ceil(max(v))::BIGINT + 9 AS j1 FROM there), grid AS (SELECT i, unnest(generate_series(j0, j1)) AS j FROM (SELECT *, unnest(generate_series(i0, i1)) AS i FROM r))"
    return f"{PIXELS}, {there}, {grid}, " + steps_sql("back", "grid", target, NATIVE, "(i + 0.5)", "(j + 0.5)", "i, j")


@query("r1_project_nearest", pulled(FINE) + " SELECT j AS y, i AS x, px.v, px.s FROM back JOIN px ON px.x = floor(u)::BIGINT AND px.y = floor(back.v)::BIGINT")
def project_nearest(spark, sf):
    return reproject.reproject(native_pixels(spark, sf), NATIVE, FINE, ["v", "s"])


@query("r1_project_bilinear", pulled(FINE) + """, n AS (SELECT j AS y, i AS x, px.v AS value, px.s, (1 - abs(u - (px.x + 0.5))) * (1 - abs(back.v - (px.y + 0.5))) AS w FROM back JOIN (SELECT unnest([0, 1]) AS dx) ON true JOIN (SELECT unnest([0, 1]) AS dy) ON true
  JOIN px ON px.x = floor(u - 0.5)::BIGINT + dx AND px.y = floor(back.v - 0.5)::BIGINT + dy)
SELECT y, x, round(sum(value * w) / sum(w), 0)::BIGINT AS v, round(sum(s * w) / sum(w) FILTER (s IS NOT NULL), 0)::BIGINT AS s FROM n WHERE w > 0 GROUP BY ALL""")
def project_bilinear(spark, sf):
    return reproject.reproject(native_pixels(spark, sf), NATIVE, FINE, ["v", "s"], "bilinear").select("y", "x", F.round("v").cast("bigint").alias("v"), F.round("s").cast("bigint").alias("s"))


@query("r1_project_average", f"{PIXELS}, " + steps_sql("there", "px", NATIVE, COARSE, "(x + 0.5)", "(y + 0.5)", "v AS value, s").replace("SELECT v AS value, s, ", "SELECT value, s, ").replace("FROM px)", "FROM (SELECT *, v AS value FROM px))") + " SELECT floor(v)::BIGINT AS y, floor(u)::BIGINT AS x, avg(value)::DOUBLE AS v, avg(s)::DOUBLE AS s FROM there GROUP BY 1, 2")
def project_average(spark, sf):
    return reproject.reproject(native_pixels(spark, sf), NATIVE, COARSE, ["v", "s"], "average")


ZONES = {"EPSG:32755": NATIVE, "EPSG:32754": reproject.Raster("EPSG:32754", (1068000.0, 6093000.0), (30.0, -30.0))}
TILED = spatial.Grid((3000.0, 3000.0), 50.0, crs=ALBERS)


@query("src7_native_load", """px AS (SELECT l_linenumber % 4 AS dataset_id, l_orderkey % 160 AS y, l_partkey % 140 AS x, sum(l_quantity * 100)::BIGINT AS v FROM lineitem GROUP BY ALL),
""" + ", ".join(steps_sql(f"z{k}", f"(SELECT * FROM px WHERE dataset_id % 2 = {k})", raster, reproject.Raster.of(TILED), "(x + 0.5)", "(y + 0.5)", "dataset_id, value").replace("(SELECT * FROM px", "(SELECT *, v AS value FROM px") for k, raster in enumerate(ZONES.values())) + """,
g AS (SELECT dataset_id, floor(u)::BIGINT AS i, -floor(v)::BIGINT - 1 AS j, avg(value)::DOUBLE AS v FROM (SELECT * FROM z0 UNION ALL SELECT * FROM z1) GROUP BY 1, 2, 3),
t AS (SELECT dataset_id, floor(i / 60)::INT AS tile_x, floor(j / 60)::INT AS tile_y, i, j, v FROM g)
SELECT 'p' AS period, tile_x, tile_y, dataset_id, 59 - (j - tile_y * 60) AS y, i - tile_x * 60 AS x, v FROM t WHERE tile_x % 2 = 0 AND dataset_id < 3""")
def native_load(spark, sf):
    t = spark.read.parquet(f"{sf}/lineitem.parquet")
    of = F.col("l_linenumber") % 4
    native = t.groupBy(of.alias("dataset_id"), (F.col("l_orderkey") % 160).alias("y"), (F.col("l_partkey") % 140).alias("x")).agg(F.sum(F.col("l_quantity") * 100).cast("bigint").alias("v"))
    native = native.withColumn("crs", F.when(F.col("dataset_id") % 2 == 0, "EPSG:32755").otherwise("EPSG:32754"))
    tiles = spark.range(440, 480, 2).select(F.col("id").cast("int").alias("x")).crossJoin(spark.range(-1320, -1300).select(F.col("id").cast("int").alias("y")))
    tasks = tiles.select(F.lit("p").alias("period"), "x", "y", F.array(*(F.lit(i).cast("long") for i in range(3))).alias("dataset_ids"))
    return reproject.load_native(tasks, native.withColumn("dataset_id", F.col("dataset_id").cast("long")), ZONES, TILED, ["v"], "average").select("period", "tile_x", "tile_y", "dataset_id", "y", "x", "v")


CORNERS = "SELECT " + ", ".join(f"{a} AS x{i}, {b} AS y{i}" for i, (a, b) in enumerate((("x * 96e3", "y * 96e3"), ("x * 96e3", "y * 96e3 + 96e3"), ("x * 96e3 + 96e3", "y * 96e3 + 96e3"), ("x * 96e3 + 96e3", "y * 96e3"))))


@query("k2_item_geometry", SCENES + """, t AS (SELECT DISTINCT strftime(center_time, '%Y-%m') || '--P1M' AS period, x - 3 AS x, y - 30 AS y FROM scenes), c AS (SELECT period, x, y, """ + CORNERS.removeprefix("SELECT ") + """ FROM t),
p AS (SELECT period, x, y, k, e, [x0, x1, x2, x3][e + 1] + ([x1, x2, x3, x0][e + 1] - [x0, x1, x2, x3][e + 1]) * (k / 8) AS u, [y0, y1, y2, y3][e + 1] + ([y1, y2, y3, y0][e + 1] - [y0, y1, y2, y3][e + 1]) * (k / 8) AS v FROM c, range(8) AS s(k), range(4) AS r(e)),
d AS (SELECT period, x, y, e * 8 + k AS n, """ + "{0} AS lon, {1} AS lat".format(*projection(ALBERS).inverse("u", "v")) + """ FROM p)
SELECT period, x, y, (count(*) + 1)::INT AS points, round(min(lon), 6) AS west, round(min(lat), 6) AS south, round(max(lon), 6) AS east, round(max(lat), 6) AS north, round(any_value(lon) FILTER (n = 13), 6) AS lon_13, round(any_value(lat) FILTER (n = 13), 6) AS lat_13 FROM d GROUP BY ALL""")
def k2_geometry(spark, sf):
    from chronocell.operators import planner
    from chronocell.sources import sinks

    s = scenes(spark, sf).withColumns({"period": F.date_format("center_time", "yyyy-MM'--P1M'"), "x": F.col("x") - 3, "y": F.col("y") - 30})
    d = sinks.item_documents(planner.tasks_of(s), "gm", ["red"], "s3://b", spatial.Grid((96000.0, 96000.0), 32.0, crs=ALBERS))
    j = F.from_json("document", "bbox array<double>, geometry struct<coordinates:array<array<array<double>>>>")
    ring = j["geometry"]["coordinates"][0]
    values = {"west": j["bbox"][0], "south": j["bbox"][1], "east": j["bbox"][2], "north": j["bbox"][3], "lon_13": ring[13][0], "lat_13": ring[13][1]}
    return d.select("period", "x", "y", F.size(ring).alias("points"), *[F.round(c, 6).alias(n) for n, c in values.items()])
