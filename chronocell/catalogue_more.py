"""Further queries with SQL: planning operators, scalar expressions, models, summaries over metadata, sinks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from chronocell.catalogue import HOURLY, LOCAL, OBS, SCENES, SQL, hourly, obs, query, scenes, shipped
from chronocell.functions import pixels
from chronocell.functions.periods import Period
from chronocell.functions.tables import folder
from chronocell.operators import geomedian, models, morphology, planner, polygons, spatial, summaries
from chronocell.operators.landcover import CultivatedClass, UrbanClass, WoodyCover
from chronocell.operators.summaries import execute
from chronocell.sources import scene_store, sinks
from chronocell.streaming import tasks as streams

PROPERTIES = SCENES + """, e AS (SELECT s.*, v.value, CASE product WHEN 'click' THEN 'ls8_sr' WHEN 'view' THEN 'ls5_sr' ELSE product END AS sensor, CASE WHEN id % 3 = 0 THEN 'T1' ELSE 'T2' END AS category FROM scenes s JOIN events v ON v.event_id = s.id)"""


def described(spark, sf):
    """Scenes with properties; two of the event types stand for the sensors held to a category."""
    e = scenes(spark, sf).join(spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_id").alias("id"), "value"), "id")
    p = F.create_map(F.lit("gqa_iterative_mean_xy"), F.col("value").cast("string"), F.lit("collection_category"), F.when(F.col("id") % 3 == 0, "T1").otherwise("T2"), F.lit("platform"), F.col("product"))
    return e.withColumns({"properties": p, "product": F.when(F.col("product") == "click", "ls8_sr").when(F.col("product") == "view", "ls5_sr").otherwise(F.col("product"))})


@query("src1_scan", PROPERTIES + " SELECT id FROM e WHERE sensor IN ('ls8_sr', 'purchase') AND center_time BETWEEN TIMESTAMP '2024-01-04 09:36:00' AND TIMESTAMP '2024-01-15 14:23:59.999999' AND category = 'T1'")
def src1(spark, sf):
    return planner.scan(described(spark, sf), ["ls8_sr", "purchase"], Period.parse("2024-01-05--P10D"), planner.PAD_DAYS, {"collection_category": "T1"}).select("id")


@query("src2_timeless_scan", PROPERTIES + " SELECT id, sensor AS product FROM e WHERE (sensor = 'ls8_sr' AND center_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-14 23:59:59.999999') OR sensor = 'purchase'")
def src2(spark, sf):
    return planner.scan(described(spark, sf), ["ls8_sr", "purchase"], Period.parse("2024-01-05--P10D"), ignore_time=("purchase",)).select("id", "product")


@query("f3_quality", PROPERTIES + " SELECT id FROM e WHERE value <= 40")
def f3(spark, sf):
    return described(spark, sf).where(planner.quality(40.0)).select("id")


@query("f4_category", PROPERTIES + " SELECT id FROM e WHERE sensor NOT IN ('ls5_sr', 'ls8_sr') OR category = 'T1'")
def f4(spark, sf):
    return described(spark, sf).where(planner.collection("T1")).select("id")


@query("f6_tiles", SCENES + " SELECT id FROM scenes WHERE x >= 1 AND x < 5 AND y >= 2 AND y < 4")
def f6(spark, sf):
    return scenes(spark, sf).where(planner.in_tiles((1, 5), (2, 4))).select("id")


BOXES = SCENES + ", f AS (SELECT id, x * 10.0 AS a, x * 10.0 + 12.0 AS c, y * 10.0 - 3.0 AS b, y * 10.0 + 2.0 AS d, x, y FROM scenes)"


def boxes(spark, sf):
    return scenes(spark, sf).withColumns({"min_x": F.col("x") * 10.0, "max_x": F.col("x") * 10.0 + 12, "min_y": F.col("y") * 10.0 - 3, "max_y": F.col("y") * 10.0 + 2})


@query("f7_footprints", BOXES + " SELECT id FROM f WHERE a <= 30 AND c >= 10 AND b <= 40 AND d >= 20")
def f7(spark, sf):
    return boxes(spark, sf).where(spatial.boxes_meet(spatial.Grid((10.0, 10.0), 1.0).extent((1, 3), (2, 4)))).select("id")


@query("f8_exact_prune", LOCAL + " SELECT id FROM t WHERE t BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1999-12-31 23:59:59.999999'")
def f8(spark, sf):
    return planner.exact_prune(shipped(spark, sf), Period.parse("1998--P2Y")).select("id")


@query("j3_timeless_copies", SCENES + HOURLY + """, s AS (SELECT id, product, hour, region_code AS r, product || '_' || strftime(hour, '%Y%m%d') AS label FROM h),
x AS (SELECT * FROM s WHERE product = 'purchase'), t AS (SELECT * FROM s WHERE product <> 'purchase'),
g AS (SELECT hour, r, arg_min({'p': product, 'l': label}, product || lpad(id::VARCHAR, 12, '0')) AS lead FROM t GROUP BY ALL)
SELECT id, hour AS center_time, r AS region_code, label FROM t WHERE r IN (SELECT r FROM x) UNION ALL SELECT x.id, g.hour, x.r, x.product || replace(g.lead.l, g.lead.p, '') FROM g JOIN x USING (r)""")
def j3_copies(spark, sf):
    s = scenes(spark, sf).withColumn("center_time", F.date_trunc("hour", "center_time")).withColumns({"label": F.concat_ws("_", "product", F.date_format("center_time", "yyyyMMdd")), "properties": F.create_map(F.lit("datetime"), F.col("center_time").cast("string"))})
    extra = s.where("product = 'purchase'")
    return planner.with_timeless(s.where("product <> 'purchase'"), extra).select("id", "center_time", "region_code", "label")


def fusable(spark, sf):
    """At most one scene a product, hour and region."""
    s = hourly(spark, sf).groupBy("center_time", "region_code", "product").agg(F.min("id").alias("id"))
    when = F.date_format("center_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    s = s.withColumns({
        "label": F.concat("product", F.date_format("center_time", "'_'yyyyMMddHH")), "schema": F.lit("s"), "crs": F.when(F.col("id") % 2 == 0, "epsg:1").otherwise("EPSG:1"),
        "properties": F.create_map(F.lit("datetime"), when, F.lit("a"), F.lit("same"), F.lit("b"), F.col("id").cast("string")),
        "measurements": F.create_map(F.col("product"), F.concat(F.col("id").cast("string"), F.lit(".tif"))),
        "grids": F.create_map(F.lit("default"), F.struct(F.array(F.lit(4), F.lit(4)).alias("shape"), F.array(*map(F.lit, (1.0, 0.0, 0.0, 0.0, -1.0, 0.0, 0.0))).alias("transform"))),
    })
    groups = planner.fuse_join(s, 1)
    return s.join(groups.select(*planner.KEY), list(planner.KEY), "left_semi")


@query("j5_fuse_scenes", SCENES + HOURLY + """, s AS (SELECT hour, (CAST(region_code AS INT) % 10)::VARCHAR AS r, product, min(id) AS id FROM h GROUP BY ALL),
g AS (SELECT hour, r, count(*) AS n, string_agg(product, '__' ORDER BY product, id) AS names, string_agg(product || '=' || id || '.tif', ',' ORDER BY product) AS bands, string_agg(id::VARCHAR, ',' ORDER BY product, id) AS sources, list_sort(list(id::VARCHAR)) AS ids FROM s GROUP BY ALL HAVING count(*) >= 2),
u AS (SELECT *, lower(concat_ws(chr(10), 'fused__' || names, '0.0.0', '', array_to_string(ids, chr(10)))) AS name FROM g),
k AS (SELECT *, sha1(unhex('6f34c6f413d643c08e4e42b6c13203af') || encode(name)) AS d FROM u)
SELECT hour AS center_time, r AS region_code, 'fused__' || names AS product, 'fused__' || names || strftime(hour, '_%Y%m%d%H') AS label, bands, sources, 'a=same,datetime=' || strftime(hour, '%Y-%m-%dT%H:%M:%S+00:00') || ',fused=True' AS properties,
       concat_ws('-', d[1:8], d[9:12], '5' || d[14:16], ['8', '9', 'a', 'b'][('0x' || d[17:17])::INT % 4 + 1] || d[18:20], d[21:32]) AS id FROM k""")
def j5(spark, sf):
    f = planner.fuse_scenes(fusable(spark, sf))
    pairs = lambda c: F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")
    return f.select("center_time", "region_code", "product", "label", pairs("measurements").alias("bands"), F.array_join("sources", ",").alias("sources"), pairs("properties").alias("properties"), "id")


@query("j9_polygon_tiles", SCENES + " SELECT DISTINCT x, y FROM scenes WHERE x * 10 <= 37.0 AND x * 10 + 10 >= 12.5 AND y * 10 <= 21.0 AND y * 10 + 10 >= 5.0")
def j9(spark, sf):
    t = scenes(spark, sf).select("x", "y").dropDuplicates()
    area = spark.range(1).select(polygons.box(*map(F.lit, (12.5, 5.0, 37.0, 21.0))).alias("rings"))
    return polygons.tiles_meeting(t, area, spatial.Grid((10.0, 10.0), 1.0))


@query("j10_regions", BOXES + """, g AS (SELECT DISTINCT 'x' || x || 'y' || y AS region_code, x * 10.0 AS a, x * 10.0 + 9.5 AS c, y * 10.0 AS b, y * 10.0 + 9.5 AS d FROM f)
SELECT DISTINCT region_code FROM g JOIN f e ON g.a <= e.c AND g.c >= e.a AND g.b <= e.d AND g.d >= e.b""")
def j10(spark, sf):
    b = boxes(spark, sf)
    g = b.select(F.format_string("x%dy%d", "x", "y").alias("region_code"), (F.col("x") * 10.0).alias("min_x"), (F.col("x") * 10.0 + 9.5).alias("max_x"), (F.col("y") * 10.0).alias("min_y"), (F.col("y") * 10.0 + 9.5).alias("max_y")).dropDuplicates()
    return spatial.regions_touched(g, b).select("region_code")


@query("j12_aligned", OBS + ", a AS (SELECT y, x, max(red) AS red, count(*) AS n FROM obs WHERE fmask <> 1 GROUP BY ALL), b AS (SELECT y, x, min(red) AS red FROM obs WHERE water = 0 GROUP BY ALL) SELECT y, x, a.red AS a_red, b.red AS b_red, n FROM a JOIN b USING (y, x)")
def j12(spark, sf):
    o = obs(spark, sf)
    a = o.where("fmask <> 1").groupBy("y", "x").agg(F.max("red").alias("red"), F.count(F.lit(1)).alias("n"))
    b = o.where("water = 0").groupBy("y", "x").agg(F.min("red").alias("red"))
    return planner.aligned({"a": a, "b": b}).withColumnsRenamed({"a.red": "a_red", "b.red": "b_red"})


def seasons(name: str, frequency: str, months: int, anchor: int, only: bool = False, period: str | None = None):
    """SQL of seasons of months months from the anchor month on: months since the anchor, counted from year 0."""
    label = "P1Y" if months == 12 else f"P{months}M"
    since = f"(year(t) * 12 + month(t) - {anchor})"
    start = f"({since} // 12 * 12)" if only else f"({since} // {months} * {months})"
    where = f" WHERE {since} % 12 < {months}" if only else ""

    @query(name, LOCAL + f", s AS (SELECT id, {start} + {anchor} - 1 AS m FROM t{where}) SELECT id, (m // 12)::VARCHAR || '-' || lpad((m % 12 + 1)::VARCHAR, 2, '0') || '--{label}' AS period FROM s")
    def binned(spark, sf):
        return planner.binned(shipped(spark, sf), frequency, Period.parse(period) if period else None).select("id", "period")


seasons("b3_semiannual", "semiannual", 6, 1)
seasons("b3_quarters", "quartely", 3, 1)
seasons("b3_fiscal_year", "annual-fy", 12, 7)
seasons("b4_apr_oct", "apr-oct", 7, 4, True)
seasons("b7_seasons_of_a_range", "3month-seasons", 3, 2, False, "1997-02--P4Y")

FLAGS = {"cloud": {"bits": 6, "values": {"1": "yes", "0": "no"}}, "level": {"bits": [8, 9], "values": {"3": "high"}}}


@query("e3_flag_masks", OBS + " SELECT id, l_linenumber, (water & 64) <> 0 AS cloudy, (blue & (64 + 768)) = 0 AS low FROM obs")
def e3(spark, sf):
    o = obs(spark, sf)
    return o.select("id", "l_linenumber", pixels.any_bit("water", pixels.flag_mask(FLAGS, cloud="yes")).alias("cloudy"), pixels.no_bit("blue", pixels.flag_mask(FLAGS, cloud="yes", level="high")).alias("low"))


SIX = OBS + ", o AS (SELECT *, blue + 7 AS swir1, nir + 9 AS swir2 FROM obs)"
ND = "({0} - {1})::DOUBLE / nullif({0} + {1}, 0)"
WET = " + ".join(f"{b} * {w}::DOUBLE" for b, w in zip(models.BANDS, pixels.TASSELLED_CAP["wet"], strict=True))


def six(spark, sf):
    return obs(spark, sf).withColumns({"swir1": F.col("blue") + 7, "swir2": F.col("nir") + 9})


@query("e10_spectral_indices", SIX + f""" SELECT id, l_linenumber, {ND.format("green", "swir1")} AS mndwi, {ND.format("swir1", "nir")} - {ND.format("nir", "red")} AS bui, ((swir1 + red) - (nir + blue))::DOUBLE / nullif((swir1 + red) + (nir + blue), 0) AS bsi,
  {WET} AS tcw, {ND.format("nir", "swir1")} AS ndmi, blue + 2.5::DOUBLE * green - 1.5::DOUBLE * (nir + swir1) - 0.25::DOUBLE * swir2 AS awei_sh, (red + 0.3::DOUBLE) / nullif(green + swir1, 0) AS baei, {ND.format("green", "swir1")} AS ndsi FROM o""")
def e10_all(spark, sf):
    return six(spark, sf).select("id", "l_linenumber", *[c.alias(n) for n, c in pixels.spectral_indices().items()])


@query("e11_norm_e12_composite", OBS + """ SELECT id, l_linenumber, greatest(sqrt((blue * blue + red * red)::DOUBLE), 1e-8::DOUBLE) AS norm,
  round_even((least(greatest(blue, 1), 3000) - 1) * 255.0::DOUBLE / 2999, 0)::INT AS r, round_even((least(greatest(red, 1), 3000) - 1) * 255.0::DOUBLE / 2999, 0)::INT AS g, round_even((least(greatest(nir, 1), 3000) - 1) * 255.0::DOUBLE / 2999, 0)::INT AS b, 255 AS a FROM obs""")
def e11(spark, sf):
    o = obs(spark, sf).select("id", "l_linenumber", pixels.norm(("blue", "red")).alias("norm"), pixels.rgba(("blue", "red", "nir")).alias("c"))
    return o.select("id", "l_linenumber", "norm", *[F.col(f"c.{k}").cast("int").alias(k) for k in "rgba"])


@query("m1_masked", OBS + " SELECT id, l_linenumber, CASE WHEN blue > 2500 THEN blue::DOUBLE END AS blue, fmask = 3 AS selected FROM obs")
def m1(spark, sf):
    return models.masked(obs(spark, sf), ["blue"], "fmask", 3, 2500).select("id", "l_linenumber", "blue", "selected")


@query("m2_predict", OBS + " SELECT id, l_linenumber, CASE WHEN blue > 2500 AND fmask = 3 THEN round(blue * 0.25::DOUBLE + red, 6) ELSE 255 END AS prediction FROM obs")
def m2(spark, sf):
    o = models.masked(obs(spark, sf).withColumn("red", F.col("red").cast("double")), ["blue"], "fmask", 3, 2500)
    return models.predict(o, ["blue", "red"], lambda: lambda f: f[:, 0] * 0.25 + f[:, 1], False, "plain").select("id", "l_linenumber", "prediction")


NORMED = SIX + ", u AS (SELECT *, greatest(sqrt((" + " + ".join(f"{b} * {b}" for b in models.BANDS) + ")::DOUBLE), 1e-8::DOUBLE) AS q FROM o), n AS (SELECT id, l_linenumber, " + ", ".join(f"{b} / q AS {b}" for b in models.BANDS) + " FROM u)"
PLAIN = "({0} - {1}) / nullif({0} + {1}, 0)"


@query("m3_tree_feature_values", NORMED + f""" SELECT id, l_linenumber, blue, green, swir1, swir2, 0.1::DOUBLE AS sdev, 50.0::DOUBLE / 1e4::DOUBLE AS edev, 0.2::DOUBLE AS bcdev, {PLAIN.format("green", "swir1")} AS mndwi, {PLAIN.format("swir1", "nir")} - {PLAIN.format("nir", "red")} AS bui,
  ((swir1 + red) - (nir + blue)) / nullif((swir1 + red) + (nir + blue), 0) AS bsi, {WET} AS tcw, {PLAIN.format("nir", "swir1")} AS ndmi, blue + 2.5::DOUBLE * green - 1.5::DOUBLE * (nir + swir1) - 0.25::DOUBLE * swir2 AS awei_sh, (red + 0.3::DOUBLE) / nullif(green + swir1, 0) AS baei, {PLAIN.format("green", "swir1")} AS ndsi FROM n""")
def m3_values(spark, sf):
    o = six(spark, sf).withColumns({"sdev": F.lit(0.1), "edev": F.lit(50.0), "bcdev": F.lit(0.2)})
    return models.tree_features(o).select("id", "l_linenumber", *models.FEATURES)


PATCHES = OBS + ", p AS (SELECT solar_day, y, x, max(blue)::DOUBLE AS a, max(red)::DOUBLE AS b FROM obs GROUP BY ALL)"


@query("m5_patches", PATCHES + " SELECT solar_day, y, x, (a / greatest(sqrt(a * a + b * b), 1e-8::DOUBLE) > 0.5)::INT::DOUBLE AS prediction FROM p")
def m5(spark, sf):
    p = obs(spark, sf).groupBy("solar_day", "y", "x").agg(F.max("blue").cast("double").alias("a"), F.max("red").cast("double").alias("b"))
    return models.predict_patches(p, ["a", "b"], lambda: lambda f: f[..., 0], ["solar_day"], 16, "first").select("solar_day", "y", "x", "prediction")


def shape(radius: int) -> str:
    return ", ".join(f"({i}, {j})" for i, j in morphology.disk(radius))


CLEAN = OBS + f""", d AS (SELECT solar_day, y, x, bool_or(fmask = 3) AS m, bool_or(fmask <> 0) AS v FROM obs GROUP BY ALL),
r AS (SELECT solar_day, min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1 FROM d GROUP BY ALL),
c AS (SELECT solar_day, y, unnest(generate_series(x0, x1)) AS x FROM (SELECT *, unnest(generate_series(y0, y1)) AS y FROM r)), one(i, j) AS (VALUES {shape(1)}), two(i, j) AS (VALUES {shape(2)}),
full_ AS (SELECT c.*, coalesce(m, false) AS m FROM c LEFT JOIN d USING (solar_day, y, x)),
gone AS (SELECT DISTINCT solar_day, y + i AS y, x + j AS x FROM full_, one WHERE NOT m), e AS (SELECT f.solar_day, f.y, f.x, g.y IS NULL AS m FROM full_ f LEFT JOIN gone g USING (solar_day, y, x)),
o1 AS (SELECT DISTINCT solar_day, y + i AS y, x + j AS x FROM e, one WHERE m), o2 AS (SELECT c.solar_day, y, x FROM c SEMI JOIN o1 USING (solar_day, y, x)), w AS (SELECT DISTINCT solar_day, y + i AS y, x + j AS x FROM o2, two),
clean AS (SELECT d.*, w.y IS NOT NULL AS wide FROM d LEFT JOIN w USING (solar_day, y, x))"""
STEPS = [("opening", 1), ("dilation", 2)]


@query("n1_cleanup", CLEAN + " SELECT solar_day, y, x, wide FROM clean")
def n1(spark, sf):
    d = obs(spark, sf).groupBy("solar_day", "y", "x").agg(F.bool_or(F.col("fmask") == 3).alias("m"))
    return morphology.cleanup_images(d, {"wide": ("m", STEPS)}, ["solar_day"]).select("solar_day", "y", "x", "wide")


@query("a3_pq_cleaned", CLEAN + " SELECT y, x, count(*) FILTER (v) AS total, count(*) FILTER (v AND NOT m) AS clear, count(*) FILTER (v AND NOT wide) AS clear_1_2 FROM clean GROUP BY ALL")
def a3_cleaned(spark, sf):
    return execute(obs(spark, sf), summaries.PixelQuality({"clear_1_2": STEPS}, 0, (3,), "fmask"))


@query("u4_fuse_mixed", OBS + " SELECT y, x, solar_day, arg_min(red, (id * 10 + l_linenumber, red)) FILTER (red > 700) AS red, bool_or((water & 64) <> 0) AS cloud_mask FROM obs GROUP BY ALL")
def u4(spark, sf):
    g = geomedian.GeomedianBits(("red",), "water", 64, 0, None, -7.0, 0.01)
    o = obs(spark, sf).withColumn("time", F.col("id") * 10 + F.col("l_linenumber"))
    return g.prepare(o, ["time"]).groupBy("y", "x", "solar_day").agg(*g.fuse())


@query("a8_geomedian_bits_one_band", OBS + """, d AS (SELECT y, x, solar_day, arg_min(red, (id * 10 + l_linenumber, red)) FILTER ((water & 1) = 0 AND red > 200) AS red, bool_or((water & 64) <> 0) AS c FROM obs GROUP BY ALL),
v AS (SELECT *, median(red) FILTER (NOT c) OVER (PARTITION BY y, x) AS m FROM d)
SELECT y, x, coalesce(round_even(any_value(m) * (0.001::DOUBLE * 100) + -0.2::DOUBLE * 100, 0)::INT, 0) AS red, coalesce(round_even((median(abs(red - m)) FILTER (NOT c)) * (0.001::DOUBLE * 100) + 0.0::DOUBLE, 0)::INT, 0) AS emad, (count(red) FILTER (NOT c))::INT AS count FROM v GROUP BY ALL""")
def a8_one(spark, sf):
    o = obs(spark, sf).withColumn("time", F.col("id") * 10 + F.col("l_linenumber"))
    return geomedian.GeomedianBits(("red",), "water", 64, 1, None, -0.2, 0.001, 100).run(o).select("y", "x", "red", "emad", "count")


IMAGES = SIX + """, k AS (SELECT *, id * 10 + l_linenumber AS t FROM o),
i AS (SELECT y, x, l_linenumber AS image, arg_min(blue, (t, blue)) AS blue, arg_min(green, (t, green)) AS green, arg_min(red, (t, red)) AS red, arg_min(nir, (t, nir)) AS nir, arg_min(fmask, (t, fmask)) AS code FROM k GROUP BY ALL), c AS (SELECT *, max(code) OVER (PARTITION BY y, x) = 5 AS chosen FROM i)"""


def imaged(spark, sf):
    more = {"time": F.col("id") * 10 + F.col("l_linenumber"), "dataset_id": F.col("l_linenumber"), "classes_l3_l4": F.col("fmask"), "sdev": F.col("red"), "edev": F.lit(1.0), "bcdev": F.lit(0.5), "period": F.lit("p")}
    return six(spark, sf).withColumns(more)


@query("a15_woody_cover", IMAGES + " SELECT y, x, CASE WHEN NOT any_value(chosen) THEN 255 WHEN bool_or(blue::DOUBLE / 50 <= 20) THEN 114 ELSE 113 END AS woody_cover FROM c GROUP BY ALL")
def a15(spark, sf):
    s = WoodyCover(lambda: lambda f: f[:, 0] / 50, mask_bands={"classes_l3_l4": 5})
    return s.run(imaged(spark, sf), tile=["period"]).select("y", "x", "woody_cover")


@query("a14_cultivated_class", IMAGES + " SELECT y, x, CASE WHEN NOT any_value(chosen) THEN 255 WHEN bool_or(red < 900) THEN 111 ELSE 112 END AS cultivated_class FROM c GROUP BY ALL")
def a14(spark, sf):
    s = CultivatedClass(lambda: lambda f: np.stack([f[:, 4] < 900, f[:, 4] >= 900], 1).astype(float), mask_bands={"classes_l3_l4": 5})  # sdev holds red
    return s.run(imaged(spark, sf), tile=["period"]).select("y", "x", "cultivated_class")


@query("a16_urban_class", IMAGES + """, g AS (SELECT DISTINCT y, x FROM i), j AS (SELECT y, x, image FROM g, (SELECT DISTINCT image FROM i)),
f AS (SELECT j.*, coalesce(i.blue, first_value(i.blue IGNORE NULLS) OVER w) AS blue, coalesce(i.red, first_value(i.red IGNORE NULLS) OVER w) AS red FROM j LEFT JOIN i USING (y, x, image) WINDOW w AS (PARTITION BY j.y, j.x ORDER BY j.image ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT y, x, CASE WHEN bool_or(blue > red) THEN 215 ELSE 216 END AS urban_classes FROM f GROUP BY ALL""")
def a16(spark, sf):
    s = UrbanClass(lambda: lambda f: (f[..., 0] > f[..., 2]).astype(float), crop_size=16)
    return s.run(imaged(spark, sf), tile=["period"]).select("y", "x", "urban_classes")


@query("r2_native_then_average", OBS + """, n AS (SELECT y, x, time, solar_day, id, l_linenumber, ((water & 1) = 0 AND (water & 127) <> 0)::INT AS bad FROM obs)
SELECT (y // 2)::BIGINT AS y, (x // 2)::BIGINT AS x, solar_day, avg(bad)::DOUBLE AS bad FROM n GROUP BY 1, 2, 3""")
def r2(spark, sf):
    bad = pixels.no_bit("water", 1) & pixels.any_bit("water", 127)
    native = obs(spark, sf).select("y", "x", "solar_day", bad.cast("int").alias("bad"))
    return spatial.average_down(native, ["bad"], 2, ["solar_day"])


BINNED = SCENES + ", b AS (SELECT *, strftime(center_time, '%Y-%m') || '--P1M' AS period FROM scenes)"


def monthly(spark, sf):
    return scenes(spark, sf).withColumns({"period": F.date_format("center_time", "yyyy-MM'--P1M'"), "utc_offset": F.lit(10.0)})


@query("s2_tile_features", SCENES + """, t AS (SELECT (x - 3) * 4 AS x, y, count(DISTINCT id) AS total FROM scenes GROUP BY ALL)
SELECT x, y, 'Feature' AS type, printf('%02d,%02d', x, y) AS title, printf('x%02dy%02d', x, y) AS region_code, total::VARCHAR AS total, '[[[' || (x * 10.0) || ',' || (y * 10.0) || ']' AS corner FROM t""")
def s2(spark, sf):
    f = planner.tile_features(monthly(spark, sf).withColumn("x", (F.col("x") - 3) * 4), spatial.Grid((10.0, 10.0), 1.0))
    get = lambda p: F.get_json_object("geojson", p)
    return f.select("x", "y", get("$.type").alias("type"), get("$.properties.title").alias("title"), get("$.properties.region_code").alias("region_code"), get("$.properties.total").alias("total"), F.regexp_extract(get("$.geometry.coordinates"), r"^\[\[\[[^\]]*\]", 0).alias("corner"))


@query("s3_period_features", BINNED + """, t AS (SELECT period, x, y, count(DISTINCT id) AS total, count(DISTINCT (center_time + INTERVAL 10 HOUR)::DATE) AS days FROM b GROUP BY ALL)
SELECT period, string_agg(printf('%+04d,%+04d', x, y) || ':' || total || ':' || days, ';' ORDER BY x, y) AS tiles FROM t GROUP BY ALL""")
def s3(spark, sf):
    f = planner.period_features(monthly(spark, sf), spatial.Grid((10.0, 10.0), 1.0))
    kind = "features array<struct<properties:struct<title:string,total:long,days:long>>>"
    p = F.transform(F.from_json("geojson", kind)["features"], lambda x: F.concat_ws(":", x["properties"]["title"], x["properties"]["total"].cast("string"), x["properties"]["days"].cast("string")))
    return f.select("period", F.array_join(p, ";").alias("tiles"))


@query("s4_dry_run", BINNED + """, t AS (SELECT period, x, y, count(DISTINCT id)::INT AS datasets, count(DISTINCT center_time::DATE) AS days FROM b GROUP BY ALL) SELECT *, CASE WHEN x = 3 THEN 'skip' ELSE 'new' END AS state FROM t""")
def s4(spark, sf):
    m = monthly(spark, sf)
    t = planner.tasks_of(m)
    return planner.dry_run(t, t.where("x = 3"), scenes=m.select("id", "center_time"))


@query("s6_totals", SCENES + " SELECT count(*) AS total, count(*) FILTER (id % 3 <> 0 AND product <> 'click') AS finished, count(*) FILTER (product = 'click') AS skipped, count(*) FILTER (id % 3 = 0) AS errored FROM scenes")
def s6(spark, sf):
    r = scenes(spark, sf).select(F.col("id").alias("location"), (F.col("product") == "click").alias("skipped"), F.when(F.col("id") % 3 == 0, "bad").alias("error"))
    return planner.run_totals(r)


@query("s7_lineage", BINNED + " SELECT period, x, y, string_agg(DISTINCT id::VARCHAR, ',' ORDER BY id::VARCHAR) AS lineage FROM b GROUP BY ALL")
def s7(spark, sf):
    m = monthly(spark, sf).withColumn("sources", F.array(F.col("id").cast("string"), F.col("id").cast("string")))
    return planner.lineage(m, True).select("period", "x", "y", F.array_join("lineage", ",").alias("lineage"))


@query("s8_ids", SCENES + """, n AS (SELECT id, sha1(unhex('6f34c6f413d643c08e4e42b6c13203af') || encode(lower(product || chr(10) || id))) AS d FROM scenes)
SELECT id, concat_ws('-', d[1:8], d[9:12], '5' || d[14:16], ['8', '9', 'a', 'b'][('0x' || d[17:17])::INT % 4 + 1] || d[18:20], d[21:32]) AS uuid FROM n""")
def s8(spark, sf):
    return scenes(spark, sf).select("id", sinks.uuid5_column(F.lower(F.concat_ws("\n", "product", F.col("id").cast("string")))).alias("uuid"))


@query("k2_item_documents", BINNED + """, t AS (SELECT period, x, y, count(DISTINCT id) AS n FROM b GROUP BY ALL)
SELECT period, x, y, 'gm_x' || lpad(x::VARCHAR, 2, '0') || 'y' || lpad(y::VARCHAR, 2, '0') || '_' || period AS title, '[' || (x * 10.0) || ',' || (y * 10.0) || ',' || (x * 10.0 + 10.0) || ',' || (y * 10.0 + 10.0) || ']' AS bbox, '[10,10]' AS shape, n::INT AS inputs,
       's3://b/x' || lpad(x::VARCHAR, 2, '0') || '/y' || lpad(y::VARCHAR, 2, '0') || '/' || period || '/gm_x' || lpad(x::VARCHAR, 2, '0') || 'y' || lpad(y::VARCHAR, 2, '0') || '_' || period || '_red.tif' AS red FROM t""")
def k2(spark, sf):
    d = sinks.item_documents(planner.tasks_of(monthly(spark, sf)), "gm", ["red"], "s3://b", spatial.Grid((10.0, 10.0), 1.0))
    get = lambda p: F.get_json_object("document", p)
    return d.select("period", "x", "y", get("$.properties.title").alias("title"), get("$.bbox").alias("bbox"), get("$['properties']['proj:shape']").alias("shape"), F.size(F.from_json(get("$['odc:lineage']['inputs']"), "array<string>")).alias("inputs"), get("$.assets.red.href").alias("red"))


@query("k10_mosaic", OBS + " SELECT solar_day AS period, 0 AS tile_x, 0 AS tile_y, (y // 4)::BIGINT AS y, (x // 4)::BIGINT AS x, avg(red)::DOUBLE AS red FROM obs GROUP BY ALL")
def k10(spark, sf):
    from chronocell.plans.tasks import mosaic

    return mosaic(obs(spark, sf).withColumns({"period": F.col("solar_day"), "tile_x": F.lit(0), "tile_y": F.lit(0)}), ["red"], 4)


@query("k8_messages", BINNED + " SELECT DISTINCT 'db' AS filedb, period || '/' || printf('%02d', x - 3) || '/' || printf('%02d', y) AS tile_idx FROM b")
def k8(spark, sf):
    return streams.messages(monthly(spark, sf).select("period", (F.col("x") - 3).alias("x"), "y").dropDuplicates(), "db")


def as_stream(df):
    """A stream of the frame's rows, from files, a third of them a batch: a file a core, as small files are not split."""
    spark = df.sparkSession
    source, cores = folder(spark, "arriving"), max(2, spark.sparkContext.defaultParallelism)
    df.repartition(3 * cores).write.parquet(source)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", cores).parquet(source)


@query("stream_windows", SCENES + " SELECT time_bucket(INTERVAL 1 DAY, center_time)::TIMESTAMP AS start, product, count(*) AS scenes FROM scenes GROUP BY ALL")
def windows(spark, sf):
    """A stream that takes the scenes in parts, in any order within the days that a scene may be late."""
    counts = streams.scene_windows(as_stream(scenes(spark, sf).withColumn("center_time", F.col("center_time").cast("timestamp"))), late="60 days").select(F.col("window.start").cast("timestamp_ntz").alias("start"), "product", "scenes")
    out, state = folder(spark, "windows"), folder(spark, "state")
    streams.running(counts, out, state).awaitTermination()
    return streams.latest(spark, out, ["start", "product"])


@query("stream_tasks", SCENES + """, b AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_shipdate + INTERVAL 10 HOUR AS t, (l_suppkey % 5)::INT AS x, (l_suppkey % 3)::INT AS y FROM lineitem),
p AS (SELECT *, (year(t) - CASE WHEN month(t) < 3 THEN 1 ELSE 0 END)::INT AS yr, [12, 12, 3, 3, 3, 6, 6, 6, 9, 9, 9, 12][month(t)] AS m FROM b)
SELECT printf('%04d-%02d--P3M', yr, m) AS period, x, y, make_timestamp(yr, m, 1, 0, 0, 0.0) + INTERVAL 3 MONTH AS closes, array_to_string(list_sort(list(DISTINCT id)), ',') AS dataset_ids, count(DISTINCT t::DATE) AS days FROM p GROUP BY ALL""")
def arriving(spark, sf):
    """Seasonal tasks whose scenes come in any order over all years."""
    s = spark.read.parquet(f"{sf}/lineitem.parquet").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_shipdate").cast("timestamp").alias("center_time"), F.lit(10.0).alias("utc_offset"), (F.col("l_suppkey") % 5).cast("int").alias("x"), (F.col("l_suppkey") % 3).cast("int").alias("y"))
    out, state = folder(spark, "tasks"), folder(spark, "state")
    streams.running(streams.arriving_tasks(planner.binned(as_stream(s), "seasonal"), "3650 days"), out, state).awaitTermination()
    return streams.latest(spark, out, ["period", "x", "y"]).select("period", "x", "y", F.col("closes").cast("timestamp_ntz").alias("closes"), F.array_join(F.col("dataset_ids").cast("array<string>"), ",").alias("dataset_ids"), "days")


@query("j1_clustered_fuse", SCENES + HOURLY + ", s AS (SELECT id, hour AS center_time, (CAST(region_code AS INT) % 10)::VARCHAR AS region_code, count(*) OVER (PARTITION BY hour, CAST(region_code AS INT) % 10) AS n FROM h) SELECT id, center_time, region_code FROM s WHERE n >= 3")
def clustered(spark, sf):
    """Scenes of fused groups, from a table in buckets of time and region; they come in the order of both."""
    where = folder(spark, "scenes")
    s = scene_store.write_scenes(hourly(spark, sf), where.rsplit("/", 1)[1].replace("-", "_"), 8, where)
    groups = planner.fuse_join(s, 2)
    return scene_store.in_order(s.join(groups.select(*planner.KEY), list(planner.KEY), "left_semi").select("id", "center_time", "region_code"))


@query("src3_catalogue", SCENES + """, u AS (SELECT region_code, arg_max({'p': product, 'i': id}, id) AS l, arg_min({'p': product, 'i': id}, id) AS f FROM scenes GROUP BY ALL)
SELECT region_code || '/' || l.i AS id, l.p AS product, region_code, x * 10.0::DOUBLE AS min_x, y * 10.0::DOUBLE AS max_y FROM u JOIN scenes USING (region_code) WHERE scenes.id = l.i
UNION ALL SELECT region_code || '/' || f.i, f.p, region_code, x * 10.0::DOUBLE, y * 10.0::DOUBLE FROM u JOIN scenes USING (region_code) WHERE scenes.id = f.i AND f.i < l.i""")
def catalogue_of_items(spark, sf):
    """Files of the regions' last scenes join those of their first ones in a catalogue that is brought up to date after each."""
    from chronocell.sources import catalogue_store

    root, store, s = folder(spark, "items"), folder(spark, "catalogue"), scenes(spark, sf)
    for which in (F.min_by, F.max_by):
        one = s.groupBy("region_code").agg(which(F.struct("id", "product", "x", "y"), "id").alias("s"))
        corner = [F.col("s.x") * 10.0, F.col("s.y") * 10.0 - 3, F.col("s.x") * 10.0 + 12, F.col("s.y") * 10.0]
        item = F.struct(F.concat_ws("/", "region_code", "s.id").alias("id"), F.col("s.product").alias("collection"), F.array(*corner).alias("bbox"), F.create_map(F.lit("odc:region_code"), F.col("region_code")).alias("properties"))
        one.select(F.to_json(item).alias("value")).write.mode("append").option("maxRecordsPerFile", 10_000).text(root)
        catalogue_store.refresh(spark, root, store, "*.txt", lines=True)
    return catalogue_store.scenes(spark, store).select("id", "product", "region_code", "min_x", "max_y")


@query("j6_local_offsets", SCENES + " SELECT id, round_even(((x * 25.0 + 12.5 + 180) % 360 - 180) / 15, 0)::DOUBLE AS utc_offset FROM scenes")
def j6_offsets(spark, sf):
    s = scenes(spark, sf)
    return spatial.with_offset(s, spatial.Grid((25.0, 25.0), 1.0).longitude(F.col("x"), F.col("y"))).select("id", "utc_offset")


# the same queries under their first names
SQL["a3_pq_filters"] = SQL["a3_pq_cleaned"]
SQL["m3_tree_features"] = SQL["m3_tree_feature_values"]
