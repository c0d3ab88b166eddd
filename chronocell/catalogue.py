"""Queries of the operators over the driver's tables, with the same in SQL.

`obs` makes an observation table of lineitem by arithmetic; `events` stands for scenes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronocell.functions import pixels
from chronocell.functions.periods import Period, local_time
from chronocell.functions.tables import folder
from chronocell.operators import fuse, geomedian, models, morphology, planner, spatial, summaries
from chronocell.operators.summaries import execute
from chronocell.sources import sinks
from chronocell.streaming.tasks import fold_history, latest_history

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

OBS = """obs AS (SELECT l_orderkey AS id, (l_suppkey % 10)::BIGINT AS y, (l_partkey % 10)::BIGINT AS x, l_shipdate AS time, CAST(l_shipdate AS DATE) AS solar_day,
  floor(l_quantity * 100)::BIGINT AS blue, floor(l_extendedprice / 10)::BIGINT % 10000 AS green, floor(l_discount * 10000)::BIGINT + 500 AS red, floor(l_tax * 10000)::BIGINT + 800 AS nir,
  (CASE l_returnflag WHEN 'A' THEN 128 WHEN 'R' THEN 64 ELSE 0 END + CASE WHEN l_orderkey % 11 = 0 THEN 1 ELSE 0 END)::BIGINT AS water, (l_linenumber % 6)::BIGINT AS fmask, l_linenumber FROM lineitem)"""
SCENES = "scenes AS (SELECT event_id AS id, event_type AS product, ts AS center_time, CAST(user_id AS VARCHAR) AS region_code, (user_id % 7)::INT AS x, (user_id % 5)::INT AS y FROM events)"


def obs(spark: SparkSession, sf: str) -> DataFrame:
    t = spark.read.parquet(f"{sf}/lineitem.parquet")
    whole = lambda c: F.floor(c).cast("long")
    return t.select(
        F.col("l_orderkey").alias("id"), (F.col("l_suppkey") % 10).alias("y"), (F.col("l_partkey") % 10).alias("x"), F.col("l_shipdate").alias("time"), F.to_date("l_shipdate").alias("solar_day"),
        whole(F.col("l_quantity") * 100).alias("blue"), (whole(F.col("l_extendedprice") / 10) % 10000).alias("green"), (whole(F.col("l_discount") * 10000) + 500).alias("red"), (whole(F.col("l_tax") * 10000) + 800).alias("nir"),
        (F.when(F.col("l_returnflag") == "A", 128).when(F.col("l_returnflag") == "R", 64).otherwise(0) + F.when(F.col("l_orderkey") % 11 == 0, 1).otherwise(0)).cast("long").alias("water"),
        (F.col("l_linenumber") % 6).cast("long").alias("fmask"), "l_linenumber",
    )


def scenes(spark: SparkSession, sf: str) -> DataFrame:
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select(F.col("event_id").alias("id"), F.col("event_type").alias("product"), F.col("ts").alias("center_time"), F.col("user_id").cast("string").alias("region_code"), (F.col("user_id") % 7).cast("int").alias("x"), (F.col("user_id") % 5).cast("int").alias("y"))


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql:
            SQL[name] = "WITH " + sql.strip()
        return f

    return put


DAILY_WATER = OBS + """, d AS (SELECT y, x, solar_day, bool_or((water & 1) = 0 AND (water & 127) <> 0) AS bad,
  bool_or(water = 0) AS dry, bool_or(water = 128) AS wet FROM obs GROUP BY ALL),
n AS (SELECT y, x, count(*) FILTER (bad) AS b, count(*) FILTER (wet AND NOT dry AND NOT bad) AS w, count(*) FILTER (dry AND NOT wet AND NOT bad) AS c FROM d GROUP BY ALL)"""


@query("a1_wofs_summary", DAILY_WATER + """
SELECT y, x, CASE WHEN b + w + c > 0 THEN w ELSE -999 END::BIGINT AS count_wet, CASE WHEN b + w + c > 0 THEN w + c ELSE -999 END::BIGINT AS count_clear, w::DOUBLE / nullif(w + c, 0) AS frequency FROM n""")
def a1(spark, sf):
    return execute(obs(spark, sf), summaries.WofsSummary()).withColumns({c: F.col(c).cast("long") for c in ("count_wet", "count_clear")})


YEARLY = OBS + ", d AS (SELECT y, x, year(time) AS yr, count(*) FILTER (water = 128) AS count_wet, CASE WHEN count(*) FILTER (water = 0) = 0 THEN -999 ELSE count(*) FILTER (water IN (0, 128)) END AS count_clear FROM obs GROUP BY ALL)"


def yearly(spark, sf):
    o = obs(spark, sf)
    return o.groupBy("y", "x", F.year("time").alias("yr")).agg(F.count_if(F.col("water") == 128).alias("count_wet"), F.when(F.count_if(F.col("water") == 0) == 0, -999).otherwise(F.count_if(F.col("water").isin(0, 128))).alias("count_clear"))


FH = """, s AS (SELECT y, x, sum(count_wet)::BIGINT AS w, coalesce(sum(count_clear) FILTER (count_clear <> -999), 0)::BIGINT AS c, count(*) FILTER (count_clear <> -999) AS n FROM d GROUP BY ALL)
SELECT y, x, CASE WHEN n > 0 THEN w ELSE -999 END AS count_wet, CASE WHEN n > 0 THEN c ELSE -999 END AS count_clear, w::DOUBLE / nullif(c, 0) AS frequency FROM s"""


@query("a2_wofs_full_history", YEARLY + FH)
def a2(spark, sf):
    return execute(yearly(spark, sf), summaries.WofsFullHistory())


@query("stream_full_history", YEARLY + FH)
def a2_stream_form(spark, sf):
    """A stream that takes the annual summaries a year at a time."""
    source, out, state = (folder(spark, k) for k in ("annual", "history", "state"))
    annual = yearly(spark, sf)
    annual.repartition("yr").write.partitionBy("yr").parquet(source)
    stream = spark.readStream.schema(annual.schema).option("maxFilesPerTrigger", 2).parquet(source)
    fold_history(stream, out, state).awaitTermination()
    return latest_history(spark, out)


@query("a3_pq", OBS + """, d AS (SELECT y, x, solar_day, bool_or(fmask <> 0) AS valid, bool_or(fmask IN (3, 4)) AS erased FROM obs GROUP BY ALL)
SELECT y, x, count(*) FILTER (valid) AS total, count(*) FILTER (valid AND NOT erased) AS clear FROM d GROUP BY ALL""")
def a3(spark, sf):
    return execute(obs(spark, sf), summaries.PixelQuality({}, 0, (3, 4), "fmask"))


@query("a3_pq_filters")
def a3_filters(spark, sf):
    return execute(obs(spark, sf), summaries.PixelQuality({"clear_1_2": [("opening", 1), ("dilation", 2)]}, 0, (3,), "fmask"))


@query("a4_pq_bitmask", OBS + """, d AS (SELECT y, x, solar_day, bool_or((water & 1) = 0) AS k, bool_or((water & 64) <> 0) AS e, bool_or(((blue >> 6) & 3) = 3) AS a FROM obs GROUP BY ALL)
SELECT y, x, count(*) FILTER (k) AS total, count(*) FILTER (k AND NOT e) AS clear, count(*) FILTER (k AND NOT a AND NOT e) AS clear_aerosol FROM d GROUP BY ALL""")
def a4(spark, sf):
    return execute(obs(spark, sf), summaries.PixelQualityBits(mask=64, aerosol="blue", band="water"))


PC = "CASE WHEN len({0}) >= 3 THEN list_sort({0})[round_even({1} * (len({0}) - 1), 0)::INT + 1] END"


def pc(band: str, q: float, nodata: int, suffix: str) -> str:
    return f"coalesce({PC.format(band, q)}, {nodata})::BIGINT AS {suffix}_pc_{int(q * 100)}"


COVER = OBS + """, o AS (SELECT *, (water & 239) = 0 AND nir - 800 < 600 AS valid, (water & 239) = 128 AS wet FROM obs),
d AS (SELECT y, x, solar_day, floor(avg(CASE WHEN valid AND fmask <> 255 THEN fmask END))::BIGINT AS fmask, floor(avg(CASE WHEN valid THEN least(greatest(red - 500, 0), 100) END))::BIGINT AS pv, bool_or(wet) AS wet, bool_or(valid) AS valid FROM o GROUP BY ALL),
l AS (SELECT y, x, list(fmask) FILTER (fmask IS NOT NULL) AS f, list(pv) FILTER (pv IS NOT NULL) AS p, count(*) FILTER (valid) AS count_valid, bool_or(wet AND NOT valid) AS w FROM d GROUP BY ALL)"""


@query("a5_fc_percentiles", COVER + f"""
SELECT y, x, {", ".join(pc(c, q, 255, n) for c, n in (("f", "fmask"), ("p", "pv")) for q in (0.1, 0.5, 0.9))},
       CASE WHEN coalesce(len(f), 0) >= 3 AND coalesce(len(p), 0) >= 3 THEN 2 WHEN w THEN 0 ELSE 1 END AS qa, count_valid FROM l""")
def a5(spark, sf):
    o = obs(spark, sf).withColumns({"pv": F.least(F.greatest(F.col("red") - 500, F.lit(0)), F.lit(100)), "ue": F.col("nir") - 800})
    r = execute(o, summaries.CoverPercentiles(("fmask", "pv"), ue_threshold=600, count_valid=True))
    return r.withColumns({c: F.col(c).cast("long") for c in r.columns if "_pc_" in c})


@query("a6_tcw_percentiles", OBS + """, o AS (SELECT y, x, solar_day, CASE WHEN fmask NOT IN (0, 2, 3) THEN trunc(blue * 0.5::DOUBLE + green * -0.25::DOUBLE)::BIGINT END AS v FROM obs),
d AS (SELECT y, x, solar_day, floor(avg(v))::BIGINT AS v FROM o GROUP BY ALL), l AS (SELECT y, x, list(v) FILTER (v IS NOT NULL) AS v FROM d GROUP BY ALL)
SELECT y, x, """ + ", ".join(pc("v", q, -9999, "wet") for q in (0.1, 0.5, 0.9)) + " FROM l")
def a6(spark, sf):
    o = obs(spark, sf).withColumn("contiguity", F.lit(1))
    r = execute(o, summaries.TasselledCapPercentiles({"wet": (0.5, -0.25)}, ("wet",), bands=("blue", "green")))
    return r.withColumns({c: F.col(c).cast("long") for c in r.columns if "_pc_" in c})


def weiszfeld(bands: tuple[str, ...], steps: int = 400) -> str:
    """CTEs over d (y, x, day, bands, no band missing): a step of the fixed point after another, and g with the last one's medians."""
    each = lambda f, by=", ": by.join(f(b) for b in bands)
    gap = "sqrt(" + each(lambda b: f"(d.{b} - m.{b}_m) ** 2", " + ") + ")"
    return f"""m0 AS (SELECT y, x, {each(lambda b: f"avg({b})::DOUBLE AS {b}_m")} FROM d GROUP BY ALL),
m AS (SELECT y, x, 0 AS k, {each(lambda b: f"{b}_m")} FROM m0 UNION ALL SELECT y, x, k + 1, {each(lambda b: f"(1 - h) * {b}_t + h * {b}_m")} FROM (
  SELECT *, CASE WHEN held > 0 THEN least(1, held / nullif(sqrt({each(lambda b: f"{b}_p ** 2", " + ")}), 0)) ELSE 0 END AS h FROM (
    SELECT y, x, k, {each(lambda b: f"{b}_m")}, count(*) FILTER (w = 0) AS held, {each(lambda b: f"coalesce(sum(w * {b}) / nullif(sum(w), 0), {b}_m) AS {b}_t")}, {each(lambda b: f"sum(w * ({b} - {b}_m)) AS {b}_p")}
    FROM (SELECT d.*, m.k, {each(lambda b: f"m.{b}_m")}, CASE WHEN {gap} < 1e-12 THEN 0 ELSE 1 / {gap} END AS w FROM d JOIN m USING (y, x) WHERE k < {steps}) GROUP BY y, x, k, {each(lambda b: f"{b}_m")}))),
g AS (SELECT * FROM m WHERE k = {steps})"""


def deviation_sql(bands: tuple[str, ...]) -> tuple[str, str, str]:
    """Of observations d from medians g: cosine, Euclidean and Bray-Curtis."""
    plus = lambda f: " + ".join(f(b) for b in bands)
    size = lambda f: f"sqrt({plus(lambda b: f(b) + ' ** 2')})"
    return (f"1 - ({plus(lambda b: f'd.{b} * g.{b}_m')}) / ({size(lambda b: f'd.{b}')} * {size(lambda b: f'g.{b}_m')})", size(lambda b: f"(d.{b} - g.{b}_m)"), f"({plus(lambda b: f'abs(d.{b} - g.{b}_m)')}) / ({plus(lambda b: f'abs(d.{b} + g.{b}_m)')})")


def in_order(spark, sf):
    """Observations whose times differ."""
    return obs(spark, sf).withColumn("time", F.col("id") * 10 + F.col("l_linenumber"))


GM = ("blue", "green", "red", "nir")
SMAD, EMAD, BCMAD = deviation_sql(GM)


@query("a7_geomedian", "RECURSIVE " + OBS + ", k AS (SELECT y, x, solar_day, " + ", ".join(f"arg_min({b}, (id * 10 + l_linenumber, {b})) FILTER (fmask NOT IN (0, 2, 3)) AS {b}" for b in GM) + f" FROM obs GROUP BY ALL), p AS (SELECT DISTINCT y, x FROM k), d AS (SELECT * FROM k WHERE {' AND '.join(f'{b} IS NOT NULL' for b in GM)}), " + weiszfeld(GM) + f""",
v AS (SELECT y, x, median({SMAD}) AS smad, median({EMAD}) AS emad, median({BCMAD}) AS bcmad, count(*)::INT AS count FROM d JOIN g USING (y, x) GROUP BY ALL)
SELECT p.y, p.x, {", ".join(f"round({b}_m, 2) AS {b}" for b in GM)}, round(smad, 6) AS smad, round(emad, 2) AS emad, round(bcmad, 6) AS bcmad, coalesce(count, 0)::INT AS count FROM p LEFT JOIN g USING (y, x) LEFT JOIN v USING (y, x)""")
def a7(spark, sf):
    r = geomedian.Geomedian(tolerance=1e-12).run(in_order(spark, sf))
    return r.select("y", "x", *[F.nanvl(F.round(c, d), F.lit(None)).alias(c) for c, d in (*((b, 2) for b in GM), ("smad", 6), ("emad", 2), ("bcmad", 6))], "count")


@query("a7_geomedian_one_band", OBS + " SELECT y, x, median(red)::DOUBLE AS red, count(red)::INT AS count FROM obs WHERE fmask NOT IN (0, 2, 3) GROUP BY ALL")
def a7_one(spark, sf):
    return geomedian.Geomedian(("red",)).run(obs(spark, sf), day=None).where("count > 0").select("y", "x", "red", "count")


A8 = ("red", "nir")


@query("a8_geomedian_bitmask", "RECURSIVE " + OBS + ", k AS (SELECT y, x, solar_day, " + ", ".join(f"arg_min({b}, (id * 10 + l_linenumber, {b})) FILTER ((water & 1) = 0 AND red > 200 AND nir > 200) AS {b}" for b in A8) + ", bool_or((water & 64) <> 0) AS c FROM obs GROUP BY ALL), p AS (SELECT DISTINCT y, x FROM k), d AS (SELECT * FROM k WHERE NOT c AND red IS NOT NULL AND nir IS NOT NULL), " + weiszfeld(A8) + f""",
v AS (SELECT y, x, median({deviation_sql(A8)[0]}) AS smad, median({deviation_sql(A8)[1]}) AS emad, median({deviation_sql(A8)[2]}) AS bcmad, count(*)::INT AS count FROM d JOIN g USING (y, x) GROUP BY ALL)
SELECT p.y, p.x, {", ".join(f"coalesce(round_even({b}_m * (0.001::DOUBLE * 100) - 20, 0)::INT, 0) AS {b}" for b in A8)}, round(smad, 6) AS smad, coalesce(round_even(emad * (0.001::DOUBLE * 100), 0)::INT, 0) AS emad, round(bcmad, 6) AS bcmad, coalesce(count, 0)::INT AS count FROM p LEFT JOIN g USING (y, x) LEFT JOIN v USING (y, x)""")
def a8(spark, sf):
    r = geomedian.GeomedianBits(A8, "water", 64, 1, None, -0.2, 0.001, 100, tolerance=1e-12).run(in_order(spark, sf))
    return r.withColumns({c: F.nanvl(F.round(c, 6), F.lit(None)) for c in ("smad", "bcmad")})


@query("a9_longest_runs", OBS + """, m AS (SELECT y, x, month(time) AS month, CASE WHEN count(*) % 5 = 0 THEN 255 WHEN median(red) > 1000 THEN 1 ELSE 0 END AS v FROM obs GROUP BY ALL),
i AS (SELECT *, sum(CASE WHEN v = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY y, x ORDER BY month) AS i FROM m WHERE v <> 255),
r AS (SELECT y, x, i, sum(v) AS n FROM i GROUP BY ALL), b AS (SELECT y, x, max(n) AS n FROM r GROUP BY ALL)
SELECT p.y, p.x, coalesce(n, 255)::INT AS run FROM (SELECT DISTINCT y, x FROM obs) p LEFT JOIN b USING (y, x)""")
def a9_runs(spark, sf):
    v = F.when(F.count(F.lit(1)) % 5 == 0, 255).when(F.median("red") > 1000, 1).otherwise(0)
    return summaries.longest_run(obs(spark, sf).groupBy("y", "x", F.month("time").alias("month")).agg(v.alias("v")), "v", ["y", "x"])


@query("a9_veg_count", OBS + """, o AS (SELECT *, (water & 227) = 0 AS v0, (water & 251) = 128 AS w0 FROM obs),
p AS (SELECT *, CASE WHEN w0 OR v0 THEN w0::INT::DOUBLE END AS wn, v0 AND nir - 800 < 300 AS v FROM o),
d AS (SELECT y, x, solar_day, avg(CASE WHEN v THEN red END) AS pv, avg(CASE WHEN v THEN nir END) AS npv, avg(CASE WHEN v THEN blue END) AS bs, bool_or(wn = 1) AS anywet, count(wn) AS c FROM p GROUP BY ALL),
m AS (SELECT y, x, month(solar_day) AS month, median(pv) AS pv, median(npv) AS npv, median(bs) AS bs, median(CASE WHEN c > 0 THEN anywet::INT::DOUBLE END) AS wet FROM d GROUP BY ALL),
f AS (SELECT y, x, month, CASE WHEN wet > 0 THEN 0 WHEN pv IS NULL THEN 255 ELSE (pv > bs OR npv > bs)::INT END AS veg, CASE WHEN wet IS NULL THEN 255 ELSE (wet > 0.5)::INT END AS water FROM m),
vi AS (SELECT *, sum((veg = 0)::INT) OVER (PARTITION BY y, x ORDER BY month) AS i FROM f WHERE veg <> 255), vr AS (SELECT y, x, max(n) AS n FROM (SELECT y, x, i, sum(veg) AS n FROM vi GROUP BY ALL) GROUP BY ALL),
wi AS (SELECT *, sum((water = 0)::INT) OVER (PARTITION BY y, x ORDER BY month) AS i FROM f WHERE water <> 255), wr AS (SELECT y, x, max(n) AS n FROM (SELECT y, x, i, sum(water) AS n FROM wi GROUP BY ALL) GROUP BY ALL)
SELECT k.y, k.x, coalesce(vr.n, 255)::INT AS veg_frequency, coalesce(wr.n, 255)::INT AS water_frequency FROM (SELECT DISTINCT y, x FROM f) k LEFT JOIN vr USING (y, x) LEFT JOIN wr USING (y, x)""")
def a9(spark, sf):
    # ties of time within a day are settled by taking wet first, in both forms
    o = obs(spark, sf).select("y", "x", F.to_timestamp("solar_day").alias("time"), "solar_day", "water", F.col("red").alias("pv"), F.col("nir").alias("npv"), F.col("blue").alias("bs"), (F.col("nir") - 800).alias("ue"))
    order = F.when(F.col("water").bitwiseAND(251) == 128, 0).otherwise(1)
    return summaries.VegetationCount(300).run(o.withColumn("time", F.struct("time", order)))


LEVEL1 = OBS + """, p AS (SELECT y, x, count(*) FILTER (water = 128)::DOUBLE / 1000 AS f, (count(*) % 5)::INT AS veg, (count(*) % 13)::DOUBLE AS dem, CASE WHEN count(*) % 3 = 0 THEN (count(*) % 7)::DOUBLE END AS elevation, min(blue) AS blue, min(red) AS red, min(green) AS green FROM obs GROUP BY ALL)"""


def level1_input(spark, sf):
    n = F.count(F.lit(1))
    return obs(spark, sf).groupBy("y", "x").agg((F.count_if(F.col("water") == 128) / 1000.0).alias("frequency"), (n % 5).cast("int").alias("veg_frequency"), (n % 13).cast("double").alias("dem_h"), F.when(n % 3 == 0, (n % 7).cast("double")).alias("elevation"), F.min("blue").alias("blue"), F.min("red").alias("red"), F.min("green").alias("green"))


@query("a10_level1", LEVEL1 + """, s AS (SELECT *, CASE WHEN blue > -999 THEN blue::DOUBLE * red / nullif(green, 0) END AS si, coalesce(f >= 0.2, false) AS wa FROM p),
b AS (SELECT *, CASE WHEN wa THEN 221 WHEN coalesce(si > 1000 AND dem <= 6, false) OR coalesce(si > 1500, false) OR veg < 2 THEN 210 ELSE 0 END AS c FROM s),
e AS (SELECT *, CASE WHEN elevation IS NOT NULL THEN (CASE WHEN c > 0 THEN 223 ELSE 124 END) ELSE c END AS c2 FROM b)
SELECT y, x, CASE WHEN si IS NULL OR veg >= 255 THEN 255 WHEN c2 <= 0 THEN 110 ELSE c2 END AS classes_l3_l4, CASE WHEN f > 0 AND f <= 0.25 THEN 1.0::DOUBLE WHEN f > 0.25 AND f <= 1 THEN 2.0::DOUBLE ELSE f END AS water_seasonality FROM e""")
def a10(spark, sf):
    return summaries.level1_classes(level1_input(spark, sf), ("elevation",)).select("y", "x", "classes_l3_l4", "water_seasonality")


@query("a11_dem", LEVEL1 + " SELECT y, x, CASE WHEN dem > 3 THEN dem END AS height FROM p")
def a11(spark, sf):
    return summaries.renamed_inputs(level1_input(spark, sf), {"dem_h": "height"}, 3).select("y", "x", "height")


@query("a12_mangroves", OBS + """, p AS (SELECT y, x, count(*) % 80 AS pv, count(*) % 3 AS qa, -(count(*) % 40) * 50 - 900 AS wet FROM obs GROUP BY ALL)
SELECT y, x, CASE WHEN NOT (x + 0.5 < 7 AND y + 0.5 < 9 AND wet > -1850 AND ((pv > 14 AND qa = 2) OR qa = 1)) THEN 255 WHEN qa = 1 THEN 0 ELSE (pv > 14)::INT + (pv > 38)::INT + (pv > 60)::INT END AS canopy_cover_class FROM p""")
def a12(spark, sf):
    n = F.count(F.lit(1))
    p = obs(spark, sf).groupBy("y", "x").agg((n % 80).alias("pv_pc_10"), (n % 3).alias("qa"), (-(n % 40) * 50 - 900).alias("wet_pc_10"))
    p = spatial.rasterize(p.withColumns({"cx": F.col("x") + 0.5, "cy": F.col("y") + 0.5}), [[(-1, -1), (7, -1), (7, 9), (-1, 9), (-1, -1)]])
    return summaries.mangroves(p).select("y", "x", "canopy_cover_class")


@query("a13_level3", OBS + """, p AS (SELECT y, x, [110, 111, 210, 221][count(*) % 4 + 1] AS l, CASE WHEN count(*) % 3 = 0 THEN 112 ELSE 255 END AS c, 215 + count(*) % 2 AS u FROM obs GROUP BY ALL), r AS (SELECT *, CASE WHEN c < 255 THEN c ELSE l END AS r FROM p)
SELECT y, x, CASE WHEN r = 210 THEN u ELSE r END::BIGINT AS level3_class FROM r""")
def a13(spark, sf):
    n = F.count(F.lit(1))
    p = obs(spark, sf).groupBy("y", "x").agg(F.element_at(F.array(*map(F.lit, (110, 111, 210, 221))), (n % 4 + 1).cast("int")).alias("classes_l3_l4"), F.when(n % 3 == 0, 112).otherwise(255).alias("cultivated_class"), (215 + n % 2).alias("urban_classes"))
    return summaries.level3_classes(p).select("y", "x", F.col("level3_class").cast("long").alias("level3_class"))


@query("a17_urban_vote", OBS + """, v AS (SELECT y, x, l_linenumber, CASE WHEN max(water) > 128 THEN 255 WHEN count(*) % 2 = 0 THEN 1 ELSE 0 END AS p FROM obs GROUP BY ALL)
SELECT y, x, CASE WHEN count(*) FILTER (p <> 255) = 0 THEN 255 WHEN max(p) FILTER (p <> 255) > 0 THEN 215 ELSE 216 END AS class FROM v GROUP BY ALL""")
def a17(spark, sf):
    v = obs(spark, sf).groupBy("y", "x", "l_linenumber").agg(F.when(F.max("water") > 128, 255).when(F.count(F.lit(1)) % 2 == 0, 1).otherwise(0).alias("prediction"))
    return models.urban_vote(v, ["y", "x"])


@query("a17_woody_cultivated_votes", OBS + """, v AS (SELECT y, x, l_linenumber, (count(*) % 60)::INT AS p FROM obs GROUP BY ALL),
w AS (SELECT y, x, CASE WHEN bool_or(p <= 20) THEN 114 ELSE 113 END AS woody, CASE WHEN bool_or(p % 2 = 0) THEN 111 ELSE 112 END AS cultivated FROM v GROUP BY ALL) SELECT * FROM w""")
def a17b(spark, sf):
    v = obs(spark, sf).groupBy("y", "x", "l_linenumber").agg((F.count(F.lit(1)) % 60).cast("int").alias("prediction"))
    c = models.cultivated_vote(v.withColumn("prediction", F.col("prediction") % 2), ["y", "x"]).withColumnRenamed("class", "cultivated")
    return models.woody_vote(v, ["y", "x"]).withColumnRenamed("class", "woody").join(c, ["y", "x"])


@query("a18_month_medians", OBS + " SELECT y, x, month(time)::INT AS month, median(red)::DOUBLE AS red, median(blue)::DOUBLE AS blue FROM obs GROUP BY ALL")
def a18(spark, sf):
    return summaries.month_medians(obs(spark, sf), ("red", "blue"))


@query("e10_indices", OBS + """ SELECT id, l_linenumber, (green - red)::DOUBLE / nullif(green + red, 0) AS ndsi, (red + 0.3::DOUBLE) / nullif(green + nir, 0) AS baei, least(greatest(green, 1000), 3000) AS clipped, coalesce(nullif(blue, 1000), -999) AS filled FROM obs""")
def e10(spark, sf):
    o = obs(spark, sf)
    return o.select("id", "l_linenumber", pixels.divided(F.col("green") - F.col("red"), F.col("green") + F.col("red")).alias("ndsi"), pixels.divided(F.col("red") + 0.3, F.col("green") + F.col("nir")).alias("baei"), pixels.clip("green", 1000, 3000).alias("clipped"), pixels.sentinel(pixels.missing("blue", 1000), -999).alias("filled"))


@query("m3_tree_features")
def m3(spark, sf):
    o = obs(spark, sf).withColumns({"swir1": F.col("blue") + 7, "swir2": F.col("nir") + 9, "sdev": F.lit(0.1), "edev": F.lit(50.0), "bcdev": F.lit(0.2)})
    return models.tree_features(o).select("id", "l_linenumber", *models.FEATURES)


@query("m6_impute", OBS + " SELECT id, l_linenumber, CASE WHEN blue > 2500 THEN blue WHEN red > 900 THEN red END AS b FROM (SELECT id, l_linenumber, CASE WHEN blue > 2500 THEN blue ELSE -999 END AS blue, CASE WHEN red > 900 THEN red ELSE -999 END AS red FROM obs)")
def m6(spark, sf):
    o = obs(spark, sf).select("id", "l_linenumber", F.when(F.col("blue") > 2500, F.col("blue")).otherwise(-999).alias("blue"), F.when(F.col("red") > 900, F.col("red")).otherwise(-999).alias("red"))
    return o.select("id", "l_linenumber", models.imputed(["blue", "red"])["blue"].alias("b"))


@query("n1_dilation", OBS + """, p AS (SELECT strftime(time, '%Y-%m-%d %H') AS image, y, x, bool_or(fmask = 2) AS m FROM obs GROUP BY ALL)
SELECT p.image, p.y, p.x, coalesce(bool_or(s.m), false) AS dilated FROM p LEFT JOIN p s ON s.image = p.image AND s.m AND (p.y - s.y) ** 2 + (p.x - s.x) ** 2 <= 4 GROUP BY ALL""")
def n1(spark, sf):
    p = obs(spark, sf).groupBy(F.date_format("time", "yyyy-MM-dd HH").alias("image"), "y", "x").agg(F.bool_or(F.col("fmask") == 2).alias("m"))
    return morphology.dilate_rows(p, "m", 2, ["image"]).select("image", "y", "x", "dilated")


@query("n1_dilation_days", OBS + """, p AS (SELECT solar_day, y, x, bool_or(fmask = 2) AS m FROM obs GROUP BY ALL)
SELECT p.solar_day, p.y, p.x, coalesce(bool_or(s.m), false) AS dilated FROM p LEFT JOIN p s ON s.solar_day = p.solar_day AND s.m AND (p.y - s.y) ** 2 + (p.x - s.x) ** 2 <= 4 GROUP BY ALL""")
def n1_days(spark, sf):
    p = obs(spark, sf).groupBy("solar_day", "y", "x").agg(F.bool_or(F.col("fmask") == 2).alias("m"))
    return morphology.dilate_rows(p, "m", 2, ["solar_day"]).select("solar_day", "y", "x", "dilated")


@query("r3_average", OBS + " SELECT (y // 3)::BIGINT AS y, (x // 3)::BIGINT AS x, avg(red)::DOUBLE AS red FROM obs GROUP BY 1, 2")
def r3(spark, sf):
    return spatial.average_down(obs(spark, sf), ["red"], 3)


@query("r1_nearest", OBS + ", p AS (SELECT y, x, sum(red)::BIGINT AS red FROM obs GROUP BY ALL) SELECT (y // 2)::BIGINT AS y, (x // 2)::BIGINT AS x, red FROM p WHERE y % 2 = 1 AND x % 2 = 1")
def r1(spark, sf):
    return spatial.nearest(obs(spark, sf).groupBy("y", "x").agg(F.sum("red").alias("red")), 2).select(F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), "red")


@query("r1_bilinear", OBS + """, p AS (SELECT y, x, sum(red)::DOUBLE AS red FROM obs GROUP BY ALL), w(i, j, w) AS (VALUES (0, 0, 0.375::DOUBLE), (0, 1, 0.375::DOUBLE), (1, 0, 0.125::DOUBLE), (1, 1, 0.125::DOUBLE))
SELECT y - i AS y, x - j AS x, round(sum(red * w) / sum(w), 6) AS red FROM p, w GROUP BY 1, 2""")
def r1b(spark, sf):
    return spatial.bilinear(obs(spark, sf).groupBy("y", "x").agg(F.sum("red").cast("double").alias("red")), ["red"], 0.25, 0.5).withColumn("red", F.round("red", 6))


@query("u_fusers", OBS + """ SELECT y, x, solar_day, arg_min(red, (id * 10 + l_linenumber, red)) FILTER (fmask <> 0) AS red, bool_or(fmask = 2) AS cloud, floor(avg(CASE WHEN fmask <> 0 THEN nir END))::BIGINT AS nir FROM obs GROUP BY ALL""")
def u(spark, sf):
    o = obs(spark, sf).withColumns({"red": F.when(F.col("fmask") != 0, F.col("red")), "nir": F.when(F.col("fmask") != 0, F.col("nir")), "cloud": F.col("fmask") == 2, "time": F.col("id") * 10 + F.col("l_linenumber")})
    return o.groupBy("y", "x", "solar_day").agg(fuse.first_valid("red"), fuse.any_of("cloud"), fuse.mean_int("nir"))


HOURLY = ", h AS (SELECT *, date_trunc('hour', center_time) AS hour FROM scenes)"


def hourly(spark, sf):
    return scenes(spark, sf).withColumn("center_time", F.date_trunc("hour", "center_time")).withColumn("region_code", (F.col("region_code").cast("int") % 10).cast("string"))


@query("j1_fuse_join", SCENES + HOURLY + " SELECT hour AS center_time, (CAST(region_code AS INT) % 10)::VARCHAR AS region_code, count(*) AS n FROM h GROUP BY ALL HAVING count(*) >= 3")
def j1(spark, sf):
    return planner.fuse_join(hourly(spark, sf), 2).select("center_time", "region_code", "n")


@query("j2_optional_join", SCENES + HOURLY + " SELECT hour AS center_time, (CAST(region_code AS INT) % 10)::VARCHAR AS region_code, count(*) AS n FROM h GROUP BY ALL HAVING count(*) >= 3 OR (count(*) >= 2 AND count(*) FILTER (product <> 'click') >= 2)")
def j2(spark, sf):
    return planner.fuse_join(hourly(spark, sf), 2, ("click",)).select("center_time", "region_code", "n")


@query("j3_timeless_join", SCENES + ", e AS (SELECT id AS extra_id, region_code FROM scenes WHERE product = 'purchase') SELECT s.id, center_time, extra_id FROM scenes s JOIN e USING (region_code) WHERE product = 'click'")
def j3(spark, sf):
    s = scenes(spark, sf)
    return planner.join_timeless(s.where("product = 'click'"), s.where("product = 'purchase'")).select("id", "center_time", "extra_id")


@query("j7_named_bins", SCENES + """, b(period, s, e) AS (VALUES ('2024-01-03--P7D', TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-09 23:59:59.999999'), ('2024-01-08--P10D', TIMESTAMP '2024-01-08', TIMESTAMP '2024-01-17 23:59:59.999999'))
SELECT id, period FROM scenes JOIN b ON center_time BETWEEN s AND e""")
def j7(spark, sf):
    bins = {p.short: p for p in (Period(datetime(2024, 1, 3), 7, "D"), Period(datetime(2024, 1, 8), 10, "D"))}
    return planner.named_bins(scenes(spark, sf), bins).select("id", "period")


LOCAL = SCENES + ", t AS (SELECT *, center_time + INTERVAL 10 HOUR AS t FROM (SELECT l_orderkey * 10 + l_linenumber AS id, l_shipdate AS center_time FROM lineitem))"


def shipped(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_shipdate").alias("center_time"), F.lit(10.0).alias("utc_offset"))


@query("b1_annual", LOCAL + " SELECT id, strftime(t, '%Y') || '--P1Y' AS period FROM t")
def b1(spark, sf):
    return planner.binned(shipped(spark, sf), "annual").select("id", "period")


@query("b2_full_history", LOCAL + " SELECT id, (SELECT year(min(center_time)) || '--P' || (year(max(center_time)) - year(min(center_time)) + 1) || 'Y' FROM t) AS period FROM t")
def b2(spark, sf):
    return planner.binned(shipped(spark, sf), "all").select("id", "period")


@query("b5_seasons", LOCAL + " SELECT id, CASE WHEN month(t) = 12 THEN year(t) WHEN month(t) < 3 THEN year(t) - 1 ELSE year(t) END || '-' || lpad(CASE WHEN month(t) IN (12, 1, 2) THEN '12' ELSE (month(t) // 3 * 3)::VARCHAR END, 2, '0') || '--P3M' AS period FROM t")
def b5(spark, sf):
    return planner.binned(shipped(spark, sf), "seasonal").select("id", "period")


@query("b4_single_season", LOCAL + " SELECT id, CASE WHEN month(t) >= 11 THEN year(t) ELSE year(t) - 1 END || '-11--P5M' AS period FROM t WHERE month(t) IN (11, 12, 1, 2, 3)")
def b4(spark, sf):
    return planner.binned(shipped(spark, sf), "nov-mar").select("id", "period")


@query("b6_rolling", LOCAL + """, b AS (SELECT s::TIMESTAMP AS s, s::TIMESTAMP + INTERVAL 3 MONTH - INTERVAL 1 MICROSECOND AS e FROM unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-10-01', INTERVAL 1 MONTH)) g(s))
SELECT id, strftime(s, '%Y-%m') || '--P3M' AS period FROM t JOIN b ON t BETWEEN s AND e""")
def b6(spark, sf):
    return planner.binned(shipped(spark, sf), "rolling-3months", Period.parse("1995--P7Y")).select("id", "period")


@query("b6_rolling_span", LOCAL + """, r AS (SELECT date_trunc('year', min(t)) AS a, date_trunc('year', max(t)) AS z FROM t), b AS (SELECT s, s + INTERVAL 3 MONTH - INTERVAL 1 MICROSECOND AS e FROM (SELECT unnest(generate_series(a, z + INTERVAL 9 MONTH, INTERVAL 1 MONTH)) AS s FROM r))
SELECT id, strftime(s, '%Y-%m') || '--P3M' AS period FROM t JOIN b ON t BETWEEN s AND e""")
def b6_span(spark, sf):
    s = shipped(spark, sf)
    local = local_time(F.col("center_time"), F.col("utc_offset"))
    r = s.agg(F.year(F.min(local)).alias("a"), F.year(F.max(local)).alias("z")).first()  # one row
    if r.a is None:
        return s.where("false").select("id", F.lit("").alias("period"))
    return planner.binned(s, "rolling-3months", Period(datetime(r.a, 1, 1), r.z - r.a + 1, "Y")).select("id", "period")


@query("b8_tasks", SCENES + " SELECT strftime(center_time, '%Y') || '--P1Y' AS period, x, y, count(DISTINCT id)::INT AS n FROM scenes GROUP BY ALL")
def b8(spark, sf):
    b = planner.binned(scenes(spark, sf).withColumn("utc_offset", F.lit(0.0)), "annual")
    return planner.tasks_of(b.union(b)).select("period", "x", "y", F.size("dataset_ids").alias("n"))


@query("s1_task_counts", SCENES + " SELECT strftime(center_time, '%Y-%m') || '--P1M' AS T, printf('%+05d', x) AS X, printf('%+05d', y) AS Y, count(DISTINCT id) AS datasets, count(DISTINCT center_time::DATE) AS days FROM scenes GROUP BY ALL".replace("AS T,", "AS \"T\",").replace("AS X,", "AS \"X\",").replace("AS Y,", "AS \"Y\","))
def s1(spark, sf):
    return planner.task_counts(scenes(spark, sf).withColumn("period", F.date_format("center_time", "yyyy-MM'--P1M'")))


@query("s5_extent", SCENES + " SELECT min(center_time) AS start, max(center_time) AS \"end\" FROM scenes")
def s5(spark, sf):
    return planner.time_extent(scenes(spark, sf))


@query("s9_platforms", SCENES + " SELECT 'p' AS period, x, y, string_agg(DISTINCT product, ',' ORDER BY product) AS platform, string_agg(DISTINCT product, '_' ORDER BY product) AS instrument FROM scenes GROUP BY ALL")
def s9(spark, sf):
    return planner.platforms(scenes(spark, sf).withColumns({"period": F.lit("p"), "platform": F.col("product"), "instrument": F.col("product")}))


@query("j13_pending", SCENES + " SELECT DISTINCT x, y FROM scenes WHERE NOT (x = 3 OR y = 2)")
def j13(spark, sf):
    t = scenes(spark, sf).select("x", "y").dropDuplicates()
    return planner.pending(t, t.where("x = 3 or y = 2"), ["x", "y"])


@query("j14_newest", SCENES + HOURLY + ", r AS (SELECT id, row_number() OVER (PARTITION BY hour, (CAST(region_code AS INT) % 10) ORDER BY product DESC, id DESC) AS r FROM h) SELECT id FROM r WHERE r = 1")
def j14(spark, sf):
    return planner.newest_version(hourly(spark, sf).withColumn("label", F.col("product")))[0].select("id")


@query("j6_tiles", SCENES + ", f AS (SELECT id, x * 10.0 AS a, x * 10.0 + 12.0 AS c, y * 10.0 - 3.0 AS b, y * 10.0 + 2.0 AS d FROM scenes), g AS (SELECT id, unnest(generate_series(floor(a / 10)::INT, floor(c / 10)::INT)) AS x, b, d FROM f) SELECT id, x::INT AS x, unnest(generate_series(floor(b / 10)::INT, floor(d / 10)::INT))::INT AS y FROM g")
def j6(spark, sf):
    f = scenes(spark, sf).select("id", (F.col("x") * 10.0).alias("min_x"), (F.col("x") * 10.0 + 12).alias("max_x"), (F.col("y") * 10.0 - 3).alias("min_y"), (F.col("y") * 10.0 + 2).alias("max_y"))
    return spatial.to_tiles(f, spatial.Grid((10.0, 10.0), 1.0)).select("id", "x", "y")


@query("k4_manifest", SCENES + " SELECT x, y, string_agg(sha1(id::VARCHAR) || '  ' || id || '.tif', chr(10) ORDER BY sha1(id::VARCHAR) || '  ' || id || '.tif') AS manifest FROM scenes GROUP BY ALL")
def k4(spark, sf):
    f = scenes(spark, sf).select(F.lit("p").alias("period"), "x", "y", F.concat(F.col("id").cast("string"), F.lit(".tif")).alias("name"), F.col("id").cast("string").cast("binary").alias("content"))
    return sinks.manifest(f).select("x", "y", "manifest")


@query("k9_paths", SCENES + " SELECT DISTINCT 's3://b/x' || lpad(x::VARCHAR, 2, '0') || '/y' || lpad(y::VARCHAR, 2, '0') || '/2024--P1Y/gm_x' || lpad(x::VARCHAR, 2, '0') || 'y' || lpad(y::VARCHAR, 2, '0') || '_2024--P1Y_final_red.tif' AS path FROM scenes")
def k9(spark, sf):
    return scenes(spark, sf).select("x", "y").dropDuplicates().withColumn("period", F.lit("2024--P1Y")).select(sinks.output_path("s3://b", "gm", "red", maturity="final").alias("path"))


@query("f9_checker", SCENES + " SELECT id FROM scenes WHERE (product = 'click' AND center_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-05 23:59:59.999999') OR product = 'purchase'")
def f9(spark, sf):
    s = scenes(spark, sf).withColumn("properties", F.create_map(F.lit("platform"), F.col("product")))
    return s.where(planner.checker('{"platform": "click", "datetime": "2024-01-05--P1D"}|{"platform": "purchase"}')).select("id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from chronocell import catalogue_models, catalogue_more, catalogue_runs, catalogue_space  # noqa: F401  register the rest

    return dict(Q)


def oracle_sql() -> dict[str, str]:
    from chronocell import catalogue_models, catalogue_more, catalogue_runs, catalogue_space  # noqa: F401

    return dict(SQL)


