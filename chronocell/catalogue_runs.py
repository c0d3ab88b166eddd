"""Queries of whole runs: the commands from scenes to tasks, results, documents and queue, each with the same in SQL.

An order line stands for a scene, in one tile of 25 degrees, and for one pixel of it.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from chronocell import cli
from chronocell.catalogue import query
from chronocell.functions.periods import Period
from chronocell.functions.tables import folder
from chronocell.operators import planner, spatial
from chronocell.plans.tasks import SaveOptions, plan_tasks
from chronocell.sources import catalogue_items, sinks
from chronocell.streaming import tasks as streams

GRID, DEGREES = "25,25,1", spatial.Grid((25.0, 25.0), 1.0)
LINES = """lines AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE)) AS id, CASE WHEN l_linenumber % 2 = 0 THEN 'even' ELSE 'odd' END AS product, l_shipdate + INTERVAL 20 HOUR * (l_orderkey % 2) AS center_time,
  (l_suppkey % 5)::INT AS tx, (l_partkey % 3)::INT AS ty, (l_orderkey % 3)::BIGINT AS y, (l_partkey % 4)::BIGINT AS x, CASE l_returnflag WHEN 'A' THEN 128 WHEN 'R' THEN 64 ELSE 0 END AS water, CAST(l_shipdate AS DATE) AS solar_day FROM lineitem),
t AS (SELECT *, center_time + INTERVAL 1 HOUR * round_even((tx * 25 + 12.5) / 15, 0)::INT AS t FROM lines)"""
PLANNED = LINES + ", b AS (SELECT *, strftime(t, '%Y') || '--P1Y' AS period FROM t WHERE t >= TIMESTAMP '1994-01-01' AND t < TIMESTAMP '1997-01-01')"
TASKS = PLANNED + ", k AS (SELECT period, tx AS x, ty AS y, string_agg(id, ',' ORDER BY id) AS dataset_ids, count(*) AS n FROM b GROUP BY ALL)"


def lines(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").cast("string")).alias("id"), F.when(F.col("l_linenumber") % 2 == 0, "even").otherwise("odd").alias("product"),
        F.expr("cast(l_shipdate as timestamp) + make_dt_interval(0, cast(20 * (l_orderkey % 2) as int))").alias("center_time"),
        (F.col("l_suppkey") % 5).cast("int").alias("tile_x"), (F.col("l_partkey") % 3).cast("int").alias("tile_y"), (F.col("l_orderkey") % 3).alias("y"), (F.col("l_partkey") % 4).alias("x"),
        F.when(F.col("l_returnflag") == "A", 128).when(F.col("l_returnflag") == "R", 64).otherwise(0).alias("water"), F.to_date("l_shipdate").alias("solar_day"),
    )


def taken(spark, sf):
    """Scenes with their footprints."""
    low = {"min_x": F.col("tile_x") * 25.0 + 3, "min_y": F.col("tile_y") * 25.0 + 3}
    s = lines(spark, sf).select("id", "product", "center_time", F.format_string("x%dy%d", "tile_x", "tile_y").alias("region_code"), *[c.alias(n) for n, c in low.items()], *[(c + 4).alias(n.replace("min", "max")) for n, c in low.items()])
    return s.withColumns({"label": F.col("id"), "properties": F.create_map(F.lit("id"), F.col("id"))})


def call(spark, *args: str) -> None:
    if code := cli.main(list(args), spark):
        raise RuntimeError(f"{args[0]} ended with {code}")


def saved(spark, sf) -> tuple[str, str]:
    """Paths of the scenes and of the tasks that save-tasks makes of them."""
    where, out = folder(spark, "scenes"), folder(spark, "saved")
    taken(spark, sf).write.parquet(where)
    call(spark, "save-tasks", where, out, "--products", "even-odd", "--frequency", "annual", "--temporal-range", "1994--P3Y", "--grid", GRID)
    return where, f"{out}/tasks"


@query("cli_save_tasks", TASKS + " SELECT period, x, y, dataset_ids FROM k")
def save_tasks(spark, sf):
    t = catalogue_items.read_tasks(spark, saved(spark, sf)[1])
    return t.select("period", "x", "y", F.array_join("dataset_ids", ",").alias("dataset_ids"))


@query("src6_task_scenes", PLANNED + " SELECT period, tx AS x, ty AS y, id, product FROM b")
def task_scenes(spark, sf):
    scenes, tasks = saved(spark, sf)
    return catalogue_items.scenes_of(catalogue_items.read_tasks(spark, tasks), spark.read.parquet(scenes)).select("period", "x", "y", "id", "product")


@query("cli_run", PLANNED + """, d AS (SELECT period, tx, ty, y, x, solar_day, bool_or(water = 64) AS bad, bool_or(water = 0) AS dry, bool_or(water = 128) AS wet FROM b GROUP BY ALL),
n AS (SELECT period, tx AS tile_x, ty AS tile_y, y, x, count(*) FILTER (bad) AS b, count(*) FILTER (wet AND NOT dry AND NOT bad) AS w, count(*) FILTER (dry AND NOT wet AND NOT bad) AS c FROM d GROUP BY ALL)
SELECT period, tile_x, tile_y, y, x, CASE WHEN b + w + c > 0 THEN w ELSE -999 END::BIGINT AS count_wet, CASE WHEN b + w + c > 0 THEN w + c ELSE -999 END::BIGINT AS count_clear FROM n""")
def run(spark, sf):
    """All tasks' results, as they are found where the command wrote them."""
    scenes, tasks = saved(spark, sf)
    px, out = folder(spark, "pixels"), folder(spark, "results")
    lines(spark, sf).select(F.col("id").alias("dataset_id"), "tile_x", "tile_y", "y", "x", F.col("center_time").alias("time"), "solar_day", "water").write.parquet(px)
    call(spark, "run", tasks, scenes, px, out, "wofs-summary", "--grid", GRID)
    r = spark.read.parquet(out)
    return r.select(F.col("period").cast("string").alias("period"), *[F.col(c).cast("int").alias(c) for c in ("tile_x", "tile_y")], "y", "x", *[F.col(c).cast("long").alias(c) for c in ("count_wet", "count_clear")])


#: Two parts, the second a triangle: they meet tiles 1 and 2 of the first row, and tile 4 of the third.
AREA = [[[[30, 5], [60, 5], [60, 20], [30, 20], [30, 5]]], [[[110, 60], [113, 60], [110, 62], [110, 60]]]]


@query("cli_publish_tasks", TASKS + " SELECT period, x, y FROM k WHERE (x IN (1, 2) AND y = 0) OR (x = 4 AND y = 2)")
def publish_tasks(spark, sf):
    """Tasks as a stream takes them from the queue that the command filled."""
    _, tasks = saved(spark, sf)
    area, queue, out, state = (folder(spark, k) for k in ("area", "queue", "received", "state"))
    text = json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": AREA}}]})
    spark.range(1).select(F.lit(text)).coalesce(1).write.text(area)
    call(spark, "publish-tasks", tasks, queue, "--geojson-filter", area, "--grid", GRID)
    work = lambda m, n: m.write.mode("overwrite").parquet(f"{out}/batch={n}")
    streams.run_stream(streams.task_stream(spark, queue), work, state).awaitTermination()
    return spark.read.parquet(out).select("period", "x", "y")


@query("f10_selectors", TASKS + """, o AS (SELECT period, x, y, row_number() OVER (ORDER BY period, x, y) - 1 AS i, count(*) OVER () AS n FROM k)
SELECT period, x, y, 0 AS selector, (i - 1) // 3 AS place FROM o WHERE i >= 1 AND i < n - 1 AND (i - 1) % 3 = 0 UNION ALL SELECT period, x, y, 1, 0 FROM o WHERE period = '1995--P1Y' AND x = 2 AND y = 1
UNION ALL SELECT period, x, y, s, 0 FROM o, unnest([2, 3]) u(s) WHERE i = 0 UNION ALL SELECT period, x, y, 4, 0 FROM o WHERE i = n - 1""")
def selectors(spark, sf):
    """A slice, an id, an index that is chosen twice, and the last task."""
    t = planner.tasks_of(plan_tasks(taken(spark, sf), DEGREES, SaveOptions("even-odd", "annual", Period.parse("1994--P3Y"))))
    return planner.selected(t, ["1:-1:3", "1995--P1Y/2/1", "0", "0", "-1"]).select("period", "x", "y", F.col("_nth.selector").alias("selector"), F.col("_nth.place").alias("place"))


@query("f5_fused_predicate", LINES + """, g AS (SELECT center_time, tx, ty FROM t WHERE center_time BETWEEN TIMESTAMP '1993-12-31' - INTERVAL 864 MINUTE + INTERVAL 1 DAY AND TIMESTAMP '1995-12-31 23:59:59.999999' + INTERVAL 864 MINUTE GROUP BY ALL HAVING count(*) >= 2)
SELECT (year(t) - CASE WHEN month(t) < 3 THEN 1 ELSE 0 END)::INT || '-' || ['12', '12', '03', '03', '03', '06', '06', '06', '09', '09', '09', '12'][month(t)] || '--P3M' AS period, tx AS x, ty AS y, string_agg(id, ',' ORDER BY id) AS dataset_ids
FROM t JOIN g USING (center_time, tx, ty) WHERE t >= TIMESTAMP '1994-01-01' AND t < TIMESTAMP '1996-01-01' AND product = 'even' GROUP BY ALL""")
def fused_predicate(spark, sf):
    """Seasonal tasks of scenes that have another one at their time and region; then the predicate chooses."""
    options = SaveOptions("even+odd", "seasonal", Period.parse("1994--P2Y"), predicate=F.col("product") == "even")
    return planner.tasks_of(plan_tasks(taken(spark, sf), DEGREES, options)).select("period", "x", "y", F.array_join("dataset_ids", ",").alias("dataset_ids"))


@query("k3_dataset_documents", TASKS + """, c AS (SELECT *, 'x0' || x || 'y0' || y AS code FROM k)
SELECT period, x, y, 'w_' || code || '_' || period AS label, code AS region_code, '[25,25]' AS shape, '[1.0,0.0,' || (x * 25) || '.0,0.0,-1.0,' || (y * 25 + 25) || '.0]' AS transform,
  's3://b/x0' || x || '/y0' || y || '/' || period || '/w_' || code || '_' || period || '_wet.tif' AS wet, n::INT AS sources, '["even","odd"]' AS inputs, '{"a": 1}' AS config FROM c""")
def dataset_documents(spark, sf):
    """Dataset documents beside the records of how the tasks were made."""
    t = planner.tasks_of(plan_tasks(taken(spark, sf), DEGREES, SaveOptions("even-odd", "annual", Period.parse("1994--P3Y"))))
    get = lambda p: F.get_json_object("document", p)
    d = sinks.dataset_documents(t, "w", ["wet"], "s3://b", DEGREES).select(
        "period", "x", "y", get("$.label").alias("label"), get("$['properties']['odc:region_code']").alias("region_code"), get("$.grids.default.shape").alias("shape"), get("$.grids.default.transform").alias("transform"),
        get("$.measurements.wet.path").alias("wet"), F.size(F.from_json(get("$.lineage.level3"), "array<string>")).alias("sources"),
    )
    p = sinks.processing_documents(t, ["odd", "even"], {"a": 1}, [("chronocell", "", "1")])
    return d.join(p.select("period", "x", "y", get("$['input-products']").alias("inputs"), get("$.config").alias("config")), ["period", "x", "y"])
