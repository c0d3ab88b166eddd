from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronocell.functions import parsing
from chronocell.functions.periods import Period, rolling_rules, season_label, season_rules, single_season_rules
from chronocell.operators import planner, polygons, spatial
from chronocell.plans.tasks import SaveOptions, plan_tasks, run_tasks
from chronocell.sources import catalogue_items, scene_store, sinks
from chronocell.streaming import tasks as streams


def test_periods():
    p = Period.parse("2019--P1Y")
    assert (p.start, p.end) == (datetime(2019, 1, 1), datetime(2019, 12, 31, 23, 59, 59, 999999))
    assert Period.parse("2019-03-07--P1M").end == datetime(2019, 4, 6, 23, 59, 59, 999999)
    assert Period.parse("2015-07--P1Y").end == datetime(2016, 6, 29, 23, 59, 59, 999999)
    assert Period.parse("2019-01-31--P1M").end == datetime(2019, 3, 2, 23, 59, 59, 999999)
    assert Period.parse("2014-07--P1Y").short == "2014-07-01--P1Y"
    assert Period.year(2000) + 1 == Period.year(2001) and Period.year(2000) - 1 == Period.year(1999)
    assert datetime(2019, 12, 31) in p and datetime(2020, 1, 1) not in p


def test_seasons(spark):
    assert single_season_rules(5, 11) == {m: "11--P5M" for m in (11, 12, 1, 2, 3)}
    assert season_rules(3, 12)[1] == "12--P3M" and season_rules(12, 7)[3] == "07--P1Y"
    assert len(rolling_rules(Period.parse("2019-03--P2Y"), 6, 1)) == 19
    df = spark.createDataFrame([(datetime(2020, 1, 28),), (datetime(2020, 12, 30),), (datetime(2020, 4, 1),)], ["t"])
    assert [r[0] for r in df.select(season_label(F.col("t"), single_season_rules(5, 11))).collect()] == ["2019-11--P5M", "2020-11--P5M", None]


@pytest.mark.parametrize("signs", ["+", "-", "+-", "-+", "++-"])
@pytest.mark.parametrize("around", ["", "-", "+-+"])
def test_products(signs, around):
    """A run of signs is one operator that its first sign decides; signs at the ends mean nothing; paths may hold hyphens."""
    for parts in (["alpha", "beta_2"], ["alpha", "beta_2", "gamma"], ["s3://some-bucket/a-b/1-2-3/", "alpha"], ["alpha", "s3://x/y-z/", "s3://q/"]):
        text = around + signs.join(parts) + around
        joins = (len(parts) - 1) * (signs[0] == "+")
        assert parsing.parse_products(text) == ([(n, not n.startswith("s3://")) for n in parts], joins)
    assert parsing.parse_products("p+q-r") == ([("p", True), ("q", True), ("r", True)], 1)


def test_task_ids(spark):
    for x, y in ((0, 0), (7, -12), (-105, 31)):
        task = ("2021--P3M", x, y)
        assert parsing.parse_task(parsing.render_task(task)) == task
        for sep in "/,":
            assert parsing.parse_task(sep.join((task[0], f"{x:+04d}", f"{y:+d}"))) == task
            assert parsing.parse_task(sep.join((f"x{x:+d}", f"y{y:+04d}", task[0]))) == task
        assert parsing.parse_message(parsing.render_message(task, "t.db")) == (task, "t.db")
    every = sorted((f"20{10 + i // 3}--P1Y", i % 3, -i) for i in range(12))
    table = spark.createDataFrame(every[::-1], "period string, x int, y int")
    chosen = lambda selectors: [tuple(r)[:3] for r in planner.selected(table, selectors).orderBy("_nth").collect()]
    for s in ("3", "-1", "2:9:3", ":4", "-3:", "::5"):
        want = every[slice(*[int(p) if p else None for p in s.split(":")])] if ":" in s else [every[int(s)]]
        assert chosen([s]) == want
    assert chosen(["5", parsing.render_task(every[2]), "5", "7:3:-2"]) == [every[5], every[2], every[5], every[7], every[5]]
    for bad in ("12", "-13", "2030--P1Y/0/0", "word", "a:b", "1:2:3:4"):
        with pytest.raises(ValueError):
            chosen(["0", bad])
    assert parsing.parse_range2d("-2:3,4:15") == ((-2, 3), (4, 15)) and parsing.parse_resolution("25") == (-25, 25) and parsing.parse_resolution("-8,16") == (-8, 16)
    assert parsing.compatible_resolution((96, 64), (-16, 32)) and not parsing.compatible_resolution((96, 64), (-16, 28))


def test_queries_are_stored_plainly():
    ring = [(0, 0), (1, 0), (1, 1), (0, 0)]
    q = {"time": (datetime(2020, 1, 2), Period.parse("2020--P1Y")), "geopolygon": ring, "n": 3}
    assert parsing.plain(q) == {"time": ["2020-01-02T00:00:00", "2020--P1Y"], "geopolygon": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}, "n": 3}


def test_rolling_labels_are_the_rules(spark):
    from chronocell.functions.periods import rolling_labels

    period = Period.parse("2019-11--P1Y")
    df = spark.sql("SELECT explode(sequence(timestamp '2019-08-15', timestamp '2021-01-15', interval 5 days)) AS t")
    for months, interval in ((3, 1), (6, 2), (5, 3)):
        rules = rolling_rules(period, months, interval)
        got = df.select("t", rolling_labels(F.col("t"), period, months, interval).alias("l")).collect()
        assert all(sorted(r.l or []) == sorted(n for n, p in rules.items() if r.t in p) for r in got)


def test_ids_agree(spark):
    want = str(sinks.deterministic_id("a", "1", ["s2", "s1"], tag="T"))
    name = "\n".join(["a", "1", "", "tag=t", "s1", "s2"])
    assert spark.range(1).select(sinks.uuid5_column(F.lit(name))).first()[0] == want


SCENES = "id string, product string, center_time timestamp, region_code string, min_x double, min_y double, max_x double, max_y double, label string, crs string, properties map<string,string>, measurements map<string,string>"


def scene(i, product, t, region, x=0.5):
    return (i, product, t, region, x, 0.5, x + 0.1, 0.6, f"l{i}", "EPSG:1", {"a": "1", "b": i}, {product: f"{i}.tif"})


def test_plan_and_run(spark):
    t = datetime(2019, 5, 1, 10)
    s = spark.createDataFrame([scene("1", "p", t, "r"), scene("2", "q", t, "r"), scene("3", "p", datetime(2019, 6, 1), "r"), scene("4", "p", datetime(2021, 6, 1), "r", 1.5)], SCENES)
    grid = spatial.Grid((1.0, 1.0), 0.1)
    union = planner.tasks_of(plan_tasks(s, grid, SaveOptions("p-q", "annual", Period.parse("2019--P1Y"))))
    assert [(r.period, r.x, r.y, r.dataset_ids) for r in union.collect()] == [("2019--P1Y", 0, 0, ["1", "2", "3"])]
    joined = planner.tasks_of(plan_tasks(s, grid, SaveOptions("p+q")))
    assert [r.dataset_ids for r in joined.collect()] == [["1", "2"]]
    px = spark.createDataFrame([("1", 0, 0, 0, 0, 1, "d1", 128), ("3", 0, 0, 0, 0, 2, "d2", 0)], ["dataset_id", "tile_x", "tile_y", "y", "x", "time", "solar_day", "water"])
    r = run_tasks(spark, union, s, px, "wofs-summary").first()
    assert (r.period, r.count_wet, r.count_clear, r.frequency) == ("2019--P1Y", 1, 2, 0.5)
    merged = planner.merge_documents(s.where("id in ('1', '2')")).first()
    assert merged["product"] == "fused__p__q" and merged.properties == {"a": "1"} and sorted(merged.measurements) == ["p", "q"]
    done = union.select("period", "x", "y")
    assert planner.pending(union, done).count() == 0
    assert planner.dry_run(union, done).first().state == "skip"
    assert {r.days for r in planner.dry_run(union, done, scenes=s).collect()} == {2}
    kept, skipped = planner.newest_version(s)
    assert kept.count() == 3 and [r.id for r in skipped.collect()] == ["1"]


def test_run_on_prepared_and_resampled_pixels(spark):
    """Expressions on native pixels, then a coarser grid, then the summary; another column than the day may fuse."""
    tasks = spark.createDataFrame([("p", 0, 0, ["a", "b"])], "period string, x int, y int, dataset_ids array<string>")
    data = [(d, 0, 0, y, x, t, day, 128 if (y + x + t) % 3 else 2) for t, (d, day) in enumerate((("a", "d1"), ("b", "d1"))) for y in range(4) for x in range(4)]
    px = spark.createDataFrame(data, "dataset_id string, tile_x int, tile_y int, y int, x int, time int, solar_day string, water int")
    scenes = spark.createDataFrame([("a",)], "id string")
    flip = lambda df: df.withColumn("water", F.when(F.col("water") == 2, 0).otherwise(F.col("water")))
    got = run_tasks(spark, tasks, scenes, px, "wofs-summary", native=flip, resampling=("nearest", 2), group_by="time").collect()
    want = {(y, x): [(2 * y + 1 + 2 * x + 1 + t) % 3 != 0 for t in (0, 1)] for y in (0, 1) for x in (0, 1)}
    assert {(r.y, r.x): (r.count_wet, r.count_clear) for r in got} == {k: (sum(v), 2) for k, v in want.items()}
    with pytest.raises(ValueError):
        run_tasks(spark, tasks, scenes, px, "wofs-summary", resampling=("cubic", 2))
    a = px.where("time = 0").select("y", "x", "water")
    both = planner.aligned({"a": a, "b": a.where("x < 2").withColumn("more", F.lit(1))})
    assert both.columns == ["y", "x", "a.water", "b.water", "more"] and both.count() == 8


def test_time_independent_scenes(spark):
    """p+dem: the region's elevation joins each group with the group's time; p-dem has no time for it."""
    t = datetime(2019, 5, 1, 10)
    s = spark.createDataFrame([scene("1", "p", t, "r"), scene("2", "p", datetime(2019, 6, 1), "r"), scene("3", "p", t, "other"), scene("d", "dem", datetime(2000, 1, 1), "r")], SCENES)
    grid = spatial.Grid((1.0, 1.0), 0.1)
    plan = lambda text, **more: planner.tasks_of(plan_tasks(s, grid, SaveOptions(text, "annual", Period.parse("2019--P1Y"), ignore_time=("dem",), **more))).collect()
    assert [(r.period, r.dataset_ids) for r in plan("p+dem")] == [("2019--P1Y", ["1", "2", "d"])]
    assert [r.dataset_ids for r in plan("p-dem")] == [["1", "2", "3"]]
    assert [r.dataset_ids for r in plan("p-dem", predicate=F.col("id") != "2")] == [["1", "3"]]
    copies = planner.with_timeless(s.where("product = 'p'"), s.where("product = 'dem'")).where("id = 'd'").collect()
    assert {r.center_time for r in copies} == {t, datetime(2019, 6, 1)} and {r.label for r in copies} == {"deml1".replace("p", ""), "deml2"}


def test_optional_products_by_part_of_the_name(spark):
    t = datetime(2019, 5, 1)
    s = spark.createDataFrame([scene("1", "first", t, "a"), scene("2", "second", t, "a"), scene("3", "first", t, "b"), scene("4", "opt", t, "b")], SCENES)
    of = lambda names: sorted(r.region_code for r in planner.fuse_join(s, 2, names).collect())
    assert of(("s3://x/opt/1/",)) == ["a"] and of(()) == []


def test_fused_products_and_scenes(spark):
    product = lambda n, *bands, **more: {"name": n, "metadata_type": "eo3", "measurements": [{"name": b} for b in bands], **more}
    f = planner.fuse_products([product("a", "x", description="A", file_format="T"), product("b", "y", file_format="T")])
    assert (f["name"], f["file_format"], f["description"]) == ("fused__a__b", "T", "Fused products: A,non_indexed_1") and [m["name"] for m in f["measurements"]] == ["x", "y"]
    assert "file_format" not in planner.fuse_products([product("a", "x"), product("b", "y", file_format="T")])
    for bad in ([product("a", "x")], [product("a", "x"), product("b", "x")], [product("a", "x", file_format="T"), product("b", "y", file_format="U")], [product("a", "x"), {**product("b", "y"), "metadata_type": "eo"}]):
        with pytest.raises(ValueError):
            planner.fuse_products(bad)
    kind = "id string, product string, label string, schema string, crs string, center_time timestamp, region_code string, grids map<string,struct<shape:array<int>,transform:array<double>>>, measurements map<string,string>, properties map<string,string>"
    grid = lambda last=0.0, step=1.0: {"default": ([2, 2], [step, 0.0, 0.0, 0.0, -1.0, 0.0, last])}

    def pair(**change):
        t = datetime(2019, 5, 1)
        one = {"id": "i1", "product": "a", "label": "a_x", "schema": "s", "crs": "EPSG:1", "center_time": t, "region_code": "r", "grids": grid(), "measurements": {"x": "x.tif"}, "properties": {"datetime": "2019-05-01T00:00:00Z", "k": "v", "only": "1"}}
        two = one | {"id": "i2", "product": "b", "label": "b_x", "crs": "epsg:1", "grids": grid(1.0) | {"more": grid()["default"]}, "measurements": {"y": "y.tif"}, "properties": {"datetime": "2019-05-01T00:00:00+00:00", "k": "v", "only": "2"}} | change
        return planner.fuse_scenes(spark.createDataFrame([tuple(one.values()), tuple(two[k] for k in one)], kind))

    r = pair().first()
    assert (r.product, r.label, r.datetime, sorted(r.grids), r.measurements, r.sources) == ("fused__a__b", "fused__a__b_x", "2019-05-01T00:00:00+00:00", ["default", "more"], {"x": "x.tif", "y": "y.tif"}, ["i1", "i2"])
    assert r.properties == {"datetime": "2019-05-01T00:00:00+00:00", "k": "v", "fused": "True"} and r.id == str(sinks.deterministic_id("fused__a__b", "0.0.0", ["i1", "i2"]))
    for change, what in (({"label": "b_z"}, "labels"), ({"label": None}, "label"), ({"schema": "z"}, "schemas"), ({"crs": "EPSG:2"}, "coordinate"), ({"properties": {"datetime": "2019-05-02T00:00:00Z"}}, "datetimes"), ({"grids": grid(step=2.0)}, "grids")):
        with pytest.raises(Exception, match=what):
            pair(**change).collect()


def test_documents(spark):
    import json
    import math

    tasks = spark.createDataFrame([("2019--P1Y", 3, -4, ["s2", "s1"], "2019-01-01T00:00:00Z", "2019-12-31T23:59:59Z", {"eo:gsd": "30", "odc:file_format": "old"})], "period string, x int, y int, dataset_ids array<string>, start_datetime string, end_datetime string, shared map<string,string>")
    grid = spatial.Grid((10.0, 20.0), 5.0, crs="EPSG:3857")
    d = json.loads(sinks.item_documents(tasks, "gm", ["red"], "s3://b", grid, "http://about", "2020-01-01T00:00:00Z", {"k": "v"}).first().document)
    degrees = [math.degrees(m / 6378137) for m in (30, -80, 40, -60)]  # so near to the equator, both ways alike
    assert d["bbox"] == pytest.approx(degrees, abs=1e-9) and d["geometry"]["coordinates"][0][0] == pytest.approx(degrees[:2], abs=1e-9) and len(d["geometry"]["coordinates"][0]) == 33
    p = d["properties"]
    assert (p["datetime"], p["proj:code"], p["proj:shape"], p["proj:transform"], p["odc:processing_datetime"], p["k"]) == ("2019-01-01T00:00:00Z", "EPSG:3857", [4, 2], [5, 0, 30, 0, -5, -60], "2020-01-01T00:00:00Z", "v")
    assert [x["rel"] for x in d["links"]] == ["product_overview", "self"] and d["links"][1]["href"].endswith("_2019--P1Y.stac-item.json") and d["assets"]["red"]["roles"] == ["data"]
    e = json.loads(sinks.dataset_documents(tasks, "gm", ["red"], "s3://b", grid, nodata={"red": -999}).first().document)
    assert e["id"] == d["id"] and e["grids"]["default"]["shape"] == [4, 2] and e["lineage"] == {"level3": ["s2", "s1"]} and e["measurements"]["red"]["nodata"] == -999
    assert e["properties"]["eo:gsd"] == "30" and e["properties"]["odc:file_format"] == "GeoTIFF" and e["accessories"]["checksum:sha1"]["path"].endswith(".sha1")
    i = json.loads(sinks.processing_documents(tasks, ["b", "a"], {"from": datetime(2019, 1, 1)}, [("own", "http://x", "1")]).first().document)
    assert i["input-products"] == ["a", "b"] and i["software_versions"][0]["version"] == "1" and "2019-01-01T00:00:00" in i["config"]


def test_queue_and_items(spark, tmp_path):
    tasks = spark.createDataFrame([("2019--P1Y", 1, 2)], "period string, x int, y int")
    streams.publish(tasks, "db", str(tmp_path / "q"))
    seen = []
    q = streams.run_stream(streams.task_stream(spark, str(tmp_path / "q")), lambda df, _: seen.extend(df.collect()), str(tmp_path / "c"))
    q.awaitTermination(60)
    assert [(r.period, r.x, r.y, r.filedb) for r in seen] == [("2019--P1Y", 1, 2, "db")]
    item = tmp_path / "x1" / "y2" / "a.stac-item.json"
    item.parent.mkdir(parents=True)
    item.write_text('{"id": "a", "collection": "p", "bbox": [0, 0, 1, 1], "properties": {"datetime": "2019-05-01T00:00:00Z"}, "assets": {"red": {"href": "r.tif"}}}')
    r = catalogue_items.read_items(spark, str(tmp_path), period=Period.parse("2019--P1Y")).collect()
    assert [(x.id, x["product"], x.measurements) for x in r] == [("a", "p", {"red": "r.tif"})]
    docs = sinks.item_documents(tasks.union(spark.createDataFrame([("p", -3, 104)], "period string, x int, y int")).withColumn("dataset_ids", F.array(F.lit("s"))), "prod", ["red"], "s3://b")
    sinks.write_documents(docs, str(tmp_path / "d"))
    assert {tuple(r) for r in sinks.existing(spark, str(tmp_path / "d")).collect()} == {("2019--P1Y", 1, 2), ("p", -3, 104)}
    (tmp_path / "conf.yaml").write_text('{"a": 1}')
    assert parsing.load_config(f"file://{tmp_path}/conf.yaml", spark) == {"a": 1}
    long = streams.run_stream(streams.task_stream(spark, str(tmp_path / "q")), lambda df, _: df.count(), str(tmp_path / "c2"), poll="1 second")
    assert streams.stopped_in_time(long, 2) is False and not long.isActive
    doc = docs.where("x = 1").first().document
    assert "x01y02" in doc and "prod_x01y02_2019--P1Y_red.tif" in doc


def test_polygons(spark):
    tasks = spark.createDataFrame([("p", x, y) for x in range(4) for y in range(4)], ["period", "x", "y"])
    area = tasks.sparkSession.createDataFrame([([[(0.5, 0.5), (1.5, 0.5), (1.5, 0.7), (0.5, 0.7), (0.5, 0.5)]],)], f"rings {polygons.RINGS}")
    hit = polygons.tiles_meeting(tasks, area, spatial.Grid((1.0, 1.0), 0.1))
    assert {(r.x, r.y) for r in hit.collect()} == {(0, 0), (1, 0)}


def test_regions_equal_all_pairs(spark):
    import random

    random.seed(3)
    box = lambda w: (lambda x, y: (x, y, x + random.uniform(0, w), y + random.uniform(0, w)))(random.uniform(-50, 50), random.uniform(-50, 50))
    grid, extent = [(f"x{i}y-{i}", *box(6)) for i in range(80)], [(i % 3, *box(25)) for i in range(12)]
    g = spark.createDataFrame(grid, "region_code string, min_x double, min_y double, max_x double, max_y double")
    e = spark.createDataFrame(extent, "kind int, min_x double, min_y double, max_x double, max_y double")
    found = spatial.regions_touched(g, e, "kind <> 1")
    meets = lambda a, b: a[1] <= b[3] and a[3] >= b[1] and a[2] <= b[4] and a[4] >= b[2]
    assert {r.region_code: r.numbers for r in found.collect()} == {a[0]: [a[0][1:].split("y")[0], a[0].split("y")[1]] for a in grid if any(b[0] != 1 and meets(a, b) for b in extent)}
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_holes_and_shape_files(spark, tmp_path):
    import struct

    hole = [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]]
    p = spark.createDataFrame([(5.0, 5.0), (2.0, 2.0), (20.0, 2.0)], "x double, y double")
    assert [r[0] for r in p.select(spatial.inside_polygons(F.col("x"), F.col("y"), [hole])).collect()] == [False, True, False]
    area = tmp_path / "a.geojson"
    area.write_text('{"features": [{"geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]], [[0.1, 0.1], [0.2, 0.1], [0.2, 0.2], [0.1, 0.1]]]]}}]}')
    assert [[len(r) for r in rings] for rings in catalogue_items.read_polygons(spark, str(area))] == [[4, 4]]
    record = lambda i, box: struct.pack(">II", i, 60) + struct.pack("<I4dII", 5, *box, 1, 4) + struct.pack("<I", 0) + struct.pack("<8d", *box, *box)
    record = lambda i, box, make=record: struct.pack(">II", i, (len(make(i, box)) - 8) // 2) + make(i, box)[8:]
    (tmp_path / "g.shp").write_bytes(b"\0" * 100 + record(1, (0, 0, 1, 1)) + struct.pack(">III", 2, 2, 0) + record(3, (8, 8, 9, 9)))
    field = lambda name, n: name.ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([n]) + b"\0" * 15
    rows = b"".join(b" " + a.ljust(8) + b.ljust(4) for a, b in ((b"x1y2", b"sea"), (b"x3y4", b""), (b"x5y6", b"land")))
    (tmp_path / "g.dbf").write_bytes(struct.pack("<4BIHH", 3, 0, 0, 0, 3, 32 + 64 + 1, 13) + b"\0" * 20 + field(b"region_code", 8) + field(b"kind", 4) + b"\r" + rows)
    assert sorted(tuple(r) for r in catalogue_items.read_shapes(spark, str(tmp_path / "g.shp")).collect()) == [(0, 0, 1, 1, "x1y2", "sea"), (8, 8, 9, 9, "x5y6", "land")]


def test_names_of_all_summaries():
    from chronocell.operators.summaries import REGISTRY, import_all

    assert len(import_all()) == len(REGISTRY) == 18


def test_longitudes(spark):
    at = lambda crs, x, y: spark.range(1).select(spatial.to_longitude(crs, F.lit(x), F.lit(y))).first()[0]
    assert at("EPSG:4326", 190.0, 0.0) == -170
    assert at("EPSG:6933", 17367530.45, 0.0) % 360 == pytest.approx(180, abs=1e-4)  # the grid's edge
    assert at("EPSG:3577", 0.0, -3e6) == pytest.approx(132, abs=1e-9)
    assert at("EPSG:3577", 1549000.0, -3960000.0) == pytest.approx(149.1, abs=0.3)  # Canberra
    with pytest.raises(ValueError):
        spatial.to_longitude("EPSG:1", F.lit(0.0), F.lit(0.0))


def test_local_time_and_finished_tasks_by_command(spark, tmp_path, capsys):
    """A scene at 150.5 east: 20 h UTC on the last of December is the next year there."""
    from chronocell import cli

    path = lambda name: str(tmp_path / name)
    s = spark.createDataFrame([scene("1", "p", datetime(2018, 12, 31, 20), "r", 150.5), scene("2", "p", datetime(2019, 6, 1), "r", 150.5), scene("3", "p", datetime(2019, 12, 31, 20), "r", 150.5), scene("4", "p", datetime(2019, 6, 1), "r", 0.5)], SCENES)
    s.write.parquet(path("scenes"))
    assert cli.main(["save-tasks", path("scenes"), path("out"), "--products", "p", "--temporal-range", "2019--P1Y"], spark) == 0
    tasks = spark.read.parquet(path("out/tasks"))
    assert {(r.period, r.x, tuple(r.dataset_ids)) for r in tasks.collect()} == {("2019--P1Y", 150, ("1", "2")), ("2019--P1Y", 0, ("4",))}
    px = spark.createDataFrame([("1", 150, 0, 0, 0, 1, "d1", 128), ("4", 0, 0, 0, 0, 1, "d1", 0)], ["dataset_id", "tile_x", "tile_y", "y", "x", "time", "solar_day", "water"])
    px.write.parquet(path("pixels"))
    run = ["run", path("out/tasks"), path("scenes"), path("pixels"), path("results"), "wofs-summary"]
    assert cli.main([*run, "2019--P1Y/0/0"], spark) == 0
    assert [(r.period, r.x, r.y) for r in sinks.finished(spark, path("results")).collect()] == [("2019--P1Y", 0, 0)]
    capsys.readouterr()
    assert cli.main([*run, "--dryrun"], spark) == 0
    assert {w for w in capsys.readouterr().out.replace("|", " ").split() if w in ("new", "skip", "recompute")} == {"new", "skip"}
    assert cli.main(run, spark) == 0 and cli.main(run, spark) == 0
    assert sorted((r.tile_x, r.count_wet) for r in spark.read.parquet(path("results")).collect()) == [(0, 0), (150, 1)]
    assert cli.main([*run, "2019--P1Y/0/0", "--overwrite", "--product", "w", "--location", "s3://b"], spark) == 0  # the other task's result stays
    assert sorted((r.tile_x, r.count_wet) for r in spark.read.parquet(path("results")).collect()) == [(0, 0), (150, 1)]
    assert [(r.x, r.collection) for r in spark.read.json(path("results/_documents")).select(F.col("properties.`odc:region_code`").alias("x"), "collection").collect()] == [("x00y00", "w")]
    assert cli.main([*run, "2020--P1Y/0/0"], spark) == 1 and "no task" in capsys.readouterr().err
    area = tmp_path / "area.geojson"
    area.write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[150.2, 0.2], [150.4, 0.2], [150.4, 0.4], [150.2, 0.2]]]}}]}')
    assert cli.main(["publish-tasks", path("out/tasks"), path("queue"), "--geojson-filter", str(area), "--dryrun"], spark) == 0
    assert capsys.readouterr().out.split() == ["2019--P1Y/+150/+000"]
    assert cli.main(["publish-tasks", path("out/tasks"), path("queue"), "0"], spark) == 0 and spark.read.json(path("queue")).count() == 1
    spark.createDataFrame([("x1y2", 0.0, 0.0, 1.0, 1.0), ("x5y6", 8.0, 8.0, 9.0, 9.0)], "region_code string, min_x double, min_y double, max_x double, max_y double").write.parquet(path("grid"))
    spark.createDataFrame([("sea", 0.5, 0.5, 0.6, 0.6), ("land", 8.5, 0.5, 8.6, 9.0)], "kind string, min_x double, min_y double, max_x double, max_y double").write.parquet(path("extent"))
    assert cli.main(["locate-grids", path("grid"), path("extent"), "--attr-filter", "kind <> 'sea'"], spark) == 0 and capsys.readouterr().out.strip() == '[["5", "6"]]'
    assert cli.main(["generate-mosaic", path("results"), path("mosaic"), "count_wet", "--factor", "2"], spark) == 0 and spark.read.parquet(path("mosaic")).count() == 2
    item = tmp_path / "items" / "x1" / "y2" / "a.stac-item.json"
    item.parent.mkdir(parents=True)
    item.write_text('{"id": "a", "collection": "p", "bbox": [0, 0, 1, 1], "properties": {"datetime": "2019-05-01T00:00:00Z"}, "assets": {}}')
    assert cli.main(["generate-cache", str(tmp_path / "items"), path("cache")], spark) == 0 and scene_store.source(spark, path("cache")).first().id == "a"
    assert cli.main(["save-tasks", path("scenes"), path("none")], spark) == 1 and cli.main(["save-tasks", path("scenes"), path("none"), "--products", "p", "--frequency", "rolling-3months"], spark) == 2
