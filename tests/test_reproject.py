"""Projections against published values and round trips; resampling against a lookup from every target pixel."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from chronocell.functions import projections
from chronocell.functions.projections import Albers, CylindricalEqualArea, Ellipsoid, TransverseMercator, number, projection
from chronocell.operators import polygons, reproject, spatial
from chronocell.operators.reproject import Raster
from chronocell.plans.tasks import run_tasks

CLARKE = Ellipsoid(6378206.4, 0.00676866)
value = lambda pair: duckdb.sql(f"SELECT {pair[0]}, {pair[1]}").fetchall()[0]


@pytest.mark.parametrize("of, lon, lat, x, y", [
    (TransverseMercator(-75.0, false=(0.0, 0.0), on=CLARKE), -73.5, 40.5, 127106.5, 4484124.4),
    (Albers((29.5, 45.5), (23.0, -96.0), CLARKE), -75.0, 35.0, 1885472.7, 1535925.0),
    (CylindricalEqualArea(5.0, -75.0, CLARKE), -78.0, 5.0, -332699.8, 554248.5),
])
def test_numerical_examples_of_the_textbook(of, lon, lat, x, y):
    assert value(of.forward(number(lon), number(lat))) == pytest.approx((x, y), abs=0.06)


@pytest.mark.parametrize("crs", ["EPSG:4326", "EPSG:3857", "EPSG:6933", "EPSG:3577", "EPSG:32755", "epsg:32601"])
def test_there_and_back(spark, crs):
    lon0 = {"EPSG:32755": 147, "epsg:32601": -177}.get(crs, 132)
    r = random.Random(2)
    south = -1 if crs != "epsg:32601" else 1
    rows = [(lon0 + r.uniform(-3, 3), south * r.uniform(1, 60)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a double, b double")
    x, y = projection(crs).forward("a", "b")
    df = df.withColumns({"x": F.expr(x), "y": F.expr(y)})
    back = reproject.geographic(df, crs, "x", "y").collect()
    assert all(abs(p.lon - p.a) < 1e-7 and abs(p.lat - p.b) < 2e-8 for p in back)
    if crs == "EPSG:32755":  # the central meridian, and symmetric about it
        assert value(projection(crs).forward("147e0", "0e0")) == pytest.approx((500000, 10000000), abs=1e-6)
        assert value(projection(crs).forward("148e0", "-30e0"))[0] - 500000 == pytest.approx(500000 - value(projection(crs).forward("146e0", "-30e0"))[0])


def test_unknown_systems():
    for crs in ("EPSG:1", "EPSG:32799", "x"):
        with pytest.raises(ValueError):
            projection(crs)
    assert projections.between("EPSG:4326", "epsg:4326", "x", "y") == ("x", "y")


SOURCE, TARGET = Raster("EPSG:32755", (500000.0, 6100000.0), (30.0, -30.0)), Raster("EPSG:4326", (147.0, -35.2), (0.0002, -0.00017))


@pytest.fixture(scope="module")
def scene(spark):
    r = random.Random(4)
    rows = [(k, y, x, r.randint(0, 500) if r.random() > 0.1 else None, "a" if r.random() > 0.5 else "b") for k in (1, 2) for y in range(18) for x in range(23) if r.random() > 0.15]
    return rows, spark.createDataFrame(rows, "k int, y long, x long, v int, name string")


def lookups(rows):
    """Centre of every target pixel around the scene, taken to the source."""
    corner = [value(projections.between(SOURCE.crs, TARGET.crs, *map(number, (SOURCE.origin[0] + 30 * x, SOURCE.origin[1] - 30 * y)))) for x in (0, 23) for y in (0, 18)]
    place = [((a - TARGET.origin[0]) / TARGET.step[0], (b - TARGET.origin[1]) / TARGET.step[1]) for a, b in corner]
    span = [range(math.floor(min(p[c] for p in place)) - 4, math.ceil(max(p[c] for p in place)) + 5) for c in (0, 1)]
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t AS SELECT i, j, {number(TARGET.origin[0])} + (i + 0.5) * {number(TARGET.step[0])} AS a, {number(TARGET.origin[1])} + (j + 0.5) * {number(TARGET.step[1])} AS b FROM range({span[0].start}, {span[0].stop}) AS r(i), range({span[1].start}, {span[1].stop}) AS s(j)")
    x, y = projections.between(TARGET.crs, SOURCE.crs, "a", "b")
    return con.execute(f"SELECT j, i, ({x} - {SOURCE.origin[0]}) / 30, ({SOURCE.origin[1]} - {y}) / 30 FROM t").fetchall()


def test_nearest_and_bilinear_are_lookups(scene):
    rows, df = scene
    at = {(k, y, x): (v, n) for k, y, x, v, n in rows}
    near, smooth = {}, {}
    for j, i, u, v in lookups(rows):
        for k in (1, 2):
            if (hit := at.get((k, math.floor(v), math.floor(u)))) is not None:
                near[k, j, i] = hit
            x0, y0 = math.floor(u - 0.5), math.floor(v - 0.5)
            parts = [(at[k, y0 + dy, x0 + dx][0], (1 - abs(u - x0 - dx - 0.5)) * (1 - abs(v - y0 - dy - 0.5))) for dy in (0, 1) for dx in (0, 1) if (k, y0 + dy, x0 + dx) in at]
            if parts:
                seen = [(p, w) for p, w in parts if p is not None]
                smooth[k, j, i] = sum(p * w for p, w in seen) / sum(w for _, w in seen) if seen else None
    got = reproject.reproject(df, SOURCE, TARGET, ["v", "name"], keys=["k"])
    assert got.schema["v"].dataType.simpleString() == "int" and {(r.k, r.y, r.x): (r.v, r.name) for r in got.collect()} == near and got.count() == len(near) > 300
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()  # nothing is shuffled or joined
    got = {(r.k, r.y, r.x): r.v for r in reproject.reproject(df, SOURCE, TARGET, ["v"], "bilinear", ["k"]).collect()}
    assert got.keys() == smooth.keys() and all((got[p] is None) == (v is None) and (v is None or got[p] == pytest.approx(v, abs=1e-6)) for p, v in smooth.items())


def test_average_and_other_methods(scene):
    rows, df = scene
    coarse = Raster("EPSG:32755", (500000.0, 6100000.0), (90.0, -90.0))
    got = {(r.k, r.y, r.x): r.v for r in reproject.reproject(df, SOURCE, coarse, ["v"], "average", ["k"]).collect()}
    want = {}
    for k, y, x, v, _ in rows:
        want.setdefault((k, y // 3, x // 3), []).extend([] if v is None else [v])
    assert got == {p: sum(v) / len(v) if v else None for p, v in want.items()}
    with pytest.raises(ValueError):
        reproject.reproject(df, SOURCE, coarse, ["v"], "cubic")
    assert reproject.reproject(df.where("false"), SOURCE, TARGET, ["v"], "bilinear").count() == 0


def test_tasks_load_what_was_taken_in_their_own_system(spark):
    grid = spatial.Grid((3000.0, 3000.0), 30.0, crs="EPSG:32755")
    raster = Raster.of(grid)
    native = spark.createDataFrame([("s", "EPSG:32755", -1, 0, 1, "d", 128), ("s", "epsg:32755", -100, 99, 1, "d", 0), ("s", "EPSG:32755", -101, 100, 1, "d", 0), ("other", "EPSG:32755", -1, 0, 1, "d", 128)], "dataset_id string, crs string, y long, x long, time int, solar_day string, water int")
    tasks = spark.createDataFrame([("p", 0, 0, ["s"]), ("p", 1, 1, ["s"])], "period string, x int, y int, dataset_ids array<string>")
    obs = reproject.load_native(tasks, native, {"EPSG:32755": raster}, grid, ["water"])
    assert sorted((r.tile_x, r.tile_y, r.y, r.x, r.water) for r in obs.collect()) == [(0, 0, 0, 99, 0), (0, 0, 99, 0, 128), (1, 1, 99, 0, 0)]  # the southernmost row is the last
    area = spark.createDataFrame([([[(0.0, 0.0), (300.0, 0.0), (300.0, 300.0), (0.0, 300.0)]],)], f"rings {polygons.RINGS}")
    out = run_tasks(spark, tasks, None, native, "wofs-summary", rasters={"EPSG:32755": raster}, grid=grid, area=area)
    assert [(r.tile_x, r.y, r.x, r.count_wet) for r in out.collect()] == [(0, 99, 0, 1)]


def test_outputs_follow_in_order_and_an_unfinished_task_comes_again(spark, tmp_path):
    import hashlib

    from chronocell import cli
    from chronocell.sources import sinks

    path = lambda name: str(tmp_path / name)
    spark.createDataFrame([("s", None)], "id string, center_time timestamp").write.parquet(path("scenes"))
    spark.createDataFrame([("2019--P1Y", x, -30, ["s"]) for x in (0, 1)], "period string, x int, y int, dataset_ids array<string>").write.parquet(path("tasks"))
    spark.createDataFrame([("s", x, -30, 0, 0, 1, "d", 128) for x in (0, 1)], "dataset_id string, tile_x int, tile_y int, y int, x int, time int, solar_day string, water int").write.parquet(path("pixels"))
    run = ["run", path("tasks"), path("scenes"), path("pixels"), path("out"), "wofs-summary"]
    options = ["--product", "w", "--location", "s3://b", "--grid", "96000,96000,32", "--crs", "EPSG:3577"]
    assert cli.main([*run, "2019--P1Y/0/-30"], spark) == 0  # bands without documents: as if the run had ended there
    assert sinks.existing(spark, path("out/_documents")).count() == 0
    assert cli.main([*run, *options], spark) == 0
    assert {tuple(r) for r in sinks.existing(spark, path("out/_documents")).collect()} == {("2019--P1Y", 0, -30), ("2019--P1Y", 1, -30)}
    assert sorted((r.tile_x, r.count_wet) for r in spark.read.parquet(path("out")).collect()) == [(0, 1), (1, 1)]  # nothing twice
    when = [max(p.stat().st_mtime_ns for p in (tmp_path / "out" / d).glob("part*")) for d in ("period=2019--P1Y/tile_x=1/tile_y=-30", "_sha1", "_processing", "_datasets", "_documents")]
    assert when == sorted(when)
    lines = {n: h for r in spark.read.json(path("out/_sha1")).collect() if r.x == 1 for h, n in [line.split("  ") for line in r.manifest.split("\n")]}
    assert len(lines) == 4 and {n.split(".", 1)[1] for n in lines if n.startswith("w_x01y-30_2019--P1Y.")} == {"proc-info.yaml", "odc-metadata.yaml", "stac-item.json"}
    for name, sha in lines.items():
        if name.endswith(".parquet"):
            assert hashlib.sha1((tmp_path / "out/period=2019--P1Y/tile_x=1/tile_y=-30" / name).read_bytes()).hexdigest() == sha
        if name.endswith("stac-item.json"):
            assert sha in {hashlib.sha1(r.value.encode()).hexdigest() for r in spark.read.text(path("out/_documents")).collect()}
    item = spark.read.json(path("out/_documents")).where("properties.`odc:region_code` = 'x00y-30'").first()
    assert len(item.geometry.coordinates[0]) == 33 and 131.9 < item.bbox[0] < 132.1 and -27 < item.bbox[1] < item.bbox[3] < -23 and item.properties["proj:code"] == "EPSG:3577"
    before = spark.read.text(path("out/_documents")).count()
    assert cli.main([*run, *options], spark) == 0 and spark.read.text(path("out/_documents")).count() == before  # all done
