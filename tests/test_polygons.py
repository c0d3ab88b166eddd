"""Polygon joins against loops over all pairs of edges, and polygons from files."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from chronocell.operators import polygons, spatial
from chronocell.sources import catalogue_items

KIND = f"id int, rings {polygons.RINGS}"


def star(r, cx, cy, size, points):
    turn = sorted(r.uniform(0, 2 * math.pi) for _ in range(points))
    return [(cx + math.cos(a) * s, cy + math.sin(a) * s) for a in turn for s in [r.uniform(0.3, 1) * size]]


def outline(r, i):
    """Stars, some with a hole of a quarter of their size, some of two parts, some on whole numbers so that borders touch."""
    cx, cy, size = r.uniform(-40, 40), r.uniform(-40, 40), r.choice((1, 4, 15))
    if i % 4 == 0:
        x, y, w = round(cx), round(cy), max(1, round(size))
        return [[(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]]
    rings = [star(r, cx, cy, size, r.randint(3, 9))]
    if i % 4 == 1:
        rings.append([(cx + (x - cx) / 4, cy + (y - cy) / 4) for x, y in rings[0]])
    if i % 4 == 2:
        rings.append(star(r, cx + 3 * size, cy, size, 5))
    return rings


def pairs(rings):
    return [(a, b) for ring in rings if len(ring) > 2 for a, b in zip(ring, ring[1:] + ring[:1], strict=True) if a != b]


def within(p, rings):
    odd = False
    for (x0, y0), (x1, y1) in pairs(rings):
        if (y0 > p[1]) != (y1 > p[1]) and p[0] < x0 + (p[1] - y0) * (x1 - x0) / (y1 - y0):
            odd = not odd
    return odd


def crossing(a, b, c, d):
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    sign = lambda v: (v > 0) - (v < 0)
    near = all(max(p[i] for p in s) >= min(p[i] for p in t) for s, t in (((a, b), (c, d)), ((c, d), (a, b))) for i in (0, 1))
    return near and sign(turn(a, b, c)) * sign(turn(a, b, d)) <= 0 and sign(turn(c, d, a)) * sign(turn(c, d, b)) <= 0


def meet(a, b):
    return any(crossing(*s, *t) for s in pairs(a) for t in pairs(b)) or any(within(p, b) for r in a for p in r) or any(within(p, a) for r in b for p in r)


@pytest.fixture(scope="module")
def both(spark):
    r = random.Random(7)
    a, b = ([(i, outline(r, i)) for i in range(60)] for _ in range(2))
    frame = lambda rows: spark.createDataFrame([(i, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for i, rings in rows], KIND)
    return a, b, frame(a), frame(b).withColumnRenamed("id", "of")


@pytest.mark.parametrize("cell", [1.5, 500.0])
def test_pairs_that_meet(both, cell):
    a, b, left, right = both
    want = {(i, j) for i, p in a for j, q in b if meet(p, q)}
    assert 20 < len(want) < 2000
    found = polygons.meeting(left, right, ["id"], ["of"], polygons.Cells(cell, cell))
    assert sorted(map(tuple, found.collect())) == sorted(want)
    few = right.where("of % 7 = 3")
    assert {r.id for r in polygons.touched(left, few, ["id"], polygons.Cells(cell, cell * 2)).collect()} == {i for i, j in want if j % 7 == 3}


def test_pairs_do_not_meet_by_loops(both):
    _, _, left, right = both
    for df in (polygons.meeting(left, right, ["id"], ["of"], polygons.Cells(4.0, 4.0)), polygons.touched(left, right, ["id"], polygons.Cells(4.0, 4.0))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError, match="keys"):
        polygons.meeting(left, left, ["id"], ["id"], polygons.Cells(1.0, 1.0))


@pytest.mark.parametrize("cell", [2.0, 11.0])
def test_points(spark, both, cell):
    a, _, left, _ = both
    r = random.Random(1)
    points = [(k, r.uniform(-60, 60), r.uniform(-60, 60)) for k in range(400)] + [(1000 + k, float(r.randint(-45, 45)), float(r.randint(-45, 45))) for k in range(200)]
    found = polygons.points_within(spark.createDataFrame(points, "k int, px double, py double"), "px", "py", left, ["id"], polygons.Cells(cell, cell, 0.25))
    assert sorted((r.k, r.id) for r in found.collect()) == sorted((k, i) for k, x, y in points for i, rings in a if within((x, y), rings))


def test_tiles(spark, both):
    a, _, left, _ = both
    grid = spatial.Grid((4.0, 3.0), 1.0, (1.0, -2.0))
    tile = lambda i, j: [[(1 + 4 * i, -2 + 3 * j), (5 + 4 * i, -2 + 3 * j), (5 + 4 * i, 1 + 3 * j), (1 + 4 * i, 1 + 3 * j)]]
    span = lambda rings, c, o, w: range(*(math.floor((f(p[c] for r in rings for p in r) - o) / w) + d for f, d in ((min, -1), (max, 2))))
    closed = {(k, i, j) for k, rings in a for i in span(rings, 0, 1, 4) for j in span(rings, 1, -2, 3) if meet(rings, tile(i, j))}
    assert {tuple(r) for r in polygons.polygon_tiles(left, ["id"], grid, touching=True).collect()} == closed
    overlap = {tuple(r) for r in polygons.polygon_tiles(left, ["id"], grid).collect()}
    assert overlap < closed
    for k, i, j in closed - overlap:  # only a border is shared: whole numbers
        assert k % 4 == 0
    task = spark.createDataFrame([("p", i, j) for i in range(-5, 6) for j in range(-6, 6)], "period string, x int, y int")
    few = left.where("id % 5 = 2")
    assert {(r.x, r.y) for r in polygons.tiles_meeting(task, few, grid).collect()} == {(i, j) for k, i, j in closed if k % 5 == 2 and -5 <= i < 6 and -6 <= j < 6}


def test_an_area_costs_its_outline(spark):
    """A square of 4 million cells has about 8000 cells with edges, and its inside comes in blocks."""
    one = spark.createDataFrame([(1, [[(0.5, 0.5), (2000.5, 0.5), (2000.5, 2000.5), (0.5, 2000.5)]])], KIND)
    cover = polygons.cover(one, ["id"], polygons.Cells(1.0, 1.0))
    assert cover.count() < 8100 and polygons.blocks(cover, ["id"]).count() < 2000 * 40
    assert polygons.blocks(cover, ["id"]).agg(F.sum(F.expr("power(8, _l)"))).first()[0] == 1999 * 1999


def test_empty_and_odd_polygons(spark):
    rows = [(1, None), (2, []), (3, [[(0.0, 0.0), (1.0, 1.0)]]), (4, [[(0.0, 0.0), (4.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)]])]
    df = spark.createDataFrame(rows, KIND)
    assert {r.id for r in polygons.polygon_tiles(df, ["id"], spatial.Grid((1.0, 1.0), 1.0)).collect()} == {4}
    assert polygons.meeting(df, df.where("false").withColumnRenamed("id", "of"), ["id"], ["of"], polygons.Cells(1.0, 1.0)).count() == 0
    null = spark.createDataFrame([(9, 0.5, 0.2), (8, None, 1.0)], "k int, px double, py double")
    assert [(r.k, r.id) for r in polygons.points_within(null, "px", "py", df, ["id"], polygons.Cells(1.0, 1.0)).collect()] == [(9, 4)]


def shape_file(path, polygons_, attributes):
    body = b""
    for i, rings in enumerate(polygons_):
        points = [p for r in rings for p in r]
        starts = [sum(len(r) for r in rings[:k]) for k in range(len(rings))]
        box = (min(p[0] for p in points), min(p[1] for p in points), max(p[0] for p in points), max(p[1] for p in points))
        content = struct.pack("<I4dII", 5, *box, len(rings), len(points)) + struct.pack(f"<{len(starts)}I", *starts) + b"".join(struct.pack("<2d", *p) for p in points)
        body += struct.pack(">II", i + 1, len(content) // 2) + content
    path.with_suffix(".shp").write_bytes(b"\0" * 100 + body)
    field = b"region_code" + b"C" + b"\0" * 4 + bytes([8]) + b"\0" * 15
    path.with_suffix(".dbf").write_bytes(struct.pack("<4BIHH", 3, 0, 0, 0, len(attributes), 65, 9) + b"\0" * 20 + field + b"\r" + b"".join(b" " + a.ljust(8) for a in attributes))


def test_shape_files_meet_by_outline(spark, tmp_path, capsys):
    from chronocell import cli

    square = lambda x, y, w: [(x, y), (x, y + w), (x + w, y + w), (x + w, y), (x, y)]
    shape_file(tmp_path / "grid", [[square(4.0, 4.0, 1.0)], [square(1.0, 1.0, 1.0)], [square(20.0, 0.0, 1.0)], [square(30.0, 0.0, 1.0)]], [b"x4y4", b"x1y1", b"x20y0", b"x30y0"])
    shape_file(tmp_path / "area", [[square(0.0, 0.0, 10.0), square(3.0, 3.0, 4.0)[::-1], square(30.2, 0.2, 0.1)]], [b"sea"])
    area = catalogue_items.read_shapes(spark, str(tmp_path / "area.shp"), outlines=True).first()
    assert [len(r) for r in area.rings] == [5, 5, 5] and area.region_code == "sea"
    assert cli.main(["locate-grids", str(tmp_path / "grid.shp"), str(tmp_path / "area.shp")], spark) == 0
    assert capsys.readouterr().out.strip() == '[["1", "1"], ["30", "0"]]'  # one lies in the hole, one in another part


def test_tasks_of_all_parts_without_holes(spark, tmp_path, capsys):
    from chronocell import cli

    spark.createDataFrame([("p", x, 0, ["s"]) for x in range(12)], "period string, x int, y int, dataset_ids array<string>").write.parquet(str(tmp_path / "t"))
    (tmp_path / "a.geojson").write_text('{"features": [{"geometry": {"type": "MultiPolygon", "coordinates": [[[[0.5, -5], [5.5, -5], [5.5, 5], [0.5, 5]], [[1.8, -1], [4.2, -1], [4.2, 2], [1.8, 2]]], [[[8.2, 0.2], [8.4, 0.2], [8.4, 0.4]]]]}}, {"geometry": {"type": "Polygon", "coordinates": [[[10.2, 0.2], [10.4, 0.2], [10.4, 0.4]]]}}]}')
    command = lambda *chosen: ["publish-tasks", str(tmp_path / "t"), str(tmp_path / "q"), *chosen, "--geojson-filter", str(tmp_path / "a.geojson"), "--dryrun"]
    assert cli.main(command(), spark) == 0
    assert capsys.readouterr().out.split() == [f"p/{x:+04d}/+000" for x in (0, 1, 4, 5, 8)]  # of the first feature
    assert cli.main(command("8", "p/1/0", "8", "2:6"), spark) == 0
    assert capsys.readouterr().out.split() == [f"p/{x:+04d}/+000" for x in (8, 1, 8, 4, 5)]  # as chosen, repeats kept


def test_footprints_of_items(spark, tmp_path):
    item = '{{"id": "{}", "collection": "p", "bbox": [0, 0, 4, 4], {}"properties": {{"datetime": "2019-05-01T00:00:00Z"}}, "assets": {{}}}}'
    (tmp_path / "a.stac-item.json").write_text(item.format("a", '"geometry": {"type": "Polygon", "coordinates": [[[0.2, 0.2], [3.8, 3.8], [0.2, 3.8]]]}, '))
    (tmp_path / "b.stac-item.json").write_text(item.format("b", ""))
    tiles = spatial.to_tiles(catalogue_items.read_items(spark, str(tmp_path)), spatial.Grid((1.0, 1.0), 0.1))
    of = lambda i: {(r.x, r.y) for r in tiles.collect() if r.id == i}
    assert of("a") == {(x, y) for x in range(4) for y in range(4) if x <= y} and len(of("b")) == 16  # without a geometry, the box


def test_covers_never_go_through_the_driver_and_repeats_meet_once(spark, tmp_path):
    box = lambda x, y, w: [[(x, y), (x + w, y), (x + w, y + w), (x, y + w)]]
    a = [(1, box(0.0, 0.0, 9.0)), (2, box(0.0, 0.0, 9.0)), (3, box(50.0, 0.0, 1.0)), (4, None), (5, []), (1, box(2.0, 2.0, 3.0))]
    b = [(7, box(4.0, 4.0, 1.0)), (8, box(4.0, 4.0, 1.0)), (8, box(4.0, 4.0, 1.0)), (9, box(200.0, 0.0, 1.0)), (None, box(4.0, 4.0, 1.0))]
    for k, rows in (("p", a), ("q", b)):  # files, as only their sizes are estimated as small
        spark.createDataFrame(rows, f"{k} int, rings {polygons.RINGS}").write.parquet(str(tmp_path / k))
    a, b = (spark.read.parquet(str(tmp_path / k)) for k in "pq")
    pairs, hit = polygons.meeting(a, b, ["p"], ["q"], polygons.Cells(2.0, 2.0)), polygons.touched(a, b, ["p"], polygons.Cells(2.0, 2.0))
    assert sorted(map(str, pairs.collect())) == sorted(f"Row(p={p}, q={q})" for p in (1, 2) for q in (7, 8, None))
    assert sorted(q.p for q in hit.collect()) == [1, 2]
    points = spark.createDataFrame([(4.5, 4.5)], "x double, y double")
    for df in (pairs, hit, polygons.points_within(points, "x", "y", b, ["q"], polygons.Cells(2.0, 2.0))):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
