"""What must not grow with one pixel or one image: heavy geomedians, quantile states, blocks of masks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronocell import catalogue_more
from chronocell.operators import fuse, geomedian, morphology, summaries


def test_heavy_pixels_are_solved_by_sums_over_all_tasks(spark):
    r = np.random.default_rng(8)
    rows = [("t", y, x, *map(float, v)) for (y, x), n in {(0, 0): 180, (0, 1): 7, (3, 9): 151, (9, 3): 1}.items() for v in r.integers(1, 400, (n, 2))]
    rows += [("t", 5, 5, 10.0, 20.0)] * 120 + [("t", 5, 5, 90.0, 10.0)] * 30  # most of them at one point
    rows += [("t", 0, 0, None, 3.0)] * 40 + [("t", 8, 8, None, 1.0)]
    df = spark.createDataFrame(rows, "period string, y long, x long, a double, b double")
    light = geomedian.geomedian_rows(df, ["a", "b"], ["period", "y", "x"], tolerance=1e-3, steps=60)
    mixed = geomedian.geomedian_rows(df, ["a", "b"], ["period", "y", "x"], heavy=100, tolerance=1e-3, steps=60)
    key = lambda q: (q.y, q.x)
    a, b = sorted(light.collect(), key=key), sorted(mixed.collect(), key=key)
    assert mixed.columns == light.columns and len(a) == len(b) == 6
    for p, q in zip(a, b, strict=True):
        assert p["count"] == q["count"] and np.allclose(p[3:8], q[3:8], rtol=1e-6, atol=1e-6, equal_nan=True)
    assert next((q.a, q.b) for q in b if q.y == 5) == pytest.approx((10.0, 20.0), abs=0.1)
    one = geomedian.geomedian_rows(df.select("period", "y", "x", "a"), ["a"], ["period", "y", "x"], heavy=100)
    assert {(q.y, q.x): q.a for q in one.collect() if q["count"]} == {(y, x): float(np.median([v[3] for v in rows if v[1:3] == (y, x) and v[3] is not None])) for y, x in ((0, 0), (0, 1), (3, 9), (9, 3), (5, 5))}


def test_medians_of_keys_that_fill_many_tasks(spark):
    r = np.random.default_rng(3)
    values = {"a": r.normal(size=401), "b": np.repeat(r.normal(size=3), 100), "c": r.normal(size=2)}
    df = spark.createDataFrame([(k, float(v), float(-v)) for k, vs in values.items() for v in vs], "k string, u double, v double")
    got = {q.k: (q.u, q.v, q.n) for q in geomedian.distributed_medians(df, ["k"], ["u", "v"], "n").collect()}
    assert got == {k: (pytest.approx(np.median(vs)), pytest.approx(-np.median(vs)), len(vs)) for k, vs in values.items()}


def test_blocks_of_a_geomedian_are_bounded(spark):
    df = spark.range(400).select((F.col("id") % 20).alias("y"), F.floor(F.col("id") / 20).alias("x"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    plan = geomedian.geomedian_rows(df, ["a", "b"], ["y", "x"])
    assert plan.count() == 400 and df.select(F.floor(F.col("y") / geomedian.BLOCK), F.floor(F.col("x") / geomedian.BLOCK)).distinct().count() == 9


@pytest.mark.parametrize("ps", [(0.1, 0.5, 0.9), (0.0, 0.25, 1.0), (0.33, 0.77)])
def test_nearest_ranks_without_lists(spark, ps):
    r = np.random.default_rng(6)
    groups = {n: r.integers(-300, 300, n) for n in range(1, 60)}
    df = spark.createDataFrame([(n, int(v)) for n, vs in groups.items() for v in vs] + [(3, None), (70, None)], "n int, v int")
    got = df.groupBy("n").agg(*[c.alias(f"q{i}") for i, c in enumerate(summaries.rank_quantiles("v", ps))])
    assert "collect_list" not in got._jdf.queryExecution().executedPlan().toString()
    want = {n: tuple(int(np.sort(vs)[int(np.rint((n - 1) * p))]) if n >= 3 else None for p in ps) for n, vs in groups.items()} | {70: (None,) * len(ps)}
    assert {q.n: tuple(q)[1:] for q in got.collect()} == want


def plain(mask, radius, grow):
    h, w = mask.shape
    out = np.zeros_like(mask)
    for i in range(h):
        for j in range(w):
            around = [mask[i + a, j + b] if 0 <= i + a < h and 0 <= j + b < w else not grow for a, b in morphology.disk(radius)]
            out[i, j] = any(around) if grow else all(around)
    return out


def test_dilation_by_runs_is_dilation_by_disks():
    r = np.random.default_rng(2)
    for radius in (1, 2, 5, 9):
        for shape in ((1, 1), (3, 20), (17, 13)):
            m = r.random(shape) < 0.1
            assert (morphology.dilate(m, radius) == plain(m, radius, True)).all()
            assert (morphology.erode(~m, radius) == plain(~m, radius, False)).all()


@pytest.mark.parametrize("block", [4, 7, 512])
def test_blocks_with_halos_equal_whole_images(spark, block):
    r = np.random.default_rng(9)
    steps = {"a": ("f", [("opening", 1), ("dilation", 2)]), "b": ("g", [("closing", 2)]), "c": ("f", [("erosion", 1)]), "d": ("g", [("dilation", 0)])}
    images = {("t", k): (r.random(shape) < 0.35, r.random(shape) < 0.1, r.random(shape) < 0.1) for k, shape in ((1, (23, 31)), (2, (5, 40)), (3, (1, 1)))}
    images["t", None] = (np.zeros((6, 6), bool), np.ones((6, 6), bool), np.zeros((6, 6), bool))
    rows = [(t, k, y - 8, x + 3, bool(f[y, x]) or None, bool(g[y, x]), f"{y}{x}") for (t, k), (f, g, gone) in images.items() for y in range(f.shape[0]) for x in range(f.shape[1]) if not gone[y, x]]
    df = spark.createDataFrame(rows + rows[:5], "tile string, time int, y int, x int, f boolean, g boolean, more string")
    got = morphology.cleanup_images(df, steps, ["tile", "time"], block=block)
    assert got.columns == [*df.columns, *steps] and got.count() == len(rows) + 5
    for (t, k), (f, g, gone) in images.items():
        own = [q for q in got.collect() if q.time == k]
        lo = [min(q[c] for q in own) for c in ("y", "x")]
        shape = [max(q[c] for q in own) - m + 1 for c, m in zip(("y", "x"), lo, strict=True)]
        mask = {"f": np.zeros(shape, bool), "g": np.zeros(shape, bool)}
        for q in own:
            for c in "fg":
                mask[c][q.y - lo[0], q.x - lo[1]] |= bool(q[c])
        for name, (flag, s) in steps.items():
            want = morphology.cleanup(mask[flag], s)
            assert all(q[name] == want[q.y - lo[0], q.x - lo[1]] for q in own), (k, name)
    assert morphology.cleanup_images(df.where("false"), steps, ["tile", "time"]).count() == 0


def test_a_stream_of_years_goes_on_after_a_restart(spark, tmp_path):
    from chronocell.streaming import tasks as streams

    r = np.random.default_rng(12)
    rows = [(y, x, int(r.integers(0, 9)) if r.random() > 0.2 else -999, int(r.integers(9, 20)) if r.random() > 0.2 else -999) for _ in range(5) for y in range(3) for x in range(4)]
    years = [rows[i : i + 12] for i in range(0, 60, 12)]
    read = lambda: spark.readStream.schema(streams.ANNUAL).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for part in (years[:3], years[3:4], years[4:]):  # the query ends after each and is started anew
        for y in part:
            spark.createDataFrame(y, streams.ANNUAL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        streams.fold_history(read(), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert len(list((tmp_path / "out").glob("batch=*"))) == 5
    got = streams.latest_history(spark, str(tmp_path / "out"))
    want = streams.full_history(spark.createDataFrame(rows, streams.ANNUAL))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_equal_times_are_settled_by_the_least_value(spark):
    rows = [(y, t, v) for y, t in ((0, 1), (1, 2)) for v in (None, 9, 4, 7)] + [(0, 2, 1), (1, None, 0), (2, 1, None), (3, None, 5)]
    want = {0: 4, 1: 4, 2: None, 3: None}
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "y int, time int, v int").coalesce(1)
        assert {q.y: q.v for q in df.groupBy("y").agg(fuse.first_valid("v")).collect()} == want


def test_a_batch_of_a_stream_has_a_file_a_core(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue_more, "folder", lambda *_: str(tmp_path / "source"))
    catalogue_more.as_stream(spark.range(100).toDF("id"))
    assert len(list((tmp_path / "source").glob("*.parquet"))) == 3 * spark.sparkContext.defaultParallelism
