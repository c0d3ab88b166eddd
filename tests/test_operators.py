"""Operators over images made here, against plain loops over the same arrays ([time][y][x])."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronocell.operators import geomedian, models, morphology, summaries
from chronocell.operators.summaries import execute

SIZE = (5, 6, 7)  # times, rows, columns
DAYS = ["d1", "d1", "d2", "d3", "d3"]
GROUPS = [[0, 1], [2], [3, 4]]  # times of each day


def made(seed, choices, size=SIZE):
    return np.random.default_rng(seed).choice(choices, size)


def rows(spark, days=DAYS, **bands):
    first = np.array(next(iter(bands.values())))
    data = [(t, days[t], y, x, *(int(np.array(b)[t][y][x]) for b in bands.values())) for t in range(first.shape[0]) for y in range(first.shape[1]) for x in range(first.shape[2])]
    return spark.createDataFrame(data, ["time", "solar_day", "y", "x", *bands])


def image(df, column):
    got = {(r.y, r.x): r[column] for r in df.collect()}
    return [[got[y, x] for x in range(max(k[1] for k in got) + 1)] for y in range(max(k[0] for k in got) + 1)]


def pixelwise(of, size=SIZE):
    return [[of(y, x) for x in range(size[2])] for y in range(size[1])]


def reach(mask, radius, outside=False):
    """Whether any cell within the radius is set; cells outside the image count as told."""
    h, w = mask.shape
    at = lambda y, x: mask[y, x] if 0 <= y < h and 0 <= x < w else outside
    near = [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if i * i + j * j <= radius * radius]
    return np.array([[any(at(y + i, x + j) for i, j in near) for x in range(w)] for y in range(h)])


def cleaned(mask, steps):
    """Steps by complement: what erosion keeps is what the complement's reach does not meet."""
    for name, r in steps:
        grow, shrink = (lambda m, r=r: reach(m, r)), (lambda m, r=r: ~reach(~m, r))
        mask = {"dilation": grow, "erosion": shrink, "opening": lambda m: grow(shrink(m)), "closing": lambda m: shrink(grow(m))}[name](mask)
    return mask


def test_water_summary(spark):
    w = made(1, [0, 128, 1, 2, 8, 136], SIZE)
    got = execute(rows(spark, water=w), summaries.WofsSummary()).cache()

    def of(y, x):
        wet = dry = bad = 0
        for times in GROUPS:
            v = [int(w[t, y, x]) for t in times]
            flags = [not i & 1 and bool(i & 127) for i in v]
            bad += any(flags)
            if not any(flags):
                wet += 128 in v and 0 not in v
                dry += 0 in v and 128 not in v
        some = wet + dry + bad > 0
        return (wet if some else -999, wet + dry if some else -999, wet / (wet + dry) if wet + dry else None)

    want = pixelwise(of)
    for i, c in enumerate(("count_wet", "count_clear", "frequency")):
        assert image(got, c) == [[p[i] for p in line] for line in want]


def test_cover_percentiles(spark):
    b, w, ue = made(2, range(0, 120)), made(3, [0, 0, 0, 128, 2, 16]), made(4, range(0, 60))
    s = summaries.CoverPercentiles(("cover",), ue_threshold=40, clip_range=(0, 100), count_valid=True)
    b[:, 0, 0] = 255
    got = execute(rows(spark, cover=b, water=w, ue=ue), s).cache()

    def of(y, x):
        values, valid_days, wet = [], 0, False
        for times in GROUPS:
            ok = [t for t in times if not w[t, y, x] & 239 and ue[t, y, x] < 40]
            v = [min(int(b[t, y, x]), 100) for t in ok if b[t, y, x] != 255]
            if v:
                values.append(int(np.floor(np.mean(v))))
            valid_days += bool(ok)
            wet |= not ok and any(w[t, y, x] & 239 == 128 for t in times)
        values.sort()
        pc = [values[int(np.rint(q * (len(values) - 1)))] if len(values) >= 3 else 255 for q in (0.1, 0.5, 0.9)]
        return (*pc, 2 if len(values) >= 3 else 0 if wet else 1, valid_days)

    want = pixelwise(of)
    for i, c in enumerate(("cover_pc_10", "cover_pc_50", "cover_pc_90", "qa", "count_valid")):
        assert image(got, c) == [[p[i] for p in line] for line in want]


EACH = ["a", "b", "c", "d", "e"]


@pytest.mark.parametrize("steps", [[], [("opening", 1), ("dilation", 1)], [("closing", 2), ("opening", 1)], [("erosion", 1), ("dilation", 2)]])
def test_quality_bits(spark, steps):
    qa, dust, thick = made(5, [0, 0, 0, 4, 8, 12, 1]), made(6, [0, 64, 128, 192, 200]), made(7, [0, 299, 301, 900, -9999])
    df = rows(spark, EACH, qa=qa, dust=dust, thick=thick)
    keeps, erased = qa & 1 == 0, qa & 12 != 0
    clean = np.stack([cleaned(m, steps) for m in erased])
    for more, dusty in (({"aerosol": "dust"}, dust >> 6 & 3 == 3), ({"opacity": "thick"}, (thick != -9999) & (thick * 0.001 > 0.3))):
        got = execute(df, summaries.PixelQualityBits({"f": steps} if steps else None, {"g": steps} if steps else None, **more)).cache()
        want = {"total": keeps, "clear": keeps & ~erased, "clear_aerosol": keeps & ~erased & ~dusty} | ({"f": keeps & ~clean, "g": keeps & ~clean & ~dusty} if steps else {})
        for c, flags in want.items():
            assert image(got, c) == flags.sum(0).tolist()


def test_cleanup_of_odd_rows(spark):
    """Two rows of one pixel, null flags and null longs."""
    df = spark.createDataFrame([("a", 0, 0, True, None), ("a", 0, 0, None, 5), ("a", 3, 3, False, (1 << 60) + 1), ("a", 3, 2, True, 7)], "time string, y int, x int, m boolean, v long")
    got = morphology.cleanup_images(df, {"wide": ("m", [("dilation", 1)])}, ["time"]).collect()
    assert sorted((r.y, r.x, r.wide, r.v) for r in got if r.v) == [(0, 0, True, 5), (3, 2, True, 7), (3, 3, True, (1 << 60) + 1)] and len(got) == 4


@pytest.mark.parametrize("steps", [None, [("closing", 2), ("dilation", 1)]])
def test_geomedian_bits(spark, steps):
    red, qa = made(8, range(0, 90)), made(9, [0, 0, 0, 4, 8, 1])
    got = geomedian.GeomedianBits(("red",), filters=steps, offset=-0.2, scale=0.00975, output_scale=100).run(rows(spark, EACH, red=red, qa=qa)).cache()
    cloud = np.stack([cleaned(m, steps or []) for m in qa & 12 != 0])

    def of(y, x):
        v = [float(red[t, y, x]) for t in range(SIZE[0]) if not qa[t, y, x] & 1 and red[t, y, x] > 0.2 / 0.00975 and not cloud[t, y, x]]
        m = np.median(v) if v else None
        return (int(np.rint(m * (0.00975 * 100) - 0.2 * 100)), int(np.rint(np.median(np.abs(np.array(v) - m)) * (0.00975 * 100))), len(v)) if v else (0, 0, 0)

    want = pixelwise(of)
    for i, c in enumerate(("red", "emad", "count")):
        assert image(got, c) == [[p[i] for p in line] for line in want]


def test_geomedian_is_the_minimum():
    rng = np.random.default_rng(1)
    x, valid = rng.normal(size=(40, 9, 4)), rng.random((40, 9)) < 0.7
    x[0, 1:4] = x[0, 0]  # a median on several observations
    valid[0], valid[1] = True, False
    m = geomedian.geomedians(np.where(valid[..., None], x, np.nan), valid)
    dev = geomedian.deviations(x, valid, m)
    assert np.isnan(m[1]).all() and np.isnan(dev[1]).all()
    for i in [0, *range(2, 40)]:
        own = x[i][valid[i]]
        cost = lambda p, own=own: np.linalg.norm(own - p, axis=1).sum()
        assert all(cost(m[i]) <= cost(m[i] + d) + 1e-6 for d in rng.normal(size=(50, 4)) * 1e-2)
        cosine = [1 - v @ m[i] / (np.linalg.norm(v) * np.linalg.norm(m[i])) for v in own]
        assert np.allclose(dev[i], [np.median(cosine), np.median(np.linalg.norm(own - m[i], axis=1)), np.median(np.abs(own - m[i]).sum(1) / np.abs(own + m[i]).sum(1))])


def test_geomedian_rows(spark):
    """Several bands, pixels with few and no observations, and two tiles, against the minimum of each pixel alone."""
    a, b, f = made(10, range(100, 4000)), made(11, range(100, 4000)), made(12, [0, 1, 1, 1, 2])
    f[:, 2, 2] = 0
    df = rows(spark, EACH, blue=a, red=b, fmask=f).withColumn("tile", F.col("x") % 2)
    got = {(r.y, r.x): r for r in geomedian.Geomedian(("blue", "red")).run(df, day=None, tile=["tile"]).collect()}
    assert len(got) == SIZE[1] * SIZE[2]
    for (y, x), r in got.items():
        own = np.array([(a[t, y, x], b[t, y, x]) for t in range(SIZE[0]) if f[t, y, x] == 1], float)
        assert r["count"] == len(own)
        if len(own):
            cost = lambda p, own=own: np.linalg.norm(own - p, axis=1).sum()
            steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
            assert all(cost((r.blue, r.red)) <= cost((r.blue + i, r.red + j)) + 1e-3 for i, j in steps)


def test_level3(spark):
    l1, urban, cult = made(13, [110, 124, 210, 221, 223, 255], (1, 6, 7)), made(14, [215, 216], (1, 6, 7)), made(15, [111, 112, 255, 255], (1, 6, 7))
    got = summaries.level3_classes(rows(spark, ["a"], classes_l3_l4=l1, urban_classes=urban, cultivated_class=cult))
    first = np.where(cult < 255, cult, l1)[0]
    assert image(got, "level3_class") == np.where(first == 210, urban[0], first).tolist()


def test_urban_votes(spark):
    v = made(16, [0, 1, 255], (2, 6, 7))
    df = rows(spark, ["a", "b"], prediction=v)
    for n in (1, 2):
        want = [[215 if 1 in s else 216 if 0 in s else 255 for x in range(7) for s in [set(v[:n, y, x])]] for y in range(6)]
        assert image(models.urban_vote(df.where(f"time < {n}"), ["y", "x"]), "class") == want


def test_tree_features(spark):
    b, g, r, n, s1, s2 = band = np.random.default_rng(17).uniform(20, 3000, 6)
    df = spark.createDataFrame([(*map(float, band), 0.02, 150.0, 0.3)], [*models.BANDS, "sdev", "edev", "bcdev"])
    got = models.tree_features(df).select(*models.FEATURES).first()
    b, g, r, n, s1, s2 = band / np.sqrt((band**2).sum())
    nd = lambda p, q: (p - q) / (p + q)
    wet = np.dot((b, g, r, n, s1, s2), (0.0315, 0.2021, 0.3102, 0.1594, -0.6806, -0.6109))  # fixed values, as published
    want = (b, g, s1, s2, 0.02, 0.015, 0.3, nd(g, s1), nd(s1, n) - nd(n, r), nd(s1 + r, n + b), wet, nd(n, s1), b + 2.5 * g - 1.5 * (n + s1) - 0.25 * s2, (r + 0.3) / (g + s1), nd(g, s1))
    assert np.allclose(got, want)


def test_a_worker_loads_a_model_once(spark, tmp_path):
    path = str(tmp_path / "loads")
    df = spark.range(400, numPartitions=8).select(F.col("id").cast("double").alias("b"))

    def load(path=path):
        import os

        with open(path, "a") as f:
            f.write(f"{os.getpid()}\n")
        return lambda x: x[:, 0]

    for _ in range(3):
        assert models.predict(df, ["b"], load, False).agg(F.sum("prediction")).first()[0] == sum(range(400))
    loads = open(path).read().split()
    assert len(loads) == len(set(loads)) <= 4
    twice = lambda: lambda x: x[:, 0] * 2  # noqa: E731  another model of the same name
    assert models.predict(df, ["b"], twice, False).agg(F.sum("prediction")).first()[0] == 2 * sum(range(400))


def test_longest_run(spark):
    data = [(0, m, v) for m, v in enumerate([1, 255, 1, 0, 1])] + [(1, m, 255) for m in range(3)] + [(2, 0, 0)]
    r = {x.p: x.run for x in summaries.longest_run(spark.createDataFrame(data, ["p", "month", "v"]), "v", ["p"]).collect()}
    assert r == {0: 2, 1: 255, 2: 0}


def test_morphology_forms_agree(spark):
    rng = np.random.default_rng(0)
    m = rng.random((9, 11)) < 0.15
    df = rows(spark, ["a"], m=m.astype(int)[None]).withColumn("m", F.col("m") == 1)
    assert image(morphology.dilate_rows(df, "m", 2, ["time"]), "dilated") == morphology.dilate(m, 2).tolist()
    assert image(morphology.cleanup_images(df, {"d": ("m", [("dilation", 2)])}, ["time"]), "d") == morphology.dilate(m, 2).tolist()


def test_registry():
    assert summaries.resolve("wofs-summary") is summaries.WofsSummary
    assert summaries.resolve("chronocell.operators.geomedian.GeomedianS2") is geomedian.GeomedianS2
    for bad in ("nothing", "json.JSONDecoder", "no.such.thing"):
        with pytest.raises(ValueError):
            summaries.resolve(bad)


def test_patch_and_tree_models(spark):
    df = rows(spark, ["a"], b=[[[1, 2], [3, 4]]]).withColumn("b", F.col("b").cast("double"))
    got = models.predict(df, ["b"], lambda: lambda x: x[:, 0] * 2, False, "twice")
    assert image(got, "prediction") == [[2.0, 4.0], [6.0, 8.0]]
    got = models.predict_patches(df, ["b"], lambda: lambda x: x[..., 0], ["time"], 4, "ones")
    assert image(got, "prediction") == [[1.0, 1.0], [1.0, 1.0]]


def test_every_listed_summary_resolves():
    import subprocess
    import sys
    from pathlib import Path

    names = "veg_class_l1 dem_in_stats mangroves lccs_level3 cultivated_class woody_cover urban_class gm-generic gm-s2 gm-ls gm-ls-bitmask".split()
    code = f"from chronocell.operators.summaries import resolve; [resolve(n) for n in {names}]"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parent.parent)  # nothing else imported


def scored(df, name, **config):
    return summaries.resolve(name)(**config).run(df, tile=["period"])


def test_land_cover_summaries(spark):
    columns = "period string, dataset_id string, time int, y int, x int, classes_l3_l4 int, urban_classes int, cultivated_class int"
    df = spark.createDataFrame([("p", d, 0, 0, x, *v) for x, bands in enumerate([(210, 216, 255), (110, 216, 111)]) for d, v in {"a": (bands[0], None, None), "b": (None, bands[1], bands[2])}.items()], columns)
    assert image(scored(df, "lccs_level3"), "level3_class") == [[216, 111]]
    dem = rows(spark, ["a"], dem_h=[[[5, -9999]]]).withColumn("period", F.lit("p"))
    assert image(scored(dem, "dem_in_stats", measurements=["height"]), "height") == [[5, None]]
    m = rows(spark, ["a"], pv_pc_10=[[[40, 40]]], qa=[[[2, 2]]], wet_pc_10=[[[0, 0]]]).withColumns({"period": F.lit("p"), "cx": F.col("x") + 0.5, "cy": F.col("y") + 0.5})
    assert image(scored(m, "mangroves", mangroves_extent=[[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]), "canopy_cover_class") == [[2, 255]]
    v = rows(spark, ["a"], veg_frequency=[[[3, 3]]], dem_h=[[[9, 9]]], blue=[[[1, 1]]], red=[[[1, 1]]], green=[[[1, 1]]], wet=[[[1, 0]]])
    v = v.withColumns({"period": F.lit("p"), "frequency": F.col("wet").cast("double")})
    assert image(scored(v, "veg_class_l1"), "classes_l3_l4") == [[221, 110]]


def test_model_summaries_vote_over_images(spark):
    """Pixels 0 and 1 have two images, pixel 2 one; the mask is a scene of its own and leaves out pixel 3."""
    bands = (*models.BANDS, "sdev", "edev", "bcdev")
    values = {"a": {0: 10, 1: 30, 3: 10}, "b": {0: 30, 1: 50, 2: 30, 3: 10}}
    data = [("p", d, 0, 0, x, None, *[float(v)] * 9) for d, of in values.items() for x, v in of.items()]
    data += [("p", "mask", 0, 0, x, 110 if x < 3 else 210, *[None] * 9) for x in range(4)]
    df = spark.createDataFrame(data, "period string, dataset_id string, time int, y int, x int, classes_l3_l4 int, " + ", ".join(f"{b} double" for b in bands))
    assert image(scored(df, "woody_cover", load=lambda: lambda f: f[:, 0]), "woody_cover") == [[114, 113, 113, 255]]
    two = lambda f: np.stack([f[:, 4] < 25, f[:, 4] >= 25], 1).astype(float)  # sdev; class 0 is cultivated
    assert image(scored(df, "cultivated_class", load=lambda: two), "cultivated_class") == [[111, 112, 112, 255]]
    seen = df.where("dataset_id <> 'mask'").withColumns({"red": F.when(F.col("blue") > 20, 0.0).otherwise(F.col("red"))})
    got = scored(seen, "urban_class", load=lambda: lambda f: (f[..., 2] > 0.1).astype(float), crop_size=4)
    assert image(got, "urban_classes") == [[215, 216, 216, 215]]
    holes = seen.where("not (dataset_id = 'b' and x = 0)")  # either image lacks a pixel, which the other fills
    got = scored(holes, "urban_class", load=lambda: lambda f: np.full(f.shape[:2], float((f[..., 0] > 0).all())), crop_size=4)
    assert image(got, "urban_classes") == [[215] * 4]
