"""Stores of scenes, pixels and items, and tasks planned from a stream."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chronocell.functions.periods import Period, period_end
from chronocell.operators import planner
from chronocell.plans.tasks import run_tasks
from chronocell.sources import catalogue_store, scene_store
from chronocell.streaming import tasks as streams

SCENES = "id long, product string, center_time timestamp, region_code string"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grouping_by_time_and_region_needs_no_shuffle(spark, tmp_path, no_broadcast):
    rows = [(i, "ab"[i % 2], datetime(2019, 1, 1 + i // 2 % 9), f"r{i % 7}") for i in range(200)] + [(900, "a", None, None), (901, "b", None, None)]
    s = spark.createDataFrame(rows, SCENES)
    stored = scene_store.write_scenes(s, "kept_scenes", 5, str(tmp_path / "scenes"))
    assert len([f for f in os.listdir(tmp_path / "scenes") if f.endswith(".parquet")]) <= 5

    def fused(scenes):
        groups = planner.fuse_join(scenes, 1)
        return scenes.join(groups.select(*planner.KEY), list(planner.KEY), "left_semi")

    assert "Exchange" in plan(fused(s)) and "Exchange" not in plan(fused(stored))
    assert sorted(map(repr, fused(stored).collect())) == sorted(map(repr, fused(s).collect())) and fused(s).count() > 0
    got = [(r.center_time, r.region_code, r.id) for r in scene_store.in_order(stored).collect()]
    assert got == sorted(got, key=lambda v: (v[0] is None, v[0] or datetime.max, v[1] is None, v[1] or "", v[2])) and len(got) == 202
    assert [r.id for r in scene_store.in_order(s.where("id < 3").drop("region_code")).collect()] == [0, 1, 2]
    assert scene_store.write_scenes(s.limit(0), "kept_scenes", 5, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        scene_store.write_scenes(s, "kept_scenes", 0)


def test_pixels_in_buckets_are_not_shuffled(spark, tmp_path, no_broadcast):
    px = spark.createDataFrame([(i % 3, 0, f"s{i % 4}", i % 5, i % 2, "d1", 128 * (i % 2)) for i in range(60)], "tile_x int, tile_y int, dataset_id string, y int, x int, solar_day string, water int")
    tasks = spark.createDataFrame([("p", x, 0, ["s0", "s2", "s3"]) for x in range(2)], "period string, x int, y int, dataset_ids array<string>")
    stored = scene_store.write_pixels(px, "kept_pixels", 4, str(tmp_path / "px"))
    chosen = tasks.select(F.col("x").alias("tile_x"), F.col("y").alias("tile_y"), F.explode("dataset_ids").alias("dataset_id"))
    joined = plan(stored.join(chosen, list(scene_store.PIXELS)))
    assert joined.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in joined
    run = lambda p: sorted(map(repr, run_tasks(spark, tasks, None, p, "wofs-summary").collect()))
    assert run(stored) == run(px) and len(run(px)) > 0
    assert scene_store.source(spark, "table:kept_pixels").count() == 60


def put(root, name, uid, at, product="p", text=None):
    root.mkdir(exist_ok=True, parents=True)
    f = root / f"{name}.stac-item.json"
    f.write_text(text if text is not None else json.dumps({"id": uid, "collection": product, "bbox": [0, 0, 1, 1], "properties": {"datetime": "2019-05-01T00:00:00Z"}, "assets": {"red": {"href": "r.tif"}}}, indent=1))
    os.utime(f, (at, at))
    return f


def test_a_catalogue_reads_what_is_new_or_changed(spark, tmp_path):
    from chronocell.sources import catalogue_items

    items, store = tmp_path / "items", str(tmp_path / "store")
    update = lambda: catalogue_store.refresh(spark, str(items), store)
    now = lambda: sorted((r.id, r["product"], r.measurements["red"]) for r in catalogue_store.scenes(spark, store).collect())
    for i in range(4):
        put(items / f"x{i}", "a", f"i{i}", 1_600_000_000 + i)
    with pytest.raises(ValueError):
        catalogue_store.scenes(spark, store)
    assert update() == (4, 0) and now() == [(f"i{i}", "p", "r.tif") for i in range(4)]
    assert sorted(map(repr, catalogue_store.scenes(spark, store).collect())) == sorted(map(repr, catalogue_items.read_items(spark, str(items)).collect()))
    assert update() == (0, 0) and catalogue_store.batches(spark, store) == [0]
    put(items / "x0", "new", "i9", 1_700_000_000)
    put(items / "x1", "a", "i1", 1_700_000_001, product="q")  # changed
    put(items / "x2", "late", "i8", 1_500_000_000)  # older than all that is known
    put(items / "x2", "bad", "", 1_700_000_002, text="{no json")
    put(items / "x2", "empty", "", 1_700_000_003, text="")  # an empty file counts as none
    (items / "x3" / "a.stac-item.json").unlink()
    assert update() == (4, 1) and now() == [("i0", "p", "r.tif"), ("i1", "q", "r.tif"), ("i2", "p", "r.tif"), ("i8", "p", "r.tif"), ("i9", "p", "r.tif")]
    assert update() == (0, 0)
    put(items / "x5", "copy", "i1", 1_700_000_009, product="z")  # one id in two files: the newer
    os.makedirs(f"{store}/batch=2")  # a refresh that was stopped
    (tmp_path / "store" / "batch=2" / "part.parquet").write_text("half")
    assert update() == (1, 0) and ("i1", "z", "r.tif") in now() and len(now()) == 5
    put(items / "x3", "a", "i3", 1_600_000_003)  # back as it was
    assert update() == (1, 0) and len(now()) == 6


def test_only_new_files_are_opened(spark, tmp_path):
    """A known file that can no longer be parsed, at its old time and length, is not read again."""
    items, store = tmp_path / "items", str(tmp_path / "store")
    f = put(items, "a", "i0", 1_600_000_000)
    catalogue_store.refresh(spark, str(items), store)
    f.write_text("x" * f.stat().st_size)
    os.utime(f, (1_600_000_000, 1_600_000_000))
    put(items, "b", "i1", 1_600_000_100)
    assert catalogue_store.refresh(spark, str(items), store) == (1, 0)
    assert sorted(r.id for r in catalogue_store.scenes(spark, store).collect()) == ["i0", "i1"]


def test_a_file_has_an_item_a_line(spark, tmp_path):
    items, store = tmp_path / "items", str(tmp_path / "store")
    update = lambda: catalogue_store.refresh(spark, str(items), store, lines=True)
    now = lambda: sorted((r.id, r["product"]) for r in catalogue_store.scenes(spark, store).collect())
    text = lambda *ids: "\n".join(json.dumps({"id": i, "collection": p}) for i, p in ids)
    put(items, "a", "", 1_600_000_000, text=text(("i0", "p"), ("i1", "p"), ("i1", "q")) + "\r\n \n{no json\n")
    put(items, "b", "", 1_600_000_001, text="\n\n" + text(("i2", "p"), ("i3", "p")))
    put(items, "none", "", 1_600_000_002, text=" \n\n")
    assert update() == (3, 0) and now() == [("i0", "p"), ("i1", "q"), ("i2", "p"), ("i3", "p")]
    assert update() == (0, 0)
    put(items, "b", "", 1_700_000_000, text=text(("i3", "z"), ("i4", "p")))  # i2 is gone from its file
    put(items, "c", "", 1_700_000_001, text=text(("i0", "z")))
    assert update() == (2, 0) and now() == [("i0", "z"), ("i1", "q"), ("i3", "z"), ("i4", "p")]
    (items / "a.stac-item.json").unlink()
    assert update() == (0, 1) and now() == [("i0", "z"), ("i3", "z"), ("i4", "p")]
    store, before = str(tmp_path / "before"), spark.read.parquet(f"{store}/batch=1").where("id <> 'i3'").drop("line")
    before.write.parquet(f"{store}/batch=0")  # of a release that knew no lines
    assert now() == [("i0", "z"), ("i4", "p")]
    put(items, "b", "", 1_700_000_002, text=text(("i5", "p"), ("i6", "p")))
    assert update() == (2, 0) and now() == [("i0", "z"), ("i5", "p"), ("i6", "p")]  # b, and the file without items, which batch 1 does not have


def test_files_of_the_catalogue_do_not_grow_with_the_regions(spark, tmp_path, monkeypatch):
    from chronocell import catalogue_more

    made = lambda _, kind: str(tmp_path / kind)
    monkeypatch.setattr(catalogue_more, "folder", made)
    events = spark.range(400).selectExpr("id AS event_id", "'p' AS event_type", "timestamp'2019-05-01' AS ts", "id % 150 AS user_id")
    events.write.parquet(str(tmp_path / "events.parquet"))
    out = catalogue_more.catalogue_of_items(spark, str(tmp_path)).collect()
    assert sorted(r.id for r in out) == sorted([f"{i}/{i}" for i in range(150)] + [f"{i}/{i + (300 if i < 100 else 150)}" for i in range(150)])
    assert len(list((tmp_path / "items").rglob("*.txt"))) <= 2 * 4


@pytest.mark.parametrize("text", ["2019--P1Y", "2019-12--P3M", "2019-01-05--P10D", "2020-02--P1M", "2019-07--P12M", "2020--P3Y"])
def test_ends_of_periods(spark, text):
    import datetime as dt

    got = spark.createDataFrame([(text,)], ["p"]).select(period_end("p")).first()[0]
    assert got == Period.parse(text).end + dt.timedelta(microseconds=1)


def test_ends_of_other_texts(spark):
    assert [r[0] for r in spark.createDataFrame([("x",), ("2019-13--P1M",), (None,), ("",)], "p string").select(period_end("p")).collect()] == [None] * 4


def test_tasks_close_once_and_late_scenes_are_left_out(spark, tmp_path):
    kind = "period string, x int, y int, id string, center_time timestamp, utc_offset double"
    path = lambda n: str(tmp_path / n)
    month = lambda m, day, uid: (f"2019-{m:02d}--P1M", 0, 0, uid, datetime(2019, m, day), 0.0)
    parts = [
        [month(1, 3, "a"), month(1, 9, "b"), month(1, 9, "b"), month(1, 9, None)],
        [month(2, 3, "c"), month(1, 20, "late but in time")],
        [month(4, 3, "d")],  # January and February close
        [month(1, 30, "too late"), month(4, 4, "e")],
        [month(9, 1, "f")],
    ]
    out = []
    for i, part in enumerate(parts):  # a query that is started anew each time
        spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(path("in"))
        s = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(path("in"))
        q = streams.arriving_tasks(s, "20 days").writeStream.outputMode("append").foreachBatch(lambda df, _, i=i: out.extend((i, r.period, tuple(r.dataset_ids), r.days) for r in df.collect()))
        q.option("checkpointLocation", path("state")).trigger(availableNow=True).start().awaitTermination()
    assert [(p, ids, days) for _, p, ids, days in sorted(out)] == [("2019-01--P1M", ("a", "b", "late but in time"), 3), ("2019-02--P1M", ("c",), 1), ("2019-04--P1M", ("d", "e"), 2)]
    batch = streams.arriving_tasks(spark.createDataFrame(parts[0], kind)).collect()
    assert [(r.period, r.dataset_ids, r.days, r.closes) for r in batch] == [("2019-01--P1M", ["a", "b"], 2, datetime(2019, 2, 1))]


def test_running_windows_equal_the_batch(spark, tmp_path):
    rows = [(i, "ab"[i % 2], datetime(2019, 1, 1 + i % 20), "r") for i in range(90)]
    for part in (rows[:40], rows[40:]):
        spark.createDataFrame(part, SCENES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        s = spark.readStream.schema(SCENES).parquet(str(tmp_path / "in"))
        streams.running(streams.scene_windows(s, late="30 days").select(F.col("window.start").alias("start"), "product", "scenes"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    want = streams.scene_windows(spark.createDataFrame(rows, SCENES)).select(F.col("window.start").alias("start"), "product", "scenes")
    assert sorted(map(repr, streams.latest(spark, str(tmp_path / "out"), ["start", "product"]).collect())) == sorted(map(repr, want.collect()))
