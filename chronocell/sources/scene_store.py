"""Scenes and pixels kept in buckets of their keys, so that grouping scenes and fetching a task's pixels need no shuffle of them.

A store is a table of the session's catalogue. Its buckets are chosen once (128 MB each is a good size, as a task reads whole
buckets); a key's rows lie in one bucket, which is sound as long as they are few: the products of one time and region, or the
pixels that one scene has in one tile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronocell.operators.planner import KEY

PIXELS = ("tile_x", "tile_y", "dataset_id")
TABLE = "table:"


def write_buckets(rows: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """rows as a table of so many buckets of the keys, one sorted file each; what the table held before goes. path: of an external table."""
    if buckets < 1:
        raise ValueError("one bucket at least")
    w = rows.repartition(buckets, *keys).write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (w if path is None else w.option("path", path)).saveAsTable(table)
    return rows.sparkSession.table(table)


def write_scenes(scenes: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Scenes by time and region: fuse_join() and the semi join with its groups read each bucket where it lies."""
    return write_buckets(scenes, table, KEY, buckets, path)


def write_pixels(pixels: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Pixels by tile and scene: run_tasks() brings the tasks' scenes, which are few, to them."""
    return write_buckets(pixels, table, PIXELS, buckets, path)


def source(spark: SparkSession, name: str) -> DataFrame:
    """table:NAME, a catalogue that is kept up to date, or Parquet."""
    from chronocell.sources import catalogue_store

    if name.startswith(TABLE):
        return spark.table(name.removeprefix(TABLE))
    return catalogue_store.scenes(spark, name) if catalogue_store.batches(spark, name) else spark.read.parquet(name)


def in_order(scenes: DataFrame) -> DataFrame:
    """Scenes by time and region code, or by time where they have no such column; ties by id. A sort over ranges of time, none of which is larger than a task's share."""
    return scenes.orderBy(*[F.asc_nulls_last(c) for c in (*KEY, "id") if c in scenes.columns])
