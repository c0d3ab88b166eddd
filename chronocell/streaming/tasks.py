"""Streams: a directory of task files as a queue, running counts, and tasks that are planned as their scenes arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronocell.functions.periods import local_time, period_end
from chronocell.functions.pixels import divided

MESSAGE = "filedb string, tile_idx string"
ANNUAL = "y long, x long, count_wet long, count_clear long"


def messages(tasks: DataFrame, filedb: str) -> DataFrame:
    tile = F.concat_ws("/", "period", F.format_string("%02d", "x"), F.format_string("%02d", "y"))
    return tasks.select(F.lit(filedb).alias("filedb"), tile.alias("tile_idx"))


def publish(tasks: DataFrame, filedb: str, path: str) -> None:
    """One JSON message a task: what a queue would carry."""
    messages(tasks, filedb).write.mode("append").json(path)


def task_stream(spark: SparkSession, path: str, files: int = 10) -> DataFrame:
    """period, x, y and filedb of messages as they arrive; a message is done once its batch is."""
    m = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files).json(path)
    part = F.split("tile_idx", "/")
    return m.select(part[0].alias("period"), part[1].cast("int").alias("x"), part[2].cast("int").alias("y"), "filedb")


def run_stream(tasks: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, poll: str | None = None) -> StreamingQuery:
    """Runs work on each batch until the directory is used up, or, with poll (like '10 seconds'), for as long as messages
    may come; a failed batch is tried again on restart. The checkpoint takes the place of a queue's leases: a batch is
    this query's until its work has ended, and its messages are then done."""
    out = tasks.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if poll is None else out.trigger(processingTime=poll)).start()


def stopped_in_time(query: StreamingQuery, seconds: float) -> bool:
    """Waits for a query to end; one that takes longer is stopped and its batch left for the next run. Whether it ended."""
    if query.awaitTermination(seconds):
        return True
    query.stop()
    return False


def full_history(annual: DataFrame) -> DataFrame:
    """All-time counts and frequency from annual summaries, batch or stream (update mode)."""
    total = lambda c: F.sum(F.when(F.col(c) >= 0, F.col(c)).otherwise(0))
    a = annual.groupBy("y", "x").agg(total("count_wet").alias("cw"), total("count_clear").alias("cc"), F.count_if(F.col("count_clear") >= 0).alias("n"))
    count = lambda c: F.when(F.col("n") > 0, F.col(c)).otherwise(-999)
    return a.select("y", "x", count("cw").alias("count_wet"), count("cc").alias("count_clear"), divided("cw", "cc").alias("frequency"))


def running(changed: DataFrame, path: str, checkpoint: str, poll: str | None = None) -> StreamingQuery:
    """A stream's aggregates in update mode. Each batch's changed rows go to a folder of their own, which a batch that is tried
    again replaces; the aggregates are state under the checkpoint, so a restart goes on where it ended."""

    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    out = changed.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if poll is None else out.trigger(processingTime=poll)).start()


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last row a key of running()."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_last")).select(*keys, "_last.*")


def fold_history(annual: DataFrame, path: str, checkpoint: str, poll: str | None = None) -> StreamingQuery:
    """The running all-time counts of a stream of annual summaries."""
    return running(full_history(annual), path, checkpoint, poll)


def latest_history(spark: SparkSession, path: str) -> DataFrame:
    """Each pixel's last counts of fold_history()."""
    return latest(spark, path, ["y", "x"])


def scene_windows(scenes: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Scenes a product and fixed window as they arrive."""
    return scenes.withWatermark("center_time", late).groupBy(F.window("center_time", width), "product").agg(F.count(F.lit(1)).alias("scenes"))


def arriving_tasks(binned: DataFrame, late: str = "2 days") -> DataFrame:
    """Tasks of a stream of binned tile scenes (period, x, y, id, center_time, utc_offset), with dataset_ids and closes, the
    end of the period in local time; batch frames give the same rows.

    A task closes once a scene of a period has come that ends later by `late` at least: append mode gives each task once, then;
    update mode gives it whenever it grows. Scenes of a closed task are left out, and its state goes. A scene that comes twice
    counts once; one without an id counts for the days only. A task's ids are its state, as they are its row.
    """
    day = F.to_date(local_time(F.col("center_time"), F.col("utc_offset")))
    s = binned.select("period", "x", "y", "id", day.alias("day"), period_end("period").alias("closes")).withWatermark("closes", late)
    ids = F.sort_array(F.collect_set("id"))  # array_sort calls a comparator for each pair it compares
    return s.groupBy("closes", "period", "x", "y").agg(ids.alias("dataset_ids"), F.array_size(F.collect_set("day")).cast("long").alias("days"))
