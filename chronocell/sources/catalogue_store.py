"""A catalogue of item documents that is brought up to date by reading new and changed files only.

A refresh lists all files (path, time and length; no content) and compares them with what the store knows. store/batch=N has
what the N-th refresh found: the scene of each new or changed file, and the paths that are gone. A batch counts once it is
whole, and the next refresh takes the place of one that is not, so a refresh can be stopped and started again at any time; two
at once are not meant to be. Files that are no item documents are known, so they are not read again, but give no scene; empty files count as absent. Of
files with one id the newest gives the scene, of equally new ones the one with the last path, of a file's lines with one id the last.

A listing goes through the driver, as Spark's always do, so files should not be as many as items: with lines, a file has an item a line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronocell.sources.catalogue_items import ITEM, scene_columns

FILE = ["path", "modified", "length"]


def batches(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the whole batches."""
    root = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith("batch=")]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(p.getName().removeprefix("batch=")) for p in found if fs.exists(done(p, "_SUCCESS")))


def listing(spark: SparkSession, globs: str | Sequence[str], pattern: str) -> DataFrame:
    """The files with their content, which is read only where it is selected and the time is as filtered."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load([globs] if isinstance(globs, str) else list(globs))
    return f.withColumnRenamed("modificationTime", "modified")


def known(spark: SparkSession, store: str) -> DataFrame | None:
    """The last row of each path that is not gone; None before the first refresh."""
    whole = batches(spark, store)
    if not whole:
        return None
    rows = spark.read.option("basePath", store).option("mergeSchema", True).parquet(*[f"{store}/batch={n}" for n in whole])
    rows = rows if "line" in rows.columns else rows.withColumn("line", F.lit(0))  # a store from before there were lines
    last = rows.groupBy("path").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["path", "batch"], "left_semi").where("not gone")


def refresh(spark: SparkSession, globs: str | Sequence[str], store: str, pattern: str = "*.stac-item.json", lines: bool = False) -> tuple[int, int]:
    """Brings the store up to date with all files under the globs; how many files were read, and how many paths are gone.

    A file is one item, or with lines an item a line. Only the span of the new and changed files' times goes through the driver: the reader opens no file outside it.
    """
    now, old, whole = listing(spark, globs, pattern), known(spark, store), batches(spark, store)
    found = now.select(*FILE)
    changed = found if old is None else found.join(old.select(*FILE), FILE, "left_anti")
    span = changed.agg(F.min("modified").alias("low"), F.max("modified").alias("high")).first()
    fresh = now.where(F.col("modified").between(F.lit(span.low), F.lit(span.high))).join(changed.select("path"), "path", "left_semi")
    text = F.decode("content", "utf-8")
    documents = fresh.select(*FILE, F.posexplode(F.split(text, "\n") if lines else F.array(text)).alias("line", "text"))
    documents = documents.where((F.col("line") == 0) | (F.trim("text", F.lit(" \t\r")) != ""))  # a file without items is known by its first line
    item = documents.select(*FILE, "line", F.from_json("text", ITEM).alias("item"))
    rows = item.select(*FILE, "line", F.lit(False).alias("gone"), "item.*").select(*FILE, "line", "gone", *scene_columns())
    if old is not None:
        rows = rows.unionByName(old.select("path", F.lit(True).alias("gone")).dropDuplicates().join(found.select("path"), "path", "left_anti"), allowMissingColumns=True)
        if span.low is None and rows.where("gone").isEmpty():
            return 0, 0
    batch = f"{store}/batch={max(whole, default=-1) + 1}"
    rows.write.mode("overwrite").option("compression", "zstd").parquet(batch)
    n = spark.read.parquet(batch).agg(F.count_if(~F.col("gone") & (F.col("line") == 0)), F.count_if("gone")).first()
    return n[0], n[1]


def scenes(spark: SparkSession, store: str) -> DataFrame:
    """The scenes of the store's items as they are now, as read_items() gives them."""
    rows = known(spark, store)
    if rows is None:
        raise ValueError(f"no whole batch in {store}")
    newest = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("modified"), F.desc("path"), F.desc("line")))
    return rows.where("id is not null").withColumn("_nth", newest).where("_nth = 1").drop("_nth", "batch", "gone", "line", *FILE)
