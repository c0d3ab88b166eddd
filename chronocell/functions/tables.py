"""Tables that cut lineage, and folders, where all executors see them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """spark.checkpoint.dir. A session on one machine gets a new folder where that is unset; on a cluster an unset folder is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def folder(spark: SparkSession, kind: str) -> str:
    """A new folder's path in the shared one."""
    return f"{shared(spark)}/{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df computed and kept in the shared folder; its partitions and their order stay."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared(df.sparkSession))
    return df.checkpoint()
