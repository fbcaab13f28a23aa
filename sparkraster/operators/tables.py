"""Tables cut off from their lineage in the folder that all executors share."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows that a task makes, about, where they are counted first.
TASK_ROWS = 500_000


def tasks(spark: SparkSession, rows: float | None) -> int:
    """Number of tasks for ``rows`` counted rows. Sizes of files and of shuffled bytes tell nothing of rows that are made from them."""
    return max(spark.sparkContext.defaultParallelism, math.ceil((rows or 0) / TASK_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder where a local session sets none (tests), else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def shared_table(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet and read from there."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` through checkpoint() in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
