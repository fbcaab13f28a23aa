"""Partitioned export of patch datasets."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkraster.operators.tables import shared_dir


def export_by_split(patches: DataFrame, keys: list[str], path: str | None = None) -> DataFrame:
    """Writes ``patches`` as Parquet partitioned by ``split`` and counts what was written by split and ``keys``."""
    path = path or f"{shared_dir(patches.sparkSession)}/dataset-{uuid.uuid4().hex[:12]}"
    patches.write.partitionBy("split").parquet(path)
    return patches.sparkSession.read.parquet(path).groupBy("split", *keys).agg(F.count("*").alias("patches"))


def read_patch_meta(spark, path: str) -> DataFrame:
    """Patch records of a folder of ``*_meta.json`` files, one multi-line object each."""
    schema = (
        "patch_id string, xoff int, yoff int, patch_width int, patch_height int, valid_ratio double, edge_ratio double, "
        "sampling_class string, feature_mode string, feature_channel_count int"
    )
    return spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*_meta.json").json(path)
