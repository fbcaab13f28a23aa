"""A clustered layout of pixel tables, so that a window of a scene reads few row groups.

Pixels belong to cells of ``CELL`` x ``CELL``. The table is sorted by scene and
by the Morton code of the cell, whose neighbours in the plane are near in the
file, and row groups are small. Each row group then spans few scenes and a small
square of cells, which its statistics tell. A scan states the ranges of scene,
cells, rows and columns as plain comparisons, which reach the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = 256
#: Bytes of a row group, about.
GROUP = 8 << 20
#: Cells of an axis have numbers of so many bits.
BITS = 16


def morton(cy: Column, cx: Column) -> Column:
    """The bits of two cell numbers from 0 to 2 ** ``BITS`` - 1, interleaved."""
    bit = lambda c, i, to: F.shiftleft(F.shiftright(c.cast("long"), i).bitwiseAND(F.lit(1)), to)
    parts = [bit(c, i, 2 * i + k) for i in range(BITS) for k, c in ((1, cy), (0, cx))]
    out = parts[0]
    for p in parts[1:]:
        out = out.bitwiseOR(p)
    return out


def write_clustered(pixels: DataFrame, path: str, cell: int = CELL, group: int = GROUP, parts: int | None = None) -> None:
    """Writes pixels ``scene_id, y, x, ...`` (y, x >= 0) to the new table ``path`` in the clustered layout.

    Rows are dealt to files in ranges of scene and Morton code, so a scene of
    any size is many files; columns ``cell_y, cell_x`` are added.
    """
    at = lambda c: F.floor(F.col(c) / cell).cast("int")
    df = pixels.withColumns({"cell_y": at("y"), "cell_x": at("x")})
    df = df.withColumn("__code", morton(F.col("cell_y"), F.col("cell_x")))
    parts = parts or int(pixels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["scene_id", "__code", "y", "x"]
    df.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("__code").write.option("parquet.block.size", group).parquet(path)


def scan_clustered(spark: SparkSession, path: str, scene_id=None, window: tuple[int, int, int, int] | None = None, cell: int = CELL) -> DataFrame:
    """Pixels of a scene (None: all) in a half-open window ``y0, y1, x0, x1`` (None: whole) of a clustered table.

    The cells of the window are a range of ``cell_y`` and of ``cell_x``, given
    beside the exact bounds, so row groups and pages are skipped by either.
    """
    df = spark.read.parquet(path)
    if scene_id is not None:
        df = df.where(F.col("scene_id") == scene_id)
    if window is not None:
        for c, lo, hi in (("y", *window[:2]), ("x", *window[2:])):
            df = df.where((F.col(f"cell_{c}") >= lo // cell) & (F.col(f"cell_{c}") <= (hi - 1) // cell) & (F.col(c) >= lo) & (F.col(c) < hi))
    return df.drop("cell_y", "cell_x")
