"""Labelled regions: pixels ``scene_id, y, x, label``; masks are pixel tables of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkraster.operators.sampling import _ranked

KEY = ["scene_id", "y", "x"]


def mask_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pixels of either mask with ``both_, either_, only_a``: their intersection, union and difference."""
    x = a.select(*KEY).distinct().withColumn("a", F.lit(True))
    y = b.select(*KEY).distinct().withColumn("b", F.lit(True))
    j = x.join(y, KEY, "full_outer").fillna(False, ["a", "b"])
    return j.select(*KEY, (F.col("a") & F.col("b")).alias("both_"), (F.col("a") | F.col("b")).alias("either_"), (F.col("a") & ~F.col("b")).alias("only_a"))


def label_sizes(labels: DataFrame) -> DataFrame:
    return labels.where("label > 0").groupBy("scene_id", "label").agg(F.count("*").alias("n"))


def filter_small(labels: DataFrame, least: int) -> DataFrame:
    """Regions of fewer than ``least`` pixels become background (0). Sizes are summed before the join, so a giant label is one row of it."""
    small = label_sizes(labels).where(F.col("n") < least).select("scene_id", "label", F.lit(True).alias("small"))
    j = labels.join(small, ["scene_id", "label"], "left")
    return j.select(*KEY, F.when(F.col("small"), F.lit(0).cast("long")).otherwise(F.col("label")).alias("label"))


def compact(labels: DataFrame) -> DataFrame:
    """Labels 1..N of each scene in ascending order of the old ones; 0 and negative labels stay.

    Labels are ranked over all scenes in ranges, and the first rank of a scene
    is taken off, so a scene of many labels is not one task's work.
    """
    kinds = _ranked(label_sizes(labels).select("scene_id", "label"), [F.col("scene_id"), F.col("label")])
    least = kinds.groupBy("scene_id").agg(F.min("rank").alias("least"))
    kinds = kinds.join(least, "scene_id").select("scene_id", "label", (F.col("rank") - F.col("least") + 1).alias("new"))
    return labels.join(kinds, ["scene_id", "label"], "left").select(*KEY, F.coalesce("new", "label").alias("label"))


def edges(labels: DataFrame) -> DataFrame:
    """Unit edges of labelled pixels whose 4-neighbour has another label or none.

    ``scene_id, label, side, y, x``: side 0 above, 1 right, 2 below, 3 left.
    """
    inner = labels.where("label > 0").select("scene_id", "label", "y", "x")
    steps = F.array(*[F.struct(F.lit(s).alias("side"), F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for s, dy, dx in ((0, -1, 0), (1, 0, 1), (2, 1, 0), (3, 0, -1))])
    near = inner.select("*", F.explode(steps).alias("s")).select("scene_id", "label", "y", "x", "s.side", (F.col("y") + F.col("s.dy")).alias("ny"), (F.col("x") + F.col("s.dx")).alias("nx"))
    other = inner.select("scene_id", "label", F.col("y").alias("ny"), F.col("x").alias("nx"))
    return near.join(other, ["scene_id", "label", "ny", "nx"], "left_anti").select("scene_id", "label", "side", "y", "x")


def shape_facts(labels: DataFrame) -> DataFrame:
    """Box, area and perimeter of each label."""
    box = labels.where("label > 0").groupBy("scene_id", "label").agg(
        F.min("y").alias("ymin"), F.max("y").alias("ymax"), F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.count("*").alias("area")
    )
    per = edges(labels).groupBy("scene_id", "label").agg(F.count("*").alias("perimeter"))
    return box.join(per, ["scene_id", "label"])


def cleanup(parcels: DataFrame, least_area: float) -> DataFrame:
    """Adds ``reason`` why a parcel is dropped: empty, small_area (area <= least + 1e-9) or null for kept ones."""
    return parcels.withColumn(
        "reason", F.when(F.coalesce(F.col("area"), F.lit(0.0)) <= 0, "empty").when(F.col("area") <= least_area + 1e-9, "small_area")
    )


def simplify(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """Ring vertices ``keys, pos, x, y`` without those on the line of their neighbours; the shape stays."""
    from pyspark.sql import Window as W

    w = W.partitionBy(*keys).orderBy("pos")
    whole = W.partitionBy(*keys)
    first = {c: F.min_by(c, "pos").over(whole) for c in ("x", "y")}
    last = {c: F.max_by(c, "pos").over(whole) for c in ("x", "y")}
    v = vertices.withColumns(
        {**{f"p{c}": F.coalesce(F.lag(c).over(w), last[c]) for c in ("x", "y")}, **{f"n{c}": F.coalesce(F.lead(c).over(w), first[c]) for c in ("x", "y")}}
    )
    cross = (F.col("x") - F.col("px")) * (F.col("ny") - F.col("y")) - (F.col("y") - F.col("py")) * (F.col("nx") - F.col("x"))
    return v.where(cross != 0).select(*keys, "pos", "x", "y")


def illegal_labels(labels: DataFrame, invalid: int = -1) -> DataFrame:
    """Negative labels other than ``invalid``, with their number of pixels."""
    return labels.where((F.col("label") < 0) & (F.col("label") != invalid)).groupBy("scene_id", "label").agg(F.count("*").alias("n"))
