"""Rings of parcels ``scene_id, parcel_id, ring_no, ring``: crossings, simplification and reasons to drop a parcel.

``ring`` is an array of ``struct<x double, y double>``, closed by itself. Holes
are further rings of a parcel, of the other orientation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkraster.operators.spatial import _edges, box_join, once
from sparkraster.operators.tables import shared_table, tasks

PARCEL = ["scene_id", "parcel_id"]
#: Added to the least area in comparisons (a fixed value).
EPSILON = 1e-9


def _distinct_points(ring: Column) -> Column:
    """The ring without vertices equal to the one before; a null ring is empty."""
    def some(r):
        n = F.size(r)
        return F.filter(r, lambda p, i: (n == 1) | (p != F.element_at(r, F.when(i > 0, i).otherwise(n))))

    return F.coalesce(once(ring, some), F.array().cast("array<struct<x:double,y:double>>"))


def signed_area(ring: Column) -> Column:
    """Half the sum of cross products: the area of a ring, negative for the other orientation, 0 under 3 vertices."""
    terms = F.transform(_edges(ring), lambda e: e["ax"] * e["by"] - e["bx"] * e["ay"])
    return F.when(F.size(ring) >= 3, F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) / 2).otherwise(0.0)


def segments(rings: DataFrame) -> DataFrame:
    """Segments of rings of 3 vertices and more: ``scene_id, parcel_id, ring_no, pos, n, ax, ay, bx, by``."""
    r = rings.select(*PARCEL, "ring_no", _distinct_points(F.col("ring")).alias("ring")).where(F.size("ring") >= 3)
    r = r.select(*PARCEL, "ring_no", F.size("ring").alias("n"), F.posexplode(_edges(F.col("ring"))).alias("pos", "e"))
    return r.select(*PARCEL, "ring_no", "pos", "n", "e.*")


def crossings(rings: DataFrame) -> DataFrame:
    """Parcels ``scene_id, parcel_id`` whose rings are not simple, with ``crossings``, the pairs of segments that show it.

    Two segments of a ring that are not neighbours must not share a point,
    neighbours share only their vertex, and segments of two rings of a parcel do
    not cross each other. Segments meet by the boxes around them on the levels
    of a grid (``box_join``), so long segments are few rows and no parcel is
    compared within one task. The orientation of three points is exact where
    their coordinates are multiples of one power of two of at most 25 bits, as
    those of pixel corners are.
    """
    s = segments(rings)
    low = lambda a, b: F.floor(F.least(a, b)).cast("long")
    high = lambda a, b: F.floor(F.greatest(a, b)).cast("long")
    boxes = s.select(
        F.struct(*PARCEL).alias("scene_id"), F.struct("ring_no", "pos").alias("parcel_id"), low("ax", "bx").alias("x0"), low("ay", "by").alias("y0"),
        (high("ax", "bx") - low("ax", "bx") + 1).alias("w"), (high("ay", "by") - low("ay", "by") + 1).alias("h"), "n", "ax", "ay", "bx", "by",
    )
    pairs = box_join(boxes, boxes, carry=("n", "ax", "ay", "bx", "by")).where("left_id < right_id")

    def point(side, end):
        return F.col(f"{side}_{end}x"), F.col(f"{side}_{end}y")

    def turn(p, q, r):
        return F.signum((q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]))

    def within(p, q, r):
        """Whether ``r``, on the line of the segment, is on it."""
        return r[0].between(F.least(p[0], q[0]), F.greatest(p[0], q[0])) & r[1].between(F.least(p[1], q[1]), F.greatest(p[1], q[1]))

    a, b, c, d = point("left", "a"), point("left", "b"), point("right", "a"), point("right", "b")
    turns = [(turn(*t), t) for t in ((a, b, c), (a, b, d), (c, d, a), (c, d, b))]
    proper = (turns[0][0] * turns[1][0] < 0) & (turns[2][0] * turns[3][0] < 0)
    touch = F.lit(False)
    for t, points in turns:
        touch = touch | ((t == 0) & within(*points))
    one_ring = F.col("left_id.ring_no") == F.col("right_id.ring_no")
    apart = F.col("right_id.pos") - F.col("left_id.pos")
    beside = one_ring & ((apart == 1) | (apart == F.col("left_n") - 1))
    # Neighbours run back over each other where they are on one line in opposite directions.
    back = (turns[0][0] == 0) & (turns[1][0] == 0) & ((b[0] - a[0]) * (d[0] - c[0]) + (b[1] - a[1]) * (d[1] - c[1]) < 0)
    bad = F.when(beside, back).when(one_ring, proper | touch).otherwise(proper)
    return pairs.where(bad).groupBy("scene_id").agg(F.count("*").alias("crossings")).select("scene_id.*", "crossings")


def simplified(points: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """Vertices of a ring that stay with a tolerance: Douglas and Peucker (1973) between the first and the one farthest from it; [] under 3."""
    if len(points) < 3:
        return []
    far = max(range(len(points)), key=lambda i: (points[i][0] - points[0][0]) ** 2 + (points[i][1] - points[0][1]) ** 2)
    path, keep = [*points, points[0]], {0, far}
    todo = [(0, far), (far, len(points))]
    while todo:
        i, j = todo.pop()
        (ax, ay), (bx, by) = path[i], path[j]
        dx, dy = bx - ax, by - ay
        length = (dx * dx + dy * dy) ** 0.5

        def off(k):
            x, y = path[k][0] - ax, path[k][1] - ay  # noqa: B023
            if not length:  # noqa: B023
                return (x * x + y * y) ** 0.5
            along = min(max((x * dx + y * dy) / (length * length), 0.0), 1.0)  # noqa: B023
            return ((x - along * dx) ** 2 + (y - along * dy) ** 2) ** 0.5  # noqa: B023

        if j - i > 1:
            worst = max(range(i + 1, j), key=off)
            if off(worst) > tolerance:
                keep.add(worst)
                todo += [(i, worst), (worst, j)]
    return [points[i] for i in sorted(keep)] if len(keep) >= 3 else []


def simplify_rings(rings: DataFrame, tolerance: float) -> DataFrame:
    """``rings`` with every ``ring`` simplified; one that is left with under 3 vertices is empty. Rings may come to cross."""
    kind = "scene_id {}, parcel_id {}, ring_no {}, ring array<struct<x:double,y:double>>".format(*(dict(rings.dtypes)[c] for c in (*PARCEL, "ring_no")))
    r = rings.select(*PARCEL, "ring_no", _distinct_points(F.col("ring")).alias("ring"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            made = [[{"x": x, "y": y} for x, y in simplified([(p["x"], p["y"]) for p in ring], tolerance)] for ring in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(made, b.schema.field(3).type)], schema=b.schema)

    return r.mapInArrow(run, kind)


def _areas(rings: DataFrame, name: str) -> DataFrame:
    return rings.groupBy(*PARCEL).agg(F.abs(F.sum(signed_area(F.col("ring")))).alias(name))


def cleanup_rings(rings: DataFrame, least_area: float = 0.0, tolerance: float = 0.0) -> DataFrame:
    """``scene_id, parcel_id, reason, area``: why a parcel is dropped, the first reason of these, or null for kept ones.

    empty: no ring of 3 vertices; invalid: rings that are not simple
    (``crossings``), as geometry is not repaired here; small_area: outer rings
    less holes are not larger than ``least_area``; simplified_away: they are not
    after ``simplify_rings``. ``area`` is that before simplification.
    """
    # Written once, as it is read five times, and dealt, as a small file of rings is one task's.
    dealt = rings.repartition(tasks(rings.sparkSession, 16 * rings.count()), *PARCEL)
    clean = shared_table(dealt.select(*PARCEL, "ring_no", _distinct_points(F.col("ring")).alias("ring")))
    made = clean.groupBy(*PARCEL).agg(
        F.max(F.size("ring")).alias("vertices"), F.abs(F.sum(signed_area(F.col("ring")))).alias("area")
    )
    after = _areas(simplify_rings(clean, tolerance), "after") if tolerance > 0 else made.select(*PARCEL, F.col("area").alias("after"))
    j = made.join(crossings(clean), PARCEL, "left").join(after, PARCEL)
    least = max(least_area, 0.0) + EPSILON
    reason = (
        F.when(F.col("vertices") < 3, "empty").when(F.col("crossings").isNotNull(), "invalid").when(F.col("area") <= least, "small_area")
        .when(F.col("after") <= least, "simplified_away")
    )
    return j.select(*PARCEL, reason.alias("reason"), "area")
