"""Parcels and pixels: rasterization, candidate joins, overlaps, matches and object metrics.

Parcels are ``scene_id, parcel_id`` with either an integer box ``x0, y0, w, h``
in pixels or a ``ring`` of ``struct<x double, y double>`` vertices (closed by
itself). A pixel belongs to a parcel when its centre does; on an edge, left and
top are in, right and bottom out.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparkraster.functions import bands as B
from sparkraster.operators.pixels import with_scene
from sparkraster.operators.tables import shared_table, tasks

CELL = 256


def box_runs(boxes: DataFrame) -> DataFrame:
    """``scene_id, parcel_id, y, a, b``: the pixels of integer boxes as runs, a row of pixels each, from ``a`` to ``b``."""
    some = boxes.where("w > 0 AND h > 0")
    # A small file is one task's, whatever its boxes make.
    some = some.repartition(tasks(boxes.sparkSession, some.agg(F.sum("h")).first()[0]), "scene_id", "parcel_id")
    rows = some.withColumn("y", F.explode(F.expr("sequence(y0, y0 + h - 1)")))
    return rows.select("scene_id", "parcel_id", "y", F.col("x0").alias("a"), F.expr("x0 + w - 1").alias("b"))


def _pixels_of(runs: DataFrame) -> DataFrame:
    return runs.select("scene_id", "parcel_id", "y", F.explode(F.sequence("a", "b")).alias("x"))


def rasterize_boxes(boxes: DataFrame) -> DataFrame:
    """``scene_id, parcel_id, y, x`` of the pixels of integer boxes."""
    return _pixels_of(box_runs(boxes))


def once(value: Column, made) -> Column:
    """``made(value)`` with ``value`` computed once a row, however often ``made`` names it; lambdas in it would compute it for each element."""
    return F.element_at(F.transform(F.array(value), made), 1)


def _edges(ring: Column) -> Column:
    """Segments of a ring: each vertex with the next, the last with the first."""

    def of(r):
        after = lambda i: F.element_at(r, F.when(i + 1 < F.size(r), i + 2).otherwise(F.lit(1)))
        return F.transform(r, lambda p, i: F.struct(p["x"].alias("ax"), p["y"].alias("ay"), after(i)["x"].alias("bx"), after(i)["y"].alias("by")))

    return once(ring, of)


def ring_runs(parcels: DataFrame) -> DataFrame:
    """``scene_id, parcel_id, y, a, b``: the pixels of rings as runs, by even-odd crossings.

    Holes are further rows of a parcel: a pixel is inside when the crossings of
    all its rings are odd. Each row of pixels meets the edges of its own parcel
    only; a row's crossings, sorted, bound its runs of pixels, so no pixel
    outside is ever made.
    """
    e = parcels.select("scene_id", "parcel_id", F.inline(_edges(F.col("ring"))))
    lo, hi = F.least("ay", "by"), F.greatest("ay", "by")
    # Rows whose centre y + 0.5 lies in [lo, hi).
    first, last = F.ceil(lo - 0.5), F.ceil(hi - 0.5) - 1
    e = e.where(F.col("ay") != F.col("by")).withColumns({"r0": first.cast("long"), "r1": last.cast("long")}).where("r0 <= r1")
    e = e.withColumn("y", F.explode(F.expr("sequence(r0, r1)")))
    cross = F.col("ax") + (F.col("y") + 0.5 - F.col("ay")) * (F.col("bx") - F.col("ax")) / (F.col("by") - F.col("ay"))
    rows = e.groupBy("scene_id", "parcel_id", "y").agg(F.array_sort(F.collect_list(cross)).alias("c"))
    runs = rows.select(
        "scene_id", "parcel_id", "y",
        F.explode(F.transform(F.sequence(F.lit(1), (F.size("c") / 2).cast("int")), lambda i: F.struct(
            F.ceil(F.element_at("c", 2 * i - 1) - 0.5).cast("long").alias("a"), (F.ceil(F.element_at("c", 2 * i) - 0.5) - 1).cast("long").alias("b")))).alias("run"),
    )
    return runs.where("run.a <= run.b").select("scene_id", "parcel_id", "y", "run.a", "run.b")


def rasterize_rings(parcels: DataFrame) -> DataFrame:
    """``scene_id, parcel_id, y, x`` of the pixels of rings, see ``ring_runs``."""
    return _pixels_of(ring_runs(parcels))


def pixel_runs(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, y, a, b``: pixels ``keys, y, x`` as runs, which end at the borders of cells of ``CELL`` columns."""
    px = pixels.select(*keys, "y", "x").distinct().withColumn("cell", F.floor(F.col("x") / CELL))
    w = W.partitionBy(*keys, "y", "cell").orderBy("x")
    px = px.withColumn("run", F.col("x") - F.row_number().over(w))
    return px.groupBy(*keys, "y", "cell", "run").agg(F.min("x").alias("a"), F.max("x").alias("b")).drop("cell", "run")


def outline_rings(parcels: DataFrame) -> DataFrame:
    """Distinct ``scene_id, y, x`` of the pixels that the outlines of rings touch, of all parcels together.

    A pixel is touched when a point of an edge lies in it; its left and top
    edges belong to it, its right and bottom ones to its neighbours. Each edge is
    cut into rows of pixels, and the part in a row touches a run of them; nothing
    inside a parcel is ever made. Edges are dealt by bands of rows first, see
    ``_banded``, so pixels are made and told apart where they stay.
    """
    e = parcels.select("scene_id", F.inline(_edges(F.col("ring"))))
    down = F.col("ay") <= F.col("by")
    e = e.select("scene_id", *[F.when(down, F.col(p)).otherwise(F.col(q)).alias(n) for n, p, q in (
        ("px", "ax", "bx"), ("py", "ay", "by"), ("qx", "bx", "ax"), ("qy", "by", "ay"))])
    e = e.withColumns({"y0": F.floor("py").cast("long"), "y1": F.floor("qy").cast("long")})
    e = _banded(e, F.abs(F.col("qx") - F.col("px")) + F.col("qy") - F.col("py") + 2)
    e = e.withColumn("y", F.explode(F.sequence("y0", "y1")))
    flat = F.col("py") == F.col("qy")
    at = lambda v: F.col("px") + (v - F.col("py")) * (F.col("qx") - F.col("px")) / (F.col("qy") - F.col("py"))
    first = F.when(flat, F.col("px")).otherwise(at(F.greatest(F.col("py"), F.col("y").cast("double"))))
    last = F.when(flat | (F.col("qy") < F.col("y") + 1), F.col("qx")).otherwise(at(F.col("y") + 1.0))
    # The point where an edge goes on in the next row belongs to that row.
    goes_on = ~flat & (F.col("qy") >= F.col("y") + 1)
    e = e.select("scene_id", "band", "y", first.alias("f"), last.alias("l"), goes_on.alias("on"))
    low = F.floor(F.least("f", "l"))
    high = F.when(F.col("on") & (F.col("l") >= F.col("f")), F.ceil("l") - 1).otherwise(F.floor(F.greatest("f", "l")))
    e = e.select("scene_id", "band", "y", F.explode(F.sequence(low.cast("long"), F.greatest(low, high).cast("long"))).alias("x"))
    return e.distinct().select("scene_id", "y", "x")


def outline_boxes(boxes: DataFrame) -> DataFrame:
    """Distinct ``scene_id, y, x`` of the border pixels of integer boxes, of all parcels together."""
    b = boxes.where("w > 0 AND h > 0")
    # Top and bottom are whole rows, left and right what is between them.
    side = "struct({} AS x0, {} AS x1, {} AS y0, {} AS y1)"
    top, bottom = (side.format("x0", "x0 + w - 1", y, y) for y in ("y0", "y0 + h - 1"))
    left, right = (side.format(x, x, "y0 + 1", "y0 + h - 2") for x in ("x0", "x0 + w - 1"))
    sides = f"array_distinct(concat(array({top}, {bottom}), IF(h > 2, array({left}, {right}), array())))"
    e = b.select("scene_id", F.expr(f"inline({sides})")).selectExpr("scene_id", *[f"CAST({c} AS LONG) AS {c}" for c in ("x0", "x1", "y0", "y1")])
    e = _banded(e, F.expr("(x1 - x0 + 1) * (y1 - y0 + 1)"))
    e = e.withColumn("y", F.explode(F.sequence("y0", "y1"))).select("scene_id", "band", "y", F.explode(F.sequence("x0", "x1")).alias("x"))
    return e.distinct().select("scene_id", "y", "x")


#: Rows of pixels of a band.
BAND = 64


def _banded(lines: DataFrame, pixels: Column) -> DataFrame:
    """Lines with rows ``y0`` to ``y1`` cut at bands of ``BAND`` rows and dealt by scene and ``band``.

    There are as many tasks as the sum of ``pixels``, the pixels a line makes,
    asks for. A pixel's scene, band and place are then told apart in its task,
    so what moves are lines and not pixels, and no task makes those of a file.
    """
    parts = tasks(lines.sparkSession, lines.agg(F.sum(pixels)).first()[0])
    at = lambda c: F.floor(F.col(c) / BAND).cast("long")
    b = lines.withColumn("band", F.explode(F.sequence(at("y0"), at("y1")))).repartition(parts, "scene_id", "band")
    return b.withColumns({"y0": F.greatest(F.col("y0"), F.col("band") * BAND), "y1": F.least(F.col("y1"), F.col("band") * BAND + BAND - 1)})


def box_join(left: DataFrame, right: DataFrame, cell: int = CELL, carry: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of boxes that meet: ``scene_id, left_id, right_id``, and the columns ``carry`` of both with these prefixes.

    The grid has levels of cells of ``cell`` times a power of two. A box belongs
    to the first level whose cells are as long as its longer side, where it
    touches at most 4 of them, so a box over a whole scene is 4 rows as well.
    Two boxes meet at the larger one's level, to which the smaller one is taken
    through the parents of its cells, at most 4 again; only levels that hold a
    box of the other side are made. A pair is kept in the cell of its
    intersection's corner only, so it comes once and no distinct is needed.
    """

    def sized(df, side):
        d = df.where("w > 0 AND h > 0").select(
            "scene_id", F.col("parcel_id").alias(f"{side}_id"), *[F.col(c).alias(f"{side}_{c}") for c in ("x0", "y0")],
            (F.col("x0") + F.col("w")).alias(f"{side}_x1"), (F.col("y0") + F.col("h")).alias(f"{side}_y1"), F.greatest("w", "h").alias("longer"),
            *[F.col(c).alias(f"{side}_{c}") for c in carry],
        )
        level = F.greatest(F.ceil(F.log2(F.col("longer") / cell)), F.lit(0)).cast("int")
        # Rounding of the logarithm must not make a box longer than its cells.
        return d.withColumn("own", F.when(F.col("longer") > cell * F.pow(2, level), level + 1).otherwise(level)).drop("longer")

    def dealt(df, side, levels):
        """The box in the cells of its own level, and of those of ``levels`` above it."""
        above = F.filter(F.array(*[F.lit(n) for n in levels]).cast("array<int>"), lambda n: n > F.col("own"))
        d = df.withColumn("level", F.explode(F.concat(F.array("own"), above)))
        at = lambda c: F.floor(F.expr(c) / (cell * F.pow(2, F.col("level"))))
        for n, lo, hi in (("cx", f"{side}_x0", f"{side}_x1 - 1"), ("cy", f"{side}_y0", f"{side}_y1 - 1")):
            d = d.withColumn(n, F.explode(F.sequence(at(lo).cast("long"), at(hi).cast("long"))))
        return d.withColumnRenamed("own", f"{side}_own")

    sides = {"left": sized(left, "left"), "right": sized(right, "right")}
    # At most a row for each doubling of a side's length.
    levels = {k: sorted(r.own for r in d.select("own").distinct().collect()) for k, d in sides.items()}
    # Estimated by the size of the boxes, either side would be broadcast.
    joined = dealt(sides["left"], "left", levels["right"]).hint("merge").join(dealt(sides["right"], "right", levels["left"]), ["scene_id", "level", "cx", "cy"])
    meet = "level = greatest(left_own, right_own) AND left_x0 < right_x1 AND right_x0 < left_x1 AND left_y0 < right_y1 AND right_y0 < left_y1"
    size = F.lit(cell) * F.pow(2, F.col("level"))
    corner = (F.floor(F.greatest("left_x0", "right_x0") / size) == F.col("cx")) & (F.floor(F.greatest("left_y0", "right_y0") / size) == F.col("cy"))
    return joined.where(meet).where(corner).drop("level", "left_own", "right_own")


def _in_cells(runs: DataFrame, name: str, id_: str | None, parts: int | None = None) -> DataFrame:
    """Runs cut at the borders of cells of ``CELL`` columns, dealt to ``parts`` by row and cell; those of one id made disjoint.

    All that meet in ``overlaps_of_runs`` are dealt alike, so its joins move nothing again.
    """
    key = [*ROW, *([id_] if id_ else [])]
    r = runs.select("scene_id", "y", *([F.col("parcel_id").cast("long").alias(id_)] if id_ else []), F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    r = r.withColumn("cell", F.explode(F.sequence(F.floor(F.col("a") / CELL), F.floor(F.col("b") / CELL))))
    r = r.withColumns({"a": F.greatest(F.col("a"), F.col("cell") * CELL), "b": F.least(F.col("b"), F.col("cell") * CELL + CELL - 1)})
    # Two parcel rows of one id may cover a pixel twice.
    w = W.partitionBy(*key).orderBy("a")
    reach = F.max("b").over(w.rowsBetween(W.unboundedPreceding, -1))
    r = (r.repartition(parts, *ROW) if parts else r.repartition(*ROW)).withColumn("new", F.when(F.col("a") <= reach, 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    return r.groupBy(*key, "run").agg(F.min("a").alias(f"{name}_a"), F.max("b").alias(f"{name}_b")).drop("run")


ROW = ["scene_id", "y", "cell"]


def _met(left: DataFrame, right: DataFrame, a: str, b: str, made: str) -> DataFrame:
    """Common parts of the runs ``a`` of left and ``b`` of right in their rows and cells, as runs ``made``.

    Runs are estimated by the size of the boxes they were made from, so they would be broadcast unless a merge is asked for.
    """
    j = left.hint("merge").join(right, ROW).where((F.col(f"{a}_a") <= F.col(f"{b}_b")) & (F.col(f"{b}_a") <= F.col(f"{a}_b")))
    j = j.withColumns({"lo": F.greatest(f"{a}_a", f"{b}_a"), "hi": F.least(f"{a}_b", f"{b}_b")})
    return j.drop(f"{a}_a", f"{a}_b", f"{b}_a", f"{b}_b").withColumnsRenamed({"lo": f"{made}_a", "hi": f"{made}_b"})


def overlaps_of_runs(gt: DataFrame, pred: DataFrame, valid: DataFrame | None = None) -> DataFrame:
    """``scene_id, gt_id, pred_id, inter, gt_area, pred_area, iou, ov_gt, ov_pred`` from runs ``scene_id, parcel_id, y, a, b``.

    Runs of both sides meet in cells of ``CELL`` columns of a row, and their
    common parts are summed, so what is shuffled grows with the outlines of
    parcels and not with their areas. ``valid(scene_id, y, a, b)`` restricts
    both sides to valid pixels. A pixel that several rows of one parcel cover
    counts once; parcels without a valid common pixel make no row.
    """
    parts = tasks(gt.sparkSession, sum(d.count() for d in (gt, pred, valid) if d is not None))
    g, p = _in_cells(gt, "g", "gt_id", parts), _in_cells(pred, "p", "pred_id", parts)
    if valid is not None:
        v = _in_cells(valid, "v", None, parts)
        g, p = _met(g, v, "g", "v", "g"), _met(p, v, "p", "v", "p")
    # Read for the areas and for the common parts.
    g, p = shared_table(g), shared_table(p)

    def area(runs, name, id_, to):
        return runs.groupBy("scene_id", id_).agg(F.sum(F.col(f"{name}_b") - F.col(f"{name}_a") + 1).alias(to))

    inter = _met(g.repartition(parts, *ROW), p.repartition(parts, *ROW), "g", "p", "i").groupBy("scene_id", "gt_id", "pred_id").agg(F.sum(F.col("i_b") - F.col("i_a") + 1).alias("inter"))
    e = inter.join(area(g, "g", "gt_id", "gt_area"), ["scene_id", "gt_id"]).join(area(p, "p", "pred_id", "pred_area"), ["scene_id", "pred_id"])
    i, x, y = F.col("inter"), F.col("gt_area"), F.col("pred_area")
    return e.withColumns({"iou": B.ratio(i, x + y - i), "ov_gt": B.ratio(i, x), "ov_pred": B.ratio(i, y)})


def overlaps(gt_px: DataFrame, pred_px: DataFrame, valid_px: DataFrame | None = None) -> DataFrame:
    """As ``overlaps_of_runs``, from pixels ``scene_id, parcel_id, y, x`` and ``valid_px(scene_id, y, x)``."""
    of = ["scene_id", "parcel_id"]
    valid = None if valid_px is None else pixel_runs(valid_px, ["scene_id"])
    return overlaps_of_runs(pixel_runs(gt_px, of), pixel_runs(pred_px, of), valid)


def box_overlaps(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """As ``overlaps`` for boxes on fully valid scenes, by arithmetic on the candidate join."""
    e = box_join(gt, pred)
    i = F.expr("(least(left_x1, right_x1) - greatest(left_x0, right_x0)) * (least(left_y1, right_y1) - greatest(left_y0, right_y0))").cast("long")
    a, b = F.expr("(left_x1 - left_x0) * (left_y1 - left_y0)").cast("long"), F.expr("(right_x1 - right_x0) * (right_y1 - right_y0)").cast("long")
    return e.select(
        "scene_id", F.col("left_id").alias("gt_id"), F.col("right_id").alias("pred_id"), i.alias("inter"), a.alias("gt_area"), b.alias("pred_area"),
        B.ratio(i, a + b - i).alias("iou"), B.ratio(i, a).alias("ov_gt"), B.ratio(i, b).alias("ov_pred"),
    )


RULES = ("iou_or_overlap", "iou_and_overlap", "iou_only", "overlap_only")


def matches(edges: DataFrame, rule: str = "iou_or_overlap", iou: float = 0.1, ov_gt: float = 0.1, ov_pred: float = 0.1) -> DataFrame:
    """Edges that count as a match under ``rule``; the overlap test asks for enough cover of both sides."""
    by_iou = F.col("iou") >= iou
    by_ov = (F.col("ov_gt") >= ov_gt) & (F.col("ov_pred") >= ov_pred)
    test = {"iou_or_overlap": by_iou | by_ov, "iou_and_overlap": by_iou & by_ov, "iou_only": by_iou, "overlap_only": by_ov}[rule]
    return edges.where(test)


def unmatched(parcels: DataFrame, matched: DataFrame, side: str) -> DataFrame:
    """Parcels without a match; ``side`` is the id column of ``matched`` (gt_id: missed, pred_id: spurious)."""
    ids = matched.select("scene_id", F.col(side).alias("parcel_id"))
    return parcels.select("scene_id", "parcel_id").join(ids, ["scene_id", "parcel_id"], "left_anti")


def object_metrics(gt: DataFrame, matched: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``n_gt, split_gt, merged_pred, merged_gt, goc, guc, gtc, norm_gtc`` of each key.

    A ground-truth parcel is split when it has two matches or more, a prediction
    merged when it has, and a parcel merged when one of its predictions is.
    Degrees count matches within the key, so buckets do not add up to the whole.
    ``gt`` has ``parcel_id`` and the keys, ``matched`` has ``gt_id, pred_id`` and the keys.
    """
    keys = keys or ["scene_id"]
    per_gt = matched.groupBy(*keys, "gt_id").agg(F.count("*").alias("d_gt"))
    per_pred = matched.groupBy(*keys, "pred_id").agg(F.count("*").alias("d_pred"))
    in_merged = matched.join(per_pred.where("d_pred >= 2"), [*keys, "pred_id"]).select(*keys, "gt_id").distinct()
    n = gt.groupBy(*keys).agg(F.count("*").alias("n_gt"))
    split = per_gt.groupBy(*keys).agg(F.count_if(F.col("d_gt") >= 2).alias("split_gt"))
    mp = per_pred.groupBy(*keys).agg(F.count_if(F.col("d_pred") >= 2).alias("merged_pred"))
    mg = in_merged.groupBy(*keys).agg(F.count("*").alias("merged_gt"))
    df = n.join(split, keys, "left").join(mp, keys, "left").join(mg, keys, "left").fillna(0, ["split_gt", "merged_pred", "merged_gt"])
    goc, guc = B.ratio(F.col("split_gt"), F.col("n_gt")), B.ratio(F.col("merged_gt"), F.col("n_gt"))
    return df.withColumns({"goc": goc, "guc": guc, "gtc": goc + guc, "norm_gtc": F.least(goc + guc, F.lit(1.0))})


def size_bucket(area: Column, small: float = 200, large: float = 2000) -> Column:
    return F.when(area < small, "small").when(area < large, "medium").otherwise("large")


def _covered(parcels: DataFrame, pixels: DataFrame) -> DataFrame:
    """Pixels with the parcels that cover them. ``parcels`` are runs ``scene_id, parcel_id, y, a, b``, or pixels ``y, x`` of parcels.

    Runs meet pixels in cells of ``CELL`` columns of a row. They are few and are
    hashed, so the pixels of parcels are never made and those of scenes, read
    once, are neither sorted nor kept.
    """
    if "a" not in parcels.columns:
        return parcels.join(pixels, ["scene_id", "y", "x"])
    runs = parcels.withColumn("cell", F.explode(F.sequence(F.floor(F.col("a") / CELL), F.floor(F.col("b") / CELL))))
    met = runs.hint("shuffle_hash").join(pixels.withColumn("cell", F.floor(F.col("x") / CELL)), ROW)
    return met.where(F.col("x").between(F.col("a"), F.col("b"))).drop("a", "b", "cell")


def valid_area(parcels: DataFrame, pixels: DataFrame) -> DataFrame:
    """Valid pixels of each parcel that covers a known pixel; 0 excludes it downstream. Parcels as ``_covered`` takes them."""
    px = pixels.select("scene_id", "y", "x", "valid")
    return _covered(parcels, px).groupBy("scene_id", "parcel_id").agg(
        F.count_if(F.col("valid") == 1).alias("area"), F.count("*").alias("covered")
    )


def polygon_confidence(parcels: DataFrame, pixels: DataFrame, extent: float = 0.5) -> DataFrame:
    """Zonal means of each parcel and its confidence in [0, 1]; 0 without a valid pixel. Parcels as ``_covered`` takes them.

    0.50 mean extent + 0.20 (1 - mean presence) + 0.15 mean scaled distance +
    0.15 share of extent >= ``extent`` - 0.25 (1 - valid share). The distance is
    min-max scaled over the valid pixels of the scene.
    """
    ok = F.col("valid") == 1
    span = pixels.where(ok).groupBy("scene_id").agg(F.min("distance_pred").alias("lo"), F.max("distance_pred").alias("hi"))
    px = _covered(with_scene(parcels, shared_table(span)), pixels)
    d = B.ratio(F.col("distance_pred") - F.col("lo"), F.col("hi") - F.col("lo"))
    pres = B.presence(F.col("p_skel"), F.col("p_buf"))
    z = px.groupBy("scene_id", "parcel_id").agg(
        F.avg(F.when(ok, F.col("extent_prob"))).alias("mean_extent"), F.avg(F.when(ok, pres)).alias("mean_presence"),
        F.avg(F.when(ok, d)).alias("mean_distance"), F.avg(F.when(ok, (F.col("extent_prob") >= extent).cast("double"))).alias("support"),
        F.avg(ok.cast("double")).alias("cover"),
    )
    c = 0.5 * F.col("mean_extent") + 0.2 * (1 - F.col("mean_presence")) + 0.15 * F.col("mean_distance") + 0.15 * F.col("support") - 0.25 * (1 - F.col("cover"))
    return z.withColumn("confidence", F.coalesce(B.clip(c, 0.0, 1.0), F.lit(0.0)))


def confidence_summary(parcels: DataFrame) -> DataFrame:
    c = F.col("confidence")
    return parcels.groupBy("scene_id").agg(
        F.count("*").alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.avg(c).alias("mean"), F.count_if((c < 0) | (c > 1)).alias("out_of_range")
    )


def nearest_squared(points: DataFrame, targets: DataFrame, sy: float = 1.0, sx: float = 1.0, reach: int = 4, rounds: int = 2) -> DataFrame:
    """Points ``scene_id, y, x`` with ``d2``, the squared distance to the nearest target of the scene.

    Exact. Points look for targets in the grid cells around their own; those
    without one nearer than the cells guarantee go on with cells four times as
    wide, for ``rounds`` rounds. What is left lies far from every target and
    goes down a pyramid of occupied cells, see ``leaf_cells``. Points of a scene
    without a target have d2 null from the start.
    """
    t = targets.select("scene_id", F.col("y").alias("ty"), F.col("x").alias("tx")).distinct()
    every = points.select("scene_id", "y", "x").distinct()
    some = t.select("scene_id").distinct()
    null = F.lit(None).cast("double").alias("d2")
    done = [every.join(some, "scene_id", "left_anti").select("scene_id", "y", "x", null)]
    left = every.join(some, "scene_id", "left_semi")
    for _ in range(rounds):
        # Cells of ``reach`` pixels: a target within reach lies in the 3 x 3 cells around.
        around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("n")
        p = left.select("scene_id", "y", "x", around).select(
            "scene_id", "y", "x", (F.floor(F.col("y") / reach) + F.col("n.i")).alias("cy"), (F.floor(F.col("x") / reach) + F.col("n.j")).alias("cx")
        )
        c = t.select("scene_id", F.floor(F.col("ty") / reach).alias("cy"), F.floor(F.col("tx") / reach).alias("cx"), "ty", "tx")
        dy, dx = (F.col("y") - F.col("ty")) * sy, (F.col("x") - F.col("tx")) * sx
        best = p.join(c, ["scene_id", "cy", "cx"]).groupBy("scene_id", "y", "x").agg(F.min(dy * dy + dx * dx).cast("double").alias("d2"))
        found = shared_table(left.join(best, ["scene_id", "y", "x"], "left"))
        sure = (reach * min(sy, sx)) ** 2
        done.append(found.where(F.col("d2") <= sure))
        left = found.where(F.col("d2").isNull() | (F.col("d2") > sure)).select("scene_id", "y", "x")
        if left.isEmpty():
            return functools.reduce(DataFrame.unionAll, done)
        reach *= 4
    t = shared_table(t)
    leaves = leaf_cells(left, t, sy, sx)
    inside = t.select("scene_id", F.floor(F.col("ty") / LEAF).alias("cy"), F.floor(F.col("tx") / LEAF).alias("cx"), "ty", "tx")
    dy, dx = (F.col("y") - F.col("ty")) * sy, (F.col("x") - F.col("tx")) * sx
    last = leaves.join(inside, ["scene_id", "cy", "cx"]).groupBy("scene_id", "y", "x").agg(F.min(dy * dy + dx * dx).cast("double").alias("d2"))
    return functools.reduce(DataFrame.unionAll, [*done, last])


#: Side of the smallest cells of the pyramid, and how many of them a cell of the next level spans.
LEAF, SPAN = 8, 4


def leaf_cells(points: DataFrame, targets: DataFrame, sy: float = 1.0, sx: float = 1.0) -> DataFrame:
    """Cells ``cy, cx`` of ``LEAF`` pixels that may hold the nearest target of each of the points ``scene_id, y, x``.

    ``targets(scene_id, ty, tx)`` are counted into cells of ``LEAF``, ``LEAF *
    SPAN``, ... pixels up to at most 2 x 2 cells a scene; a cell keeps the bounds
    of its targets. A point starts with the cells at the top and goes down to
    their children. A cell's targets lie no nearer than its bounds, and one of
    them no farther than the far end of a near side of the bounds, as each side
    holds a target. Cells that lie farther than another one must reach are
    dropped on every level, so a point keeps a few cells a level and never meets
    the targets of a scene.
    """
    e = targets.agg(F.max("ty") - F.min("ty"), F.max("tx") - F.min("tx")).first()
    sides = [LEAF]
    while sides[-1] < max(e[0] or 0, e[1] or 0) + 1:
        sides.append(sides[-1] * SPAN)
    bounds = [f(c).alias(n) for n, f, c in (("y0", F.min, "y0"), ("y1", F.max, "y1"), ("x0", F.min, "x0"), ("x1", F.max, "x1"))]
    cells = targets.select("scene_id", F.floor(F.col("ty") / LEAF).alias("cy"), F.floor(F.col("tx") / LEAF).alias("cx"), F.col("ty").alias("y0"), F.col("ty").alias("y1"), F.col("tx").alias("x0"), F.col("tx").alias("x1"))
    levels = [shared_table(cells.groupBy("scene_id", "cy", "cx").agg(*bounds))]
    for _ in sides[1:]:
        up = levels[-1].withColumns({"cy": F.floor(F.col("cy") / SPAN), "cx": F.floor(F.col("cx") / SPAN)})
        levels.append(shared_table(up.groupBy("scene_id", "cy", "cx").agg(*bounds)))
    y, x = F.col("y"), F.col("x")
    gap = lambda p, lo, hi: F.greatest(lo - p, p - hi, F.lit(0))
    near = lambda p, lo, hi: F.least(F.abs(p - lo), F.abs(p - hi))
    far = lambda p, lo, hi: F.greatest(F.abs(p - lo), F.abs(p - hi))
    sq = lambda dy, dx: (dy * sy) * (dy * sy) + (dx * sx) * (dx * sx)
    by, bx = (F.col("y0"), F.col("y1")), (F.col("x0"), F.col("x1"))
    least = sq(gap(y, *by), gap(x, *bx))
    most = F.least(sq(near(y, *by), far(x, *bx)), sq(far(y, *by), near(x, *bx)))
    found = points.select("scene_id", "y", "x").join(levels[-1], "scene_id")
    whole = W.partitionBy("scene_id", "y", "x")
    for k in range(len(levels) - 1, -1, -1):
        kept = found.withColumns({"low": least, "reach": F.min(most).over(whole)}).where("low <= reach")
        found = kept.select("scene_id", "y", "x", "cy", "cx")
        if k:
            child = levels[k - 1].select("scene_id", F.floor(F.col("cy") / SPAN).alias("py"), F.floor(F.col("cx") / SPAN).alias("px"), "cy", "cx", "y0", "y1", "x0", "x1")
            found = found.withColumnsRenamed({"cy": "py", "cx": "px"}).join(child, ["scene_id", "py", "px"]).drop("py", "px")
    return found


def boundary_displacement(gt: DataFrame, pred: DataFrame, sy: float = 1.0, sx: float = 1.0) -> DataFrame:
    """Per scene: half the sum of the mean nearest distances pred to gt and gt to pred; null where one side is empty."""
    a = nearest_squared(pred, gt, sy, sx).groupBy("scene_id").agg(F.avg(F.sqrt("d2")).alias("pred_to_gt"))
    b = nearest_squared(gt, pred, sy, sx).groupBy("scene_id").agg(F.avg(F.sqrt("d2")).alias("gt_to_pred"))
    return a.join(b, "scene_id", "full_outer").withColumn("bde", (F.col("pred_to_gt") + F.col("gt_to_pred")) / 2)


def effective_extent(boxes: DataFrame, buffer: float, width: float, height: float) -> DataFrame:
    """Bounds of the union of buffered boxes, clamped to the scene; a disjoint union is an empty box, told by ``disjoint``."""
    b = boxes.groupBy("scene_id").agg(
        (F.min("x0") - buffer).alias("xmin"), (F.min("y0") - buffer).alias("ymin"), (F.max(F.col("x0") + F.col("w")) + buffer).alias("xmax"),
        (F.max(F.col("y0") + F.col("h")) + buffer).alias("ymax"),
    )
    out = (F.col("xmin") >= width) | (F.col("ymin") >= height) | (F.col("xmax") <= 0) | (F.col("ymax") <= 0)
    return b.withColumn("disjoint", out).withColumns(
        {"xmin": B.clip(F.col("xmin").cast("double"), 0, width), "xmax": B.clip(F.col("xmax").cast("double"), 0, width),
         "ymin": B.clip(F.col("ymin").cast("double"), 0, height), "ymax": B.clip(F.col("ymax").cast("double"), 0, height)}
    )
