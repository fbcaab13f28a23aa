"""Queries of rasterization, spatial joins, object metrics and areas of interest."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkraster.operators import regions as R
from sparkraster.operators import rings as rings_of
from sparkraster.operators import spatial as S
from sparkraster.operators.tables import shared_table
from sparkraster.plans.registry import query, rounded
from sparkraster.sources.views import sql, view

GT_PX = "g AS (SELECT parcel_id AS gt_id, y, x FROM gt_rect, generate_series(y0, y0 + h - 1) t(y), generate_series(x0, x0 + w - 1) u(x))"
PR_PX = "p AS (SELECT parcel_id AS pred_id, y, x FROM pred_rect, generate_series(y0, y0 + h - 1) t(y), generate_series(x0, x0 + w - 1) u(x))"
EDGE = """e AS (SELECT g.parcel_id AS gt_id, p.parcel_id AS pred_id, (LEAST(g.x0 + g.w, p.x0 + p.w) - GREATEST(g.x0, p.x0)) * (LEAST(g.y0 + g.h, p.y0 + p.h) - GREATEST(g.y0, p.y0)) AS inter,
 g.w * g.h AS gt_area, p.w * p.h AS pred_area FROM gt_rect g JOIN pred_rect p ON g.x0 < p.x0 + p.w AND p.x0 < g.x0 + g.w AND g.y0 < p.y0 + p.h AND p.y0 < g.y0 + g.h),
 r AS (SELECT *, inter::DOUBLE / (gt_area + pred_area - inter) AS iou, inter::DOUBLE / gt_area AS ov_gt, inter::DOUBLE / pred_area AS ov_pred FROM e)"""
RULE = {
    "iou_or_overlap": "iou >= 0.1 OR (ov_gt >= 0.1 AND ov_pred >= 0.1)", "iou_and_overlap": "iou >= 0.1 AND ov_gt >= 0.1 AND ov_pred >= 0.1",
    "iou_only": "iou >= 0.1", "overlap_only": "ov_gt >= 0.1 AND ov_pred >= 0.1",
}
BOTH = sql("gt_rect", "pred_rect") + f", {EDGE}"
MATCH = BOTH + f", m AS (SELECT * FROM r WHERE {RULE['iou_or_overlap']})"


def _boxes(spark, sf_dir, name):
    """One scene. Its id is no literal: Spark drops those from keys, and what is dealt by scene would be moved again."""
    return view(spark, sf_dir, name).withColumn("scene_id", F.expr("parcel_id * 0L"))


def _edges(spark, sf_dir):
    return S.box_overlaps(_boxes(spark, sf_dir, "gt_rect"), _boxes(spark, sf_dir, "pred_rect"))


@query(sql("gt_rect") + f", {GT_PX} SELECT gt_id AS parcel_id, y, x FROM g")
def rasterize_rect(spark, sf_dir):
    return S.rasterize_boxes(_boxes(spark, sf_dir, "gt_rect")).select("parcel_id", "y", "x")


@query(sql("pred_rect") + f", {PR_PX} SELECT pred_id AS parcel_id, y, x FROM p")
def rasterize_ring(spark, sf_dir):
    corner = lambda x, y: F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x0 + w", "y0"), corner("x0 + w", "y0 + h"), corner("x0", "y0 + h"))
    return S.rasterize_rings(_boxes(spark, sf_dir, "pred_rect").withColumn("ring", ring)).select("parcel_id", "y", "x")


@query(sql("pred_rect") + f", {PR_PX} SELECT DISTINCT p.y, p.x FROM p JOIN pred_rect b ON p.pred_id = b.parcel_id WHERE p.y = y0 OR p.y = y0 + h - 1 OR p.x = x0 OR p.x = x0 + w - 1")
def rasterize_outline(spark, sf_dir):
    return S.outline_boxes(_boxes(spark, sf_dir, "pred_rect")).select("y", "x")


SLANTED = [("x0 + 0.25e0", "y0 + 0.0e0"), ("x0 + w + 0.0e0", "y0 + 1.5e0"), ("x0 + w - 1.25e0", "y0 + h + 0.0e0"), ("x0 + 0.0e0", "y0 + h - 2.75e0")]
TOUCHED = "co AS (SELECT parcel_id, [" + ", ".join(f"{{'x': {x}, 'y': {y}}}" for x, y in SLANTED) + """] AS r FROM pred_rect),
 se AS (SELECT parcel_id, r[i] AS a, r[1 + i % 4] AS b FROM co, generate_series(1, 4) t(i)),
 du AS (SELECT parcel_id, CASE WHEN a.y <= b.y THEN a ELSE b END AS p, CASE WHEN a.y <= b.y THEN b ELSE a END AS q FROM se),
 ro AS (SELECT *, unnest(generate_series(FLOOR(p.y)::BIGINT, FLOOR(q.y)::BIGINT)) AS y FROM du),
 cl AS (SELECT parcel_id, y, p.x + (GREATEST(p.y, y) - p.y) * (q.x - p.x) / (q.y - p.y) AS f, CASE WHEN q.y < y + 1 THEN q.x ELSE p.x + (y + 1 - p.y) * (q.x - p.x) / (q.y - p.y) END AS l, q.y >= y + 1 AS goes_on FROM ro)
 SELECT DISTINCT y, unnest(generate_series(FLOOR(LEAST(f, l))::BIGINT, GREATEST(FLOOR(LEAST(f, l))::BIGINT, CASE WHEN goes_on AND l >= f THEN CEIL(l)::BIGINT - 1 ELSE FLOOR(GREATEST(f, l))::BIGINT END))) AS x FROM cl"""


@query(sql("pred_rect") + f", {TOUCHED}")
def rasterize_touched(spark, sf_dir):
    ring = F.array(*[F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y")) for x, y in SLANTED])
    return S.outline_rings(_boxes(spark, sf_dir, "pred_rect").withColumn("ring", ring)).select("y", "x")


@query(BOTH + " SELECT gt_id, pred_id FROM e")
def bbox_join(spark, sf_dir):
    pairs = S.box_join(_boxes(spark, sf_dir, "gt_rect"), _boxes(spark, sf_dir, "pred_rect"), cell=64)
    return pairs.select(F.col("left_id").alias("gt_id"), F.col("right_id").alias("pred_id"))


@query(
    sql("gt_rect", "pred_rect") + f""", {GT_PX}, {PR_PX}, g2 AS (SELECT * FROM g WHERE (y * 7 + x * 3) % 11 <> 0), p2 AS (SELECT * FROM p WHERE (y * 7 + x * 3) % 11 <> 0),
    i AS (SELECT gt_id, pred_id, COUNT(*) AS inter FROM g2 JOIN p2 USING (y, x) GROUP BY ALL), ga AS (SELECT gt_id, COUNT(*) AS gt_area FROM g2 GROUP BY ALL), pa AS (SELECT pred_id, COUNT(*) AS pred_area FROM p2 GROUP BY ALL)
    SELECT gt_id, pred_id, inter, gt_area, pred_area, ROUND(inter::DOUBLE / (gt_area + pred_area - inter), 6) AS iou FROM i JOIN ga USING (gt_id) JOIN pa USING (pred_id)"""
)
def parcel_overlap(spark, sf_dir):
    g, p = (S.box_runs(_boxes(spark, sf_dir, n)) for n in ("gt_rect", "pred_rect"))
    rows = g.select("scene_id", "y", "a", "b").unionAll(p.select("scene_id", "y", "a", "b")).groupBy("scene_id", "y").agg(F.min("a").alias("lo"), F.max("b").alias("hi"))
    # 7 y + 3 x is a multiple of 11 where x - 5 y is.
    valid = rows.withColumn("k", F.explode(F.expr("sequence((lo - 5 * y) div 11 - 1, (hi - 5 * y) div 11 + 1)")))
    valid = valid.selectExpr("scene_id", "y", "greatest(lo, 5 * y + 11 * k + 1) AS a", "least(hi, 5 * y + 11 * k + 10) AS b").where("a <= b")
    return rounded(S.overlaps_of_runs(g, p, valid).select("gt_id", "pred_id", "inter", "gt_area", "pred_area", "iou"))


def _rule_query(name, rule):
    def f(spark, sf_dir):
        return S.matches(_edges(spark, sf_dir), rule).select("gt_id", "pred_id", "inter")

    f.__name__ = name
    query(BOTH + f" SELECT gt_id, pred_id, inter FROM r WHERE {RULE[rule]}")(f)


for _name, _rule in (("match_rule_or", "iou_or_overlap"), ("match_rule_and", "iou_and_overlap"), ("match_rule_iou", "iou_only"), ("match_rule_overlap", "overlap_only")):
    _rule_query(_name, _rule)


@query(MATCH + " SELECT parcel_id FROM gt_rect WHERE parcel_id NOT IN (SELECT gt_id FROM m)")
def missed_parcels(spark, sf_dir):
    return S.unmatched(_boxes(spark, sf_dir, "gt_rect"), S.matches(_edges(spark, sf_dir)), "gt_id").select("parcel_id")


@query(MATCH + " SELECT parcel_id FROM pred_rect WHERE parcel_id NOT IN (SELECT pred_id FROM m)")
def spurious_parcels(spark, sf_dir):
    return S.unmatched(_boxes(spark, sf_dir, "pred_rect"), S.matches(_edges(spark, sf_dir)), "pred_id").select("parcel_id")


OBJ = """dg AS (SELECT {k} gt_id, COUNT(*) AS d FROM m GROUP BY ALL), dp AS (SELECT {k} pred_id, COUNT(*) AS d FROM m GROUP BY ALL),
 mg AS (SELECT DISTINCT {mk} m.gt_id FROM m JOIN dp ON m.pred_id = dp.pred_id {on} WHERE dp.d >= 2)"""


@query(
    MATCH + ", " + OBJ.format(k="", mk="", on="") + """, c AS (SELECT (SELECT COUNT(*) FROM gt_rect) AS n_gt, (SELECT COUNT(*) FROM dg WHERE d >= 2) AS split_gt, (SELECT COUNT(*) FROM dp WHERE d >= 2) AS merged_pred, (SELECT COUNT(*) FROM mg) AS merged_gt)
    SELECT n_gt, split_gt, merged_pred, merged_gt, ROUND(split_gt::DOUBLE / n_gt, 6) AS goc, ROUND(merged_gt::DOUBLE / n_gt, 6) AS guc, ROUND((split_gt + merged_gt)::DOUBLE / n_gt, 6) AS gtc, ROUND(LEAST(1, (split_gt + merged_gt)::DOUBLE / n_gt), 6) AS norm_gtc FROM c"""
)
def object_metrics(spark, sf_dir):
    return rounded(S.object_metrics(_boxes(spark, sf_dir, "gt_rect"), S.matches(_edges(spark, sf_dir))).drop("scene_id"))


BUCKET = "CASE WHEN w * h < 100 THEN 'small' WHEN w * h < 160 THEN 'medium' ELSE 'large' END"


@query(
    sql("gt_rect", "pred_rect") + f""", {EDGE}, b AS (SELECT parcel_id AS gt_id, {BUCKET} AS bucket FROM gt_rect), m AS (SELECT r.*, b.bucket FROM r JOIN b USING (gt_id) WHERE {RULE['iou_or_overlap']}), """
    + OBJ.format(k="bucket,", mk="m.bucket,", on="AND m.bucket = dp.bucket")
    + """, l AS (SELECT unnest(['small', 'medium', 'large']) AS bucket), n AS (SELECT bucket, COUNT(*) AS n FROM b GROUP BY ALL), s AS (SELECT bucket, COUNT(*) AS n FROM dg WHERE d >= 2 GROUP BY ALL), q AS (SELECT bucket, COUNT(*) AS n FROM dp WHERE d >= 2 GROUP BY ALL), t AS (SELECT bucket, COUNT(*) AS n FROM mg GROUP BY ALL)
    SELECT l.bucket, COALESCE(n.n, 0) AS n_gt, COALESCE(s.n, 0) AS split_gt, COALESCE(q.n, 0) AS merged_pred, COALESCE(t.n, 0) AS merged_gt, ROUND(COALESCE((COALESCE(s.n, 0) + COALESCE(t.n, 0))::DOUBLE / NULLIF(n.n, 0), 0), 6) AS gtc
    FROM l LEFT JOIN n USING (bucket) LEFT JOIN s USING (bucket) LEFT JOIN q USING (bucket) LEFT JOIN t USING (bucket)"""
)
def object_metrics_by_bucket(spark, sf_dir):
    gt = _boxes(spark, sf_dir, "gt_rect").withColumn("bucket", S.size_bucket(F.col("w") * F.col("h"), 100, 160))
    m = S.matches(_edges(spark, sf_dir)).join(gt.select(F.col("parcel_id").alias("gt_id"), "bucket"), "gt_id")
    every = spark.createDataFrame([("small",), ("medium",), ("large",)], "bucket string")
    made = S.object_metrics(gt, m, ["bucket"])
    return rounded(every.join(made, "bucket", "left").fillna(0).select("bucket", "n_gt", "split_gt", "merged_pred", "merged_gt", "gtc"))


PX_RECT = "pr AS (SELECT k AS parcel_id, s AS scene_id, y, x FROM (SELECT DISTINCT scene_id AS s FROM px), generate_series(0, 11) a(k), generate_series((k // 4) * 15, (k // 4) * 15 + 11) t(y), generate_series((k % 4) * 24, (k % 4) * 24 + 17) u(x))"


def _scene_parcels(spark, sf_dir):
    """Runs of pixels of twelve boxes in every scene of the pixel table."""
    scenes = shared_table(view(spark, sf_dir, "px").select("scene_id").distinct())
    boxes = scenes.withColumn("parcel_id", F.explode(F.expr("sequence(0L, 11L)"))).selectExpr(
        "scene_id", "parcel_id", "(parcel_id % 4) * 24 AS x0", "(parcel_id div 4) * 15 AS y0", "18 AS w", "12 AS h"
    )
    return S.box_runs(boxes)


@query(sql("px") + f", {PX_RECT} SELECT scene_id, parcel_id, COUNT(*) FILTER (valid = 1) AS area, COUNT(*) AS covered FROM pr JOIN px USING (scene_id, y, x) GROUP BY ALL")
def parcel_valid_area(spark, sf_dir):
    return S.valid_area(_scene_parcels(spark, sf_dir), view(spark, sf_dir, "px"))


CONFIDENCE = f"""{PX_RECT}, sp AS (SELECT scene_id, MIN(distance_pred) AS lo, MAX(distance_pred) AS hi FROM px WHERE valid = 1 GROUP BY scene_id),
 z AS (SELECT scene_id, parcel_id, AVG(extent_prob) FILTER (valid = 1) AS e, AVG(LEAST(GREATEST(p_skel + p_buf, 0), 1)) FILTER (valid = 1) AS p, AVG((distance_pred - lo) / NULLIF(hi - lo, 0)) FILTER (valid = 1) AS d,
 AVG((extent_prob >= 0.5)::INT) FILTER (valid = 1) AS s, AVG((valid = 1)::INT) AS c FROM pr JOIN px USING (scene_id, y, x) JOIN sp USING (scene_id) GROUP BY ALL),
 co AS (SELECT scene_id, parcel_id, COALESCE(LEAST(GREATEST(0.5 * e + 0.2 * (1 - p) + 0.15 * d + 0.15 * s - 0.25 * (1 - c), 0), 1), 0) AS confidence FROM z)"""


@query(sql("px") + f", {CONFIDENCE} SELECT scene_id, parcel_id, ROUND(confidence, 6) AS confidence FROM co")
def polygon_confidence(spark, sf_dir):
    made = S.polygon_confidence(_scene_parcels(spark, sf_dir), view(spark, sf_dir, "px"))
    return rounded(made.select("scene_id", "parcel_id", "confidence"))


@query(sql("px") + f", {CONFIDENCE} SELECT scene_id, COUNT(*) AS n, ROUND(MIN(confidence), 6) AS lo, ROUND(MAX(confidence), 6) AS hi, ROUND(AVG(confidence), 6) AS mean, COUNT(*) FILTER (confidence < 0 OR confidence > 1) AS out_of_range FROM co GROUP BY scene_id")
def confidence_summary(spark, sf_dir):
    return rounded(S.confidence_summary(S.polygon_confidence(_scene_parcels(spark, sf_dir), view(spark, sf_dir, "px"))))


GTB = "gb AS (SELECT scene_id, y, x FROM px WHERE gt_boundary = 1 AND valid = 1)"
PRB = "pb AS (SELECT scene_id, y, x FROM px WHERE valid = 1 AND p_skel >= p_bg AND p_skel >= p_buf)"


def _sides(spark, sf_dir):
    px = view(spark, sf_dir, "px").where("valid = 1")
    return px.where("gt_boundary = 1"), px.where("p_skel >= p_bg AND p_skel >= p_buf")


@query(sql("px") + f", {GTB}, {PRB} SELECT p.scene_id, p.y, p.x, MIN((p.y - g.y) * (p.y - g.y) + (p.x - g.x) * (p.x - g.x))::DOUBLE AS d2 FROM pb p LEFT JOIN gb g ON p.scene_id = g.scene_id GROUP BY ALL")
def nearest_boundary(spark, sf_dir):
    gt, pred = _sides(spark, sf_dir)
    return S.nearest_squared(pred, gt)


@query(
    sql("px") + f""", {GTB}, {PRB}, a AS (SELECT p.scene_id, p.y, p.x, SQRT(MIN((p.y - g.y) * (p.y - g.y) + (p.x - g.x) * (p.x - g.x))) AS d FROM pb p JOIN gb g ON p.scene_id = g.scene_id GROUP BY ALL),
    b AS (SELECT g.scene_id, g.y, g.x, SQRT(MIN((p.y - g.y) * (p.y - g.y) + (p.x - g.x) * (p.x - g.x))) AS d FROM gb g JOIN pb p ON p.scene_id = g.scene_id GROUP BY ALL)
    SELECT scene_id, ROUND(x.d, 6) AS pred_to_gt, ROUND(y.d, 6) AS gt_to_pred, ROUND((x.d + y.d) / 2, 6) AS bde FROM (SELECT scene_id, AVG(d) AS d FROM a GROUP BY 1) x FULL JOIN (SELECT scene_id, AVG(d) AS d FROM b GROUP BY 1) y USING (scene_id)"""
)
def boundary_displacement(spark, sf_dir):
    gt, pred = _sides(spark, sf_dir)
    return rounded(S.boundary_displacement(gt, pred))


@query(
    sql("px") + " SELECT scene_id, y, x, COALESCE(gt_extent = 1, FALSE) AND gt_boundary <> 0 AS both_, gt_extent = 1 OR gt_boundary <> 0 AS either_, gt_extent = 1 AND gt_boundary = 0 AS only_a FROM px WHERE gt_extent = 1 OR gt_boundary <> 0"
)
def mask_set_ops(spark, sf_dir):
    px = view(spark, sf_dir, "px")
    return R.mask_sets(px.where("gt_extent = 1"), px.where("gt_boundary <> 0"))


EXTENT = "e AS (SELECT MIN(x0) - {b} AS xmin, MIN(y0) - {b} AS ymin, MAX(x0 + w) + {b} AS xmax, MAX(y0 + h) + {b} AS ymax FROM gt_rect WHERE {f})"
CLAMP = "SELECT LEAST(GREATEST(xmin, 0), 500)::DOUBLE AS xmin, LEAST(GREATEST(ymin, 0), 400)::DOUBLE AS ymin, LEAST(GREATEST(xmax, 0), 500)::DOUBLE AS xmax, LEAST(GREATEST(ymax, 0), 400)::DOUBLE AS ymax, (xmin >= 500 OR ymin >= 400 OR xmax <= 0 OR ymax <= 0) AS disjoint FROM e"


@query(sql("gt_rect") + ", " + EXTENT.format(b=30, f="TRUE") + " " + CLAMP)
def aoi_effective_extent(spark, sf_dir):
    return S.effective_extent(_boxes(spark, sf_dir, "gt_rect"), 30, 500, 400).drop("scene_id")


@query(sql("gt_rect") + ", " + EXTENT.format(b=12, f="TRUE") + " " + CLAMP)
def aoi_from_labels(spark, sf_dir):
    return S.effective_extent(_boxes(spark, sf_dir, "gt_rect"), 12, 500, 400).drop("scene_id")


SHAPES = {  # by parcel_id % 7: a bow tie, a sliver, a line; boxes otherwise
    0: (("x0", "y0"), ("x0 + w", "y0 + h"), ("x0 + w", "y0"), ("x0", "y0 + h")),
    1: (("x0", "y0"), ("x0 + 0.25e0", "y0"), ("x0 + 0.25e0", "y0 + 1000"), ("x0", "y0 + 1000")),
    2: (("x0", "y0"), ("x0 + w", "y0 + h")),
}
BOX = (("x0", "y0"), ("x0 + w", "y0"), ("x0 + w", "y0 + h"), ("x0", "y0 + h"))


def _shape_sql(point):
    lists = {k: "[" + ", ".join(point.format(x=x, y=y) for x, y in v) + "]" for k, v in (*SHAPES.items(), (None, BOX))}
    return "CASE parcel_id % 7 " + " ".join(f"WHEN {k} THEN {v}" for k, v in lists.items() if k is not None) + f" ELSE {lists[None]} END"


def _turn(a, b, c):
    return f"sign((r[{b}].x - r[{a}].x) * (r[{c}].y - r[{a}].y) - (r[{b}].y - r[{a}].y) * (r[{c}].x - r[{a}].x))"


def _cross(a, b, c, d):
    return f"({_turn(a, b, c)} * {_turn(a, b, d)} < 0 AND {_turn(c, d, a)} * {_turn(c, d, b)} < 0)"


@query(
    sql("gt_rect") + f""", s AS (SELECT parcel_id, {_shape_sql("{{'x': ({x})::DOUBLE, 'y': ({y})::DOUBLE}}")} AS r FROM gt_rect),
    f AS (SELECT *, CASE WHEN len(r) < 3 THEN 0 ELSE abs(list_sum(list_transform(generate_series(1, len(r)), lambda i: r[i].x * r[1 + i % len(r)].y - r[1 + i % len(r)].x * r[i].y))) / 2 END AS area,
     len(r) = 4 AND ({_cross(1, 2, 3, 4)} OR {_cross(2, 3, 4, 1)}) AS crosses,
     abs((r[3].x - r[1].x) * (r[2].y - r[1].y) - (r[3].y - r[1].y) * (r[2].x - r[1].x)) / sqrt(power(r[3].x - r[1].x, 2) + power(r[3].y - r[1].y, 2)) AS off FROM s)
    SELECT parcel_id, area::DOUBLE AS area, CASE WHEN len(r) < 3 THEN 'empty' WHEN crosses THEN 'invalid' WHEN area <= 100 + 1e-9 THEN 'small_area' WHEN off <= 0.5 THEN 'simplified_away' END AS reason FROM f"""
)
def parcel_cleanup_reasons(spark, sf_dir):
    """Each parcel with the reason to drop it; both other corners of a box lie equally far from its diagonal."""
    corner = lambda x, y: F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y"))
    ring = F.array(*[corner(*p) for p in BOX])
    for k, points in SHAPES.items():
        ring = F.when(F.col("parcel_id") % 7 == k, F.array(*[corner(*p) for p in points])).otherwise(ring)
    rings = _boxes(spark, sf_dir, "gt_rect").select("scene_id", "parcel_id", F.lit(0).alias("ring_no"), ring.alias("ring"))
    return rings_of.cleanup_rings(rings, 100.0, 0.5).select("parcel_id", "area", "reason")
