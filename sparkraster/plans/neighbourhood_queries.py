"""Queries of dilation, closing, distances, components and labelled regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkraster.operators import neighbourhood as N
from sparkraster.operators import regions as R
from sparkraster.operators.polygons import polygonize
from sparkraster.plans.registry import query, rounded
from sparkraster.sources.views import sql, view

H, W = 50, 100
INSIDE = "y >= 0 AND y < 50 AND x >= 0 AND x < 100"
DIA = "(SELECT a.i AS dy, b.i AS dx FROM generate_series(-3, 3) a(i), generate_series(-3, 3) b(i) WHERE ABS(a.i) + ABS(b.i) <= 3)"
DISK = "(SELECT a.i AS dy, b.i AS dx FROM generate_series(-2, 2) a(i), generate_series(-2, 2) b(i) WHERE a.i * a.i + b.i * b.i <= 4)"


@query(
    sql("px") + f""", s AS (SELECT scene_id, y, x FROM px WHERE gt_boundary = 1), n AS (SELECT DISTINCT scene_id, y + dy AS y, x + dx AS x FROM s, {DIA} o),
    k AS (SELECT * FROM n WHERE {INSIDE}) SELECT k.scene_id, k.y, k.x, CASE WHEN s.y IS NULL THEN 2 ELSE 1 END AS boundary FROM k LEFT JOIN s USING (scene_id, y, x)"""
)
def boundary_encode(spark, sf_dir):
    return N.boundary_encode(view(spark, sf_dir, "px").where("gt_boundary = 1"), H, W)


CLOSE = f"""d AS (SELECT DISTINCT scene_id, y + dy AS y, x + dx AS x FROM s, {DISK} o), k AS (SELECT * FROM d WHERE {INSIDE}),
 c AS (SELECT scene_id, y, x FROM (SELECT scene_id, y + dy AS y, x + dx AS x FROM k, {DISK} o) WHERE {INSIDE} GROUP BY ALL HAVING COUNT(*) = 13)"""


@query(sql("px") + f", s AS (SELECT scene_id, y, x FROM px WHERE gt_boundary = 1), {CLOSE} SELECT scene_id, y, x FROM c")
def boundary_closing(spark, sf_dir):
    return N.close(view(spark, sf_dir, "px").where("gt_boundary = 1"), 2, H, W)


@query(
    sql("px") + f", s AS (SELECT scene_id, y, x FROM px WHERE gt_boundary <> 0), {CLOSE} SELECT px.scene_id, px.y, px.x, CASE WHEN c.y IS NULL THEN 1.0::DOUBLE ELSE 0.0 END AS p_bg, CASE WHEN c.y IS NULL THEN 0.0::DOUBLE ELSE 1.0 END AS p_skel, 0.0::DOUBLE AS p_buf FROM px LEFT JOIN c USING (scene_id, y, x)"
)
def boundary_repair(spark, sf_dir):
    px = view(spark, sf_dir, "px").withColumns(
        {"p_skel": F.expr("CASE WHEN gt_boundary = 1 THEN 0.6e0 ELSE 0.0e0 END"), "p_buf": F.expr("CASE WHEN gt_boundary = 2 THEN 0.3e0 ELSE 0.0e0 END")}
    )
    return N.repair_boundary(px, 2, H, W).select("scene_id", "y", "x", "p_bg", "p_skel", "p_buf")


@query(
    sql("px") + """, b AS (SELECT scene_id, y AS by_, x AS bx FROM px WHERE gt_boundary = 1),
    m AS (SELECT p.scene_id, p.y, p.x, MIN((p.y - by_) * (p.y - by_) + (p.x - bx) * (p.x - bx)) AS d2 FROM px p JOIN b ON p.scene_id = b.scene_id AND ABS(p.y - by_) <= 8 AND ABS(p.x - bx) <= 8 GROUP BY ALL)
    SELECT p.scene_id, p.y, p.x, ROUND(CASE WHEN p.valid = 1 THEN LEAST(COALESCE(SQRT(d2), 8), 8) ELSE 0 END, 6)::DOUBLE AS distance FROM px p LEFT JOIN m USING (scene_id, y, x)"""
)
def distance_transform(spark, sf_dir):
    return rounded(N.distance_transform(view(spark, sf_dir, "px"), "gt_boundary = 1", 8))


@query(
    sql("px").replace("WITH ", "WITH RECURSIVE ", 1) + """, m AS (SELECT scene_id, y, x, y * 100 + x + 1 AS k FROM px WHERE valid = 1 AND extent_prob >= 0.7),
    r AS (SELECT scene_id, y, x, k AS label FROM m UNION SELECT b.scene_id, b.y, b.x, a.label FROM r a JOIN m b ON a.scene_id = b.scene_id AND ABS(a.y - b.y) + ABS(a.x - b.x) = 1 AND a.label < b.k)
    SELECT scene_id, y, x, MIN(label) AS label FROM r GROUP BY ALL"""
)
def connected_components(spark, sf_dir):
    return N.connected_components(view(spark, sf_dir, "px").where("valid = 1 AND extent_prob >= 0.7"), W, H)


LABELS = "la AS (SELECT scene_id, y, x, CASE WHEN valid = 0 THEN -1 WHEN extent_prob >= 0.3 THEN (y // 6) * 20 + x // 9 + 3 ELSE 0 END AS label FROM px)"


def _labels(spark, sf_dir):
    return view(spark, sf_dir, "px").selectExpr(
        "scene_id", "y", "x", "CASE WHEN valid = 0 THEN -1L WHEN extent_prob >= 0.3 THEN (y div 6) * 20 + x div 9 + 3 ELSE 0L END AS label"
    )


@query(sql("px") + f", {LABELS}, n AS (SELECT scene_id, label, COUNT(*) AS n FROM la WHERE label > 0 GROUP BY ALL) SELECT scene_id, y, x, CASE WHEN n < 30 THEN 0 ELSE label END AS label FROM la LEFT JOIN n USING (scene_id, label)")
def filter_small_regions(spark, sf_dir):
    return R.filter_small(_labels(spark, sf_dir), 30)


@query(sql("px") + f", {LABELS}, n AS (SELECT scene_id, label, ROW_NUMBER() OVER (PARTITION BY scene_id ORDER BY label) AS new FROM (SELECT DISTINCT scene_id, label FROM la WHERE label > 0)) SELECT scene_id, y, x, COALESCE(new, label) AS label FROM la LEFT JOIN n USING (scene_id, label)")
def compact_relabel(spark, sf_dir):
    return R.compact(_labels(spark, sf_dir))


SIDES = "(SELECT * FROM (VALUES (0, -1, 0), (1, 0, 1), (2, 1, 0), (3, 0, -1)) s(side, dy, dx))"
EDGES = f"ed AS (SELECT a.scene_id, a.label, side, a.y, a.x FROM la a CROSS JOIN {SIDES} s LEFT JOIN la b ON a.scene_id = b.scene_id AND b.y = a.y + dy AND b.x = a.x + dx AND b.label = a.label WHERE a.label > 0 AND b.label IS NULL)"


@query(sql("px") + f", {LABELS}, {EDGES} SELECT * FROM ed")
def label_edges(spark, sf_dir):
    return R.edges(_labels(spark, sf_dir))


FACTS = "f AS (SELECT scene_id, label, MIN(y) AS ymin, MAX(y) AS ymax, MIN(x) AS xmin, MAX(x) AS xmax, COUNT(*) AS area FROM la WHERE label > 0 GROUP BY ALL), pe AS (SELECT scene_id, label, COUNT(*) AS perimeter FROM ed GROUP BY ALL)"


@query(sql("px") + f", {LABELS}, {EDGES}, {FACTS} SELECT * FROM f JOIN pe USING (scene_id, label)")
def parcel_shape_facts(spark, sf_dir):
    return R.shape_facts(_labels(spark, sf_dir))


@query(sql("px") + f", {LABELS}, {EDGES}, {FACTS} SELECT scene_id, label, area::DOUBLE AS area, perimeter FROM f JOIN pe USING (scene_id, label)")
def polygonize_labels(spark, sf_dir):
    """Area by the shoelace formula and perimeter of the traced rings, which SQL counts in pixels and edges."""
    rings = polygonize(_labels(spark, sf_dir)).select("scene_id", "label", F.explode(R_edges(F.col("points"))).alias("e"))
    cross = F.col("e.ax") * F.col("e.by") - F.col("e.bx") * F.col("e.ay")
    length = F.abs(F.col("e.ax") - F.col("e.bx")) + F.abs(F.col("e.ay") - F.col("e.by"))
    return rings.groupBy("scene_id", "label").agg((F.sum(cross) / 2).alias("area"), F.sum(length).cast("long").alias("perimeter"))


def R_edges(points):
    from sparkraster.operators.spatial import _edges

    return _edges(points)


@query(
    sql("px") + f", {LABELS}, f AS (SELECT scene_id, label, COUNT(*) AS area FROM la WHERE label > 0 GROUP BY ALL), c AS (SELECT CASE WHEN area <= 30 + 1e-9 THEN 'small_area' END AS reason FROM f) SELECT COALESCE(reason, 'kept') AS reason, COUNT(*) AS parcels FROM c GROUP BY ALL"
)
def parcel_cleanup(spark, sf_dir):
    parcels = R.label_sizes(_labels(spark, sf_dir)).withColumnRenamed("n", "area")
    return R.cleanup(parcels, 30).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("parcels"))


RING = """v AS (SELECT parcel_id, k AS pos, CASE k WHEN 0 THEN x0 WHEN 1 THEN x0 + w // 2 WHEN 2 THEN x0 + w WHEN 3 THEN x0 + w ELSE x0 END AS x, CASE k WHEN 0 THEN y0 WHEN 1 THEN y0 WHEN 2 THEN y0 WHEN 3 THEN y0 + h WHEN 4 THEN y0 + h ELSE y0 + h // 2 END AS y FROM gt_rect, generate_series(0, 5) t(k))"""


@query(sql("gt_rect") + f", {RING} SELECT parcel_id, pos, x, y FROM v WHERE pos NOT IN (1, 5)")
def ring_simplify(spark, sf_dir):
    v = view(spark, sf_dir, "gt_rect").withColumn("pos", F.explode(F.expr("sequence(0L, 5L)"))).selectExpr(
        "parcel_id", "pos", "CASE pos WHEN 0 THEN x0 WHEN 1 THEN x0 + w div 2 WHEN 2 THEN x0 + w WHEN 3 THEN x0 + w ELSE x0 END AS x",
        "CASE pos WHEN 0 THEN y0 WHEN 1 THEN y0 WHEN 2 THEN y0 WHEN 3 THEN y0 + h WHEN 4 THEN y0 + h ELSE y0 + h div 2 END AS y",
    )
    return R.simplify(v, ["parcel_id"])


@query(sql("px") + f", {LABELS}, b AS (SELECT scene_id, CASE WHEN label = 7 THEN -5 ELSE label END AS label FROM la) SELECT scene_id, label, COUNT(*) AS n FROM b WHERE label < 0 AND label <> -1 GROUP BY ALL")
def instance_label_check(spark, sf_dir):
    bad = _labels(spark, sf_dir).withColumn("label", F.expr("CASE WHEN label = 7 THEN -5L ELSE label END"))
    return R.illegal_labels(bad)


@query()
def seeded_growth(spark, sf_dir):
    """Parcels grown from the components of marker pixels; a spanning forest has no SQL, so a test uses brute force."""
    from sparkraster.functions import bands as B
    from sparkraster.operators import growth, pixels

    px = pixels.relief_surface(view(spark, sf_dir, "px"), barrier=0.7)
    inside = (F.col("extent_prob") >= 0.5) & (F.col("valid") == 1) & (B.presence(F.col("p_skel"), F.col("p_buf")) <= 0.7)
    markers = N.connected_components(pixels.marker_candidates(px), W, H)
    return growth.grow(px.withColumn("inside", inside), markers, H, W)
