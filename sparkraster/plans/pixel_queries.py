"""Queries of the per-pixel operators over the derived pixel tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkraster.operators import metrics as M
from sparkraster.operators import pixels as P
from sparkraster.plans.registry import query, rounded
from sparkraster.sources.views import sql, view

GT = [599800.0, 25.0, 0.0, 4400200.0, 0.0, -25.0]
NDVI = "(b7 - b5) / (b7 + b5 + 1e-6)"
SAVI = "1.5 * (b7 - b5) / (b7 + b5 + 0.5 + 1e-6)"
NDWI = "(b3 - b7) / (b3 + b7 + 1e-6)"
PRES = "LEAST(GREATEST(p_skel + p_buf, 0), 1)"
MARK = f"extent_prob >= 0.6 AND {PRES} <= 0.5 AND distance_pred >= 2.0 AND valid = 1"
DOMAIN = f"extent_prob >= 0.5 AND valid = 1 AND {PRES} <= 0.7"


@query(sql("px") + " SELECT scene_id, y, x, valid, gt_extent FROM px WHERE y >= 4 AND y < 24 AND x >= 8 AND x < 68")
def scan_bounds_window(spark, sf_dir):
    window = P.bounds_to_window(GT, 100, 50, (600000.0, 4399600.0, 601500.0, 4400100.0))
    return P.scan_window(view(spark, sf_dir, "px"), window).select("scene_id", "y", "x", "valid", "gt_extent")


EXTENTS = "(SELECT scene_id, MIN(y) AS y0, MAX(y) + 1 AS y1, MIN(x) AS x0, MAX(x) + 1 AS x1 FROM px WHERE gt_boundary = 2 AND x BETWEEN 20 AND 60 AND y > scene_id * 3 GROUP BY scene_id)"


@query(sql("px") + f" SELECT p.scene_id, p.y, p.x, p.valid FROM px p JOIN {EXTENTS} e ON p.scene_id = e.scene_id WHERE p.y >= y0 AND p.y < y1 AND p.x >= x0 AND p.x < x1")
def aoi_window(spark, sf_dir):
    px = view(spark, sf_dir, "px")
    extents = px.where("gt_boundary = 2 AND x BETWEEN 20 AND 60 AND y > scene_id * 3").groupBy("scene_id").agg(
        F.min("y").alias("y0"), (F.max("y") + 1).alias("y1"), F.min("x").alias("x0"), (F.max("x") + 1).alias("x1")
    )
    return P.aoi_window(px, extents).select("scene_id", "y", "x", "valid")


WORLD = "SELECT parcel_id, 100.0 + x0 * 2.5 + 0.7 AS xmin, 100.0 + (x0 + w) * 2.5 AS xmax, 900.0 - (y0 + h) * 2.5 AS ymin, 900.0 - y0 * 2.5 - 0.3 AS ymax FROM gt_rect"


@query(
    sql("gt_rect") + f""", w AS ({WORLD}) SELECT parcel_id,
    LEAST(GREATEST(FLOOR((xmin - 100.0) / 2.5), 0), 500)::BIGINT AS col0, LEAST(GREATEST(CEIL((xmax - 100.0) / 2.5), 0), 500)::BIGINT AS col1,
    LEAST(GREATEST(FLOOR((ymax - 900.0) / -2.5), 0), 800)::BIGINT AS row0, LEAST(GREATEST(CEIL((ymin - 900.0) / -2.5), 0), 800)::BIGINT AS row1 FROM w"""
)
def pixel_world_bounds(spark, sf_dir):
    rects = view(spark, sf_dir, "gt_rect").selectExpr(
        "parcel_id", "100.0e0 + x0 * 2.5e0 + 0.7e0 AS xmin", "100.0e0 + (x0 + w) * 2.5e0 AS xmax",
        "900.0e0 - (y0 + h) * 2.5e0 AS ymin", "900.0e0 - y0 * 2.5e0 - 0.3e0 AS ymax",
    )
    out = P.world_bounds_to_pixels(rects, [100.0, 2.5, 0.0, 900.0, 0.0, -2.5], 500, 800)
    return out.select("parcel_id", "col0", "col1", "row0", "row1")


@query(
    sql("px") + """ SELECT scene_id, y // 5 AS oy, x // 5 AS ox, ROUND(AVG(extent_prob), 6) AS extent_prob, ROUND(AVG(p_bg), 6) AS p_bg, COUNT(*) AS n
    FROM px GROUP BY ALL"""
)
def raster_overview_avg(spark, sf_dir):
    return rounded(P.overview(view(spark, sf_dir, "px"), 5, ["extent_prob", "p_bg"], []))


@query(
    sql("px") + """ SELECT scene_id, y // 5 AS oy, x // 5 AS ox, gt_extent, gt_boundary FROM (SELECT *, ROW_NUMBER() OVER (
    PARTITION BY scene_id, y // 5, x // 5 ORDER BY ABS(y % 5 - 2) + ABS(x % 5 - 2), y, x) AS r FROM px) WHERE r = 1"""
)
def raster_overview_nearest(spark, sf_dir):
    return P.overview(view(spark, sf_dir, "px"), 5, [], ["gt_extent", "gt_boundary"]).drop("n")


CELLS = "c AS (SELECT *, ((2 * y + 1) * 22) // 100 AS oy, ((2 * x + 1) * 44) // 200 AS ox FROM px)"
OFF = "ABS((2 * y + 1) * 22 - (2 * oy + 1) * 50) / 44.0 + ABS((2 * x + 1) * 44 - (2 * ox + 1) * 100) / 88.0"


@query(
    sql("px") + f""", {CELLS}, n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY scene_id, oy, ox ORDER BY {OFF}, y, x) AS r FROM c)
    SELECT scene_id, oy, ox, AVG(distance_pred) AS distance_pred, MAX(CASE WHEN r = 1 THEN gt_boundary END) AS gt_boundary, COUNT(*) AS n FROM n GROUP BY ALL"""
)
def raster_preview(spark, sf_dir):
    """Scenes of 50 x 100 pixels in previews of at most 1000, which are 22 x 44."""
    px = view(spark, sf_dir, "px")
    scenes = px.select("scene_id").distinct().withColumns({"height": F.lit(50), "width": F.lit(100)})
    return P.preview(px, scenes, ["distance_pred"], ["gt_boundary"], budget=1000)


@query(sql("bands") + " SELECT vec_id, CASE WHEN label <> 0 THEN 1 ELSE 0 END AS by_mask, CASE WHEN b1 <> 1.0 THEN 1 ELSE 0 END AS by_nodata, CASE WHEN label % 3 <> 0 THEN 1 ELSE 0 END AS by_override FROM bands")
def valid_mask_predict(spark, sf_dir):
    """The first of mask, nodata and override that there is decides alone."""
    px = view(spark, sf_dir, "bands").withColumn("force", F.expr("label % 3"))
    every = {"by_mask": {"mask": "label", "nodata": 1.0, "override": "force"}, "by_nodata": {"nodata": 1.0, "override": "force"}, "by_override": {"override": "force"}}
    for name, given in every.items():
        px = P.valid_mask(px, mode="predict", **given).withColumnRenamed("valid", name)
    return px.select("vec_id", *every)


@query(sql("px") + " SELECT scene_id, y, x, CASE WHEN valid = 1 THEN gt_boundary % 2 ELSE 255 END AS gt_extent FROM px")
def ignore_label_stamp(spark, sf_dir):
    return P.stamp_ignore(view(spark, sf_dir, "px").withColumn("gt_extent", F.expr("gt_boundary % 2"))).select("scene_id", "y", "x", "gt_extent")


@query(sql("bands") + " SELECT vec_id, CASE WHEN label <> 0 AND b1 <> 1.0 THEN 1 ELSE 0 END AS valid FROM bands")
def valid_mask(spark, sf_dir):
    return P.valid_mask(view(spark, sf_dir, "bands"), mask="label", nodata=1.0).select("vec_id", "valid")


@query(sql("bands") + f" SELECT vec_id, ROUND({NDVI}, 6) AS ndvi, ROUND({SAVI}, 6) AS savi, ROUND({NDWI}, 6) AS ndwi FROM bands")
def band_indices(spark, sf_dir):
    return rounded(P.band_indices(view(spark, sf_dir, "bands")).select("vec_id", "ndvi", "savi", "ndwi"))


@query(
    sql("bands") + f""", v AS (SELECT *, CASE WHEN label % 3 = 0 THEN 0 ELSE 1 END AS valid FROM bands)
    SELECT vec_id, CASE WHEN valid = 1 THEN ROUND({NDVI}, 6) ELSE 0 END AS ndvi, CASE WHEN valid = 1 THEN ROUND({SAVI}, 6) ELSE 0 END AS savi,
    CASE WHEN valid = 1 THEN ROUND({NDWI}, 6) ELSE 0 END AS ndwi, CASE WHEN valid = 1 THEN ROUND(b1, 6) ELSE 0 END AS b1 FROM v"""
)
def band_indices_masked(spark, sf_dir):
    px = view(spark, sf_dir, "bands").withColumn("valid", F.expr("CASE WHEN label % 3 = 0 THEN 0 ELSE 1 END"))
    return rounded(P.band_indices(px, masked=True).select("vec_id", "ndvi", "savi", "ndwi", "b1"))


def _stats(px, columns):
    """Percentiles of valid pixels, one row per band."""
    return M.band_percentiles(px, columns).select("band_idx", "p_lo", "p_hi")


VALID_BANDS = "v AS (SELECT *, CASE WHEN label % 3 = 0 THEN 0 ELSE 1 END AS valid FROM bands)"
QS = "q AS (SELECT " + ", ".join(f"quantile_cont(b{i}, 0.005) AS l{i}, quantile_cont(b{i}, 0.995) AS h{i}" for i in range(1, 9)) + " FROM v WHERE valid = 1)"


def _scaled(i, low=0):
    return f"CASE WHEN valid = 1 THEN COALESCE((LEAST(GREATEST(b{i}, l{i}), h{i}) - l{i}) / NULLIF(h{i} - l{i}, 0), 0) ELSE {low} END"


@query(sql("bands") + f", {VALID_BANDS}, {QS} SELECT vec_id, " + ", ".join(f"ROUND({_scaled(i)}, 6) AS b{i}" for i in range(1, 9)) + " FROM v, q")
def normalize_bands(spark, sf_dir):
    px = view(spark, sf_dir, "bands").withColumn("valid", F.expr("CASE WHEN label % 3 = 0 THEN 0 ELSE 1 END"))
    columns = [f"b{i}" for i in range(1, 9)]
    return rounded(P.normalize_bands(px, _stats(px, columns), columns).select("vec_id", *columns))


@query(sql("bands") + f", {VALID_BANDS} SELECT vec_id, 9 AS channels, ROUND({' + '.join(f'b{i}' for i in range(1, 9))} + valid, 6) AS total FROM v")
def assemble_input(spark, sf_dir):
    px = view(spark, sf_dir, "bands").withColumn("valid", F.expr("CASE WHEN label % 3 = 0 THEN 0 ELSE 1 END"))
    made = P.assemble_input(px, [f"b{i}" for i in range(1, 9)], 9)
    total = F.aggregate("features", F.lit(0.0), lambda a, b: a + b)
    return rounded(made.select("vec_id", F.size("features").alias("channels"), total.alias("total")))


CLS = "CASE WHEN p_bg >= p_skel AND p_bg >= p_buf THEN 0 WHEN p_skel >= p_buf THEN 1 ELSE 2 END"


@query(
    sql("px") + f""" SELECT scene_id, y, x, ({CLS} <> 0)::INT AS not_background, ({CLS} = 1)::INT AS skeleton,
    (p_skel + p_buf >= 0.5)::INT AS by_sum FROM px"""
)
def boundary_decision_modes(spark, sf_dir):
    return P.boundary_decisions(view(spark, sf_dir, "px")).select("scene_id", "y", "x", "not_background", "skeleton", "by_sum")


@query(sql("px") + f" SELECT scene_id, y, x FROM px WHERE {MARK}")
def marker_candidates(spark, sf_dir):
    return P.marker_candidates(view(spark, sf_dir, "px")).select("scene_id", "y", "x")


@query(
    sql("px") + f""" SELECT scene_id, COUNT(*) FILTER (valid = 1) AS valid_px, COUNT(*) FILTER (valid = 1 AND extent_prob >= 0.6) AS extent_px,
    COUNT(*) FILTER (valid = 1 AND {PRES} <= 0.5) AS presence_px, COUNT(*) FILTER (valid = 1 AND distance_pred >= 2.0) AS distance_px,
    COUNT(*) FILTER ({MARK}) AS markers,
    ROUND(COALESCE(COUNT(*) FILTER ({MARK})::DOUBLE / NULLIF(COUNT(*) FILTER (valid = 1), 0), 0), 6) AS marker_ratio FROM px GROUP BY scene_id"""
)
def marker_diagnostics(spark, sf_dir):
    return rounded(P.marker_diagnostics(view(spark, sf_dir, "px")))


@query(sql("px") + f" SELECT scene_id, y, x FROM px WHERE {DOMAIN}")
def growth_domain(spark, sf_dir):
    return P.growth_domain(view(spark, sf_dir, "px"), barrier=0.7).select("scene_id", "y", "x")


@query(
    sql("px") + f""", d AS (SELECT *, MIN(distance_pred) FILTER (valid = 1) OVER (PARTITION BY scene_id) AS lo,
    MAX(distance_pred) FILTER (valid = 1) OVER (PARTITION BY scene_id) AS hi FROM px),
    r AS (SELECT *, ({DOMAIN}) AS inside, {PRES} + 0.5 * (1 - extent_prob) + 0.5 * (1 - COALESCE((distance_pred - lo) / NULLIF(hi - lo, 0), 0)) AS raw FROM d),
    m AS (SELECT *, MAX(raw) FILTER (inside) OVER (PARTITION BY scene_id) AS top_in FROM r),
    v AS (SELECT *, CASE WHEN inside THEN raw ELSE COALESCE(top_in, 0) + 1 END AS val FROM m),
    s AS (SELECT *, MIN(val) OVER (PARTITION BY scene_id) AS v0, MAX(val) OVER (PARTITION BY scene_id) AS v1 FROM v)
    SELECT scene_id, y, x, FLOOR(COALESCE((val - v0) / NULLIF(v1 - v0, 0), 0) * 255)::INT AS relief FROM s"""
)
def relief_surface(spark, sf_dir):
    return P.relief_surface(view(spark, sf_dir, "px"), barrier=0.7).select("scene_id", "y", "x", "relief")


@query(
    sql("px") + """ SELECT scene_id, y, x, CASE WHEN EXISTS (SELECT 1 FROM px a WHERE a.scene_id = p.scene_id AND a.y = p.y AND a.x = p.x
    AND a.gt_boundary <> 0) THEN valid ELSE 0 END AS valid FROM px p"""
)
def aoi_suppression(spark, sf_dir):
    px = view(spark, sf_dir, "px")
    return P.aoi_suppression(px, px.where("gt_boundary <> 0")).select("scene_id", "y", "x", "valid")


E3 = "EXP(b2 - GREATEST(b2, b3, b4)) + EXP(b3 - GREATEST(b2, b3, b4)) + EXP(b4 - GREATEST(b2, b3, b4))"


@query(
    sql("bands") + f""" SELECT vec_id, ROUND(1 / (1 + EXP(-b1)), 6) AS extent_prob, ROUND(EXP(b2 - GREATEST(b2, b3, b4)) / ({E3}), 6) AS p_bg,
    ROUND(EXP(b3 - GREATEST(b2, b3, b4)) / ({E3}), 6) AS p_skel, ROUND(EXP(b4 - GREATEST(b2, b3, b4)) / ({E3}), 6) AS p_buf FROM bands"""
)
def logit_activations(spark, sf_dir):
    made = P.logit_activations(view(spark, sf_dir, "bands"), "b1", ("b2", "b3", "b4"))
    return rounded(made.select("vec_id", "extent_prob", "p_bg", "p_skel", "p_buf"))


@query(
    sql("px") + """, h AS (SELECT scene_id, y, x, (y // 10) * 10 + x // 10 AS patch, y % 10 AS py, x % 10 AS px_,
    md5('42:' || (scene_id * 100 + (y // 10) * 10 + x // 10)::VARCHAR) AS m FROM px),
    b AS (SELECT *, ('0x' || m[1])::INT % 2 AS fh, ('0x' || m[2])::INT % 2 AS fv, ('0x' || m[3])::INT % 4 AS k FROM h),
    f AS (SELECT *, CASE WHEN fh = 1 THEN 9 - px_ ELSE px_ END AS x1, CASE WHEN fv = 1 THEN 9 - py ELSE py END AS y1 FROM b)
    SELECT scene_id * 100 + patch AS patch_id, py AS y, px_ AS x, CASE k WHEN 0 THEN y1 WHEN 1 THEN 9 - x1 WHEN 2 THEN 9 - y1 ELSE x1 END AS ny,
    CASE k WHEN 0 THEN x1 WHEN 1 THEN y1 WHEN 2 THEN 9 - x1 ELSE 9 - y1 END AS nx FROM f"""
)
def augment_patches(spark, sf_dir):
    px = view(spark, sf_dir, "px").selectExpr(
        "scene_id * 100 + (y div 10) * 10 + x div 10 AS patch_id", "y % 10 AS y", "x % 10 AS x"
    )
    return P.augment(px, 10).select("patch_id", "y", "x", "ny", "nx")


@query(
    sql("bands") + """, s AS (SELECT label AS band_idx, MIN(b1) AS p_lo, MAX(b1) AS p_hi, 'explicit' AS origin, 0 AS r FROM bands WHERE label IS NOT NULL AND label % 3 = 0 GROUP BY label
    UNION ALL SELECT label, MIN(b2), MAX(b2), 'embedded', 1 FROM bands WHERE label IS NOT NULL AND label % 2 = 0 GROUP BY label UNION ALL
    SELECT label, MIN(b3), MAX(b3), 'stats_source', 2 FROM bands WHERE label IS NOT NULL GROUP BY label)
    SELECT band_idx, ROUND(p_lo, 6) AS p_lo, ROUND(p_hi, 6) AS p_hi, origin FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY band_idx ORDER BY r) AS n FROM s) WHERE n = 1"""
)
def norm_stats_priority(spark, sf_dir):
    px = view(spark, sf_dir, "bands").where("label is not null")

    def stats(band, keep, origin):
        return px.where(keep).groupBy(F.col("label").alias("band_idx")).agg(
            F.min(band).alias("p_lo"), F.max(band).alias("p_hi")
        ).withColumn("origin", F.lit(origin))

    return rounded(
        P.norm_stats_priority(
            stats("b1", "label % 3 = 0", "explicit"), stats("b2", "label % 2 = 0", "embedded"), stats("b3", "true", "stats_source")
        )
    )


@query(sql("px") + " SELECT scene_id, y, x, valid, distance_pred FROM px WHERE scene_id = 1 AND y >= 10 AND y < 30 AND x >= 40 AND x < 70")
def clustered_window(spark, sf_dir):
    """A window of one scene out of all pixels, written in the clustered layout and read through its row groups."""
    import uuid

    from sparkraster.operators.tables import shared_dir
    from sparkraster.sources import layout

    path = f"{shared_dir(spark)}/pixels-{uuid.uuid4().hex[:12]}"
    layout.write_clustered(view(spark, sf_dir, "px").select("scene_id", "y", "x", "valid", "distance_pred"), path, cell=16)
    return layout.scan_clustered(spark, path, 1, (10, 30, 40, 70), cell=16)
