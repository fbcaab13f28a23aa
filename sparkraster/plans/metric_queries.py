"""Queries of pixel, boundary, distance and loss metrics, percentiles and value checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkraster.operators import metrics as M
from sparkraster.plans.registry import query, rounded
from sparkraster.plans.tile_queries import PATCH, _patches
from sparkraster.sources.views import sql, view

OK = "valid = 1 AND gt_extent <> 255"
CONF = f"""COUNT(*) FILTER ({OK} AND gt_extent = 1 AND extent_prob >= 0.5) AS tp, COUNT(*) FILTER ({OK} AND gt_extent <> 1 AND extent_prob >= 0.5) AS fp,
 COUNT(*) FILTER ({OK} AND gt_extent = 1 AND extent_prob < 0.5) AS fn, COUNT(*) FILTER ({OK} AND gt_extent <> 1 AND extent_prob < 0.5) AS tn,
 COUNT(*) FILTER (valid = 1) AS valid_px, COUNT(*) FILTER (valid <> 1) AS invalid_px, COUNT(*) FILTER (gt_extent = 255) AS ignored_px"""


def _r(a, b):
    return f"ROUND(COALESCE(({a})::DOUBLE / NULLIF({b}, 0), 0), 6)"


SCORES = f"{_r('tp', 'tp + fp + fn')} AS iou, {_r('2 * tp', '2 * tp + fp + fn')} AS f1, {_r('tp', 'tp + fp')} AS precision, {_r('tp', 'tp + fn')} AS recall"


@query(sql("px") + f", c AS (SELECT {CONF} FROM px) SELECT *, {SCORES} FROM c")
def pixel_metrics(spark, sf_dir):
    return rounded(M.pixel_metrics(view(spark, sf_dir, "px")))


@query(sql("px") + f", c AS (SELECT scene_id, {CONF} FROM px GROUP BY scene_id) SELECT *, {SCORES} FROM c")
def pixel_metrics_by_scene(spark, sf_dir):
    return rounded(M.pixel_metrics(view(spark, sf_dir, "px"), keys=["scene_id"]))


CLS = "CASE WHEN p_bg >= p_skel AND p_bg >= p_buf THEN 0 WHEN p_skel >= p_buf THEN 1 ELSE 2 END"
MODES = " UNION ALL ".join(
    f"SELECT '{p}' AS pred_mode, '{g}' AS gt_mode, COUNT(*) FILTER (({a}) AND ({b})) AS tp, COUNT(*) FILTER (({a}) AND NOT ({b})) AS fp, COUNT(*) FILTER (NOT ({a}) AND ({b})) AS fn FROM v"
    for p, a in (("not_background", "c <> 0"), ("skeleton", "c = 1"), ("by_sum", "p_skel + p_buf >= 0.5"))
    for g, b in (("any", "gt_boundary <> 0"), ("skeleton", "gt_boundary = 1"))
)


@query(
    sql("px") + f", v AS (SELECT *, {CLS} AS c FROM px WHERE valid = 1), m AS ({MODES}) SELECT pred_mode, gt_mode, tp, fp, fn, {_r('2 * tp', '2 * tp + fp + fn')} AS f1, {_r('tp', 'tp + fp')} AS precision, {_r('tp', 'tp + fn')} AS recall FROM m"
)
def boundary_metrics(spark, sf_dir):
    return rounded(M.boundary_metrics(view(spark, sf_dir, "px")))


@query(
    sql("px") + " SELECT scene_id, ROUND(AVG(ABS(distance_pred - gt_distance)) FILTER (valid = 1), 6) AS mae, ROUND(SQRT(AVG(POWER(distance_pred - gt_distance, 2)) FILTER (valid = 1)), 6) AS rmse, COUNT(*) FILTER (valid = 1) AS n FROM px GROUP BY scene_id"
)
def distance_metrics(spark, sf_dir):
    return rounded(M.distance_metrics(view(spark, sf_dir, "px"), ["scene_id"]))


CC = ", ".join(
    f"COUNT(*) FILTER (({a}) AND ({b})) AS tp_{n}, COUNT(*) FILTER (({a}) AND NOT ({b})) AS fp_{n}, COUNT(*) FILTER (NOT ({a}) AND ({b})) AS fn_{n}"
    for n, a, b in (("any", "c <> 0", "gt_boundary <> 0"), ("skeleton", "c = 1", "gt_boundary = 1"), ("buffer", "c = 2", "gt_boundary = 2"))
)


def _f1(n):
    return f"COALESCE((2 * tp_{n})::DOUBLE / NULLIF(2 * tp_{n} + fp_{n} + fn_{n}, 0), 0)"


@query(
    sql("px") + f", v AS (SELECT *, {CLS} AS c FROM px WHERE valid = 1), m AS (SELECT {CC} FROM v) SELECT *, ROUND({_f1('any')}, 6) AS f1_any, ROUND({_f1('skeleton')}, 6) AS f1_skeleton, ROUND({_f1('buffer')}, 6) AS f1_buffer, ROUND(({_f1('skeleton')} + {_f1('buffer')}) / 2, 6) AS macro2_f1 FROM m"
)
def boundary_class_metrics(spark, sf_dir):
    return rounded(M.boundary_class_metrics(view(spark, sf_dir, "px")))


LOSS = f"""v AS (SELECT *, LEAST(GREATEST(extent_prob, 1e-7), 1 - 1e-7) AS p, (gt_extent = 1)::INT::DOUBLE AS t,
 LEAST(GREATEST(CASE gt_boundary WHEN 1 THEN p_skel WHEN 2 THEN p_buf ELSE p_bg END, 1e-7), 1 - 1e-7) AS pc,
 CASE gt_boundary WHEN 1 THEN 4.0 WHEN 2 THEN 1.5 ELSE 0.5 END AS wc, (gt_boundary = 1)::INT::DOUBLE AS sy, ABS(distance_pred - gt_distance) AS d FROM px WHERE valid = 1),
 w AS (SELECT *, CASE WHEN t = 1 THEN p ELSE 1 - p END AS pt, CASE WHEN t = 1 THEN 0.25 ELSE 0.75 END AS aw FROM v),
 l AS (SELECT scene_id, AVG(-LN(pt)) FILTER (gt_extent <> 255) AS bce, AVG(-aw * POWER(1 - pt, 2) * LN(pt)) FILTER (gt_extent <> 255) AS focal,
 1 - (2 * SUM(p * t) FILTER (gt_extent <> 255) + 1) / (SUM(p + t) FILTER (gt_extent <> 255) + 1) AS dice,
 AVG(-wc * POWER(1 - pc, 2) * LN(pc)) AS boundary_ce, 1 - (2 * SUM(p_skel * sy) + 1) / (SUM(p_skel + sy) + 1) AS skeleton_dice,
 AVG(CASE WHEN d < 1 THEN 0.5 * d * d ELSE d - 0.5 END) AS distance FROM w GROUP BY scene_id)"""


@query(sql("px") + f", {LOSS} SELECT scene_id, ROUND(bce, 6) AS bce, ROUND(focal, 6) AS focal, ROUND(dice, 6) AS dice, ROUND(0.5 * focal + 0.5 * dice, 6) AS extent FROM l")
def loss_extent(spark, sf_dir):
    return rounded(M.losses(view(spark, sf_dir, "px"), ["scene_id"]).select("scene_id", "bce", "focal", "dice", "extent"))


@query(sql("px") + f", {LOSS} SELECT scene_id, ROUND(boundary_ce, 6) AS boundary_ce, ROUND(skeleton_dice, 6) AS skeleton_dice, ROUND(boundary_ce + 0.5 * skeleton_dice, 6) AS boundary FROM l")
def loss_boundary(spark, sf_dir):
    return rounded(M.losses(view(spark, sf_dir, "px"), ["scene_id"]).select("scene_id", "boundary_ce", "skeleton_dice", "boundary"))


@query(sql("px") + f", {LOSS} SELECT scene_id, ROUND(distance, 6) AS distance FROM l")
def loss_distance(spark, sf_dir):
    return rounded(M.losses(view(spark, sf_dir, "px"), ["scene_id"]).select("scene_id", "distance"))


@query(sql("px") + f", {LOSS} SELECT scene_id, ROUND(0.5 * focal + 0.5 * dice + 2.5 * (boundary_ce + 0.5 * skeleton_dice) + distance, 6) AS total FROM l")
def loss_total(spark, sf_dir):
    return rounded(M.losses(view(spark, sf_dir, "px"), ["scene_id"]).select("scene_id", "total"))


BANDS = [f"b{i}" for i in range(1, 9)]


def _valid_bands(spark, sf_dir):
    return view(spark, sf_dir, "bands").withColumn("valid", F.expr("CASE WHEN label % 3 = 0 THEN 0 ELSE 1 END"))


@query(
    sql("bands") + ", v AS (SELECT * FROM bands WHERE NOT COALESCE(label % 3 = 0, FALSE)) "
    + " UNION ALL ".join(f"SELECT {i} AS band_idx, ROUND(quantile_cont({c}, 0.005), 6) AS p_lo, ROUND(quantile_cont({c}, 0.995), 6) AS p_hi, COUNT(*) AS n_valid FROM v" for i, c in enumerate(BANDS))
)
def band_percentiles(spark, sf_dir):
    return rounded(M.band_percentiles(_valid_bands(spark, sf_dir), BANDS))


@query()
def band_percentiles_approx(spark, sf_dir):
    return M.sketch_percentiles(M.band_sketches(_valid_bands(spark, sf_dir), BANDS), BANDS)


@query()
def norm_stats_merge(spark, sf_dir):
    per_batch = M.band_sketches(_valid_bands(spark, sf_dir), BANDS, ["scene_id"])
    return M.sketch_percentiles(M.merge_sketches(per_batch, BANDS), BANDS)


@query(
    sql("px") + " SELECT scene_id, COUNT(*) FILTER (valid = 1) AS valid_px, COUNT(*) FILTER (valid <> 1) AS invalid_px, COUNT(*) AS total_px, ROUND(COUNT(*) FILTER (valid = 1)::DOUBLE / COUNT(*), 6) AS fraction FROM px GROUP BY scene_id"
)
def valid_coverage(spark, sf_dir):
    return rounded(M.valid_coverage(view(spark, sf_dir, "px"), ["scene_id"]))


@query(
    sql("bands") + ", v AS (SELECT * FROM bands WHERE NOT COALESCE(label % 3 = 0, FALSE)) SELECT i AS band_idx, (SELECT COUNT(*) FROM v) AS n_valid, TRUE AS ordered FROM generate_series(0, 7) t(i)"
)
def norm_stats_kept(spark, sf_dir):
    """Statistics of three batches, one of them sent twice, from the state kept between them."""
    from sparkraster.operators.tables import shared_dir

    path = f"{shared_dir(spark)}/state-{uuid.uuid4().hex[:12]}"
    px = _valid_bands(spark, sf_dir)
    for batch in (0, 1, 2, 1):
        M.keep_sketches(px.where(F.col("vec_id") % 3 == batch), BANDS, f"batch-{batch}", path)
    found = M.sketch_percentiles(M.kept_sketch(spark, path, BANDS), BANDS)
    return found.select("band_idx", "n_valid", (F.col("p_lo") <= F.col("p_hi")).alias("ordered"))


BROKEN = "CASE WHEN (yoff + xoff) % 5 = 0 AND p.y = yoff AND p.x = xoff THEN {bad} ELSE p.{c} END AS {c}"


def _broken(spark, sf_dir):
    """Patches in which some hold an illegal value at their corner."""
    corner = ((F.col("yoff") + F.col("xoff")) % 5 == 0) & (F.col("y") == F.col("yoff")) & (F.col("x") == F.col("xoff"))
    df = _patches(spark, sf_dir)
    return df.withColumns({"gt_boundary": F.when(corner, 7).otherwise(F.col("gt_boundary")), "gt_distance": F.when(corner, -1.0).otherwise(F.col("gt_distance"))})


CORNER = "(yoff + xoff) % 5 = 0 AND y = yoff AND x = xoff"
DOMAIN = PATCH + f""", b AS (SELECT scene_id, yoff, xoff, valid, gt_extent, CASE WHEN {CORNER} THEN 7 ELSE gt_boundary END AS gb, CASE WHEN {CORNER} THEN -1.0 ELSE gt_distance END AS gd FROM a),
 g AS (SELECT scene_id, yoff, xoff, COUNT(*) FILTER (gt_extent NOT IN (0, 1, 255)) AS e, COUNT(*) FILTER (gb NOT IN (0, 1, 2)) AS bo, COUNT(*) FILTER (valid NOT IN (0, 1)) AS va,
 COUNT(*) FILTER (gd < 0) AS nd, COUNT(*) FILTER ((gt_extent = 255) <> (valid = 0)) AS il FROM b GROUP BY ALL)"""
DOMAIN_ROWS = " UNION ALL ".join(
    f"SELECT scene_id, yoff, xoff, '{n}' AS violation FROM g WHERE {c} > 0"
    for n, c in (("extent_domain", "e"), ("boundary_domain", "bo"), ("valid_domain", "va"), ("negative_distance", "nd"), ("ignore_label", "il"))
)
PKEYS = ["scene_id", "yoff", "xoff"]


@query(sql("px") + f", {DOMAIN} {DOMAIN_ROWS}")
def domain_check(spark, sf_dir):
    return M.domain_check(_broken(spark, sf_dir), PKEYS)


LAYERS = ["gt_extent", "gt_boundary", "gt_distance"]
SHAPE = PATCH + """, g AS (SELECT scene_id, yoff, xoff, COUNT(gt_extent) AS e, COUNT(CASE WHEN gt_boundary = 1 AND y % 13 = 0 THEN NULL ELSE gt_boundary END) AS bo, COUNT(gt_distance) AS di FROM a GROUP BY ALL)"""


@query(
    sql("px") + f", {SHAPE} SELECT scene_id, yoff, xoff, 'gt_extent' AS violation FROM g WHERE e <> 256 UNION ALL SELECT scene_id, yoff, xoff, 'gt_boundary' FROM g WHERE bo <> 256 UNION ALL SELECT scene_id, yoff, xoff, 'gt_distance' FROM g WHERE di <> 256"
)
def patch_shape_check(spark, sf_dir):
    df = _patches(spark, sf_dir).withColumn("gt_boundary", F.expr("CASE WHEN gt_boundary = 1 AND y % 13 = 0 THEN NULL ELSE gt_boundary END"))
    return M.shape_check(df, PKEYS, 16, LAYERS)


@query(
    sql("px") + ", q AS (SELECT *, CASE WHEN y = 7 THEN p_bg + 0.01 ELSE p_bg END AS pb FROM px WHERE valid = 1), g AS (SELECT scene_id, COUNT(*) FILTER (extent_prob < -1e-6 OR extent_prob > 1 + 1e-6) AS e, COUNT(*) FILTER (ABS(pb + p_skel + p_buf - 1) > 5e-3) AS s FROM q GROUP BY scene_id) SELECT scene_id, 'extent_prob_range' AS violation FROM g WHERE e > 0 UNION ALL SELECT scene_id, 'simplex' FROM g WHERE s > 0"
)
def probability_check(spark, sf_dir):
    px = view(spark, sf_dir, "px").withColumn("p_bg", F.expr("CASE WHEN y = 7 THEN p_bg + 0.01e0 ELSE p_bg END"))
    return M.probability_check(px, ["scene_id"])


STATS = "s AS (SELECT label AS run, (vec_id // 10) % 8 AS band_idx, MIN(b1) AS p_lo, CASE WHEN label = 4 THEN MIN(b1) ELSE MAX(b1) END AS p_hi FROM bands WHERE label IS NOT NULL AND NOT (label = 2 AND (vec_id // 10) % 8 = 3) GROUP BY label, (vec_id // 10) % 8)"


@query(
    sql("bands") + f", {STATS}, g AS (SELECT run, COUNT(*) AS n, MIN(band_idx) AS lo, MAX(band_idx) AS hi, COUNT(*) FILTER (NOT p_hi > p_lo) AS flat FROM s GROUP BY run) SELECT run, 'not_contiguous' AS violation FROM g WHERE n <> 8 OR lo <> 0 OR hi <> 7 UNION ALL SELECT run, 'flat_range' FROM g WHERE flat > 0"
)
def norm_stats_check(spark, sf_dir):
    b = view(spark, sf_dir, "bands").where("label is not null AND NOT (label = 2 AND (vec_id div 10) % 8 = 3)")
    s = b.groupBy(F.col("label").alias("run"), F.expr("(vec_id div 10) % 8").alias("band_idx")).agg(
        F.min("b1").alias("p_lo"), F.when(F.col("label") == 4, F.min("b1")).otherwise(F.max("b1")).alias("p_hi")
    )
    return M.norm_stats_check(s, 8, ["run"])


META = "SELECT o_orderkey AS patch_id, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS xoff, CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_custkey END AS yoff, CASE WHEN o_orderkey % 23 = 0 THEN 'raw8_idx3' WHEN o_orderkey % 29 = 0 THEN NULL ELSE 'raw8' END AS feature_mode FROM orders"


@query(
    f"WITH m AS ({META}) SELECT patch_id, 'missing_xoff' AS violation FROM m WHERE xoff IS NULL UNION ALL SELECT patch_id, 'missing_yoff' FROM m WHERE yoff IS NULL UNION ALL SELECT patch_id, 'missing_feature_mode' FROM m WHERE feature_mode IS NULL UNION ALL SELECT patch_id, 'feature_mode' FROM m WHERE feature_mode IS DISTINCT FROM 'raw8'"
)
def metadata_check(spark, sf_dir):
    return M.metadata_check(_meta(spark, sf_dir), ["xoff", "yoff", "feature_mode"], "raw8", ["patch_id"])


def _meta(spark, sf_dir):
    from sparkraster.tables import table

    return table(spark, sf_dir, "orders").selectExpr(*[x.strip() for x in _split(META)])


def _split(select):
    """The expressions of a SELECT list (no commas inside parentheses here)."""
    return select.removeprefix("SELECT ").removesuffix(" FROM orders").split(", ")


@query(
    sql("px") + f", {DOMAIN}, {SHAPE.removeprefix(PATCH + ', ').replace('g AS', 'h AS')}, m AS ({META}), v AS ({DOMAIN_ROWS} UNION ALL SELECT scene_id, yoff, xoff, 'gt_extent' FROM h WHERE e <> 256 UNION ALL SELECT scene_id, yoff, xoff, 'gt_boundary' FROM h WHERE bo <> 256 UNION ALL SELECT scene_id, yoff, xoff, 'gt_distance' FROM h WHERE di <> 256 UNION ALL SELECT 0, 0, 0, 'missing_xoff' FROM m WHERE xoff IS NULL UNION ALL SELECT 0, 0, 0, 'feature_mode' FROM m WHERE feature_mode IS DISTINCT FROM 'raw8') SELECT COUNT(*) AS violations, COUNT(DISTINCT violation) AS kinds, COUNT(*) = 0 AS ok FROM v"
)
def dataset_verdict(spark, sf_dir):
    return M.verdict(
        domain_check(spark, sf_dir), patch_shape_check(spark, sf_dir), M.metadata_check(_meta(spark, sf_dir), ["xoff"], "raw8", ["patch_id"])
    )
