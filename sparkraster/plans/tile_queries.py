"""Queries of windows, tiles, patches, their classes, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkraster.operators import sampling as G
from sparkraster.operators import tiling as T
from sparkraster.plans.registry import query, rounded
from sparkraster.sources.views import sql, view

H, W = 50, 100


def _axis(name, n, size, stride):
    return f"{name} AS (SELECT DISTINCT off FROM (SELECT unnest(generate_series(0, {n - size}, {stride})) AS off UNION ALL SELECT {n - size}))"


def _windows(size, stride):
    return f"{_axis('ys', H, size, stride)}, {_axis('xs', W, size, stride)}, sc AS (SELECT DISTINCT scene_id FROM px), win AS (SELECT scene_id, ys.off AS yoff, xs.off AS xoff FROM sc, ys, xs)"


def _scenes(spark, sf_dir):
    return view(spark, sf_dir, "px").select("scene_id").distinct().withColumns({"height": F.lit(H), "width": F.lit(W)})


@query(sql("px") + f", {_windows(16, 8)} SELECT scene_id, yoff, xoff FROM win")
def patch_windows(spark, sf_dir):
    return T.windows(_scenes(spark, sf_dir), 16)


@query(sql("px") + f", {_windows(24, 18)} SELECT scene_id, yoff, xoff FROM win")
def tile_windows(spark, sf_dir):
    return T.windows(_scenes(spark, sf_dir), 24, T.tile_stride(24, 0.25), small=True)


COVER = "p.y >= yoff AND p.y < yoff + {s} AND p.x >= xoff AND p.x < xoff + {s}"


@query(
    sql("px") + f", {_windows(24, 18)} SELECT p.scene_id, p.y, p.x, yoff, xoff FROM px p JOIN win w ON p.scene_id = w.scene_id AND {COVER.format(s=24)}"
)
def pixels_to_tiles(spark, sf_dir):
    return T.assign(view(spark, sf_dir, "px"), H, W, 24, 18).select("scene_id", "y", "x", "yoff", "xoff")


@query(
    sql("px") + f""", {_windows(24, 18)} SELECT p.scene_id, yoff, xoff, COUNT(*) AS pixels,
    COUNT(*) FILTER ({COVER.format(s=24)}) AS core FROM px p JOIN win w ON p.scene_id = w.scene_id AND p.y >= yoff - 3 AND p.y < yoff + 27 AND p.x >= xoff - 3 AND p.x < xoff + 27
    GROUP BY p.scene_id, yoff, xoff"""
)
def tile_halo_counts(spark, sf_dir):
    a = T.assign(view(spark, sf_dir, "px"), H, W, 24, 18, halo=3)
    return a.groupBy("scene_id", "yoff", "xoff").agg(F.count("*").alias("pixels"), F.sum("is_core").cast("long").alias("core"))


WEIGHT = "EXP(-(POWER(p.y - yoff - 11.5, 2) + POWER(p.x - xoff - 11.5, 2)) / 72.0) * valid"


@query(
    sql("px") + f""", {_windows(24, 18)}, a AS (SELECT p.*, yoff, xoff, {WEIGHT} AS wt, extent_prob * (1 + (yoff + xoff) % 7 / 10.0) AS pred
    FROM px p JOIN win w ON p.scene_id = w.scene_id AND {COVER.format(s=24)})
    SELECT scene_id, y, x, ROUND(COALESCE(SUM(pred * wt) / NULLIF(SUM(wt), 0), 0), 6) AS pred, COUNT(*) AS n_tiles FROM a GROUP BY scene_id, y, x"""
)
def gaussian_blend(spark, sf_dir):
    a = T.assign(view(spark, sf_dir, "px"), H, W, 24, 18)
    a = a.withColumn("pred", F.col("extent_prob") * (1 + ((F.col("yoff") + F.col("xoff")) % 7) / 10.0))
    return rounded(T.blend(a, ["pred"], 24))


@query(
    sql("px") + f""", {_windows(8, 6)}, t AS (SELECT p.scene_id, yoff, xoff, MAX(CASE WHEN p.gt_boundary = 2 THEN 1 ELSE 0 END) AS v FROM px p
    JOIN win w ON p.scene_id = w.scene_id AND {COVER.format(s=8)} GROUP BY ALL)
    SELECT scene_id, COUNT(*) AS tiles, COUNT(*) FILTER (v = 1) AS processed FROM t GROUP BY scene_id"""
)
def tile_coverage(spark, sf_dir):
    px = view(spark, sf_dir, "px").withColumn("valid", (F.col("gt_boundary") == 2).cast("int"))
    return T.tile_coverage(T.assign(px, H, W, 8, 6))


@query(
    sql("px") + f""", {_windows(24, 18)} SELECT p.scene_id, p.y, p.x, yoff, xoff, ROUND(0.5 * extent_prob - 0.25 * p_bg + 0.125 * distance_pred, 6) AS score
    FROM px p JOIN win w ON p.scene_id = w.scene_id AND {COVER.format(s=24)}"""
)
def score_tiles_linear(spark, sf_dir):
    a = T.assign(view(spark, sf_dir, "px"), H, W, 24, 18)
    made = T.score_tiles(a, ["extent_prob", "p_bg", "distance_pred"], lambda bands, mask: 0.5 * bands[0] - 0.25 * bands[1] + 0.125 * bands[2], 24)
    return rounded(made.select("scene_id", "y", "x", "yoff", "xoff", "score"))


@query(
    sql("px") + f""", {_windows(24, 18)}, a AS (SELECT p.scene_id, p.y, p.x, yoff, xoff, valid, distance_pred, {COVER.format(s=24)} AS core
    FROM px p JOIN win w ON p.scene_id = w.scene_id AND p.y >= yoff - 1 AND p.y < yoff + 25 AND p.x >= xoff - 1 AND p.x < xoff + 25),
    live AS (SELECT DISTINCT scene_id, yoff, xoff FROM a WHERE core AND valid = 1)
    SELECT a.scene_id, a.yoff, a.xoff, a.y, a.x, ROUND(COALESCE(SUM(b.distance_pred * b.valid) / NULLIF(SUM(b.valid), 0), 0), 6) AS score
    FROM a JOIN live USING (scene_id, yoff, xoff) JOIN a b ON a.scene_id = b.scene_id AND a.yoff = b.yoff AND a.xoff = b.xoff AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1
    WHERE a.core GROUP BY ALL"""
)
def score_tiles_filter(spark, sf_dir):
    a = T.assign(view(spark, sf_dir, "px"), H, W, 24, 18, halo=1)
    return rounded(T.score_tiles(a, ["distance_pred"], T.mean_filter, 24, halo=1).select("scene_id", "yoff", "xoff", "y", "x", "score"))


@query(
    sql("px") + f""", {_windows(24, 18)}, a AS (SELECT p.scene_id, p.y, p.x, yoff, xoff, valid, distance_pred, {COVER.format(s=24)} AS core
    FROM px p JOIN win w ON p.scene_id = w.scene_id AND p.y >= yoff - 1 AND p.y < yoff + 25 AND p.x >= xoff - 1 AND p.x < xoff + 25),
    live AS (SELECT DISTINCT scene_id, yoff, xoff FROM a WHERE core AND valid = 1),
    f AS (SELECT a.scene_id, a.yoff, a.xoff, a.y, a.x, ANY_VALUE(a.valid) AS valid, COALESCE(SUM(b.distance_pred * b.valid) / NULLIF(SUM(b.valid), 0), 0) AS score
    FROM a JOIN live USING (scene_id, yoff, xoff) JOIN a b ON a.scene_id = b.scene_id AND a.yoff = b.yoff AND a.xoff = b.xoff AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1
    WHERE a.core GROUP BY ALL),
    p AS (SELECT *, EXP(-(POWER(y - yoff - 11.5, 2) + POWER(x - xoff - 11.5, 2)) / 72.0) * valid AS wt, 1 / (1 + EXP(-score / 16)) AS prob FROM f)
    SELECT scene_id, y, x, ROUND(COALESCE(SUM(prob * wt) / NULLIF(SUM(wt), 0), 0), 6) AS prob, COUNT(*) AS n_tiles FROM p GROUP BY ALL"""
)
def tiled_prediction(spark, sf_dir):
    """The chain of a tiled prediction: windows with halo, a scorer on whole tiles, its activation, overlap-add of the tiles."""
    a = T.assign(view(spark, sf_dir, "px"), H, W, 24, 18, halo=1)
    made = T.score_tiles(a, ["distance_pred"], T.mean_filter, 24, halo=1)
    return rounded(T.blend(made.withColumn("prob", 1 / (1 + F.exp(-F.col("score") / 16))), ["prob"], 24))


@query(
    sql("px") + " SELECT 16 AS size, scene_id, yoff, xoff FROM (" + f"WITH {_windows(16, 8)} SELECT * FROM win" + ") UNION ALL SELECT 32, scene_id, yoff, xoff FROM ("
    + f"WITH {_windows(32, 16)} SELECT * FROM win" + ")"
)
def multi_size_windows(spark, sf_dir):
    return T.multi_size_windows(_scenes(spark, sf_dir), [16, 32, 16])


def _patches(spark, sf_dir, size=16, stride=8):
    return T.assign(view(spark, sf_dir, "px"), H, W, size, stride)


PATCH = f"{_windows(16, 8)}, a AS (SELECT p.*, yoff, xoff FROM px p JOIN win w ON p.scene_id = w.scene_id AND {COVER.format(s=16)})"
RATIOS = PATCH + ", ra AS (SELECT scene_id, yoff, xoff, SUM(valid) / 256.0 AS valid_ratio, COUNT(*) FILTER (gt_boundary = 1) / 256.0 AS edge_ratio FROM a GROUP BY ALL)"
CLASS = "CASE WHEN valid_ratio < 0.05 THEN NULL WHEN valid_ratio < 0.5 THEN 'near_invalid' WHEN edge_ratio >= 0.1 THEN 'boundary_positive' WHEN valid_ratio >= 0.8 AND edge_ratio = 0 THEN 'hard_negative' ELSE 'center_positive' END"
COVERAGE = PATCH + ", co AS (SELECT scene_id, yoff, xoff, COALESCE(COUNT(*) FILTER (valid = 1 AND gt_extent > 0)::DOUBLE / NULLIF(COUNT(*) FILTER (valid = 1), 0), 0) AS coverage FROM a GROUP BY ALL)"


@query(sql("px") + f", {RATIOS} SELECT scene_id, yoff, xoff, ROUND(valid_ratio, 6)::DOUBLE AS valid_ratio, ROUND(edge_ratio, 6)::DOUBLE AS edge_ratio FROM ra")
def patch_ratios(spark, sf_dir):
    return rounded(T.patch_ratios(_patches(spark, sf_dir), 16))


@query(sql("px") + f", {RATIOS} SELECT scene_id, yoff, xoff, {CLASS} AS sampling_class FROM ra")
def patch_sampling_class(spark, sf_dir):
    r = T.patch_ratios(_patches(spark, sf_dir), 16)
    return r.select("scene_id", "yoff", "xoff", T.patch_class(F.col("valid_ratio"), F.col("edge_ratio")).alias("sampling_class"))


@query(
    sql("px") + f", {RATIOS}, c AS (SELECT *, {CLASS} AS cls FROM ra) SELECT scene_id, COUNT(*) FILTER (cls = 'near_invalid') AS near_invalid, COUNT(*) FILTER (cls = 'boundary_positive') AS boundary_positive, COUNT(*) FILTER (cls = 'hard_negative') AS hard_negative, COUNT(*) FILTER (cls = 'center_positive') AS center_positive, COUNT(*) FILTER (cls IS NULL) AS rejected FROM c GROUP BY scene_id"
)
def patch_class_counts(spark, sf_dir):
    return T.class_counts(T.patch_ratios(_patches(spark, sf_dir), 16))


@query(sql("px") + f", {COVERAGE} SELECT scene_id, yoff, xoff, ROUND(coverage, 6) AS coverage FROM co")
def patch_extent_coverage(spark, sf_dir):
    return rounded(T.extent_coverage(_patches(spark, sf_dir)))


BUCKETS = COVERAGE + ", q AS (SELECT quantile_cont(coverage, 0.33) AS q1, quantile_cont(coverage, 0.66) AS q2 FROM co), bu AS (SELECT co.*, CASE WHEN coverage <= q1 THEN 'low' WHEN coverage <= q2 THEN 'medium' ELSE 'high' END AS bucket FROM co, q)"


@query(sql("px") + f", {BUCKETS} SELECT scene_id, yoff, xoff, bucket FROM bu")
def coverage_buckets(spark, sf_dir):
    return T.coverage_buckets(T.extent_coverage(_patches(spark, sf_dir))).select("scene_id", "yoff", "xoff", "bucket")


@query(
    sql("px") + f""", {BUCKETS}, t AS (SELECT b.bucket, th.t AS threshold, COUNT(*) FILTER (gt_extent = 1 AND extent_prob >= th.t) AS tp,
    COUNT(*) FILTER (gt_extent <> 1 AND extent_prob >= th.t) AS fp, COUNT(*) FILTER (gt_extent = 1 AND extent_prob < th.t) AS fn
    FROM a JOIN bu b USING (scene_id, yoff, xoff) CROSS JOIN (SELECT unnest([0.5, 0.55]) AS t) th WHERE a.valid = 1 GROUP BY ALL)
    SELECT bucket, threshold::DOUBLE AS threshold, tp, fp, fn, ROUND(COALESCE(tp::DOUBLE / NULLIF(tp + fp, 0), 0), 6) AS prec, ROUND(COALESCE(tp::DOUBLE / NULLIF(tp + fn, 0), 0), 6) AS rec,
    ROUND(COALESCE(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 6)::DOUBLE AS f1,
    ROUND(COALESCE(tp::DOUBLE / NULLIF(tp + fp, 0), 0) - COALESCE(tp::DOUBLE / NULLIF(tp + fn, 0), 0), 6) AS gap FROM t"""
)
def threshold_bucket_metrics(spark, sf_dir):
    from sparkraster.operators.metrics import threshold_sweep

    patches = _patches(spark, sf_dir)
    buckets = T.coverage_buckets(T.extent_coverage(patches)).drop("coverage")
    return rounded(threshold_sweep(patches.join(buckets, ["scene_id", "yoff", "xoff"]), [0.5, 0.55], ["bucket"]))


SPLIT_N = ", n AS (SELECT COUNT(*) AS n, GREATEST(1, round_even(COUNT(*) * 0.7, 0)) AS tr, round_even(COUNT(*) * 0.15, 0) AS va FROM win)"
SPLIT_CASE = "CASE WHEN r <= tr THEN 'train' WHEN r <= tr + va THEN 'val' ELSE 'test' END AS split"


@query(
    sql("px") + f", {_windows(16, 8)}{SPLIT_N} SELECT scene_id, yoff, xoff, {SPLIT_CASE} FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY yoff, xoff, scene_id) AS r FROM win), n"
)
def split_spatial(spark, sf_dir):
    return G.ordered_split(T.windows(_scenes(spark, sf_dir), 16), ["yoff", "xoff", "scene_id"])


@query(
    sql("px") + f", {_windows(16, 8)}{SPLIT_N} SELECT scene_id, yoff, xoff, {SPLIT_CASE} FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY md5('42:' || scene_id || ':' || yoff || ':' || xoff), scene_id, yoff, xoff) AS r FROM win), n"
)
def split_random(spark, sf_dir):
    return G.random_split(T.windows(_scenes(spark, sf_dir), 16), ["scene_id", "yoff", "xoff"], seed=42)


@query(
    sql("px") + f", {_windows(16, 8)}{SPLIT_N} SELECT {SPLIT_CASE}, scene_id, COUNT(*) AS patches FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY yoff, xoff, scene_id) AS r FROM win), n GROUP BY ALL"
)
def split_export_counts(spark, sf_dir):
    from sparkraster.sources.datasets import export_by_split

    return export_by_split(G.ordered_split(T.windows(_scenes(spark, sf_dir), 16), ["yoff", "xoff", "scene_id"]), ["scene_id"])


@query(
    sql("px") + f""", {BUCKETS}, u AS (SELECT *, ('0x' || substr(md5('7:' || scene_id || ':' || yoff || ':' || xoff), 1, 8))::BIGINT AS h,
    CASE bucket WHEN 'low' THEN 1.0 WHEN 'medium' THEN 2.0 ELSE 4.0 END AS w FROM bu)
    SELECT scene_id, yoff, xoff FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY -ln((h + 0.5) / 4294967296.0) / w, scene_id, yoff, xoff) AS r FROM u) WHERE r <= 40"""
)
def weighted_sample(spark, sf_dir):
    b = T.coverage_buckets(T.extent_coverage(_patches(spark, sf_dir)))
    w = F.when(F.col("bucket") == "low", 1.0).when(F.col("bucket") == "medium", 2.0).otherwise(4.0)
    return G.weighted_sample(b.withColumn("w", w), "w", ["scene_id", "yoff", "xoff"], 40, seed=7).select("scene_id", "yoff", "xoff")


DRAWN = 500
POINT = (42 % 997 + 0.5) / 997


@query(
    f"""WITH c AS (SELECT o_orderkey, o_custkey % 9 AS w, SUM(o_custkey % 9) OVER (ORDER BY o_orderkey) AS hi, SUM(o_custkey % 9) OVER () AS total FROM orders WHERE o_custkey % 9 > 0)
    SELECT o_orderkey, COUNT(*) AS times FROM (SELECT o_orderkey, unnest(generate_series(1, (CEIL(hi::DOUBLE / total * {DRAWN} - {POINT!r}::DOUBLE) - CEIL((hi - w)::DOUBLE / total * {DRAWN} - {POINT!r}::DOUBLE))::BIGINT)) FROM c) GROUP BY 1"""
)
def weighted_sample_replaced(spark, sf_dir):
    """Draws with replacement: a row comes as often as points of the cumulated weights fall on it."""
    from sparkraster.operators import sampling
    from sparkraster.tables import table

    df = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "CAST(o_custkey % 9 AS DOUBLE) AS w")
    return sampling.weighted_sample(df, "w", ["o_orderkey"], DRAWN, 42, replacement=True).groupBy("o_orderkey").agg(F.count("*").alias("times"))
