"""Queries of run records, comparison, ranking, lineage and metadata checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparkraster.operators import metrics as M
from sparkraster.operators import runs as J
from sparkraster.plans.registry import query, rounded
from sparkraster.sources.views import sql, view
from sparkraster.tables import table

R = sql("runs")
PAIRS = "pairs AS (SELECT a.run_id AS left_id, a.run_id + 1 AS right_id FROM runs a JOIN runs b ON b.run_id = a.run_id + 1 WHERE a.run_id % 2 = 0)"
METRICS = ["extent_f1", "boundary_f1", "goc", "guc"]
OPTIONAL = ["boundary_bde", "normalized_gtc"]
LONG = "lo AS (" + " UNION ALL ".join(f"SELECT run_id, '{m}' AS metric, {m}::DOUBLE AS v FROM runs" for m in METRICS + OPTIONAL) + ")"
LOWER = "('boundary_bde', 'goc', 'guc', 'normalized_gtc')"
DELTA = f"""{PAIRS}, {LONG}, de AS (SELECT left_id, right_id, a.metric, CASE WHEN a.metric IN {LOWER} THEN 'lower_is_better' ELSE 'higher_is_better' END AS orientation, ROUND(a.v, 6) AS left_value, ROUND(b.v, 6) AS right_value, ROUND(b.v - a.v, 6) AS delta,
 CASE WHEN b.v - a.v IS NULL OR b.v = a.v THEN NULL WHEN a.metric IN {LOWER} THEN b.v < a.v ELSE b.v > a.v END AS improved,
 CASE WHEN b.v - a.v IS NOT NULL THEN 'ok' WHEN a.metric IN ('boundary_bde', 'normalized_gtc') THEN 'skipped' ELSE 'missing' END AS status
 FROM pairs JOIN lo a ON a.run_id = left_id JOIN lo b ON b.run_id = right_id AND b.metric = a.metric)"""


def _runs(spark, sf_dir):
    return view(spark, sf_dir, "runs")


def _pairs(spark, sf_dir):
    r = _runs(spark, sf_dir).select("run_id")
    left = r.where("run_id % 2 = 0").select(F.col("run_id").alias("left_id"), (F.col("run_id") + 1).alias("right_id"))
    return left.join(r.select(F.col("run_id").alias("right_id")), "right_id", "left_semi").select("left_id", "right_id")


@query(R + f", {DELTA} SELECT * FROM de")
def run_delta(spark, sf_dir):
    return rounded(J.run_delta(_pairs(spark, sf_dir), _runs(spark, sf_dir), METRICS, OPTIONAL))


@query(R + f", {DELTA} SELECT left_id, right_id, metric, delta FROM de WHERE status = 'ok'")
def delta_table(spark, sf_dir):
    d = J.run_delta(_pairs(spark, sf_dir), _runs(spark, sf_dir), METRICS, OPTIONAL)
    return rounded(d.where("status = 'ok'").select("left_id", "right_id", "metric", "delta"))


@query(R + f", {DELTA} SELECT metric, COUNT(*) FILTER (status = 'ok' AND improved) AS wins, COUNT(*) FILTER (status = 'ok' AND NOT improved) AS losses, COUNT(*) FILTER (status = 'ok' AND improved IS NULL) AS ties FROM de GROUP BY metric")
def scene_win_loss(spark, sf_dir):
    return J.win_loss(J.run_delta(_pairs(spark, sf_dir), _runs(spark, sf_dir), METRICS, OPTIONAL), ["metric"])


GROUPS = {"pixel": ["extent_threshold"], "boundary": ["boundary_threshold"], "object_structure": ["iou_threshold", "extent_threshold"]}
COMPAT = f"""{PAIRS}, co AS (SELECT left_id, right_id, 'pixel' AS policy, CASE WHEN ABS(a.extent_threshold - b.extent_threshold) > 1e-9 THEN 'extent_threshold mismatch' ELSE 'compatible' END AS reason FROM pairs JOIN runs a ON a.run_id = left_id JOIN runs b ON b.run_id = right_id
 UNION ALL SELECT left_id, right_id, 'boundary', CASE WHEN ABS(a.boundary_threshold - b.boundary_threshold) > 1e-9 THEN 'boundary_threshold mismatch' ELSE 'compatible' END FROM pairs JOIN runs a ON a.run_id = left_id JOIN runs b ON b.run_id = right_id
 UNION ALL SELECT left_id, right_id, 'object_structure', CASE WHEN ABS(a.iou_threshold - b.iou_threshold) > 1e-9 THEN 'iou_threshold mismatch' WHEN ABS(a.extent_threshold - b.extent_threshold) > 1e-9 THEN 'extent_threshold mismatch' ELSE 'compatible' END FROM pairs JOIN runs a ON a.run_id = left_id JOIN runs b ON b.run_id = right_id)"""


@query(R + f", {COMPAT} SELECT * FROM co")
def policy_compat(spark, sf_dir):
    return J.policy_compat(_pairs(spark, sf_dir), _runs(spark, sf_dir), GROUPS)


@query(
    R + f""", {COMPAT} SELECT left_id, right_id, CASE WHEN a.eval_mode <> b.eval_mode OR g = 0 THEN 'not_ready' WHEN g = 3 THEN 'ready' ELSE 'partial' END AS readiness
    FROM (SELECT left_id, right_id, COUNT(*) FILTER (reason = 'compatible') AS g FROM co GROUP BY ALL) JOIN runs a ON a.run_id = left_id JOIN runs b ON b.run_id = right_id"""
)
def compare_readiness(spark, sf_dir):
    runs, pairs = _runs(spark, sf_dir), _pairs(spark, sf_dir)
    return J.readiness(pairs, runs, J.policy_compat(pairs, runs, GROUPS))


@query(
    R + f""", {PAIRS}, s AS (SELECT run_id, [run_id % 5, (run_id + run_id % 2) % 7, nation % 2] AS ids FROM runs)
    SELECT left_id, right_id, len(list_intersect(a.ids, b.ids))::INT AS shared, list_sort(list_distinct(a.ids)) = list_sort(list_distinct(b.ids)) AS same FROM pairs JOIN s a ON a.run_id = left_id JOIN s b ON b.run_id = right_id"""
)
def provenance_overlap(spark, sf_dir):
    s = _runs(spark, sf_dir).selectExpr("run_id", "array(run_id % 5, (run_id + run_id % 2) % 7, CAST(nation % 2 AS BIGINT)) AS source_ids")
    return J.provenance_overlap(_pairs(spark, sf_dir), s)


@query(R + ", s AS (SELECT run_id, ROUND(0.4 * extent_f1 + 0.3 * boundary_f1 + 0.3 * (1 - LEAST(1, goc + guc)), 6) AS score FROM runs) SELECT run_id, score, RANK() OVER (ORDER BY score DESC)::INT AS rank FROM s")
def run_ranking(spark, sf_dir):
    return J.ranking(_runs(spark, sf_dir).withColumn("normalized_gtc", F.least(F.col("goc") + F.col("guc"), F.lit(1.0))))


HISTORY = "h AS (SELECT user_id AS run_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS epoch, ((event_id * 7919) % 1000) / 1000.0::DOUBLE AS boundary_f1, ((event_id * 104729) % 1000) / 1000.0::DOUBLE AS extent_f1 FROM events WHERE user_id IS NOT NULL)"


@query(
    f"WITH {HISTORY}, c AS (SELECT *, 0.6 * boundary_f1 + 0.4 * extent_f1 AS co FROM h), w AS (SELECT *, MAX(co) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pr FROM c) SELECT run_id, epoch, ROUND(co, 6) AS composite, pr IS NULL OR co > pr AS is_best FROM w"
)
def best_epoch(spark, sf_dir):
    h = table(spark, sf_dir, "events").where("user_id IS NOT NULL").select(
        F.col("user_id").alias("run_id"), F.row_number().over(W.partitionBy("user_id").orderBy("event_id")).cast("long").alias("epoch"),
        F.expr("CAST((event_id * 7919) % 1000 AS DOUBLE) / 1000.0e0").alias("boundary_f1"), F.expr("CAST((event_id * 104729) % 1000 AS DOUBLE) / 1000.0e0").alias("extent_f1"),
    )
    return rounded(J.best_epochs(h).select("run_id", "epoch", "composite", "is_best"))


@query(
    sql("px") + ", g AS (SELECT scene_id * 100 + y AS scene, COUNT(*) FILTER (valid = 1 AND gt_extent = 1 AND extent_prob >= 0.5) AS tp, COUNT(*) FILTER (valid = 1 AND gt_extent = 0 AND extent_prob >= 0.5) AS fp, COUNT(*) FILTER (valid = 1 AND gt_extent = 1 AND extent_prob < 0.5) AS fn FROM px GROUP BY 1), s AS (SELECT scene, COALESCE(2.0 * tp / NULLIF(2 * tp + fp + fn, 0), 0)::DOUBLE AS f FROM g) SELECT scene, ROUND(f, 6) AS f1, r::INT AS rank FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY f, scene) AS r FROM s) WHERE r <= 10"
)
def worst_scenes(spark, sf_dir):
    px = view(spark, sf_dir, "px").withColumn("scene", F.col("scene_id") * 100 + F.col("y"))
    return rounded(J.top_k(M.pixel_metrics(px, keys=["scene"]).select("scene", "f1"), "f1", "scene", 10, largest=False))


@query(R + f", {DELTA} SELECT left_id, delta, r::INT AS rank FROM (SELECT left_id, delta, ROW_NUMBER() OVER (ORDER BY delta DESC, left_id) AS r FROM de WHERE metric = 'boundary_f1' AND delta IS NOT NULL) WHERE r <= 10")
def most_improved_scenes(spark, sf_dir):
    d = J.run_delta(_pairs(spark, sf_dir), _runs(spark, sf_dir), METRICS, OPTIONAL).where("metric = 'boundary_f1'")
    return J.top_k(rounded(d).select("left_id", "delta"), "delta", "left_id", 10, largest=True)


TAX = "t AS (SELECT run_id, (run_id % 13)::DOUBLE AS a, (run_id % 11)::DOUBLE AS b, (run_id % 7)::DOUBLE AS c, (run_id % 5)::DOUBLE AS d, (run_id % 3)::DOUBLE AS e, boundary_bde FROM runs)"


@query(R + f", {TAX} SELECT run_id, 'split_error' AS error, a AS value FROM t UNION ALL SELECT run_id, 'merge_error', b FROM t UNION ALL SELECT run_id, 'missed_parcel', c FROM t UNION ALL SELECT run_id, 'spurious_parcel', d FROM t UNION ALL SELECT run_id, 'invalid_area_artifact', e FROM t UNION ALL SELECT run_id, 'boundary_shift', ROUND(boundary_bde, 6) FROM t")
def error_taxonomy(spark, sf_dir):
    c = _runs(spark, sf_dir).selectExpr("run_id", "run_id % 13 AS split_gt", "run_id % 11 AS merged_gt", "run_id % 7 AS missed", "run_id % 5 AS spurious", "run_id % 3 AS invalid_area", "boundary_bde")
    return rounded(J.error_taxonomy(c, "run_id"))


@query(R + ", w AS (SELECT c_custkey AS run_id FROM customer), b AS (SELECT * FROM runs WHERE run_id = 3) SELECT w.run_id, COALESCE(r.status, 'missing') AS status, ROUND(r.extent_f1, 6) AS extent_f1, ROUND(r.boundary_bde, 6) AS boundary_bde, ROUND(r.extent_f1 - b.extent_f1, 6) AS d_extent_f1, ROUND(r.boundary_bde - b.boundary_bde, 6) AS d_boundary_bde FROM w LEFT JOIN runs r USING (run_id) LEFT JOIN b ON TRUE")
def experiment_summary(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run_id"))
    return rounded(J.experiment_summary(wanted, _runs(spark, sf_dir), 3, ["extent_f1", "boundary_bde"]))


@query(R.replace("WITH ", "WITH RECURSIVE ", 1) + ", a AS (SELECT run_id, parent_id AS ancestor_id, 1 AS depth FROM runs WHERE parent_id IS NOT NULL UNION SELECT a.run_id, r.parent_id, a.depth + 1 FROM a JOIN runs r ON r.run_id = a.ancestor_id WHERE r.parent_id IS NOT NULL) SELECT run_id, ancestor_id, MIN(depth) AS depth FROM a GROUP BY ALL")
def run_lineage(spark, sf_dir):
    return J.lineage(_runs(spark, sf_dir))


@query(R + ", c AS (SELECT run_id, run_id % 4 AS n_gt, NULLIF(run_id % 6, 1) AS n_pred FROM runs) SELECT run_id, NOT (COALESCE(n_gt, 0) = 0 OR COALESCE(n_pred, 0) = 0) AS ready, CASE WHEN COALESCE(n_gt, 0) = 0 THEN 'no ground truth parcels' WHEN COALESCE(n_pred, 0) = 0 THEN 'no predicted parcels' END AS reason FROM c")
def track_readiness(spark, sf_dir):
    c = _runs(spark, sf_dir).selectExpr("run_id", "run_id % 4 AS n_gt", "nullif(run_id % 6, 1) AS n_pred")
    return J.track_readiness(c).select("run_id", "ready", "reason")


SIDES = "g AS (SELECT DISTINCT scene_id * 50 + y AS scene_id FROM px WHERE valid = 1 AND gt_extent = 1 AND x < 2), p AS (SELECT DISTINCT scene_id * 50 + y AS scene_id FROM px WHERE valid = 1 AND extent_prob >= 0.6 AND x < 4), s AS (SELECT DISTINCT scene_id * 50 + y AS scene_id FROM px)"


def _selection(spark, sf_dir):
    """Rows of scenes, with the sides that have something at their beginning."""
    px = view(spark, sf_dir, "px").withColumn("scene_id", F.col("scene_id") * 50 + F.col("y"))
    sides = {"ground_truth": px.where("valid = 1 AND gt_extent = 1 AND x < 2"), "prediction": px.where("valid = 1 AND extent_prob >= 0.6 AND x < 4")}
    return J.scene_selection(px, sides, "both_sides")


@query(sql("px") + f", {SIDES} SELECT scene_id, 'both_sides' AS policy FROM s WHERE scene_id IN (SELECT * FROM g) AND scene_id IN (SELECT * FROM p)")
def scenes_included(spark, sf_dir):
    return _selection(spark, sf_dir).where("included").select("scene_id", "policy")


@query(sql("px") + f", {SIDES} SELECT scene_id, CASE WHEN scene_id NOT IN (SELECT * FROM g) THEN 'missing_ground_truth' ELSE 'missing_prediction' END AS reason, 'both_sides' AS policy FROM s WHERE scene_id NOT IN (SELECT * FROM g) OR scene_id NOT IN (SELECT * FROM p)")
def scenes_excluded(spark, sf_dir):
    return _selection(spark, sf_dir).where("not included").select("scene_id", "reason", "policy")


@query(R + f", {DELTA} SELECT left_id, right_id, metric, orientation, delta, status FROM de")
def delta_table_export(spark, sf_dir):
    """The delta table as CSV files, read back."""
    from sparkraster.operators.tables import shared_dir

    d = rounded(J.run_delta(_pairs(spark, sf_dir), _runs(spark, sf_dir), METRICS, OPTIONAL)).select("left_id", "right_id", "metric", "orientation", "delta", "status")
    path = f"{shared_dir(spark)}/deltas-{uuid.uuid4().hex[:12]}"
    J.export_table(d, path, "csv")
    return J.read_table(spark, path, "left_id long, right_id long, metric string, orientation string, delta double, status string", "csv")


@query(R + ", p AS (SELECT run_id, 'p' || nation % 2 AS a, 'p' || run_id % 2 AS b, 'p' || run_id % 4 % 2 AS c FROM runs) SELECT run_id, CASE WHEN a = b AND b = c THEN a ELSE 'mixed_explicit_threshold_provenance' END AS mode FROM p")
def threshold_provenance_mode(spark, sf_dir):
    p = _runs(spark, sf_dir).selectExpr("run_id", "concat('p', nation % 2) AS a", "concat('p', run_id % 2) AS b", "concat('p', run_id % 4 % 2) AS c")
    return J.threshold_provenance(p, ["a", "b", "c"])


MANIFEST = "CASE WHEN run_id % 10 = 4 THEN NULL ELSE 'eval' END AS schema_name, CASE WHEN run_id % 12 = 5 THEN ' ' ELSE 'v1' END AS schema_version, CASE WHEN run_id % 14 = 6 THEN NULL ELSE '1.0' END AS module_version, CAST(run_id AS VARCHAR) AS name"


@query(R + f", m AS (SELECT run_id, status, {MANIFEST} FROM runs) SELECT run_id, 'missing_schema_name' AS violation FROM m WHERE COALESCE(TRIM(schema_name), '') = '' UNION ALL SELECT run_id, 'missing_schema_version' FROM m WHERE COALESCE(TRIM(schema_version), '') = '' UNION ALL SELECT run_id, 'missing_stage_name' FROM m UNION ALL SELECT run_id, 'status' FROM m WHERE status NOT IN ('success', 'partial', 'failed')")
def manifest_contract(spark, sf_dir):
    m = _runs(spark, sf_dir).selectExpr("run_id", "status", *MANIFEST.replace("VARCHAR", "STRING").split(", "))
    return J.manifest_contract(m, ("schema_name", "schema_version", "module_version", "name", "status", "stage_name"))


@query(
    """WITH l AS (SELECT c_custkey AS scene_id, c_nationkey AS layer, 100 + (c_custkey % 9 = 0)::INT AS width, CASE WHEN c_custkey % 8 = 0 THEN 'EPSG:4326' ELSE 'EPSG:32637' END AS crs, c_custkey % 6 = 0 AS off FROM customer)
    SELECT scene_id, layer, 'size' AS violation FROM l WHERE width <> 100 UNION ALL SELECT scene_id, layer, 'crs' FROM l WHERE crs <> 'EPSG:32637' UNION ALL SELECT scene_id, layer, 'transform' FROM l WHERE off"""
)
def layer_alignment(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    gt = "array(599800.0e0, 25.0e0, 0.0e0, 4400200.0e0 {}, 0.0e0, -25.0e0)"
    layers = c.selectExpr(
        "c_custkey AS scene_id", "c_nationkey AS layer", "100 + CAST(c_custkey % 9 = 0 AS INT) AS width", "50 AS height", "CASE WHEN c_custkey % 8 = 0 THEN 'EPSG:4326' ELSE 'EPSG:32637' END AS crs",
        gt.format("+ CASE WHEN c_custkey % 6 = 0 THEN 0.5e0 ELSE 0.0e0 END") + " AS gt",
    )
    reference = c.selectExpr("c_custkey AS scene_id", "100 AS width", "50 AS height", "'EPSG:32637' AS crs", gt.format("") + " AS gt")
    return J.layer_alignment(layers, reference)


@query(
    """WITH v AS (SELECT c_custkey AS scene_id, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ' epsg:32637' ELSE 'EPSG:4326' END AS crs, c_custkey % 5 <> 0 AS pr FROM customer)
    SELECT scene_id, CASE WHEN crs IS NULL THEN 'missing_crs' WHEN NOT pr THEN 'not_projected' WHEN UPPER(TRIM(crs)) = 'EPSG:32637' THEN 'same' ELSE 'reprojection_required' END AS status FROM v"""
)
def crs_check(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    vectors = c.selectExpr("c_custkey AS scene_id", "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ' epsg:32637' ELSE 'EPSG:4326' END AS crs")
    scenes = c.selectExpr("c_custkey AS scene_id", "'EPSG:32637' AS crs", "c_custkey % 5 <> 0 AS is_projected")
    return J.crs_check(scenes, vectors).select("scene_id", "status")


@query(
    """WITH v AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Polygon' WHEN 1 THEN 'Polygon25D' WHEN 2 THEN '3D Polygon' WHEN 3 THEN 'MultiPolygon Z' WHEN 4 THEN 'POLYGON ZM' ELSE 'MultiPolygon M' END AS k FROM part)
    SELECT p_partkey, CASE p_partkey % 6 WHEN 3 THEN 'MULTIPOLYGON' WHEN 5 THEN 'MULTIPOLYGON' ELSE 'POLYGON' END AS kind FROM v"""
)
def geometry_kind(spark, sf_dir):
    k = F.expr("CASE p_partkey % 6 WHEN 0 THEN 'Polygon' WHEN 1 THEN 'Polygon25D' WHEN 2 THEN '3D Polygon' WHEN 3 THEN 'MultiPolygon Z' WHEN 4 THEN 'POLYGON ZM' ELSE 'MultiPolygon M' END")
    return table(spark, sf_dir, "part").select("p_partkey", J.geometry_kind(k).alias("kind"))


@query("SELECT c_custkey AS scene_id FROM customer WHERE NOT (c_custkey % 2 = 0 OR c_custkey % 3 = 0 OR c_custkey % 5 = 0)")
def valid_policy_check(spark, sf_dir):
    s = table(spark, sf_dir, "customer").selectExpr("c_custkey AS scene_id", "c_custkey % 2 = 0 AS has_mask", "CASE WHEN c_custkey % 3 = 0 THEN 0.0e0 END AS nodata", "CASE WHEN c_custkey % 5 = 0 THEN true END AS override")
    return J.valid_policy(s).select("scene_id")


@query(
    """WITH m AS (SELECT l_orderkey AS run_id, l_linenumber AS role, MAX(l_partkey) AS path FROM lineitem WHERE l_linenumber <> 3 GROUP BY ALL), u AS (SELECT l_orderkey AS run_id, l_linenumber AS role, MAX(CASE WHEN l_suppkey % 9 = 0 THEN l_partkey + 1 ELSE l_partkey END) AS path FROM lineitem WHERE l_linenumber <> 5 GROUP BY ALL)
    SELECT run_id, role, CASE WHEN m.path IS NULL THEN 'not_in_manifest' WHEN u.path IS NULL THEN 'not_used' ELSE 'path_differs' END AS problem FROM m FULL JOIN u USING (run_id, role) WHERE m.path IS NULL OR u.path IS NULL OR m.path <> u.path"""
)
def manifest_artifact_check(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_orderkey": "run_id", "l_linenumber": "role"})
    m = li.where("role <> 3").groupBy("run_id", "role").agg(F.max("l_partkey").alias("path"))
    u = li.where("role <> 5").groupBy("run_id", "role").agg(F.max(F.expr("CASE WHEN l_suppkey % 9 = 0 THEN l_partkey + 1 ELSE l_partkey END")).alias("path"))
    return J.artifact_check(m, u)
