"""What a task or the driver holds does not grow with rows that are made from a small file."""

import re

from pyspark.sql import functions as F

from sparkraster.operators import spatial as S


def boxes(spark, n, w, h):
    """``n`` boxes of one scene from one small task."""
    at = spark.range(0, n, 1, 1).selectExpr("id div 1000000 AS scene_id", "id AS parcel_id", "(id % 30) * 20 AS x0", "(id div 30) * 20 AS y0")
    return at.withColumns({"w": F.lit(w).cast("long"), "h": F.lit(h).cast("long")})


def first_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_and_boxes_of_small_tables_are_not_broadcast(spark):
    g, p = boxes(spark, 300, 9, 8), boxes(spark, 300, 12, 9)
    g_runs, p_runs = S.box_runs(g), S.box_runs(p)
    valid = g_runs.select("scene_id", "y", "a", "b")
    for df in (S._met(S._in_cells(g_runs, "g", "gt_id"), S._in_cells(valid, "v", None), "g", "v", "g"), S.box_join(g, p)):
        assert "Broadcast" not in first_plan(df)
    assert S.overlaps_of_runs(g_runs, p_runs, valid).count() == 300


def test_runs_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr("sparkraster.operators.tables.TASK_ROWS", 100)
    runs = S.box_runs(boxes(spark, 200, 3, 10))
    assert runs.rdd.getNumPartitions() == 20 and runs.count() == 2000


def test_the_expression_of_a_ring_is_computed_once(spark):
    from sparkraster.operators import rings as R

    df = boxes(spark, 5, 9, 8)
    ring = F.array(*[F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y")) for x, y in (
        ("x0 + 4321", "y0"), ("x0 + w", "y0"), ("x0 + w", "y0"), ("x0 + w", "y0 + h"), ("x0", "y0 + h"))])
    made = df.select("parcel_id", S._edges(R._distinct_points(ring)).alias("e"))
    assert first_plan(made).count("4321") == 1
    assert made.select(F.size("e")).distinct().collect() == [(4,)]


def tallest(df):
    """Most rows of a task, and the number of tasks."""
    made = df.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    return tuple(made)


def test_touched_pixels_are_made_and_told_apart_where_their_edges_are(spark, monkeypatch):
    monkeypatch.setattr("sparkraster.operators.tables.TASK_ROWS", 2000)
    corner = lambda x, y: F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x0 + w", "y0 + 1.5"), corner("x0 + w", "y0 + h"), corner("x0", "y0 + h"))
    made = S.outline_rings(boxes(spark, 3000, 150, 130).withColumn("ring", ring))
    assert len(re.findall(r"Exchange hashpartitioning", first_plan(made))) == 1  # of edges, none of pixels
    most, tasks = tallest(made)
    assert tasks > 20 and most < made.count() / 5


def test_border_pixels_are_made_and_told_apart_where_their_sides_are(spark, monkeypatch):
    monkeypatch.setattr("sparkraster.operators.tables.TASK_ROWS", 2000)
    made = S.outline_boxes(boxes(spark, 3000, 15, 130))
    assert len(re.findall(r"Exchange hashpartitioning", first_plan(made))) == 1
    most, tasks = tallest(made)
    assert tasks > 20 and most < made.count() / 5
    thin = [(0, 1, 5, -2, 1, 1), (0, 2, 0, 62, 2, 2), (0, 3, 4, 60, 3, 9), (1, 3, 4, 60, 3, 1), (1, 4, 0, 0, 0, 5)]
    got = sorted(tuple(r) for r in S.outline_boxes(spark.createDataFrame(thin, "scene_id long, parcel_id long, x0 long, y0 long, w long, h long")).collect())
    want = {(s, y, x) for s, _, x0, y0, w, h in thin for y in range(y0, y0 + h) for x in range(x0, x0 + w) if y in (y0, y0 + h - 1) or x in (x0, x0 + w - 1)}
    assert got == sorted(want)


def scene(spark):
    return spark.range(60 * 700).selectExpr(
        "id div 1000000 AS scene_id", "id div 700 AS y", "id % 700 AS x", "IF(id % 3 = 0, 0, 1) AS valid", "(id % 10) / 10.0D AS extent_prob",
        "0.25D AS p_skel", "(id % 4) / 8.0D AS p_buf", "CAST(id % 64 AS double) AS distance_pred")


def test_pixels_of_parcels_are_not_made_for_their_areas(spark):
    some = boxes(spark, 40, 300, 31)
    by_run, by_pixel = (S.valid_area(p, scene(spark)) for p in (S.box_runs(some), S.rasterize_boxes(some)))
    assert "Sort" not in first_plan(by_run) and "Generate explode(sequence(a" not in first_plan(by_run)
    assert sorted(map(tuple, by_run.collect())) == sorted(map(tuple, by_pixel.collect())) != []


def test_pixels_of_parcels_are_not_made_for_their_confidence(spark):
    some = boxes(spark, 40, 300, 31)
    by_run, by_pixel = (S.polygon_confidence(p, scene(spark)) for p in (S.box_runs(some), S.rasterize_boxes(some)))
    assert "Sort" not in first_plan(S.confidence_summary(by_run))
    rows = lambda df: sorted((r.parcel_id, round(r.confidence, 9), round(r.mean_distance, 9)) for r in df.collect())
    assert rows(by_run) == rows(by_pixel) != []
