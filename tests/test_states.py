"""Kept statistics, large weighted samples, previews, baselines and excluded scenes."""

import math
import random

import numpy as np
import pytest

from sparkraster.operators import metrics as M
from sparkraster.operators import pixels as P
from sparkraster.operators import runs as J
from sparkraster.operators import sampling as G


def test_a_batch_sent_twice_counts_once(spark, tmp_path):
    d = np.random.default_rng(1)
    px = spark.createDataFrame([(i, int(i % 7 != 0), float(v)) for i, v in enumerate(d.normal(0, 1, 9000))], "i int, valid int, b1 double")
    path, batches = str(tmp_path / "state"), [px.where(f"i % 3 = {b}") for b in range(3)]
    M.keep_sketches(px.where("i % 3 = 1 AND i < 100"), ["b1"], "1", path)  # an attempt that was cut short
    for b in (0, 1, 2, 1):
        M.keep_sketches(batches[b], ["b1"], str(b), path)
    M.keep_sketches(px.where("i < 0"), ["b1"], "none", path)
    kept = M.sketch_percentiles(M.kept_sketch(spark, path, ["b1"]), ["b1"]).first()
    once = M.sketch_percentiles(M.band_sketches(px, ["b1"]), ["b1"]).first()
    values = np.sort([r.b1 for r in px.where("valid = 1").collect()])
    assert kept.n_valid == once.n_valid == len(values)
    for r in (kept, once):
        assert np.searchsorted(values, r.p_lo) / len(values) == pytest.approx(0.005, abs=0.02)
        assert np.searchsorted(values, r.p_hi) / len(values) == pytest.approx(0.995, abs=0.02)


@pytest.mark.parametrize("n", [0, 1, 500, 999, 1000, 5000])
def test_sample_without_replacement(spark, n):
    rows = [(i, float(i % 5)) for i in range(1250)]
    got = G.weighted_sample(spark.createDataFrame(rows, "k long, w double"), "w", ["k"], n, seed=3).collect()
    draw = {r[0]: r[1] for r in spark.createDataFrame(rows, "k long, w double").select("k", G.uniform(3, ["k"])).collect()}
    want = sorted((i for i, w in rows if w > 0), key=lambda i: (-math.log(draw[i]) / rows[i][1], i))[:n]
    assert sorted(r.k for r in got) == sorted(want)


def test_sample_with_equal_keys(spark):
    """Repeated rows draw alike; the sample still has n rows."""
    df = spark.createDataFrame([(1, 1.0)] * 40 + [(2, 1.0)] * 40, "k long, w double")
    for n in (7, 40, 55):
        assert G.weighted_sample(df, "w", ["k"], n, seed=3).count() == n


@pytest.mark.parametrize(("h", "w", "budget"), [(7, 11, 1000), (7, 11, 20), (50, 3, 1), (9, 9, 81), (31, 17, 100)])
def test_preview_keeps_its_budget(spark, h, w, budget):
    rnd = random.Random(h)
    image = {(y, x): rnd.randrange(9) for y in range(h) for x in range(w)}
    px = spark.createDataFrame([(0, y, x, float(v), v) for (y, x), v in image.items()], "scene_id long, y long, x long, a double, n1 long")
    got = {(r.oy, r.ox): r for r in P.preview(px, spark.createDataFrame([(0, h, w)], "scene_id long, height int, width int"), ["a"], ["n1"], budget).collect()}
    scale = 1.0 if h * w <= budget else math.sqrt(budget / (h * w))
    oh, ow = max(1, math.floor(h * scale)), max(1, math.floor(w * scale))
    assert got.keys() == {(y, x) for y in range(oh) for x in range(ow)} and len(got) <= max(budget, oh, ow)
    for (oy, ox), r in got.items():
        cell = [p for p in image if int((p[0] + 0.5) * oh / h + 1e-12) == oy and int((p[1] + 0.5) * ow / w + 1e-12) == ox]
        assert r.n == len(cell) and r.a == pytest.approx(sum(image[p] for p in cell) / len(cell))
        near = min(cell, key=lambda p: (round(abs(p[0] + 0.5 - (oy + 0.5) * h / oh) + abs(p[1] + 0.5 - (ox + 0.5) * w / ow), 9), p))
        assert r.n1 == image[near]


def test_baseline_that_occurs_twice(spark):
    runs = spark.createDataFrame([(1, "success", 0.5), (1, "failed", 0.9), (2, "success", 0.7)], "run_id long, status string, f1 double")
    wanted = spark.createDataFrame([(2,), (3,)], "run_id long")
    for order in (["status"], ["f1"]):
        got = {r.run_id: (r.status, r.d_f1) for r in J.experiment_summary(wanted, runs.orderBy(*order), 1, ["f1"]).collect()}
        assert got == {2: ("success", pytest.approx(-0.2)), 3: ("missing", None)}
    assert J.experiment_summary(wanted, runs, 99, ["f1"]).where("d_f1 IS NULL").count() == 2


def test_excluded_scenes_name_their_reason(spark):
    s = lambda *ids: spark.createDataFrame([(i,) for i in ids], "scene_id long")
    got = {r.scene_id: (r.included, r.reason, r.policy) for r in J.scene_selection(s(1, 2, 3, 4, 4), {"ground_truth": s(1, 2, 9), "prediction": s(1, 3)}, "both").collect()}
    assert got == {1: (True, None, "both"), 2: (False, "missing_prediction", "both"), 3: (False, "missing_ground_truth", "both"), 4: (False, "missing_ground_truth", "both")}


def test_scene_rows_beyond_the_bound_meet_by_shuffle(spark, monkeypatch):
    px = spark.range(40).selectExpr("id % 4 AS scene_id", "id AS y")
    scenes = spark.range(4).selectExpr("id AS scene_id", "id * 10 AS d")
    small = P.with_scene(px, scenes)
    monkeypatch.setattr(P, "SCENES", 3)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, P.with_scene(px, scenes).collect()))
