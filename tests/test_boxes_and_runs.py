"""Joins of boxes over grid levels and overlaps from runs, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkraster.operators import spatial as S

BOX = "scene_id long, parcel_id long, x0 long, y0 long, w long, h long"


def boxes(seed, n, scenes=2):
    d = np.random.default_rng(seed)
    size = lambda: int(2 ** d.uniform(0, 9))
    return [(int(d.integers(scenes)), i, int(d.integers(-50, 600)), int(d.integers(-50, 600)), size(), size()) for i in range(n)]


def meet(a, b):
    return a[0] == b[0] and a[2] < b[2] + b[4] and b[2] < a[2] + a[4] and a[3] < b[3] + b[5] and b[3] < a[3] + a[5]


@pytest.mark.parametrize("cell", [1, 7, 64])
def test_box_join_equals_brute_force(spark, cell):
    left, right = boxes(1, 120), boxes(2, 90)
    got = [(r.scene_id, r.left_id, r.right_id) for r in S.box_join(spark.createDataFrame(left, BOX), spark.createDataFrame(right, BOX), cell).collect()]
    assert sorted(got) == sorted((a[0], a[1], b[1]) for a in left for b in right if meet(a, b))


def test_a_box_over_the_scene_takes_few_cells(spark):
    """One box over 10^5 small ones: the plan makes at most 4 rows a box and level, and every pair once."""
    small = spark.range(100_000).selectExpr("0L AS scene_id", "id AS parcel_id", "(id % 316) * 40 AS x0", "(id div 316) * 40 AS y0", "30L AS w", "30L AS h")
    whole = spark.createDataFrame([(0, 7, 0, 0, 100_000, 100_000)], BOX)
    pairs = S.box_join(small, whole)
    assert pairs.count() == 100_000 and pairs.select("left_id").distinct().count() == 100_000


def runs_of(pixels):
    return [(s, i, y, x, x) for s, i, y, x in pixels]


RUN = "scene_id long, parcel_id long, y long, a long, b long"


def brute(g, p, valid):
    out = {}
    for s, i in {(s, i) for s, i, _, _ in g}:
        gi = {(y, x) for t, k, y, x in g if (t, k) == (s, i)} & valid[s]
        for j in {k for t, k, _, _ in p if t == s}:
            pj = {(y, x) for t, k, y, x in p if (t, k) == (s, j)} & valid[s]
            if gi & pj:
                out[s, i, j] = (len(gi & pj), len(gi), len(pj))
    return out


def test_overlaps_of_runs_equal_pixels(spark, monkeypatch):
    monkeypatch.setattr(S, "CELL", 5)
    d = np.random.default_rng(3)

    def parcels(n):
        """Rows (scene, id, y, a, b), with ids that occur in several overlapping runs."""
        return [(int(d.integers(2)), int(d.integers(6)), int(d.integers(4)), int(a := d.integers(-9, 20)), int(a + d.integers(0, 14))) for _ in range(n)]

    pixels = lambda rows: {(s, i, y, x) for s, i, y, a, b in rows for x in range(a, b + 1)}
    g, p = parcels(40), parcels(40)
    mask = [(s, 0, y, a, b) for s in range(2) for y in range(4) for a, b in ((-9, -3), (0, 4), (5, 5), (7, 40))]
    valid = {s: {(y, x) for t, _, y, x in pixels(mask) if t == s} for s in range(2)}
    df = [spark.createDataFrame(x, RUN) for x in (g, p, mask)]
    got = {(r.scene_id, r.gt_id, r.pred_id): (r.inter, r.gt_area, r.pred_area) for r in S.overlaps_of_runs(*df).collect()}
    assert got == brute(pixels(g), pixels(p), valid)
    everywhere = {s: {(y, x) for y in range(4) for x in range(-9, 60)} for s in range(2)}
    free = {(r.scene_id, r.gt_id, r.pred_id): (r.inter, r.gt_area, r.pred_area) for r in S.overlaps_of_runs(*df[:2]).collect()}
    assert free == brute(pixels(g), pixels(p), everywhere)
    by_pixel = [spark.createDataFrame(sorted(pixels(x)), "scene_id long, parcel_id long, y long, x long") for x in (g, p, mask)]
    same = {(r.scene_id, r.gt_id, r.pred_id): (r.inter, r.gt_area, r.pred_area) for r in S.overlaps(by_pixel[0], by_pixel[1], by_pixel[2].drop("parcel_id")).collect()}
    assert same == got


def test_pixel_runs(spark, monkeypatch):
    monkeypatch.setattr(S, "CELL", 4)
    px = spark.createDataFrame([(0, 0, x) for x in (0, 1, 2, 3, 4, 6, 7, 7, 11, -1, -2)] + [(1, 5, 2)], "scene_id long, y long, x long")
    got = sorted(tuple(r) for r in S.pixel_runs(px, ["scene_id"]).select("scene_id", "y", "a", "b").collect())
    assert got == [(0, 0, -2, -1), (0, 0, 0, 3), (0, 0, 4, 4), (0, 0, 6, 7), (0, 0, 11, 11), (1, 5, 2, 2)]


def test_large_parcels_move_rows_and_not_areas(spark):
    """Two parcels of 4 million pixels meet in rows of their heights times their cells."""
    one = spark.createDataFrame([(0, 1, 0, 0, 2000, 2000)], BOX)
    two = spark.createDataFrame([(0, 2, 1000, 500, 2000, 2000)], BOX)
    dealt = S._in_cells(S.box_runs(one), "g", "gt_id")
    assert dealt.count() == 2000 * 8
    r = S.overlaps_of_runs(S.box_runs(one), S.box_runs(two)).first()
    assert (r.inter, r.gt_area, r.pred_area) == (1000 * 1500, 4_000_000, 4_000_000)
    assert S.overlaps_of_runs(S.box_runs(one), S.box_runs(two.where("false"))).agg(F.count("*")).first()[0] == 0
