"""Queries over whole tables, without SQL, against brute force on the smallest tables."""

import math
from collections import defaultdict

import pytest

from sparkraster.plans import registry
from sparkraster.sources.views import view

SF = "/root/testdata/sf0.001"


def run(spark, name):
    return registry.queries()[name](spark, SF).collect()


@pytest.fixture(scope="module")
def px(spark):
    return view(spark, SF, "px").collect()


def near(points, targets):
    at = defaultdict(list)
    for t in targets:
        at[t.scene_id].append((t.y, t.x))
    return {(p.scene_id, p.y, p.x): min((p.y - y) ** 2 + (p.x - x) ** 2 for y, x in at[p.scene_id]) for p in points if at[p.scene_id]}


def sides(px):
    gt = [p for p in px if p.valid == 1 and p.gt_boundary == 1]
    return gt, [p for p in px if p.valid == 1 and p.p_skel >= p.p_bg and p.p_skel >= p.p_buf]


def test_nearest_boundary(spark, px):
    gt, pred = sides(px)
    got = {(r.scene_id, r.y, r.x): r.d2 for r in run(spark, "nearest_boundary")}
    assert {k: v for k, v in got.items() if v is not None} == near(pred, gt) and len(got) == len(pred)


def test_boundary_displacement(spark, px):
    gt, pred = sides(px)
    mean = [defaultdict(list), defaultdict(list)]
    for m, d in zip(mean, (near(pred, gt), near(gt, pred))):
        for k, v in d.items():
            m[k[0]].append(math.sqrt(v))
    for r in run(spark, "boundary_displacement"):
        a, b = (sum(m[r.scene_id]) / len(m[r.scene_id]) for m in mean)
        assert (r.pred_to_gt, r.gt_to_pred, r.bde) == pytest.approx((a, b, (a + b) / 2), abs=1e-5)


def test_distance_transform(spark, px):
    d = near(px, [p for p in px if p.gt_boundary == 1])
    want = {(p.scene_id, p.y, p.x): min(math.sqrt(d.get((p.scene_id, p.y, p.x), 64)), 8) if p.valid == 1 else 0 for p in px}
    assert {(r.scene_id, r.y, r.x): r.distance for r in run(spark, "distance_transform")} == pytest.approx(want, abs=1e-5)


def test_boundary_encode(spark, px):
    s = {(p.scene_id, p.y, p.x) for p in px if p.gt_boundary == 1}
    reach = [(a, b) for a in range(-3, 4) for b in range(-3, 4) if abs(a) + abs(b) <= 3]
    want = {(i, y + a, x + b) for i, y, x in s for a, b in reach if 0 <= y + a < 50 and 0 <= x + b < 100}
    assert {((r.scene_id, r.y, r.x), r.boundary) for r in run(spark, "boundary_encode")} == {(k, 1 if k in s else 2) for k in want}


def test_extent_and_summary(spark):
    b = view(spark, SF, "gt_rect").collect()
    (r,) = run(spark, "aoi_effective_extent")
    clamp = lambda v, top: float(min(max(v, 0), top))
    assert (r.xmin, r.ymin) == (clamp(min(p.x0 for p in b) - 30, 500), clamp(min(p.y0 for p in b) - 30, 400))
    assert (r.xmax, r.ymax) == (clamp(max(p.x0 + p.w for p in b) + 30, 500), clamp(max(p.y0 + p.h for p in b) + 30, 400))
    runs = {x.run_id: x for x in view(spark, SF, "runs").collect()}
    got = {x.run_id: (x.status, x.extent_f1) for x in run(spark, "experiment_summary")}
    ids = {p.parcel_id for p in b}
    assert got == {i: (runs[i].status, pytest.approx(runs[i].extent_f1)) if i in runs else ("missing", None) for i in ids}
