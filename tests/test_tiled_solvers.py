"""Distances, components and far neighbours solved by tile or pyramid, against brute force."""

import numpy as np
import pytest

from sparkraster.operators import neighbourhood as N
from sparkraster.operators import spatial as S

POINT = "scene_id long, y long, x long"


def brute_squared(on, clip):
    out = np.full(on.shape, clip * clip)
    for y, x in zip(*np.nonzero(on)):
        yy, xx = np.indices(on.shape)
        out = np.minimum(out, (yy - y) ** 2 + (xx - x) ** 2)
    return out


@pytest.mark.parametrize("clip", [1, 3, 8, 64])
def test_envelopes_equal_brute_force(clip):
    d = np.random.default_rng(clip)
    for share in (0.0, 0.003, 0.05, 0.5, 1.0):
        on = d.random((37, 41)) < share
        assert (N.squared_distances(on, clip) == brute_squared(on, clip)).all()


@pytest.mark.parametrize(("clip", "tile"), [(5, 7), (64, 16), (64, 256), (2, 50)])
def test_distance_over_tiles(spark, clip, tile):
    d = np.random.default_rng(tile)
    images = [(d.random((45, 60)) < 0.01, d.random((45, 60)) < 0.9) for _ in range(2)]
    rows = [(s, y, x, int(valid[y, x]), bool(on[y, x])) for s, (on, valid) in enumerate(images) for y in range(45) for x in range(60) if (y, x) != (3, 3)]
    px = spark.createDataFrame(rows, "scene_id long, y int, x int, valid int, b boolean")
    got = {(r.scene_id, r.y, r.x): r.distance for r in N.distance_transform(px, "b", clip, tile).collect()}
    assert len(got) == len(rows)
    for s, (on, valid) in enumerate(images):
        on[3, 3] = False
        want = np.where(valid, np.sqrt(brute_squared(on, clip)), 0.0)
        assert all(got[s, y, x] == pytest.approx(want[y, x]) for k, y, x, _, _ in rows if k == s)


def test_a_pixel_moves_once(spark):
    """At clip 64 the rows dealt are the pixels and the halo copies of boundary pixels."""
    px = spark.range(512 * 512).selectExpr("0L AS scene_id", "id div 512 AS y", "id % 512 AS x", "1 AS valid", "id % 97 = 0 AS b")
    got = N.distance_transform(px, "b", 64)
    assert got.count() == 512 * 512
    assert got.where("distance = 0").count() == -(-512 * 512 // 97)


def brute_labels(on, connectivity):
    label, todo = {}, []
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (connectivity == 8 or not (a and b))]
    for p in sorted(on):
        if p in label:
            continue
        label[p] = p
        todo = [p]
        while todo:
            y, x = todo.pop()
            for a, b in steps:
                q = (y + a, x + b)
                if q in on and q not in label:
                    label[q] = p
                    todo.append(q)
    return label


@pytest.mark.parametrize("connectivity", [4, 8])
@pytest.mark.parametrize("tile", [3, 8, 256])
def test_components_over_tiles(spark, monkeypatch, tile, connectivity):
    monkeypatch.setattr(N, "TILE", tile)
    d = np.random.default_rng(tile)
    scenes = [{(int(y), int(x)) for y, x in zip(*np.nonzero(d.random((20, 33)) < share))} for share in (0.4, 0.6, 0.97)]
    df = spark.createDataFrame([(s, y, x) for s, on in enumerate(scenes) for y, x in on], POINT)
    got = {(r.scene_id, r.y, r.x): r.label for r in N.connected_components(df, 33, 20, connectivity).collect()}
    assert got == {(s, *p): y * 33 + x + 1 for s, on in enumerate(scenes) for p, (y, x) in brute_labels(on, connectivity).items()}


def test_rounds_work_on_border_pixels(spark):
    """A full scene of 256 x 256 pixels in tiles of 64: links in the order of the borders, one for each pair of tiles here."""
    full = spark.range(256 * 256).selectExpr("0L AS scene_id", "id div 256 AS y", "id % 256 AS x")
    labelled = N._tile_labels(full, 256, 256, 4, 64)
    assert labelled.select("node").distinct().count() == 16
    assert N.border_links(labelled, 4, 64).count() == 24
    comb = full.where("x % 2 = 0")
    assert N.border_links(N._tile_labels(comb, 256, 256, 4, 64), 4, 64).count() == 3 * 128


def test_far_points_keep_few_cells(spark):
    """Targets in opposite corners and 10^5 points between: a few cells a point, and the exact distance."""
    n = 4000
    points = spark.range(100_000).selectExpr("0L AS scene_id", f"(id * 7919) % {n} AS y", f"(id * 104729) % {n} AS x").distinct()
    targets = spark.createDataFrame([(0, 0, 0), (0, n - 1, n - 1)], "scene_id long, ty long, tx long")
    leaves = S.leaf_cells(points, targets)
    assert leaves.count() <= 2 * points.count()
    got = S.nearest_squared(points, targets.toDF("scene_id", "y", "x"))
    far = f"least(y * y + x * x, ({n - 1} - y) * ({n - 1} - y) + ({n - 1} - x) * ({n - 1} - x))"
    assert got.count() == points.count() and got.where(f"d2 <> {far}").count() == 0


def test_pyramid_equals_brute_force(spark):
    d = np.random.default_rng(8)
    targets = [(s, int(y), int(x)) for s in (0, 1) for y, x in np.concatenate([d.integers(0, 40, (30, 2)), d.integers(600, 900, (30, 2))])]
    circle = [(2, int(300 + 200 * np.cos(a)), int(300 + 200 * np.sin(a))) for a in np.linspace(0, 6.28, 80)]
    points = [(s, int(y), int(x)) for s in (0, 1, 2, 3) for y, x in d.integers(-300, 1200, (40, 2))] + [(2, 300, 300)]
    p, t = spark.createDataFrame(points, POINT), spark.createDataFrame(targets + circle, POINT)
    got = {(r.scene_id, r.y, r.x): r.d2 for r in S.nearest_squared(p, t, 1.5, 0.5).collect()}
    want = {q: min(((1.5 * (q[1] - y)) ** 2 + (0.5 * (q[2] - x)) ** 2 for s, y, x in targets + circle if s == q[0]), default=None) for q in points}
    assert got == pytest.approx(want) and got.keys() == want.keys()
