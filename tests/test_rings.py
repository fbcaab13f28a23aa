"""Simple rings, simplification and drop reasons against brute force."""

import collections
import random

import pytest

from sparkraster.operators import rings as R

RINGS = "scene_id long, parcel_id long, ring_no int, ring array<struct<x:double,y:double>>"


def table(spark, rows):
    return spark.createDataFrame([(s, i, n, None if ring is None else [(float(x), float(y)) for x, y in ring]) for s, i, n, ring in rows], RINGS)


def turn(p, q, r):
    v = (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return (v > 0) - (v < 0)


def on(p, q, r):
    return turn(p, q, r) == 0 and min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])


def dedup(ring):
    return [p for i, p in enumerate(ring) if len(ring) == 1 or p != ring[i - 1]]


def brute_invalid(rings):
    segs = []
    for n, ring in enumerate(map(dedup, rings)):
        if len(ring) >= 3:
            segs += [(n, i, len(ring), ring[i], ring[(i + 1) % len(ring)]) for i in range(len(ring))]
    for k, (n, i, size, a, b) in enumerate(segs):
        for m, j, _, c, d in segs[k + 1 :]:
            proper = turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0
            if n != m:
                bad = proper
            elif abs(j - i) in (1, size - 1):
                bad = turn(a, b, c) == 0 and turn(a, b, d) == 0 and (b[0] - a[0]) * (d[0] - c[0]) + (b[1] - a[1]) * (d[1] - c[1]) < 0
            else:
                bad = proper or on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b)
            if bad:
                return True
    return False


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]])) / 2 if len(ring) >= 3 else 0.0


def test_invalid_rings_equal_brute_force(spark):
    rnd = random.Random(2)
    parcels, rows = {}, []
    for i in range(250):
        size = rnd.choice([6, 40, 700])
        some = [[(rnd.randrange(size), rnd.randrange(size)) for _ in range(rnd.choice([2, 3, 4, 5, 8]))] for _ in range(rnd.choice([1, 1, 2]))]
        parcels[i] = some
        rows += [(i % 3, i, n, ring) for n, ring in enumerate(some)]
    got = {r.parcel_id for r in R.crossings(table(spark, rows)).collect()}
    want = {i for i, some in parcels.items() if brute_invalid(some)}
    assert got == want and 20 < len(want) < 230


def test_reasons(spark):
    square = [(0, 0), (10, 0), (10, 10), (0, 10)]
    rows = [
        (0, 1, 0, square), (0, 2, 0, None), (0, 3, 0, []), (0, 4, 0, [(1, 1), (1, 1), (5, 5)]), (0, 5, 0, [(0, 0), (10, 10), (10, 0), (0, 10)]),
        (0, 6, 0, [(0, 0), (2, 0), (2, 2), (0, 2)]), (0, 7, 0, [(0, 0), (100, 0), (100, 0.25), (0, 0.25)]),
        (0, 8, 0, square), (0, 8, 1, [(1, 1), (1, 9), (9, 9), (9, 1)]),  # a hole leaves 36
        (0, 9, 0, square), (0, 9, 1, [(1, 1), (1, 9.5), (9.5, 9.5), (9.5, 1)]),  # a hole leaves 27.75
        (0, 10, 0, [(0, 0), (10, 0), (10, 10), (5, 10), (5, 0), (5, 10), (0, 10)]),  # runs back over itself
        (0, 11, 0, [(0, 0), (0, 0), (6, 0), (6, 0), (6, 6), (0, 6), (0, 0)]), (1, 1, 0, [(0, 0), (5, 0), (5, 4), (0, 4)]),
        (0, 12, 0, square), (0, 12, 1, [(5, 5), (15, 5), (15, 8), (5, 8)]),  # a ring that leaves the other
    ]
    got = {(r.scene_id, r.parcel_id): (r.reason, r.area) for r in R.cleanup_rings(table(spark, rows), 20.0, 0.5).collect()}
    assert {k: v[0] for k, v in got.items()} == {
        (0, 1): None, (0, 2): "empty", (0, 3): "empty", (0, 4): "empty", (0, 5): "invalid", (0, 6): "small_area", (0, 7): "simplified_away", (0, 8): None,
        (0, 9): None, (0, 10): "invalid", (0, 11): None, (1, 1): "small_area", (0, 12): "invalid",
    }
    assert got[0, 8][1] == pytest.approx(36) and got[0, 9][1] == pytest.approx(27.75) and got[1, 1][1] == 20
    loose = collections.Counter(r.reason for r in R.cleanup_rings(table(spark, rows)).collect())
    assert loose == {None: 7, "empty": 3, "invalid": 3}
    assert R.cleanup_rings(table(spark, []), 1.0, 1.0).count() == 0


@pytest.mark.parametrize("tolerance", [0.3, 1.0, 4.0])
def test_simplified_rings_stay_within_the_tolerance(spark, tolerance):
    rnd = random.Random(5)
    rings = {i: [(rnd.uniform(0, 20), rnd.uniform(0, 20)) for _ in range(rnd.randrange(1, 30))] for i in range(60)}
    got = {r.parcel_id: [(p.x, p.y) for p in r.ring] for r in R.simplify_rings(table(spark, [(0, i, 0, ring) for i, ring in rings.items()]), tolerance).collect()}
    for i, ring in rings.items():
        made = got[i]
        assert made == [p for p in ring if p in set(made)] and (not made or len(made) >= 3)
        if made:
            for p in ring:
                near = min(distance(p, a, b) for a, b in zip(made, [*made[1:], made[0]]))
                assert near <= tolerance + 1e-9


def distance(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    t = min(max(((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy or 1.0), 0.0), 1.0)
    return ((p[0] - a[0] - t * dx) ** 2 + (p[1] - a[1] - t * dy) ** 2) ** 0.5


def test_polygons_of_labels_are_simple(spark):
    """Rings traced from pixels, without holes that touch at a corner."""
    from sparkraster.operators.polygons import polygonize

    image = ["1110", "1010", "1112", "0222"]
    labels = spark.createDataFrame([(0, y, x, int(v)) for y, row in enumerate(image) for x, v in enumerate(row)], "scene_id long, y long, x long, label long")
    rings = polygonize(labels, 2).selectExpr("scene_id", "label AS parcel_id", "ring_no", "points AS ring")
    got = {r.parcel_id: (r.reason, r.area) for r in R.cleanup_rings(rings).collect()}
    assert got == {1: (None, 8.0), 2: (None, 4.0)}
