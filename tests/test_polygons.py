"""Rings traced by tile and stitched, against rings traced in one piece."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkraster.operators import polygons as P
from sparkraster.operators import regions as R

LABELS = "scene_id long, y long, x long, label long"


def brute(image, scene=0):
    """Rings of all labels, edge by edge over the whole image: (scene, label, ring_no) -> corners (x, y) from the first on."""
    out = {}
    steps = {0: ((0, 0), (1, 0)), 1: ((1, 0), (1, 1)), 2: ((1, 1), (0, 1)), 3: ((0, 1), (0, 0))}
    for label in np.unique(image[image > 0]):
        grid = np.pad(image == label, 1)
        edges = {}
        for y, x in zip(*np.nonzero(image == label)):
            for side, (dy, dx) in enumerate(((-1, 0), (0, 1), (1, 0), (0, -1))):
                if not grid[y + 1 + dy, x + 1 + dx]:
                    (ax, ay), (bx, by) = steps[side]
                    edges.setdefault((y + ay, x + ax), []).append((y + by, x + bx))
        rings = []
        while edges:
            start = min(edges)
            ring, here, to = [start], start, edges[start].pop()
            while to != start:
                ring.append(to)
                dy, dx = to[0] - here[0], to[1] - here[1]
                if not edges[here]:
                    del edges[here]
                here = to
                for ty, tx in ((dx, -dy), (dy, dx), (-dx, dy)):  # right, straight, left
                    if (here[0] + ty, here[1] + tx) in edges[here]:
                        to = (here[0] + ty, here[1] + tx)
                        edges[here].remove(to)
                        break
            for c in {here, start}:
                if c in edges and not edges[c]:
                    del edges[c]
            n = len(ring)
            keep = [p for i, p in enumerate(ring) if (p[0] - ring[i - 1][0]) * (ring[(i + 1) % n][1] - p[1]) != (p[1] - ring[i - 1][1]) * (ring[(i + 1) % n][0] - p[0])]
            rings.append([(int(x), int(y)) for y, x in keep])
        for no, ring in enumerate(sorted(rings, key=lambda r: (r[0][1], r[0][0]))):
            out[scene, int(label), no] = ring
    return out


def found(df):
    return {(r.scene_id, r.label, r.ring_no): [(int(p.x), int(p.y)) for p in r.points] for r in df.collect()}


def table(spark, *images):
    rows = [(s, int(y), int(x), int(v)) for s, image in enumerate(images) for (y, x), v in np.ndenumerate(image)]
    return spark.createDataFrame(rows, LABELS)


def spiral(n):
    image, y, x, dy, dx = np.zeros((n, n), int), 0, 0, 0, 1
    image[0, 0] = 1
    for _ in range(n * n):
        y2, x2 = y + dy, x + dx
        far = (y2 + dy, x2 + dx)
        if not (0 <= y2 < n and 0 <= x2 < n) or (0 <= far[0] < n and 0 <= far[1] < n and image[far]) or image[y2, x2]:
            dy, dx = dx, -dy
            if not (0 <= y + dy < n and 0 <= x + dx < n) or image[y + dy, x + dx]:
                break
            continue
        y, x = y2, x2
        image[y, x] = 1
    return image


def images():
    d = np.random.default_rng(5)
    ring = np.ones((17, 23), int)
    ring[3:12, 4:20] = 0
    ring[6:8, 6:9] = 1
    ring[9, 10:15] = 2
    return [
        d.integers(-1, 3, (13, 19)), (d.random((16, 16)) < 0.6).astype(int) * 7, np.indices((12, 15)).sum(0) % 2, np.indices((12, 15)).sum(0) % 2 + 1,
        np.ones((20, 9), int), ring, spiral(15), np.zeros((3, 3), int), np.array([[5]]),
    ]


@pytest.mark.parametrize("tile", [2, 8, 256])
def test_rings_equal_one_piece(spark, tile):
    some = images()
    want = {}
    for s, image in enumerate(some):
        want |= brute(image, s)
    assert found(P.polygonize(table(spark, *some), tile)) == want


def test_one_label_over_a_scene_is_many_small_groups(spark):
    """A comb whose only ring crosses most tiles: no piece is longer than the border in a tile, and a ring takes few rounds."""
    image = np.zeros((64, 64), int)
    image[:, ::2] = 1
    image[-1] = 1
    labels = table(spark, image)
    pieces = P.ring_pieces(labels, 8)
    assert pieces.select("ring").distinct().count() == 1 and pieces.count() > 64
    assert pieces.agg(F.max(F.size("points"))).first()[0] <= 4 * 8 * 8
    assert found(P.polygonize(labels, 8)) == brute(image)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 33])
def test_ring_order(spark, n):
    d = np.random.default_rng(n)
    rows, want = [], {}
    for scene, size in ((0, n), (1, 1), (2, 5)):
        nodes = d.permutation(1000)[:size].tolist()
        rows += [(scene, a, b) for a, b in zip(nodes, nodes[1:] + nodes[:1])]
        first = nodes.index(min(nodes))
        want |= {(scene, a): (min(nodes), i) for i, a in enumerate(nodes[first:] + nodes[:first])}
    got = P.ring_order(spark.createDataFrame(rows, "scene_id long, node long, next long")).collect()
    assert {(r.scene_id, r.node): (r.ring, r.part) for r in got} == want


def test_no_labels(spark):
    assert P.polygonize(table(spark, np.zeros((4, 4), int))).count() == 0
    assert P.polygonize(spark.createDataFrame([], LABELS)).count() == 0


def test_compact_of_many_labels(spark):
    image = np.array([[9, 0, -1, 4], [4, 7, 9, 0]])
    got = {(r.scene_id, r.y, r.x): r.label for r in R.compact(table(spark, image, image + 1)).collect()}
    for s, im in ((0, image), (1, image + 1)):
        order = {v: i + 1 for i, v in enumerate(np.unique(im[im > 0]).tolist())}
        assert all(got[s, y, x] == order.get(int(v), int(v)) for (y, x), v in np.ndenumerate(im))
