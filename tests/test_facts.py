"""Facts of the operators on tiny scenes."""

import math

import pytest
from pyspark.sql import functions as F

from sparkraster.functions import bands as B
from sparkraster.operators import metrics as M
from sparkraster.operators import neighbourhood as N
from sparkraster.operators import pixels as P
from sparkraster.operators import regions as R
from sparkraster.operators import sampling as G
from sparkraster.operators import spatial as S
from sparkraster.operators import tiling as T
from sparkraster.operators.graph import components
from sparkraster.operators.polygons import polygonize

PX = "scene_id long, y long, x long, valid int, gt_extent int, gt_boundary int, extent_prob double, p_bg double, p_skel double, p_buf double, gt_distance double, distance_pred double"


def scene(spark, h, w, **at):
    """Pixels of one scene; ``at`` gives a column as a function of (y, x)."""
    base = dict(valid=1, gt_extent=0, gt_boundary=0, extent_prob=0.1, p_bg=1.0, p_skel=0.0, p_buf=0.0, gt_distance=0.0, distance_pred=0.0)
    names = [c.split()[0] for c in PX.split(", ")][3:]
    rows = [(0, y, x, *[at[c](y, x) if c in at else base[c] for c in names]) for y in range(h) for x in range(w)]
    return spark.createDataFrame(rows, PX)


def test_confusion_of_4x4(spark):
    high = {(1, 1), (1, 2), (2, 2), (0, 0), (3, 3)}
    px = scene(
        spark, 4, 4, gt_extent=lambda y, x: 255 if (y, x) == (0, 0) else int(1 <= y <= 2 and 1 <= x <= 2),
        valid=lambda y, x: int((y, x) != (3, 3)), extent_prob=lambda y, x: 0.9 if (y, x) in high else 0.4 if (y, x) == (2, 1) else 0.8 if (y, x) == (0, 1) else 0.1,
    )
    r = M.pixel_metrics(px).first()
    assert (r.tp, r.fp, r.fn, r.tn, r.ignored_px, r.invalid_px) == (3, 1, 1, 9, 1, 1)
    assert r.precision == r.recall == r.f1 == 0.75 and r.iou == pytest.approx(0.6)


def test_boundary_perfect_and_shifted(spark):
    def at(col):
        return scene(spark, 5, 6, gt_boundary=lambda y, x: int(1 <= y <= 3 and x == 2), p_bg=lambda y, x: 0.2 if 1 <= y <= 3 and x == col else 0.9,
                     p_skel=lambda y, x: 0.7 if 1 <= y <= 3 and x == col else 0.05, p_buf=lambda y, x: 0.1 if 1 <= y <= 3 and x == col else 0.05)

    same = M.boundary_metrics(at(2)).where("pred_mode = 'skeleton' AND gt_mode = 'skeleton'").first()
    assert same.f1 == 1.0
    for col, bde in ((2, 0.0), (3, 1.0)):
        px = at(col)
        r = S.boundary_displacement(px.where("gt_boundary = 1"), px.where("p_skel > 0.5")).first()
        assert r.bde == bde


def test_nearest_equals_brute_force(spark):
    a, b = [(0, (i * 37) % 90, (i * 53) % 80) for i in range(40)], [(0, (i * 61) % 95, (i * 17) % 85) for i in range(15)]
    got = {(r.y, r.x): r.d2 for r in S.nearest_squared(*(spark.createDataFrame(v, "scene_id long, y long, x long") for v in (a, b))).collect()}
    assert got == {(y, x): min((y - v) ** 2 + (x - w) ** 2 for _, v, w in b) for _, y, x in a}


def test_objects_same_merged_split(spark):
    kind = "scene_id long, parcel_id long, x0 long, y0 long, w long, h long"
    two = spark.createDataFrame([(0, 1, 1, 1, 3, 3), (0, 2, 4, 1, 3, 3)], kind)
    one = spark.createDataFrame([(0, 9, 1, 1, 6, 3)], kind)
    same = S.object_metrics(two, S.matches(S.box_overlaps(two, two))).first()
    assert same.gtc == 0
    merged = S.object_metrics(two, S.matches(S.box_overlaps(two, one))).first()
    assert (merged.split_gt, merged.merged_gt, merged.guc) == (0, 2, 1.0)
    split = S.object_metrics(one, S.matches(S.box_overlaps(one, two))).first()
    assert (split.split_gt, split.goc) == (1, 1.0)


def test_ring_with_hole(spark):
    p = lambda pts: [{"x": float(x), "y": float(y)} for x, y in pts]
    rows = [(0, 1, p([(0, 0), (6, 0), (6, 6), (0, 6)])), (0, 1, p([(2, 2), (4, 2), (4, 4), (2, 4)]))]
    df = spark.createDataFrame(rows, "scene_id long, parcel_id long, ring array<struct<x:double,y:double>>")
    got = {(r.y, r.x) for r in S.rasterize_rings(df).collect()}
    assert got == {(y, x) for y in range(6) for x in range(6)} - {(y, x) for y in (2, 3) for x in (2, 3)}


def test_offsets_and_windows(spark):
    s = spark.createDataFrame([(0, 100, 60)], "scene_id long, height int, width int")
    ys = {r.yoff for r in T.windows(s, 32).collect()}
    assert ys == {0, 16, 32, 48, 64, 68} and max(ys) + 32 == 100
    small = spark.createDataFrame([(0, 10, 10)], "scene_id long, height int, width int")
    assert T.windows(small, 32).count() == 0 and T.windows(small, 32, small=True).count() == 1


def test_blend_of_constant_and_invalid(spark):
    for valid, want in ((1, 0.5), (0, 0.0)):
        px = scene(spark, 8, 8, valid=lambda y, x: valid, extent_prob=lambda y, x: 0.5)
        b = T.blend(T.assign(px, 8, 8, 4, 3), ["extent_prob"], 4)
        assert b.count() == 64 and all(r.extent_prob == pytest.approx(want) for r in b.collect())


@pytest.mark.parametrize(("valid", "edge", "want"), [(0.04, 0, None), (0.3, 0.5, "near_invalid"), (0.9, 0.1, "boundary_positive"), (0.8, 0, "hard_negative"), (0.6, 0, "center_positive"), (0.9, 0.05, "center_positive")])
def test_patch_class(spark, valid, edge, want):
    r = spark.range(1).select(T.patch_class(F.lit(valid), F.lit(edge)).alias("c")).first()
    assert r.c == want


def test_split_sizes_and_order(spark):
    df = spark.range(100).withColumnRenamed("id", "xoff")
    got = {r.xoff: r.split for r in G.ordered_split(df, ["xoff"]).collect()}
    assert [got[i] for i in range(100)] == ["train"] * 70 + ["val"] * 15 + ["test"] * 15
    a, b = (sorted(map(tuple, G.random_split(df, ["xoff"], seed=s).collect())) for s in (1, 1))
    assert a == b and sorted(map(tuple, G.random_split(df, ["xoff"], seed=2).collect())) != a


def test_weighted_sample_with_replacement(spark):
    df = spark.createDataFrame([(i, float(w)) for i, w in enumerate([1, 1, 8])], "k long, w double")
    got = [r.k for r in G.weighted_sample(df, "w", ["k"], 10, 3, replacement=True).collect()]
    assert len(got) == 10 and got.count(2) == 8


def test_components_labels(spark):
    px = scene(spark, 5, 5)
    mask = px.where("(y = 0 AND x < 2) OR (y = 1 AND x = 2) OR (y = 4 AND x = 4)")
    four = {r.label for r in N.connected_components(mask, 5, 5).collect()}
    eight = {r.label for r in N.connected_components(mask, 5, 5, connectivity=8).collect()}
    assert len(four) == 3 and len(eight) == 2


def test_components_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert components(links.where("a < 0")).count() == 0


def test_polygon_of_label_with_hole(spark):
    rows = [(0, y, x, 1) for y in range(3) for x in range(3) if (y, x) != (1, 1)]
    r = polygonize(spark.createDataFrame(rows, "scene_id long, y long, x long, label long")).orderBy("ring_no").collect()
    assert [len(x.points) for x in r] == [4, 4]


def test_clip_of_distance(spark):
    px = scene(spark, 6, 6, valid=lambda y, x: int((y, x) != (5, 5)), gt_boundary=lambda y, x: int((y, x) == (0, 0)))
    d = {(r.y, r.x): r.distance for r in N.distance_transform(px, "gt_boundary = 1", 3).collect()}
    assert d[0, 0] == 0 and d[1, 1] == pytest.approx(math.sqrt(2)) and d[4, 4] == 3 and d[5, 5] == 0
    none = N.distance_transform(scene(spark, 2, 2), "gt_boundary = 1", 3)
    assert {r.distance for r in none.collect()} == {3.0}


def test_valid_mask_needs_a_policy(spark):
    px = spark.createDataFrame([(0, 0, 0, float("nan")), (0, 0, 1, 2.0)], "scene_id long, y long, x long, b1 double")
    with pytest.raises(ValueError):
        P.valid_mask(px)
    assert [r.valid for r in P.valid_mask(px, nodata=float("nan")).orderBy("x").collect()] == [0, 1]
    assert [r.valid for r in P.valid_mask(px, override=True).collect()] == [1, 1]


def test_window_outside_scene():
    gt = [0.0, 1.0, 0.0, 100.0, 0.0, -1.0]
    assert P.bounds_to_window(gt, 100, 100, (-5, 90, 10, 200)) == (0, 10, 0, 10)
    with pytest.raises(ValueError):
        P.bounds_to_window(gt, 100, 100, (200, 0, 300, 10))


def test_sketch_percentiles_are_near(spark):
    px = spark.range(20_000).selectExpr("0 AS scene_id", "1 AS valid", "CAST(id AS DOUBLE) AS b1", "id % 7 AS part")
    merged = M.merge_sketches(M.band_sketches(px, ["b1"], ["part"]), ["b1"])
    r = M.sketch_percentiles(merged, ["b1"], 0.1, 0.9).first()
    assert r.n_valid == 20_000 and abs(r.p_lo - 2_000) < 600 and abs(r.p_hi - 18_000) < 600


def test_flat_range_rescales_to_low(spark):
    assert spark.range(1).select(B.rescale(F.lit(5.0), 3, 3).alias("v")).first().v == 0.0


def test_manifest_round_trip(spark, tmp_path):
    from sparkraster.operators import runs as J

    good = spark.createDataFrame([tuple("abcdefgh") + ("success",)], ", ".join(f"{c} string" for c in J.REQUIRED_FIELDS))
    J.write_manifests(good, str(tmp_path / "m"))
    back = spark.read.json(str(tmp_path / "m"))
    assert back.count() == 1 and J.manifest_contract(good).count() == 0
    with pytest.raises(ValueError):
        J.write_manifests(good.withColumn("status", F.lit("done")), str(tmp_path / "n"))


def test_patch_meta_files(spark, tmp_path):
    from sparkraster.sources.datasets import read_patch_meta

    (tmp_path / "patch_000001_meta.json").write_text('{\n "patch_id": "patch_000001",\n "xoff": 3, "yoff": 4, "valid_ratio": 0.5}')
    (tmp_path / "other.json").write_text("{}")
    r = read_patch_meta(spark, str(tmp_path)).collect()
    assert len(r) == 1 and r[0].xoff == 3 and r[0].feature_mode is None


@pytest.mark.parametrize(("tile", "top", "h", "w"), [(3, 3, 7, 9), (3, 12, 7, 9), (64, 64, 7, 9), (4, 1024, 37, 41)])
def test_growth_equals_kruskal(spark, tile, top, h, w, monkeypatch):
    import random

    from sparkraster.operators import growth

    monkeypatch.setattr(growth, "TILE", tile)
    monkeypatch.setattr(growth, "TOP", top)

    rnd = random.Random(3)
    relief = {(y, x): rnd.randrange(12) for y in range(h) for x in range(w)}
    seeds = {(0, 0): 1, (0, 1): 1, (6, 8): 2, (3, 4): 3, (6, 0): 3}
    n = {p: p[0] * w + p[1] for p in relief}
    edges = sorted((max(relief[p], relief[q]), n[p], n[q]) for p in relief for q in ((p[0], p[1] + 1), (p[0] + 1, p[1])) if q in relief)
    up, mark = {i: i for i in n.values()}, {}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    first = {}
    for p, k in sorted(seeds.items()):
        up[n[p]] = first.setdefault(k, n[p])
        mark[first[k]] = k
    for _, a, b in edges:
        a, b = root(a), root(b)
        if a != b and not (a in mark and b in mark):
            keep, gone = (a, b) if a in mark or b not in mark else (b, a)
            up[gone] = keep
    want = {p: mark.get(root(i), 0) for p, i in n.items()}
    px = spark.createDataFrame([(0, y, x, r, 1, True) for (y, x), r in relief.items()], "scene_id long, y long, x long, relief int, valid int, inside boolean")
    m = spark.createDataFrame([(0, y, x, k) for (y, x), k in seeds.items()], "scene_id long, y long, x long, label long")
    assert {(r.y, r.x): r.label for r in growth.grow(px, m, h, w).collect()} == want
    masked = growth.grow(px.withColumn("valid", F.expr("CASE WHEN y = 0 THEN 0 ELSE 1 END")).withColumn("inside", F.expr("x > 0")), m, h, w)
    assert {r.label for r in masked.where("y = 0").collect()} == {-1} and {r.label for r in masked.where("y > 0 AND x = 0").collect()} == {0}
