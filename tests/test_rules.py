"""Rules with nulls, real names and slanted shapes, against brute force."""

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from sparkraster.operators import neighbourhood as N
from sparkraster.operators import pixels as P
from sparkraster.operators import runs as J
from sparkraster.operators import sampling as G
from sparkraster.operators import spatial as S

RECORD = {
    "schema_name": "eval", "schema_version": "1", "module_name": "m", "module_version": None, "data_contract_version": "1", "run_id": "r",
    "stage_name": None, "created_at_utc": "2020", "status": "success",
}
SCHEMA = ", ".join(f"{c} string" for c in RECORD)


def test_manifest_fields_may_be_null_or_not(spark):
    rows = [RECORD | {"run_id": "good"}, RECORD | {"run_id": "name", "module_name": None}, RECORD | {"run_id": "blank", "schema_version": " "},
            RECORD | {"run_id": "done", "status": "done"}, RECORD | {"run_id": "null", "status": None}]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.run_id, r.violation) for r in J.manifest_contract(df).collect()}
    assert got == {("name", "missing_module_name"), ("blank", "missing_schema_version"), ("done", "status"), ("null", "missing_status")}
    assert {r.violation for r in J.manifest_contract(df.where("run_id = 'good'").drop("module_version")).collect()} == {"missing_module_version"}


def test_orientation_of_real_metrics(spark):
    runs = spark.createDataFrame([(1, 0.5, 3.0, 0.4), (2, 0.6, 2.0, None)], "run_id long, extent_f1 double, boundary_bde double, normalized_gtc double")
    pairs = spark.createDataFrame([(1, 2)], "left_id long, right_id long")
    got = {r.metric: (r.orientation, r.improved, r.status) for r in J.run_delta(pairs, runs, ["extent_f1"], ["boundary_bde", "normalized_gtc"]).collect()}
    assert got == {
        "extent_f1": ("higher_is_better", True, "ok"), "boundary_bde": ("lower_is_better", True, "ok"), "normalized_gtc": ("lower_is_better", None, "skipped"),
    }
    with pytest.raises(ValueError, match="run_id"):
        J.run_delta(pairs, runs, ["run_id"], [])


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_tables_come_back(spark, tmp_path, kind):
    schema = "left_id long, metric string, delta double"
    rows = [(1, "a", 0.1), (2, "b, \"c\"", None), (None, "", -1e-9)]
    J.export_table(spark.createDataFrame(rows, schema), str(tmp_path / "t"), kind)
    assert sorted(map(str, (tuple(r) for r in J.read_table(spark, str(tmp_path / "t"), schema, kind).collect()))) == sorted(map(str, rows))
    with pytest.raises(ValueError, match="unknown"):
        J.export_table(spark.createDataFrame(rows, schema), str(tmp_path / "u"), "xml")


def test_predict_mask_priority(spark):
    px = spark.createDataFrame([(0, 1, 0.0, 0), (1, 0, 5.0, 1), (2, None, None, None)], "x int, m int, b1 double, force int")
    valid = lambda **given: [r.valid for r in P.valid_mask(px, mode="predict", **given).orderBy("x").collect()]
    assert valid(mask="m", nodata=0.0, override="force") == [1, 0, 0]
    assert valid(nodata=0.0, override="force") == [0, 1, 0]
    assert valid(override="force") == [0, 1, 0] and valid(override=True) == [1, 1, 1]
    with pytest.raises(ValueError):
        P.valid_mask(px, mode="predict")
    with pytest.raises(ValueError):
        P.valid_mask(px, mask="m", mode="other")


def touched(a, b, y, x):
    """Whether a point of the segment lies in the pixel, right and bottom edges left out."""
    lo, hi, lo_open, hi_open = Fraction(0), Fraction(1), False, False
    for s, e, at in ((a[0], b[0], x), (a[1], b[1], y)):
        s, d = Fraction(s), Fraction(e) - Fraction(s)
        if d == 0:
            if not at <= s < at + 1:
                return False
            continue
        t0, t1 = (at - s) / d, (at + 1 - s) / d
        t0_open, t1_open = False, True
        if t0 > t1:
            t0, t1, t0_open, t1_open = t1, t0, t1_open, t0_open
        if t0 > lo or t0 == lo and t0_open:
            lo, lo_open = t0, t0_open
        if t1 < hi or t1 == hi and t1_open:
            hi, hi_open = t1, t1_open
    return lo < hi or lo == hi and not lo_open and not hi_open


def test_outlines_touch_all_pixels(spark):
    rnd = random.Random(4)
    rings = []
    for i in range(12):
        n = rnd.choice([3, 4, 5])
        rings.append((i, 1, [(rnd.randrange(36) / 4, rnd.randrange(36) / 4) for _ in range(n)]))
    df = spark.createDataFrame(rings, "scene_id long, parcel_id long, ring array<struct<x:double,y:double>>")
    got = {(r.scene_id, r.y, r.x) for r in S.outline_rings(df).collect()}
    want = {(i, y, x) for i, _, ring in rings for k in range(len(ring)) for y in range(10) for x in range(10) if touched(ring[k], ring[(k + 1) % len(ring)], y, x)}
    assert got == want


def test_far_points_find_the_nearest(spark):
    rnd = random.Random(6)
    points = [(s, rnd.randrange(300), rnd.randrange(300)) for s in (0, 1, 2) for _ in range(30)]
    targets = [(0, rnd.randrange(300), rnd.randrange(300)) for _ in range(5)] + [(1, 299, 299)]
    p, t = (spark.createDataFrame(v, "scene_id long, y long, x long") for v in (points, targets))
    got = {(r.scene_id, r.y, r.x): r.d2 for r in S.nearest_squared(p, t, 2.0, 3.0).collect()}
    want = {q: min((4.0 * (q[1] - y) ** 2 + 9.0 * (q[2] - x) ** 2 for s, y, x in targets if s == q[0]), default=None) for q in points}
    assert got == want


def test_components_meet_at_tile_borders(spark, monkeypatch):
    monkeypatch.setattr(N, "TILE", 4)
    rnd = random.Random(7)
    on = {(y, x) for y in range(8) for x in range(30) if rnd.random() < 0.6}
    df = spark.createDataFrame([(0, y, x) for y, x in on], "scene_id long, y long, x long")
    for connectivity in (4, 8):
        near = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (abs(a) + abs(b) == 1 or connectivity == 8) and (a or b)]
        label = {p: p[0] * 30 + p[1] + 1 for p in on}
        changed = True
        while changed:
            changed = False
            for y, x in on:
                low = min([label[y, x], *(label[y + a, x + b] for a, b in near if (y + a, x + b) in on)])
                changed, label[y, x] = changed or low < label[y, x], low
        got = {(r.y, r.x): r.label for r in N.connected_components(df, 30, 8, connectivity).collect()}
        assert got == label


def test_quantiles_over_ranges(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 500), np.round(rng.standard_normal(500), 1))] + [(3, 1.5), (0, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    for r in G.exact_quantiles(df, "g", "v", [0.0, 0.33, 0.5, 1.0]).collect():
        v = [x for g, x in rows if g == r.g and x is not None]
        assert r.n == len(v) and [r.q0, r.q1, r.q2, r.q3] == pytest.approx(np.quantile(v, [0, 0.33, 0.5, 1]))
    assert G.exact_quantiles(df.where("false"), "g", "v", [0.5]).count() == 0


def test_overlaps_of_valid_pixels(spark):
    kind = "scene_id long, parcel_id long, y long, x long"
    gt = spark.createDataFrame([(0, 1, 0, x) for x in range(6)] + [(0, 2, 0, x) for x in range(4, 8)] + [(1, 1, 0, 0)], kind)
    pred = spark.createDataFrame([(0, 9, 0, x) for x in range(3, 7)] + [(0, 8, 5, 5)], kind)
    valid = spark.createDataFrame([(0, 0, x) for x in range(7) if x != 5] + [(1, 0, 0)], "scene_id long, y long, x long")
    got = {(r.gt_id, r.pred_id): (r.inter, r.gt_area, r.pred_area) for r in S.overlaps(gt, pred, valid).collect()}
    assert got == {(1, 9): (2, 5, 3), (2, 9): (2, 2, 3)}
    assert {(r.gt_id, r.pred_id): r.inter for r in S.overlaps(gt, pred).collect()} == {(1, 9): 3, (2, 9): 3}


def test_lineage_of_lines_and_cycles(spark):
    rows = [(i, i - 1 if i else None) for i in range(12)] + [(20, 21), (21, 20)]
    got = {(r.run_id, r.ancestor_id): r.depth for r in J.lineage(spark.createDataFrame(rows, "run_id long, parent_id long")).collect()}
    assert got == {(i, j): i - j for i in range(12) for j in range(i)} | {(20, 21): 1, (21, 20): 1, (20, 20): 2, (21, 21): 2}
    assert J.lineage(spark.createDataFrame([(1, None)], "run_id long, parent_id long")).count() == 0


def test_growth_of_the_fixture(spark):
    from sparkraster.operators import growth

    rows = [(0, y, x, 5 if x == 1 else 1, 1, x != 1) for y in range(5) for x in range(7)]
    px = spark.createDataFrame(rows, "scene_id long, y long, x long, relief int, valid int, inside boolean")
    for seeds, instances in (([(0, 2, 0, 1), (0, 2, 6, 2)], 2), ([(0, 2, 0, 1)], 1)):
        m = spark.createDataFrame(seeds, "scene_id long, y long, x long, label long")
        got = {(r.y, r.x): r.label for r in growth.grow(px, m, 5, 7).collect()}
        assert len({v for v in got.values() if v > 0}) == instances and all(v == 0 for (y, x), v in got.items() if x == 1)
    assert growth.grow(px, m.where("false"), 5, 7).where("label <> 0").count() == 0
