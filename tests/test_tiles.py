"""Whole-tile scoring: dense tiles, padding, halo, and tiles that are split over Arrow batches."""

import numpy as np
import pyarrow as pa
import pytest

from sparkraster.operators import tiling as T

PIXELS = "scene_id long, y int, x int, valid int, b0 double, b1 double"


def scene(spark, h, w, seed=0, hole=lambda y, x: False):
    d = np.random.default_rng(seed)
    rows = [(0, y, x, int(d.random() < 0.7), float(d.random()), None if d.random() < 0.1 else float(d.random())) for y in range(h) for x in range(w)]
    return spark.createDataFrame([r for r in rows if not hole(r[1], r[2])], PIXELS), rows


@pytest.mark.parametrize("batch", [1, 7, 10_000])
@pytest.mark.parametrize("halo", [0, 2])
def test_scorer_sees_whole_tiles(spark, batch, halo):
    """A convolution over a tile, whatever the size of the Arrow batches."""
    px, rows = scene(spark, 13, 17)
    size, stride = 8, 5
    image, valid = np.zeros((13, 17)), np.zeros((13, 17))
    for _, y, x, v, b0, _ in rows:
        image[y, x], valid[y, x] = b0, v
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        a = T.assign(px, 13, 17, size, stride, halo)
        got = {tuple(r)[:5]: r.score for r in T.score_tiles(a, ["b0"], T.mean_filter, size, halo).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for yoff in sorted({*range(0, 6, stride), 5}):
        for xoff in sorted({*range(0, 10, stride), 9}):
            for y in range(yoff, yoff + size):
                for x in range(xoff, xoff + size):
                    near = [(j, i) for j in range(max(0, y - 1, yoff - halo), min(13, y + 2, yoff + size + halo)) for i in range(max(0, x - 1, xoff - halo), min(17, x + 2, xoff + size + halo))]
                    n = sum(valid[p] for p in near)
                    want[0, yoff, xoff, y, x] = sum(image[p] * valid[p] for p in near) / n if n else 0.0
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_tiles_out_of_batches():
    rows = pa.table({"scene_id": [0] * 7, "yoff": [0, 0, 0, 0, 8, 8, 8], "xoff": [0, 0, 8, 8, 0, 0, 0], "v": range(7)})
    for cuts in ([7], [1, 6], [3, 1, 3], [1] * 7, [2, 2, 3], [4, 3]):
        batches, at = [], 0
        for n in cuts:
            batches += [rows.slice(at, n).to_batches()[0], rows.slice(0, 0).to_batches()[0] if rows.slice(0, 0).to_batches() else pa.RecordBatch.from_pylist([], schema=rows.schema)]
            at += n
        assert [t.column("v").to_pylist() for t in T.TileBatches(batches)] == [[0, 1], [2, 3], [4, 5, 6]]
    assert list(T.TileBatches([])) == []


def test_padding_nulls_and_several_outputs(spark):
    px, _ = scene(spark, 5, 6, hole=lambda y, x: (y, x) == (1, 1))
    seen = []

    def scorer(bands, mask):
        assert bands.shape == (2, 8, 8) and mask.shape == (8, 8)
        assert not bands[:, 5:].any() and not bands[:, :, 6:].any() and not mask[5:].any() and not bands[:, 1, 1].any() and mask[1, 1] == 0
        assert np.isfinite(bands).all()
        return np.stack([bands.sum(0), np.full(mask.shape, mask.sum(), float)])

    a = T.assign(px, 5, 6, 8, 8)
    got = T.score_tiles(a, ["b0", "b1"], scorer, 8, names=("total", "n"))
    seen = {(r.y, r.x): r for r in got.collect()}
    assert len(seen) == 29 and got.columns == ["scene_id", "yoff", "xoff", "y", "x", "valid", "total", "n"]
    values = {(r.y, r.x): r for r in px.collect()}
    assert all(r.total == pytest.approx(values[k].b0 + (values[k].b1 or 0.0)) and r.n == sum(v.valid for v in values.values()) for k, r in seen.items())


def test_tiles_without_valid_core_are_skipped(spark):
    """A valid pixel in the halo alone does not bring a tile."""
    rows = [(0, y, x, int((y, x) == (0, 8)), 1.0, 1.0) for y in range(8) for x in range(16)]
    a = T.assign(spark.createDataFrame(rows, PIXELS), 8, 16, 8, 8, halo=1)
    got = T.score_tiles(a, ["b0"], T.mean_filter, 8, 1).collect()
    assert {r.xoff for r in got} == {8} and len(got) == 64
    empty = T.assign(spark.createDataFrame([], PIXELS), 8, 16, 8, 8)
    assert T.score_tiles(empty, ["b0"], T.mean_filter, 8).count() == 0
