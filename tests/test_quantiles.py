"""Exact quantiles by sketches and brackets, against sorting."""

import math

import numpy as np
import pytest

from sparkraster.operators import metrics as M
from sparkraster.operators import sampling as G

QS = [0.0, 0.005, 0.33, 0.5, 0.66, 0.995, 1.0]


def check(spark, groups, **limits):
    rows = [(g, None if v is None else float(v)) for g, values in groups.items() for v in values]
    got = {r.g: r for r in G.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", QS).collect()}
    want = {g: [v for v in values if v is not None] for g, values in groups.items()}
    assert got.keys() == {g for g, v in want.items() if v}
    for g, r in got.items():
        assert r.n == len(want[g])
        assert [r[f"q{i}"] for i in range(len(QS))] == pytest.approx(np.quantile(want[g], QS), rel=1e-12)


def groups(n):
    d = np.random.default_rng(n)
    return {
        "normal": d.normal(0, 1, n), "ties": d.integers(0, 4, n), "one": [3.25], "two": [1, None, 9], "none": [None], "equal": [7] * n,
        "heavy": np.concatenate([np.zeros(n // 2), d.random(n - n // 2)]), "wide": 10.0 ** d.uniform(-300, 300, n // 3),
    }


def test_quantiles_equal_sorting(spark):
    check(spark, groups(20_000))


def test_brackets_are_narrowed_until_they_fit(spark, monkeypatch):
    monkeypatch.setattr(G, "SORTED", 40)
    check(spark, groups(6_000))


def test_wrong_sketches_are_found_out(spark, monkeypatch):
    """Brackets far off their ranks are widened, whatever the sketch says."""
    right = G._Rank.narrowed

    def off(self):
        if self.margin < 100:
            return self.cuts[0] - 2.0, self.cuts[0] - 1.0
        return right(self)

    monkeypatch.setattr(G._Rank, "narrowed", off)
    check(spark, {"a": list(range(1000)), "b": [1, 2]})


def test_nan_sorts_last(spark):
    df = spark.createDataFrame([(0, float(i)) for i in range(8)] + [(0, math.nan), (0, math.nan), (1, math.nan), (None, 1.0)], "g int, v double")
    got = {r.g: r for r in G.exact_quantiles(df, "g", "v", [0.5, 0.75, 1.0]).collect()}
    assert got.keys() == {0, 1} and got[0].q0 == 4.5 and got[0].q1 == 6.75 and math.isnan(got[0].q2) and math.isnan(got[1].q0)


def test_band_percentiles_move_few_values(spark):
    """The table is read twice and not written: only values near the two ranks are grouped."""
    d = np.random.default_rng(0)
    px = spark.createDataFrame([(1, *map(float, r)) for r in d.normal(0, 1, (30_000, 2))], "valid int, b1 double, b2 double")
    got = M.band_percentiles(px, ["b1", "b2"]).collect()
    rows = np.array(px.collect())[:, 1:]
    for r in got:
        assert (r.p_lo, r.p_hi) == pytest.approx(tuple(np.quantile(rows[:, r.band_idx], [0.005, 0.995])), rel=1e-12)
