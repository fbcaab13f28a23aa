"""Exact top-k search from the impact-ordered index against brute force."""

import collections
import math
from fractions import Fraction

import numpy as np
import pytest
from compare import connect, of_spark, of_sql

from sparkraster.llm import impact_search, queries

SF = "/root/testdata/sf0.01"
ROWS = "vec_id long, embedding array<double>"


def brute(rows, every, k=5):
    """(query_id, rank, vec_id, score) counted, from all pairs in Python integers."""
    ok = [(n, i, [math.floor(256 * Fraction(x)) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = collections.Counter()
    for n, i, q in ok:
        if i is None or i % every:
            continue
        scored = [(min(max(sum(a * b for a, b in zip(q, v)), -(1 << 63)), (1 << 63) - 1), j) for m, j, v in ok if m != n and len(v) == len(q)]
        scored.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for rank, (s, j) in enumerate(scored[:k], 1):
            out[i, rank, j, s] += 1
    return out


def found(spark, rows, every, k=5):
    df = spark.createDataFrame(rows, ROWS)
    return collections.Counter(tuple(r) for r in impact_search.search(df, f"vec_id % {every} = 0", k).collect())


def vectors(seed, n, dims):
    """Clusters, copies, sparse and constant rows."""
    d = np.random.default_rng(seed)
    x = d.normal(0, 0.2, (n, dims))
    x[n // 2 :] = x[: n - n // 2] + d.normal(0, 0.02, (n - n // 2, dims))
    x[::7] = x[0]
    x[3::11] *= d.random((len(x[3::11]), dims)) < 0.2
    return [(i, v) for i, v in enumerate(x.tolist())]


def test_query_equals_sql(spark):
    assert of_spark(queries.op12_impact_search(spark, SF)) == of_sql(connect(SF), queries.oracle_sql()["op12_impact_search"])


@pytest.mark.parametrize(("dims", "k", "every"), [(1, 5, 4), (3, 1, 10), (16, 5, 3), (40, 20, 9)])
def test_search_equals_brute_force_over_many_blocks(spark, monkeypatch, dims, k, every):
    monkeypatch.setattr(impact_search, "BLOCK", 40)
    monkeypatch.setattr(impact_search, "QUERIES", 12)
    monkeypatch.setattr(impact_search, "TILES", 3)
    rows = vectors(dims, 300, dims)
    assert found(spark, rows, every, k) == brute(rows, every, k)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [1.0, 2.0]), (50, None), (100, []), (1, []), (None, [1.0, 2.0]), (2, [math.nan, 1.0]), (3, [None, 1.0]),
        (4, [math.inf, 0.0]), (5, [1.0]), (150, [-1.0]), (6, [0.0, 0.0]), (7, [-3.0, 0.001]), (200, [0.0, 0.0]), (250, [5.0, 6.0, 7.0]),
    ]
    assert found(spark, rows, 50) == brute(rows, 50)
    empty = spark.createDataFrame([], ROWS).selectExpr("*", "1 AS uid", "2 AS dims", "3 AS block", "4 AS score")
    assert impact_search.search(empty, "vec_id % 50 = 0").count() == 0


def test_large_components_are_exact(spark):
    d = np.random.default_rng(4)
    rows = [(i, (d.normal(0, 1, 4) * 10.0 ** d.integers(0, 12)).tolist()) for i in range(60)] + [(60, [1e300, -1.0, 0.0, 0.0]), (61, [1.7e308, 1.0, 0.0, 0.0])]
    assert found(spark, rows, 5) == brute(rows, 5)


def test_stops_early_by_proof_and_loses_nothing():
    d = np.random.default_rng(9)
    centre = d.normal(0, 0.3, (40, 32))
    x = centre[d.integers(0, 40, 2000)] + d.normal(0, 0.03, (2000, 32))
    codes = impact_search.codes_of(x)
    ids = np.arange(2000)
    index = impact_search.Index(x, ids, ids, np.ones(2000, bool), impact_search.Index.order_of(codes))
    spent = 0
    for n in range(0, 2000, 40):
        some, cost = impact_search.possible_members(index, codes[n], n, 5, None)
        scores = codes @ codes[n]
        scores[n] = -(1 << 60)
        best = np.lexsort([ids, -scores])[:5]
        assert set(best) <= set(some)
        spent += cost
    assert spent < 0.6 * 50 * codes.size
