"""Raster, parcel and run tables derived from the driver's tables.

Each view is a list of (column, expression) over one table or view. The
expressions are written once: ``DIV`` stands for integer division, which Spark
spells ``div`` and DuckDB ``//``. ``sql`` gives the same views as a WITH clause
for the oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from sparkraster.tables import table

SCENE_PIXELS = 5000
SCENE_WIDTH = 100
SCENE_HEIGHT = 50

#: view -> (table or view it reads, filter, columns)
VIEWS: dict[str, tuple[str, str, list[tuple[str, str]]]] = {
    "px_raw": (
        "orders", "o_orderkey IS NOT NULL",
        [
            ("k", "o_orderkey"), ("scene_id", "o_orderkey DIV 5000"), ("y", "(o_orderkey % 5000) DIV 100"),
            ("x", "o_orderkey % 100"),
            ("valid", "CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey % 3 = 0 THEN 0 ELSE 1 END"),
            ("status", "o_orderstatus"), ("extent_prob", "CAST(o_totalprice AS DOUBLE) / 500000.0e0"),
            ("wa", "CAST((o_orderkey * 7919) % 97 + 1 AS DOUBLE)"), ("wb", "CAST((o_orderkey * 104729) % 89 + 1 AS DOUBLE)"),
            ("wc", "CAST((o_orderkey * 1299709) % 83 + 1 AS DOUBLE)"),
            ("gt_distance", "CAST((o_orderkey * 31) % 64 AS DOUBLE)"), ("distance_pred", "CAST((o_orderkey * 37) % 64 AS DOUBLE)"),
        ],
    ),
    "px": (
        "px_raw", "",
        [
            ("scene_id", "scene_id"), ("y", "y"), ("x", "x"), ("valid", "valid"),
            ("gt_extent", "CASE WHEN valid = 0 THEN 255 WHEN status = 'F' THEN 1 ELSE 0 END"),
            ("gt_boundary", "CASE WHEN status = 'P' THEN 1 WHEN status = 'O' AND k % 4 = 0 THEN 2 ELSE 0 END"),
            ("extent_prob", "extent_prob"), ("p_bg", "wa / (wa + wb + wc)"), ("p_skel", "wb / (wa + wb + wc)"),
            ("p_buf", "wc / (wa + wb + wc)"), ("gt_distance", "gt_distance"), ("distance_pred", "distance_pred"),
        ],
    ),
    "bands": (
        "embeddings", "vec_id IS NOT NULL",
        [("scene_id", "vec_id DIV 200"), ("y", "(vec_id % 200) DIV 20"), ("x", "vec_id % 20"), ("vec_id", "vec_id"), ("label", "label")]
        + [(f"b{i}", f"CAST(ELEM{i} AS DOUBLE) + 1.0e0") for i in range(1, 9)],
    ),
    "gt_rect": (
        "customer", "c_custkey IS NOT NULL",
        [
            ("parcel_id", "c_custkey"), ("x0", "(c_custkey % 30) * 20"), ("y0", "(c_custkey DIV 30) * 20"),
            ("w", "8 + c_nationkey % 8"), ("h", "8 + c_custkey % 7"),
        ],
    ),
    "pred_rect": (
        "part", "p_partkey IS NOT NULL",
        [
            ("parcel_id", "p_partkey"), ("x0", "(p_partkey % 30) * 20 + p_size % 7"),
            ("y0", "(p_partkey DIV 30) * 20 + p_size % 5"),
            ("w", "CASE WHEN p_partkey % 11 = 0 THEN 30 WHEN p_partkey % 5 = 0 THEN 6 ELSE 10 END"), ("h", "9"),
        ],
    ),
    "runs": (
        "supplier", "s_suppkey IS NOT NULL",
        [
            ("run_id", "s_suppkey"), ("nation", "s_nationkey"),
            ("extent_f1", "CAST((s_suppkey * 37) % 100 AS DOUBLE) / 100.0e0"), ("boundary_f1", "CAST((s_suppkey * 53) % 100 AS DOUBLE) / 100.0e0"),
            ("boundary_bde", "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST((s_suppkey * 11) % 40 AS DOUBLE) / 10.0e0 END"),
            ("goc", "CAST((s_suppkey * 17) % 30 AS DOUBLE) / 100.0e0"), ("guc", "CAST((s_suppkey * 19) % 30 AS DOUBLE) / 100.0e0"),
            ("normalized_gtc", "CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST((s_suppkey * 17) % 30 + (s_suppkey * 19) % 30 AS DOUBLE) / 100.0e0 END"),
            ("extent_threshold", "CASE WHEN s_nationkey % 3 = 0 THEN 0.55e0 ELSE 0.5e0 END"),
            ("boundary_threshold", "CASE WHEN s_nationkey % 4 = 0 THEN 0.4e0 ELSE 0.5e0 END"),
            ("iou_threshold", "CASE WHEN s_nationkey % 5 = 0 THEN 0.3e0 ELSE 0.5e0 END"),
            ("eval_mode", "CASE WHEN s_nationkey % 6 = 0 THEN 'scene' ELSE 'dataset' END"),
            ("status", "CASE s_suppkey % 9 WHEN 0 THEN 'failed' WHEN 1 THEN 'partial' WHEN 2 THEN 'done' ELSE 'success' END"),
            ("parent_id", "CASE WHEN s_suppkey < 10 THEN NULL ELSE s_suppkey DIV 3 END"),
        ],
    ),
}


def _spell(expression: str, div: str, element: str) -> str:
    expression = re.sub(r"\bDIV\b", div, expression)
    return re.sub(r"\bELEM(\d+)\b", element, expression)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view ``name`` over the tables of ``sf_dir``."""
    source, keep, columns = VIEWS[name]
    df = view(spark, sf_dir, source) if source in VIEWS else table(spark, sf_dir, source)
    if keep:
        df = df.where(keep)
    return df.selectExpr(*[f"{_spell(e, 'div', r'element_at(embedding, \1)')} AS {c}" for c, e in columns])


def sql(*names: str) -> str:
    """DuckDB WITH clause (without a trailing comma) that defines the views."""
    wanted: list[str] = []
    for name in names:
        source = VIEWS[name][0]
        wanted += [n for n in ((source, name) if source in VIEWS else (name,)) if n not in wanted]
    parts = []
    for name in wanted:
        source, keep, columns = VIEWS[name]
        exprs = ", ".join(f"{_spell(e, '//', r'embedding[\1]')} AS {c}" for c, e in columns)
        parts.append(f"{name} AS (SELECT {exprs} FROM {source}" + (f" WHERE {keep}" if keep else "") + ")")
    return "WITH " + ", ".join(parts)
