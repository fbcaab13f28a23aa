"""Seeded region growing over a relief, as a minimum spanning forest grown from markers.

Pixels are joined with their right and lower neighbours by an edge of the larger
relief of the two. The forest that is rooted in the markers and has the least
edges gives each pixel the marker that it reaches over the lowest pass: a
watershed cut (Cousty et al., 2009). Edges are in one total order (relief, then
pixel numbers), so the result is unique and needs no queue order. It is found in
the manner of Boruvka: every region without a marker takes its least edge, and
the regions so linked become one.

Most of it happens inside tiles: a region that lies in one tile knows all its
edges, so a task per tile contracts regions until each holds a marker or its
least edge leaves the tile. What remains are regions at tile borders and the
least edge between any two of them. They are contracted again in squares of 4 x 4
tiles, 16 x 16 tiles and so on, a task each: a region belongs to the square of
its representative, where all its edges are known. Edges between two regions with
markers are dropped. Beyond squares of ``TOP`` pixels, rounds of joins go on,
which at least halve the regions without a marker.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkraster.operators.graph import components
from sparkraster.operators.tables import shared_table

TILE = 64
#: Side of the largest squares that a task contracts; it holds the regions at the borders of those a quarter as wide.
TOP = TILE * 4**4


def contract_tile(u: np.ndarray, v: np.ndarray, marked: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Region (a representative index) of each pixel of a tile.

    ``u, v`` index the pixels at the ends of the edges, in ascending order of the
    edges; ``marked`` is the region of marker pixels and -1 elsewhere; pixels
    that are not ``own`` belong to other tiles and stay by themselves.
    """
    n = len(own)
    region = np.where(marked >= 0, marked, np.arange(n))
    settled = ~own | (marked >= 0)  # by region: never takes an edge
    while True:
        a, b = region[u], region[v]
        open_ = np.flatnonzero(a != b)
        a, b = a[open_], b[open_]
        least = np.full(n, len(u))
        np.minimum.at(least, a, open_)
        np.minimum.at(least, b, open_)
        picks = np.flatnonzero((least < len(u)) & ~settled & (region == np.arange(n)))
        ends_u, ends_v = region[u[least[picks]]], region[v[least[picks]]]
        other = np.where(ends_u == picks, ends_v, ends_u)
        inside = own[other]
        picks, other = picks[inside], other[inside]
        if not len(picks):
            return region
        to = np.arange(n)
        to[picks] = other
        # Two regions that take the same edge become the smaller one of them.
        both = (to[to[picks]] == picks) & (picks < to[picks])
        to[picks[both]] = picks[both]
        while True:
            far = to[to]
            if (far == to).all():
                break
            to = far
        region = to[region]


def _tiles(px: DataFrame, width: int) -> DataFrame:
    """``node, region, other, w, a, b``: the region of each pixel (other null), and the least edge between two regions of a tile.

    ``px`` has ``scene_id, y, x, node, relief, seed``. An edge that leaves a tile
    comes from the tile of its smaller end and names the pixel on the other side.
    """
    halo = F.array(
        F.struct(F.lit(0).alias("dy"), F.lit(0).alias("dx")), F.struct(F.lit(0).alias("dy"), F.lit(1).alias("dx")),
        F.struct(F.lit(1).alias("dy"), F.lit(0).alias("dx")), F.struct(F.lit(0).alias("dy"), F.lit(-1).alias("dx")),
        F.struct(F.lit(-1).alias("dy"), F.lit(0).alias("dx")),
    )
    ty, tx = F.floor(F.col("y") / TILE), F.floor(F.col("x") / TILE)
    # A pixel goes to its own tile and to those that one of its neighbours lies in.
    to = F.array_distinct(F.transform(halo, lambda d: F.struct(
        F.floor((F.col("y") + d["dy"]) / TILE).alias("ty"), F.floor((F.col("x") + d["dx"]) / TILE).alias("tx"))))
    dealt = px.select("scene_id", "y", "x", "node", "relief", "seed", ty.alias("my"), tx.alias("mx"), F.explode(to).alias("t"))
    dealt = dealt.select(
        "scene_id", F.col("t.ty").alias("ty"), F.col("t.tx").alias("tx"), "y", "x", "node", F.col("relief").cast("double").alias("relief"),
        "seed", ((F.col("t.ty") == F.col("my")) & (F.col("t.tx") == F.col("mx"))).alias("own"),
    )

    def solve(pdf):
        import pandas as pd

        pdf = pdf.sort_values("node", kind="stable").reset_index(drop=True)
        node, x, relief = pdf["node"].to_numpy(), pdf["x"].to_numpy(), pdf["relief"].to_numpy()
        own, seed = pdf["own"].to_numpy(bool), pdf["seed"].fillna(-1).to_numpy(np.int64)
        at_u, at_v = [], []
        for step, ok in ((1, x < width - 1), (width, np.ones(len(node), bool))):
            j = np.minimum(np.searchsorted(node, node + step), len(node) - 1)
            there = np.flatnonzero((node[j] == node + step) & ok & (own | own[j]))
            at_u.append(there)
            at_v.append(j[there])
        u, v = np.concatenate(at_u), np.concatenate(at_v)
        w = np.maximum(relief[u], relief[v])
        order = np.lexsort([node[v], node[u], w])
        u, v, w = u[order], v[order], w[order]
        # Pixels of one marker are one region from the start, also where they do not touch.
        marked = np.full(len(node), -1)
        if (seed[own] >= 0).any():
            mine = np.flatnonzero(own & (seed >= 0))
            seeds, first = np.unique(seed[mine], return_index=True)
            marked[mine] = mine[first][np.searchsorted(seeds, seed[mine])]
        region = contract_tile(u, v, marked, own)
        name = np.where(own[region] & (seed[region] >= 0), seed[region], node[region])
        keep = (region[u] != region[v]) & own[u]
        u, v, w = u[keep], v[keep], w[keep]
        rest = pd.DataFrame({"region": name[region[u]], "other": np.where(own[v], name[region[v]], node[v]), "w": w, "a": node[u], "b": node[v]})
        rest = rest.drop_duplicates(["region", "other"])  # edges are in order, so the first is the least
        mapped = pd.DataFrame({"node": node[own], "region": name[region[own]]})
        out = pd.concat([mapped, rest], ignore_index=True)
        return out.astype({"node": "Int64", "region": "Int64", "other": "Int64", "a": "Int64", "b": "Int64"})[["node", "region", "other", "w", "a", "b"]]

    return dealt.groupBy("scene_id", "ty", "tx").applyInPandas(solve, "node long, region long, other long, w double, a long, b long")


def _square(e: DataFrame, side: int, height: int, width: int) -> DataFrame:
    """``node, region``: regions that become part of another one within squares of ``side`` pixels.

    ``e`` has the least edges ``u, v, rank, mu, mv`` between regions; the flags
    tell which have a marker.
    """

    def square(c):
        scene, y, x = F.expr(f"{c} div {height * width}"), F.expr(f"({c} % {height * width}) div {width}"), F.col(c) % width
        return F.struct(scene.alias("scene"), F.floor(y / side).alias("ty"), F.floor(x / side).alias("tx"))

    dealt = e.select("u", "v", "rank.w", "rank.a", "rank.b", "mu", "mv", square("u").alias("su"), square("v").alias("sv"))
    dealt = dealt.withColumn("t", F.explode(F.array_distinct(F.array("su", "sv"))))
    dealt = dealt.select("t", "u", "v", "w", "a", "b", "mu", "mv", (F.col("su") == F.col("t")).alias("ou"), (F.col("sv") == F.col("t")).alias("ov"))

    def solve(pdf):
        import pandas as pd

        order = np.lexsort([pdf["b"].to_numpy(), pdf["a"].to_numpy(), pdf["w"].to_numpy()])
        u, v = pdf["u"].to_numpy()[order], pdf["v"].to_numpy()[order]
        node, where = np.unique(np.concatenate([u, v]), return_inverse=True)
        i, j = where[: len(u)], where[len(u) :]
        own, marked = np.zeros(len(node), bool), np.full(len(node), -1)
        for ends, o, m in ((i, "ou", "mu"), (j, "ov", "mv")):
            own[ends] = pdf[o].to_numpy(bool)[order]
            has = ends[pdf[m].to_numpy(bool)[order]]
            marked[has] = has
        marked[~own] = -1
        region = contract_tile(i, j, marked, own)
        moved = np.flatnonzero(own & (region != np.arange(len(node))))
        return pd.DataFrame({"node": node[moved], "region": node[region[moved]]})

    return dealt.groupBy("t").applyInPandas(solve, "node long, region long")


def grow(pixels: DataFrame, markers: DataFrame, height: int, width: int, invalid: int = -1) -> DataFrame:
    """``scene_id, y, x, label`` of every pixel.

    ``pixels`` has ``relief, valid, inside`` (boolean, the growth domain) and
    ``markers`` the ``label`` of marker pixels. All pixels conduct; those outside
    the domain are 0 and invalid ones ``invalid`` in the result. Pixels that
    reach no marker are 0.
    """
    node = (F.col("scene_id") * height + F.col("y")) * width + F.col("x")
    m = markers.select(node.alias("node"), "scene_id", "label")
    seeds = shared_table(m.join(m.groupBy("scene_id", "label").agg(F.min("node").alias("seed")), ["scene_id", "label"]).select("node", "seed", "label"))
    marked = shared_table(seeds.select("seed", "label").distinct())
    px = pixels.select("scene_id", "y", "x", node.alias("node"), "relief", "valid", "inside")
    px = shared_table(px.join(seeds.select("node", "seed"), "node", "left"))
    tiles = shared_table(_tiles(px, width))
    found = tiles.where("other is null").select("node", "region")
    edges = tiles.where("other is not null").select(
        F.col("region").alias("u"), F.col("other").alias("v"), F.struct("w", "a", "b").alias("rank")
    )

    def contract(edges, to):
        """Edges between the regions that ``to(node, region)`` gives; the least of parallel ones."""
        a = to.select(F.col("node").alias("u"), F.col("region").alias("ru"))
        b = to.select(F.col("node").alias("v"), F.col("region").alias("rv"))
        j = edges.join(a, "u", "left").join(b, "v", "left").select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"), "rank")
        j = j.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "rank")
        j = j.groupBy("u", "v").agg(F.min("rank").alias("rank"))
        for c, flag in (("u", "mu"), ("v", "mv")):
            has = marked.select(F.col("seed").alias(c), F.lit(True).alias(flag))
            j = j.join(has, c, "left").withColumn(flag, F.col(flag).isNotNull())
        # Two regions with markers never meet.
        return shared_table(j.where("not (mu and mv)"))

    def after(steps, step):
        """``steps(node, region)`` with ``step`` behind it."""
        if steps is None:
            return step
        nxt = step.select(F.col("node").alias("region"), F.col("region").alias("next"))
        moved = steps.join(nxt, "region", "left").select("node", F.coalesce("next", "region").alias("region"))
        return shared_table(moved.unionAll(step.join(steps.select("node"), "node", "left_anti")))

    e = contract(edges, found)
    steps, side = None, TILE
    while side < min(TOP, max(height, width)) and not e.isEmpty():
        side *= 4
        step = shared_table(_square(e, side, height, width))
        steps, e = after(steps, step), contract(e, step)
    while True:
        both = e.select(F.col("u").alias("c"), F.col("v").alias("o"), "rank", F.col("mu").alias("m")).unionAll(e.select(F.col("v").alias("c"), F.col("u").alias("o"), "rank", F.col("mv").alias("m")))
        picks = shared_table(both.where("not m").groupBy("c").agg(F.min_by("o", "rank").alias("o")))
        if picks.isEmpty():
            break
        comp = components(picks.select(F.col("c").alias("a"), F.col("o").alias("b")))
        # A group of picks holds one marked region at most.
        owner = comp.join(marked, comp.node == marked.seed).select("component", "seed")
        step = shared_table(comp.join(owner, "component", "left").select("node", F.coalesce("seed", "component").alias("region")))
        steps, e = after(steps, step), contract(e, step)
    if steps is not None:
        last = steps.select(F.col("node").alias("region"), F.col("region").alias("next"))
        found = found.join(last, "region", "left").select("node", F.coalesce("next", "region").alias("region"))
    label = px.drop("seed").join(found, "node", "left").join(marked, F.col("region") == F.col("seed"), "left")
    out = F.when(F.col("valid") != 1, F.lit(invalid)).when(~F.col("inside"), 0).otherwise(F.coalesce("label", F.lit(0)))
    return label.select("scene_id", "y", "x", out.cast("long").alias("label"))
