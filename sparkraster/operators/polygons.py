"""Rings of labels, traced tile by tile and stitched at tile borders.

The directed unit edges of a label keep its pixels on their right. Each edge has
one successor at the corner where it ends: the only edge of the label that starts
there, or, where two start, the right turn, so rings do not cross. An edge
belongs to the tile that holds the corner where it starts. In a tile edges are
chained; a ring that stays in it is closed there, and every other chain ends at a
corner of another tile. Chains are the nodes of cycles whose smallest member and
order are found by doubling the reach of pointers, with joins of rows without
points. So no task holds more than a tile, and the rounds follow the logarithm of
the tile borders that a ring crosses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkraster.operators.regions import edges
from sparkraster.operators.sampling import _ranked
from sparkraster.operators.tables import shared_table

TILE = 256
#: Corners lie within this distance of 0; an edge is numbered by its corner and direction in 62 bits.
REACH = 1 << 29
#: Steps of the directions right, down, left and up (sides 0 to 3 of a pixel).
STEP_Y, STEP_X = (0, 1, 0, -1), (1, 0, -1, 0)

_CHAIN = (
    "scene_id long, label long, closed boolean, node long, head_y long, head_x long, head_dir int, before int, "
    "end_y long, end_x long, tail_dir int, ys array<long>, xs array<long>"
)


def _trace(tile: int):
    """The function that chains the edges of one tile; a row for each chain or closed ring."""

    def run(key, table):
        import numpy as np
        import pyarrow as pa

        step_y, step_x = np.array(STEP_Y), np.array(STEP_X)
        label, d, y, x = (table.column(c).to_numpy() for c in ("label", "side", "cy", "cx"))
        d = d.astype(np.int64)
        top, left = key[1].as_py() * tile, key[2].as_py() * tile
        _, kind = np.unique(label, return_inverse=True)
        place = lambda yy, xx: (kind * tile + (yy - top)) * tile + (xx - left)
        here = place(y, x)
        order = np.argsort(here, kind="stable")
        starts = here[order]
        end_y, end_x = y + step_y[d], x + step_x[d]
        inside = (end_y >= top) & (end_y < top + tile) & (end_x >= left) & (end_x < left + tile)
        there = place(end_y, end_x)
        first = np.minimum(np.searchsorted(starts, there), len(starts) - 1)
        two = np.searchsorted(starts, there, "right") - first == 2
        one, other = order[first], order[np.minimum(first + 1, len(starts) - 1)]
        following = np.where(inside, np.where(two & (d[one] != (d + 1) % 4), other, one), -1)
        entered = np.zeros(len(d), bool)
        entered[following[inside]] = True
        shared = np.searchsorted(starts, here, "right") - np.searchsorted(starts, here) == 2
        before = np.where(shared, (d - 1) % 4, -1)
        following, turn, yl, xl = following.tolist(), d.tolist(), y.tolist(), x.tolist()
        seen, found = bytearray(len(turn)), []
        for closed, begin in ((False, np.flatnonzero(~entered)), (True, np.flatnonzero(entered))):
            for head in begin.tolist():
                if seen[head]:
                    continue
                ys, xs, at, last = [], [], head, head
                while True:
                    seen[at] = 1
                    if turn[at] != turn[last]:
                        ys.append(yl[at])
                        xs.append(xl[at])
                    last, at = at, following[at]
                    if at < 0 or at == head:
                        break
                if closed and turn[head] != turn[last]:
                    ys.append(yl[head])
                    xs.append(xl[head])
                found.append((closed, head, last, ys, xs))
        head, last = (np.array([f[k] for f in found], np.int64) for k in (1, 2))
        node = ((y[head] + REACH) << 32) + ((x[head] + REACH) << 2) + d[head]
        ids = table.column("scene_id").combine_chunks()
        return pa.table(
            {
                "scene_id": ids.take(pa.array(head)), "label": label[head], "closed": [f[0] for f in found], "node": node,
                "head_y": y[head].astype(np.int64), "head_x": x[head].astype(np.int64), "head_dir": d[head].astype(np.int32),
                "before": before[head].astype(np.int32), "end_y": end_y[last].astype(np.int64), "end_x": end_x[last].astype(np.int64),
                "tail_dir": d[last].astype(np.int32), "ys": pa.array([f[3] for f in found], pa.list_(pa.int64())),
                "xs": pa.array([f[4] for f in found], pa.list_(pa.int64())),
            }
        )

    return run


def chains(labels: DataFrame, tile: int = TILE) -> DataFrame:
    """Chains of directed edges within tiles, and the rings that stay in one; see ``ring_pieces``.

    ``node`` numbers the first edge of a chain. ``before`` is the direction from
    which a chain is entered where two edges of the label start at its corner,
    else -1. ``ys, xs`` are the corners behind the first where it turns; a ring
    has all its turns.
    """
    e = edges(labels)
    cy, cx = F.col("y") + F.col("side").isin(2, 3).cast("int"), F.col("x") + F.col("side").isin(1, 2).cast("int")
    e = e.select(F.col("scene_id").cast("long"), F.col("label").cast("long"), F.col("side").cast("int"), cy.cast("long").alias("cy"), cx.cast("long").alias("cx"))
    e = e.withColumns({"ty": F.floor(F.col("cy") / tile).cast("long"), "tx": F.floor(F.col("cx") / tile).cast("long")})
    return e.groupBy("scene_id", "ty", "tx").applyInArrow(_trace(tile), _CHAIN)


def ring_order(links: DataFrame) -> DataFrame:
    """Cycles ``scene_id, node, next`` in order: ``scene_id, node, ring, part``.

    ``ring`` is the smallest node of the cycle, ``part`` the place from there,
    from 0. Every node holds the smallest node on a stretch of the cycle that
    begins with it, and how far it is; each round doubles the stretches by one
    join, until none finds a smaller node.
    """
    at = links.select("scene_id", "node", F.col("next").alias("to"), F.col("node").alias("low"), F.lit(0).cast("long").alias("off"))
    length = 1
    while True:
        far = at.select("scene_id", F.col("node").alias("to"), F.col("to").alias("to2"), F.col("low").alias("low2"), F.col("off").alias("off2"))
        less = F.col("low2") < F.col("low")
        at = shared_table(
            at.drop("moved").join(far, ["scene_id", "to"]).select(
                "scene_id", "node", F.col("to2").alias("to"), F.least("low", "low2").alias("low"),
                F.when(less, F.col("off2") + length).otherwise(F.col("off")).alias("off"), less.alias("moved"),
            )
        )
        length *= 2
        if at.where("moved").isEmpty():
            break
    size = at.groupBy("scene_id", "low").agg(F.count("*").alias("n"))
    part = F.when(F.col("off") == 0, 0).otherwise(F.col("n") - F.col("off"))
    return at.join(size, ["scene_id", "low"]).select("scene_id", "node", F.col("low").alias("ring"), part.alias("part"))


def ring_pieces(labels: DataFrame, tile: int = TILE) -> DataFrame:
    """All rings in pieces of one tile: ``scene_id, label, ring, part, points``, to be read in the order of ``part``.

    ``points`` are the corners (struct of y and x) where the ring turns. A label
    of any size is many rows, and no row is longer than the border in a tile.
    """
    made = shared_table(chains(labels, tile))
    corner = lambda y, x: F.struct(y.alias("y"), x.alias("x"))
    turns = F.zip_with("ys", "xs", corner)
    whole = made.where("closed").select("scene_id", "label", F.col("node").alias("ring"), F.lit(0).cast("long").alias("part"), turns.alias("points"))
    cut = made.where("not closed")
    tails = cut.select("scene_id", "label", "node", F.col("end_y").alias("cy"), F.col("end_x").alias("cx"), "tail_dir")
    heads = cut.select("scene_id", "label", F.col("node").alias("next"), F.col("head_y").alias("cy"), F.col("head_x").alias("cx"), "head_dir", "before")
    links = shared_table(
        tails.join(heads, ["scene_id", "label", "cy", "cx"]).where("before = -1 or before = tail_dir")
        .select("scene_id", "node", "next", (F.col("tail_dir") != F.col("head_dir")).alias("turns"))
    )
    if links.isEmpty():
        return whole
    entry = links.select("scene_id", F.col("next").alias("node"), "turns")
    ordered = cut.join(ring_order(links), ["scene_id", "node"]).join(entry, ["scene_id", "node"])
    head = F.array(corner(F.col("head_y"), F.col("head_x")))
    return whole.unionByName(
        ordered.select("scene_id", "label", "ring", F.col("part").cast("long").alias("part"), F.when(F.col("turns"), F.concat(head, turns)).otherwise(turns).alias("points"))
    )


def _from_first(points: Column) -> Column:
    """A closed list of points from its first in order of y and x on."""
    at = F.array_position(points, F.array_min(points)).cast("int")
    return F.concat(F.slice(points, at, F.size(points)), F.slice(points, F.lit(1), at - 1))


def polygonize(labels: DataFrame, tile: int = TILE) -> DataFrame:
    """Rings of each label: ``scene_id, label, ring_no, points`` (outer rings clockwise in image axes, holes the other way).

    Straight runs are one edge. Rings begin at their first corner and are
    numbered in this order, by y and x, from 0 in each label. Labels of 0 and
    below have none. The points of a ring are one value; ``ring_pieces`` has
    them in pieces.
    """
    pieces = ring_pieces(labels, tile)
    parts = F.array_sort(F.collect_list(F.struct("part", "points")))
    rings = pieces.groupBy("scene_id", "label", "ring").agg(F.flatten(F.transform(parts, lambda p: p["points"])).alias("points"))
    rings = shared_table(rings.withColumn("points", _from_first(F.col("points"))))
    first = rings.select("scene_id", "label", "ring", F.col("points")[0].alias("start"))
    numbered = _ranked(first, [F.col("scene_id"), F.col("label"), F.col("start")])
    least = numbered.groupBy("scene_id", "label").agg(F.min("rank").alias("least"))
    number = numbered.join(least, ["scene_id", "label"]).select("scene_id", "label", "ring", (F.col("rank") - F.col("least")).cast("int").alias("ring_no"))
    xy = F.transform("points", lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    return rings.join(number, ["scene_id", "label", "ring"]).select("scene_id", "label", "ring_no", xy.alias("points"))
