"""Neighbourhood operators over pixels ``scene_id, y, x``: dilation, closing, distances, components.

Masks are sparse: only set pixels are rows, so the neighbour rows made are a
constant times the set pixels. Scenes have ``height`` and ``width``; neighbours
outside are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparkraster.operators.graph import components, least_of_component
from sparkraster.operators.tables import shared_table

KEY = ["scene_id", "y", "x"]


def _shifts(offsets: list[tuple[int, int]]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy, dx in offsets])).alias("o")


def diamond(radius: int) -> list[tuple[int, int]]:
    """Offsets of L1 length up to ``radius``: a cross dilated that many times."""
    r = range(-radius, radius + 1)
    return [(dy, dx) for dy in r for dx in r if abs(dy) + abs(dx) <= radius]


def disk(radius: int) -> list[tuple[int, int]]:
    r = range(-radius, radius + 1)
    return [(dy, dx) for dy in r for dx in r if dy * dy + dx * dx <= radius * radius]


def spread(mask: DataFrame, offsets: list[tuple[int, int]], height: int, width: int) -> DataFrame:
    """Every pixel of ``mask`` moved by every offset, inside the scene; not distinct."""
    moved = mask.select("scene_id", "y", "x", _shifts(offsets)).select(
        "scene_id", (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x")
    )
    return moved.where((F.col("y") >= 0) & (F.col("y") < height) & (F.col("x") >= 0) & (F.col("x") < width))


def dilate(mask: DataFrame, offsets: list[tuple[int, int]], height: int, width: int) -> DataFrame:
    return spread(mask, offsets, height, width).distinct()


def boundary_encode(skeleton: DataFrame, height: int, width: int, iterations: int = 3) -> DataFrame:
    """``boundary`` 1 on skeleton pixels, 2 in the buffer around them; all others are background and no row."""
    s = skeleton.select(*KEY).distinct()
    near = dilate(s, diamond(iterations), height, width)
    return near.join(s.withColumn("s", F.lit(True)), KEY, "left").select(*KEY, F.when(F.col("s"), 1).otherwise(2).alias("boundary"))


def close(mask: DataFrame, radius: int, height: int, width: int) -> DataFrame:
    """Closing with a disk. Pixels outside the scene count as unset in the erosion, so edges shrink."""
    shape = disk(radius)
    wide = dilate(mask.select(*KEY).distinct(), shape, height, width)
    return spread(wide, shape, height, width).groupBy(*KEY).agg(F.count("*").alias("n")).where(F.col("n") == len(shape)).select(*KEY)


def repair_boundary(pixels: DataFrame, radius: int, height: int, width: int) -> DataFrame:
    """Presence > 0 is closed; ``p_bg, p_skel, p_buf`` become (1 - m, m, 0)."""
    m = close(pixels.where("p_skel + p_buf > 0"), radius, height, width).withColumn("m", F.lit(1.0))
    j = pixels.drop("p_bg", "p_skel", "p_buf").join(m, KEY, "left")
    m1 = F.coalesce("m", F.lit(0.0))
    return j.withColumns({"p_bg": 1 - m1, "p_skel": m1, "p_buf": F.lit(0.0)}).drop("m")


#: Rows and columns of the tiles in which distances and components are solved.
TILE = 256


def lower_envelope(g, clip: int):
    """numpy: for rows of squared heights ``g`` (clip * clip and more: none), the least of g[j] + (i - j)^2 over the columns j.

    The lower envelope of parabolas of Felzenszwalb and Huttenlocher (2012), a
    column at a time for all rows together: each row keeps a stack of parabolas
    and the places from where they are lowest.
    """
    import numpy as np

    rows, n = g.shape
    who = np.arange(rows)
    stack, place = np.zeros((rows, n + 1), np.int64), np.full((rows, n + 2), np.inf)
    top = np.full(rows, -1)
    for q in range(n):
        left = who[g[:, q] < clip * clip]
        at = np.full(len(left), -np.inf)
        busy = np.arange(len(left))
        while len(busy):
            r = left[busy]
            busy, r = busy[top[r] >= 0], r[top[r] >= 0]
            v = stack[r, top[r]]
            cross = ((g[r, q] + q * q) - (g[r, v] + v * v)) / (2.0 * (q - v))
            higher = cross <= place[r, top[r]]
            at[busy] = np.where(higher, -np.inf, cross)
            top[r[higher]] -= 1
            busy = busy[higher]
        top[left] += 1
        stack[left, top[left]], place[left, top[left]], place[left, top[left] + 1] = q, at, np.inf
    out, k = np.full((rows, n), clip * clip, np.int64), np.zeros(rows, np.int64)
    some = who[top >= 0]
    for q in range(n):
        while True:
            go = some[place[some, k[some] + 1] < q]
            if not len(go):
                break
            k[go] += 1
        v = stack[some, k[some]]
        out[some, q] = np.minimum(out[some, q], g[some, v] + (q - v) ** 2)
    return out


def squared_distances(on, clip: int):
    """numpy: squared distances to the nearest set pixel of a mask, at most ``clip`` squared."""
    import numpy as np

    n = on.shape[0]
    y = np.arange(n)[:, None]
    above = np.maximum.accumulate(np.where(on, y, -n - clip), 0)
    below = np.minimum.accumulate(np.where(on, y, 2 * n + clip)[::-1], 0)[::-1]
    g = np.minimum(np.minimum(y - above, below - y), clip)
    return lower_envelope(g * g, clip)


def distance_transform(pixels: DataFrame, boundary: str, clip: int, tile: int | None = None) -> DataFrame:
    """Euclidean distance to the nearest pixel with ``boundary``, at most ``clip``; 0 at invalid pixels.

    Exact. Pixels are dealt to tiles, boundary pixels to all tiles within
    ``clip`` as well, and a task solves a tile with its halo. So a pixel moves
    once, and a boundary pixel at a tile's border a few times. Without a boundary
    in reach the distance is ``clip``.
    """
    tile = max(tile or TILE, clip)
    own = lambda c: F.floor(F.col(c) / tile).cast("long")
    near = lambda c: F.sequence(F.floor((F.col(c) - clip) / tile).cast("long"), F.floor((F.col(c) + clip) / tile).cast("long"))
    px = pixels.select(*KEY, "valid", F.coalesce(F.expr(boundary), F.lit(False)).alias("on"))
    # A boundary pixel comes once for each tile in reach, any other pixel for its own.
    px = px.withColumn("ty", F.explode(F.when(F.col("on"), near("y")).otherwise(F.array(own("y")))))
    px = px.withColumn("tx", F.explode(F.when(F.col("on"), near("x")).otherwise(F.array(own("x")))))

    def solve(key, table):
        import numpy as np
        import pyarrow as pa

        top, left = key[1].as_py() * tile - clip, key[2].as_py() * tile - clip
        i, j = table.column("y").to_numpy() - top, table.column("x").to_numpy() - left
        on = np.zeros((tile + 2 * clip, tile + 2 * clip), bool)
        hit = table.column("on").to_numpy(zero_copy_only=False)
        on[i[hit], j[hit]] = True
        core = (i >= clip) & (i < clip + tile) & (j >= clip) & (j < clip + tile)
        rows = table.filter(pa.array(core))
        if not rows.num_rows:
            return rows.select(KEY).append_column("distance", pa.array([], pa.float64()))
        d = np.sqrt(squared_distances(on, clip)[i[core], j[core]].astype(np.float64))
        valid = rows.column("valid").to_numpy(zero_copy_only=False) == 1
        return rows.select(KEY).append_column("distance", pa.array(np.where(valid, d, 0.0)))

    schema = ", ".join(f"{c} {kind}" for c, kind in px.select(*KEY).dtypes)
    return px.groupBy("scene_id", "ty", "tx").applyInArrow(solve, f"{schema}, distance double")


def tile_components(on, connectivity: int = 4):
    """numpy: for each set pixel of a mask, in order, the place (row * columns + column) of the first pixel of its component."""
    import numpy as np

    h, w = on.shape
    flat = np.flatnonzero(on)
    rank = np.full(h * w, -1)
    rank[flat] = np.arange(len(flat))
    y, x = np.divmod(flat, w)
    steps = ((0, 1), (1, 0)) if connectivity == 4 else ((0, 1), (1, 0), (1, 1), (1, -1))
    links = []
    for dy, dx in steps:
        ok = np.flatnonzero((y + dy < h) & (x + dx < w) & (x + dx >= 0))
        other = rank[(y[ok] + dy) * w + x[ok] + dx]
        links.append(np.stack([ok[other >= 0], other[other >= 0]]))
    i, j = np.concatenate(links, 1)
    return flat[least_of_component(i, j, len(flat))]


def _tile_labels(mask: DataFrame, width: int, height: int, connectivity: int, tile: int) -> DataFrame:
    """``scene_id, y, x, node``: components within tiles; a node is the number of the component's first pixel over all scenes."""
    m = mask.select(*KEY).distinct()
    m = m.withColumns({"ty": F.floor(F.col("y") / tile).cast("long"), "tx": F.floor(F.col("x") / tile).cast("long")})

    def solve(key, table):
        import numpy as np
        import pyarrow as pa

        top, left = key[1].as_py() * tile, key[2].as_py() * tile
        i, j = table.column("y").to_numpy() - top, table.column("x").to_numpy() - left
        on = np.zeros((tile, tile), bool)
        on[i, j] = True
        first = np.empty((tile, tile), np.int64)
        first[on] = tile_components(on, connectivity)
        y, x = np.divmod(first[i, j], tile)
        node = (int(key[0].as_py()) * height + (y + top)) * width + (x + left)
        return table.select(KEY).append_column("node", pa.array(node, pa.int64()))

    schema = ", ".join(f"{c} {kind}" for c, kind in m.select(*KEY).dtypes)
    return m.groupBy("scene_id", "ty", "tx").applyInArrow(solve, f"{schema}, node long")


def border_links(labelled: DataFrame, connectivity: int, tile: int) -> DataFrame:
    """Distinct links ``a, b`` of components of neighbouring tiles, from the pixels at tile borders alone."""
    edge = lambda c: F.pmod(F.col(c), F.lit(tile)).isin(0, tile - 1)
    border = labelled.where(edge("y") | edge("x"))
    steps = [(0, 1), (1, 0)] + ([(1, 1), (1, -1)] if connectivity == 8 else [])
    place = lambda c: F.floor(F.col(c) / tile)
    near = border.select("scene_id", F.col("node").alias("a"), "y", "x", _shifts(steps)).select(
        "scene_id", "a", (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"),
        (F.floor((F.col("y") + F.col("o.dy")) / tile) != place("y")) | (F.floor((F.col("x") + F.col("o.dx")) / tile) != place("x")),
    ).toDF("scene_id", "a", "y", "x", "crosses").where("crosses")
    return near.join(border.withColumnRenamed("node", "b"), KEY).select("a", "b").distinct()


def connected_components(mask: DataFrame, width: int, height: int, connectivity: int = 4) -> DataFrame:
    """``scene_id, y, x, label`` of the pixels of ``mask``; a label is 1 + the smallest pixel number of its component.

    Components are solved within tiles of ``TILE`` pixels in a task each. Only
    those that meet at a tile's border are linked and go through the rounds of
    the component search, so these work on border pixels and not on areas.
    """
    labelled = shared_table(_tile_labels(mask, width, height, connectivity, TILE))
    comp = components(border_links(labelled, connectivity, TILE))
    label = F.coalesce("component", "node") - F.col("scene_id") * height * width + 1
    return labelled.join(comp, "node", "left").select(*KEY, label.alias("label"))
