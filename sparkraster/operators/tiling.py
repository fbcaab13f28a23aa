"""Windows, tiles and patches over scenes, and blending of overlapping tiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkraster.operators.sampling import exact_quantiles

#: Fixed values of the patch classes.
REJECT_BELOW, INVALID_BELOW, BOUNDARY_FROM, CENTER_FROM = 0.05, 0.5, 0.1, 0.8


def offsets(total: Column, size: int, stride: int, small: bool) -> Column:
    """Window starts along one axis: 0, stride, ... and the last that ends at the edge.

    A scene shorter than the window has none, or [0] where ``small`` allows a padded one.
    """
    last = total - F.lit(size)
    regular = F.array_union(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0)).cast("long"), F.lit(stride).cast("long")), F.array(last.cast("long")))
    short = F.array(F.lit(0).cast("long")) if small else F.array().cast("array<bigint>")
    return F.when(last < 0, short).when((last == 0) & F.lit(small), F.array(F.lit(0).cast("long"))).otherwise(regular)


def windows(scenes: DataFrame, size: int, stride: int | None = None, small: bool = False) -> DataFrame:
    """``scene_id, yoff, xoff`` of the windows of ``scenes(scene_id, height, width)``; stride half the size by default."""
    stride = stride or max(1, size // 2)
    rows = scenes.select("scene_id", "width", F.explode(offsets(F.col("height"), size, stride, small)).alias("yoff"))
    return rows.select("scene_id", "yoff", F.explode(offsets(F.col("width"), size, stride, small)).alias("xoff"))


def tile_stride(size: int, overlap: float) -> int:
    return max(1, int(size * (1 - overlap)))


def multi_size_windows(scenes: DataFrame, sizes: list[int]) -> DataFrame:
    """Windows for each different size: ``size, scene_id, yoff, xoff``."""
    out = None
    for size in dict.fromkeys(sizes):
        one = windows(scenes, size).select(F.lit(size).alias("size"), "scene_id", "yoff", "xoff")
        out = one if out is None else out.unionAll(one)
    return out


def _covering(p: Column, total: int, size: int, stride: int, halo: int) -> Column:
    """Starts of the windows of an axis whose range, with its halo, holds ``p``."""
    last = max(total - size, 0)
    lo = F.greatest(F.lit(0), F.ceil((p - size - halo + 1) / stride)).cast("long")
    hi = F.least(F.floor((p + halo) / stride), F.lit(last // stride)).cast("long")
    regular = F.when(lo <= hi, F.transform(F.sequence(lo, hi), lambda i: i * stride)).otherwise(F.array().cast("array<bigint>"))
    end = F.lit(last).cast("long")
    reaches = (p >= last - halo) & (p < last + size + halo)
    return F.when(reaches, F.array_union(regular, F.array(end))).otherwise(regular)


def assign(pixels: DataFrame, height: int, width: int, size: int, stride: int, halo: int = 0) -> DataFrame:
    """Each pixel once for every window that covers it; adds ``yoff, xoff`` and ``is_core``.

    The windows are found by arithmetic, so there is no range join; a pixel has
    at most ceil((size + 2 halo) / stride) + 1 per axis.
    """
    df = pixels.withColumn("yoff", F.explode(_covering(F.col("y"), height, size, stride, halo)))
    df = df.withColumn("xoff", F.explode(_covering(F.col("x"), width, size, stride, halo)))
    core = (F.col("y") >= F.col("yoff")) & (F.col("y") < F.col("yoff") + size) & (F.col("x") >= F.col("xoff")) & (F.col("x") < F.col("xoff") + size)
    return df.withColumn("is_core", core.cast("int"))


def gaussian_weight(size: int) -> Column:
    """Weight of a pixel in its tile: separable, sigma size / 4, not normalised."""
    sigma, centre = size / 4.0, (size - 1) / 2.0
    dy, dx = F.col("y") - F.col("yoff") - centre, F.col("x") - F.col("xoff") - centre
    return F.exp(-(dy * dy + dx * dx) / (2 * sigma * sigma))


def blend(tiles: DataFrame, columns: list[str], size: int) -> DataFrame:
    """Overlap-add of per-tile predictions: sum(p w valid) / sum(w valid) of each pixel, 0 without weight."""
    df = tiles.withColumn("w", gaussian_weight(size) * F.col("valid"))
    sums = [F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("w")), F.sum("w")), F.lit(0.0)).alias(c) for c in columns]
    return df.groupBy("scene_id", "y", "x").agg(*sums, F.count("*").alias("n_tiles"))


def tile_coverage(assigned: DataFrame) -> DataFrame:
    """Per scene: tiles, and those with a valid pixel, which alone are processed."""
    per = assigned.groupBy("scene_id", "yoff", "xoff").agg(F.max("valid").alias("any_valid"))
    return per.groupBy("scene_id").agg(F.count("*").alias("tiles"), F.count_if(F.col("any_valid") == 1).alias("processed"))


TILE = ["scene_id", "yoff", "xoff"]


class TileBatches:
    """Rows of tiles from Arrow batches in order of tile; a tile may begin in one batch and end in another."""

    def __init__(self, batches):
        self.batches = batches

    def __iter__(self):
        import pyarrow as pa
        import pyarrow.compute as pc

        held = []

        def tile():
            return pa.Table.from_batches(held).combine_chunks()

        for b in self.batches:
            if not b.num_rows:
                continue
            if held and any(held[-1].column(c)[-1] != b.column(c)[0] for c in TILE):
                yield tile()
                held = []
            begin = 0
            if b.num_rows > 1:
                new = [pc.not_equal(b.column(c).slice(1), b.column(c).slice(0, b.num_rows - 1)) for c in TILE]
                for at in pc.indices_nonzero(pc.or_(pc.or_(new[0], new[1]), new[2])).to_pylist():
                    held.append(b.slice(begin, at + 1 - begin))
                    yield tile()
                    held, begin = [], at + 1
            held.append(b.slice(begin))
        if held:
            yield tile()


def dense_tile(rows, columns: list[str], size: int, halo: int):
    """``(bands, mask, i, j)`` of the rows of one tile.

    ``bands`` is (columns, side, side) in double precision with side ``size + 2
    halo``; nulls and pixels that do not exist, as beyond the edge of the scene,
    are 0. ``mask`` is 1 at valid pixels. ``i, j`` are the places of the rows.
    """
    import numpy as np

    side = size + 2 * halo
    i = rows.column("y").to_numpy() - rows.column("yoff").to_numpy() + halo
    j = rows.column("x").to_numpy() - rows.column("xoff").to_numpy() + halo
    bands, mask = np.zeros((len(columns), side, side)), np.zeros((side, side), np.uint8)
    mask[i, j] = rows.column("valid").to_numpy(zero_copy_only=False) == 1
    for k, c in enumerate(columns):
        bands[k, i, j] = rows.column(c).cast("double").fill_null(0.0).to_numpy()
    return bands, mask, i, j


def score_tiles(assigned: DataFrame, columns: list[str], score: Callable, size: int, halo: int = 0, names: tuple[str, ...] = ("score",)) -> DataFrame:
    """Runs a scorer once on every tile with a valid pixel: ``scene_id, yoff, xoff, y, x, valid`` and ``names`` of its core pixels.

    ``assigned`` comes from ``assign`` with the same size and halo. The scorer
    gets the whole tile as arrays, ``score(bands, mask)`` as ``dense_tile`` makes
    them, and returns an array (side, side) or (names, side, side), so it may look
    at neighbours: a filter, a network. What it says beyond the tile's core or
    where no pixel exists is left out. Tiles whose core has no valid pixel are
    not scored and have no rows.

    Rows are dealt by tile and sorted, so a task holds one tile at a time, of
    side * side pixels, however many tiles a scene has.
    """
    import numpy as np
    from pyspark.sql.types import DoubleType, StructType

    kept = [*TILE, "y", "x", "valid"]
    df = assigned.select(*kept, "is_core", *[c for c in dict.fromkeys(columns) if c not in kept])
    dealt = df.repartition(*TILE).sortWithinPartitions(*TILE)
    out = StructType([df.schema[c] for c in kept])
    for name in names:
        out = out.add(name, DoubleType())

    def run(batches):
        import pyarrow as pa

        for rows in TileBatches(batches):
            core = rows.column("is_core").to_numpy() == 1
            if not (core & (rows.column("valid").to_numpy(zero_copy_only=False) == 1)).any():
                continue
            bands, mask, i, j = dense_tile(rows, columns, size, halo)
            made = np.asarray(score(bands, mask), np.float64).reshape(len(names), *mask.shape)
            rows = rows.select(kept)
            for k, name in enumerate(names):
                rows = rows.append_column(name, pa.array(made[k, i, j]))
            yield from rows.filter(pa.array(core)).to_batches()

    return dealt.mapInArrow(run, out)


def mean_filter(bands, mask):
    """A scorer: the mean of the first band over the valid pixels of the 3 x 3 neighbourhood, 0 where there are none."""
    import numpy as np

    def around(a):
        p = np.pad(a.astype(np.float64), 1)
        return sum(p[1 + dy : p.shape[0] - 1 + dy, 1 + dx : p.shape[1] - 1 + dx] for dy in (-1, 0, 1) for dx in (-1, 0, 1))

    n = around(mask)
    return np.divide(around(bands[0] * mask), n, out=np.zeros(n.shape), where=n > 0)


def patch_ratios(patches: DataFrame, size: int) -> DataFrame:
    """``valid_ratio, edge_ratio`` of each ``scene_id, yoff, xoff``; edges are boundary class 1."""
    area = float(size * size)
    return patches.groupBy("scene_id", "yoff", "xoff").agg(
        (F.sum("valid") / area).alias("valid_ratio"), (F.count_if(F.col("gt_boundary") == 1) / area).alias("edge_ratio")
    )


def patch_class(valid_ratio: Column, edge_ratio: Column) -> Column:
    """Sampling class; null rejects the patch."""
    return (
        F.when(valid_ratio < REJECT_BELOW, F.lit(None).cast("string")).when(valid_ratio < INVALID_BELOW, "near_invalid")
        .when(edge_ratio >= BOUNDARY_FROM, "boundary_positive").when((valid_ratio >= CENTER_FROM) & (edge_ratio == 0), "hard_negative")
        .otherwise("center_positive")
    )


def class_counts(ratios: DataFrame) -> DataFrame:
    """Patches per scene and class, one column a class, and the rejected."""
    cls = patch_class(F.col("valid_ratio"), F.col("edge_ratio"))
    names = ("near_invalid", "boundary_positive", "hard_negative", "center_positive")
    return ratios.withColumn("cls", cls).groupBy("scene_id").agg(
        *[F.count_if(F.col("cls") == n).alias(n) for n in names], F.count_if(F.col("cls").isNull()).alias("rejected")
    )


def extent_coverage(patches: DataFrame) -> DataFrame:
    """Share of valid pixels with extent > 0 in each patch, 0 where none is valid."""
    ok = F.col("valid") == 1
    return patches.groupBy("scene_id", "yoff", "xoff").agg(
        F.coalesce(F.try_divide(F.count_if(ok & (F.col("gt_extent") > 0)), F.count_if(ok)), F.lit(0.0)).cast("double").alias("coverage")
    )


def coverage_buckets(coverage: DataFrame) -> DataFrame:
    """Adds ``bucket``: low up to the 33rd, medium up to the 66th percentile, else high (ends included)."""
    q = exact_quantiles(coverage.select(F.lit(0).alias("every"), "coverage"), "every", "coverage", [0.33, 0.66])
    df = coverage.join(F.broadcast(q.select("q0", "q1")))  # one row
    c = F.col("coverage")
    return df.withColumn("bucket", F.when(c <= F.col("q0"), "low").when(c <= F.col("q1"), "medium").otherwise("high")).drop("q0", "q1")
