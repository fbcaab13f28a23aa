"""Per-pixel filters, masks and maps. Rows are pixels: ``scene_id, y, x`` and values.

A pixel with ``valid = 0`` is a row, not a null: predicates exclude it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkraster.functions import bands as B
from sparkraster.operators.tables import shared_table

KEY = ["scene_id", "y", "x"]


def bounds_to_window(gt: list[float], width: int, height: int, bounds: tuple[float, float, float, float]):
    """(y0, y1, x0, x1), half open: world ``bounds`` (min_x, min_y, max_x, max_y) as whole pixels in the scene.

    ``gt`` is a north-up affine transform in GDAL order. An empty window is an error.
    """
    min_x, min_y, max_x, max_y = bounds
    col = sorted(((min_x - gt[0]) / gt[1], (max_x - gt[0]) / gt[1]))
    row = sorted(((min_y - gt[3]) / gt[5], (max_y - gt[3]) / gt[5]))
    x0, x1 = (min(max(round(v), 0), width) for v in col)
    y0, y1 = (min(max(round(v), 0), height) for v in row)
    if x0 >= x1 or y0 >= y1:
        raise ValueError(f"bounds {bounds} do not meet the scene")
    return y0, y1, x0, x1


#: Rows of a table with one row a scene that are broadcast to the pixels; they hold a few numbers each.
SCENES = 100_000


def with_scene(pixels: DataFrame, scenes: DataFrame) -> DataFrame:
    """``pixels`` joined with one row a scene.

    Pixels of a giant scene are one key, so the rows are counted, and up to
    ``SCENES`` of them (some MB) go to the pixels; more meet by a shuffle, where
    no scene is a large part of all.
    """
    return pixels.join(F.broadcast(scenes) if scenes.limit(SCENES + 1).count() <= SCENES else scenes, "scene_id")


def scan_window(pixels: DataFrame, window: tuple[int, int, int, int]) -> DataFrame:
    """Pixels of a half-open window; plain ranges, so Parquet can prune them."""
    y0, y1, x0, x1 = window
    return pixels.where((F.col("y") >= y0) & (F.col("y") < y1) & (F.col("x") >= x0) & (F.col("x") < x1))


def aoi_window(pixels: DataFrame, extents: DataFrame) -> DataFrame:
    """Pixels within the extent of their scene: ``extents(scene_id, y0, y1, x0, x1)``, one row per scene."""
    inside = (F.col("y") >= F.col("y0")) & (F.col("y") < F.col("y1")) & (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1"))
    return with_scene(pixels, extents).where(inside).drop("y0", "y1", "x0", "x1")


def world_bounds_to_pixels(rects: DataFrame, gt: list[float], width: int, height: int) -> DataFrame:
    """``x0, x1, y0, y1`` (half open, clamped) of world boxes ``xmin, ymin, xmax, ymax``: floor and ceil of the inverse transform."""
    px = lambda c: (F.col(c) - gt[0]) / gt[1]
    py = lambda c: (F.col(c) - gt[3]) / gt[5]
    clamp = lambda c, top: F.least(F.greatest(c, F.lit(0)), F.lit(top)).cast("long")
    return rects.withColumns(
        {
            "col0": clamp(F.floor(F.least(px("xmin"), px("xmax"))), width), "col1": clamp(F.ceil(F.greatest(px("xmin"), px("xmax"))), width),
            "row0": clamp(F.floor(F.least(py("ymin"), py("ymax"))), height), "row1": clamp(F.ceil(F.greatest(py("ymin"), py("ymax"))), height),
        }
    )


def valid_mask(
    pixels: DataFrame, band: str = "b1", mask: str | None = None, nodata: float | None = None, override: bool | str = False, mode: str = "prep"
) -> DataFrame:
    """Adds ``valid`` (0/1).

    ``mode`` prep: dataset mask and band not nodata, NaN aware; ``override``
    makes all pixels valid. ``mode`` predict: the first of mask, nodata and
    override that there is, and no other; ``override`` may name a 0/1 column.
    Without any of the three the mask cannot be told, which is an error.
    """
    if mask is None and nodata is None and not override:
        raise ValueError("no mask, nodata value or override tells valid pixels")
    if mode not in ("prep", "predict"):
        raise ValueError(f"unknown mode: {mode}")
    tests = []
    if mask is not None:
        tests.append(F.col(mask) != 0)
    if nodata is not None:
        tests.append(~F.isnan(band) if nodata != nodata else F.col(band) != F.lit(nodata))
    forced = (F.col(override) != 0) if isinstance(override, str) else F.lit(True)
    if mode == "predict":
        ok = [*tests, forced][0]
    elif override:
        ok = forced
    else:
        ok = tests[0] if len(tests) == 1 else tests[0] & tests[1]
    return pixels.withColumn("valid", F.coalesce(ok.cast("int"), F.lit(0)))


def stamp_ignore(pixels: DataFrame, target: str = "gt_extent", label: int = 255) -> DataFrame:
    """The extent target becomes ``label`` where a pixel is not valid, so that losses and metrics leave it out."""
    return pixels.withColumn(target, F.when(F.col("valid") == 1, F.col(target)).otherwise(F.lit(label)))


def band_indices(pixels: DataFrame, masked: bool = False) -> DataFrame:
    """Adds ``ndvi, savi, ndwi``. ``masked``: 0 where invalid or not finite, and all bands 0 where invalid."""
    g, r, n = (F.col(c).cast("double") for c in (B.GREEN, B.RED, B.NIR))
    made = {"ndvi": B.ndvi(r, n), "savi": B.savi(r, n), "ndwi": B.ndwi(g, n)}
    if masked:
        ok = F.col("valid") == 1
        made = {k: F.when(ok, B.finite_or_zero(v)).otherwise(0.0) for k, v in made.items()}
        made |= {f"b{i}": F.when(ok, F.col(f"b{i}")).otherwise(0.0) for i in range(1, 9)}
    return pixels.withColumns(made)


def normalize_bands(pixels: DataFrame, stats: DataFrame, columns: list[str], low: float = 0.0, high: float = 1.0, fill_invalid: bool = True) -> DataFrame:
    """Robust scaling of ``columns`` by ``stats(band_idx, p_lo, p_hi)``, band_idx in their order.

    Invalid pixels get ``low``, or stay as they are where ``fill_invalid`` is
    false. The statistics are one row per band, so they are one joined row here.
    """
    wide = stats.groupBy().agg(
        *[F.max(F.when(F.col("band_idx") == i, F.col(p))).alias(f"{p}_{i}") for i in range(len(columns)) for p in ("p_lo", "p_hi")]
    )
    joined = pixels.join(F.broadcast(wide))  # one row
    out = {}
    for i, c in enumerate(columns):
        v = B.rescale(F.col(c).cast("double"), F.col(f"p_lo_{i}"), F.col(f"p_hi_{i}"), low, high)
        out[c] = F.when(F.col("valid") == 1, v).otherwise(F.lit(low) if fill_invalid else F.col(c).cast("double"))
    return joined.withColumns(out).drop(*wide.columns)


def assemble_input(pixels: DataFrame, columns: list[str], size: int) -> DataFrame:
    """Adds ``features``: the columns and ``valid`` in one array; its size must be ``size``."""
    if len(columns) + 1 != size:
        raise ValueError(f"{len(columns)} features and the mask are not {size} channels")
    return pixels.withColumn("features", F.array(*[F.col(c).cast("double") for c in columns], F.col("valid").cast("double")))


def boundary_decisions(pixels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds ``not_background, skeleton, by_sum`` (0/1): the three ways to call a boundary pixel."""
    bg, sk, bu = F.col("p_bg"), F.col("p_skel"), F.col("p_buf")
    cls = B.boundary_class(bg, sk, bu)
    return pixels.withColumns(
        {"not_background": (cls != 0).cast("int"), "skeleton": (cls == 1).cast("int"), "by_sum": (sk + bu >= threshold).cast("int")}
    )


def marker(extent: float = 0.6, most_presence: float = 0.5, distance: float = 2.0) -> Column:
    """Marker pixels: sure of the field, away from its boundary, and valid."""
    return (
        (F.col("extent_prob") >= extent) & (B.presence(F.col("p_skel"), F.col("p_buf")) <= most_presence)
        & (F.col("distance_pred") >= distance) & (F.col("valid") == 1)
    )


def marker_candidates(pixels: DataFrame, **limits: float) -> DataFrame:
    return pixels.where(marker(**limits))


def marker_diagnostics(pixels: DataFrame, extent: float = 0.6, most_presence: float = 0.5, distance: float = 2.0) -> DataFrame:
    """Per scene: valid pixels, those passing each test, markers, and their share of valid pixels."""
    ok = F.col("valid") == 1
    near = B.presence(F.col("p_skel"), F.col("p_buf")) <= most_presence
    n, m = F.count_if(ok), F.count_if(marker(extent, most_presence, distance))
    return pixels.groupBy("scene_id").agg(
        n.alias("valid_px"), F.count_if(ok & (F.col("extent_prob") >= extent)).alias("extent_px"),
        F.count_if(ok & near).alias("presence_px"), F.count_if(ok & (F.col("distance_pred") >= distance)).alias("distance_px"),
        m.alias("markers"), B.ratio(m, n).alias("marker_ratio"),
    )


def growth_domain(pixels: DataFrame, extent: float = 0.5, barrier: float = 1.0) -> DataFrame:
    """Pixels that regions may grow into."""
    return pixels.where(
        (F.col("extent_prob") >= extent) & (F.col("valid") == 1) & (B.presence(F.col("p_skel"), F.col("p_buf")) <= barrier)
    )


def relief_surface(
    pixels: DataFrame, w_boundary: float = 1.0, w_extent: float = 0.5, w_distance: float = 0.5, extent: float = 0.5, barrier: float = 1.0
) -> DataFrame:
    """Adds ``relief`` (0..255): high on boundaries, low inside fields, highest outside the growth domain.

    Per scene: the distance is min-max scaled on valid pixels, pixels outside
    the domain lie 1 above the highest inside, and the sum is scaled to 0..255
    and truncated. Two small aggregates per scene are joined back.
    """
    ok = F.col("valid") == 1
    pres = B.presence(F.col("p_skel"), F.col("p_buf"))
    one = pixels.groupBy("scene_id").agg(
        F.min(F.when(ok, F.col("distance_pred"))).alias("d_lo"), F.max(F.when(ok, F.col("distance_pred"))).alias("d_hi")
    )
    d = B.ratio(F.col("distance_pred") - F.col("d_lo"), F.col("d_hi") - F.col("d_lo"))
    raw = F.lit(w_boundary) * pres + F.lit(w_extent) * (1 - F.col("extent_prob")) + F.lit(w_distance) * (1 - d)
    inside = (F.col("extent_prob") >= extent) & ok & (pres <= barrier)
    df = with_scene(pixels, shared_table(one)).withColumns({"raw": raw, "inside": inside})
    two = df.groupBy("scene_id").agg(
        F.max(F.when(F.col("inside"), F.col("raw"))).alias("r_in"), F.min(F.when(F.col("inside"), F.col("raw"))).alias("r_lo"),
        F.count_if(~F.col("inside")).alias("n_out"),
    )
    df = with_scene(df, shared_table(two))
    v = F.when(F.col("inside"), F.col("raw")).otherwise(F.coalesce("r_in", F.lit(0.0)) + 1)
    low = F.coalesce("r_lo", F.coalesce("r_in", F.lit(0.0)) + 1)
    top = F.when(F.col("n_out") > 0, F.coalesce("r_in", F.lit(0.0)) + 1).otherwise(F.col("r_in"))
    return df.withColumn("relief", F.floor(B.ratio(v - low, top - low) * 255).cast("int")).drop(
        "d_lo", "d_hi", "raw", "inside", "r_in", "r_lo", "n_out"
    )


def aoi_suppression(pixels: DataFrame, inside: DataFrame) -> DataFrame:
    """``valid`` becomes 0 outside the pixels ``inside(scene_id, y, x)`` of the area of interest."""
    keys = inside.select(*KEY).distinct().withColumn("in_aoi", F.lit(1))
    return pixels.join(keys, KEY, "left").withColumn(
        "valid", F.when(F.col("in_aoi").isNotNull(), F.col("valid")).otherwise(0)
    ).drop("in_aoi")


def logit_activations(pixels: DataFrame, extent_logit: str, class_logits: tuple[str, str, str]) -> DataFrame:
    """Adds ``extent_prob, p_bg, p_skel, p_buf``: sigmoid and softmax."""
    soft = B.softmax(*[F.col(c) for c in class_logits])
    return pixels.withColumns(
        {"extent_prob": B.sigmoid(F.col(extent_logit)), **dict(zip(("p_bg", "p_skel", "p_buf"), soft))}
    )


def overview(pixels: DataFrame, factor: int, average: list[str], nearest: list[str]) -> DataFrame:
    """Preview at 1 / ``factor``: means of ``average``, and of ``nearest`` the value nearest the block's centre."""
    off = F.abs(F.col("y") % factor - factor // 2) + F.abs(F.col("x") % factor - factor // 2)
    rank = F.struct(off, "y", "x")
    return pixels.groupBy("scene_id", F.expr(f"y div {factor}").alias("oy"), F.expr(f"x div {factor}").alias("ox")).agg(
        *[F.avg(c).alias(c) for c in average], *[F.min_by(c, rank).alias(c) for c in nearest], F.count("*").alias("n")
    )


#: Pixels of a preview at most (a fixed value).
PREVIEW_PIXELS = 4_000_000


def preview(pixels: DataFrame, scenes: DataFrame, average: list[str], nearest: list[str], budget: int = PREVIEW_PIXELS) -> DataFrame:
    """A preview of each scene of at most ``budget`` pixels: ``scene_id, oy, ox``, ``average``, ``nearest`` and ``n``.

    ``scenes`` has ``scene_id, height, width``. A scene within the budget keeps
    its shape; a larger one is scaled by sqrt(budget / (height width)), each side
    rounded down, 1 at least (which a narrow scene may exceed). A pixel falls into the cell of the preview that
    holds its centre: ``average`` columns are means over a cell, of ``nearest``
    ones it has the pixel nearest its centre, above and left of others as near.
    ``n`` counts its pixels.
    """
    total = F.col("height").cast("double") * F.col("width")
    scale = F.when(total <= budget, F.lit(1.0)).otherwise(F.sqrt(F.lit(float(budget)) / total))
    shape = {out: F.greatest(F.lit(1), F.floor(F.col(side) * scale)).cast("long") for out, side in (("out_h", "height"), ("out_w", "width"))}
    px = with_scene(pixels, scenes.select("scene_id", "height", "width").withColumns(shape))
    # Twice the centre of pixel y, in cells: (2 y + 1) out / height.
    cell = lambda c, out, side: F.expr(f"((2 * {c} + 1) * {out}) div (2 * {side})")
    px = px.withColumns({"oy": cell("y", "out_h", "height"), "ox": cell("x", "out_w", "width")})
    off = lambda c, o, out, side: F.abs((2 * F.col(c) + 1) * F.col(out) - (2 * F.col(o) + 1) * F.col(side)) / (2.0 * F.col(out))
    rank = F.struct(off("y", "oy", "out_h", "height") + off("x", "ox", "out_w", "width"), "y", "x")
    return px.groupBy("scene_id", "oy", "ox").agg(*[F.avg(c).alias(c) for c in average], *[F.min_by(c, rank).alias(c) for c in nearest], F.count("*").alias("n"))


def augment(patches: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """Remaps ``y, x`` of the pixels of each patch by a flip and quarter turns chosen by md5(seed, patch_id).

    Adds ``ny, nx``. All layers are columns of the row, so they move alike.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col("patch_id").cast("string")).cast("binary"))
    bit = lambda i: F.conv(F.substring(h, i, 1), 16, 10).cast("int")
    top = size - 1
    x1 = F.when(bit(1) % 2 == 1, top - F.col("x")).otherwise(F.col("x"))
    y1 = F.when(bit(2) % 2 == 1, top - F.col("y")).otherwise(F.col("y"))
    k = bit(3) % 4
    ny = F.when(k == 0, y1).when(k == 1, top - x1).when(k == 2, top - y1).otherwise(x1)
    nx = F.when(k == 0, x1).when(k == 1, y1).when(k == 2, top - x1).otherwise(top - y1)
    return patches.withColumns({"ny": ny, "nx": nx})


def norm_stats_priority(*sources: DataFrame) -> DataFrame:
    """``band_idx, p_lo, p_hi, origin``: for each band the first of the sources that has it.

    Each source is ``(band_idx, p_lo, p_hi)`` with its name in ``origin``.
    """
    df = None
    for i, s in enumerate(sources):
        one = s.select("band_idx", F.lit(i).alias("rank"), "p_lo", "p_hi", "origin").where("p_lo is not null and p_hi is not null")
        df = one if df is None else df.unionAll(one)
    return df.groupBy("band_idx").agg(
        *[F.min_by(c, "rank").alias(c) for c in ("p_lo", "p_hi", "origin")]
    )
