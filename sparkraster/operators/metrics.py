"""Quality metrics over pixels: confusion counts, boundaries, distances, losses, percentiles, checks."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkraster.functions import bands as B
from sparkraster.operators.sampling import exact_quantiles


def _grouped(df: DataFrame, keys: list[str]):
    return df.groupBy(*keys) if keys else df.groupBy()


def pixel_metrics(pixels: DataFrame, threshold: float = 0.5, strict: bool = False, keys: list[str] | None = None) -> DataFrame:
    """Confusion counts and IoU, F1, precision, recall of the extent, on valid pixels not labelled 255.

    ``strict`` asks for more than the threshold instead of at least it.
    ``ignored_px`` counts every 255 whatever its mask. No keys: one row for all.
    """
    ok = (F.col("valid") == 1) & (F.col("gt_extent") != B.IGNORE)
    pred = F.col("extent_prob") > threshold if strict else F.col("extent_prob") >= threshold
    gt = F.col("gt_extent") == 1
    tp, fp, fn, tn = (F.count_if(ok & a & b) for a, b in ((gt, pred), (~gt, pred), (gt, ~pred), (~gt, ~pred)))
    counts = _grouped(pixels, keys or []).agg(
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"), F.count_if(F.col("valid") == 1).alias("valid_px"),
        F.count_if(F.col("valid") != 1).alias("invalid_px"), F.count_if(F.col("gt_extent") == B.IGNORE).alias("ignored_px"),
    )
    return with_scores(counts)


def with_scores(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {"iou": B.ratio(tp, tp + fp + fn), "f1": B.f1(tp, fp, fn), "precision": B.ratio(tp, tp + fp), "recall": B.ratio(tp, tp + fn)}
    )


PRED_MODES = {
    "not_background": lambda t: B.boundary_class(F.col("p_bg"), F.col("p_skel"), F.col("p_buf")) != 0,
    "skeleton": lambda t: B.boundary_class(F.col("p_bg"), F.col("p_skel"), F.col("p_buf")) == 1,
    "by_sum": lambda t: F.col("p_skel") + F.col("p_buf") >= t,
}
GT_MODES = {"any": lambda: F.col("gt_boundary") != 0, "skeleton": lambda: F.col("gt_boundary") == 1}


def boundary_metrics(pixels: DataFrame, threshold: float = 0.5, keys: list[str] | None = None) -> DataFrame:
    """Boundary precision, recall and F1 on valid pixels for each way to call predictions and ground truth; one scan."""
    keys, ok = keys or [], F.col("valid") == 1
    aggs, names = [], []
    for p, pred in PRED_MODES.items():
        for g, gt in GT_MODES.items():
            a, b = pred(threshold), gt()
            names.append((p, g))
            aggs.append(F.struct(
                F.lit(p).alias("pred_mode"), F.lit(g).alias("gt_mode"), F.count_if(ok & a & b).alias("tp"),
                F.count_if(ok & a & ~b).alias("fp"), F.count_if(ok & ~a & b).alias("fn"),
            ))
    one = _grouped(pixels, keys).agg(F.array(*aggs).alias("rows")).select(*keys, F.inline("rows"))
    return with_scores(one).drop("iou")


def distance_metrics(pixels: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """MAE and RMSE of the distance on valid pixels, with their number; null without one."""
    d = F.when(F.col("valid") == 1, F.col("distance_pred") - F.col("gt_distance"))
    return _grouped(pixels, keys or []).agg(F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"), F.count(d).alias("n"))


def threshold_sweep(pixels: DataFrame, thresholds: list[float], keys: list[str]) -> DataFrame:
    """Extent precision, recall, F1 and precision - recall for each threshold and key on valid pixels; one scan."""
    gt = F.col("gt_extent") == 1
    rows = [
        F.struct(
            F.lit(float(t)).alias("threshold"), F.count_if(gt & (F.col("extent_prob") >= t)).alias("tp"),
            F.count_if(~gt & (F.col("extent_prob") >= t)).alias("fp"), F.count_if(gt & (F.col("extent_prob") < t)).alias("fn"),
        )
        for t in thresholds
    ]
    df = pixels.where("valid = 1").groupBy(*keys).agg(F.array(*rows).alias("rows")).select(*keys, F.inline("rows"))
    p, r = B.ratio(F.col("tp"), F.col("tp") + F.col("fp")), B.ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return df.withColumns({"prec": p, "rec": r, "f1": B.f1(F.col("tp"), F.col("fp"), F.col("fn")), "gap": p - r})


def boundary_class_metrics(pixels: DataFrame) -> DataFrame:
    """F1 for any boundary, skeleton and buffer by the class of largest probability, and the mean of the latter two."""
    ok = F.col("valid") == 1
    pred = B.boundary_class(F.col("p_bg"), F.col("p_skel"), F.col("p_buf"))
    out = []
    for name, a, b in (("any", pred != 0, F.col("gt_boundary") != 0), ("skeleton", pred == 1, F.col("gt_boundary") == 1), ("buffer", pred == 2, F.col("gt_boundary") == 2)):
        out += [F.count_if(ok & x & y).alias(f"{k}_{name}") for k, x, y in (("tp", a, b), ("fp", a, ~b), ("fn", ~a, b))]
    df = pixels.groupBy().agg(*out)
    made = {f"f1_{n}": B.f1(F.col(f"tp_{n}"), F.col(f"fp_{n}"), F.col(f"fn_{n}")) for n in ("any", "skeleton", "buffer")}
    df = df.withColumns(made)
    return df.withColumn("macro2_f1", (F.col("f1_skeleton") + F.col("f1_buffer")) / 2)


#: Fixed values of the training losses.
FOCAL_GAMMA, FOCAL_ALPHA, DICE_SMOOTH, HUBER_BETA = 2.0, 0.25, 1.0, 1.0
CLASS_WEIGHTS = (0.5, 4.0, 1.5)
LOSS_WEIGHTS = (1.0, 2.5, 1.0)


def _p(c: Column) -> Column:
    return B.clip(c, 1e-7, 1 - 1e-7)


def losses(pixels: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``bce, focal, dice, extent, boundary_ce, skeleton_dice, boundary, distance, total`` over valid pixels; one scan.

    Extent is half focal binary cross-entropy and half soft Dice loss on pixels
    not labelled 255; boundary is class-weighted focal cross-entropy plus half
    the Dice loss of the skeleton; distance is the Huber loss.
    """
    ok = F.col("valid") == 1
    on = ok & (F.col("gt_extent") != B.IGNORE)
    p, y = _p(F.col("extent_prob")), (F.col("gt_extent") == 1).cast("double")
    pt = F.when(y == 1, p).otherwise(1 - p)
    at = F.when(y == 1, FOCAL_ALPHA).otherwise(1 - FOCAL_ALPHA)
    cls = F.col("gt_boundary")
    pc = _p(F.when(cls == 1, F.col("p_skel")).when(cls == 2, F.col("p_buf")).otherwise(F.col("p_bg")))
    wc = F.when(cls == 1, CLASS_WEIGHTS[1]).when(cls == 2, CLASS_WEIGHTS[2]).otherwise(CLASS_WEIGHTS[0])
    sk, sy = F.col("p_skel"), (cls == 1).cast("double")
    d = F.abs(F.col("distance_pred") - F.col("gt_distance"))
    huber = F.when(d < HUBER_BETA, 0.5 * d * d / HUBER_BETA).otherwise(d - 0.5 * HUBER_BETA)

    def mean(c, where):
        return F.avg(F.when(where, c))

    def dice(a, b, where):
        both, sums = F.sum(F.when(where, a * b)), F.sum(F.when(where, a + b))
        return 1 - (2 * both + DICE_SMOOTH) / (sums + DICE_SMOOTH)

    df = _grouped(pixels, keys or []).agg(
        mean(-F.log(pt), on).alias("bce"), mean(-at * F.pow(1 - pt, F.lit(FOCAL_GAMMA)) * F.log(pt), on).alias("focal"), dice(p, y, on).alias("dice"),
        mean(-wc * F.pow(1 - pc, F.lit(FOCAL_GAMMA)) * F.log(pc), ok).alias("boundary_ce"), dice(sk, sy, ok).alias("skeleton_dice"),
        mean(huber, ok).alias("distance"),
    )
    df = df.withColumns(
        {"extent": 0.5 * F.col("focal") + 0.5 * F.col("dice"), "boundary": F.col("boundary_ce") + 0.5 * F.col("skeleton_dice")}
    )
    e, b, dd = LOSS_WEIGHTS
    return df.withColumn("total", e * F.col("extent") + b * F.col("boundary") + dd * F.col("distance"))


def band_percentiles(pixels: DataFrame, columns: list[str], lo: float = 0.005, hi: float = 0.995) -> DataFrame:
    """Exact ``band_idx, p_lo, p_hi, n_valid`` of valid pixels, linear between ranks; see ``exact_quantiles``."""
    long = F.inline(F.array(*[F.struct(F.lit(i).alias("band_idx"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]))
    q = exact_quantiles(pixels.where("valid = 1").select(long), "band_idx", "v", [lo, hi])
    return q.select("band_idx", F.col("q0").alias("p_lo"), F.col("q1").alias("p_hi"), F.col("n").alias("n_valid"))


def band_sketches(pixels: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """KLL sketches of the bands of valid pixels for each key: a state that merges."""
    return _grouped(pixels.where("valid = 1"), keys or []).agg(
        *[F.expr(f"kll_sketch_agg_double(CAST({c} AS DOUBLE))").alias(c) for c in columns], F.count("*").alias("n_valid")
    )


def merge_sketches(sketches: DataFrame, columns: list[str]) -> DataFrame:
    return sketches.agg(*[F.expr(f"kll_merge_agg_double({c})").alias(c) for c in columns], F.sum("n_valid").alias("n_valid"))


def keep_sketches(pixels: DataFrame, columns: list[str], batch: str, path: str) -> None:
    """Keeps the state of a batch of pixels in the table at ``path``; a batch that comes again replaces what it left.

    The table has a partition for each batch, which is overwritten as a whole,
    so a batch that was sent twice, or whose job was repeated, counts once.
    """
    one = band_sketches(pixels, columns).withColumn("batch", F.lit(batch))
    one.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def kept_sketch(spark, path: str, columns: list[str]) -> DataFrame:
    """The merged state of all batches kept at ``path``, one row; batches without a valid pixel add nothing."""
    return merge_sketches(spark.read.parquet(path).where("n_valid > 0"), columns)


def sketch_percentiles(sketch: DataFrame, columns: list[str], lo: float = 0.005, hi: float = 0.995) -> DataFrame:
    """``band_idx, p_lo, p_hi, n_valid`` of one merged sketch row; the rank error is that of the sketch, about 1 %."""
    rows = [
        F.struct(
            F.lit(i).alias("band_idx"), F.expr(f"kll_sketch_get_quantile_double({c}, {lo}D)").alias("p_lo"),
            F.expr(f"kll_sketch_get_quantile_double({c}, {hi}D)").alias("p_hi"), F.col("n_valid"),
        )
        for i, c in enumerate(columns)
    ]
    return sketch.select(F.inline(F.array(*rows)))


def valid_coverage(pixels: DataFrame, keys: list[str] | None = None) -> DataFrame:
    v = F.count_if(F.col("valid") == 1)
    return _grouped(pixels, keys or []).agg(
        v.alias("valid_px"), (F.count("*") - v).alias("invalid_px"), F.count("*").alias("total_px"), B.ratio(v, F.count("*")).alias("fraction")
    )


# Checks: one row for each violation.


def _violations(aggregated: DataFrame, tests: dict[str, Column], keys: list[str]) -> DataFrame:
    found = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in tests.items()]), lambda v: v.isNotNull())
    return aggregated.select(*keys, F.explode(found).alias("violation"))


def domain_check(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """Values outside their domain: extent {0, 1, 255}, boundary {0, 1, 2}, valid {0, 1}, distance >= 0; 255 iff invalid."""
    bad = {
        "extent_domain": ~F.col("gt_extent").isin(0, 1, 255), "boundary_domain": ~F.col("gt_boundary").isin(0, 1, 2),
        "valid_domain": ~F.col("valid").isin(0, 1), "negative_distance": F.col("gt_distance") < 0,
        "ignore_label": (F.col("gt_extent") == 255) != (F.col("valid") == 0),
    }
    one = pixels.groupBy(*keys).agg(*[F.count_if(v).alias(k) for k, v in bad.items()])
    return _violations(one, {k: F.col(k) > 0 for k in bad}, keys)


def shape_check(pixels: DataFrame, keys: list[str], size: int, layers: list[str]) -> DataFrame:
    """Layers of a patch that do not have ``size`` squared values."""
    one = pixels.groupBy(*keys).agg(*[F.count(c).alias(c) for c in layers])
    return _violations(one, {c: F.col(c) != size * size for c in layers}, keys)


def probability_check(pixels: DataFrame, keys: list[str], slack: float = 1e-6, sum_slack: float = 5e-3) -> DataFrame:
    """Probabilities outside [0, 1] or classes that do not sum to 1, on valid pixels."""
    ok = F.col("valid") == 1
    tests = {f"{c}_range": (F.col(c) < -slack) | (F.col(c) > 1 + slack) for c in ("extent_prob", "p_bg", "p_skel", "p_buf")}
    tests["simplex"] = F.abs(F.col("p_bg") + F.col("p_skel") + F.col("p_buf") - 1) > sum_slack
    one = pixels.groupBy(*keys).agg(*[F.count_if(ok & v).alias(k) for k, v in tests.items()])
    return _violations(one, {k: F.col(k) > 0 for k in tests}, keys)


def norm_stats_check(stats: DataFrame, channels: int, keys: list[str] | None = None) -> DataFrame:
    """Band statistics that are not one row for each of 0..channels - 1, or with p_hi <= p_lo."""
    keys = keys or []
    one = _grouped(stats, keys).agg(
        F.count("*").alias("n"), F.count_distinct("band_idx").alias("kinds"), F.min("band_idx").alias("lo"), F.max("band_idx").alias("hi"),
        F.count_if(~(F.col("p_hi") > F.col("p_lo"))).alias("flat"),
    )
    return _violations(
        one,
        {
            "not_contiguous": (F.col("n") != channels) | (F.col("kinds") != channels) | (F.col("lo") != 0) | (F.col("hi") != channels - 1),
            "flat_range": F.col("flat") > 0,
        },
        keys,
    )


def metadata_check(patches: DataFrame, required: list[str], mode: str, keys: list[str]) -> DataFrame:
    """Missing metadata of a patch, and a feature mode other than ``mode``."""
    tests = {f"missing_{c}": F.col(c).isNull() for c in required}
    tests["feature_mode"] = ~F.col("feature_mode").eqNullSafe(F.lit(mode))
    return _violations(patches, tests, keys)


def verdict(*violations: DataFrame) -> DataFrame:
    """One row: number of violations of each kind of check together, and ``ok``."""
    every = functools.reduce(DataFrame.unionAll, [v.select("violation") for v in violations])
    return every.agg(F.count("*").alias("violations"), F.count_distinct("violation").alias("kinds"), (F.count("*") == 0).alias("ok"))
