"""Column expressions over band, probability and mask columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Band order of the 8-band scenes and the constants of the indices.
BANDS = ("coastal", "blue", "green", "yellow", "red", "rededge", "nir1", "nir2")
GREEN, RED, NIR = "b3", "b5", "b7"
EPSILON = 1e-6
SAVI_L = 0.5
IGNORE = 255


def ndvi(red: Column, nir: Column) -> Column:
    return (nir - red) / (nir + red + EPSILON)


def savi(red: Column, nir: Column) -> Column:
    return (1 + SAVI_L) * (nir - red) / (nir + red + SAVI_L + EPSILON)


def ndwi(green: Column, nir: Column) -> Column:
    return (green - nir) / (green + nir + EPSILON)


def finite_or_zero(c: Column) -> Column:
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(bad, 0.0).otherwise(c)


def clip(c: Column, low, high) -> Column:
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    return F.least(F.greatest(c, low), high)


def rescale(c: Column, p_lo, p_hi, low: float = 0.0, high: float = 1.0) -> Column:
    """``c`` clipped to [p_lo, p_hi] and mapped to [low, high]; a flat range gives ``low``."""
    p_lo, p_hi = (x if isinstance(x, Column) else F.lit(float(x)) for x in (p_lo, p_hi))
    share = F.coalesce(F.try_divide(clip(c, p_lo, p_hi) - p_lo, p_hi - p_lo), F.lit(0.0))
    return share * (high - low) + low


def presence(p_skel: Column, p_buf: Column) -> Column:
    """Boundary presence: skeleton or buffer, clipped to [0, 1]."""
    return clip(p_skel + p_buf, 0.0, 1.0)


def boundary_class(p_bg: Column, p_skel: Column, p_buf: Column) -> Column:
    """Class of the largest probability; ties go to the lowest class."""
    return F.when((p_bg >= p_skel) & (p_bg >= p_buf), 0).when(p_skel >= p_buf, 1).otherwise(2)


def sigmoid(c: Column) -> Column:
    return 1 / (1 + F.exp(-c))


def softmax(*logits: Column) -> list[Column]:
    top = F.greatest(*logits)
    parts = [F.exp(x - top) for x in logits]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return [p / total for p in parts]


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double; 0 where b is 0 or null."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2 * tp, 2 * tp + fp + fn)
