"""Splits and samples of patches, all by deterministic order or hash."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructType

from sparkraster.operators.tables import shared_table


def key_hash(seed: int, keys: list[str]) -> Column:
    """md5 of ``seed:key:key...``, the same in every engine."""
    parts = [F.lit(f"{seed}")] + [F.col(k).cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def uniform(seed: int, keys: list[str]) -> Column:
    """In (0, 1), from the first 32 bits of ``key_hash``."""
    return (F.conv(F.substring(key_hash(seed, keys), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` in ranges of ``order``, sorted, with ``part``, the number of the range, and ``at``, the place in it from 0.

    Written to the shared folder, so that all who read it see the same ranges.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("mono", F.monotonically_increasing_id())
    part = F.shiftrightunsigned("mono", 33).cast("int")
    return shared_table(dealt.withColumns({"part": part, "at": F.col("mono") - F.shiftleft(part.cast("long"), 33)}).drop("mono"))


def by_part(parts: dict, kind: str = "long") -> Column:
    """A value for each ``part``; 0 where it has none."""
    if not parts:
        return F.lit(0).cast(kind)
    table = F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.col("part")), F.lit(0)).cast(kind)


def _ranked(df: DataFrame, order: list[Column]) -> DataFrame:
    """Adds ``rank`` from 1 in the global order, without one task sorting all rows.

    Rows are range-partitioned and sorted; each partition numbers its own rows
    and adds the rows of the partitions before it. One count per partition
    reaches the driver. The numbers depend on the order alone when the order is
    total, whatever the ranges are.
    """
    dealt = ranged(df, order)
    before, starts = 0, {}
    for r in sorted(dealt.groupBy("part").count().collect()):
        starts[r["part"]] = before
        before += r["count"]
    return dealt.withColumn("rank", F.col("at") + by_part(starts) + 1).drop("part", "at")


#: Steps of the quantiles that a sketch gives, values that one task sorts at most, and the size of a sketch.
GRID, SORTED, SKETCH = 512, 1_000_000, 2048


class _Rank:
    """Where two neighbouring ranks of a group lie: between ``lo`` and ``hi``, with so many values below and inside."""

    def __init__(self, low: int, high: int, size: int, cuts: list[float]):
        self.low, self.high, self.below, self.size, self.cuts = low, high, 0, size, cuts
        self.lo, self.hi, self.margin = -math.inf, math.inf, 2

    def narrowed(self) -> tuple[float, float]:
        """The bracket of the sketch's quantiles around the ranks, a margin wider than where they should be."""
        at = lambda rank: (rank - self.below) * GRID / max(self.size, 1)
        first, last = math.floor(at(self.low)) - self.margin, math.ceil(at(self.high + 1)) + self.margin
        return (self.cuts[first] if first > 0 else self.lo), (self.cuts[last] if last < GRID else self.hi)

    def holds(self, below: int, inside: int) -> bool:
        return below <= self.low and self.high < below + inside


def order_statistics(v: DataFrame, wanted) -> tuple[dict, dict]:
    """Values of given ranks in groups, as driver data: ``(sizes, found)`` of ``v(g, v)`` with doubles that are not null.

    ``wanted(n)`` lists pairs of ranks (low, high), equal or neighbours, for a
    group of n values. ``sizes`` has n by group, ``found[g, i]`` the places
    (from, to, value) that hold the ranks of pair i, so ``from`` is how many
    values are less. NaN sorts last.

    A sketch of each group brackets the ranks. A second scan counts what lies
    below a bracket and keeps only the values inside, with their numbers; a
    sketch that was wrong shows there, and its bracket is widened. While a
    bracket would hold more than about ``SORTED`` values, it is narrowed by a
    scan with a sketch of its inside. So no value is moved but those near the
    ranks. The groups are few.
    """
    cuts = "array(" + ", ".join(f"{k / GRID!r}D" for k in range(GRID + 1)) + ")"
    sketch = F.expr(f"kll_sketch_agg_double(v, {SKETCH})")
    real = v.where(~F.isnan("v"))
    # A sketch leaves NaN out.
    every = v.groupBy("g").agg(F.count("*").alias("n"), F.count_if(~F.isnan("v")).alias("m"), sketch.alias("s"))
    every = every.select("g", "n", "m", F.expr(f"CASE WHEN m > 0 THEN kll_sketch_get_quantile_double(s, {cuts}) END").alias("cuts")).collect()
    sizes, found = {r["g"]: r["n"] for r in every}, {r["g"]: r for r in every}
    open_, got = {}, {}
    for g, n in sizes.items():
        m = found[g]["m"]
        for i, (low, high) in enumerate(wanted(n)):
            got[g, i] = [(m, n, math.nan)]  # places from, to, value
            if low < m:
                open_[g, i] = _Rank(low, min(high, m - 1), m, found[g]["cuts"])
    kind = v.schema["g"].dataType
    schema = StructType().add("g", kind).add("i", IntegerType()).add("lo", DoubleType()).add("hi", DoubleType()).add("low", LongType()).add("high", LongType())
    while open_:
        rows = [(g, i, *r.narrowed(), r.low, r.high) for (g, i), r in open_.items()]
        each = real.join(F.broadcast(v.sparkSession.createDataFrame(rows, schema)), "g")  # a row for each group and quantile
        inside = F.col("v").between(F.col("lo"), F.col("hi"))
        if any(r.size * (2 * r.margin + 2) > SORTED * GRID for r in open_.values() if r.margin < GRID):
            step = each.groupBy("g", "i").agg(F.count_if(F.col("v") < F.col("lo")).alias("below"), F.count_if(inside).alias("n"), F.expr(f"kll_sketch_agg_double(CASE WHEN v BETWEEN lo AND hi THEN v END, {SKETCH})").alias("s"))
            step = step.select("g", "i", "below", "n", F.expr(f"CASE WHEN n > 0 THEN kll_sketch_get_quantile_double(s, {cuts}) END").alias("cuts"))
            for r in step.collect():
                rank = open_[r["g"], r["i"]]
                lo, hi = rank.narrowed()
                if rank.holds(r["below"], r["n"]) and (lo == hi or r["n"] == rank.size):
                    # Equal values, or nothing was gained: the last scan counts them by value.
                    rank.lo, rank.hi, rank.below, rank.size, rank.cuts, rank.margin = lo, hi, r["below"], r["n"], r["cuts"], GRID
                elif rank.holds(r["below"], r["n"]):
                    rank.lo, rank.hi, rank.below, rank.size, rank.cuts, rank.margin = lo, hi, r["below"], r["n"], r["cuts"], 2
                else:
                    rank.margin *= 4
            continue
        near = each.where(F.col("v") <= F.col("hi")).groupBy("g", "i", "low", "high", F.when(inside, F.col("v")).alias("v")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(W.partitionBy("g", "i").orderBy(F.col("v").asc_nulls_first()))
        near = near.withColumn("upto", upto).where("v IS NOT NULL AND upto > low AND upto - n <= high")
        for r in near.collect():
            got[r["g"], r["i"]].append((r["upto"] - r["n"], r["upto"], r["v"]))
        for k, rank in list(open_.items()):
            if all(any(a <= p < b for a, b, _ in got[k]) for p in (rank.low, rank.high)):
                del open_[k]
            else:
                got[k], rank.margin = got[k][:1], rank.margin * 4
    return sizes, got


def exact_quantiles(df: DataFrame, group: str, value: str, qs: list[float]) -> DataFrame:
    """``group, n, q0, q1, ...``: exact quantiles of ``value`` in each group, linear between ranks; see ``order_statistics``.

    Nulls do not count; rows without a group are left out. The groups are few.
    """
    v = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
    sizes, got = order_statistics(v, lambda n: [(int(q * (n - 1)), min(int(q * (n - 1)) + 1, n - 1)) for q in qs])
    kind = df.schema[group].dataType
    out = []
    for g, n in sizes.items():
        values = []
        for i, q in enumerate(qs):
            place = q * (n - 1)
            low, share = int(place), place - int(place)
            pick = lambda p: next(x for a, b, x in got[g, i] if a <= p < b)  # noqa: B023, E731
            values.append(pick(low) * (1.0 - share) + (pick(low + 1) * share if share else 0.0))
        out.append((g, n, *values))
    schema = StructType().add(group, kind).add("n", LongType())
    for i in range(len(qs)):
        schema = schema.add(f"q{i}", DoubleType())
    return df.sparkSession.createDataFrame(out, schema)


def _cut(df: DataFrame, order: list[Column], ratios: tuple[float, float]) -> DataFrame:
    ranked = _ranked(df, order)
    n = ranked.count()
    train = max(1, round(n * ratios[0]))  # half to even
    val = round(n * ratios[1])
    r = F.col("rank")
    return ranked.withColumn("split", F.when(r <= train, "train").when(r <= train + val, "val").otherwise("test")).drop("rank")


def ordered_split(patches: DataFrame, order: list[str], ratios: tuple[float, float] = (0.7, 0.15)) -> DataFrame:
    """Adds ``split``: sorted by ``order`` and cut into train, val and the rest, test."""
    return _cut(patches, [F.col(c) for c in order], ratios)


def random_split(patches: DataFrame, keys: list[str], seed: int = 42, ratios: tuple[float, float] = (0.7, 0.15)) -> DataFrame:
    """As ``ordered_split`` in the order of a seeded hash of the keys."""
    df = patches.withColumn("h", key_hash(seed, keys))
    return _cut(df, [F.col("h"), *[F.col(k) for k in keys]], ratios).drop("h")


def weighted_sample(df: DataFrame, weight: str, keys: list[str], n: int, seed: int, replacement: bool = False) -> DataFrame:
    """``n`` rows drawn by weight.

    Without replacement: the n smallest -ln(u) / w (Efraimidis and Spirakis,
    2006), equal ones in order of ``keys``. The n-th of them is found by counts,
    see ``order_statistics``, and a filter takes the rows up to it, so a sample of
    half of a table is no one's work. With replacement: the n points (i + u) / n of
    the cumulated weights, so a row comes as often as points fall on it.
    """
    if not replacement:
        rank = -F.log(uniform(seed, keys)) / F.col(weight)
        keyed = df.where(F.col(weight) > 0).withColumn("draw", rank)
        sizes, found = order_statistics(keyed.select(F.lit(0).alias("g"), F.col("draw").alias("v")), lambda m: [(min(n, m) - 1,) * 2] if n else [])
        if not n or sizes.get(0, 0) <= n:
            return keyed.where(F.lit(bool(n))).drop("draw")
        less, upto, last = next(f for f in found[0, 0] if f[0] <= n - 1 < f[1])
        if upto == n:
            return keyed.where(F.col("draw") <= last).drop("draw")
        ties = _ranked(keyed.where(F.col("draw") == last), [F.col(k) for k in keys]).where(F.col("rank") <= n - less)
        return keyed.where(F.col("draw") < last).unionByName(ties.drop("rank")).drop("draw")
    u = float(int.from_bytes(seed.to_bytes(8, "little"), "little") % 997 + 0.5) / 997
    # Cumulated weights: sums of the ranges before, and a window inside each range.
    dealt = ranged(df.where(F.col(weight) > 0), [F.col(k) for k in keys])
    total, starts = 0.0, {}
    for r in sorted(dealt.groupBy("part").agg(F.sum(F.col(weight).cast("double")).alias("w")).collect()):
        starts[r["part"]] = total
        total += r["w"]
    inside = F.sum(F.col(weight).cast("double")).over(W.partitionBy("part").orderBy("at").rowsBetween(W.unboundedPreceding, 0))
    hi = by_part(starts, "double") + inside
    dealt = dealt.withColumn("hi", hi).withColumn("lo", F.col("hi") - F.col(weight))
    point = lambda c: F.ceil(F.col(c) / F.lit(total or 1.0) * n - u)
    times = F.greatest(point("hi") - point("lo"), F.lit(0)).cast("int")
    return dealt.withColumn("draw", F.explode(F.array_repeat(F.lit(1), times))).drop("draw", "hi", "lo", "part", "at")
