"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted the same fractional number of times: the
source's target over its size, at most ``most_copies``. The whole part is taken
as it is. The fraction is rounded by the pivotal method (Deville and Tille,
1998): two fractional probabilities meet, mass moves at random from one to the
other until one of them is 0 or 1, and the other one, the residual, meets the
next. Mass is counted in words, so the words taken, and not only the number of
documents, keep their expected sum up to one last residual.

The pairing is a reduction tree. Its leaves are groups of about ``FAN``
documents of one source and size class, chosen by a hash; a fold over a group
leaves at most one residual; the residuals of a class form the groups of the
next level; the last residuals of all classes of a source meet in one fold over
its size classes (whose number is bounded by the logarithm of the largest size),
and one last probability for each source is rounded by itself. A source that
holds a third of all rows is only more groups. All of it is DataFrame
expressions; random numbers are hashes of (seed, level, document), so a rerun
gives the same mix whatever the partitions. A document is known by a hash of its
id, source and text; rows alike in all three are numbered, so any number of them
spreads over as many groups as other rows. Only ids and sizes go through the
tree; the rows themselves are joined to its decisions once, at the end.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparkraster.llm.shared import WORD, cut, stored
from sparkraster.operators.sampling import _ranked

WEIGHTS = (5.0, 2.0, 1.0)
FAN = 48
#: Size classes of a factor of two.
CLASSES_PER_DOUBLING = 16
EPS = 1e-9


def size_in_words(text: Column) -> Column:
    """Number of words of ``text``; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most_copies: float = 2.0
) -> DataFrame:
    """Per source: ``source, source_size, target``.

    ``sizes`` has ``source`` and ``size``. Sources in code-point order, null
    last, get the weights in turn. ``share`` times all sizes is dealt out by
    weight; a source stops at ``most_copies`` times its size and its excess is
    dealt again by weight until none is above. Only one row per source is ever
    gathered; sources of size 0 have target 0.
    """
    by = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most_copies))
    by = cut(by.select("source", "source_size", w.alias("weight"), cap.alias("cap")))
    # In order of cap over weight, the sources before some place are capped and the others share the rest by weight;
    # the level is the rest over their weights at the first place where no cap lies below it.
    before = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    onward = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(0, W.unboundedFollowing)
    total = by.agg(F.sum("source_size").cast("double")).first()[0] or 0.0
    level = (F.lit(total * share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    fits = by.where("source_size > 0").select(level.alias("level"), (F.col("cap") / F.col("weight")).alias("own"))
    level = fits.where("level <= own").agg(F.max("level")).first()[0]
    target = F.col("cap") if level is None else F.least("cap", F.col("weight") * F.lit(level))
    return by.select("source", "source_size", target.alias("target"))


def _uniform(seed: int, level: Column | int, *keys: Column) -> Column:
    """A number in [0, 1) from a hash of its arguments."""
    lv = level if isinstance(level, Column) else F.lit(level)
    h = F.xxhash64(F.lit(seed), lv, *keys)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def _fold(items: Column) -> Column:
    """Pivotal rounding of an array of (p, s, u): decisions (i, v), the residual's index and p.

    Mass is counted in words: what one document gains the other one loses, so
    the sum of p * s stays as it is. The direction is drawn so that every p
    keeps its expectation. Indices start at 1; no residual has index 0.
    """
    start = F.struct(
        F.array().cast("array<struct<i:int,v:int>>").alias("done"),
        F.lit(0).alias("at"), F.lit(0.0).alias("p"), F.lit(1.0).alias("s"), F.lit(0).alias("n"),
    )

    def with_one(done, i, v):
        return F.concat(done, F.array(F.struct(i.alias("i"), v.cast("int").alias("v"))))

    def state(done, at, p, s, n):
        # A probability within rounding of 0 or 1 is decided at once.
        sure = (at > 0) & ((p < EPS) | (p > 1 - EPS))
        return F.struct(
            F.when(sure, with_one(done, at, p > 0.5)).otherwise(done).alias("done"),
            F.when(sure, 0).otherwise(at).alias("at"),
            F.when(sure, 0.0).otherwise(p).alias("p"),
            s.alias("s"), n.alias("n"),
        )

    def step(acc, x):
        n = acc["n"] + 1
        a, sa, b, sb = acc["p"], acc["s"], x["p"], x["s"]
        up = F.least((1 - a) * sa, b * sb)  # words from the new to the carried document
        down = F.least(a * sa, (1 - b) * sb)
        rises = x["u"] * (up + down) < down
        moved = F.when(rises, up).otherwise(-down)
        a2, b2 = a + moved / sa, b - moved / sb
        carried_done = F.when(rises, (1 - a) * sa <= b * sb).otherwise(a * sa <= (1 - b) * sb)
        merged = F.when(
            carried_done, state(with_one(acc["done"], acc["at"], rises), n, b2, sb, n)
        ).otherwise(state(with_one(acc["done"], n, ~rises), acc["at"], a2, sa, n))
        return F.when(acc["at"] == 0, state(acc["done"], n, b, sb, n)).otherwise(merged)

    return F.aggregate(items, start, step)


def _level(df: DataFrame, keys: list[str], level: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """One level of the tree: rounds each group of ``keys``; (decided rows, residual rows).

    ``df`` has the keys and ``size, uid, no, p``. A group is folded from its
    largest document to its smallest.
    """
    item = F.struct((-F.col("size")).alias("o"), F.xxhash64(F.lit(seed), "uid").alias("h"), "uid", "no", "p")
    psu = F.transform(
        "items",
        lambda x: F.struct(
            x["p"].alias("p"), (-x["o"]).cast("double").alias("s"), _uniform(seed, level, x["uid"]).alias("u")
        ),
    )
    g = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"))
    g = stored(g.withColumn("f", _fold(psu)))
    decided = g.select(
        F.inline(F.transform("f.done", lambda d: F.struct(F.element_at("items", d["i"])["no"].alias("no"), d["v"].alias("extra"))))
    )
    at = F.element_at("items", F.col("f.at"))
    rest = g.where(F.col("f.at") > 0).select(
        *keys, (-at["o"]).alias("size"), at["uid"].alias("uid"), at["no"].alias("no"), F.col("f.p").alias("p")
    )
    return decided, rest


def _numbered(base: DataFrame) -> DataFrame:
    """``base(no, key, ...)`` with ``uid``, a hash of the key and of the row's number among rows of the same key.

    Rows of one key are alike, so it does not matter which gets which number.
    Only repeated keys are ranked, in ranges of (key, no) that cut a key with
    many rows; no task holds all rows of a key.
    """
    often = base.groupBy("key").count().where("count > 1").select(F.col("key").alias("often"))
    seen = base.join(often, F.col("key") == F.col("often"), "left")
    single = seen.where("often is null").drop("often").withColumn("uid", F.col("key"))
    ranked = _ranked(seen.where("often is not null").drop("often"), [F.col("key"), F.col("no")])
    first = ranked.groupBy(F.col("key").alias("first_key")).agg(F.min("rank").alias("first"))
    again = ranked.join(first, F.col("key") == F.col("first_key"))
    again = again.withColumn("uid", F.xxhash64("key", F.col("rank") - F.col("first")))
    return single.unionByName(again.drop("rank", "first", "first_key"))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    most_copies: float = 2.0,
    seed: int = 17,
    keep: list[str] | None = None,
) -> DataFrame:
    """Copies of each document in a mix of ``share`` times all words.

    ``docs`` has ``doc_id, text, source``. The result has one row for each input
    row: the columns ``keep`` (default ``doc_id``) as a struct ``row``, and
    ``size, source_size, target, copies, taken`` (``copies * size``).

    Null or empty texts have size 0 and take 0 words; null sources are a source
    of their own, last in order; repeated rows and repeated or null ids are
    documents of their own. Rows equal in id, source and text are exchangeable.
    An empty table gives an empty result. Other columns are ignored.
    """
    keep = keep or ["doc_id"]
    rows = stored(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("source"), size_in_words(F.col("text")).alias("size"),
            F.xxhash64("doc_id", "source", "text").alias("key"), F.monotonically_increasing_id().alias("no"),
        )
    )
    base = stored(_numbered(rows.select("no", "key", "source", "size")))
    targets = source_targets(base, weights, share, most_copies).withColumnRenamed("source", "ts")
    cls = F.floor(F.log2(F.col("size") + F.lit(1.0)) * CLASSES_PER_DOUBLING).cast("int")
    # One small table, sources x size classes, tells into how many groups a class goes.
    classes = (
        base.withColumn("cls", cls).groupBy("source", "cls").agg(F.count("*").alias("n"))
        .join(targets, F.col("source").eqNullSafe(F.col("ts")))
        .select(
            F.col("source").alias("cs"), F.col("cls").alias("cc"), F.ceil(F.col("n") / FAN).cast("int").alias("groups"),
            "source_size", "target",
        )
    )
    classes = cut(classes)
    most = classes.agg(F.max("groups")).first()[0] or 1
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate + EPS)
    leaf = (
        base.withColumn("cls", cls)
        .join(classes, F.col("source").eqNullSafe(F.col("cs")) & (F.col("cls") == F.col("cc")))
        .select(
            "source", "cls", "size", "uid", "no", F.greatest(rate - whole, F.lit(0.0)).alias("p"),
            F.pmod(F.xxhash64(F.lit(seed), F.lit("group"), "uid"), F.col("groups")).cast("int").alias("g"),
        )
    )
    settled = (F.col("p") < EPS) | (F.col("size") == 0)
    done = [leaf.where(settled).select("no", F.lit(0).alias("extra"))]
    df, level = leaf.where(~settled), 0
    while True:
        decided, rest = _level(df, ["source", "cls", "g"], level, seed)
        done.append(decided)
        if most <= 1:
            break
        df = rest.withColumn("g", F.floor(F.col("g") / FAN).cast("int"))
        most, level = -(-most // FAN), level + 1
    decided, last = _level(rest.drop("cls", "g"), ["source"], 1000, seed)
    done.append(decided)
    done.append(last.select("no", (_uniform(seed, 2000, F.col("uid")) < F.col("p")).cast("int").alias("extra")))
    every = functools.reduce(DataFrame.unionAll, done)
    of_source = targets.select("ts", "source_size", "target", whole.cast("int").alias("whole"))
    copies = F.col("whole") + F.col("extra")
    found = rows.drop("key").join(every, "no").join(of_source, F.col("source").eqNullSafe(F.col("ts")))
    return found.select(
        "row", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix`` takes it, columns as they are.

    Rows without words are taken once for each whole copy of their source.
    """
    m = mix(docs, keep=docs.columns, **options)
    return m.where("copies > 0").select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")
