"""Connected components of a link table, as rounds of grouping and joining."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkraster.operators.tables import checkpointed as cut


def least_of_component(i, j, n: int):
    """numpy: the smallest member of the component of each of ``n`` nodes with the links i - j, for links that fit one task."""
    import numpy as np

    low = np.arange(n)
    while len(i):
        a, b = low[i], low[j]
        if (a == b).all():
            break
        root = np.minimum(a, b)
        np.minimum.at(low, a, root)
        np.minimum.at(low, b, root)
        while (low[low] != low).any():
            low = low[low]
    return low


def components(links: DataFrame) -> DataFrame:
    """Components of ``links(a, b)`` as ``(node, component)``, the smallest id of each.

    Only nodes with a link to another node appear. Null ids, self links and
    repeated links are ignored; an empty table gives an empty result.

    Each round every node hooks onto its smallest neighbour, and the links are
    contracted to the roots of the hooks, the local minima, of which each hook
    leaves one less. A hub is only a key of a grouped minimum (combined before
    the shuffle) and of plain equi-joins that AQE can split. Every round is
    cut through the shared folder.
    """
    e = (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    e = cut(e)
    found = None
    while not e.isEmpty():
        up = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = cut(
            up.groupBy("u").agg(F.min("v").alias("m"))
            .select(F.col("u").alias("node"), F.least("u", "m").alias("to"))
        )
        # Hooks point to ever smaller ids. Jumping doubles their reach until each is at its root,
        # so a chain takes the logarithm of its length and not as many rounds.
        while True:
            far = hook.select(F.col("node").alias("to"), F.col("to").alias("far"))
            hook = cut(
                hook.join(far, "to", "left")
                .select("node", F.coalesce("far", "to").alias("to"), (F.coalesce("far", "to") < F.col("to")).alias("moved"))
            )
            if hook.where("moved").isEmpty():
                break
            hook = hook.drop("moved")
        hook = hook.drop("moved")
        left = hook.select(F.col("node").alias("u"), F.col("to").alias("tu"))
        right = hook.select(F.col("node").alias("v"), F.col("to").alias("tv"))
        e = (
            e.join(left, "u").join(right, "v").where("tu <> tv")
            .select(F.greatest("tu", "tv").alias("u"), F.least("tu", "tv").alias("v"))
            .distinct()
        )
        e = cut(e)
        if found is None:
            found = hook
        else:
            step = hook.select(F.col("node").alias("to"), F.col("to").alias("next"))
            found = cut(found.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to")))
    if found is None:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.select("node", F.col("to").alias("component"))
