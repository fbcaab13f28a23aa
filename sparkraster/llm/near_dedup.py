"""Near-duplicate vectors by int8 quantised tile products with error bounds.

Vectors of one label are compared with each other. Equal vectors are one class
from the start. Classes are sorted by label and by a fixed projection and packed
into blocks; two blocks of a label form a tile when their projections come
within the distance that the threshold allows (|u - v| <= sqrt(2 - 2t) for unit
vectors). In a tile every unit vector v is s * q + e with int8 q, so

    |u.v - s_u s_v (q_u . q_v)| <= |e_u| |s_v q_v| + |e_v|

with the norms of the errors known for each vector. Products of int8 codes are
exact in float32 over up to 1024 dimensions at a time. Vectors are quantised
once, and the tiles first meet in codes alone, an eighth of the bytes; only tiles
with a pair whose bound reaches the threshold fetch the doubles, and only such
pairs are computed again. A tile gives sums of links for its vectors and a star
forest of them, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkraster.llm.shared import mix64, small_batches, spanning_edges, stored, trimmed
from sparkraster.operators.graph import components

BLOCK = 1024
#: Blocks of a label that one task compares with all its blocks.
SHARE = 16
DIMS_EXACT = 1024  # 1024 * 127 * 127 < 2**24


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes int8, scale, norm of the error, norm of scale * code) of unit rows."""
    scale = np.abs(unit).max(1) / 127.0
    codes = np.rint(unit / scale[:, None])
    back = codes * scale[:, None]
    error = np.sqrt(((unit - back) ** 2).sum(1)) + 1e-12
    return codes.astype(np.int8), scale, error, np.sqrt((back**2).sum(1)) + 1e-12


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, as float64."""
    out = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], DIMS_EXACT):
        out += a[:, d : d + DIMS_EXACT].astype(np.float32) @ b[:, d : d + DIMS_EXACT].astype(np.float32).T
    return out


def possible(a: tuple, b: tuple, threshold: float) -> np.ndarray:
    """Matrix of the pairs of two quantised blocks whose cosine may reach ``threshold``."""
    (qa, sa, ea, ma), (qb, sb, eb, mb) = a, b
    high = code_products(qa, qb) * sa[:, None] * sb[None, :]
    high += ea[:, None] * mb[None, :] + eb[None, :]
    return high >= threshold - 1e-9


def linked_pairs(a: np.ndarray, b: np.ndarray | None, threshold: float, qa: tuple = (), qb: tuple = ()) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows with cosine >= threshold; ``b`` None: pairs i < j of ``a``. ``qa, qb``: as ``quantise`` gives them."""
    same = b is None
    na = np.sqrt((a * a).sum(1))
    nb = na if same else np.sqrt((b * b).sum(1))
    qa = qa or quantise(a / na[:, None])
    qb = qa if same else qb or quantise(b / nb[:, None])
    b = a if same else b
    maybe = possible(qa, qb, threshold)
    if same:
        maybe = np.triu(maybe, 1)
    i, j = np.nonzero(maybe)
    found = []
    for at in range(0, len(i), 65536):
        x, y = i[at : at + 65536], j[at : at + 65536]
        cos = np.einsum("ij,ij->i", a[x], b[y]) / (na[x] * nb[y])
        found.append(cos >= threshold)
    ok = np.concatenate(found) if found else np.empty(0, bool)
    return i[ok], j[ok]


def _prepare(rows: DataFrame, label: str, column: str) -> DataFrame:
    """``vec_id, label, proj, k1, k2, vec`` of the rows that can link; vec holds doubles."""

    def run(batches):
        directions: dict[int, np.ndarray] = {}
        for b in batches:
            out = []
            for i, x in enumerate(b.column(2)):
                if not x.is_valid or x.values.null_count or not len(x.values):
                    continue
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(v).max()
                if not np.isfinite(v).all() or top == 0:
                    continue
                # A power of two leaves cosines as they are and keeps squares finite.
                v = v * 2.0 ** -np.frexp(top)[1] + 0.0
                if len(v) not in directions:
                    d = np.random.default_rng(7).standard_normal(len(v))
                    directions[len(v)] = d / np.sqrt(d @ d)
                bits = mix64(v.view(np.uint64) + np.arange(1, len(v) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                k1 = int(bits.sum(dtype=np.uint64))
                k2 = int(mix64(bits ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64))
                out.append((i, float(v @ directions[len(v)] / np.sqrt(v @ v)), k1, k2, len(v), v.tobytes()))
            take = pa.array([x[0] for x in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(take), b.column(1).take(take), pa.array([x[4] for x in out], pa.int32()),
                    pa.array([x[1] for x in out], pa.float64()),
                    pa.array(np.array([x[2] for x in out], np.uint64).view(np.int64)),
                    pa.array(np.array([x[3] for x in out], np.uint64).view(np.int64)),
                    pa.array([x[5] for x in out], pa.binary()),
                ],
                names=["vec_id", "label", "dims", "proj", "k1", "k2", "vec"],
            )

    return rows.where(F.col(label).isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(column).alias("vec")
    ).mapInArrow(run, "vec_id long, label string, dims int, proj double, k1 long, k2 long, vec binary")


def _blocks(classes: DataFrame) -> DataFrame:
    """Blocks of up to ``BLOCK`` vectors of one label and dimension, in order of projection."""

    def pack(batches):
        part, made, key, rows = TaskContext.get().partitionId(), 0, None, []

        def block():
            nonlocal made
            made += 1
            vecs = b"".join(r["vec"] for r in rows)
            v = np.frombuffer(vecs, np.float64).reshape(len(rows), -1)
            codes, *bounds = quantise(v / np.sqrt((v * v).sum(1))[:, None])
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "label": key[0], "dims": key[1], "block": (part << 32) + made,
                        "lo": rows[0]["proj"], "hi": rows[-1]["proj"],
                        "ids": np.array([r["rep"] for r in rows], "<i8").tobytes(),
                        "copies": np.array([r["copies"] for r in rows], "<i8").tobytes(),
                        "vecs": vecs, "codes": codes.tobytes(), "bounds": np.array(bounds).tobytes(),
                    }
                ],
                schema=schema,
            )

        schema = pa.schema(
            [("label", pa.string()), ("dims", pa.int32()), ("block", pa.int64()), ("lo", pa.float64()), ("hi", pa.float64()),
             ("ids", pa.binary()), ("copies", pa.binary()), ("vecs", pa.binary()), ("codes", pa.binary()), ("bounds", pa.binary())]
        )
        for b in batches:
            for r in b.to_pylist():
                if rows and (key != (r["label"], r["dims"]) or len(rows) >= BLOCK):
                    yield block()
                    rows = []
                key = (r["label"], r["dims"])
                rows.append(r)
        if rows:
            yield block()

    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "dims", "proj", "rep"]
    dealt = classes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return dealt.select("rep", "label", "dims", "proj", "copies", "vec").mapInArrow(
        pack, "label string, dims int, block long, lo double, hi double, ids binary, copies binary, vecs binary, codes binary, bounds binary"
    )


def _tiles(blocks: DataFrame, threshold: float) -> DataFrame:
    """``id, other, n``: links of a vector in a tile (n > 0), and star edges (other not null)."""

    def load(r, end=""):
        ids = np.frombuffer(r["ids" + end], "<i8")
        return ids, np.frombuffer(r["copies" + end], "<i8"), np.frombuffer(r["vecs" + end], np.float64).reshape(len(ids), -1)

    def quantised(codes, bounds):
        bounds = np.frombuffer(bounds, np.float64).reshape(3, -1)
        return np.frombuffer(codes, np.int8).reshape(bounds.shape[1], -1), *bounds

    def result(ids, copies, i, j):
        n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        some = np.flatnonzero(n)
        a, r = spanning_edges(i, j, ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([ids[some], a])),
                pa.array(np.concatenate([ids[some], r]), mask=np.arange(len(some) + len(a)) < len(some)),
                pa.array(np.concatenate([n[some].astype(np.int64), np.zeros(len(a), np.int64)])),
            ],
            names=["id", "other", "n"],
        )

    def own(batches):
        for b in trimmed(batches):
            for r in b.to_pylist():
                ids, copies, v = load(r)
                yield result(ids, copies, *linked_pairs(v, None, threshold, quantised(r["codes"], r["bounds"])))

    def meet(batches):
        for b in trimmed(batches):
            rows = b.to_pylist()
            near = [possible(quantised(r["codes"], r["bounds"]), quantised(r["codes_b"], r["bounds_b"]), threshold).any() for r in rows]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["p", "q"]).filter(pa.array(near, pa.bool_()))

    def cross(batches):
        for b in trimmed(batches):
            for r in b.to_pylist():
                ia, ca, va = load(r)
                ib, cb, vb = load(r, "_b")
                i, j = linked_pairs(va, vb, threshold, quantised(r["codes"], r["bounds"]), quantised(r["codes_b"], r["bounds_b"]))
                yield result(np.concatenate([ia, ib]), np.concatenate([ca, cb]), i, j + len(ia))

    def side(name, end, columns):
        return blocks.select(F.col("block").alias(name), *[F.col(c).alias(c + end) for c in columns])

    kind = "id long, other long, n long"
    inner = blocks.select("ids", "copies", "vecs", "codes", "bounds").mapInArrow(own, kind)
    # A label of many blocks is dealt to a task for each SHARE of them: one side by a hash, the other to every task.
    key = ["label", "dims"]
    shares = blocks.groupBy(*key).agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    light = blocks.select(*key, "block", "lo", "hi").join(shares, key)
    left = light.select(
        *key, F.pmod(F.xxhash64("block"), F.col("shares")).cast("int").alias("share"),
        F.col("block").alias("p"), F.col("lo").alias("lo_p"), F.col("hi").alias("hi_p"),
    )
    right = light.select(
        *key, F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
        F.col("block").alias("q"), F.col("lo").alias("lo_q"), F.col("hi").alias("hi_q"),
    )
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9)
    pairs = left.join(right, [*key, "share"]).where(
        (F.col("p") < F.col("q")) & (F.col("lo_q") <= F.col("hi_p") + reach) & (F.col("lo_p") <= F.col("hi_q") + reach)
    ).select("p", "q")
    codes = pairs.join(side("p", "", ["codes", "bounds"]), "p").join(side("q", "_b", ["codes", "bounds"]), "q")
    near = stored(codes.select("p", "q", "codes", "bounds", "codes_b", "bounds_b").mapInArrow(meet, "p long, q long"))
    every = ["ids", "copies", "vecs", "codes", "bounds"]
    outer = near.join(side("p", "", every), "p").join(side("q", "_b", every), "q").drop("p", "q").mapInArrow(cross, kind)
    return inner.unionAll(outer)


def near_duplicates(rows: DataFrame, threshold: float = 0.98, label: str = "label", column: str = "embedding") -> DataFrame:
    """Links of each vector: ``vec_id, n_links, component_id, kept``.

    ``rows`` has ``vec_id``, the label and the vector column (array of float or
    double); other columns are ignored. Two vectors link when their labels are
    equal and not null, their dimensions are equal and their cosine in double
    precision is at least ``threshold``. Vectors that are null, empty, all zero
    or hold a null or non-finite component link with nothing.

    There is one row for each input row: ``n_links`` counts the other rows
    linked directly (repeated rows are other rows), ``component_id`` is the
    smallest vec_id reachable, itself included, and ``kept`` tells whether that
    is its own. A null vec_id has the component of its links or null. An empty
    table gives an empty result.
    """
    small_batches(rows.sparkSession)
    ready = stored(_prepare(rows, label, column))
    key = ["label", "dims", "k1", "k2"]
    # proj and vec are the same for all rows of a class.
    classes = stored(
        ready.groupBy(*key).agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min("proj").alias("proj"), F.first("vec").alias("vec")
        )
    )
    tiles = stored(_tiles(stored(_blocks(classes)), threshold))
    links = tiles.where("other is null").groupBy("id").agg(F.sum("n").alias("far"))
    comp = components(tiles.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    of_class = (
        classes.select(*key, "rep", "copies")
        .join(links, F.col("rep") == links.id, "left").join(comp, F.col("rep") == comp.node, "left")
        .select(
            *key, (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    found = ready.select("vec_id", *key).join(of_class, key).select("vec_id", "n_links", "component_id")
    ids = rows.select(F.col("vec_id").cast("long").alias("vec_id"))
    per_id = found.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = ids.join(per_id.withColumnRenamed("vec_id", "v"), F.col("vec_id").eqNullSafe(F.col("v")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
