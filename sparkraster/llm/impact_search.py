"""Exact top-k inner products from an impact-ordered index, a score at a time.

Components x become integers floor(scale * x). Rows are dealt by a hash into
blocks of about ``BLOCK`` rows, each with its own index: for each dimension the
rows in order of their value there. All rows of one value are a posting segment,
whose impact on a query is the product of the query's component and that value.

A query meets a block in rounds of descending impact. Impacts are quantised
against the largest one, and a round takes all segments from one level down to
the next, of every dimension a contiguous piece. After a round the score of a row
is at most what it has gathered, plus the smaller of two bounds on the rest: so
many dimensions are open, each below the level; and, by the Cauchy-Schwarz
inequality, the product of the norms of what is open on both sides. Rows that
cannot reach the k-th best exact score known so far are out by proof. When it
takes less to score all possible members exactly than to read half of what is
open, or nothing is open, that ends the rounds.

The k-th best score starts from the queries of one block among each other and
rises with the rows scored exactly; a task carries it from block to block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkraster.llm.shared import small_batches, stored, trimmed

#: Rows of an index block and queries of a query block, on average; a place in a block takes 16 bits.
BLOCK = 4096
QUERIES = 256
#: Tiles (query block, index block) that one task takes at most, about.
TILES = 64
#: Levels of quantised impact (of 255) at which a round ends; the last round takes what is left.
LEVELS = (96, 32, 0)
#: Leading rows that are scored exactly after a round, a multiple of k, to raise the k-th best.
LEAD = 16
#: Sums of products below it are exact in double precision.
EXACT = 1 << 53
LONG = (-(1 << 63), (1 << 63) - 1)


def codes_of(x: np.ndarray, scale: int = 256) -> np.ndarray:
    """floor(scale * x) as int64, or as Python integers where a value leaves 32 bits."""
    with np.errstate(over="ignore"):
        y = np.floor(x * float(scale))
    if not y.size or np.abs(y).max() < 1 << 31:
        return y.astype(np.int64)
    whole = np.frompyfunc(lambda v, w: int(w) if np.isfinite(w) else int(v) * scale, 2, 1)
    return whole(x, y).astype(object)


class Index:
    """Rows of one block and, by dimension, their places in ascending order of value."""

    def __init__(self, x: np.ndarray, uids: np.ndarray, ids: np.ndarray, named: np.ndarray, order: np.ndarray, scale: int = 256):
        self.codes, self.uids, self.ids, self.named = codes_of(x, scale), uids, ids, named
        self.places = order.astype(np.int64).ravel()
        n, dims = self.codes.shape
        self.n, self.dims = n, dims
        self.small = self.codes.dtype != object and n > 0 and dims > 0
        if self.small:
            self.low, self.high = int(self.codes.min()), int(self.codes.max())
            self.span = self.high - self.low + 2
            dim = np.repeat(np.arange(dims), n)
            values = self.codes[self.places, dim]
            self.keys = dim * self.span + (values - self.low)
            self.values = values.astype(np.float64)
            self.squares = (self.codes.astype(np.float64) ** 2).sum(1)
            self.top = max(abs(self.low), abs(self.high))

    @staticmethod
    def order_of(codes: np.ndarray) -> np.ndarray:
        """Places of the rows in order of value, a row for each dimension."""
        return np.argsort(codes, axis=0, kind="stable").T.astype(np.uint16)

    def exact(self, q: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self.codes[places] @ q


class Best:
    """The k best (score, id) of a query so far, ties to the smaller id and rows without id last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def add(self, scores, ids, named) -> None:
        if len(scores):
            rows = self.rows + [(min(max(int(s), LONG[0]), LONG[1]), bool(m), int(i)) for s, i, m in zip(scores, ids, named)]
            self.rows = sorted(rows, key=lambda r: (-r[0], not r[1], r[2]))[: self.k]

    @property
    def least(self):
        """The k-th best score, or None while fewer are known."""
        return self.rows[-1][0] if len(self.rows) == self.k else None


def possible_members(index: Index, q: np.ndarray, own: int, k: int, least) -> tuple[np.ndarray, int]:
    """Places of all rows that may belong to the k best of ``q`` with a score of ``least`` or more, and how many postings that took.

    ``own`` is the place of the query itself, which is left out, or -1.
    """
    n, dims = index.n, index.dims
    every = np.ones(n, bool)
    if own >= 0:
        every[own] = False
    if not index.small or q.dtype == object or float(np.abs(q).max()) * index.top * dims >= EXACT:
        return np.flatnonzero(every), 0
    largest = int(max((q * index.low).max(), (q * index.high).max()))
    gathered, met = np.zeros(n), np.zeros(n)
    left_q, left_x = np.full(n, float((q * q).sum())), index.squares.copy()
    live = q != 0
    left_x -= (index.codes[:, ~live].astype(np.float64) ** 2).sum(1)
    dim, qs = np.flatnonzero(live), q[live]
    first, last = dim * n, dim * n + n
    spent = 0
    for level in (*LEVELS, None):
        floor = None if level is None else max(-(-largest * level // 255), 0)
        if floor is None:
            low, high = first.copy(), last.copy()
        else:
            # Values whose product with the component reaches the level.
            edge = np.clip(np.where(qs > 0, -(-floor // qs), floor // qs), index.low - 1, index.high + 1)
            up = np.searchsorted(index.keys, dim * index.span + (edge - index.low), "left")
            down = np.searchsorted(index.keys, dim * index.span + (edge - index.low), "right")
            low, high = np.where(qs > 0, np.clip(up, first, last), first), np.where(qs > 0, last, np.clip(down, first, last))
        # Positive components take their segments from the top down, negative ones from the bottom up.
        size = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
        some, values, own_q = index.places[at], index.values[at], np.repeat(qs.astype(np.float64), size)
        gathered += np.bincount(some, values * own_q, n)
        first, last = np.where(qs > 0, first, high), np.where(qs > 0, low, last)
        spent += len(at)
        if floor is None:
            bound = gathered
        else:
            met += np.bincount(some, minlength=n)
            rest = (len(dim) - met) * (floor - 1)
            if floor:
                left_q -= np.bincount(some, own_q * own_q, n)
                left_x -= np.bincount(some, values * values, n)
                rest = np.minimum(rest, np.sqrt(np.maximum(left_q, 0) * np.maximum(left_x, 0)) * (1 + 1e-9) + 1e-6)
            bound = gathered + rest
        if least is None or floor is not None:
            # Exact scores of the rows that lead now can raise the k-th best.
            lead = np.flatnonzero(every)
            if len(lead) > LEAD * k:
                lead = lead[np.argpartition(-gathered[lead], LEAD * k)[: LEAD * k]]
            if len(lead) >= k:
                now = int(np.sort(index.exact(q, lead))[-k])
                least = now if least is None else max(least, now)
        left = every if least is None else every & (bound >= least)
        count = int(left.sum())
        if floor is None or 2 * count * dims <= n * len(dim) - spent:
            return np.flatnonzero(left), spent
    raise AssertionError("the last round returns")


def _ready(rows: DataFrame, column: str) -> DataFrame:
    """``uid, vec_id, dims, vec`` of the rows that take part; vec holds doubles, uid tells rows apart."""

    def run(batches):
        at = TaskContext.get().partitionId() << 40
        for b in trimmed(batches):
            ids, vecs, dims = [], [], []
            for i, x in zip(b.column(0), b.column(1)):
                if not x.is_valid or x.values.null_count:
                    continue
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(v).all():
                    ids.append(i.as_py())
                    vecs.append(v.tobytes())
                    dims.append(len(v))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(at, at + len(ids))), pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())],
                names=["uid", "vec_id", "dims", "vec"],
            )
            at += len(ids)

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("vec")).mapInArrow(
        run, "uid long, vec_id long, dims int, vec binary"
    )


def _dealt(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``rows`` with a block number of their dimensions, by a hash of uid: about ``size`` rows a block."""
    blocks = rows.groupBy("dims").agg(F.ceil(F.count("*") / size).alias("__blocks"))
    number = F.pmod(F.xxhash64("uid"), F.col("__blocks"))
    return rows.join(blocks, "dims").withColumn(name, number).drop("__blocks")


def _packed(rows: DataFrame, size: int, name: str, scale: int, indexed: bool) -> DataFrame:
    """A row for each block: its uids, ids and vectors, and the order of an index block."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        ids = table.column("vec_id")
        x = np.frombuffer(b"".join(table.column("vec").to_pylist()), np.float64).reshape(table.num_rows, -1)
        row = {
            "dims": table.column("dims")[0].as_py(), name: table.column(name)[0].as_py(),
            "uids": table.column("uid").to_numpy().astype("<i8").tobytes(),
            "ids": ids.fill_null(0).to_numpy().astype("<i8").tobytes(), "named": ids.is_valid().to_numpy().tobytes(),
            "vecs": x.tobytes(), "order": Index.order_of(codes_of(x, scale)).tobytes() if indexed else b"",
        }
        return pa.Table.from_pylist([row], schema=schema)

    schema = pa.schema(
        [("dims", pa.int32()), (name, pa.int64()), ("uids", pa.binary()), ("ids", pa.binary()), ("named", pa.binary()), ("vecs", pa.binary()), ("order", pa.binary())]
    )
    kind = f"dims int, {name} long, uids binary, ids binary, named binary, vecs binary, order binary"
    return _dealt(rows, size, name).groupBy("dims", name).applyInArrow(pack, kind)


def search(rows: DataFrame, is_query, k: int = 5, scale: int = 256, column: str = "embedding") -> DataFrame:
    """The ``k`` best rows of every query: ``query_id, rank, vec_id, score``.

    ``rows`` has ``vec_id`` and the vector column (array of float or double);
    other columns are ignored. ``is_query`` is a condition on vec_id; each row
    that meets it is a query, and every other row is its candidate: also one of
    the same vec_id, so a repeated row finds its copies, and has a result of its
    own. The score is the inner product of the vectors floor(scale * x), ties go
    to the smaller vec_id and rows without vec_id come last among them. A query
    with fewer than k candidates has all of them.

    Vectors that are null or hold null or non-finite components take no part.
    Vectors of different dimensions have no inner product and are not
    candidates of each other; those of no dimension all score 0. Scores are
    exact whatever the size of the components; one beyond the range of a long
    counts as its end. An empty table gives no row.
    """
    spark = rows.sparkSession
    small_batches(spark)
    ready = stored(_ready(rows, column))
    blocks = stored(_packed(ready, BLOCK, "block", scale, True), group=16 << 20)
    asked = stored(_packed(ready.where(is_query), QUERIES, "asked", scale, False))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    many = asked.groupBy("dims").agg(F.count("*").alias("n"))
    # A query block meets all index blocks of its dimensions, in shares of at most about TILES.
    shares = blocks.groupBy("dims").agg(F.count("*").alias("m")).join(many, "dims").select(
        "dims", F.greatest(F.ceil(F.col("m") / TILES), F.least("m", F.ceil(F.lit(parts) / F.col("n")))).cast("int").alias("shares")
    )
    left = asked.select("dims", "asked").join(shares, "dims").select("dims", "asked", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    right = blocks.select("dims", "block").join(shares, "dims").select("dims", "block", F.pmod(F.xxhash64("block"), F.col("shares")).cast("int").alias("share"))
    pairs = left.join(right, ["dims", "share"])
    payload = ["uids", "ids", "named", "vecs"]
    tiles = pairs.join(asked.select("dims", "asked", *[F.col(c).alias(f"q_{c}") for c in payload]), ["dims", "asked"]).join(blocks, ["dims", "block"])
    tiles = tiles.repartition(parts, "dims", "asked", "share").select(
        "dims", "asked", "share", "q_uids", "q_ids", "q_vecs", "uids", "ids", "named", "vecs", "order"
    )

    def meet(batches):
        state: dict[tuple, list[Best]] = {}
        least: dict[tuple, list] = {}
        names: dict[tuple, tuple] = {}
        for b in trimmed(batches):
            for r in b.to_pylist():
                key = (r["dims"], r["asked"], r["share"])
                q_uids, q_ids = np.frombuffer(r["q_uids"], "<i8"), np.frombuffer(r["q_ids"], "<i8")
                q = codes_of(np.frombuffer(r["q_vecs"], np.float64).reshape(len(q_uids), -1), scale)
                uids = np.frombuffer(r["uids"], "<i8")
                index = Index(
                    np.frombuffer(r["vecs"], np.float64).reshape(len(uids), -1), uids, np.frombuffer(r["ids"], "<i8"),
                    np.frombuffer(r["named"], bool), np.frombuffer(r["order"], np.uint16).reshape(r["dims"], len(uids)), scale,
                )
                if key not in state:
                    state[key], names[key] = [Best(k) for _ in q_uids], (q_uids, q_ids)
                    least[key] = _start(q, k)
                own = np.minimum(np.searchsorted(uids, q_uids), len(uids) - 1)
                own = np.where(uids[own] == q_uids, own, -1)
                for n, best in enumerate(state[key]):
                    known = [x for x in (best.least, least[key][n]) if x is not None]
                    some, _ = possible_members(index, q[n], int(own[n]), k, max(known) if known else None)
                    best.add(index.exact(q[n], some), index.ids[some], index.named[some])
        for key, found in state.items():
            q_uids, q_ids = names[key]
            out = [(u, i, *row) for u, i, best in zip(q_uids.tolist(), q_ids.tolist(), found) for row in best.rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                    pa.array([x[4] if x[3] else None for x in out], pa.int64()),
                    pa.array([x[2] for x in out], pa.int64()),
                ],
                names=["uid", "query_id", "vec_id", "score"],
            )

    found = tiles.mapInArrow(meet, "uid long, query_id long, vec_id long, score long")
    order = Window.partitionBy("uid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _start(q: np.ndarray, k: int) -> list:
    """The k-th best exact score of each query among the other queries of its block, or None where there are fewer."""
    if len(q) <= k or q.dtype == object or float(np.abs(q).max(initial=0)) ** 2 * q.shape[1] >= EXACT:
        return [None] * len(q)
    scores = q.astype(np.float64) @ q.astype(np.float64).T
    np.fill_diagonal(scores, -np.inf)
    return [int(x) for x in np.partition(scores, len(q) - k, axis=1)[:, len(q) - k]]
