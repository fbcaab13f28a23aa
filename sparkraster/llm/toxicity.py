"""Toxicity by maximum-scoring segments of token log-odds.

A token of a text is a word; what is learned of it are the word itself and its
beginnings and endings of ``PIECES`` characters, so that stems and endings count
that no single word shows. Occurrences in toxic and in other training documents
are counted, log-odds have an informative Dirichlet prior, the rate in all
training documents, so rare pieces stay near 0 (Monroe, Colaresi and Quinn,
2008). A word scores the log-odds of its most significant piece; a word without
a significant piece scores what is left for such words, a small loss, the drift
(``least_drift`` at least). So the expected score of clean text is negative. A
linear scan with back links finds all maximal scoring segments (Ruzzo and Tompa,
1999). The largest score of clean text follows an extreme-value law with K and
lambda (Karlin and Altschul, 1990), fitted on clean training documents, which
gives each segment its expected count by chance; the segments below
``significant`` are the toxic passages. A document's score is a logistic
calibration of its extreme-value statistics and of the mean log-odds of all its
words, which tells documents without any segment apart.

The log-odds that calibrate a training document come from the other half of the
training documents, so a document does not vouch for itself.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

from sparkraster.llm.shared import Memory, labelled, stored, texts_of, train_remainder, trimmed, with_text

TRAIN_ROWS = 40_000
#: Characters of the beginnings and endings of words.
PIECES = (4, 5, 6, 7)
#: Log-odds with a smaller z value count 0 in segments.
SIGNIFICANT_Z = 5.0
#: Log-odds with a smaller z value are not kept at all; the mean of a document takes the others.
KEPT_Z = 2.0
PRIOR = 20.0
LEAST_DRIFT = 0.02


def _letters() -> bytes:
    """Lower-cases A-Z and blanks all other ASCII but letters and digits."""
    t = bytearray(range(256))
    for x in range(128):
        t[x] = ord(chr(x).lower()) if chr(x).isalnum() else 32
    return bytes(t)


LETTERS = _letters()


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(LETTERS).split()


def pieces(word: str) -> list[str]:
    """The word between marks, and its longer beginnings and endings with theirs."""
    w = f"^{word}$"
    return [w, *(w[: n + 1] for n in PIECES if n < len(word)), *(w[-n - 1 :] for n in PIECES if n < len(word))]


def piece_columns(word: Column) -> Column:
    """``pieces`` as an array column."""
    w = F.concat(F.lit("^"), word, F.lit("$"))
    n = F.length(word)
    ends = [F.when(n > k, F.substring(w, 1, k + 1)) for k in PIECES] + [F.when(n > k, F.right(w, F.lit(k + 1))) for k in PIECES]
    return F.array_compact(F.array(w, *ends))


def log_odds(t, c, nt: float, nc: float, strength: float = PRIOR):
    """(log-odds, z) of a piece with t of nt toxic and c of nc other words; columns or numbers.

    z compares t with its binomial expectation among the t + c occurrences; the
    half added to the variance holds back pieces of very few.
    """
    log, root = (F.log, F.sqrt) if isinstance(t, Column) else (np.log, np.sqrt)
    n = nt + nc
    rate = (t + c + 0.5) / (n + 1.0)
    at, ac = t + rate * strength, c + rate * strength
    delta = log(at / (nt + strength - at)) - log(ac / (nc + strength - ac))
    return delta, (t - (t + c) * (nt / n)) / root((t + c) * (nt * nc / n**2) + 0.5)


def maximal_segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of the scores ``s``, in order (Ruzzo and Tompa).

    Each segment of the list links back to the last one before it with a smaller
    sum on its left, so no search passes a segment twice and the scan is linear.
    """
    positive = np.flatnonzero(s > 0)
    if not len(positive):
        return []
    total = np.concatenate([[0.0], np.cumsum(s)])
    before, after = total[positive].tolist(), total[positive + 1].tolist()
    starts, ends, lefts, rights, links = [], [], [], [], []
    for i, left, right in zip(positive.tolist(), before, after):
        start, end = i, i + 1
        j = len(starts) - 1
        while True:
            while j >= 0 and lefts[j] >= left:
                j = links[j]
            if j < 0 or rights[j] >= right:
                break
            start, left = starts[j], lefts[j]
            k = links[j]
            del starts[j:], ends[j:], lefts[j:], rights[j:], links[j:]
            j = k
        starts.append(start)
        ends.append(end)
        lefts.append(left)
        rights.append(right)
        links.append(j)
    return [(a, b, r - l) for a, b, l, r in zip(starts, ends, lefts, rights)]


@dataclass
class Model:
    """``known``: (log-odds, z) by piece. ``drift``: what a word without a significant piece costs."""

    known: dict[str, tuple[float, float]]
    drift: float
    lam: float = 1.0
    k: float = 1.0
    weights: np.ndarray | None = None
    significant: float = 0.05

    def word(self, word: bytes) -> tuple[float, float]:
        """(score in segments, log-odds in the mean) of a word, those of its most significant piece."""
        found = [v for v in map(self.known.get, pieces(word.decode("utf-8", "replace"))) if v is not None]
        if not found:
            return -self.drift, 0.0
        delta, z = max(found, key=lambda v: abs(v[1]))
        return (delta if z >= SIGNIFICANT_Z else min(delta, -self.drift) if z <= -SIGNIFICANT_Z else -self.drift), delta

    def scores(self, words: list[bytes], of) -> np.ndarray:
        """Two columns: the scores of ``word`` for each of ``words``; ``of`` remembers them."""
        return np.array(list(map(of, words))).reshape(-1, 2)

    def memory(self):
        return Memory(self.word, 24 << 20).__getitem__

    def segments(self, s: np.ndarray) -> list[tuple[int, int, float, float]]:
        """(start, end, score, expected count by chance) of the maximal segments of the scores ``s``."""
        return [(a, b, v, self.k * len(s) * float(np.exp(-self.lam * v))) for a, b, v in maximal_segments(s)]

    def statistics(self, s: np.ndarray, found: list) -> np.ndarray:
        """1, minus log p of the best segment, number and score of significant segments, mean log-odds of the words.

        ``s`` are the two columns of ``scores``, ``found`` the ``segments`` of the first.
        """
        if not len(s):
            return np.array([1.0, 0.0, 0.0, 0.0, 0.0])
        e = min((x[3] for x in found), default=np.inf)
        logp = -np.log(max(-np.expm1(-e), 1e-12)) if e < 50 else 0.0
        sure = [x for x in found if x[3] < self.significant]
        return np.array([1.0, logp, np.log1p(len(sure)), sum(x[2] for x in sure) / len(s), s[:, 1].mean()])

    def score(self, statistics: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(statistics @ self.weights, -50, 50))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def extreme_value(n: np.ndarray, top: np.ndarray) -> tuple[float, float]:
    """(lambda, K) by moments: the largest score ``top`` over ``n`` words has mean (ln K n + gamma) / lambda."""
    lam = float(np.clip(np.pi / np.sqrt(6) / max(np.std(top), 0.2), 0.1, 3.0)) if len(n) else 1.0
    k = float(np.exp(np.clip(lam * top.mean() - np.euler_gamma - np.log(n).mean(), -30, 10))) if len(n) else 1.0
    return lam, k


def _learn(known: DataFrame) -> list[Model]:
    """Log-odds from all of ``known(words, y, half)``, from its half 0 and from its half 1.

    Words are counted once for each document and its square root of the number
    of times, so a line repeated in one document weighs little. The pieces
    significant in none of the three stay on the cluster; what comes to the
    driver is bounded by the words of the training rows.
    """
    cells = [F.when((F.col("y") > 0) == hit, F.col("n")).otherwise(0.0) for hit in (True, False)]
    names = [f"{k}{h}" for h in (0, 1) for k in "tc"]
    sums = [F.sum(F.when(F.col("half") == h, x).otherwise(0.0)).alias(f"{k}{h}") for h in (0, 1) for k, x in zip("tc", cells)]
    words = stored(known.select(F.inline("words"), "y", "half").groupBy("word").agg(*sums))
    per = words.select(F.explode(piece_columns(F.col("word"))).alias("piece"), *names)
    per = per.groupBy("piece").agg(*[F.sum(x).alias(x) for x in names])
    all_of = words.agg(*[F.sum(x).alias(x) for x in names]).first().asDict()
    all_of = {k: v or 0.0 for k, v in all_of.items()}
    models, wanted = [], []
    for i, halves in enumerate(((0, 1), (0,), (1,))):
        nt, nc = (sum(all_of[f"{k}{h}"] for h in halves) for k in "tc")
        t, c = (functools.reduce(lambda a, b: a + b, [F.col(f"{k}{h}") for h in halves]) for k in "tc")
        models.append((nt, nc))
        delta, z = log_odds(t, c, nt, nc) if nt + nc else (F.lit(0.0), F.lit(0.0))
        wanted.append(F.when(F.lit(nt > 0 and nc > 0) & (t + c > 0) & (F.abs(z) >= KEPT_Z), F.struct(delta.alias("d"), z.alias("z"), t.alias("t"), c.alias("c"))).alias(f"m{i}"))
    kept = per.select("piece", *wanted).where("m0 is not null or m1 is not null or m2 is not null").toArrow().to_pylist()
    kept.sort(key=lambda r: r["piece"])
    found = []
    for i, (nt, nc) in enumerate(models):
        mine = [(r["piece"], r[f"m{i}"]) for r in kept if r[f"m{i}"] is not None]
        scores = {p: (float(np.clip(m["d"], -4.0, 8.0)), m["z"]) for p, m in mine}
        # Whole words that are significant take their share of toxic words from the rest.
        sure = [m for p, m in mine if m["z"] >= SIGNIFICANT_Z and p[0] == "^" and p[-1] == "$"]
        rest = [max(1e-3, 1 - sum(m[k] for m in sure) / max(n, 1e-9)) for k, n in (("t", nt), ("c", nc))]
        found.append(Model(scores, max(LEAST_DRIFT, float(np.log(rest[1] / rest[0])))))
    return found


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", train_rows: int = TRAIN_ROWS) -> Model:
    """A model of ``labels.target`` from at most about ``train_rows`` labelled documents outside remainder 0 of 5."""
    known = labelled(docs, labels, target, 5, 0, train_rows).select("text", "y", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half"))

    def words_of(batches):
        word = pa.struct([("word", pa.string()), ("n", pa.float64())])
        for b in trimmed(batches):
            out, order = [], []
            for t in b.column(0):
                every = tokens(t.as_py())
                count: dict[bytes, int] = {}
                for w in every:
                    count[w] = count.get(w, 0) + 1
                out.append([{"word": w.decode("utf-8", "replace"), "n": float(np.sqrt(n))} for w, n in count.items()])
                order.append(b" ".join(every))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.list_(word)), pa.array(order, pa.binary()), b.column(1), b.column(2)], names=["words", "line", "y", "half"]
            )

    known = stored(known.mapInArrow(words_of, "words array<struct<word:string,n:double>>, line binary, y double, half int"))
    model, *halves = _learn(known)
    totals = known.agg(F.count(F.when(F.col("y") > 0, 1)).alias("t"), F.count(F.when(~(F.col("y") > 0), 1)).alias("c")).first()
    if not model.known or not totals["t"] or not totals["c"]:
        base = np.log((totals["t"] + 0.5) / (totals["c"] + 0.5)) if totals["t"] or totals["c"] else 0.0
        return Model({}, LEAST_DRIFT, weights=np.array([base, 0.0, 0.0, 0.0, 0.0]))
    shared = docs.sparkSession.sparkContext.broadcast(halves)

    def scanned(batches):
        of = [m.memory() for m in shared.value]
        for b in trimmed(batches):
            rows = []
            for line, half in zip(b.column(0), b.column(2).to_pylist()):
                other = 1 - half
                s = shared.value[other].scores(line.as_py().split(), of[other])
                found = maximal_segments(s[:, 0])
                v = np.array([x[2] for x in found])
                rows.append((len(s), max(v, default=0.0), v.tobytes(), float(s[:, 1].mean()) if len(s) else 0.0))
            cols = list(zip(*rows)) or [()] * 4
            kinds = [pa.int64(), pa.float64(), pa.binary(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(cols, kinds)), b.column(1)], names=["n", "top", "found", "mean", "y"]
            )

    seen = known.select("line", "y", "half").mapInArrow(scanned, "n long, top double, found binary, mean double, y double").toArrow()
    n, top, mean = (seen.column(c).to_numpy() for c in ("n", "top", "mean"))
    y = (seen.column("y").to_numpy() > 0).astype(float)
    clean = (y == 0) & (n > 0)
    model.lam, model.k = extreme_value(n[clean], top[clean])
    x = np.zeros((len(n), 5))
    for i, v in enumerate(seen.column("found")):
        s = np.zeros((n[i], 2))
        s[:, 1] = mean[i]
        found = [(0, 0, float(g), model.k * n[i] * float(np.exp(-model.lam * g))) for g in np.frombuffer(v.as_buffer())]
        x[i] = model.statistics(s, found)
    order = np.lexsort(np.column_stack([x, y]).T)  # the same weights whatever the partitions
    model.weights = _logistic(x[order], y[order])
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default ``doc_id``) as ``row``, with ``score, predicted, passages``.

    ``passages`` are the significant segments: first and last token, score and
    expected count by chance.
    """
    wanted = with_text(docs, keep)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())])

    def run(batches):
        m = shared.value
        of = m.memory()
        for b in trimmed(batches):
            p, passages = [], []
            for t in texts_of(b):
                s = m.scores(tokens(t.as_py()), of)
                found = m.segments(s[:, 0])
                p.append(m.score(m.statistics(s, found)))
                passages.append([{"first": x, "last": y - 1, "score": v, "expected": e} for x, y, v, e in found if e < m.significant])
            hit = pa.array((np.array(p) >= threshold).astype(np.int32), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p, pa.float64()), hit, pa.array(passages, pa.list_(passage))],
                names=["row", "score", "predicted", "passages"],
            )

    kind = StructType().add("first", IntegerType()).add("last", IntegerType()).add("score", DoubleType()).add("expected", DoubleType())
    out = StructType([*wanted.select("row").schema.fields])
    return wanted.mapInArrow(run, out.add("score", DoubleType()).add("predicted", IntegerType()).add("passages", ArrayType(kind)))


def detect(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages`` of every document.

    Null and empty texts have the score of a text without a token. Texts are
    read whole; repeated rows have a result each; an empty table gives none.
    Null labels and labels of unknown ids are ignored; without a label of each
    kind every document has the base rate as its score.
    """
    s = score(docs, fit(docs, labels), threshold)
    return s.select(
        F.col("row.doc_id").alias("doc_id"), (train_remainder(F.col("row.doc_id"), 5) == 0).alias("held_out"),
        "score", "predicted", F.size("passages").alias("n_passages"),
    )
