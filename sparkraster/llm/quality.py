"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of a whole text are computed in tasks. The trees are grown with
numpy on the driver from at most about ``train_rows`` labelled documents (a row
of statistics each), flattened into arrays, and every document goes down all
trees at once by indexing.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from sparkraster.llm.shared import labelled, texts_of, train_remainder, trimmed, with_text

FEATURES = (
    "log_bytes log_words lower upper digit space newline comma_stop other_punct symbol high control "
    "word_mean word_max word_std short_words long_words upper_words distinct_words distinct_3grams top_word "
    "line_mean distinct_lines repeated_line_bytes lines_ended entropy symbol_words exclaimed digit_words runs"
).split()

TRAIN_ROWS = 20_000


def _byte_classes() -> np.ndarray:
    """Class of each byte: lower, upper, digit, space, newline, comma or stop, punctuation, symbol, high, control."""
    t = np.full(256, 9, np.uint8)
    for chars, c in ((range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), (b" \t", 3), (b"\n\r", 4),
                     (b".,", 5), (b"!?;:'\"()-", 6), (b"#$%&*@+=<>[]{}|\\/^_`~", 7), (range(128, 256), 8)):
        for x in chars:
            t[x] = c
    return t


BYTE_CLASS = _byte_classes()


def statistics(text: str | None) -> np.ndarray:
    """The feature row of a text; null counts as empty."""
    raw = (text or "").encode()
    out = np.zeros(len(FEATURES))
    if not raw:
        return out
    b = np.frombuffer(raw, np.uint8)
    hist = np.bincount(b, minlength=256)
    by_class = np.bincount(BYTE_CLASS, hist, 10)
    n = len(b)
    words = raw.split()
    out[0], out[1] = np.log1p(n), np.log1p(len(words))
    out[2:12] = by_class / n
    if words:
        m = len(words)
        lens = np.fromiter(map(len, words), np.float64, m)
        out[12:15] = lens.mean(), np.log1p(lens.max()), lens.std()
        out[15], out[16] = (lens <= 2).mean(), (lens >= 12).mean()
        out[17] = sum(map(bytes.isupper, words)) / m
        kinds = Counter(words)
        out[18] = len(kinds) / m
        out[19] = len(set(zip(words, words[1:], words[2:]))) / max(1, m - 2)
        out[20] = max(kinds.values()) / m
    lines = [x for x in raw.split(b"\n") if x]
    if lines:
        kinds = set(lines)
        out[21], out[22] = np.log1p(len(raw) / len(lines)), len(kinds) / len(lines)
        out[23] = 1 - sum(map(len, kinds)) / sum(map(len, lines))
        out[24] = sum(x[-1] in b".!?\"'" for x in lines) / len(lines)
    p = hist[hist > 0] / n
    out[25] = -(p * np.log2(p)).sum()
    out[26] = by_class[7] / max(1, len(words))
    out[27] = hist[33] / max(1, len(words))
    out[28] = by_class[2] / max(1, len(words))
    out[29] = (b[1:] == b[:-1]).mean() if n > 1 else 0.0
    return out


@dataclass
class Trees:
    """Trees in flat arrays: node i splits ``feature[i]`` at bin ``cut[i]``; children at ``child[i]``, ``child[i] + 1``.

    A leaf is its own child with a cut that no bin exceeds. ``roots`` has the
    first node of each tree.
    """

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(self.edges)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        if not len(x):
            return np.empty(0)
        b = self.bins(x)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = self.child[at] + (b[rows, self.feature[at]] > self.cut[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(1))))


def grow(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 5, bins: int = 64, rate: float = 0.15,
    least: int = 12, ridge: float = 1.0,
) -> Trees:
    """Boosted trees for the logistic loss. Without rows, or with one label, the base rate alone.

    Of equally good splits the one of the first feature and there the lowest cut counts.
    """
    width = x.shape[1] if x.ndim == 2 else len(FEATURES)
    n = len(x)
    mean = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(mean / (1 - mean)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.empty(0) for f in range(width)]
    feature, cut, child, value, roots = [], [], [], [], []
    model = lambda: Trees(edges, *(np.array(v, np.int64) for v in (feature, cut, child)), np.array(value), np.array(roots, np.int64), depth, base)
    if n == 0 or y.min() == y.max():
        return model()
    b = model().bins(x)
    offset = b + np.arange(width) * bins
    f_x = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f_x))
        g, h = p - y, p * (1 - p)

        def leaf(rows_g, rows_h):
            feature.append(0)
            cut.append(bins)
            child.append(len(child))
            value.append(-rate * rows_g / (rows_h + ridge))
            return len(child) - 1

        roots.append(leaf(g.sum(), h.sum()))
        node = np.zeros(n, np.int64)
        ids = [roots[-1]]
        for _ in range(depth):
            k = len(ids)
            live = node >= 0
            key = (node[live, None] * (width * bins) + offset[live]).ravel()
            size = k * width * bins
            hist = [np.bincount(key, np.repeat(v[live], width), size).reshape(k, width, bins) for v in (g, h)]
            count = np.bincount(key, minlength=size).reshape(k, width, bins)
            gl, hl, cl = (v.cumsum(2)[:, :, :-1] for v in (*hist, count))
            gt, ht, ct = (v[:, 0, :].sum(1)[:, None, None] for v in (*hist, count))
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(cl < least) | (ct - cl < least)] = -1
            best = gain.reshape(k, -1).argmax(1)
            nxt, moved = [], np.full(n, -1)
            for j in range(k):
                f, c = divmod(int(best[j]), bins - 1)
                if gain[j, f, c] <= 1e-6:
                    continue
                i = ids[j]
                left = leaf(gl[j, f, c], hl[j, f, c])
                leaf(gt[j, 0, 0] - gl[j, f, c], ht[j, 0, 0] - hl[j, f, c])
                feature[i], cut[i], child[i] = f, c, left
                mine = node == j
                moved[mine] = len(nxt) + (b[mine, f] > c)
                nxt += [left, left + 1]
            node, ids = moved, nxt
            if not ids:
                break
        tree = Trees(edges, *(np.array(v, np.int64) for v in (feature, cut, child)), np.array(value), np.array(roots[-1:], np.int64), depth, 0.0)
        at = np.full(n, roots[-1])
        for _ in range(depth):
            at = tree.child[at] + (b[np.arange(n), tree.feature[at]] > tree.cut[at])
        f_x += tree.value[at]
    return model()


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", train_rows: int = TRAIN_ROWS) -> Trees:
    """Trees for ``labels.target`` from documents whose crc32(doc_id) mod 4 is not 2."""

    def rows(batches):
        for b in trimmed(batches):
            x = [statistics(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in x], pa.binary()), b.column(1)], names=["x", "y"])

    got = labelled(docs, labels, target, 4, 2, train_rows).mapInArrow(rows, "x binary, y double").toArrow()
    x = np.array([np.frombuffer(v.as_buffer()) for v in got.column("x")]).reshape(-1, len(FEATURES))
    y = got.column("y").to_numpy()
    order = np.lexsort(np.column_stack([x, y]).T) if len(x) else np.arange(0)  # the same trees whatever the partitions
    return grow(x[order], (y[order] > 0).astype(float))


def score(docs: DataFrame, model: Trees, threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default ``doc_id``) with ``score`` and ``predicted``, one row for each input row.

    Null and empty texts have the score of a text without a byte. Texts are
    read whole. An empty table gives an empty result.
    """
    wanted = with_text(docs, keep)

    def run(batches):
        for b in trimmed(batches):
            texts, p = texts_of(b), [np.empty(0)]
            for at in range(0, b.num_rows, 512):
                p.append(model.score(np.array([statistics(t.as_py()) for t in texts.slice(at, 512)])))
            p = np.concatenate(p)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["row", "score", "predicted"]
            )

    out = StructType([*wanted.select("row").schema.fields]).add("score", DoubleType()).add("predicted", IntegerType())
    return wanted.mapInArrow(run, out)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; see ``fit`` and ``score``."""
    s = score(docs, fit(docs, labels), threshold)
    return s.select(
        F.col("row.doc_id").alias("doc_id"), (train_remainder(F.col("row.doc_id"), 4) == 2).alias("held_out"), "score", "predicted"
    )
