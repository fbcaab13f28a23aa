"""Language identification by nearest centroids of TF-IDF character n-gram vectors.

A text becomes counts of its hashed character 1- to 3-grams, damped by
log(1 + tf), weighted by idf and scaled to length 1. Each language has several
centroids from k-means on the unit sphere, since one language is not one
cluster. A text gets the language of the centroid of the largest cosine; it is
``rejected`` when its distance 1 - cosine is beyond the radius of its language.
Short texts lie far from every centroid, so a radius belongs to a language and a
class of length: ``slack`` times the distance that ``WITHIN`` of the training
texts of the class keep.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from sparkraster.llm.shared import hashed_share, mix64, small_batches, texts_of, train_remainder, trimmed, with_text

DIMS = 2048
TRAIN_ROWS = 6_000
CENTROIDS = 4
#: Length classes: powers of two of the number of n-grams.
CLASSES = 40
WITHIN = 0.995
UNDETERMINED = "und"


def _ascii_classes() -> np.ndarray:
    """Letters stay, every other ASCII character is a blank."""
    t = np.full(128, 32, np.uint32)
    for x in range(97, 123):
        t[x] = x
    return t


ASCII = _ascii_classes()


def counts(text: str) -> np.ndarray:
    """Hashed 1- to 3-gram counts of a lower-cased text with ASCII non-letters as single blanks."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(c < 128, ASCII[np.minimum(c, 127)], c)
    c = np.concatenate([[np.uint32(32)], c, [np.uint32(32)]])
    blank = c == 32
    c = c[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.uint64)
    out = np.bincount((mix64(c) >> np.uint64(40)).astype(np.int64) % DIMS, minlength=DIMS)
    two = c[:-1] * np.uint64(1 << 21) + c[1:]
    out += np.bincount((mix64(two) >> np.uint64(40)).astype(np.int64) % DIMS, minlength=DIMS)
    if len(c) > 2:
        three = two[:-1] * np.uint64(1 << 21) + c[2:]
        out += np.bincount((mix64(three) >> np.uint64(40)).astype(np.int64) % DIMS, minlength=DIMS)
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def length_class(tf: np.ndarray) -> np.ndarray:
    """Class of each count row."""
    return np.minimum(np.log2(1 + tf.sum(1)).astype(np.int64), CLASSES - 1)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    #: By centroid and length class.
    radius: np.ndarray

    def vectors(self, tf: np.ndarray) -> np.ndarray:
        v = np.log1p(tf) * self.idf
        return v / np.maximum(np.sqrt((v * v).sum(1)), 1e-12)[:, None]

    def nearest(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine in 0..1, rejected) of each text."""
        lang, cos, far = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        some = [i for i, t in enumerate(texts) if has_letter(t)]
        if some and len(self.centroids):
            tf = np.array([counts(texts[i]) for i in some])
            c = self.vectors(tf) @ self.centroids.T
            best = c.argmax(1)
            value = c[np.arange(len(some)), best]
            for i, k in zip(some, best):
                lang[i] = self.languages[k]
            cos[some] = np.clip(value, 0, 1)
            far[some] = 1 - value > self.radius[best, length_class(tf)]
        return lang, cos, far


def cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of the unit rows ``v`` by k-means, started from far rows."""
    centres = [v.mean(0)]
    while len(centres) < min(k, len(v)):
        near = np.max([v @ (c / max(np.sqrt(c @ c), 1e-12)) for c in centres], 0)
        centres.append(v[near.argmin()])
    c = np.array(centres)
    for _ in range(rounds):
        c = c / np.maximum(np.sqrt((c * c).sum(1)), 1e-12)[:, None]
        at = (v @ c.T).argmax(1)
        c = np.array([v[at == j].mean(0) if (at == j).any() else c[j] for j in range(len(c))])
    return c / np.maximum(np.sqrt((c * c).sum(1)), 1e-12)[:, None]


def radii(dist: np.ndarray, size: np.ndarray, slack: float) -> np.ndarray:
    """Radius of each length class; a class without a text takes that of the next shorter one, else of the next longer one."""
    found = np.full(CLASSES, np.nan)
    for c in np.unique(size):
        found[c] = slack * np.quantile(dist[size == c], WITHIN)
    have = np.flatnonzero(~np.isnan(found))
    at = np.maximum(np.searchsorted(have, np.arange(CLASSES), "right") - 1, 0)
    return found[have[at]]


def train(tf: np.ndarray, lang: list[str], per_language: int = CENTROIDS, slack: float = 1.1) -> Model:
    """Centroids and radii of labelled count rows."""
    n = len(lang)
    idf = np.log((1 + n) / (1 + (tf > 0).sum(0))) + 1 if n else np.ones(DIMS)
    model = Model(idf, np.empty((0, DIMS)), [], np.empty((0, CLASSES)))
    if not n:
        return model
    v, names, size = model.vectors(tf), np.array(lang), length_class(tf)
    every = sorted(set(lang))
    sets = [cluster(v[names == x], per_language) for x in every]
    model.centroids = np.concatenate(sets)
    model.languages = [x for x, s in zip(every, sets) for _ in range(len(s))]
    dist = [1 - (v[names == x] @ s.T).max(1) for x, s in zip(every, sets)]
    model.radius = np.concatenate([np.tile(radii(d, size[names == x], slack), (len(s), 1)) for x, s, d in zip(every, sets, dist)])
    return model


def quotas(rows: dict[str, int], bound: int) -> dict[str, float]:
    """Share of each language's rows to take: ``bound`` rows dealt evenly, what small languages leave goes to the others."""
    level, left, shares = 0.0, float(bound), {}
    for i, (x, n) in enumerate(sorted(rows.items(), key=lambda r: (r[1], r[0]))):
        level = left / (len(rows) - i)
        shares[x] = min(1.0, level / max(n, 1))
        left -= min(n, level)
    return shares


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from at most about ``train_rows`` documents whose crc32(doc_id) mod 4 is not 2.

    Only ``text`` and non-null ``lang`` are used; texts without a letter are left
    out. The rows are dealt evenly to the languages, so a rare one is learned
    from all of its rows; equal rows count once. One row for each language
    reaches the driver beside the sample, as the model holds its centroids.
    """
    small_batches(docs.sparkSession)
    h = F.xxhash64("doc_id", "text")
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.where(train_remainder(F.col("doc_id"), 4) != 2).select("text", F.col("lang").cast("string").alias("lang"), h.alias("__h"))
    found = known.groupBy("lang").agg(F.approx_count_distinct("__h", 0.02).alias("n")).collect()
    shares = quotas({r["lang"]: r["n"] for r in found}, train_rows)
    dealt = docs.sparkSession.createDataFrame(sorted(shares.items()), "of string, share double")
    some = known.join(F.broadcast(dealt), F.col("lang") == F.col("of")).where(hashed_share(F.col("__h"), F.col("share")))

    def rows(batches):
        for b in trimmed(batches):
            keep = [i for i, t in enumerate(b.column(0)) if has_letter(t.as_py())]
            x = [zlib.compress(counts(b.column(0)[i].as_py()).astype("<u4").tobytes(), 1) for i in keep]
            kept = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), b.column(1).take(kept), b.column(2).take(kept)], names=["tf", "lang", "h"])

    got = some.select("text", "lang", "__h").mapInArrow(rows, "tf binary, lang string, h long").dropDuplicates(["h", "lang"]).toArrow()
    x, lang = got.column("tf").to_pylist(), got.column("lang").to_pylist()
    order = sorted(range(len(x)), key=lambda i: (lang[i], x[i]))  # the same centroids whatever the partitions
    tf = np.array([np.frombuffer(zlib.decompress(x[i]), "<u4") for i in order], np.float32).reshape(-1, DIMS)
    return train(tf, [lang[i] for i in order])


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default ``doc_id``) as ``row``, with ``lang_pred, score, rejected``."""
    wanted = with_text(docs, keep)

    def run(batches):
        for b in trimmed(batches):
            lang, cos, far, texts = [], [np.empty(0)], [np.empty(0, bool)], texts_of(b)
            for at in range(0, b.num_rows, 128):
                x, y, z = model.nearest(texts.slice(at, 128).to_pylist())
                lang += x
                cos.append(y)
                far.append(z)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(np.concatenate(cos)), pa.array(np.concatenate(far))],
                names=["row", "lang_pred", "score", "rejected"],
            )

    out = StructType([*wanted.select("row").schema.fields])
    return wanted.mapInArrow(run, out.add("lang_pred", StringType()).add("score", DoubleType()).add("rejected", BooleanType()))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every document.

    ``lang_pred`` is a learned language, or ``und`` (score 0) where the text is
    null, has no letter, or nothing could be learned. ``rejected`` tells that
    the nearest centroid is too far for its language to be trusted. Texts are
    read whole; repeated rows have a result each; an empty table gives none.
    """
    p = predict(docs, fit(docs))
    return p.select(
        F.col("row.doc_id").alias("doc_id"), (train_remainder(F.col("row.doc_id"), 4) == 2).alias("held_out"),
        "lang_pred", "score", "rejected",
    )
