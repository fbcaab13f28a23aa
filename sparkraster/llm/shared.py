"""Helpers that the training-data operators share: shared folder, files, hashing."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import types
import uuid
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of bytes that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where a local session names none (tests), a temporary folder is set; on a
    cluster, whose executors could not read it, that is an error.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(found)
        return found.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder; later reads do not recompute it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, group: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: compact, and its columns can be pruned.

    ``group`` bounds the bytes of a row group, for tables of long rows.
    """
    uri = fresh_dir(df.sparkSession, "table")
    writer = df.write if group is None else df.write.option("parquet.block.size", group)
    writer.parquet(uri)
    out = df.sparkSession.read.schema(df.schema).parquet(uri)
    out.stored_at = uri
    return out


def discard(df: DataFrame) -> None:
    """Deletes the table of a ``stored`` DataFrame, when nothing that is still to run reads it."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of DataFrames that are gone; its cleaner follows the collector of the driver's JVM."""
    gc.collect()
    spark._jvm.System.gc()


def fresh_dir(spark: SparkSession, what: str) -> str:
    """URI of a new folder for files of one run, below the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex[:12]}"


def open_fs(uri: str):
    """(pyarrow file system, path) of a URI; plain paths are local."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _kept() -> dict:
    """What this Python worker process keeps between its tasks."""
    return sys.modules.setdefault("sparkraster_worker", types.ModuleType("sparkraster_worker")).__dict__.setdefault("kept", {})


def for_worker(key, make):
    """An object made once in each Python worker and kept between tasks, until a task asks for another one."""
    kept = _kept()
    if key not in kept:
        clear_worker()
        kept[key] = make()
    return kept[key]


def clear_worker() -> None:
    """Drop what other operators' tasks kept in this worker, and give its memory back."""
    kept = _kept()
    if kept:
        kept.clear()
        gc.collect()
        _trim()


def _trim() -> None:
    """Gives freed memory of this process back to the system, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class AtomicFile:
    """A file that appears under its name only when it is complete.

    Two attempts of one task write two temporary files and move them to the
    same name; both hold the same bytes, so either may win.
    """

    def __init__(self, uri: str):
        self.fs, self.path = open_fs(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.out = self.fs.open_output_stream(self.part)
        self.at = 0

    def write(self, data: bytes) -> int:
        """Append ``data``; returns the offset at which it starts."""
        start = self.at
        self.out.write(data)
        self.at += len(data)
        return start

    def __enter__(self) -> AtomicFile:
        return self

    def __exit__(self, kind, *_) -> None:
        self.out.close()
        if kind is None:
            self.fs.move(self.part, self.path)
        else:
            self.fs.delete_file(self.part)


def train_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; null ids give 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod, F.lit(0)).cast("int")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mix of uint64 values (splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def trimmed(batches, keeps: bool = False):
    """The batches of a task; unused memory goes back after each and at the end, so idle workers stay small.

    Unless the task ``keeps`` an object in its worker, what others kept goes first.
    """
    import pyarrow as pa

    if not keeps:
        clear_worker()
    for b in batches:
        yield b
        del b
        pa.default_memory_pool().release_unused()
    _trim()


def small_batches(spark: SparkSession) -> None:
    """Holds the Arrow batches of the session to ``BATCH_BYTES``, which bounds what a task holds of long texts."""
    now = int(spark.conf.get(BATCH_CONF).rstrip("b"))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def with_text(docs: DataFrame, keep: list[str] | None) -> DataFrame:
    """``row``, a struct of the columns ``keep`` (default ``doc_id``), and ``text`` beside it if it is not among them.

    So a text is sent to the task once; ``texts_of`` finds it.
    """
    small_batches(docs.sparkSession)
    keep = keep or ["doc_id"]
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    return docs.select(row) if "text" in keep else docs.select(row, "text")


def texts_of(batch):
    """The texts of a batch of ``with_text``."""
    return batch.column(1) if batch.num_columns > 1 else batch.column(0).field("text")


class Memory(dict):
    """Results of ``make``, remembered up to about ``bound`` bytes.

    A key is kept when it is asked for the second time, as a long tail of keys
    comes only once; a bit for each key seen tells. Entries live in two
    generations: when the young one is full it becomes the old one, and what is
    asked for again moves back. Keys of more than ``LONGEST`` characters are
    never kept.
    """

    LONGEST = 200
    #: Bytes of an entry besides its key, about.
    ENTRY = 190
    SEEN = 1 << 21

    def __init__(self, make, bound: int = 32 << 20):
        super().__init__()
        self.make, self.half, self.size, self.old, self.seen = make, bound // 2, 0, {}, bytearray(self.SEEN)

    def __missing__(self, key):
        got = self.old.pop(key, None)
        if got is None:
            got = self.make(key)
            bit = hash(key) & (self.SEEN - 1)
            if not self.seen[bit]:
                self.seen[bit] = 1
                return got
            if len(key) > self.LONGEST:
                return got
        self.size += len(key) + self.ENTRY
        if self.size > self.half:
            self.old, self.size, self.seen = dict(self), len(key) + self.ENTRY, bytearray(self.SEEN)
            self.clear()
        self[key] = got
        return got


class WordHashes:
    """64-bit hashes of words, remembered up to a bound in bytes."""

    def __init__(self, bound: int = 12 << 20):
        import xxhash

        self.known = Memory(xxhash.xxh3_64_intdigest, bound)

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))


def shingles(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of ``words``.

    Fewer than k words give one shingle of all of them, none give none.
    """
    if not words:
        return np.empty(0, np.uint64)
    h = hashes.of(words)
    n = max(1, len(h) - k + 1)
    x = np.full(n, min(k, len(h)), np.uint64)
    for i in range(min(k, len(h))):
        x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(x)


def crc32_text(value: int) -> int:
    return zlib.crc32(str(value).encode())


def spanning_edges(i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (id, root id) of a star forest with the components of the edges i-j.

    ``i`` and ``j`` index ``ids``; the root of a component is its smallest id.
    """
    order = np.argsort(ids, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(ids))
    a, b = rank[i], rank[j]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    sorted_ids = ids[order]
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return sorted_ids[moved], sorted_ids[label[moved]]


def hashed_share(key: Column, share: Column | float, seed: int = 3) -> Column:
    """Whether a row is in the ``share`` of all keys, by a hash of its key; the same whatever the partitions."""
    scale = 1 << 30
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(scale)) < F.lit(float(scale)) * share


def bounded_sample(df: DataFrame, key: Column, bound: int, seed: int = 3) -> DataFrame:
    """About ``bound`` rows of ``df`` at most, chosen by a hash of the unique ``key``; all rows of fewer.

    The size is binomial around the bound, within a few per cent for thousands of rows.
    """
    n = df.count()
    return df if n <= bound else df.where(hashed_share(key, bound / n, seed))


def bounded_rows(df: DataFrame, bound: int, seed: int = 5) -> DataFrame:
    """About ``bound`` different rows of ``df`` at most; repeated rows count once, so no key can exceed the bound."""
    h = F.xxhash64(*df.columns)
    n = df.select(F.approx_count_distinct(h, 0.02)).first()[0]
    some = df.withColumn("__h", h)
    if n > bound:
        some = some.where(hashed_share(F.col("__h"), bound / n, seed))
    return some.dropDuplicates(["__h"]).drop("__h")


def labelled(docs: DataFrame, labels: DataFrame, target: str, mod: int, held_out: int, bound: int) -> DataFrame:
    """``text, y`` of at most about ``bound`` labelled documents outside the held-out remainder.

    Labels of repeated ids count once, with the largest value; null labels do
    not count. Only the ids of the sample are broadcast, and ``bound`` bounds
    them. Where ids are repeated in ``docs``, equal rows count once and the rows
    are bounded as well.
    """
    known = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(train_remainder(F.col("doc_id"), mod) != held_out)
    known = known.groupBy("doc_id").agg(F.max(target).cast("double").alias("y"))
    some = F.broadcast(bounded_sample(known, F.col("doc_id"), bound))
    rows = docs.select("doc_id", "text").join(some, "doc_id")
    if docs.select("doc_id").join(some, "doc_id").count() > 1.25 * bound:
        rows = bounded_rows(rows, bound)
    return rows.select("text", "y")
