"""Token ids in a byte-aligned variable-length code of frequency ranks.

Ids are replaced by their frequency rank, so that frequent ids are small
numbers. A rank takes 1 to 4 little-endian bytes. Four ranks share one control
byte with 2 bits each for their lengths; all control bytes of a block stand
before its data bytes, so a block is decoded without a branch: a table of 256
entries gives the length of each of the four ranks, a cumulative sum their
places.

A shard file holds the documents of one range of doc_id in ascending order:

    magic "SRT1", uint32 header size, header (JSON)
    segments: uint32 number of ranks, uint32 number of blocks, ids by rank
              (uint32), blocks of uint32 number of ids, uint32 data size,
              control bytes, data bytes
    index:    per document int64 doc_id, uint32 number of ids (end id included)
    footer:   int64 offset of the index, int64 documents, magic "SRT1"

A segment of about ``SEGMENT_IDS`` ids has its own ranks, counted over all of
its ids. So the texts are encoded and written in one pass, with a bounded
buffer, and the ranks follow the language of the shard. Offsets of documents in
the corpus follow from the sums of the shards; one row per shard reaches the
driver.
"""

from __future__ import annotations

import array
import functools
import itertools
import json
import os
import string
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkraster.llm.shared import AtomicFile, Memory, for_worker, fresh_dir, open_fs, small_batches, stored, trimmed

MAGIC = b"SRT1"
BLOCK_IDS = 1 << 16
SEGMENT_IDS = 1 << 22
NO_ID = -(1 << 63)
END_ID = 2


def _lengths() -> np.ndarray:
    """Byte lengths of the four ranks of each control byte."""
    c = np.arange(256)
    return np.stack([(c >> (2 * i)) & 3 for i in range(4)], 1).astype(np.int64) + 1


LENGTHS = _lengths()


def encode_ranks(ranks: np.ndarray) -> bytes:
    """A block: sizes, control bytes, data bytes."""
    n = len(ranks)
    r = np.zeros(-(-n // 4) * 4, np.uint32)
    r[:n] = ranks
    wide = 2 if n == 0 or int(r.max()) <= 0xFFFF else 4
    size = (r > 0xFF).view(np.uint8)
    if wide == 4:
        size = size + (r > 0xFFFF) + (r > 0xFFFFFF)
    quads = size.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    bytes_of = r.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide)
    data = bytes_of[np.arange(wide) <= size[:, None]]
    head = np.array([n, len(data)], "<u4").tobytes()
    return head + control.astype(np.uint8).tobytes() + data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks of a block by table lookup."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()
    end = np.cumsum(size)
    start = end - size
    d = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)]).astype(np.uint32)
    out = d[start]
    for i in range(1, 4):
        out |= np.where(size > i, d[start + i] << np.uint32(8 * i), 0).astype(np.uint32)
    return out[:n]


def encode_segment(ids: np.ndarray) -> bytes:
    """The ids by frequency (ties by id) and the blocks of their ranks."""
    count = np.bincount(ids)
    some = np.flatnonzero(count)
    order = some[np.lexsort([some, -count[some]])]
    rank = np.zeros(len(count), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    ranks = rank[ids]
    blocks = [encode_ranks(ranks[at : at + BLOCK_IDS]) for at in range(0, len(ids), BLOCK_IDS)]
    return np.array([len(order), len(blocks)], "<u4").tobytes() + order.astype("<u4").tobytes() + b"".join(blocks)


def tokenizer_path(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _visible() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


VISIBLE = _visible()


class Encoder:
    """Encodes texts with the library, once for each different word while it is remembered.

    Byte-level pre-tokens never reach past the blank that begins them, so the
    ids of a text are those of its words, each with the blank before it, and of
    its newlines. A word of letters or digits alone, and punctuation after it,
    are one pre-token each and go to the library's model directly; others go
    through the whole library. Texts with runs of white space or other white
    space than single blanks and newlines, and tokenizers of another kind, are
    encoded whole by the library.
    """

    def __init__(self, tokenizer: str, bound: int = 64 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_path(tokenizer))
        self.model = self.tok.model
        if hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)  # words are remembered here
        pre = json.loads(self.tok.pre_tokenizer.__getstate__()) if self.tok.pre_tokenizer is not None else {}
        added = self.tok.get_added_tokens_decoder().values()
        own = any(a.lstrip or a.rstrip or not a.content or set(a.content) & {" ", "\n"} for a in added)
        self.by_word = (
            self.tok.normalizer is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and type(self.model).__name__ == "BPE" and not self.model.dropout and not own
        )
        # An added token of letters, digits or punctuation alone could hide inside such a word.
        plain = (a.content.rstrip(string.punctuation) for a in added)
        self.direct = self.by_word and not any(x.isalnum() or not x for x in plain)
        self.tails = Memory(self._tail, 1 << 20)
        self.after_blank = Memory(functools.partial(self._word, " "), bound * 3 // 4)
        self.as_is = Memory(functools.partial(self._word, ""), bound // 4)
        self.newline = self._library("\n")

    def _library(self, text: str) -> bytes:
        encode = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        return array.array("I", encode([text], add_special_tokens=False)[0].ids).tobytes()

    def _tail(self, tail: str) -> bytes:
        return array.array("I", [t.id for t in self.model.tokenize(tail)]).tobytes()

    def _word(self, before: str, word: str) -> bytes:
        core = word.rstrip(string.punctuation)
        # Letters below U+0370 are letters in every version of Unicode.
        ascii_core = core.isascii()
        if self.direct and (core.isalpha() and (ascii_core or max(core) < "\u0370") or ascii_core and core.isdigit()):
            if len(core) < len(word):
                return (self.after_blank if before else self.as_is)[core] + self.tails[word[len(core) :]]
            seen = core if ascii_core else core.encode().decode("latin-1").translate(VISIBLE)
            return array.array("I", [t.id for t in self.model.tokenize("\u0120" + seen if before else seen)]).tobytes()
        if word.split() != [word]:
            raise _Blank
        return self._library(before + word)

    def ids(self, text: str) -> bytes:
        """Little-endian uint32 ids of ``text``."""
        if not text:
            return b""
        if self.by_word and not ("  " in text or "\n\n" in text or "\n " in text or " \n" in text or text[0] in " \n" or text[-1] in " \n"):
            head, word, out = self.as_is.__getitem__, self.after_blank.__getitem__, []
            try:
                for line in text.split("\n"):
                    fields = line.split(" ")
                    out.append(self.newline)
                    out.append(head(fields[0]))
                    out += map(word, fields[1:])
                return b"".join(out[1:])
            except _Blank:
                pass
        return self._library(text)


class _Blank(Exception):
    """A word holds white space of another kind."""


def write(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = END_ID, bound: int = 64 << 20) -> DataFrame:
    """Encode ``docs(doc_id, text)`` into shard files below ``path``; returns the manifest.

    The manifest has ``shard, file, documents, tokens, start`` (ids of all
    shards before it). Null texts are empty and hold the end id alone. Rows
    that share a doc_id all stay, ordered by their ids; rows without doc_id
    come first. An empty table writes no shard. A worker remembers words up to
    ``bound`` bytes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    head = json.dumps({"tokenizer": os.path.basename(tokenizer), "end_id": end_id}).encode()

    def shard(batches):
        batches = trimmed(batches, keeps=True)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        name = f"shard-{part:06d}.srt"
        encoder = for_worker(("token ids", tokenizer, bound), lambda: Encoder(tokenizer, bound))
        end = np.array([end_id], "<u4").tobytes()
        index, waiting, held, total = [], [], 0, 0
        with AtomicFile(f"{path}/{name}") as out:
            out.write(MAGIC + np.array([len(head)], "<u4").tobytes() + head)
            for b in itertools.chain([first], batches):
                for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                    ids = encoder.ids(t.as_py() or "") + end
                    waiting.append(ids)
                    index.append((i if i is not None else NO_ID, len(ids) // 4))
                    held += len(ids) // 4
                    if held >= SEGMENT_IDS:
                        out.write(encode_segment(np.frombuffer(b"".join(waiting), "<u4")))
                        total, held, waiting = total + held, 0, []
            if waiting:
                out.write(encode_segment(np.frombuffer(b"".join(waiting), "<u4")))
            rows = np.array(index, [("id", "<i8"), ("n", "<u4")])
            at = out.write(rows.tobytes())
            out.write(np.array([at, len(rows)], "<i8").tobytes() + MAGIC)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([name]), pa.array([len(rows)], pa.int64()), pa.array([total + held], pa.int64())],
            names=["shard", "file", "documents", "tokens"],
        )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange(parts, "doc_id", tie).sortWithinPartitions("doc_id", tie)
    made = stored(rows.mapInArrow(shard, "shard long, file string, documents long, tokens long"))
    sums, start = [], 0
    for r in sorted(made.collect(), key=lambda r: r["shard"]):
        sums.append((r["shard"], r["file"], r["documents"], r["tokens"], start))
        start += r["tokens"]
    return spark.createDataFrame(sums, "shard long, file string, documents long, tokens long, start long")


def read(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Documents of the shard files: ``doc_id, start, n_tokens, ids_crc32``, read from the files alone."""

    def run(batches):
        for b in batches:
            for name, begin in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, p = open_fs(f"{path}/{name}")
                with fs.open_input_file(p) as f:
                    yield from documents(f, begin)

    def documents(f, begin):
        size = f.size()
        f.seek(size - 20)
        tail = f.read(20)
        assert tail[16:] == MAGIC, "not a shard file"
        at, n = np.frombuffer(tail[:16], "<i8")
        f.seek(int(at))
        index = np.frombuffer(f.read(int(n) * 12), [("id", "<i8"), ("n", "<u4")])
        f.seek(0)
        assert f.read(4) == MAGIC, "not a shard file"
        f.seek(8 + int(np.frombuffer(f.read(4), "<u4")[0]))
        left, table, blocks = np.empty(0, np.uint32), None, 0
        crcs, done = [], 0
        n_of = index["n"].astype(np.int64)
        for k, want in enumerate(n_of.tolist()):
            crc = 0
            while want:
                if not len(left):
                    if not blocks:
                        ranks, blocks = (int(x) for x in np.frombuffer(f.read(8), "<u4"))
                        table = np.frombuffer(f.read(4 * ranks), "<u4")
                    blocks -= 1
                    many, data = (int(x) for x in np.frombuffer(f.read(8), "<u4"))
                    left = table[decode_ranks(f.read(-(-many // 4)), f.read(data), many)]
                take, left = left[:want], left[want:]
                crc = zlib.crc32(take.astype("<u4").tobytes(), crc)
                want -= len(take)
            crcs.append(crc)
            if len(crcs) == 4096 or k == len(n_of) - 1:
                part = slice(done, k + 1)
                starts = begin + np.cumsum(n_of)[part] - n_of[part]
                i = index["id"][part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i, mask=i == NO_ID), pa.array(starts), pa.array(n_of[part]), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                crcs, done = [], k + 1

    n = max(1, manifest.count())
    return manifest.select("file", "start", "shard").repartitionByRange(n, "shard").select("file", "start").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def round_trip(docs: DataFrame, path: str | None = None, tokenizer: str = "byte_bpe_50k.json", end_id: int = END_ID, bound: int = 64 << 20) -> DataFrame:
    """Write the token files of ``docs`` and read them back: ``doc_id, start, n_tokens, ids_crc32``."""
    path = path or fresh_dir(docs.sparkSession, "tokens")
    return read(docs.sparkSession, path, write(docs, path, tokenizer, end_id, bound))
