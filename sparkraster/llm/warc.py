"""WARC archives with revisit records and a two-level capture index.

Every page becomes one gzip member, so a record is read by its range alone.
Of records with equal payloads the one with the largest page_id is the
response; the others are revisits that name it. Response members are built and
compressed before the join that tells the revisits, so that compressed bytes
are shuffled and raw pages never are.

The index has a line for each capture: the URL with its host reversed
(``com,example,www)/path``), page_id, archive, offset and length. Lines are
range-partitioned and sorted by key, and cut into compressed blocks; a shard
file ends with a sparse directory of the first key of each block. A lookup finds
the shard by the few first keys of the manifest, the block by binary search in
the directory, and reads the block and the records by range.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import json
import uuid
import zlib
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkraster.llm.shared import AtomicFile, cut, fresh_dir, open_fs, small_batches, stored

MAGIC = b"CIX1"
LINES = 1024
READ_AHEAD = 1 << 22
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def member(data: bytes, level: int = 5) -> bytes:
    """One gzip member with no time or name, so equal data give equal bytes."""
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record(kind: str, page_id, url, digest: str, payload_bytes: int, payload: bytes = b"", refers_to=None) -> bytes:
    """The bytes of a response or revisit record. ``digest``: base32 SHA-1 of the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of the record in a gzip member."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def sort_key(url: str | None) -> str:
    """The URL with its host reversed, without scheme and fragment; null is empty."""
    if url is None:
        return ""
    try:
        u = urlsplit(url.strip())
        host, port = (u.hostname or "").lower(), u.port
    except ValueError:
        return url.strip()
    port = f":{port}" if port and port not in (80, 443) else ""
    return ",".join(reversed(host.split("."))) + port + ")" + (u.path or "/") + (f"?{u.query}" if u.query else "")


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _members(pages: DataFrame) -> DataFrame:
    """``page_id, url, sha, n, gz``: the response member of each page."""

    def run(batches):
        for b in batches:
            n, gz = [], []
            for i, url, sha, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                payload = html.as_buffer().to_pybytes()
                n.append(len(payload))
                gz.append(member(record("response", i, url, base32(sha), len(payload), payload)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(n, pa.int64()), pa.array(gz, pa.binary())], names=["page_id", "url", "sha", "n", "gz"]
            )

    return pages.mapInArrow(run, "page_id long, url string, sha string, n long, gz binary")


def write(pages: DataFrame, path: str, least: int = 0) -> DataFrame:
    """Archives and index of ``pages(page_id, url, html)`` below ``path``; returns the index manifest.

    The manifest has ``shard, file, first_key, last_key, captures``, a row for
    each index shard. Null html is an empty payload; null urls have the empty
    key. Payloads shorter than ``least`` bytes are never revisits. Rows that
    share page_id and payload are alike: all of them are the response, or all
    revisits. Other columns are ignored; an empty table writes nothing.
    """
    spark = pages.sparkSession
    small_batches(spark)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).select("page_id", "url", F.sha1(F.col("html").cast("binary")).alias("sha"), "html")
    light = rows.select("page_id", "sha", F.octet_length("html").alias("bytes"))
    firsts = light.where(F.col("bytes") >= least).groupBy("sha").agg(F.max("page_id").alias("refers_to"))
    again = (
        light.where(F.col("bytes") >= least).select("page_id", "sha").join(firsts, "sha")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).distinct()
        .select(F.col("page_id").alias("again_id"), F.col("sha").alias("again_sha"), "refers_to")
    )
    members = _members(rows.select("page_id", "url", "sha", "html"))
    told = members.join(
        again, F.col("page_id").eqNullSafe(F.col("again_id")) & (F.col("sha") == F.col("again_sha")), "left"
    ).select("page_id", "url", "sha", "n", "gz", "refers_to", F.col("again_sha").isNotNull().alias("revisit"))

    def archive(batches):
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        # The index names the file of the attempt that counted.
        name = f"archive-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}.warc.gz"
        with AtomicFile(f"{path}/{name}") as out:
            info = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x-file:{name}>\r\nWARC-Date: {DATE}\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
            out.write(member(info.encode()))
            b = first
            while b is not None:
                at, size, keys = [], [], []
                for i, url, sha, n, gz, to, revisit in zip(*(b.column(c).to_pylist() for c in range(7))):
                    if revisit:
                        gz = member(record("revisit", i, url, base32(sha), n, refers_to=to))
                    at.append(out.write(gz))
                    size.append(len(gz))
                    keys.append(sort_key(url))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), b.column(0), pa.array([name] * len(at)), pa.array(at, pa.int64()), pa.array(size, pa.int64())],
                    names=["key", "page_id", "file", "at", "size"],
                )
                b = next(batches, None)

    lines = stored(told.mapInArrow(archive, "key string, page_id long, file string, at long, size long"))

    def index(batches):
        part = TaskContext.get().partitionId()
        name, first, last, many, waiting, directory = f"index-{part:06d}.cix", None, None, 0, [], []
        out = None

        def flush():
            data = zlib.compress("\n".join(waiting).encode(), 6)
            directory.append([json.loads(waiting[0])[0], out.write(data), len(data), len(waiting)])
            waiting.clear()

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    out, first = AtomicFile(f"{path}/{name}"), row[0]
                last, many = row[0], many + 1
                waiting.append(json.dumps(row))
                if len(waiting) >= LINES:
                    flush()
        if out is None:
            return
        with out:
            if waiting:
                flush()
            data = zlib.compress(json.dumps(directory).encode(), 6)
            at = out.write(data)
            out.write(np.array([at, len(data)], "<i8").tobytes() + MAGIC)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([name]), pa.array([first]), pa.array([last]), pa.array([many], pa.int64())],
            names=["shard", "file", "first_key", "last_key", "captures"],
        )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "page_id", "file", "at"]
    dealt = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stored(dealt.mapInArrow(index, "shard long, file string, first_key string, last_key string, captures long"))


class Shard:
    """An open index shard: its directory, and captures by range reads."""

    def __init__(self, uri: str):
        fs, p = open_fs(uri)
        self.f = fs.open_input_file(p)
        size = self.f.size()
        tail = self.f.read_at(20, size - 20)
        if tail[16:] != MAGIC:
            raise ValueError(f"not an index shard: {uri}")
        at, n = (int(x) for x in np.frombuffer(tail[:16], "<i8"))
        self.directory = json.loads(zlib.decompress(self.f.read_at(n, at)))
        self.keys = [x[0] for x in self.directory]

        self.last: tuple[int, list[list], list[str]] = (-1, [], [])

    def block(self, i: int) -> list[list]:
        """The lines of a block; the last one read is kept, as lookups come in order of keys."""
        if self.last[0] != i:
            _, at, n, _ = self.directory[i]
            lines = [json.loads(x) for x in zlib.decompress(self.f.read_at(n, at)).decode().split("\n")]
            self.last = i, lines, [x[0] for x in lines]
        return self.last[1]

    def captures(self, key: str):
        """Lines of ``key``: the block before the first with a larger or equal key, and on from there."""
        i = max(0, bisect.bisect_left(self.keys, key) - 1)
        while i < len(self.keys) and self.keys[i] <= key:
            lines = self.block(i)
            keys = self.last[2]
            yield from lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]
            i += 1


def find(urls: DataFrame, manifest: DataFrame, path: str) -> DataFrame:
    """Captures of ``urls(url)``: ``key, page_id, file, at, size``, once for each key that a url has.

    A key goes to every index shard whose range holds it, so the captures of a
    key with very many are read by as many tasks. A null url finds the captures
    of null urls. The manifest has one row for each shard, so it is bounded by
    the number of partitions that wrote it; it is the only thing sent to all
    tasks.
    """
    shards = sorted((r["first_key"], r["last_key"], r["file"]) for r in manifest.collect())

    def route(batches):
        firsts = [s[0] for s in shards]
        for b in batches:
            key, file = [], []
            for u in b.column(0).to_pylist():
                k = sort_key(u)
                i = max(0, bisect.bisect_left(firsts, k) - 1)
                while i < len(shards) and shards[i][0] <= k:
                    if shards[i][1] >= k:
                        key.append(k)
                        file.append(shards[i][2])
                    i += 1
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (key, file)], names=["key", "shard"])

    def search(batches):
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        for b in batches:
            out = itertools.chain.from_iterable(lookups(b))
            while some := list(itertools.islice(out, 8192)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*some), kinds)], names=["key", "page_id", "file", "at", "size"]
                )

    def lookups(b):
        name = shard = None
        for key, file in zip(*(c.to_pylist() for c in b.columns)):
            if file != name:
                name, shard = file, Shard(f"{path}/{file}")
            yield shard.captures(key)

    routed = urls.select("url").distinct().mapInArrow(route, "key string, shard string").distinct()
    parts = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = routed.repartitionByRange(parts, "shard", "key").sortWithinPartitions("shard", "key")
    return dealt.select("key", "shard").mapInArrow(search, "key string, page_id long, file string, at long, size long")


def records(captures: DataFrame, path: str) -> DataFrame:
    """Range-read records of ``captures(file, at, size)``: what the archives say of each.

    Columns: ``page_id, url, payload_bytes, payload_digest, record_type,
    refers_to``. The digest and size of a response are those of the payload
    read, which must agree with its header.
    """

    def run(batches):
        name = f = None
        buffer, start = b"", 0
        for b in batches:
            out = []
            for file, at, size in zip(*(c.to_pylist() for c in b.columns)):
                if file != name:
                    fs, p = open_fs(f"{path}/{file}")
                    name, f, buffer, start = file, fs.open_input_file(p), b"", 0
                if not start <= at <= at + size <= start + len(buffer):
                    buffer, start = f.read_at(max(size, READ_AHEAD), at), at
                head, block = parse(buffer[at - start : at - start + size])
                http, _, payload = block.partition(b"\r\n\r\n")
                kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response":
                    if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"payload of {head['WARC-Record-ID']} does not have its digest")
                    n = len(payload)
                else:
                    n = int(http.rpartition(b"Content-Length: ")[2])
                to = page_of(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None
                out.append((page_of(head["WARC-Record-ID"]), head.get("WARC-Target-URI"), n, digest, kind, to))
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = captures.select("file", "at", "size").repartitionByRange(parts, "file", "at").sortWithinPartitions("file", "at")
    return dealt.mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def round_trip(pages: DataFrame, path: str | None = None, least: int = 0) -> DataFrame:
    """Write the archives of ``pages``, look every url up in the index, and read the records found."""
    path = path or fresh_dir(pages.sparkSession, "warc")
    manifest = write(pages, path, least)
    return records(cut(find(pages.select("url"), manifest, path)), path)
