"""Periodic runs of words: Lyndon roots by suffix grouping, extended by common extensions.

A run is a stretch of words of smallest period q that no neighbour extends. Each
run holds a root, a Lyndon word of length q under one of two orders of the words,
an order and its reverse, that is the longest Lyndon word starting at its place.
So the longest Lyndon words at all places, under both orders, give all roots.

``lyndon_lengths`` finds them by the first phase of Baier's suffix sorter: groups
of suffixes with a common beginning are refined from the highest to the lowest,
and in the end the beginning of a group is the longest Lyndon word of its
suffixes. Roots are extended to both sides by longest common extensions, found by
binary search over fingerprints; all runs found are compared word by word, so a
collision of fingerprints cannot show in a result.

A run of at least m words and 3 periods holds every k-gram of its words twice, if
3k - 5 <= m. So a text is searched only within its maximal stretches of k-grams
that occur again in it. A run lies in one of these stretches as a whole, and none
is lost.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from sparkraster.llm.shared import mix64, texts_of, trimmed, with_text

#: Two primes below 2**31; products of residues fit 64 bits.
PRIMES = (2147483647, 2147483629)


def lyndon_lengths(codes: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place of ``codes``.

    Groups are kept in a linked list in the order of their suffixes. The highest
    group that is left is final. Its members are taken out, and each passes its
    word to the nearest place before it that is still in a group: a place that
    gets l of them has its word lengthened by these l, and leaves its group for a
    new one right above it, the more the higher. Every place passes its word
    once, so the work is linear but for the search of the nearest place, which
    compresses its paths.
    """
    members_of: dict[int, list[int]] = {}
    for i, c in enumerate(codes):
        members_of.setdefault(c, []).append(i)
    members = [members_of[c] for c in sorted(members_of)]
    word = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    group = [0] * len(codes)
    for g, some in enumerate(members):
        for i in some:
            group[i] = g
    left = list(range(-1, len(codes) - 1))
    done = bytearray(len(codes))
    top = len(members) - 1
    while top >= 0:
        own = [i for i in members[top] if group[i] == top]
        members[top] = ()
        for i in own:
            done[i] = 1
        moved: dict[tuple[int, int], list[int]] = {}
        last, times = -1, 0
        for i in own:
            near = i - 1
            if near >= 0 and done[near]:
                at = near
                while near >= 0 and done[near]:
                    near = left[near]
                while at != near:
                    left[at], at = near, left[at]
            left[i] = near
            if near == last:
                times += 1
            else:
                if last >= 0:
                    moved.setdefault((group[last], times), []).append(last)
                last, times = near, 1
        if last >= 0:
            moved.setdefault((group[last], times), []).append(last)
        for old, times in sorted(moved, key=lambda m: -m[1]):
            new = len(members)
            members.append(moved[old, times])
            word.append(word[old] + times * word[top])
            for i in members[new]:
                group[i] = new
            after = above[old]
            below.append(old)
            above.append(after)
            above[old] = new
            below[after] = new
        top = below[top]
    return [word[g] for g in group]


class Extensions:
    """Longest common extensions of places of one sequence, by fingerprints modulo two primes."""

    def __init__(self, codes: np.ndarray, seed: int):
        n = len(codes)
        self.n, self.sums, self.powers = n, [], []
        draw = np.random.default_rng(seed)
        for prime in PRIMES:
            value = draw.integers(1, prime, int(codes.max()) + 1)
            base = int(draw.integers(1 << 20, prime))
            power = np.ones(n + 1, np.int64)
            k = 1
            while k <= n:
                some = power[k : 2 * k]
                some[:] = power[: len(some)] * pow(base, k, prime) % prime
                k *= 2
            total = np.concatenate([[0], np.cumsum(value[codes] * power[:n] % prime)]) % prime
            self.sums.append(total)
            self.powers.append(power)

    def equal(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the ``length`` words from ``i`` and from ``j`` (i < j) have equal fingerprints."""
        same = np.ones(len(i), bool)
        for prime, total, power in zip(PRIMES, self.sums, self.powers):
            a = (total[i + length] - total[i]) % prime * power[j - i] % prime
            same &= a == (total[j + length] - total[j]) % prime
        return same

    def reach(self, i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``i`` and ``j`` (i < j) on are equal; not ``forward``: words before both."""
        low, high = np.zeros(len(i), np.int64), self.n - j if forward else i.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.equal(i, j, mid) if forward else self.equal(i - mid, j - mid, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low


def _is_run(codes: np.ndarray, start: int, length: int, period: int) -> bool:
    end = start + length
    return (
        bool((codes[start : end - period] == codes[start + period : end]).all())
        and (start == 0 or codes[start - 1] != codes[start - 1 + period])
        and (end == len(codes) or codes[end] != codes[end - period])
    )


def runs_of(codes: np.ndarray, min_length: int, min_periods: int) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least so many words and periods, in this order."""
    n = len(codes)
    if n < min_length:
        return np.empty((0, 3), np.int64)
    highest = int(codes.max())
    roots = [np.array(lyndon_lengths(x.tolist()), np.int64) for x in (codes, highest - codes)]
    i = np.concatenate([np.arange(n), np.arange(n)])
    p = np.concatenate(roots)
    fits = i + 2 * p <= n
    i, p = i[fits], p[fits]
    for seed in range(64):
        text = Extensions(codes, seed)
        twice = text.equal(i, i + p, p)
        a, q = i[twice], p[twice]
        # A root right after an equal one has its run.
        place = q * (n + 1) + a
        first = ~np.isin(place - q, place)
        a, q = a[first], q[first]
        start = a - text.reach(a, a + q, False)
        end = a + q + text.reach(a, a + q, True)
        keep = end - start >= np.maximum(min_length, min_periods * q)
        found = np.unique(np.stack([start, end - start, q], 1)[keep], axis=0)
        if all(_is_run(codes, *run) for run in found.tolist()):
            return found[np.lexsort([found[:, 2], found[:, 0]])]
    raise ArithmeticError("fingerprints collide under all seeds")


def gram_size(min_length: int) -> int:
    """The largest power of two k with 3k - 5 <= ``min_length``: each k-gram of a run of 3 periods is twice in it."""
    k = 1
    while 3 * 2 * k - 5 <= min_length:
        k *= 2
    return k


def stretches(hashes: np.ndarray, k: int) -> list[tuple[int, int]]:
    """Maximal stretches (begin, end) of words whose ``k``-grams all occur again; equal words have equal hashes."""
    if len(hashes) <= k:
        return []
    x, size = hashes, 1
    while size < k:
        x = mix64(x[:-size] * np.uint64(0x9E3779B97F4A7C15) + x[size:])
        size *= 2
    order = np.sort(x)
    again = order[1:][order[1:] == order[:-1]]
    if not len(again):
        return []
    again = again[np.concatenate([[True], again[1:] != again[:-1]])]
    at = np.minimum(np.searchsorted(again, x), len(again) - 1)
    flag = np.concatenate([[False], again[at] == x, [False]])
    edge = np.flatnonzero(flag[1:] != flag[:-1])
    return [(int(b), int(e) + k - 1) for b, e in zip(edge[::2], edge[1::2])]


def word_runs(words: list[bytes], min_length: int, min_periods: int) -> np.ndarray:
    """Rows (start, length, period) of the runs of ``words``, by start and period."""
    found = []
    if len(words) >= min_length:
        hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        for begin, end in stretches(hashes, gram_size(min_length)):
            if end - begin < min_length:
                continue
            code: dict[bytes, int] = {}
            codes = np.array([code.setdefault(w, len(code)) for w in words[begin:end]], np.int64)
            found.append(runs_of(codes, min_length, min_periods) + np.array([begin, 0, 0]))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by a blank."""
    if len(runs):
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
    return b" ".join(words)


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of the query's texts: those of one in ten ids repeat from some place on; null ids stay as they are."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def find_runs(docs: DataFrame, min_length: int = 24, min_periods: int = 3, rewrite=None, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default ``doc_id``), ``runs`` and ``collapsed`` of every document.

    ``runs`` has a (start, length, period) for each run of at least ``min_length``
    words and ``min_periods`` (3 or more) periods, by start and period; ``start``
    counts words from 0. ``collapsed`` is the text without the words that a run
    holds after its first period, its words joined by a blank. Words are what
    ASCII white space separates, compared byte by byte. ``rewrite(words,
    doc_id)`` may change the words before.

    Texts are read whole. Null, empty and blank texts have no runs and collapse
    to an empty text. Repeated rows have a result each, an empty table gives
    none; other columns may have any name.
    """
    if min_periods < 3:
        raise ValueError("runs of fewer than 3 periods do not repeat each of their k-grams")
    ids = rewrite is not None
    wanted = with_text(docs, keep)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for b in trimmed(batches):
            runs, texts = [], []
            doc_ids = b.column(0).field("doc_id") if ids else [None] * b.num_rows
            for doc_id, t in zip(doc_ids, texts_of(b)):
                words = t.as_buffer().to_pybytes().split() if t.is_valid else []
                if ids:
                    words = rewrite(words, doc_id.as_py())
                found = word_runs(words, min_length, min_periods)
                runs.append(found)
                texts.append(collapsed(words, found))
            rows = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
            ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            fields = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], fields=list(kind.value_type))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends), fields), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["row", "runs", "collapsed"],
            )

    one = StructType().add("start", LongType()).add("length", LongType()).add("period", LongType())
    out = StructType([*wanted.select("row").schema.fields]).add("runs", ArrayType(one)).add("collapsed", StringType())
    return wanted.mapInArrow(run, out).select("row.*", "runs", "collapsed")


def digests(found: DataFrame) -> DataFrame:
    """``doc_id, n_runs``, the run of the greatest exponent and SHA-256 sums of runs and collapsed texts."""
    greater = F.expr(
        """array_sort(runs, (x, y) -> CASE WHEN x.length * y.period > y.length * x.period THEN -1
           WHEN x.length * y.period < y.length * x.period THEN 1 WHEN x.start <> y.start THEN CAST(sign(x.start - y.start) AS INT)
           ELSE CAST(sign(x.period - y.period) AS INT) END)"""
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    best = F.try_element_at(greater, F.lit(1))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
