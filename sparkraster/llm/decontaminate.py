"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts are compared lower-cased, with runs of white space as one blank. Items are
cut into windows of ``WINDOW`` characters every ``STEP``, and of fewer
characters at a step that together make any excerpt of ``shortest`` characters
of an item hold a whole window, wherever it begins; shorter items are one
window. Items under ``Q`` characters match as whole words. A window of length L
matches a region of a text when their edit distance is at most
``k = min(floor(edit_rate * L), L // q - 1)``, all lengths alike. By the q-gram
lemma such a region shares at least ``T = L - q + 1 - k * q`` of the window's
q-grams, on diagonals within k of each other. The steps lose no match:

1. positions of a text whose q-gram occurs in the benchmark are counted in
   sliding ranges of L + k, one for windows of about one length; regions with
   fewer than the least T of these are done with;
2. windows are a trie of blocks of characters, and hits in the regions left are
   counted by node and diagonal band of width k + 1, two neighbouring bands
   together; a way down the trie needs T in all;
3. nodes left are aligned inside their band from the top, a bit for each
   diagonal and number of edits. So a beginning that thousands of windows share
   is aligned once, and a window is left as soon as its band is above k;
4. windows that come through are aligned for their region and edits.

Windows go to the tasks in blocks of at most ``BLOCK_WINDOWS``, so what is
broadcast is bounded however large the benchmark. Each block is a pass; where
there are several, its result is written before the next block is broadcast.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkraster.llm.shared import cut, discard, small_batches, stored, trimmed

Q = 8
WINDOW = 120
STEP = 60
EDIT_RATE = 0.08
#: Shortest excerpt of an item that is found at every offset.
SHORTEST = 69
BLOCK_WINDOWS = 40_000
BITS = 22
#: Characters of a node of the trie of windows.
STRIDE = 16
#: What is held at a time: positions of a text, hits, and nodes that are aligned.
SECTION, ENTRIES, ACTIVE = 1 << 16, 1 << 17, 1 << 14
#: Nodes that are worth a step of their own.
FEW = 64


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """64-bit hashes of the q-grams of code points ``c``."""
    n = len(c) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h, size = c.astype(np.uint64), 1
    while size < q:  # a hash of ``size`` characters from two hashes of fewer, which may overlap
        shift = min(size, q - size)
        size += shift
        h = h[: len(c) - size + 1] * np.uint64((0x9E3779B97F4A7C15 * (2 * size + 1)) % (1 << 64)) + h[shift:]
        if size < q:
            h ^= h >> np.uint64(29)
    return h * np.uint64(0x9E3779B97F4A7C15)


def window_sizes(shortest: int = SHORTEST) -> tuple:
    """(length, step) of the windows; the dense ones have length + step - 1 = ``shortest``."""
    step = max(1, (shortest + 1) // 7)
    return (WINDOW, STEP), (shortest + 1 - step, step)


def windows_of(text: str, shortest: int = SHORTEST, least: int = 1) -> list[tuple[int, str]]:
    """(position, window) of a normalised item; the last window of a size ends with the item.

    Items of fewer than ``least`` characters have none.
    """
    if len(text) < least or not text:
        return []
    found = {}
    for window, step in window_sizes(shortest):
        last = max(0, len(text) - window)
        found |= {(s, text[s : s + window]): None for s in [*range(0, last, step), last]}
    return list(found)


def edits(length: int, q: int = Q, edit_rate: float = EDIT_RATE) -> int:
    """Most edits of a window: no more than leave the lemma a shared q-gram."""
    return max(0, min(int(edit_rate * length), length // q - 1))


class Matcher:
    """Finds the windows of a block in texts. ``windows``: (item_id, window id, text).

    Equal windows of several items are searched once. The windows are a trie of
    blocks of ``STRIDE`` characters below their length, so a beginning that many
    of them share is counted once and aligned once.
    """

    def __init__(self, windows: list[tuple[int, int, str]], q: int = Q, edit_rate: float = EDIT_RATE):
        self.q = q
        self.every = windows
        self.k = [edits(len(w[2]), q, edit_rate) for w in windows]
        owners: dict[str, list[int]] = {}
        for i, w in enumerate(windows):
            owners.setdefault(w[2], []).append(i)
        # Windows without a q-gram are looked up as words.
        self.words = {w: of for w, of in owners.items() if len(w) < q}
        self.most_words = max((w.count(" ") + 1 for w in self.words), default=0)
        texts = sorted((w for w in owners if len(w) >= q), key=lambda w: (len(w), w))
        self.owners = [owners[w] for w in texts]
        self.len = np.array([len(w) for w in texts], np.int64)
        self.most = np.array([edits(len(w), q, edit_rate) for w in texts], np.int64)
        self.need = self.len - q + 1 - self.most * q
        self.reach = int((self.len + self.most).max()) if texts else 0
        # (q-grams of the widest region, fewest shared) of windows of about one length.
        about = self.len // STRIDE
        spans = [(self.len + self.most)[about == a].max() - q + 1 for a in np.unique(about)]
        self.spans = [(int(s), int(self.need[about == a].min())) for s, a in zip(spans, np.unique(about))]
        if texts:
            self._plant([code_points(w) for w in texts])

    def _plant(self, chars: list[np.ndarray]) -> None:
        """Makes the trie, and the index from q-grams to its nodes."""
        n, levels = len(chars), -(-int(self.len[-1]) // STRIDE)
        of = np.repeat(np.arange(n), self.len)
        at = np.arange(len(of)) - np.repeat(np.cumsum(self.len) - self.len, self.len)
        self.alphabet, codes = np.unique(np.concatenate(chars), return_inverse=True)
        self.code = np.full((n, levels * STRIDE), len(self.alphabet), np.int32)
        self.code[of, at] = codes
        self.starts, self.rep, self.parent = [0], [], []
        node = np.full((levels, n), -1, np.int64)
        for t in range(levels):
            rows = np.flatnonzero(self.len > t * STRIDE)
            block = np.ascontiguousarray(self.code[rows, t * STRIDE : (t + 1) * STRIDE])
            block = np.unique(block.view(f"V{block.itemsize * STRIDE}").ravel(), return_inverse=True)[1].ravel()
            above = node[t - 1, rows] if t else self.len[rows]
            kind, first, mine = np.unique(above * (int(block.max()) + 1) + block, return_index=True, return_inverse=True)
            node[t, rows] = self.starts[-1] + mine
            self.rep.append(rows[first])
            self.parent.append(above[first] if t else np.full(len(kind), -1, np.int64))
            self.starts.append(self.starts[-1] + len(kind))
        self.rep, self.parent = np.concatenate(self.rep), np.concatenate(self.parent)
        self.root = np.arange(len(self.parent))
        for _ in range(levels - 1):
            self.root = np.where(self.parent[self.root] < 0, self.root, self.parent[self.root])
        # Children of a node follow each other.
        self.child = np.searchsorted(self.parent, np.arange(len(self.parent)))
        self.children = np.searchsorted(self.parent, np.arange(len(self.parent)), "right") - self.child
        every = [grams(c, self.q) for c in chars]
        many = self.len - self.q + 1
        flat, of = np.concatenate(every), np.repeat(np.arange(n), many)
        pos = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        under = node[(pos + self.q - 1) // STRIDE, of]
        once = self.rep[under] == of
        flat, under, pos = flat[once], under[once], pos[once]
        order = np.argsort(flat, kind="stable")
        self.gram, self.first = np.unique(flat[order], return_index=True)
        self.many = np.diff(np.append(self.first, len(flat)))
        self.of, self.pos = under[order], pos[order]
        self.bitmap = np.zeros(1 << BITS, bool)
        self.bitmap[(self.gram >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def hits(self, h: np.ndarray, begin: int, bands: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs of node and band that share q-grams, for each level of the trie: (key, own, best).

        ``h`` are the q-grams from position ``begin`` on, ``key`` is node * bands +
        band + 1 in order, ``own`` the hits of the node's own block in this band
        and the next, ``best`` these and the most that a way down adds.
        """
        maybe = self.bitmap[(h >> np.uint64(64 - BITS)).astype(np.int64)]
        # Sliding counts over the widest region that windows of about one length can match.
        total = np.concatenate([[0], np.cumsum(maybe)])
        n = len(h)
        edge = np.zeros(n + 1, np.int64)
        for span, least in self.spans:
            span = min(span, n)
            ok = np.flatnonzero(total[span:] - total[: n + 1 - span] >= least)
            edge[ok] += 1
            edge[ok + span] -= 1
        if not edge.any():
            return []
        dense = np.cumsum(edge[:n]) > 0
        at = np.flatnonzero(dense & maybe)
        if not len(at):
            return []
        g = np.searchsorted(self.gram, h[at])
        g[g == len(self.gram)] = 0
        right = self.gram[g] == h[at]
        at, g = at[right], g[right]
        # A way down has at most the hits below its root; most texts are done with here.
        root, below = np.empty(0, np.int64), np.empty(0, np.int64)
        pairs = list(self._pairs(at, g, begin)) if self.many[g].sum() <= ENTRIES else None
        for node, band in pairs or self._pairs(at, g, begin):
            some = self.root[node] * bands + band
            root, below = _counted(root, below, some)
        if not len(root):
            return []
        after = np.searchsorted(root, root + 1)
        after[after == len(root)] = 0
        ok = below + np.where(root[after] == root + 1, below[after], 0) >= self.need[self.rep[root // bands]]
        if not ok.any():
            return []
        root = np.unique(np.concatenate([root[ok], root[ok] + 1]))
        key, own = np.empty(0, np.int64), np.empty(0, np.int64)
        for node, band in pairs or self._pairs(at, g, begin):
            some = self.root[node] * bands + band
            there = np.searchsorted(root, some)
            there[there == len(root)] = 0
            some = (node * bands + band)[root[there] == some]
            key, own = _counted(key, own, some)
        key, own = _summed(np.concatenate([key, key - 1]), np.concatenate([own, own]))
        cuts = np.searchsorted(key, np.array(self.starts) * bands)
        levels = [[key[i:j], own[i:j], own[i:j].copy()] for i, j in zip(cuts, cuts[1:])]
        for t in range(len(levels) - 1, 0, -1):
            low, _, best = levels[t]
            if not len(low):
                continue
            up = self.parent[low // bands] * bands + low % bands
            order = np.lexsort((-best, up))
            up, first = np.unique(up[order], return_index=True)
            best = best[order][first]
            key, own, _ = levels[t - 1]
            both, own = _summed(np.concatenate([key, up]), np.concatenate([own, np.zeros(len(up), np.int64)]))
            most = own.copy()
            most[np.searchsorted(both, up)] += best
            levels[t - 1] = [both, own, most]
        return levels

    def _pairs(self, at: np.ndarray, g: np.ndarray, begin: int):
        """Node and band + 1 of each hit of q-grams ``g`` at ``at``, a bounded number at a time."""
        upto = np.cumsum(self.many[g])
        cuts = np.unique(np.searchsorted(upto, np.arange(0, upto[-1] if len(upto) else 0, ENTRIES)))
        for i, j in zip(cuts, [*cuts[1:], len(at)]):
            many = self.many[g[i:j]]
            entry = np.repeat(self.first[g[i:j]] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            node = self.of[entry]
            w = self.rep[node]
            diagonal = np.repeat(at[i:j], many) + begin - self.pos[entry] + self.len[w]
            yield node, diagonal // (self.most[w] + 1) + 1

    def candidates(self, c: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, band) within k edits of which the hits lie between positions ``begin`` and ``end`` of ``c``."""
        bands = len(c) + 2 * self.reach + 4
        levels = self.hits(grams(c[begin:end], self.q), begin, bands)
        out = []
        if levels:
            key, own, best = levels[0]
            ok = best >= self.need[self.rep[key // bands]]
            key, own = key[ok], own[ok]
            if len(key):
                page = _Page(c, begin, end, self)
                size = self.len[self.rep[key // bands]]
                for length in np.unique(size):
                    mine = size == length
                    self._descend(0, 0, key[mine], own[mine], None, int(length), bands, levels, page, out)
        w = np.concatenate([x // bands for x in out]) if out else np.empty(0, np.int64)
        band = np.concatenate([x % bands - 1 for x in out]) if out else np.empty(0, np.int64)
        w = self.rep[w]
        order = np.lexsort((band, w))
        w, band = w[order], band[order]
        # Of bands in a row every second is enough: a path of k edits with hits in band b lies inside what is aligned for b - 1.
        n = np.arange(len(w))
        first = np.append(True, (w[1:] != w[:-1]) | (band[1:] != band[:-1] + 1))[: len(w)]
        keep = (n - np.maximum.accumulate(np.where(first, n, 0))) % 2 == 0
        return w[keep], band[keep]

    def _descend(self, t, done, key, have, state, length, bands, levels, page, out) -> None:
        """Goes down from the nodes of block ``t`` in ``key`` where few edits and hits enough leave a match.

        The first ``done`` characters are aligned; a few nodes are left to the alignment of whole windows.
        """
        w = self.rep[key // bands]
        k, need = int(self.most[w[0]]), int(self.need[w[0]])
        upto = min((t + 1) * STRIDE, length)
        if len(key) >= FEW and 4 * k + 3 <= 64:  # a band in one machine word
            low = (key % bands - 1) * (k + 1) - length - k
            state = page.rows(state, self.code[w], low, range(done, upto), k)
            done = upto
            alive = state[k] != 0
            key, have, state = key[alive], have[alive], state[:, alive]
        if upto == length or not len(key):
            out.append(key)
            return
        node, band = key // bands, key % bands
        all_below = have >= need
        # Children that have hits themselves.
        low, own, best = levels[t + 1]
        up = self.parent[low // bands] * bands + low % bands
        order = np.argsort(key)
        at = np.searchsorted(key[order], up)
        at[at == len(key)] = 0
        at = order[at]
        ok = (key[at] == up) & ~all_below[at]
        ok[ok] = have[at[ok]] + best[ok] >= need
        kids, of, got = [low[ok]], [at[ok]], [have[at[ok]] + own[ok]]
        # All children where the beginning has hits enough.
        full = np.flatnonzero(all_below)
        many = self.children[node[full]]
        of.append(np.repeat(full, many))
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        kids.append((np.repeat(self.child[node[full]], many) + nth) * bands + np.repeat(band[full], many))
        got.append(np.repeat(have[full], many))
        kids, of, got = np.concatenate(kids), np.concatenate(of), np.concatenate(got)
        for i in range(0, len(kids), ACTIVE):
            part = of[i : i + ACTIVE]
            below = None if state is None else state[:, part]
            self._descend(t + 1, done, kids[i : i + ACTIVE], got[i : i + ACTIVE], below, length, bands, levels, page, out)

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(window, start, end, edits) of the windows that match ``text``, the best region of each."""
        text = normal(text)
        found: dict[int, tuple[int, int, int]] = {}
        if self.words:
            self._words(text, found)
        c = code_points(text)
        best: dict[int, tuple[int, int, int]] = {}
        for begin in range(0, len(c), SECTION) if len(self.len) else ():
            w, band = self.candidates(c, begin, begin + SECTION + self.reach)
            for length in np.unique(self.len[w]) if len(w) else []:
                mine = self.len[w] == length
                for at in range(0, int(mine.sum()), 256):
                    self._align(c, w[mine][at : at + 256], band[mine][at : at + 256], int(length), best)
        for x, hit in best.items():
            found |= dict.fromkeys(self.owners[x], hit)
        return [(x, *found[x]) for x in sorted(found)]

    def _words(self, text: str, found: dict) -> None:
        """Adds the short windows that are whole words of ``text``."""
        at, words = 0, text.split(" ")
        for i, word in enumerate(words):
            for n in range(1, self.most_words + 1):
                for x in self.words.get(" ".join(words[i : i + n]), ()) if i + n <= len(words) else ():
                    found.setdefault(x, (at, at + len(self.every[x][2]), 0))
            at += len(word) + 1

    def _align(self, c: np.ndarray, w: np.ndarray, band: np.ndarray, length: int, found: dict) -> None:
        """Banded edit distance of each window with its diagonals; adds those within k.

        Verbatim windows are told by comparing characters, as only a straight path has no edits.
        """
        better = np.array([found.get(x, (0, 0, 1))[2] > 0 for x in w.tolist()])
        w, band = w[better], band[better]
        if not len(w):
            return
        k = int(self.most[w[0]])
        low = band * (k + 1) - length - k  # leftmost diagonal
        width = 2 * (k + 1) + 2 * k + 1
        pad = np.full(length + width + 2, 0xFFFFFFFF, np.uint32)
        text = np.concatenate([pad, c, pad])
        base = low + len(pad)
        p = self.alphabet[self.code[w, :length]]
        cols = np.arange(width, dtype=np.int16)
        row, at, upto = np.repeat(np.arange(len(w)), width), (base[:, None] + cols).ravel(), 0
        while upto < length and len(row):
            some = np.arange(upto, min(length, 4 * upto + 1))
            same = (text[np.clip(at[:, None] + some, 0, len(text) - 1)] == p[row[:, None], some]).all(1)
            row, at, upto = row[same], at[same], int(some[-1]) + 1
        row, first = np.unique(row, return_index=True)
        for j, s in zip(row, at[first] - len(pad)):
            if found.get(int(w[j]), (0, 0, 1))[2] > 0:
                found[int(w[j])] = (int(s), int(s) + length, 0)
        left = np.ones(len(w), bool)
        left[row] = False
        if not left.any():
            return
        w, low, base, p = w[left], low[left], base[left], p[left]
        far = length + 1
        d = np.zeros((len(w), width), np.int16)
        start = low[:, None] + cols  # where the alignment of each cell began
        for i in range(length):
            there = text[np.clip(base[:, None] + i + cols, 0, len(text) - 1)]
            best = d + (there != p[:, i : i + 1])
            from_ = start
            up = np.concatenate([d[:, 1:] + 1, np.full((len(w), 1), far, np.int16)], 1)
            up_start = np.concatenate([start[:, 1:], start[:, -1:]], 1)
            from_ = np.where(up < best, up_start, from_)
            best = np.minimum(best, up)
            slid = best - cols
            low_so_far = np.minimum.accumulate(slid, 1)
            src = np.maximum.accumulate(np.where(slid == low_so_far, cols, 0), 1)
            d = low_so_far + cols
            start = np.take_along_axis(from_, src, 1)
        end = d.argmin(1)
        cost = d[np.arange(len(w)), end]
        for j in np.flatnonzero(cost <= k):
            s, e = int(start[j, end[j]]), int(low[j] + length + end[j])
            hit = (max(0, s), min(e, len(c)), int(cost[j]))
            if int(w[j]) not in found or hit[2] < found[int(w[j])][2]:
                found[int(w[j])] = hit


def _summed(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order and the sum of each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    return key[first], np.add.reduceat(count[order], first) if len(key) else count


def _counted(key: np.ndarray, count: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of keys with those of ``more`` added."""
    new, many = np.unique(more, return_counts=True)
    return _summed(np.concatenate([key, new]), np.concatenate([count, many])) if len(key) else (new, many)


class _Page:
    """Where the characters of the benchmark stand in a section of a text, as bits."""

    def __init__(self, c: np.ndarray, begin: int, end: int, m: Matcher):
        margin = 2 * m.reach + 64
        self.shift = margin - begin
        first = max(0, begin - margin)
        c = c[first : end + margin]
        code = np.searchsorted(m.alphabet, c)
        code[code == len(m.alphabet)] = 0
        at = np.flatnonzero(m.alphabet[code] == c)
        code = code[at]
        used = np.unique(code)
        # Row 0 is for characters that the section does not have.
        self.row = np.zeros(len(m.alphabet) + 1, np.int64)
        self.row[used] = np.arange(1, len(used) + 1)
        self.words = (end - begin + 2 * margin) // 64 + 4
        self.bits = np.zeros((len(used) + 1) * self.words, np.uint64)
        at = at + first + self.shift
        np.bitwise_or.at(self.bits, self.row[code] * self.words + (at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))

    def rows(self, state: np.ndarray | None, code: np.ndarray, low: np.ndarray, rows: range, k: int) -> np.ndarray:
        """The state after aligning these characters of windows; ``state[e]`` has a bit for each diagonal within e edits.

        A window whose band has no diagonal left within k edits is out and goes no further.
        """
        one, full = np.uint64(1), np.uint64((1 << (4 * k + 3)) - 1)
        if state is None:
            state = np.full((k + 1, len(low)), full)
        out, live = np.zeros_like(state), np.arange(len(low))
        low = low + self.shift
        for i in rows:
            x = low + i
            word = self.row[code[:, i]] * self.words + (x >> 6)
            s = (x & 63).astype(np.uint64)
            same = (self.bits[word] >> s) | ((self.bits[word + 1] << one) << (np.uint64(63) - s))
            before = np.zeros(len(low), np.uint64)
            for e in range(k + 1):
                old = state[e]
                new = old & same
                if e:
                    new |= before | (before >> one) | ((state[e - 1] << one) & full)
                before, state[e] = old.copy(), new
            if i % 4 == 3:
                alive = state[k] != 0
                if not alive.all():
                    live, low, code, state = live[alive], low[alive], code[alive], state[:, alive]
        out[:, live] = state
        return out


def windows_table(bench: DataFrame, least: int = 1, shortest: int = SHORTEST) -> DataFrame:
    """The distinct windows of the benchmark: ``item_id, window, w``; ``window`` is an id of the three."""

    def cut_up(batches):
        for b in batches:
            rows = [(i, p, w) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for p, w in windows_of(normal(t), shortest, least)]
            cols = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["item_id", "pos", "w"]
            )

    every = bench.select(F.col("item_id").cast("long"), "text").mapInArrow(cut_up, "item_id long, pos long, w string")
    return cut(every.select("item_id", F.xxhash64("item_id", "pos", "w").alias("window"), "w").distinct())


def blocks(windows: DataFrame, size: int, q: int = Q, edit_rate: float = EDIT_RATE):
    """How many blocks the windows of ``windows_table`` make, and a function that broadcasts the matcher of the i-th.

    A block has ``size`` windows or fewer.
    """
    small_batches(windows.sparkSession)
    n = -(-windows.count() // size)
    # Hashed blocks are binomial around their mean; half the size keeps each below the bound.
    n = n if n <= 1 else 2 * n

    def block(i: int):
        rows = windows.where(F.pmod(F.xxhash64("window", F.lit(11)), F.lit(n)) == i).collect()
        rows = sorted(((r["item_id"], r["window"], r["w"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        return windows.sparkSession.sparkContext.broadcast(Matcher(rows, q, edit_rate))

    return n, block


def leaks(docs: DataFrame, bench: DataFrame, size: int = BLOCK_WINDOWS, least: int = 1, shortest: int = SHORTEST) -> DataFrame:
    """Passages of benchmark items in documents, one row for each document and item that meet.

    Columns: ``doc_id, item_id, windows`` (different windows of the item found),
    ``item_windows`` (windows it has), ``edits`` (fewest of a window),
    ``first_char, last_char`` (region in the normalised text).

    Null and empty texts and null or empty items match nothing, nor do items of
    fewer than ``least`` normalised characters. Excerpts of ``shortest``
    characters and more are found whatever their offset. Rows that share a
    doc_id or an item_id (a null one too) count as one document or item, so
    repeated rows change nothing. Of equally near regions of a window the first
    counts. Texts are searched whole. An empty table on either side gives an
    empty result. Other columns are ignored. The result does not depend on
    ``size``, the windows searched at a time; with more of them than one block
    the hits of each are a table in the shared folder, which the caller owns.
    """
    kind = "doc_id long, item_id long, window long, edits long, first_char long, last_char long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = windows_table(bench, least, shortest)
    n, block = blocks(every, size)
    if not n:
        return rows.sparkSession.createDataFrame([], kind.replace("window long", "windows long, item_windows long"))
    parts = []
    for i in range(n):
        shared = block(i)
        part = rows.mapInArrow(_search(shared), kind)
        if n > 1:
            part = stored(part)
            shared.destroy()
        parts.append(part)
    found = functools.reduce(DataFrame.unionAll, parts)
    regions = [F.min("edits").alias("edits"), F.min("first_char").alias("first_char"), F.max("last_char").alias("last_char")]
    found = found.groupBy("doc_id", "item_id", "window").agg(*regions)
    found = found.groupBy("doc_id", "item_id").agg(F.count("*").alias("windows"), *regions)
    has = every.groupBy(F.col("item_id").alias("of")).agg(F.count("*").alias("item_windows"))
    return found.join(has, F.col("item_id").eqNullSafe(F.col("of"))).select(
        "doc_id", "item_id", "windows", "item_windows", "edits", "first_char", "last_char"
    )


def _search(shared):
    def run(batches):
        m = shared.value
        for b in trimmed(batches):
            out = []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1)):
                out += [(doc, *m.every[w][:2], cost, s, e) for w, s, e, cost in m.find(t.as_py())]
            cols = list(zip(*out)) or [()] * 6
            names = ["doc_id", "item_id", "window", "edits", "first_char", "last_char"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    return run


def clean(docs: DataFrame, bench: DataFrame, size: int = BLOCK_WINDOWS, least: int = 1, shortest: int = SHORTEST) -> DataFrame:
    """The rows of ``docs`` without a passage of ``bench``, columns as they are; no shuffle.

    Rows with a null or empty text stay, and all rows where ``bench`` is empty or
    has no text; repeated rows stay or go together; an empty table stays empty.
    With several blocks what each leaves is a table in the shared folder; the
    last one is the caller's.
    """
    n, block = blocks(windows_table(bench, least, shortest), size)
    text, before = docs.columns.index("text"), None
    for i in range(n):
        shared = block(i)
        docs = docs.mapInArrow(_without(shared, text), docs.schema)
        if n > 1:
            docs = stored(docs)
            shared.destroy()
            if before is not None:
                discard(before)
            before = docs
    return docs


def _without(shared, text: int):
    def run(batches):
        for b in trimmed(batches):
            keep = np.array([not shared.value.find(t.as_py()) for t in b.column(text)], bool)
            yield b.filter(pa.array(keep))

    return run
