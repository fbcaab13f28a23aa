"""Alignment of the tokens of two tokenizers over the same bytes of a text.

Both token lists cover the bytes of blank + text, so each token has a byte range.
The end offsets of both lists are intersected by galloping: the shorter list
drives, and each of its offsets is looked for in the longer one from the place
where the last search ended, by steps that double and a binary search within the
last step. All strips of the shorter list gallop side by side as numpy columns.
Common ends cut the lists into groups. The place that a search ends at is a rank
in the other list, and differences of ranks are the ranges of overlapping tokens.

In how many documents a pair of ids is linked is counted over the corpus from the
distinct pairs of each document: in tasks first, then by pair. The counts are
written in buckets of a bounded number of pairs. A document's pairs go to the
buckets that hold their counts, each bucket is read by the tasks that need it,
and the sums come back by document. No count table is broadcast.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from sparkraster.llm.shared import for_worker, fresh_dir, open_fs, small_batches, stored, texts_of, trimmed, with_text
from sparkraster.llm.token_counts import MARK, model_path
from sparkraster.llm.token_output import VISIBLE, Encoder, tokenizer_path

#: Offsets of the shorter list that gallop one after the other; strips go side by side.
STRIP = 64
#: Pairs of a bucket of counts, about; a task holds one bucket at a time, 13 bytes a pair.
BUCKET = 4_000_000
#: Pairs that a task counts before it passes them on.
PENDING = 2_000_000
#: Words that B encodes in one call of its library; longer texts take longer for a word.
CHUNK = 64
#: Characters below it have the same class in all versions of Unicode.
STABLE = "\u0370"
#: Pre-tokens of byte-level BPE, as its library splits them (a fixed value).
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of texts whose tokens are aligned in one pass.
PASS_BYTES = 2 << 20


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the ascending ``short``: how many of the ascending ``long`` are smaller, and whether it is among them."""
    n, m = len(short), len(long)
    if not n or not m:
        return np.zeros(n, np.int64), np.zeros(n, bool)
    strips = -(-n // STRIP)
    some = np.full(strips * STRIP, short[-1], np.int64)
    some[:n] = short
    some = some.reshape(strips, STRIP)
    ended = np.zeros((strips, STRIP), np.int64)
    at = np.searchsorted(long, some[:, 0])  # where a strip begins
    padded = np.append(long, np.iinfo(np.int64).max)
    for i in range(STRIP):
        x = some[:, i]
        # Steps double until the offset there is not smaller any more.
        low, high, step = at, at, 1
        behind = padded[high] < x
        while behind.any():
            low = np.where(behind, high + 1, low)
            high = np.where(behind, np.minimum(high + step, m), high)
            step *= 2
            behind = padded[high] < x
        # A binary search within the last step.
        while (low < high).any():
            middle = (low + high) // 2
            less = padded[middle] < x
            low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
        at = low
        ended[:, i] = low
    place = ended.ravel()[:n]
    return place, padded[place] == short


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places of common ends in A, in B, first and last + 1 token of B that each token of A overlaps).

    Both lists ascend and end at the same offset.
    """
    swapped = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if swapped else (ends_a, ends_b)
    place, common = gallop(short, long)
    in_short, in_long = np.flatnonzero(common), place[common]
    # Token i of the short list overlaps the long one's from the first that ends behind its start to the first that ends at or behind its end.
    first = np.concatenate([[0], (place + common)[:-1]])
    last = place + 1
    if not swapped:
        return in_short, in_long, first, last
    # From the view of the long list: the tokens whose ranges reach it.
    own = np.arange(len(long))
    return in_long, in_short, np.searchsorted(last, own, "right"), np.searchsorted(first, own, "right")


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces flat[start : start + size], one after the other."""
    return flat[np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]


def _by_ranks(tok, entry: list[bytes]):
    """An encoder by ranks that equals the byte-level BPE ``tok`` on texts below ``STABLE``, or None where that is not proved.

    Its merges must come in the order of the ids they make, and each single byte
    must be a token; then the rank of a merge is the id of its result.
    """
    import tiktoken

    model = json.loads(tok.to_str())["model"]
    made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
    added = tok.get_added_tokens_decoder()
    ranks = {x: i for i, x in enumerate(entry) if i not in added}
    single = {bytes([i]) for i in range(256)}
    if None in made or any(x >= y for x, y in zip(made, made[1:])) or len(ranks) != len(model["vocab"]) or len(made) + 256 != len(ranks):
        return None
    if not single <= ranks.keys() or max(ranks[x] for x in single) >= made[0]:
        return None
    return tiktoken.Encoding("ranks", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


class Units:
    """Alignments of units (words, or whole texts) by their code: numbers, linked pairs and written groups."""

    def __init__(self):
        self.numbers = np.empty((0, 4), np.int64)  # n_a, n_b, n_groups, n_links
        self.pairs, self.written = np.empty(0, np.int64), []

    def __len__(self) -> int:
        return len(self.written)

    @property
    def start(self) -> np.ndarray:
        return np.cumsum(self.numbers[:, 3]) - self.numbers[:, 3]

    def joined(self, other: Units) -> Units:
        out = Units()
        out.numbers, out.pairs = np.concatenate([self.numbers, other.numbers]), np.concatenate([self.pairs, other.pairs])
        out.written = self.written + other.written
        return out

    def chosen(self, codes: np.ndarray) -> Units:
        out = Units()
        out.numbers = self.numbers[codes]
        out.pairs = _gather(self.pairs, self.start[codes], out.numbers[:, 3])
        out.written = [self.written[i] for i in codes.tolist()]
        return out


class Codes(dict):
    """Codes of the words that are kept; other words get the codes behind them, until they are kept or dropped."""

    def __init__(self):
        super().__init__()
        self.new: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        return self.new.setdefault(word, len(self) + len(self.new))


class Tokens:
    """Tokens of texts for a byte-level tokenizer A (text after a blank) and a SentencePiece model B, and their alignment.

    Neither joins symbols over the start of a blank or a newline, which is proved
    for the vocabulary of B when it is loaded (see ``token_counts``) and holds
    for pre-tokens of A (see ``token_output``). So a word, with the blank or the
    newline before it, begins and ends at common ends, and the alignment of a
    text is that of its words. New words of a pass are encoded and aligned
    together, by the libraries and by galloping; those seen before are kept. When
    there are more than ``KEPT``, the half used least is dropped. Texts with other white space, and models without this
    property, are one unit as a whole.
    """

    KEPT = 250_000
    LONGEST = 64
    SEEN = 1 << 22

    def __init__(self, a: str, b: str):
        import sentencepiece

        self.a = Encoder(a, bound=1 << 20)
        self.a.tok.encode_special_tokens = True
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path(b))
        n = self.sp.vocab_size()
        self.size_a, self.size_b = self.a.tok.get_vocab_size(), n
        back = {c: x for x, c in VISIBLE.items()}
        entry = (self.a.tok.id_to_token(i) or "" for i in range(self.size_a))
        self.bytes_a = [bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in entry]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(map(self.sp.id_to_piece, range(n)))]
        self.length_a, self.length_b = (np.array([len(x) for x in entry], np.int64) for entry in (self.bytes_a, self.bytes_b))
        self.begins_a, self.begins_b = ({c: np.array([x[:1] == c for x in entry]) for c in (b" ", b"\n")} for entry in (self.bytes_a, self.bytes_b))
        special = (self.sp.is_control, self.sp.is_unknown, self.sp.is_byte, self.sp.is_unused)
        pieces = [self.sp.id_to_piece(i) for i in range(n) if not any(f(i) for f in special)]
        self.by_word = self.a.by_word and not any(MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1) for p in pieces)
        # Decimal ids with the sign that follows them: within the group, at its end, at the end of B's list.
        digits_a, digits_b = [b"%d" % i for i in range(self.size_a)], [b"%d" % i for i in range(n)]
        self.signed = [*(d + b"," for d in digits_a), *(d + b"|" for d in digits_a), *(d + b"," for d in digits_b), *(d + b";" for d in digits_b), *digits_b]
        self.codes, self.kept, self.seen, self.uses = Codes(), Units(), bytearray(self.SEEN), np.empty(0, np.int64)
        self.fast = _by_ranks(self.a.tok, self.bytes_a) if self.by_word else None

    def _library_a(self, text: str) -> np.ndarray:
        return np.frombuffer(self.a._library(text), "<u4").astype(np.int64)

    def _library_b(self, text: str) -> np.ndarray:
        return np.array(self.sp.encode(text), np.int64)

    @staticmethod
    def _covers(ids: np.ndarray, entry: list[bytes], text: bytes) -> bool:
        return b"".join([entry[i] for i in ids.tolist()]) == text

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of blank + text by A and of text by B; None where their bytes are not those of blank + text."""
        a, b, want = self._library_a(" " + text), self._library_b(text), (" " + text).encode()
        return (a, b) if self._covers(a, self.bytes_a, want) and self._covers(b, self.bytes_b, want) else None

    def units_of(self, text: str) -> list[str] | None:
        """The words of ``text`` with the newline before them, if there is one; None where it has to be encoded whole."""
        if not self.by_word or self.sp.normalize(text) != MARK + text.replace(" ", MARK):
            return None
        if "  " in text or "\n\n" in text or "\n " in text or " \n" in text or text[0] in " \n" or text[-1] in " \n":
            return None
        return text.replace("\n", " \n").split(" ")

    def _new_units(self, words: list[str]) -> Units:
        """Alignments of new words; n_a is -1 where a word has to be encoded with its text."""
        # Other white space within a word may be cut off from it with a blank or newline.
        ok = [True] * len(words)
        if " ".join(words).split() != [w.removeprefix("\n") for w in words]:
            ok = [w.split() == [w.removeprefix("\n")] for w in words]
        parts = []
        for sign, first in ((" ", 0), ("\n", 1)):
            own = [i for i, w in enumerate(words) if ok[i] and (w[0] == "\n") == bool(first)]
            plain = [words[i].isascii() or max(words[i]) < STABLE for i in own]
            for some in ([i for i, x in zip(own, plain) if x], [i for i, x in zip(own, plain) if not x]):
                if not some:
                    continue
                parts.append((some, *self._split(sign, [words[i][first:] for i in some])))
        out = Units()
        out.numbers = np.zeros((len(words), 4), np.int64)
        out.numbers[:, 0] = -1
        where = np.concatenate([np.array(p[0], np.int64)[p[5]] for p in parts]) if parts else np.empty(0, np.int64)
        if len(where):
            found = self.align(*[np.concatenate([p[k] for p in parts]) for k in (1, 2, 3, 4)])
            order = np.argsort(where)
            found = found.chosen(order)
            out.numbers[where[order]] = found.numbers
            out.pairs = found.pairs
            out.written = [b""] * len(words)
            for i, w in zip(where[order].tolist(), found.written):
                out.written[i] = w
        else:
            out.written = [b""] * len(words)
        return out

    def _split(self, sign: str, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A, of B, numbers of ids by word in A, in B, places of the words taken) of words with ``sign`` before them.

        They are encoded as one text and cut where a token begins with the sign.
        Each word's tokens must cover its bytes; else it is left out.
        """
        text = sign + sign.join(words)
        ids = self.fast.encode_ordinary(text) if self.fast and (text.isascii() or max(text) < STABLE) else self._library_a(text)
        sides = [(np.asarray(ids, np.int64), self.begins_a, self.bytes_a, self.length_a)]
        # B puts a blank before each text by itself.
        chunks = [sign.join(words[i : i + CHUNK]) for i in range(0, len(words), CHUNK)]
        chunks = self.sp.encode(chunks if sign == " " else [sign + c for c in chunks], num_threads=1)
        ids = itertools.chain.from_iterable(chunks if sign == " " else (x[1:] for x in chunks))
        sides.append((np.fromiter(ids, np.int64), self.begins_b, self.bytes_b, self.length_b))
        size = np.array([len(w.encode()) + 1 for w in words])
        cut, good = [], True
        for ids, begins, entry, length in sides:
            at = np.flatnonzero(begins[sign.encode()][ids])
            good = good and len(at) == len(words) and len(at) > 0 and at[0] == 0 and np.array_equal(np.add.reduceat(length[ids], at), size)
            good = good and self._covers(ids, entry, text.encode())
            cut.append(np.diff(np.append(at, len(ids))))
        if good:
            return sides[0][0], sides[1][0], cut[0], cut[1], np.arange(len(words))
        if len(words) == 1:
            none = np.empty(0, np.int64)
            return none, none, none, none, none
        half = len(words) // 2
        x, y = self._split(sign, words[:half]), self._split(sign, words[half:])
        return tuple(np.concatenate([p, q + half if k == 4 else q]) for k, (p, q) in enumerate(zip(x, y)))

    def align(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> Units:
        """Alignments of units with the ids ``a`` and ``b``, ``n_a`` and ``n_b`` of them in each; both cover the unit's bytes."""
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        cut_a, cut_b, first, last = overlaps(ends_a, ends_b)
        out = Units()
        n_groups = np.diff(np.searchsorted(cut_a, np.concatenate([[0], last_a])))
        size = last - first
        n_links = np.diff(np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], last_a])])
        out.numbers = np.stack([n_a, n_b, n_groups, n_links], 1)
        link_b = np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        out.pairs = np.repeat(a * self.size_b, size) + b[link_b]
        out.written = self._write(a, b, cut_a, cut_b, last_a, last_b)
        return out

    def _write(self, a, b, cut_a, cut_b, last_a, last_b) -> list[bytes]:
        """The groups of each unit as a1,a2|b1;a3|b2,b3."""
        before_a = np.concatenate([[0], cut_b + 1])  # B tokens in the groups before
        kind_a, kind_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        kind_a[cut_a], kind_b[cut_b] = 1, 1
        kind_b[last_b - 1] = 2
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + before_a[np.searchsorted(cut_a, np.arange(len(a)))]] = kind_a * self.size_a + a
        out[np.arange(len(b)) + (cut_a + 1)[np.searchsorted(cut_b, np.arange(len(b)))]] = 2 * self.size_a + kind_b * self.size_b + b
        signed, written, start = list(map(self.signed.__getitem__, out.tolist())), [], 0
        for end in (last_a + last_b).tolist():
            written.append(b"".join(signed[start:end]))
            start = end
        return written

    def texts(self, texts: list[str | None]) -> tuple[Units, np.ndarray, np.ndarray]:
        """(units, codes of the units of all texts, how many units each text has); texts without tokens have none."""
        by_text = [self.units_of(t) if t and MARK not in t else None for t in texts]
        words = [w for x in by_text if x for w in x]
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        new, used = list(self.codes.new), codes
        found = self._new_units(new)
        units = self.kept.joined(found)
        many = np.array([len(x or ()) for x in by_text], np.int64)
        bad = np.flatnonzero(units.numbers[codes, 0] < 0)
        ends = np.cumsum(many)
        whole = {i: None for i, (t, x) in enumerate(zip(texts, by_text)) if t and MARK not in t and x is None}
        whole |= dict.fromkeys(np.unique(np.searchsorted(ends, bad, "right")).tolist())
        if whole:
            got = {i: x for i in whole if (x := self._whole(texts[i])) is not None}
            keep = ~np.isin(np.repeat(np.arange(len(texts)), many), list(whole))
            base, parts = len(units), list(got.values())
            if parts:
                n_a, n_b = (np.array([len(x[k]) for x in parts], np.int64) for k in (0, 1))
                units = units.joined(self.align(np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts]), n_a, n_b))
            doc = np.concatenate([np.repeat(np.arange(len(texts)), many)[keep], np.array(list(got), np.int64)])
            order = np.argsort(doc, kind="stable")
            codes = np.concatenate([codes[keep], base + np.arange(len(parts))])[order]
            many = np.bincount(doc, minlength=len(texts))
        self._keep(new, found, used)
        return units, codes, many

    def _keep(self, new: list[str], found: Units, used: np.ndarray) -> None:
        """Keeps the new words that were seen in an earlier pass."""
        bits = [hash(w) & (self.SEEN - 1) for w in new]
        again = [i for i, bit in enumerate(bits) if self.seen[bit] and len(new[i]) <= self.LONGEST]
        for bit in bits:
            self.seen[bit] = 1
        self.codes.new = {}
        self.uses += np.bincount(used, minlength=len(self.kept))[: len(self.kept)]
        if len(self.kept) + len(again) > self.KEPT:
            best = np.sort(np.argsort(-self.uses, kind="stable")[: self.KEPT // 2])
            place = dict(zip(best.tolist(), range(len(best))))
            words = {w: place[i] for w, i in self.codes.items() if i in place}
            self.kept, self.uses, self.seen = self.kept.chosen(best), self.uses[best] // 2, bytearray(self.SEEN)
            self.codes.clear()
            self.codes.update(words)
        again = again[: self.KEPT - len(self.kept)]
        if again:
            base = len(self.kept)
            self.codes.update((new[i], base + n) for n, i in enumerate(again))
            self.kept = self.kept.joined(found.chosen(np.array(again)))
            self.uses = np.concatenate([self.uses, np.zeros(len(again), np.int64)])


def aligned(tokens: Tokens, texts: list) -> dict[str, object]:
    """Numbers and linked pairs of the texts of one pass.

    ``n_a, n_b, n_groups, n_links`` and ``sha`` have an entry for each text;
    ``pair`` and ``times`` are the distinct pairs of all texts and how often they
    are linked there, and ``ends`` says where those of each text end. A pair is
    a * ids of B + b.
    """
    units, codes, many = tokens.texts(texts)
    doc = np.repeat(np.arange(len(texts)), many)
    numbers = units.numbers[codes]
    sums = [np.bincount(doc, numbers[:, k], len(texts)).astype(np.int64) for k in range(4)]
    key = _gather(units.pairs, units.start[codes], numbers[:, 3])
    all_pairs = tokens.size_a * tokens.size_b
    both = np.sort(np.repeat(doc * all_pairs, numbers[:, 3]) + key)
    new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.empty(0, np.int64)
    doc_of, pair = np.divmod(both[new], all_pairs)
    written, sha, start = list(map(units.written.__getitem__, codes.tolist())), [], 0
    for end in np.cumsum(many).tolist():
        sha.append(hashlib.sha256(b";".join(written[start:end])).hexdigest() if end > start else "")
        start = end
    return {
        "n_a": sums[0], "n_b": sums[1], "n_groups": sums[2], "n_links": sums[3], "sha": sha, "pair": pair,
        "times": np.diff(np.append(new, len(both))), "ends": np.searchsorted(doc_of, np.arange(len(texts)), "right"),
    }


def _passes(rows, texts):
    """Slices of a batch of about ``PASS_BYTES`` of text, one text at least."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        size = t.as_buffer().size if t.is_valid else 0
        if i > begin and held + size > PASS_BYTES:
            yield rows.slice(begin, i - begin), texts.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if len(texts) > begin:
        yield rows.slice(begin), texts.slice(begin)


def _binaries(values: np.ndarray, ends: np.ndarray, kind: str) -> pa.Array:
    data = values.astype(kind)
    offsets = np.concatenate([[0], ends]).astype(np.int32) * data.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


@functools.cache
def sizes(a: str, b: str) -> tuple[int, int]:
    """How many ids the two tokenizers have."""
    import sentencepiece
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(a)).get_vocab_size(), sentencepiece.SentencePieceProcessor(model_file=model_path(b)).vocab_size()


def pair_type(a: str, b: str) -> str:
    """numpy type of a pair, a * ids of B + b."""
    size_a, size_b = sizes(a, b)
    return "<u4" if size_a * size_b < 1 << 32 else "<i8"


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", keep: list[str] | None = None) -> DataFrame:
    """Groups and links of the tokens of each document, and its distinct linked pairs; a table of its own.

    Columns: ``row`` (a struct of ``keep``, default ``doc_id``), ``uid`` (tells rows apart), ``n_a,
    n_b, n_groups, n_links, groups_sha256``, ``pairs`` (a * ids of B + b, of ``pair_type``,
    ascending) and ``times`` (uint32, links of each pair) as little-endian
    bytes. Texts are encoded whole, without special tokens, whose strings are
    plain text. A text has no tokens where it is null or empty, or where the
    bytes of either token list are not those of blank + text: all numbers are 0
    and the sum is ''. Repeated rows have a row each, an empty table gives none;
    other columns may have any name.
    """
    wanted, kind = with_text(docs, keep), pair_type(a, b)

    def run(batches):
        tokens = for_worker(("alignment", a, b), lambda: Tokens(a, b))
        uid = itertools.count(TaskContext.get().partitionId() << 40)
        for batch in trimmed(batches, keeps=True):
            for rows, texts in _passes(batch.column(0), texts_of(batch)):
                x = aligned(tokens, texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows, pa.array([next(uid) for _ in range(len(rows))], pa.int64()), pa.array(x["n_a"]), pa.array(x["n_b"]), pa.array(x["n_groups"]),
                        pa.array(x["n_links"]), pa.array(x["sha"], pa.string()), _binaries(x["pair"], x["ends"], kind), _binaries(x["times"], x["ends"], "<u4"),
                    ],
                    names=["row", *NAMES],
                )

    out = StructType([*wanted.select("row").schema.fields])
    for name in NAMES[:5]:
        out = out.add(name, LongType())
    out = out.add("groups_sha256", StringType()).add("pairs", "binary").add("times", "binary")
    return stored(wanted.mapInArrow(run, out), group=32 << 20)


NAMES = ["uid", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def pair_counts(found: DataFrame, a: str, b: str) -> DataFrame:
    """``pair, n, best`` of all pairs of ids: how many documents hold it linked, and whether no pair of its A id has more."""

    kind = pair_type(a, b)

    def count(batches):
        held, pending, counts = 0, [], []

        def flush():
            pair, where = np.unique(np.concatenate(pending), return_inverse=True)
            return pair, np.bincount(where, np.concatenate(counts), len(pair)).astype(np.int64)

        for b in trimmed(batches):
            some = np.frombuffer(b"".join(b.column(0).to_pylist()), kind)
            pending.append(some)
            counts.append(np.ones(len(some), np.int64))
            held += len(some)
            if held > PENDING:
                pair, n = flush()
                if len(pair) > PENDING // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n)], names=["pair", "n"])
                    pair, n = pair[:0], n[:0]
                pending, counts, held = [pair], [n], len(pair)
        if held:
            pair, n = flush()
            for at in range(0, len(pair), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(pair[at : at + (1 << 17)], pa.int64()), pa.array(n[at : at + (1 << 17)])], names=["pair", "n"])

    pairs = stored(found.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")))
    # An A id has at most as many pairs as B has ids, and there is a row for each A id.
    id_a = F.expr(f"pair div {sizes(a, b)[1]}")
    highest = pairs.groupBy(id_a.alias("a")).agg(F.max("n").alias("highest"))
    return pairs.withColumn("a", id_a).join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _bucket_table(counts: DataFrame) -> tuple[str, int]:
    """Folder of the counts in buckets of about ``BUCKET`` pairs, by pair modulo their number, and that number."""
    spark = counts.sparkSession
    kept = stored(counts)
    buckets = max(1, -(-kept.count() // BUCKET))
    folder = fresh_dir(spark, "pairs")

    dealt = kept.withColumn("bucket", F.pmod("pair", F.lit(buckets)).cast("int"))
    dealt.write.partitionBy("bucket").parquet(folder)
    return folder, buckets


def _load_bucket(folder: str, bucket: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs ascending, counts, best) of a bucket."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    system, path = open_fs(f"{folder}/bucket={bucket}")
    files = [f.path for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")]
    parts = [pq.ParquetFile(system.open_input_file(f)).read() for f in sorted(files)]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    table = pa.concat_tables(parts)
    pair, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair, kind="stable")
    return pair[order], n[order], best[order]


def scored(found: DataFrame, counts: DataFrame, a: str, b: str) -> DataFrame:
    """``uid, n_best, count_sum`` of the rows of ``align`` with a link.

    n_best: links whose count is the highest of their A id in the corpus, ties
    included; count_sum: the counts of all links.
    """
    folder, buckets = _bucket_table(counts)
    of_pair = pair_type(a, b)

    def split(batches):
        for b in batches:
            out = []
            for uid, pairs, times in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                pair, n = np.frombuffer(pairs.as_buffer(), of_pair), np.frombuffer(times.as_buffer(), "<u4")
                where = pair % buckets
                for bucket in np.unique(where).tolist():
                    own = where == bucket
                    out.append((bucket, uid, pair[own].tobytes(), n[own].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds], names=["bucket", "uid", "pairs", "times"])

    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())

    def look_up(batches):
        for b in trimmed(batches, keeps=True):
            uids, best, total = [], [], []
            for bucket, uid, pairs, times in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                known, count, is_best = for_worker(("pair counts", folder, bucket), lambda: _load_bucket(folder, bucket))
                n = np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
                at = np.searchsorted(known, np.frombuffer(pairs.as_buffer(), of_pair).astype(np.int64))
                uids.append(uid)
                best.append(int(n[is_best[at]].sum()))
                total.append(int((n * count[at]).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (uids, best, total)], names=["uid", "n_best", "count_sum"])

    rows = found.where("n_links > 0").select("uid", "pairs", "times")
    kind = "uid long, n_best long, count_sum long"
    if buckets == 1:
        return rows.select(F.lit(0).alias("bucket"), "uid", "pairs", "times").mapInArrow(look_up, kind)
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.mapInArrow(split, "bucket int, uid long, pairs binary, times binary").repartitionByRange(max(parts, 4 * buckets), "bucket", F.xxhash64("uid"))
    return dealt.sortWithinPartitions("bucket").mapInArrow(look_up, kind).groupBy("uid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def compare(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document; see ``align`` and ``scored``."""
    small_batches(docs.sparkSession)
    found = align(docs, a, b)
    sums = scored(found, pair_counts(found, a, b), a, b)
    numbers = found.select("uid", "row.doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return numbers.join(sums, "uid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )
