"""Token counts of a SentencePiece BPE model by the whole-token shortcut.

The model joins symbols by merges only into pieces of its vocabulary. Two facts
about the vocabulary are proved when a worker loads the model: no piece holds a
word mark after another character, and none of more than one character holds a
newline. So no merge crosses the start of a word mark run or a newline, the text
falls into pre-tokens there, and the counts of the pre-tokens add up. It is also
found then which vocabulary strings encode alone as one token; a pre-token among
them counts 1 directly, and only the rest is merged by the library, once for
each different pre-token while it is remembered.

A vocabulary that lacks one of the two properties, and a text that the model
normalises to anything but itself, is encoded whole by the library.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from sparkraster.llm.shared import for_worker, texts_of, trimmed, with_text

MARK = "▁"
#: Remembered pre-tokens of a worker; the memory is emptied when it is full.
REMEMBERED = 300_000
#: Characters of a remembered pre-token at most, so that a full memory holds tens of MB whatever the texts are.
LONGEST = 64


def model_path(model: str) -> str:
    """A file of the public tokenizers by its name, or a path as it is."""
    if os.path.isabs(model):
        return model
    import public_tokenizers

    return public_tokenizers.path(model)


class Counter:
    """Counts tokens of texts for one model."""

    def __init__(self, model: str, remembered: int = REMEMBERED):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path(model))
        self.remembered = remembered
        ids = range(self.sp.vocab_size())
        special = (self.sp.is_control, self.sp.is_unknown, self.sp.is_byte, self.sp.is_unused)
        pieces = [self.sp.id_to_piece(i) for i in ids if not any(f(i) for f in special)]
        self.splits = not any(MARK in p.lstrip(MARK) or ("\n" in p and len(p) > 1) for p in pieces)
        self.newline = len(self.sp.encode("\n"))
        self.one_newline = self.newline - len(self.sp.encode(" ")) if self.splits else 0
        self.marked: dict[str, int] = {}
        self.bare: dict[str, int] = {}
        if self.splits:
            self._prove(pieces)

    def _prove(self, pieces: list[str]) -> None:
        """Which vocabulary strings are one token when they are encoded alone."""
        marked = [p[1:] for p in pieces if p.startswith(MARK) and MARK not in p[1:]]
        bare = [p for p in pieces if MARK not in p and "\n" not in p]
        self.whole_marked = {w: 1 for w, x in zip(marked, self.sp.encode(marked, num_threads=1)) if w and len(x) == 1}
        alone = self.sp.encode(["\n" + w for w in bare], num_threads=1)
        self.whole_bare = {w: 1 for w, x in zip(bare, alone) if len(x) - self.newline == 1}
        # The newline itself and a lone mark (blanks before a newline or at the end).
        self.one_newline = len(self.sp.encode("\n\n")) - self.newline
        self.whole_marked[""] = len(self.sp.encode("\n ")) - self.newline
        self.whole_bare[""] = 0
        self.marked, self.bare = dict(self.whole_marked), dict(self.whole_bare)

    def _sum(self, words: list[str], known: dict[str, int], bare: bool) -> int:
        try:
            return sum(map(known.__getitem__, words))
        except KeyError:
            pass
        if len(known) > self.remembered + 40_000:
            known.clear()
            known.update(self.whole_bare if bare else self.whole_marked)
        new, long = [w for w in dict.fromkeys(words) if w not in known], {}
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            got = self.sp.encode(["\n" + w for w in some] if bare else some, num_threads=1)
            for w, x in zip(some, got):
                (known if len(w) <= LONGEST else long)[w] = len(x) - (self.newline if bare else 0)
        return sum(map(known.__getitem__, words)) if not long else sum(long[w] if w in long else known[w] for w in words)

    def count(self, text: str | None) -> int:
        """Tokens of ``text`` as the library counts them; null is empty."""
        if not text:
            return 0
        if not self.splits or self.sp.normalize(text) != MARK + text.replace(" ", MARK):
            return len(self.sp.encode(text))
        if text[0] == " " or "  " in text or MARK in text:
            return self._count_runs(text)
        lines = text.split("\n")
        first = [x.split(" ") for x in lines]
        starts = [x[0] for x in first[1:]]
        words = first[0]
        for x in first[1:]:
            words += x[1:]
        return self._sum(words, self.marked, False) + self._sum(starts, self.bare, True) + self.one_newline * (len(lines) - 1)

    def _count_runs(self, text: str) -> int:
        """As ``count`` where runs of marks occur; they are part of the pre-token that they begin."""
        units = re.findall(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n", MARK + text.replace(" ", MARK))
        lines = units.count("\n")
        bare = [u for u in units if u[0] != MARK and u != "\n"]
        marked = [u[1:] for u in units if u[0] == MARK]
        single = [u for u in marked if MARK not in u]
        runs = [u.replace(MARK, " ") for u in marked if MARK in u]
        return (
            self._sum(single, self.marked, False) + self._sum(bare, self.bare, True) + self.one_newline * lines
            + sum(len(x) for x in (self.sp.encode(runs, num_threads=1) if runs else []))
        )


def count_tokens(
    docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` (default ``doc_id``), ``n_bytes, n_tokens, over_limit`` of every document.

    Null texts count as empty: no bytes and no tokens. Texts are counted whole;
    repeated rows have a result each; an empty table gives none. Begin, end or
    special tokens are not added, and their strings inside a text are text.
    """
    wanted = with_text(docs, keep)

    def run(batches):
        counter = for_worker(("token counts", model), lambda: Counter(model))
        for b in trimmed(batches, keeps=True):
            texts = texts_of(b)
            n_bytes = [t.as_buffer().size if t.is_valid else 0 for t in texts]
            n = np.fromiter((counter.count(t.as_py()) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["row", "n_bytes", "n_tokens", "over_limit"],
            )

    out = StructType([*wanted.select("row").schema.fields])
    out = out.add("n_bytes", LongType()).add("n_tokens", LongType()).add("over_limit", BooleanType())
    return wanted.mapInArrow(run, out).select("row.*", "n_bytes", "n_tokens", "over_limit")
