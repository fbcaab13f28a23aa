"""Alignment of two tokenizers against brute force with the libraries on whole texts."""

import collections
import hashlib

import numpy as np
import pytest

from sparkraster.llm import queries, token_alignment

SF = "/root/testdata/sf0.001"


def libraries():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def byte_alphabet():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def ranges(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(rows):
    a, b = libraries()
    back = byte_alphabet()
    found, counts = [], collections.Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        want = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            found.append((doc_id, [], [], [], []))
            continue
        ra, rb = ranges(bytes_a), ranges(bytes_b)
        links, j0 = [], 0
        for i, (s, e) in enumerate(ra):
            while rb[j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(rb) and rb[j][0] < e:
                links.append((ids_a[i], ids_b[j]))
                j += 1
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, ia, ib = [], 0, 0
        for cut in cuts:
            ga, gb = [], []
            while ia < len(ra) and ra[ia][1] <= cut:
                ga.append(ids_a[ia])
                ia += 1
            while ib < len(rb) and rb[ib][1] <= cut:
                gb.append(ids_b[ib])
                ib += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        found.append((doc_id, ids_a, ids_b, groups, links))
        counts.update(set(links))
    highest = {}
    for (x, _), n in counts.items():
        highest[x] = max(highest.get(x, 0), n)
    return collections.Counter(
        (
            i, len(ia), len(ib), len(g), len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(";".join(g).encode()).hexdigest() if g else "",
        )
        for i, ia, ib, g, links in found
    )


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert collections.Counter(tuple(r) for r in queries.op11_token_alignment(spark, SF).collect()) == brute(rows)


ODD = [
    (1, None), (2, ""), (3, " "), (4, "\n"), (5, "a"), (5, "a"), (None, "two  blanks"), (6, " led"), (7, "line\nnext\n\nlast\n"), (8, "x▁y"),
    (9, "<s> <|endoftext|> </s><unk> <0x41>"), (10, "café 你好 \U0001f600  z"), (11, "tab\tand\r\nreturn\x0b"), (12, "nul\x00byte"),
    (13, "é ﬁ Ⅳ"), (14, "word " * 60_000), (15, "q" * 20_000), (16, "don't can't 1234567 3.14159, (x)"), (17, "́x ​ y"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 AS uid", "2 AS n_a", "3 AS pairs", "4 AS `row`")
    assert collections.Counter(tuple(r) for r in token_alignment.compare(df).collect()) == brute(ODD)
    assert token_alignment.compare(df.where("false")).count() == 0
    kept = token_alignment.align(df, keep=["doc_id", "text", "row"])
    assert kept.select("row.*", "uid").columns == ["doc_id", "text", "row", "uid"] and kept.count() == len(ODD)


def test_many_buckets_passes_and_strips(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "BUCKET", 300)
    monkeypatch.setattr(token_alignment, "PENDING", 500)
    monkeypatch.setattr(token_alignment, "STRIP", 3)
    monkeypatch.setattr(token_alignment, "PASS_BYTES", 4000)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()] + ODD
    got = token_alignment.compare(spark.createDataFrame(rows, "doc_id long, text string"))
    assert collections.Counter(tuple(r) for r in got.collect()) == brute(rows)


@pytest.mark.parametrize("strip", [1, 4, 64])
def test_gallop_and_overlaps(monkeypatch, strip):
    monkeypatch.setattr(token_alignment, "STRIP", strip)
    d = np.random.default_rng(strip)
    for _ in range(200):
        end = int(d.integers(1, 400))
        a, b = (np.append(np.flatnonzero(d.random(end - 1) < d.random()) + 1, end) for _ in range(2))
        place, common = token_alignment.gallop(a, b)
        assert (place == np.searchsorted(b, a)).all() and (common == np.isin(a, b)).all()
        in_a, in_b, first, last = token_alignment.overlaps(a, b)
        assert (a[in_a] == b[in_b]).all() and set(a[in_a]) == set(a) & set(b)
        starts_a, starts_b = np.concatenate([[0], a[:-1]]), np.concatenate([[0], b[:-1]])
        meet = (starts_a[:, None] < b[None, :]) & (starts_b[None, :] < a[:, None])
        want = np.zeros_like(meet)
        for i, (x, y) in enumerate(zip(first, last)):
            want[i, x:y] = True
        assert (meet == want).all()
    assert token_alignment.gallop(np.empty(0, np.int64), a)[0].shape == (0,)
