"""Lyndon roots and runs of words against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from sparkraster.llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"


def brute_lyndon(s):
    out = []
    for i in range(len(s)):
        words = (s[i : i + k] for k in range(1, len(s) - i + 1))
        out.append(max(len(w) for w in words if all(w < w[k:] for k in range(1, len(w)))))
    return out


def brute_runs(words, min_length, min_periods):
    """All maximal stretches of each period that have no smaller one."""
    n, found = len(words), []
    for q in range(1, n // min_periods + 1):
        begin = None
        for i in range(n - q + 1):
            same = i < n - q and words[i] == words[i + q]
            if same and begin is None:
                begin = i
            elif not same and begin is not None:
                length = i + q - begin
                st = words[begin : i + q]
                if length >= max(min_length, min_periods * q) and not any(all(st[x] == st[x + d] for x in range(length - d)) for d in range(1, q)):
                    found.append((begin, length, q))
                begin = None
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words, 24, 3)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_lyndon_lengths_equal_brute_force():
    rnd = random.Random(1)
    for _ in range(1500):
        s = [rnd.randrange(rnd.choice([1, 2, 3, 6])) for _ in range(rnd.randrange(0, 16))]
        assert periodic_runs.lyndon_lengths(s) == brute_lyndon(s)


def texts_with_runs(seed, n):
    rnd = random.Random(seed)
    for _ in range(n):
        k = rnd.choice([1, 2, 3, 9])
        w = [b"%d" % rnd.randrange(k) for _ in range(rnd.randrange(0, 90))]
        for _ in range(rnd.randrange(3)):
            if w:
                a, p = rnd.randrange(len(w)), rnd.randrange(1, 12)
                w[a:a] = w[a : a + p] * rnd.randrange(1, 7)
        yield w


@pytest.mark.parametrize("min_length", [3, 5, 12, 24])
def test_runs_equal_brute_force(min_length):
    for w in texts_with_runs(min_length, 400):
        got = [tuple(r) for r in periodic_runs.word_runs(w, min_length, 3).tolist()]
        assert got == brute_runs(w, min_length, 3)


def test_fibonacci_and_thue_morse_words():
    a, b, t = [b"a"], [b"a", b"b"], [b"a"]
    for _ in range(9):
        a, b = b, b + a
        t = t + [b"b" if x == b"a" else b"a" for x in t]
    assert [tuple(r) for r in periodic_runs.word_runs(b, 9, 3).tolist()] == brute_runs(b, 9, 3) != []
    assert [tuple(r) for r in periodic_runs.word_runs(t, 3, 3).tolist()] == brute_runs(t, 3, 3) == []


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect())
    assert got == sorted(brute_row(*r) for r in rows)
    assert sum(r[1] > 0 for r in got) > 10


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "x y"), (4, "x y"), (None, "a " * 24), (None, "a " * 23), (5, ("one two  three\n" * 9) + "two"), (6, "w " * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "2 AS collapsed", "3 AS `row`", "4 AS start")
    got = collections.Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic_runs.find_runs(df).collect())
    assert got == {
        (1, (), ""): 1, (2, (), ""): 1, (3, (), ""): 1, (4, (), "x y"): 2, (None, ((0, 24, 1),), "a"): 1, (None, (), " ".join("a" * 23)): 1,
        (5, ((0, 27, 3),), "one two three two"): 1, (6, ((0, 200_000, 1),), "w"): 1,
    }
    kept = periodic_runs.find_runs(df, keep=["doc_id", "runs", "text"])
    assert kept.columns == ["doc_id", "runs", "text", "runs", "collapsed"]
    assert periodic_runs.digests(periodic_runs.find_runs(df.where("false"))).count() == 0
    digests = {r.doc_id: r for r in periodic_runs.digests(periodic_runs.find_runs(df.where("doc_id IN (1, 5)"))).collect()}
    assert digests[1].runs_sha256 == digests[1].collapsed_sha256 == hashlib.sha256(b"").hexdigest() and digests[1].start is None
    assert tuple(digests[5])[1:6] == (1, 0, 27, 3, 9000)


def test_greatest_exponent_is_exact(spark):
    text = " ".join(["a b c d e f g h".split()[i % 8] for i in range(25)] + ["-"] + ["ijklmnopq"[i % 9] for i in range(28)] + ["+"] + ["rstuvwxy"[i % 8] for i in range(25)])
    row = periodic_runs.digests(periodic_runs.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (3, 0, 25, 8, 3125)


def test_stretches_hold_every_run():
    assert periodic_runs.gram_size(24) == 8
    for w in texts_with_runs(77, 300):
        h = np.array([hash(x) for x in w], np.int64).view(np.uint64)
        some = periodic_runs.stretches(h, 8)
        assert all(any(b <= s and s + k <= e for b, e in some) for s, k, _ in brute_runs(w, 24, 3))
