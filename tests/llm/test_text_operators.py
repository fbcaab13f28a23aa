"""Token output, token counts, quality, language and toxicity: exactness, held-out results and odd inputs."""

import random
import zlib

import numpy as np
import pytest

from sparkraster.llm import lang_id, quality, token_counts, token_output, toxicity

SF = "/root/testdata/sf0.001"
ODD = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "a"), (4, "a", "de", "b"), (4, "a", "de", "b"),
    (5, "12 34 --", "en", "b"), (None, "no id here", "en", "b"), (6, "long word " * 20_000, "en", "a"), (7, "ﬁ  日本 <s> </s> <|endoftext|>\r\n😀", None, None),
]
COLUMNS = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, COLUMNS)
    return df.selectExpr("*", "'x' AS row", "1 AS score", "2 AS n_tokens", "array(1) AS predicted")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def texts(n, seed):
    parts = ["a", "b", " ", "  ", "\n", "the", "é", "<s>", "\t", "\r\n", "\x00", "ﬁ", "日本", "😀", "<|endoftext|>", ".", ",", "'s", "ing", "▁", " x", "　", "12"]
    rnd = random.Random(seed)
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(12))) for _ in range(n)]


def test_token_counts_equal_the_library():
    c = token_counts.Counter("piece_bpe_32k.model", remembered=50)
    for t in texts(4000, 1):
        assert c.count(t) == len(c.sp.encode(t)), repr(t)


def test_long_pre_tokens_are_counted_and_not_kept():
    c = token_counts.Counter("piece_bpe_32k.model")
    before = sum(map(len, c.marked)) + sum(map(len, c.bare))
    words = [chr(97 + i % 26) * (60 + i % 9) + str(i) for i in range(300)]
    text = " ".join(words) + "\n" + "\n".join(words) + " " + words[0]
    for _ in range(2):
        assert c.count(text) == len(c.sp.encode(text))
    assert max(map(len, c.marked)) <= token_counts.LONGEST and max(map(len, c.bare)) <= token_counts.LONGEST
    assert sum(map(len, c.marked)) + sum(map(len, c.bare)) - before <= 2 * 300 * token_counts.LONGEST


def test_token_counts_of_odd_rows(odd):
    got = token_counts.count_tokens(odd, limit=10).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: r for r in got}
    assert (by[1].n_bytes, by[1].n_tokens, by[1].over_limit) == (0, 0, False)
    assert by[2].n_tokens == 0 and by[6].over_limit and by[6].n_bytes == 200_000


def test_encoder_equals_the_library():
    e = token_output.Encoder("byte_bpe_50k.json", bound=8_000)
    for t in texts(4000, 2):
        assert e.ids(t) == e._library(t), repr(t)


@pytest.mark.parametrize("top", [3, 300, 70_000, 2**24 + 5])
def test_code_round_trip(top):
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
        block = token_output.encode_ranks(ranks)
        many, size = (int(x) for x in np.frombuffer(block[:8], "<u4"))
        control = -(-many // 4)
        assert len(block) == 8 + control + size
        assert (token_output.decode_ranks(block[8 : 8 + control], block[8 + control :], many) == ranks).all()


def test_token_files_round_trip(spark, odd, docs, monkeypatch):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_output.tokenizer_path("byte_bpe_50k.json"))
    for df in (odd, docs):
        rows = sorted(((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        start, want = 0, []
        for i, t in rows:
            ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4")
            want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        got = [tuple(r) for r in token_output.round_trip(df).collect()]
        key = lambda r: (r[0] is not None, r[0] or 0, r[1])
        assert sorted(got, key=key) == sorted(want, key=key)


def test_token_files_of_nothing(spark):
    assert token_output.round_trip(spark.createDataFrame([], COLUMNS)).count() == 0


def test_quality_held_out(docs, labels):
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9


def test_quality_statistics():
    x = dict(zip(quality.FEATURES, quality.statistics("an internationally a an a an")))
    assert x["top_word"] == 3 / 6
    assert not quality.statistics(None).any() and not quality.statistics("").any()


def test_quality_trees_equal_search_of_all_splits():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((200, 4))
    x[:, 3] = x[:, 2]  # a tie: the first feature counts
    y = (x[:, 0] + np.abs(x[:, 2]) + 0.3 * rng.standard_normal(200) > 0.5).astype(float)
    m = quality.grow(x, y, trees=3, depth=3, bins=16, rate=0.5)
    assert 3 not in m.feature
    f_x = np.full(200, m.base)

    def split(rows, depth, g, h):
        """Adds the value of the leaf of each row, trying every feature and cut."""
        value = lambda r: g[r].sum() ** 2 / (h[r].sum() + 1)
        best = (1e-6, None)
        for f in range(4) if depth else ():
            for c in m.edges[f]:
                left, right = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                if min(len(left), len(right)) >= 12:
                    gain = value(left) + value(right) - value(rows)
                    if gain > best[0] + 1e-9:
                        best = (gain, (left, right))
        if best[1]:
            for side in best[1]:
                split(side, depth - 1, g, h)
        else:
            f_x[rows] -= 0.5 * g[rows].sum() / (h[rows].sum() + 1)

    for _ in range(3):
        p = 1 / (1 + np.exp(-f_x))
        split(np.arange(200), 3, p - y, p * (1 - p))
    assert np.allclose(m.score(x), 1 / (1 + np.exp(-f_x)))


def test_quality_held_out_by_label(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.predicted for r in got if r.quality == x] for x in (1, 0))
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def test_trees_equal_a_walk():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, len(quality.FEATURES)))
    y = (x[:, 0] + x[:, 1] > 0).astype(float)
    m = quality.grow(x, y, trees=10)
    b = m.bins(x)

    def walk(row, node):
        while m.child[node] != node:
            node = m.child[node] + (row[m.feature[node]] > m.cut[node])
        return m.value[node]

    want = [1 / (1 + np.exp(-(m.base + sum(walk(r, t) for t in m.roots)))) for r in b]
    assert np.allclose(m.score(x), want) and ((m.score(x) > 0.5) == (y == 1)).mean() > 0.95


def test_classifiers_of_odd_rows(spark, odd, labels):
    none = labels.where("false")
    for f in (lambda d, n: quality.classify(d, n), lambda d, n: toxicity.detect(d, n)):
        for n in (labels, none):
            got = f(odd, n).collect()
            assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
        assert f(odd.where("false"), none).count() == 0
    got = {r.doc_id: r for r in lang_id.identify(odd).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[5].lang_pred == "und" and got[1].score == 0
    assert lang_id.identify(odd.where("false")).count() == 0


def test_language_held_out(docs):
    got = lang_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.95


def test_segments_equal_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(300):
        s = np.round(rng.standard_normal(rng.integers(0, 14)), 2)
        got = toxicity.maximal_segments(s)

        def brute(lo, hi):
            best = None
            for a in range(lo, hi):
                for b in range(a + 1, hi + 1):
                    v = s[a:b].sum()
                    if v > 1e-12 and (best is None or v > best[0] + 1e-12 or abs(v - best[0]) <= 1e-12 and b - a < best[2] - best[1]):
                        best = (v, a, b)
            return [] if best is None else [*brute(lo, best[1]), best[1:], *brute(best[2], hi)]

        want = brute(0, len(s))
        assert sum(v for _, _, v in got) == pytest.approx(sum(s[a:b].sum() for a, b in want)) and len(got) == len(want)


def test_long_texts_are_scanned_in_linear_time():
    import time

    s = np.random.default_rng(1).standard_normal(100_000) - 0.4
    began = time.perf_counter()
    found = toxicity.maximal_segments(s)
    assert time.perf_counter() - began < 1 and len(found) > 1000
    total = np.concatenate([[0], np.cumsum(s)])
    assert all(v == pytest.approx(total[b] - total[a]) for a, b, v in found[:100])


def rates(g, y):
    toxic, clean = [r for r in g if r[y] == 1], [r for r in g if r[y] == 0]
    return np.mean([r.predicted for r in toxic]), np.mean([1 - r.predicted for r in clean])


def test_toxic_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.detect(docs, labels).join(labels, "doc_id").where("held_out").collect()
    recall, clean = rates(got, "toxic")
    assert recall > 0.85 and clean > 0.97
    assert len({r.score for r in got}) > 0.8 * len(got)
    cut = np.quantile([r.score for r in got if r.toxic == 0], 0.95)
    assert np.mean([r.score > cut for r in got if r.toxic == 1]) > 0.9


def test_toxicity_model_equals_brute_force(spark):
    rnd = random.Random(8)
    rows, marks = [], []
    for i in range(240):
        words = [rnd.choice(["lorem", "ipsum", "dolor", "sit", "amet", "elit", "sed"]) for _ in range(rnd.randrange(5, 30))]
        y = i % 4 == 0
        if y:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), "zork" + rnd.choice("abcdefgh") * 3)
        rows.append((i, " ".join(words), None, None))
        marks.append((i, int(y)))
    docs = spark.createDataFrame(rows, COLUMNS)
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    m = toxicity.fit(docs, labels)
    train = [(t, y) for (i, t, *_), (_, y) in zip(rows, marks) if zlib.crc32(str(i).encode()) % 5]
    t, c = {}, {}
    for text, y in train:
        every = text.split()
        for w in set(every):
            for p in set(toxicity.pieces(w)):
                d = t if y else c
                d[p] = d.get(p, 0) + every.count(w) ** 0.5
    words = [p for p in {*t, *c} if p[0] == "^" and p[-1] == "$"]
    nt, nc = (sum(d.get(p, 0) for p in words) for d in (t, c))
    for p in {*t, *c}:
        delta, z = toxicity.log_odds(t.get(p, 0), c.get(p, 0), nt, nc)
        assert (p in m.known) == (abs(z) >= toxicity.KEPT_Z), p
        if p in m.known:
            assert m.known[p] == pytest.approx((np.clip(delta, -4, 8), z))
    assert m.word(b"zorkaaa")[0] > 2 and m.word(b"zorkxyz")[0] > 2 and m.word(b"lorem")[0] < 0
    got = toxicity.score(docs, m).collect()
    for r, (_, text, *_), (_, y) in zip(sorted(got, key=lambda r: r.row.doc_id), rows, marks):
        w = toxicity.tokens(text)
        s = np.array([m.word(x) for x in w])
        best = max([v for _, _, v in toxicity.maximal_segments(s[:, 0])], default=None)
        expected = [m.k * len(w) * np.exp(-m.lam * v) for _, _, v in toxicity.maximal_segments(s[:, 0])]
        sure = [v for (_, _, v), e in zip(toxicity.maximal_segments(s[:, 0]), expected) if e < m.significant]
        x = [1, 0 if best is None else -np.log(max(1 - np.exp(-min(expected)), 1e-12)), np.log1p(len(sure)), sum(sure) / len(w), s[:, 1].mean()]
        assert r.score == pytest.approx(1 / (1 + np.exp(-(np.array(x) @ m.weights))), abs=1e-9)
        assert len(r.passages) == len(sure) and r.predicted == y
    top, n = np.array([1.0, 2.0, 4.0]), np.array([10, 20, 40])
    lam, k = toxicity.extreme_value(n, top)
    assert lam == pytest.approx(np.pi / np.sqrt(6) / top.std()) and lam * top.mean() == pytest.approx(np.log(k) + np.log(n).mean() + np.euler_gamma)


def test_toxicity_pieces_are_the_columns(spark):
    from pyspark.sql import functions as F

    words = ["a", "abc", "abcd", "abcde", "éüñß日x", "abcdefghij"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", toxicity.piece_columns(F.col("w")).alias("p")).collect()
    assert all(sorted(r.p) == sorted(toxicity.pieces(r.w)) for r in got)


def test_null_labels_are_ignored(spark, docs, labels):
    for f, target in ((toxicity.detect, "toxic"), (quality.classify, "quality")):
        more = labels.unionByName(labels.selectExpr("doc_id", f"CAST(NULL AS INT) AS {target}", "0 AS " + ("quality" if target == "toxic" else "toxic")))
        assert sorted(map(str, f(docs, more).collect())) == sorted(map(str, f(docs, labels).collect()))


def test_repeated_ids_keep_the_sample_bounded(spark):
    from sparkraster.llm import shared

    docs = spark.createDataFrame([(1, f"text {i % 900}") for i in range(3000)] + [(2, "b")] * 2000, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    got = shared.labelled(docs, labels, "toxic", 5, 9, 200)
    assert 100 < got.count() < 320


def test_languages_are_dealt_evenly_and_few_texts_rejected(spark):
    assert lang_id.quotas({"a": 10, "b": 1000, "c": 5000}, 500) == {"a": 1.0, "b": 0.245, "c": 0.049}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lang_id.predict(docs, lang_id.fit(docs, 600)).collect()
    assert np.mean([r.rejected for r in rows if r.lang_pred != "und"]) < 0.1
    dist, size = np.array([0.1, 0.2, 0.4, 0.3]), np.array([3, 3, 5, 5])
    got = lang_id.radii(dist, size, 2.0)
    assert got[3] == pytest.approx(2 * np.quantile(dist[:2], lang_id.WITHIN)) and got[0] == got[4] == got[3]
    assert got[5] == got[39] == pytest.approx(2 * np.quantile(dist[2:], lang_id.WITHIN))


def test_memory_is_bounded():
    from sparkraster.llm.shared import Memory

    m = Memory(len, 20_000)
    for i in range(5000):
        assert m[str(i % 700)] == len(str(i % 700))
    assert m["x" * 1000] == m["x" * 1000] == 1000 and "x" * 1000 not in m
    assert (len(m) + len(m.old)) * m.ENTRY < 25_000
