"""Near-duplicates, joins, decontamination, mixing, WARC and the pipeline against brute force."""

import collections
import random

import numpy as np
import pytest

from sparkraster.llm import decontaminate, mixing, near_dedup, ngram_join, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string"


def group(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_groups(rows, k, num, den):
    sets = {i: shingle_set(t, k) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for n, a in enumerate(ids) for b in ids[n + 1 :]
        if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in group(ids, links).items()}


def edited(seed, n=120):
    """Families of texts with a few words changed, copies, short texts and texts of one word."""
    rnd, rows = random.Random(seed), []
    for i in range(n):
        if i % 12 == 0 or not rows:
            words = [rnd.choice("abcdefghijklm") * rnd.randrange(1, 4) for _ in range(rnd.choice([0, 1, 2, 3, 12, 40, 150]))]
        else:
            words = rows[rnd.randrange(i - i % 12, i)][1].split()
            for _ in range(rnd.randrange(3)):
                if words:
                    words[rnd.randrange(len(words))] = rnd.choice(["new", "B", "cc"])
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize(("k", "num"), [(3, 90), (5, 80), (1, 50)])
def test_join_equals_brute_force(spark, k, num):
    rows = edited(k)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), k, num, 100).collect()}
    assert got == brute_groups(rows, k, num, 100)


def test_join_splits_pages(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PAGE", 3)
    monkeypatch.setattr(ngram_join, "SHARE", 2)
    rows = edited(9, 60)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 70, 100).collect()}
    assert got == brute_groups(rows, 3, 70, 100)


def test_join_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (4, "a b"), (5, "A B"), (None, "a b"), (6, "x " * 30_000), (7, "x " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS fam", "3 AS component", "4 AS sigs")
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_groups(df).collect())
    assert got == {(1, 0, 1): 1, (2, 0, 2): 1, (3, 0, 3): 1, (4, 1, 4): 2, (5, 1, 4): 1, (None, 1, 4): 1, (6, 1, 6): 1, (7, 1, 6): 1}
    assert ngram_join.jaccard_groups(df.where("false")).count() == 0


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((8, 16))
    rows = []
    for i in range(90):
        v = base[i % 8] + rng.standard_normal(16) * rng.choice([0, 0.02, 0.1, 0.5])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(i % 3)))
    rows += [(90, None, 1), (91, [0.0] * 16, 1), (92, [float("nan")] * 16, 1), (93, [None] * 16, 1), (94, rows[0][1], None), (95, rows[0][1], 0), (96, [2 * x for x in rows[0][1]], 0), (97, [1.0], 0), (98, [], 0), (98, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS proj", "2 AS block", "3 AS n_links")
    good = {i: np.array(v, float) for i, v, x in rows if x is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    label = {i: x for i, _, x in rows}
    links = [
        (a, b) for a in good for b in good
        if a < b and label[a] == label[b] and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= 0.98
    ]
    comp = group([i for i, _, _ in rows], links)
    n = collections.Counter(x for pair in links for x in pair)
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()]
    assert sorted(got) == sorted((i, n[i], comp[i], comp[i] == i) for i, _, _ in rows)
    assert near_dedup.near_duplicates(df.where("false")).count() == 0


def test_quantised_products_bound_the_cosine():
    rng = np.random.default_rng(0)
    for dims in (3, 64, 1500):
        a = rng.standard_normal((30, dims)) * rng.lognormal(0, 3, dims)
        a /= np.sqrt((a * a).sum(1))[:, None]
        q, s, e, m = near_dedup.quantise(a)
        approx = near_dedup.code_products(q, q) * s[:, None] * s[None, :]
        bound = e[:, None] * m[None, :] + e[None, :]
        assert (np.abs(a @ a.T - approx) <= bound + 1e-9).all()
        assert (near_dedup.code_products(q, q) == q.astype(np.int64) @ q.astype(np.int64).T).all()


def distance(p, t):
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        new = [i]
        for j, b in enumerate(t, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_matches_equal_full_alignment():
    rnd = random.Random(5)
    items = [(i, "".join(rnd.choice("abcde ") for _ in range(rnd.choice([45, 90, 200])))) for i in range(6)]
    windows = [(i, p, w) for i, t in items for p, w in decontaminate.windows_of(decontaminate.normal(t))]
    m = decontaminate.Matcher(windows)
    for _ in range(80):
        w = rnd.randrange(len(windows))
        text = list(windows[w][2])
        for _ in range(rnd.randrange(int(m.k[w]) + 4)):
            at = rnd.randrange(len(text))
            text[at : at + rnd.randrange(2)] = rnd.choice(["", "x", "yz"])
        text = decontaminate.normal("zz qq " * rnd.randrange(5) + "".join(text) + " kk" * rnd.randrange(40))
        want = {(i, d) for i, (_, _, p) in enumerate(windows) if (d := distance(p, text)) <= m.k[i]}
        assert {(v[0], v[3]) for v in m.find(text)} == want


def test_leaks_of_odd_rows(spark):
    item = "the quick brown fox jumps over the lazy dog and then it runs away from all of them"
    docs = [(1, f"Before.\n{item.upper()} after"), (1, item), (2, "clean text " * 30), (3, None), (4, ""), (None, item), (5, "x " * 100_000 + item)]
    bench = [(7, item), (7, item), (8, None), (9, "short"), (10, ""), (None, item + " again and again")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "2 AS windows", "3 AS w")
    b = spark.createDataFrame(bench, "item_id long, text string").selectExpr("*", "5 AS doc_id")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()}
    assert got == {(i, j) for i in (1, None, 5) for j in (7, None)} and decontaminate.leaks(d, b.where("false")).count() == 0
    assert sorted((r.doc_id, r.windows) for r in decontaminate.clean(d, b).select("doc_id", "windows").collect()) == [(2, 2), (3, 2), (4, 2)]
    assert decontaminate.leaks(d.where("false"), b).count() == 0
    once = d.dropDuplicates(["doc_id"]).where("doc_id <> 1").union(d.where(f"text = '{item}'"))
    want = sorted(map(str, decontaminate.leaks(once, b.dropDuplicates(["item_id", "text"])).drop("first_char", "last_char").collect()))
    for size in (1, 2, 40_000):
        got = decontaminate.leaks(d.union(d), b, size=size)
        assert sorted(map(str, got.drop("first_char", "last_char").collect())) == want and len(want) == 6


def test_short_items_are_whole_words(spark):
    d = spark.createDataFrame([(1, "say  YES, it is"), (2, "say yes it"), (3, "eyes"), (4, "we are ok now"), (5, None)], "doc_id long, text string")
    b = spark.createDataFrame([(1, "Yes"), (2, "are OK"), (3, " ")], "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.windows, r.item_windows) for r in decontaminate.leaks(d, b).collect()} == {(2, 1, 1, 1), (4, 2, 1, 1)}
    assert decontaminate.leaks(d, b, least=8).count() == 0 and decontaminate.clean(d, b).count() == 3


def fill(sizes, weights, share=1.5, most=2.0):
    target, free = dict.fromkeys(sizes, 0.0), {s for s in sizes if sizes[s]}
    left = share * sum(sizes.values())
    while free:
        w = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / w > most * sizes[s]}
        if not over:
            for s in free:
                target[s] = left * weights[s] / w
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mix_targets_and_bounds(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = [r for r in mixing.mix(docs, keep=["doc_id", "source"]).collect()]
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken, largest = collections.Counter(), collections.Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.row.source]) and r.source_size == sizes[r.row.source]
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.row.source] += r.taken
        largest[r.row.source] = max(largest[r.row.source], r.size)
    assert len(got) == docs.count()
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.02)
    again = mixing.mix(docs.repartition(7), keep=["doc_id", "source"]).collect()
    assert sorted((r.row.doc_id, r.copies) for r in again) == sorted((r.row.doc_id, r.copies) for r in got)


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", None), (3, "one two", None, None), (4, "x y z", "de", "b"), (4, "x y z", "de", "b"), (None, "q", None, ""), (5, "w " * 50_000, "en", "a")]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS size", "2 AS row", "3 AS p", "4 AS target", "map('a', 1) AS m")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert {r.row.doc_id: r.source_size for r in got if r.row.doc_id in (1, 3, 4)} == {1: 50_000, 3: 2, 4: 6}
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.mix(df.where("false")).count() == 0


def test_mix_spreads_rows_of_one_key(spark, monkeypatch):
    rows = [(None, "same words here", "en", "a")] * 2000 + [(1, "w " * 9, "en", "a")] * 500 + [(i, "w " * (i % 7), "en", "b") for i in range(400)]
    df = spark.createDataFrame(rows, DOCS)
    largest, level = [], mixing._level

    def spied(d, keys, n, seed):
        if n == 0:
            largest.append(max(r["count"] for r in d.groupBy(*keys).count().collect()))
        return level(d, keys, n, seed)

    monkeypatch.setattr(mixing, "_level", spied)
    one = [(r.row.doc_id, r.size, r.copies) for r in mixing.mix(df).collect()]
    two = [(r.row.doc_id, r.size, r.copies) for r in mixing.mix(df.repartition(3)).collect()]
    assert collections.Counter(one) == collections.Counter(two) and len(one) == len(rows)
    assert max(largest) < 2 * mixing.FAN


def test_mix_keeps_expectations(spark):
    rows = [(i, "w " * (1 + i % 9), "en", "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, DOCS)
    total = collections.Counter()
    for seed in range(6):
        for r in mixing.mix(df, seed=seed).collect():
            total[r.target, r.source_size] += r.taken
    for (target, _), n in total.items():
        assert n / 6 == pytest.approx(target, rel=0.05)


PAGES = [(1, "http://a.example.com/x?b=1#f", "same"), (2, "https://A.example.com:443/y", "same"), (3, None, ""), (4, "not a url", None), (5, "http://b.org", "é" * 100_000), (5, "http://b.org", "é" * 100_000), (None, "http://c.org/", "same"), (6, "http://[bad", "other")]


def test_archives_round_trip(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "1 AS sha", "2 AS refers_to")
    import base64
    import hashlib

    first = collections.defaultdict(lambda: -1)
    for i, _, h in PAGES:
        first[h or ""] = max(first[h or ""], -1 if i is None else i)
    want = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        again = i != first[h or ""]
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first[h or ""] if again else None))
    path = str(tmp_path / "w")
    manifest = warc.write(df, path)
    got = [tuple(r) for r in warc.records(warc.find(df, manifest, path), path).drop("url").collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    urls = spark.createDataFrame([("https://a.example.com/x?b=1",), ("http://b.org/",), ("http://none.org/",), (None,)], "url string")
    hits = collections.Counter((r.key, r.page_id) for r in warc.find(urls, manifest, path).collect())
    assert hits == {("com,example,a)/x?b=1", 1): 1, ("org,b)/", 5): 2, ("", 3): 1}
    assert len([*warc.round_trip(df).collect()]) == len(PAGES)
    assert warc.round_trip(df.where("false")).count() == 0


def test_lookup_over_many_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 4)
    rows = [(i, f"http://h{i % 5}.org/{i // 3}" if i % 3 else None if i % 2 else "http://hot.org", f"p{i}") for i in range(100)]
    path = str(tmp_path / "w")
    manifest = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = collections.Counter((r.key, r.page_id) for r in warc.find(spark.createDataFrame([(u,) for _, u, _ in rows], "url string"), manifest, path).collect())
    assert got == collections.Counter((warc.sort_key(u), i) for i, u, _ in rows)


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    from sparkraster.llm import quality

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = cp.quality_classifier(spark, docs, SF)
    assert kept.columns == docs.columns
    scores = {r.row.doc_id: r.predicted for r in quality.score(docs, quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(i for i in rows if scores[i])
    once = cp.near_duplicates(spark, kept, SF)
    want = brute_groups([(i, rows[i].text) for i in ids], 5, 80, 100)
    assert sorted(r.doc_id for r in once.collect()) == sorted(i for i, (_, c) in want.items() if i == c)
    clean = cp.benchmark_decontamination(spark, once, SF)
    bench = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in clean.collect()}
    assert left == {r.doc_id for r in once.collect() if not any(b in decontaminate.normal(r.text) for b in bench)}
    out = cp.run(spark, SF).collect()
    mixed = collections.Counter(r.doc_id for r in cp.mixing_sources(spark, clean, SF).collect())
    assert collections.Counter(r.doc_id for r in out) == mixed
    out.sort(key=lambda r: r.start)
    assert [r.doc_id for r in out] == sorted(r.doc_id for r in out) and sum(r.n_tokens for r in out[:-1]) == out[-1].start


def test_pipeline_drops_near_copies_from_080(spark):
    import corpus_pipeline as cp

    rnd, rows = random.Random(8), []
    for i in range(0, 60, 4):
        words = [f"w{rnd.randrange(500)}" for _ in range(110)]
        for j in range(4):  # J = 1, 0.91, 0.83, 0.75 with the first
            rows.append((i + j, " ".join("new" if at in (20, 50, 80)[:j] else w for at, w in enumerate(words))))
    df = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], DOCS)
    want = {i for i, (_, c) in brute_groups(rows, 5, 80, 100).items() if i == c}
    assert {r.doc_id for r in cp.near_duplicates(spark, df, SF).collect()} == want
    pair = [rows[0], rows[2]]
    assert brute_groups(pair, 5, 80, 100) != brute_groups(pair, 5, 90, 100)
    kept = cp.near_duplicates(spark, df.where("doc_id IN (0, 2)"), SF).collect()
    assert [r.doc_id for r in kept] == [0]


def test_directory_loses_no_pair_and_tells_unlike_sets_apart():
    rng, sizes = np.random.default_rng(4), ngram_join.Sizes(80, 100)
    for n in [1, 2, 3, 5, 9, 10, 20, 37, 80, 200, 1000]:
        for _ in range(60):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            gone = int(rng.integers(0, n // 5 + 1))
            more = int(0.8 ** -1 * (n - gone) + 1e-9) - n if gone == 0 else 0
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, max(0, more)).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert np.intersect1d(ngram_join.signatures(a, sizes), ngram_join.signatures(b, sizes)).size
    keys = [np.unique(ngram_join.signatures(rng.integers(0, 1 << 63, 300).astype(np.uint64), sizes)) for _ in range(300)]
    assert len(np.unique(np.concatenate(keys))) == sum(map(len, keys))


def test_directory_loses_no_pair_whatever_is_common():
    rng, sizes = np.random.default_rng(8), ngram_join.Sizes(80, 100)
    common = rng.integers(0, 1 << 63, (1 << ngram_join.COMMON_BITS) // 64).astype(np.uint64)
    for n in [4, 9, 21, 60, 300]:
        for _ in range(60):
            every = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
            gone = max(0, n // 9 - 1)
            a, b = np.sort(every[gone:]), np.sort(np.delete(every, rng.choice(n, gone, False)))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert np.intersect1d(ngram_join.signatures(a, sizes, common), ngram_join.signatures(b, sizes, common)).size


def test_common_lines_do_not_make_a_family(spark):
    rnd = random.Random(11)
    lines = [" ".join(f"line{i}word{j}" for j in range(16)) for i in range(3)]
    rows = [(i, " ".join([*(f"w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(60, 240))), rnd.choice(lines)])) for i in range(400)]
    met = ngram_join._meetings(ngram_join.describe(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100).select("doc_id", "sigs"))
    assert met.count() <= 5  # more than 200 when keys were entered in order of their segments


def test_joined_sets_are_not_compared_again(monkeypatch):
    rng, compared = np.random.default_rng(12), []
    base = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    pages = [(np.arange(9) + 9 * p, [np.delete(base, rng.integers(0, 400, 9)) for _ in range(9)]) for p in range(6)]
    pages[5][1][4] = np.unique(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    inner = ngram_join.linked
    monkeypatch.setattr(ngram_join, "linked", lambda *a: (compared.append(1), inner(*a))[1])
    joined, edges = ngram_join.Joined(), []
    for q in range(6):
        for p in range(q):
            edges += zip(*(x.tolist() for x in joined.meet(*pages[p], *pages[q], 80, 100)))
    assert group(range(54), edges) == {i: i if i == 49 else 0 for i in range(54)} and len(edges) == 52
    assert len(compared) == 5 + 4  # a page that comes meets one that is joined; the odd set meets all


def test_excerpts_at_all_offsets_are_found():
    rnd = random.Random(2)
    item = decontaminate.normal("".join(rnd.choice("abcdefghijkl mnop") for _ in range(240)))
    small = "a phrase of few words only"
    m = decontaminate.Matcher([(i, p, w) for i, t in enumerate([item, item[:100], small]) for p, w in decontaminate.windows_of(t)])
    hit = lambda text: {m.every[w][0] for w, *_ in m.find(text)}
    for size in (69, 80, 110, 150):
        for at in range(len(item) - size + 1):
            part = item[at : at + size]
            assert 0 in hit(f"Zz qq {part} yy"), (size, at)
            half = size // 2
            assert 0 in hit(f"Zz qq {part[:half]}#{part[half + 1 :]} yy"), (size, at)
    assert 1 in hit("zz " + item[20:90]) and hit(f"zz {small} yy") == {2}
    assert not hit("unlike text " * 20)


def test_blocks_count_all_windows_of_an_item(spark):
    rnd = random.Random(3)
    items = [(i, "".join(rnd.choice("abcdefgh ij") for _ in range(130))) for i in (1, None)]
    d = spark.createDataFrame([(1, items[0][1][:75]), (2, items[1][1]), (3, "unlike")], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(str, decontaminate.leaks(d, b).collect()))
    assert len(one) == 2 and sorted(map(str, decontaminate.leaks(d, b, size=6).collect())) == one
    assert [r.doc_id for r in decontaminate.clean(d, b, size=6).collect()] == [3]


def test_points_bound_the_overlap_and_lose_no_pair():
    rng = np.random.default_rng(11)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    for largest in (60, 90000):
        base = [np.unique(rng.choice(pool if largest == 60 else rng.integers(0, 1 << 63, 4 * largest).astype(np.uint64), n)) for n in rng.integers(1, largest, 6)]
        sets = sorted(base + [b[: max(1, int(len(b) * s))] for b in base for s in (0.81, 0.95)], key=len)
        pages = sets[::2], sets[1::2]
        sizes = [np.array([len(s) for s in p]) for p in pages]
        points = [ngram_join.unpacked_points(ngram_join.packed_points(np.array([ngram_join.group_counts(s) for s in p])), len(p)) for p in pages]
        for i, a in enumerate(pages[0]):
            want = [np.minimum(ngram_join.group_counts(a), ngram_join.group_counts(b)).sum() for b in pages[1]]
            assert ngram_join.minima(points[0][i].astype(points[1].dtype), points[1]).tolist() == want
        of_a, of_b = ngram_join.may_link(sizes[0], points[0], sizes[1], points[1], 80, 100)
        links = [(i, j) for i, a in enumerate(pages[0]) for j, b in enumerate(pages[1]) if 180 * len(np.intersect1d(a, b)) >= 80 * (len(a) + len(b))]
        assert links and {i for i, _ in links} <= set(of_a) and {j for _, j in links} <= set(of_b)
