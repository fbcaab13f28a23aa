"""Every stage of the pipeline on odd rows: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import pytest

import corpus_pipeline as cp

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word and other words " * 8_000
LEAK = "the quick brown fox jumps over the lazy dog and then it runs away from all of them at once"
ROWS = [
    (1, None, "en", "a", 0), (2, "", None, None, 0), (3, " \n\t ", "en", "a", 3), (None, "no id but words", "en", "b", 15),
    (4, "one two three four five six", "en", None, 27), (4, "one two three four five six", "en", None, 27), (5, "one two three four five six", "de", "b", 27),
    (6, LONG, None, "a", len(LONG)), (7, "before " + LEAK + " after", "en", "b", 100),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(4, 1, 0), (None, 0, 1), (6, None, None), (99, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, LEAK), (2, None), (3, ""), (None, "x")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    return df.selectExpr("*", "1 AS row", "2 AS size", "3 AS score", "4 AS component_id", "5 AS no", "6 AS n_tokens", "array(7) AS copies")


@pytest.mark.parametrize("k", range(4))
def test_filters_keep_columns(spark, odd, folder, k):
    name, stage = cp.STAGES[k]
    got = stage(spark, odd, folder)
    assert got.columns == odd.columns
    rows = got.collect()
    texts = [(r.doc_id, r.text) for r in rows]
    if name == "n-gram Jaccard join":
        assert sorted(texts, key=str) == sorted([(i, t) for i, t, *_ in ROWS if i != 5], key=str)
    if name == "benchmark decontamination":
        assert sorted(texts, key=str) == sorted([(i, t) for i, t, *_ in ROWS if i != 7], key=str)
    if name == "mixing sources to target weights":
        assert {t for t in texts} <= {(i, t) for i, t, *_ in ROWS} and all(n <= 4 for n in map(texts.count, texts))
    assert stage(spark, odd.where("false"), folder).count() == 0


def test_tokens_of_odd_rows(spark, odd, folder):
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.start, r.n_tokens) for r in cp.token_ids(spark, odd, folder).collect()), key=lambda r: r[2])
    assert len(got) == len(ROWS) and [r[:2] for r in got] == sorted(r[:2] for r in got)
    assert all(b[2] == a[2] + a[3] for a, b in zip(got, got[1:])) and [r[3] for r in got if r[1] in (1, 2)] == [1, 1]
    assert cp.token_ids(spark, odd.where("false"), folder).count() == 0
