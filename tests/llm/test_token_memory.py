"""Remembered words change the work of token output and not its rows."""

from sparkraster.llm import queries, token_output


def test_rows_do_not_depend_on_the_bound_of_remembered_words(spark):
    rows = [(i, " ".join(f"w{(i * k) % 97}x, Zürich\nline" for k in range(1, 60))) for i in range(40)] + [(40, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few, many = (sorted(map(tuple, token_output.round_trip(docs, bound=b).collect())) for b in (1 << 12, 128 << 20))
    assert few == many and len(few) == 41


def test_the_query_remembers_more_words_than_the_pipeline(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(token_output, "round_trip", lambda docs, bound=64 << 20: seen.append(bound))
    queries.op2_token_output(spark, "/root/testdata/sf0.001")
    assert seen == [128 << 20]
