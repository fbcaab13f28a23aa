"""One query for each operator, over its whole table, and oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkraster.llm import (
    decontaminate,
    impact_search,
    lang_id,
    mixing,
    near_dedup,
    ngram_join,
    periodic_runs,
    quality,
    token_alignment,
    token_counts,
    token_output,
    toxicity,
    warc,
)
from sparkraster.tables import table


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(table(spark, sf_dir, "documents"), bound=128 << 20)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs).select("row.doc_id", "size", "source_size", "target", "taken", "copies")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op9_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.compare(table(spark, sf_dir, "documents"))


def op12_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact_search.search(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), min_length=24, min_periods=3, rewrite=periodic_runs.planted)
    return periodic_runs.digests(found)


SQL_OP1_NEAR_DEDUP = """WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 g AS (SELECT *, sqrt(list_dot_product(e, e)) AS n FROM v WHERE list_dot_product(e, e) > 0),
 l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
 r AS (SELECT vec_id AS id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
 c AS (SELECT id, MIN(c) AS c FROM r GROUP BY id), d AS (SELECT a, COUNT(*) AS d FROM l GROUP BY a)
 SELECT id AS vec_id, COALESCE(d, 0)::BIGINT AS n_links, c AS component_id, id = c AS kept FROM c LEFT JOIN d ON d.a = c.id"""

SQL_OP7_WARC = """WITH p AS (SELECT page_id, COALESCE(html, '') AS h FROM pages), d AS (SELECT page_id, strlen(h) AS n, sha1(h) AS s FROM p),
 f AS (SELECT s, MAX(page_id) AS first FROM d GROUP BY s)
 SELECT page_id, n::BIGINT AS payload_bytes, array_to_string(list_transform(generate_series(0, 31), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(s, (1 + 5 * (i // 4))::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d JOIN f USING (s)"""

SQL_OP8_NGRAM_JOIN = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS sh FROM w)),
 n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
 p AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS i FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY ALL),
 l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
 r AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
 c AS (SELECT id, MIN(c) AS c FROM r GROUP BY id)
 SELECT id AS doc_id, COALESCE(n, 0)::BIGINT AS n_shingles, c AS component_id FROM c LEFT JOIN n ON n.doc_id = c.id"""

SQL_OP12_IMPACT_SEARCH = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
 SELECT q.vec_id AS query_id, row_number() OVER w AS rank, v.vec_id AS vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
 FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
 WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, v.e) DESC, v.vec_id) QUALIFY row_number() OVER w <= 5"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {name[len("SQL_"):].lower(): sql for name, sql in globals().items() if name.startswith("SQL_")}
