"""A training corpus from ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before
kept, and returns a DataFrame that is written as Parquet and read again as the
docs of the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkraster.llm import decontaminate, mixing, ngram_join, quality, token_output
from sparkraster.llm.shared import discard, stored
from sparkraster.tables import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality trees predict to be of label 1.

    Null and empty texts are scored as a text without a byte; without labels all
    documents have the base rate. Repeated rows stay or go together, an empty
    table stays empty, other columns are kept as they are whatever their names.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, keep=docs.columns).where("predicted = 1").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest doc_id, of each group linked at Jaccard 0.8 of 5-word shingles.

    Rows without doc_id cannot be told apart by it and stay, and so do rows that
    share the doc_id that stays. Null and blank texts are in no group. An empty
    table stays empty, other columns are kept as they are.
    """
    groups = ngram_join.jaccard_groups(docs, k=5, num=80, den=100)
    surplus = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(surplus, "doc_id", "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item; null and empty texts stay, see ``decontaminate.clean``."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; null sources are one source, see ``mixing.mix``."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: ``doc_id, start, n_tokens, ids_crc32``, a row for each copy; null texts are empty."""
    return token_output.round_trip(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("token-ID / binary output", token_ids),
]

#: Trees and random rounding have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return docs
