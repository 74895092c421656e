"""A training-data pipeline: quality rules, exact dedup, near-duplicate join, source mix, tokens.

`run` applies the stages to `documents`; each is written as Parquet and read by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedmill.llm.common import documents, written
from feedmill.llm.exact_dedup import drop_copies
from feedmill.llm.jaccard_join import one_of_each
from feedmill.llm.mixing import mixed_rows
from feedmill.llm.quality_rules import drop_outliers
from feedmill.llm.queries import tokenizer_model
from feedmill.llm.sentence_pieces import encode_pieces


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return drop_outliers(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts stays."""
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of five words, similarity of 0.8 or more."""
    return one_of_each(docs, width=5, percent=80)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix; those of sources that are asked for more than they have come again."""
    return mixed_rows(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text and the text that they decode to."""
    return encode_pieces(docs, tokenizer_model(spark))


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("mix_sources", mix_stage),
    ("sentence_pieces", token_stage),
]

#: No SQL: merge ranks and robust estimates are beyond it. Tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
