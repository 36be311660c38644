"""A training-corpus pipeline over ``documents``: five stages, each written and reread.

1. language: documents whose language the network cannot tell are dropped
2. near_copies: one document of each group of near copies stays
3. benchmark: documents that hold a test item are dropped
4. secrets: secrets in texts are replaced by markers
5. pieces: texts are encoded to piece ids

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from segmint.llm import langid
from segmint.llm.common import DOC_COLUMNS, stage, table
from segmint.llm.decontaminate import drop_leaks
from segmint.llm.neardup import keep_one_of_each
from segmint.llm.pieces import add_piece_ids
from segmint.llm.queries import tokenizer_path
from segmint.llm.secrets import redact_secrets

#: A document goes if no label reaches this mean probability over its positions; texts in
#: one of the learned languages are far above it, even texts mixed of two.
MIN_LANGUAGE_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*DOC_COLUMNS)
    labelled = langid.predict(docs, langid.fit(docs), carry=DOC_COLUMNS)
    kept = labelled.where((labelled.lang_pred != langid.UNDETERMINED) & (labelled.score >= MIN_LANGUAGE_SCORE))
    return kept.select(*DOC_COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs.select(*DOC_COLUMNS))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs.select(*DOC_COLUMNS), table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs.select(*DOC_COLUMNS))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return add_piece_ids(docs.select(*DOC_COLUMNS), tokenizer_path())


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("secrets", secrets),
    ("pieces", pieces),
]

#: The trained network has no SQL form; tests/llm holds the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
