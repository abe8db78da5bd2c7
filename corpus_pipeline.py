"""The corpus pipeline: five operators of ``basketflow.llm`` over the table ``documents``, in order.

Each stage takes the documents its predecessor kept. All but the last return the columns of
documents; the last returns the mix: one row per document with the words taken from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import decontaminate, language_id, mixing, secrets, simhash
from basketflow.llm.common import held_out, table
from basketflow.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without any letter go; the others get the language they are found to be in.

    If no document outside the held-out fold has a language, nothing is learned: all of them keep
    the ``lang`` they have.
    """
    trees = language_id.train(docs.filter(~held_out("doc_id")))
    if not trees.langs:
        return language_id.with_letters(docs)
    found = language_id.predict(docs, trees).filter(F.col("lang_pred") != language_id.UNKNOWN)
    columns = [F.col("lang_pred") if c == "lang" else F.col("doc").getField(c) for c in docs.columns]
    return found.select(*[column.alias(c) for column, c in zip(columns, docs.columns, strict=True)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that quote a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blanked out; all documents stay."""
    return secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.taken_words(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("secrets", secret_scan),
    ("mixture", mixture),
]

# Context trees, fingerprints and hash orders are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
