"""Corpus pipeline over ``documents``; each stage is written and read again before the next.

1. ``quality``: documents whose quality score is below the bound go.
2. ``near_duplicates``: of each component of near copies the document with the least id stays.
3. ``secrets``: every secret in a text is replaced by a mark.
4. ``mix``: documents are repeated, cut or left out so that the sources reach their target shares.
5. ``tokens``: the ids of every text are appended; they are decoded too, and ids that do not give the text stop the run.

Columns beyond those of documents pass through. A row without a doc_id is kept by stage 2 only if no
row of its component has an id; rows that repeat the kept id are reduced to one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliniform.llm import mixing, quality, secrets, simhash, tokens
from cliniform.llm.common import table
from cliniform.sources.stage import staged


def measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a text has changed, where there is such a column."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return simhash.representatives(docs)


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets replaced."""
    return measured(secrets.redacted(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row per document and round it is drawn in, with the words drawn."""
    return measured(mixing.mixed_texts(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, each text's decoded and compared with it."""
    return tokens.encode(docs, checked=True)


STAGES = [("quality", good), ("near_duplicates", distinct), ("secrets", masked), ("mix", mixed), ("tokens", encoded)]

#: Learned scores, 64-bit hashes and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what the last one makes is returned unwritten."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
