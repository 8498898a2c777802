"""Corpus pipeline: language ID, exact and near duplicates, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept. Between stages the documents are written and read again, so a lost executor
costs at most the stage it was lost in.

What is removed: texts in none of the languages that the labelled documents have
(no letters, or a cosine with every prototype that chance alone may give); all but
one of equal texts; all but one of each component of similar texts; documents that
hold a benchmark item, question and answer. The last stage draws the mix. Any
column may be null and any table empty; each stage's function says what follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from simsearch.llm import decontamination, exact_dedup, jaccard_join, language_id, mixing
from simsearch.llm.workload import remainder, table
from simsearch.plans.storage import Scratch

# Random draws and trained profiles have no SQL form; tests compare with what was planted.
ORACLE_SQL = None

# Whole texts pass through Python and into files here: batches and row groups of a few megabytes
# keep what an executor holds apart from the number and length of its documents.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "parquet.block.size": str(16 << 20),
}

# Near duplicates of the corpus: distinct runs of five words, Jaccard similarity of 0.8 or more.
NGRAM, PERCENT = 5, 80


def bounded(spark: SparkSession) -> None:
    """Set the session to small batches and row groups, in which all stages work."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the labelled ones, from which the prototypes are learnt.

    A null text, or one without letters, goes. Without labelled documents every
    text with letters stays.
    """
    bounded(spark)
    profiles = language_id.learn_profiles(docs.where(remainder(3) != 1))
    return language_id.keep_known(docs, profiles)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space.

    The most code points stay, then the smallest doc_id, a null one last; null and empty texts are one group.
    """
    bounded(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def dissimilar_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts: the smallest doc_id, a null one last.

    Texts without words are similar to nothing and stay.
    """
    bounded(spark)
    return jaccard_join.drop_similar(docs, NGRAM, PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; all stay if there are no items with words."""
    bounded(spark)
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, a row per draw: a null source is a source, a document without words is in none of its draws."""
    bounded(spark)
    return mixing.mixed_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", distinct_texts),
    ("jaccard_join", dissimilar_texts),
    ("decontamination", without_benchmark),
    ("source_mix", mixed_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row; what a stage returned is removed when its successor is written."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
        scratch.keep(docs)
    return docs
