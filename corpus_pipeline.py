"""From raw documents to token ids: quality, language, near duplicates, benchmark leaks, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but the last return the
columns of their input; rows that a stage rejects are gone for the ones behind it. Models are fitted on the stage's own
input (and the labels table), on bounded samples that the operators document.

* quality: rows whose text fails the base rules, or whose lines are mostly boilerplate, go. Null and empty texts go.
* language: rows without a letter, or with less than half of their letters in one language, go.
* near_duplicates: of each class of copies and near copies the row with the smallest id stays.
* decontamination: rows that hold a benchmark item go.
* encoding: one row per document with its token ids, their digest and the digest of the decoded text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkstream.llm import langid, leaks, linecrf, neardup, pieces
from sparkstream.llm.common import kept, table
from sparkstream.llm.queries import PIECE_MODEL


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linecrf.keep_good(docs, linecrf.learn(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs, langid.learn(docs, docs["lang"].isNotNull()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.digests(docs, public_tokenizers.path(PIECE_MODEL), with_ids=True)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SQL cannot decode the CRF or merge pieces; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's result is written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
