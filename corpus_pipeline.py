"""From raw documents to token ids, in five stages.

Every stage takes ``(spark, docs, sf_dir)``, works on all documents that the one before kept, and returns a DataFrame
that ``run`` writes as Parquet and reads again. All but the last return the columns of ``documents``. Null and empty
texts, repeated rows and further columns are treated as the operators' docstrings say; rows without an id pass the
stages that decide per id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scholarmill.llm import bpe, lang, leaks, secrets, simhash
from scholarmill.llm.queries import pattern, table, vocabulary_path
from scholarmill.session import write_once

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification does not reject."""
    return lang.keep_known(docs, lang.fit(docs.filter(~lang.held_out())))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark."""
    return secrets.redact(docs, vocabulary_path("byte_bpe_50k.tiktoken"), pattern())


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digests of the ids and of the bytes decoded from them."""
    ranks = vocabulary_path("byte_bpe_50k.tiktoken"), pattern()
    return bpe.digests(bpe.round_trip(docs, *ranks))


STAGES = [
    ("language ID", known_language),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("byte-level BPE", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
