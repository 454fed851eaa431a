"""Documents to a training corpus: quality, near duplicates, secrets, mixture, tokens.

Each stage takes (session, documents, folder of the tables) and reads what its predecessor kept, as a
written table.  All but the last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import bpe, mixing, quality, secret_scan, simhash
from candlewick.llm.common import table
from candlewick.llm.queries import vocabulary_path
from candlewick.sources.scratch import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rejected documents go."""
    return quality.reject_low_quality(docs, table(spark, folder, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document stays of each group that is alike by five-word shingles."""
    return simhash.drop_near_duplicates(docs, similarity=simhash.SIMILARITY)


def secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets are blotted out; the documents stay."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each document, and the text that they decode to."""
    return bpe.encode(docs, vocabulary_path(), keep=["doc_id", "lang", "source"], decoded=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: Fingerprints, character models and tokens are no SQL; the tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
