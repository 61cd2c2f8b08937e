"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.common import staged, table
from sluice.llm.decontaminate import drop_contaminated
from sluice.llm.exact_dedup import keep_owners
from sluice.llm.packing import pack_documents
from sluice.llm.quality import keep_good
from sluice.llm.simhash import keep_first_rows


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is too high for their language go."""
    return keep_good(spark, docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of all equal documents stays."""
    return keep_owners(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_first_rows(spark, docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return pack_documents(spark, docs)


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", packing),
]

#: Perplexity, fingerprints and token ids have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are staged in the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
