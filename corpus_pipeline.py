"""From raw documents to packed training sequences.

`STAGES` in order: quality rules, line dedup, near-duplicate groups, mixing, packing. Every stage but the last returns
documents with the columns it was given; the last returns the pieces of the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugewise.llm.line_dedup import without_repeated_passages
from gaugewise.llm.mixing import mixed_documents
from gaugewise.llm.near_dedup import without_near_duplicates
from gaugewise.llm.quality_rules import without_rejected
from gaugewise.llm.queries import packed, table
from gaugewise.llm.storage import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list reject."""
    return without_rejected(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds; a text that only repeats stays as an empty one."""
    return without_repeated_passages(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return without_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' words as often as the mix of sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences."""
    return packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("packing", packing),
]

# learned rules, groups of near copies and tokens are beyond SQL; tests check properties of each stage's result, and the
# operators' tests hold parts of them against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stage's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
