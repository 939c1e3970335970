"""A corpus pipeline of five stages, from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run()
writes as Parquet to the shared folder and reads again for the next stage.

Defined cases, for every stage: null text is an empty text; null values of other
columns pass through; rows with a null doc_id are documents of their own, which
only their own text can reject; an empty table gives an empty table; further
columns pass through all stages but the last, whatever their names. Repeated rows
are judged row by row until near_dedup, which keeps one row of each doc_id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import saved, table
from ledgerline.llm.decontamination import cleaned
from ledgerline.llm.near_dedup import deduplicated
from ledgerline.llm.packing import packed
from ledgerline.llm.quality_rules import Cascade
from ledgerline.llm.secret_scan import redacted


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects; empty and very short ones go. The order of rows plays no part."""
    return Cascade().keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest doc_id; of its rows, the one with the smallest hash."""
    return deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item; items without text are in no document, and without items all documents stay."""
    return cleaned(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked, overlapping ones as one; n_chars follows the text and is null where that is."""
    return redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in packed sequences; an empty document is one piece of one id; equal lengths are told apart by rank."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Shingle signatures, tokenizers and packing can't be written as SQL; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
