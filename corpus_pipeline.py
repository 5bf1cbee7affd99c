"""Training-data pipeline: the stages a corpus goes through, in order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickflow.llm.decontaminate import drop_contaminated
from clickflow.llm.near_dup import drop_near_duplicates
from clickflow.llm.packing import pack_documents
from clickflow.llm.pii import pseudonymise
from clickflow.llm.quality_gam import drop_rejected
from clickflow.llm.queries import tokenizer_path
from clickflow.llm.sqltext import save_shared, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return drop_rejected(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, 0.8)."""
    return drop_near_duplicates(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by pseudonyms."""
    return pseudonymise(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents packed into sequences; with a small word
    memory, as the executors' heaps are full by then."""
    return pack_documents(docs, tokenizer_path(), remembered=100_000)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
    ("pseudonyms", pseudonyms), ("packing", packing)]

# Learned models, similarity groups and tokenisation are beyond SQL; the
# pipeline's rows are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the
    shared folder and read again as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = save_shared(docs, f"pipeline-{name}")
    return docs
