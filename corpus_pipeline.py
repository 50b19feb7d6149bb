"""Clean a document corpus and pack it: the stages in order, each over all the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from firmalign.llm import decontam, neardup, packing, pii, toxicity
from firmalign.llm.common import cut_lineage, table

#: None: a learnt score, word shingles and token ids have no SQL counterpart; see tests/llm.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. The model learns from these documents and ``labels``."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates stays, once."""
    return neardup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of words of ``benchmark`` go."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; every document stays."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids and their place in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near duplicates", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("personal data", pii_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
