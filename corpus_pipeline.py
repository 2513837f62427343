"""Corpus pipeline: five stages from ``documents`` to packed training sequences.

Each stage is one of the operators in ``ledgerline.llm``; its result is written as Parquet to
the checkpoint folder and read again as the next stage's ``docs``.  All but the last return the
columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm.decontaminate import decontaminate
from ledgerline.llm.packing import pack_documents
from ledgerline.llm.quality import keep_quality
from ledgerline.llm.queries import VOCABULARY
from ledgerline.llm.simhash import drop_near_duplicates
from ledgerline.llm.suffix_dedup import cut_repeats
from ledgerline.session import ensure_checkpoint_dir, freeze


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier rejects go."""
    ensure_checkpoint_dir(spark)
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash near-duplicate group the document with the smallest id stays."""
    return drop_near_duplicates(docs)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document has are cut out."""
    return cut_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are little else go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of what is left in sequences of 1024."""
    return pack_documents(docs, VOCABULARY)


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("suffix-array dedup", passage_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: The stages are not expressible in SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = freeze(docs, "stage")
    return docs
