"""The corpus pipeline: quality rules, line dedup, near dedup, decontamination, mixing.

Each stage works on all that the one before kept. The first four return the columns of documents; the last
returns every document that is left with the words that the mix takes of it, in training order.

Defined cases: null texts and texts without words fail the base rules of the first stage, so they go; a stage that is
given such texts by itself keeps them (line dedup, decontamination, mixing) or takes each as its own class (near dedup).
Texts of any length are read whole. Rows that share a doc_id, or have none (it counts as the largest), are judged each
by its text; equal rows stay or go together, and of equal texts the smallest doc_id stays. A null source is a source of
its own, the last. Empty tables go through all stages and give no rows; without labels the first stage has the base
rules only. Columns beside those of documents are carried through the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import decontam, lines, mixing, near, rules
from quillspark.llm.shared import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go."""
    return rules.filtered(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; a document that loses all its words so goes too, any other stays with the rest."""
    return lines.filtered(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the smallest id."""
    return near.filtered(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.filtered(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and the training position of both passes of each document."""
    out = mixing.mix(docs)
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", F.element_at("positions", 1).alias("position"), F.element_at("positions", 2).alias("second_position"))


STAGES = [("quality_rules", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mix)]

#: The learned list and the banded search have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
