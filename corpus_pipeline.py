"""A training corpus from ``documents``: bad and repeated text goes, benchmark text goes,
and what is left is mixed to the sources' target weights.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet and
read again as the docs of the next one. All stages but the last return the columns of
their docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spark_elt.llm import contamination, lines, minhash, mixing, quality
from spark_elt.llm.common import read, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.accept(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their sources."""
    return lines.drop_boilerplate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8)."""
    return minhash.drop_duplicates(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return contamination.decontaminate(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their place in the mix of sources."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_to_weights),
]

#: Trained weights and components of links are not expressible in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed corpus of ``documents``."""
    docs = read(spark, sf_dir, "documents", "*")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
