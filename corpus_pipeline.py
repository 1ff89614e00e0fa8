"""The corpus pipeline: classify, deduplicate, redact, mix, pack.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)``; its
result is written as Parquet and read back as the next stage's ``docs``. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import jaccard_join, mixing, packing, pii, quality_model
from slotwise.llm.common import stored, table

#: The classifier's training is not SQL; the stages are tested against plain Python in ``tests/llm``.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = quality_model.score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the Jaccard join stays: the one with the smallest id."""
    return jaccard_join.keep_one_per_class(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; ``n_chars`` follows the text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in global random order."""
    return mixing.mix_sources(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", deduplicate),
    ("personal data", personal_data),
    ("source mix", mix),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is stored before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
