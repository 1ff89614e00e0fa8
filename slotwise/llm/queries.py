"""The ``opN_<name>`` queries: each operator on its whole intended table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import (
    fingerprints,
    html_text,
    jaccard_join,
    licenses,
    mixing,
    near_vectors,
    packing,
    pii,
    quality_model,
    quality_rules,
    sharding,
    spelling,
    whitening,
)
from slotwise.llm.common import table

SHARDS = 24


def op1_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label: links, component and whether the vector is kept."""
    return near_vectors.link_vectors(table(spark, sf_dir, "embeddings"))


def op2_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the class and number of links of the shingle Jaccard join."""
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document; documents are files ``source/lang/doc_id``."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    found = licenses.license_scan(docs.select(path.alias("path"), "text"))
    return docs.select("doc_id", path.alias("path")).join(found, "path")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of every document, with its place in the global shuffle."""
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "source", "copy", "mix_key")


def op5_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    scored = quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op6_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule figures and posterior quality of every document."""
    return quality_rules.rule_quality(table(spark, sf_dir, "documents"))


def op7_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training sequence."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document."""
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("text_sha"),  # null and empty texts are one group
    )
    return sharding.byte_shards(rows, "doc_id", "size", "text_sha", SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened components of every vector; a deviation beyond a long is null."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
    return out.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness."""
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, some with a letter taken out, with their forms and roots."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), drop_every=199)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_links,
        op2_jaccard_groups,
        op3_license_scan,
        op4_source_mix,
        op5_quality_score,
        op6_rule_quality,
        op7_packed_sequences,
        op8_personal_data,
        op9_main_text,
        op10_byte_shards,
        op11_embedding_whitening,
        op12_document_fingerprints,
        op13_spelling_variants,
    )
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that SQL can express; the others are tested against brute force in ``tests/llm``."""
    return {"op3_license_scan": licenses.oracle_sql(), "op4_source_mix": mixing.oracle_sql()}
