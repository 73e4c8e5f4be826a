"""From raw documents to packed training sequences: the stages and the run over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.llm import language, near_dedup, packing, quality_gam, suffix_dedup
from articlelake.llm.frames import stored, table, texts
from articlelake.llm.queries import teaches


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts. It learns from the labels of two thirds of them.

    Where no label is left to learn from, every document stays.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = quality_gam.learn(texts(docs).where(teaches()), labels)
    return quality_gam.accepted(docs, model)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents mostly in one known language; those without a letter or a main language go.

    A null or empty text has no letter. Where no language is left to learn from, all go.
    """
    return language.accepted(docs, language.learn(docs.where(teaches())))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8.

    Rows of one doc_id stay or go together, as decisions are by doc_id: if one of them is a
    copy of another document, all go, also one whose text is found nowhere else. Rows without
    a doc_id, null and empty texts stay.
    """
    found = near_dedup.near_duplicates(docs)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 50 bytes that an earlier one holds; n_chars follows the text.

    A null text is empty; a row without a doc_id keeps its text and removes nothing.
    """
    left = suffix_dedup.repeated_bytes(docs).select(*docs.columns)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens.

    A null or empty text is its end id alone.
    """
    placed = packing.pack_documents(docs)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", packed_sequences),
]

# SQL expresses none of the stages; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
