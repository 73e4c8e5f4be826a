"""Registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.llm import divergence, language, near_dedup, neighbours, packing, piece_codec, quality_gam, repair, suffix_dedup, token_counts, topk, vector_codes, window_packing
from articlelake.llm.frames import table, texts


def held_out() -> Column:
    """Whether a row is held out from learning: crc32 of the doc_id as text leaves 1 by 3."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def teaches() -> Column:
    return F.coalesce(~held_out(), F.lit(False))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and the score of its best segmentation."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without strings of 50 bytes of earlier ones."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.digest(suffix_dedup.repeated_bytes(documents))


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    documents = table(spark, sf_dir, "documents")
    model = language.learn(documents.where(teaches()))
    found = language.predict(texts(documents), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, decoded again."""
    decoded = piece_codec.decode(piece_codec.encode(table(spark, sf_dir, "documents")))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return decoded.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.sha2("decoded", 256).alias("decoded_sha256"), same.alias("same"))


def op6_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from two thirds of the labels."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    found = quality_gam.scores(table(spark, sf_dir, "documents"), labels, teaches())
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_term_at_a_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products of every hundredth vector."""
    weights = topk.scaled(F.col("embedding"), 1024)
    return topk.top_k(table(spark, sf_dir, "embeddings"), weights, F.col("vec_id") % 100 == 0, 10)


def op8_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents read back from Re-Pair files."""
    decoded = repair.write_and_read(table(spark, sf_dir, "documents"))
    return decoded.select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a similarity of 0.85 on five-word shingles."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    placed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language and the terms each source is rich in."""
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all vectors, with codebooks of 256 entries after 4 rounds."""
    found, books = vector_codes.codes(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def op13_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    return window_packing.pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_block_neighbours": op2_block_neighbours,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_language_mixture": op4_language_mixture,
    "op5_piece_codec": op5_piece_codec,
    "op6_quality_gam": op6_quality_gam,
    "op7_term_at_a_time": op7_term_at_a_time,
    "op8_repair_tokens": op8_repair_tokens,
    "op9_lsh_forest": op9_lsh_forest,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_vector_codes": op12_vector_codes,
    "op13_window_packing": op13_window_packing,
}
