"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import chat, graph_dedup, licences, lines, minhash, mixing, nearest, negatives, packing, pages, phrases, quality, toxicity
from shelfmark.llm.common import prepared, read
from shelfmark.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(prepared(spark), folder, "documents"), read(spark, folder, "labels")
    model = toxicity.train(toxicity.training_rows(docs, labels))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


@query
def op2_chat_repair(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repair(read(prepared(spark), folder, "conversations"))


@query
def op3_graph_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return graph_dedup.near_duplicate_vectors(read(prepared(spark), folder, "embeddings"))


@query
def op4_co_training(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(prepared(spark), folder, "documents"), read(spark, folder, "labels")
    scored = quality.score_documents(docs, quality.train(docs, labels))
    return scored.withColumn("held_out", quality.held_out())


#: Contract of op5: three words, 85 of 100.
CONTRACT_BANDING = minhash.Banding(words=3, percent=85, subkeys=8, values=3)


@query
def op5_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(prepared(spark), folder, "documents")
    return minhash.near_duplicates(docs, CONTRACT_BANDING).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(prepared(spark), folder, "documents").select("doc_id", "text")
    shorter = lines.without_repeated_lines(docs.withColumn("n_lines", F.size(F.split("text", "\n", -1)).cast("long")))
    return shorter.select("doc_id", "n_lines", F.length("text").cast("long").alias("n_chars_left"), F.md5("text").alias("text_md5"))


@query
def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(prepared(spark), folder, "documents")
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op8_page_differencing(spark: SparkSession, folder: str) -> DataFrame:
    texts = pages.extract_text(read(prepared(spark), folder, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query
def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_sizes(read(prepared(spark), folder, "documents"))


@query
def op10_multiprobe_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(prepared(spark), folder, "embeddings")
    return nearest.nearest(vectors, vectors.where("vec_id % 20 = 0"))


@query
def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read(prepared(spark), folder, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(prepared(spark), folder, "embeddings")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", relabelled))


@query
def op13_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan_licences(read(prepared(spark), folder, "documents"))
