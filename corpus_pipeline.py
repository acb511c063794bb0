"""From documents to packed token sequences; each stage works on the rows that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import lines, minhash, mixing, packing, toxicity
from shelfmark.llm.common import materialise, prepared, read

#: Word shingles of five words, similarity of 0.8 or more.
BANDING = minhash.Banding(words=5, percent=80, subkeys=9, values=3)


def _counted(docs: DataFrame) -> DataFrame:
    """The column ``n_chars``, where there is one, follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled documents, doesn't reject."""
    prepared(spark)
    model = toxicity.train(toxicity.training_rows(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))
    return toxicity.without_toxic(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier one repeats."""
    prepared(spark)
    return _counted(lines.without_repeated_lines(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    prepared(spark)
    return minhash.without_near_duplicates(docs, BANDING)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words that it takes, repeats included."""
    prepared(spark)
    return _counted(mixing.mixed_documents(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every token piece of the documents goes: sequence and offset."""
    prepared(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL can't express the trained stage, the minhash tables or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written before the next one reads them."""
    docs = read(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
