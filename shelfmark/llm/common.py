"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.session import materialise, tune

__all__ = ["WordHashes", "cased_words", "materialise", "mix64", "prepared", "read", "rows_of", "salt_of", "texts_of"]

# Entries that a worker keeps of a word cache before it starts anew.
CACHE_WORDS = 500_000


def prepared(spark: SparkSession) -> SparkSession:
    """The library's settings, and Arrow batches that stay small where rows hold whole texts or vectors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return tune(spark)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def cased_words(text: str) -> list[bytes]:
    """Words between characters 0x09-0x0D and 0x20, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


class WordHashes(dict):
    """64-bit hashes of words, kept while there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rows_of(batches: Iterator[pd.DataFrame], size: int = 256) -> Iterator[pd.DataFrame]:
    """The batches in slices of at most ``size`` rows, so that long texts never pile up."""
    for batch in batches:
        for at in range(0, len(batch), size):
            yield batch.iloc[at : at + size]


def salt_of(column: Column | str, salts: int, seed: int = 0) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), column), F.lit(salts)).cast("int")


def texts_of(values) -> pd.Series:
    """Texts as plain Python objects; the pandas text type may arrive in chunks, which Spark doesn't take."""
    return pd.Series(list(values), dtype=object)
