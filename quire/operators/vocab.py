"""Vocabularies and character statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import extract_words, turkish_lower

#: Characters that `character_rates` counts (fixed values).
CHARACTERS = "ışybğçöüYİ"


def words(verses: DataFrame, text: str = "text", least: int = 2) -> DataFrame:
    """(word) once for each occurrence."""
    return verses.select(F.explode(extract_words(F.col(text), least)).alias("word"))


def vocabulary(verses: DataFrame, text: str = "text") -> DataFrame:
    """(word, freq): every occurrence counts for its surface and for its lower form, so lower words count twice.

    Distinct surfaces are counted first; lower forms are added over those few rows.
    """
    surface = words(verses, text).groupBy("word").agg(F.count("*").alias("n"))
    both = surface.select(F.explode(F.array("word", turkish_lower(F.col("word")))).alias("word"), "n")
    return both.groupBy("word").agg(F.sum("n").alias("freq"))


def distinct_words(verses: DataFrame, least: int, text: str = "text") -> DataFrame:
    """(word): lower-case words of at least so many characters, once each."""
    return words(verses, text, least).select(turkish_lower(F.col("word")).alias("word")).distinct()


def combined_frequency(tokens: DataFrame, vocab: DataFrame, word: str, name: str) -> DataFrame:
    """`tokens` with freq(word) + freq(lower word); give it distinct tokens.

    Spark broadcasts the vocabulary if it is small enough, and otherwise shuffles both sides by word.
    """
    v1 = vocab.select(F.col("word").alias("__w1"), F.col("freq").alias("__f1"))
    v2 = vocab.select(F.col("word").alias("__w2"), F.col("freq").alias("__f2"))
    told = tokens.join(v1, F.col(word) == F.col("__w1"), "left").withColumn("__l", turkish_lower(F.col(word))).join(v2, F.col("__l") == F.col("__w2"), "left")
    return told.withColumn(name, F.coalesce("__f1", F.lit(0)) + F.coalesce("__f2", F.lit(0))).drop("__w1", "__f1", "__w2", "__f2", "__l")


def count_of(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def character_counts(verses: DataFrame, keys: list[str], text: str = "text", chars: str = CHARACTERS) -> DataFrame:
    """(keys, total, n_0, n_1, ...): characters of a group, joined by spaces where not empty, and of each kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    full = F.sum(F.when(t != "", F.length(t) + 1).otherwise(0))
    return verses.groupBy(*keys).agg(F.greatest(full - 1, F.lit(0)).alias("total"), *(F.sum(count_of(t, c)).alias(f"n_{i}") for i, c in enumerate(chars)))


def character_rates(counts: DataFrame, keys: list[str], chars: str = CHARACTERS) -> DataFrame:
    """(keys, char, rate): occurrences per 1,000 characters, rounded to two places."""
    pairs = F.array(*(F.struct(F.lit(c).alias("char"), F.bround(F.col(f"n_{i}") * 1000 / F.greatest("total", F.lit(1)), 2).alias("rate")) for i, c in enumerate(chars)))
    return counts.select(*keys, F.inline(pairs))


def joined_text(verses: DataFrame, keys: list[str], order: list[str], text: str = "text") -> DataFrame:
    """(keys, text): a group's texts in order, empty ones left out, joined by spaces."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("__t")))), lambda x: x["__t"])
    return verses.where(F.col(text) != "").groupBy(*keys).agg(F.array_join(parts, " ").alias("text"))
