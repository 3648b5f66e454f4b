"""Similarities of short texts as Column expressions; the sequence ratio is in `python`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import normal_prefix, python_split


def set_jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if either is empty."""
    both = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def word_jaccard(a: Column, b: Column, n: int = 200) -> Column:
    """Of the words in the first n normalised characters."""
    return set_jaccard(python_split(normal_prefix(a, n)), python_split(normal_prefix(b, n)))


def word_overlap(a: Column, b: Column) -> Column:
    """Common words by the larger set; 0 if either is empty."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y)))


def starts_overlap(text: Column, anchor: Column, n: int = 5) -> Column:
    """The share of an anchor's first n words that the text contains."""
    words = F.slice(anchor, 1, n)
    return F.when(F.size(words) == 0, F.lit(0.0)).otherwise(F.size(F.filter(words, lambda w: F.contains(text, w))) / F.size(words))


def word_score(word: Column, other: Column) -> Column:
    """2 for equal words, 1 if they share a beginning of 70 % of the shorter, else 0."""
    n = F.greatest(F.lit(1), F.floor(0.7 * F.least(F.length(word), F.length(other))).cast("int"))
    return F.when(word == other, 2).when(F.substring(word, F.lit(1), n) == F.substring(other, F.lit(1), n), 1).otherwise(0)
