"""The composed jobs: detect, correct, validate and score; cross-edition verification; concordance; lexicon.

Every job is one set of lazy frames over all books. Writing is the caller's step, so a dry run is not
writing; an input is never overwritten.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alignment, concordance, correction, lexicon, quality, vocab

BOOK, VERSE = ["t", "b"], ["t", "b", "c", "v", "pos"]


@dataclass
class Corrected:
    """verses: after correction; changes: one row a token; report: one row a book; scores: one a verse; books: one a book."""

    verses: DataFrame
    changes: DataFrame
    report: DataFrame
    scores: DataFrame
    books: DataFrame
    issues: DataFrame
    risks: DataFrame


def correct(verses: DataFrame, references: DataFrame, only_corrupted: bool = True) -> Corrected:
    """Detects corrupted books, corrects their verses by the references' vocabulary, validates and scores.

    verses, references: the verse relation. Clean books go through unchanged if `only_corrupted`.
    """
    words = vocab.vocabulary(references)
    report = quality.corruption(verses, BOOK)
    bad = report.where("is_corrupted").select(*BOOK)
    todo = verses.join(F.broadcast(bad), BOOK, "left_semi") if only_corrupted else verses
    fixed, changes = correction.correct_verses(todo, words, VERSE)
    out = fixed.unionByName(verses.join(F.broadcast(bad), BOOK, "left_anti")) if only_corrupted else fixed
    scores = correction.verse_scores(out, changes, VERSE)
    return Corrected(out, changes, report, scores, correction.book_scores(scores, BOOK), quality.validation(out, BOOK), correction.semantic_risks(changes, words))


def deep_audit(verses: DataFrame, references: DataFrame, canon: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(verses, findings): artifacts off, characters repaired, wider correction; then the structure's findings."""
    words = vocab.vocabulary(references)
    clean = verses.withColumn("text", correction.clean_artifacts(F.col("text"))["text"])
    repaired = correction.repair_characters(clean, words, VERSE)
    fixed, _ = correction.correct_verses(repaired, words, VERSE, wider=True)
    return fixed, quality.structure(fixed, canon)


def verify(verses: DataFrame, references: DataFrame, canon: DataFrame) -> DataFrame:
    """All findings of one edition against the others."""
    words = vocab.vocabulary(references)
    return quality.union(
        quality.structure(verses, canon, gap=2, short_by=3, long_by=None), quality.characters(verses), quality.rare_words(verses, words), quality.length_by_median(verses, references),
        quality.uncorrected(verses, words), quality.not_in_references(verses, references, words),
    )


def integrity(verses: DataFrame, references: DataFrame, canon: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Structure, extreme lengths, sanity patterns and (if given) spot checks."""
    out = [quality.structure(verses, canon), quality.empty_or_short(verses), quality.length_by_mean(verses, references), quality.sanity(verses)]
    return quality.union(*out, *([quality.spot_checks(verses, expected)] if expected is not None else []))


def realign(verses: DataFrame, references: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(verses, counters): chapters rebuilt along a reference edition, and what is still out of order or double."""
    out = alignment.rebuild(verses, references, ["b", "c"])
    told = out.withColumn("t", F.lit("rebuilt"))
    return out, quality.count_by(quality.sequence(told), "reason")


def concord(words: DataFrame, verses: DataFrame, overrides: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(usage, index): distinctive terms of each lexicon id as (st, chips), and where each occurs.

    words: (st, b, c, v) of the interlinear, distinct; verses: (b, c, v, text).
    """
    key = ["b", "c", "v"]
    terms = concordance.term_rows(verses, key)
    ranked = concordance.chips(concordance.usage(terms, words, key))
    named = ranked.join(concordance.surfaces(terms, words, key), ["st", "term"], "left").select("st", "rank", F.coalesce("surface", "term").alias("word"))
    usage = named.groupBy("st").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]), ", ").alias("chips"))
    usage = concordance.override(usage, overrides) if overrides is not None else usage
    each = usage.select("st", F.explode(F.split("chips", r",\s*")).alias("word")).where("word <> ''")
    return usage, concordance.verse_index(each, words, verses, key)


def merge_lexicon(entries: DataFrame, maps: dict[str, DataFrame], clean: tuple[str, ...] = ("def", "sc")) -> tuple[DataFrame, DataFrame]:
    """(merged entries, those whose definition another one shares)."""
    merged = lexicon.merge(entries, maps)
    merged = lexicon.clean_fields(merged, [c for c in clean if c in merged.columns])[0]
    return merged, lexicon.with_repeated(merged, "def")
