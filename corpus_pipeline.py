"""From raw documents to packed sequences: language, quality, near-duplicates, mix, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import langid, mixing, packing, rules, simhash
from quire.llm.common import documents, held_out, stored


def _renamed(docs: DataFrame) -> tuple[DataFrame, str, list[Column]]:
    """The rows under names that no operator uses, the name of the text, and the way back to the old names."""
    names = docs.columns
    return docs.toDF(*(f"c{i}" for i in range(len(names)))), f"c{names.index('text')}", [F.col(f"c{i}").alias(n) for i, n in enumerate(names)]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters, and those of which no language has half of the letters.

    Null and empty texts have no letters: they go. Repeated rows are judged alike; of languages that tie the first in order
    counts; rows without a language teach nothing. Other columns, whatever their names, go through; so does an empty table.
    """
    model = langid.fit(langid.training(docs, ~held_out(F.col("doc_id"), 4, 2)))
    rows, text, back = _renamed(docs)
    told = langid.predict(rows, model, text)
    return told.where((F.col("__lang") != langid.UNKNOWN) & (F.col("__score") >= 0.5)).select(*back)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or are probably bad.

    Null and empty texts have no words: they go. A probability of a half stays; repeated rows count as often as they
    occur and are judged alike. Other columns go through; an empty table stays empty.
    """
    rows, text, back = _renamed(docs)
    return rules.judge(rows, text).where("__kept").select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each class of near-duplicates (five-word shingles, similarity of 0.8).

    Null and empty texts are one class. Of rows that repeat an id one stays, whichever has the least hash; rows without an
    id have no name to stay by and are kept. Other columns go through; an empty table stays empty.
    """
    return simhash.keep_one(docs, simhash.NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's target weight asks for, up to three times.

    A null source is a source, the last in order. Null and empty texts have no words and are taken as whole passes say.
    Rows equal in id and text are taken alike; a copy is a row of its own. Other columns go through; an empty table stays empty.
    """
    return mixing.take(docs, F.array("source"), mixing.by_rank())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens.

    A null or empty text is the end token alone; a repeated row is packed again; a null id stays null. Other columns are
    not read; an empty table has no sequences.
    """
    return packing.pack(docs)


STAGES = [("language", language), ("quality", quality), ("near_duplicates", near_duplicates), ("mixing", mix), ("packing", pack)]
#: Language models and fitted rules can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
