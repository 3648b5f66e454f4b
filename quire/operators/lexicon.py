"""Lexicon preparation: merging, overriding, cleaning and what is left to translate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import dedupe_lines, first_non_empty, stop_ratio
from ..sources.documents import last_wins

#: English words and markers that show an untranslated text (fixed values).
ENGLISH = "of the to and a an in for from with by as at on or is be it that this which who not but his her him them they we you i he she".split()
MARKERS = (
    "from ", "primary ", "of hebrew", "of latin", "of aramaic", "apparently", "meaning ", "unused root", "probably ", "a form of", "strengthened", "prolonged", "derivative",
    "compound", "particle", "intensive", "reduplication", "contraction", "cognate", "akin", "perhaps", "a root", "a word", "denoting",
)


def merge(entries: DataFrame, maps: dict[str, DataFrame]) -> DataFrame:
    """Entries with one column a map; keys without a value get ''. entries: (key, ...); maps: (key, value)."""
    for name, m in maps.items():
        entries = entries.join(m.select("key", F.col("value").alias(name)), "key", "left").withColumn(name, F.coalesce(name, F.lit("")))
    return entries


def repeated(entries: DataFrame, column: str) -> DataFrame:
    """(column, n): trimmed values, not empty, that two or more entries share."""
    return entries.select(F.trim(column).alias(column)).where(F.col(column) != "").groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def with_repeated(entries: DataFrame, column: str) -> DataFrame:
    """Entries whose value another one shares."""
    r = repeated(entries, column).select(F.col(column).alias("__v"))
    return entries.join(r, F.trim(column) == F.col("__v"), "left_semi")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows over old ones of the same key; columns are those of `old`. A null in a new row keeps the old value."""
    values = [c for c in old.columns if c not in keys]
    n = new.select(*keys, *(F.col(c).alias(f"__{c}") for c in values if c in new.columns))
    return old.join(n, keys, "full_outer").select(*keys, *(F.coalesce(f"__{c}", c).alias(c) if c in new.columns else F.col(c) for c in values))


def union_last(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Of a key in several frames the last frame's row."""
    rows = None
    for i, f in enumerate(frames):
        f = f.withColumn("__file", F.lit(i))
        rows = f if rows is None else rows.unionByName(f)
    return last_wins(rows, keys, ["__file"]).drop("__file")


def todo(entries: DataFrame, done: DataFrame, key: str = "key") -> DataFrame:
    return entries.join(done.select(key), key, "left_anti")


def only(entries: DataFrame, ids: DataFrame, key: str = "key") -> DataFrame:
    return entries.join(ids.select(key), key, "left_semi")


def shard(rows: DataFrame, number: Column, total: int, worker: int) -> DataFrame:
    """One worker's rows, for jobs outside Spark."""
    return rows.where(F.pmod(number, F.lit(total)) == worker)


def is_english(text: Column, other: list[str]) -> Column:
    """More than four English words and over three times as many as of the other language."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    n = lambda ws: F.size(F.filter(words, lambda w: w.isin(*ws)))
    return (n(ENGLISH) > 3 * n(other)) & (n(ENGLISH) > 4)


def has_marker(origin: Column) -> Column:
    out = F.lit(False)
    for m in MARKERS:
        out = out | F.contains(F.lower(origin), F.lit(m))
    return out


def needs_translation(text: Column, original: Column) -> Column:
    """Empty, or over 60 % of the original's words, or over 35 % English words outside brackets."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{2,}"), F.lit(0)))
    o = words(F.coalesce(original, F.lit("")))
    same = (F.size(o) > 0) & (F.size(F.array_intersect(o, words(text))) > 0.6 * F.size(o))
    bare = F.regexp_replace(F.regexp_replace(text, r"\{[^}]*\}", ""), r"\([^)]*\)", "")
    return F.coalesce(F.trim(text), F.lit("")).isin("") | same | (stop_ratio(bare, ENGLISH) > 0.35)


def has_empty_note(notes: Column) -> Column:
    return F.exists(notes, lambda n: F.trim(n["text"]) == "")


def clean_fields(entries: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Entries with comma lists deduplicated line by line, and how many values of each column changed."""
    out = entries.withColumns({c: dedupe_lines(F.col(c)) for c in columns})
    changed = entries.select(*(F.count_if(~F.col(c).eqNullSafe(dedupe_lines(F.col(c)))).alias(c) for c in columns))
    return out, changed


def best_text(*columns: str) -> Column:
    return first_non_empty(*map(F.col, columns))


def translated(entries: DataFrame, column: str, udf, batch: int | None = None) -> DataFrame:
    """`entries` with a column through a translator, once for each distinct text."""
    distinct = entries.select(F.col(column).alias("__t")).where("__t is not null").distinct()
    distinct = (distinct.repartition(batch) if batch else distinct).withColumn("__u", udf("__t"))
    return entries.join(distinct, F.col(column) == F.col("__t"), "left").withColumn(column, F.coalesce("__u", column)).drop("__t", "__u")


def carried(new: DataFrame, old: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """New rows with the old ones' optional `fields` where a new one has none (null or empty)."""
    o = old.select(*keys, *(F.col(f).alias(f"__{f}") for f in fields))
    values = {f: F.coalesce(F.nullif(F.col(f), F.lit("")), F.col(f"__{f}")) if f in new.columns else F.col(f"__{f}") for f in fields}
    return new.join(o, keys, "left").withColumns(values).drop(*(f"__{f}" for f in fields))
