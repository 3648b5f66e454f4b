"""JSON trees (one file a chapter) and the verse relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.strings import verse_number


def chapters(spark: SparkSession, path: str, editions: list[str] | None = None) -> DataFrame:
    """(t, b, c, title, content) of {path}/{t}/{b}/{c}.json, whatever the depth above.

    Missing t, b, c come from the path; files that don't parse are dropped; `editions` prunes folders.
    """
    raw = spark.read.schema(S.CHAPTER).option("multiLine", True).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(path)
    part = lambda n: F.element_at(F.split(F.col("_metadata.file_path"), "/"), -n)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1)
    out = raw.select(
        F.coalesce("t", F.url_decode(part(3))).alias("t"), F.coalesce("b", F.url_decode(part(2))).alias("b"),
        F.coalesce("c", F.expr("try_cast(regexp_extract(_metadata.file_name, '^([0-9]+)[.]json$', 1) as int)")).alias("c"), "title", "content",
    ).where(stem != "")
    return out.where(F.col("t").isin(*editions)) if editions else out


def verses(chapters: DataFrame) -> DataFrame:
    """The verse relation: items with a label, in document order; headings drop out."""
    items = chapters.select("t", "b", "c", F.posexplode("content").alias("pos", "item")).where("item.v is not null")
    return items.select("t", "b", "c", verse_number(F.col("item.v")).alias("v"), "pos", F.col("item.v").alias("label"), F.coalesce("item.text", F.lit("")).alias("text"))


def sections(chapters: DataFrame) -> DataFrame:
    """(t, b, c, pos, section, v): headings with the number of the next verse after them."""
    items = chapters.select("t", "b", "c", F.posexplode("content").alias("pos", "item"))
    after = Window.partitionBy("t", "b", "c").orderBy("pos").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    told = items.withColumn("next", F.first(verse_number(F.col("item.v")), ignorenulls=True).over(after))
    return told.where("item.section is not null").select("t", "b", "c", "pos", F.col("item.section").alias("section"), F.col("next").alias("v"))


def last_wins(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row a key: the last in `order`, which should be total."""
    w = Window.partitionBy(*keys).orderBy(*(F.desc(c) if isinstance(c, str) else c.desc() for c in order))
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def first_wins(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def verse_map(verses: DataFrame) -> DataFrame:
    """(ref, t, b, c, v, text): one text a verse, the last in the document; ref is 'B.c.v'."""
    one = last_wins(verses.where("v is not null"), ["t", "b", "c", "v"], ["pos"])
    return one.select(F.concat_ws(".", "b", "c", "v").alias("ref"), "t", "b", "c", "v", "text")


def lines(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Plain documents as verses: chapter is the id, verse the 1-based line."""
    return documents.select(F.col(id_col).alias("c"), F.posexplode(F.split(text_col, "\n")).alias("pos", "text")).select("c", (F.col("pos") + 1).alias("v"), "text")


def notes(spark: SparkSession, path: str) -> DataFrame:
    """(name, c, v, anchor, note) of {chapter: {verse: note}} files; a note may be text or anchored notes."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1).alias("name"), F.from_json("value", S.NOTES).alias("m"))
    flat = raw.select("name", F.explode("m").alias("c", "vs")).select("name", "c", F.explode("vs").alias("v", "x"))
    parsed = F.when(F.col("x").startswith("["), F.from_json("x", S.ANCHORED)).otherwise(F.array(F.struct(F.lit(None).cast("string").alias("anchor"), F.col("x").alias("note"))))
    return flat.select("name", F.col("c").cast("int").alias("c"), verse_number(F.col("v")).alias("v"), F.inline(parsed).alias("anchor", "note"))


def commentary(spark: SparkSession, path: str) -> DataFrame:
    """(b, c, intro, pos, ref, text) of {b}/{c}.json."""
    raw = spark.read.schema(S.COMMENTARY).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    told = raw.select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("b"), F.regexp_extract("_metadata.file_name", r"^(\d+)", 1).cast("int").alias("c"), "intro", F.posexplode_outer("notes").alias("pos", "n"))
    return told.select("b", "c", "intro", "pos", "n.ref", "n.text")


def interlinear(spark: SparkSession, path: str) -> DataFrame:
    """(b, c, v, pos, w, ..., st): one row a word."""
    raw = spark.read.schema(S.INTERLINEAR).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    verse = raw.select("b", "c", F.explode("verses").alias("x")).select("b", "c", "x.v", F.posexplode("x.words").alias("pos", "w"))
    return verse.select("b", "c", "v", "pos", "w.*")


def strong_verses(words: DataFrame) -> DataFrame:
    """(st, b, c, v) once for each verse in which a lexicon id occurs."""
    return words.where("coalesce(st, '') <> ''").select("st", "b", "c", "v").distinct()


def lexicon(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Entries without an error, with their prefixed id as `key`."""
    raw = spark.read.schema(S.LEXICON).option("multiLine", True).json(path)
    return raw.where("error is null").withColumn("key", F.concat(F.lit(prefix), F.col("id")))


def field_map(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(key, value) of map files; of a key in several the last file's value counts; no paths: no rows."""
    out = spark.createDataFrame([], "key string, value string, file int")
    for i, p in enumerate(paths):
        m = spark.read.text(p, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))
        out = out.unionByName(m.withColumn("file", F.lit(i)))
    return last_wins(out, ["key"], ["file"]).drop("file")


def morph_lines(spark: SparkSession, path: str) -> DataFrame:
    """(c, v, text) of lines 'BBCCVV pos morph word ...': the words of a verse in order."""
    raw = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("i"))
    p = F.split(F.trim("value"), r"\s+")
    words = raw.select("i", p.alias("p")).where(F.size("p") >= 4).select("i", F.substring(F.col("p")[0], 3, 2).cast("int").alias("c"), F.substring(F.col("p")[0], 5, 2).cast("int").alias("v"), F.col("p")[3].alias("w"))
    return words.groupBy("c", "v").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda x: x["w"]), " ").alias("text"))


def api_rows(rows: DataFrame, number: list[str], text: str) -> DataFrame:
    """(v, text) of service rows: the first number given, trimmed text, without empty texts."""
    return rows.select(F.coalesce(*(F.expr(f"try_cast(`{n}` as int)") for n in number)).alias("v"), F.trim(text).alias("text")).where("text <> ''")


def verse_counts(chapters: DataFrame) -> DataFrame:
    """(t, b, c, n): all items of a chapter, headings included."""
    return chapters.select("t", "b", "c", F.size("content").alias("n"))


def write_chapters(verses: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON row a chapter in folders t=/b=, verses in order, empty ones left out.

    `path` must be new: Spark must not overwrite what a plan still reads.
    """
    item = F.struct(F.col("v").alias("k"), "pos", F.struct(F.coalesce("label", F.col("v").cast("string")).alias("v"), "text").alias("item"))
    content = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"]).alias("content")
    verses.where("trim(text) <> ''").groupBy("t", "b", "c").agg(content).write.mode(mode).partitionBy("t", "b").json(path)


def write_log(changes: DataFrame, path: str, width: int = 50) -> None:
    """Tab-separated change log, texts cut to `width`."""
    cut = [F.substring(c, 1, width).alias(c) if k == "string" else F.col(c) for c, k in changes.dtypes]
    changes.select(*cut).write.option("sep", "\t").option("header", True).csv(path)


def as_map(rows: DataFrame, key: str, value: str) -> DataFrame:
    """One row, one map column: for small index files."""
    return rows.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value)))).alias("map"))


def nested_map(rows: DataFrame, outer: str, inner: str, value: str) -> DataFrame:
    """(outer, map of inner to value)."""
    return rows.groupBy(outer).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(inner, value)))).alias("map"))


def merge_notes(old: DataFrame, new: DataFrame, keys: list[str], note: str = "note") -> DataFrame:
    """New notes over old ones; empty results drop out."""
    b = new.select(*keys, F.col(note).alias("__new"))
    return old.join(b, keys, "full_outer").select(*keys, F.coalesce("__new", note).alias(note)).where(F.trim(note) != "")
