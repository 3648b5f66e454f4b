"""Reports as data: log and flag documents of a book, merged scores, progress lines, sectioned text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _in_order(order: list[str], fields: list[str]) -> Column:
    items = F.array_sort(F.collect_list(F.struct(*(F.col(c).alias(f"__o{i}") for i, c in enumerate(order)), F.struct(*fields).alias("item"))))
    return F.transform(items, lambda x: x["item"])


def book_logs(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, applied, flagged, total, changes): one document a book, all its changes in order."""
    fields = [c for c in changes.columns if c not in keys]
    applied = F.count_if(F.col("action") == "applied")
    return changes.groupBy(*keys).agg(applied.alias("applied"), (F.count("*") - applied).alias("flagged"), F.count("*").alias("total"), _in_order(order, fields).alias("changes"))


def book_flags(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, flags): the changes of each book that were not applied."""
    fields = [c for c in changes.columns if c not in keys]
    return changes.where("action <> 'applied'").groupBy(*keys).agg(_in_order(order, fields).alias("flags"))


def merged_scores(scores: DataFrame, key: str, value: str) -> DataFrame:
    """One row: all scores as a map and their mean, rounded to two places."""
    pairs = F.array_sort(F.collect_list(F.struct(key, value)))
    return scores.agg(F.map_from_entries(pairs).alias("scores"), F.bround(F.avg(value), 2).alias("mean"))


def write_json(rows: DataFrame, path: str, by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """JSON lines, in folders by `by`: a row a line, so progress can be followed and documents read singly."""
    writer = rows.write.mode(mode)
    (writer.partitionBy(*by) if by else writer).json(path)


def staged_swap(rows: DataFrame, path: str) -> None:
    """Replaces the table at `path`, which `rows` may read: written beside it first, then renamed over it.

    A failure before the renames leaves the old table; one between them leaves it under its `.old` name.
    """
    spark = rows.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    new, now, old = (hadoop.Path(path.rstrip("/") + end) for end in (".new", "", ".old"))
    fs = now.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    rows.write.mode("overwrite").parquet(new.toString())
    fs.delete(old, True)
    if fs.exists(now):
        fs.rename(now, old)
    fs.rename(new, now)
    fs.delete(old, True)


def sections(findings: DataFrame, most: int = 20) -> DataFrame:
    """(section, n, line): for each severity and reason a heading with its count (n = 0) and the first `most` places."""
    place = F.concat_ws(" ", "t", "b", F.concat_ws(":", "c", "v"), "detail")
    w = Window.partitionBy("severity", "reason").orderBy("t", "b", "c", "v", "detail")
    told = findings.select("severity", "reason", place.alias("line"), F.row_number().over(w).alias("n")).where(F.col("n") <= most)
    heads = findings.groupBy("severity", "reason").agg(F.count("*").alias("k")).select("severity", "reason", F.concat("severity", F.lit(" "), "reason", F.lit(": "), "k").alias("line"), F.lit(0).alias("n"))
    return heads.unionByName(told).select(F.concat_ws("/", "severity", "reason").alias("section"), "n", "line")


def report_text(parts: DataFrame) -> str:
    """`sections` as one text, in order: a few lines a reason, so it is the driver's."""
    return "\n".join(("" if r["n"] else "\n") + r["line"] for r in parts.orderBy("section", "n").collect()).lstrip("\n")
