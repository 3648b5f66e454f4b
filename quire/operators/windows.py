"""Window-like operators over numbered sequences.

All partition by the caller's keys; none sorts the whole table. `order` must be total where rows are
picked, since ties would make reruns differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _over(keys: list[str], order: list):
    return Window.partitionBy(*keys).orderBy(*order)


def duplicates(rows: DataFrame, keys: list[str], number: str, order: list) -> DataFrame:
    """The second and later rows of a number."""
    n = F.row_number().over(_over([*keys, number], order))
    return rows.withColumn("occurrence", n).where("occurrence > 1")


def gaps(rows: DataFrame, keys: list[str], number: str, more_than: int = 1) -> DataFrame:
    """(keys, after, missing): numbers missing between neighbours that differ by over `more_than`."""
    distinct = rows.where(F.col(number).isNotNull()).select(*keys, number).distinct()
    nxt = F.lead(number).over(_over(keys, [number]))
    told = distinct.withColumn("__next", nxt).where(F.col("__next") - F.col(number) > more_than)
    return told.select(*keys, F.col(number).alias("after"), F.sequence(F.col(number) + 1, F.col("__next") - 1).alias("missing"))


def missing_total(rows: DataFrame, keys: list[str], number: str, over: int = 3) -> DataFrame:
    """(keys, missing): how many numbers between the least and the greatest are missing, if over `over`."""
    agg = rows.groupBy(*keys).agg((F.max(number) - F.min(number) + 1 - F.count_distinct(number)).alias("missing"))
    return agg.where(F.col("missing") > over)


def out_of_order(rows: DataFrame, keys: list[str], value: str, order: list, strict: bool = True) -> DataFrame:
    """Rows whose value is not above (or, if not strict, is below) the row's before."""
    told = rows.withColumn("previous", F.lag(value).over(_over(keys, order)))
    return told.where(F.col("previous") >= F.col(value) if strict else F.col("previous") > F.col(value))


def clamp(rows: DataFrame, keys: list[str], value: str, order: list, name: str = "clamped") -> DataFrame:
    """Strictly increasing: each value, or the one before it plus one if that is more.

    In closed form: the row's index plus the greatest (value - index) so far.
    """
    w = _over(keys, order)
    i = F.row_number().over(w)
    told = rows.withColumn("__i", i)
    return told.withColumn(name, F.col("__i") + F.max(F.col(value) - F.col("__i")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("__i")


def islands(rows: DataFrame, keys: list[str], starts: Column, order: list, name: str = "island") -> DataFrame:
    """A running number that goes up where `starts` is true of the row (the first row starts one anyway)."""
    w = _over(keys, order)
    told = rows.withColumn("__first", F.row_number().over(w) == 1).withColumn("__s", (starts | F.col("__first")).cast("int"))
    return told.withColumn(name, F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("__first", "__s")


def interpolate(rows: DataFrame, keys: list[str], place: str, value: str, name: str = "filled") -> DataFrame:
    """Null values on the line between the known ones before and after; beyond the known ends the nearest.

    `place` orders a key's rows and is the abscissa.
    """
    w = _over(keys, [place])
    back, ahead = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col(place))
    told = rows.withColumns({
        "__v0": F.last(value, True).over(back), "__p0": F.last(at, True).over(back), "__v1": F.first(value, True).over(ahead), "__p1": F.first(at, True).over(ahead),
    })
    line = F.col("__v0") + (F.col("__v1") - F.col("__v0")) * (F.col(place) - F.col("__p0")) / F.nullif(F.col("__p1") - F.col("__p0"), F.lit(0))
    return told.withColumn(name, F.coalesce(F.col(value).cast("double"), line, F.col("__v0").cast("double"), F.col("__v1").cast("double"))).drop("__v0", "__p0", "__v1", "__p1")


def carry_forward(rows: DataFrame, keys: list[str], columns: list[str], order: list) -> DataFrame:
    """Nulls filled with the last value before them."""
    w = _over(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({c: F.last(c, True).over(w) for c in columns})


def top_k(rows: DataFrame, keys: list[str], k: int, order: list) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(_over(keys, order))).where(F.col("rank") <= k)


def bigrams(tokens: Column) -> Column:
    """Array of neighbouring tokens joined by a space."""
    n = F.size(tokens)
    return F.when(n < 2, F.array().cast("array<string>")).otherwise(F.zip_with(F.slice(tokens, F.lit(1), n - 1), F.slice(tokens, F.lit(2), n - 1), lambda a, b: F.concat_ws(" ", a, b)))


def without_overlap(chips: Column, most: int) -> Column:
    """Of ranked phrases, up to `most` of which none shares a word with one taken before."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("words"))

    def step(acc: Column, chip: Column) -> Column:
        words = F.split(chip, " ")
        takes = (F.size(acc["out"]) < most) & ~F.arrays_overlap(acc["words"], words)
        return F.when(takes, F.struct(F.array_append(acc["out"], chip).alias("out"), F.array_union(acc["words"], words).alias("words"))).otherwise(acc)

    return F.aggregate(chips, start, step)["out"]
