"""The same operators over chapters that arrive as files, with checkpoints in place of hand-kept progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..sources.documents import verses


def chapters(spark: SparkSession, path: str, files: int = 1000) -> DataFrame:
    """New chapter files, (t, b, c, title, content), up to so many a batch."""
    raw = spark.readStream.schema(S.CHAPTER).option("multiLine", True).option("maxFilesPerTrigger", files).option("recursiveFileLookup", True).json(path)
    return raw.where("content is not null")


def incremental(spark: SparkSession, path: str, out: str, checkpoint: str, f: Callable[[DataFrame], DataFrame], files: int = 1000) -> StreamingQuery:
    """Writes f(verse relation) of every batch of new files as Parquet under `out`, then stops; run again to resume.

    Each batch overwrites its own folder, so a repeated batch leaves the same rows.
    """

    def put(batch: DataFrame, n: int) -> None:
        f(verses(batch)).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return chapters(spark, path, files).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, keys: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events by tumbling window and key, with a watermark for late ones."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))
