"""A batch data source for SQLite files; nothing but Python's own module is needed.

spark.dataSource.register(SqliteSource)
spark.read.format("quire_sqlite").option("path", file).option("query", sql).option("schema", ddl).load()
With options `column`, `lower`, `upper` and `parts` the query runs once a range of an integer column; the
bounds only set the ranges' width: the first and the last are open, and rows without a value come with the first.
The file must be readable where executors run.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class _Range(InputPartition):
    def __init__(self, where: str, args: tuple):
        self.where, self.args = where, args


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        o = self.options
        if "column" not in o:
            return [_Range("", ())]
        lo, hi, n = int(o["lower"]), int(o["upper"]), int(o.get("parts", 8))
        cuts, col = sorted({lo + (hi + 1 - lo) * i // n for i in range(1, n)}), o["column"]
        if not cuts:
            return [_Range("", ())]
        inner = [_Range(f" WHERE {col} >= ? AND {col} < ?", (a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
        return [_Range(f" WHERE {col} < ? OR {col} IS NULL", (cuts[0],)), *inner, _Range(f" WHERE {col} >= ?", (cuts[-1],))]

    def read(self, partition: _Range) -> Iterator[tuple]:
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            yield from db.execute(f"SELECT * FROM ({self.options['query']}){partition.where}", partition.args)


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quire_sqlite"

    def schema(self) -> StructType | str:
        return self.options["schema"]

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(dict(self.options))
