"""What the operators of this subpackage share: tables, shared storage, word splitting."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: A word is a run of characters that are neither a space nor one of tab, \n, \v, \f, \r.
#: `bytes.split()` splits on exactly these six, so Python code splits the UTF-8 form.
WORD = r"[^\x20\x09-\x0D]+"


def thrifty() -> None:
    """Lets freed memory go back to the system at once: a worker lives on through stages, beside a JVM that keeps its heap."""
    pa.set_memory_pool(pa.system_memory_pool())
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD: larger blocks are mapped, and unmapped when they are freed


if TaskContext.get():  # in a Python worker
    thrifty()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(doc_id: Column, mod: int, remainder: int) -> Column:
    """True where crc32 of the id's decimal form leaves `remainder`; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(mod)) == remainder


_local: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    global _local
    conf = spark.sparkContext.getConf()
    if (path := spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")) is not None:
        return path
    if not conf.get("spark.master", "").startswith(("local[", "local")) or conf.get("spark.master", "").startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    _local = _local or tempfile.mkdtemp(prefix="quire-")
    return f"file://{_local}"


class Stored:
    """A frame written once to the shared folder: later reads don't depend on lost executors or on lineage."""

    def __init__(self, df: DataFrame, hint: str):
        spark = df.sparkSession
        self.spark, self.path = spark, f"{shared_dir(spark)}/quire/{hint}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def stored(df: DataFrame, hint: str) -> DataFrame:
    return Stored(df, hint).df


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of finished jobs: its cleaner acts once the driver has collected garbage."""
    gc.collect()
    spark._jvm.System.gc()


def clear(spark: SparkSession) -> None:
    """Removes all tables that operators stored; frames that read them must have been written or dropped."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/quire")
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches cut to `rows` rows, so that few texts are Python strings at once."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


_held: tuple[tuple, object] | None = None


def held(kind: str, key: object, make: Callable[[], T]) -> T:
    """What a Python worker keeps between tasks: one object, so that operators don't pile up their memories."""
    global _held
    if _held is None or _held[0] != (kind, key):
        _held = None
        _held = ((kind, key), make())
    return _held[1]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def words(text: str) -> list[bytes]:
    """The words of a text as UTF-8, in order."""
    return text.encode("utf-8", "surrogatepass").split()


def lower_words(text: str) -> list[bytes]:
    """As `words`, with A-Z (and nothing else) lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def internal(df: DataFrame, *names: str) -> None:
    """Raises if the frame lacks one of the columns that an operator reads."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
