"""The data model: one explicit superset schema for each document kind, and the canon tables.

The core relation is verse(t, b, c, v, pos, label, text): edition, book, chapter, verse number (null for
range labels such as "1-3"), place in the document, label as written, text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_S, _I = T.StringType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


#: A chapter: items with `v` are verses, items with `section` headings. `v` is a string for range labels.
CHAPTER = _struct(t=_S, b=_S, c=_I, title=_S, content=T.ArrayType(_struct(v=_S, text=_S, section=_S)))
NOTES = T.MapType(_S, T.MapType(_S, _S))
ANCHORED = T.ArrayType(_struct(anchor=_S, note=_S))
COMMENTARY = _struct(intro=_S, notes=T.ArrayType(_struct(ref=_S, text=_S)))
STUDY = _struct(source=_S, book_intro=_S, chapter_intro=_S, passages=T.ArrayType(_struct(ref=_S, title=_S, text=_S)), notes=T.ArrayType(_struct(ref=_S, text=_S)))
WORD = _struct(w=_S, l=_S, tr=_S, st=_S, mp=_S, gl=_S, stv=_S, tx=_S, cx=_S, var=T.BooleanType())
INTERLINEAR = _struct(b=_S, c=_I, lang=_S, verses=T.ArrayType(_struct(v=_I, words=T.ArrayType(WORD))))
LEXICON = _struct(id=_I, title=_S, word=_S, pos=_S, translit=_S, pronunc=_S, phonetic=_S, origin=_S, kjv=_S, nasb_header=_S, short_def=_S, strongs_def=_S, nas_def=_S, nasb=_S, error=_S)
MERGED = _struct(id=_I, pos=_S, origin=_S, **{"def": _S}, nas_def=_S, sc=_S)
OCR = _struct(pages=T.ArrayType(_struct(content=T.ArrayType(_struct(text=_S, position=T.ArrayType(T.DoubleType()))))))
VERSE = _struct(t=_S, b=_S, c=_I, v=_I, pos=_I, label=_S, text=_S)
FINDING = _struct(t=_S, b=_S, c=_I, v=_I, reason=_S, severity=_S, detail=_S)

#: Chapters of each book, in canonical order (fixed values).
OLD = {
    "GEN": 50, "EXO": 40, "LEV": 27, "NUM": 36, "DEU": 34, "JOS": 24, "JDG": 21, "RUT": 4, "1SA": 31, "2SA": 24,
    "1KI": 22, "2KI": 25, "1CH": 29, "2CH": 36, "EZR": 10, "NEH": 13, "EST": 10, "JOB": 42, "PSA": 150, "PRO": 31,
    "ECC": 12, "SNG": 8, "ISA": 66, "JER": 52, "LAM": 5, "EZK": 48, "DAN": 12, "HOS": 14, "JOL": 3, "AMO": 9,
    "OBA": 1, "JON": 4, "MIC": 7, "NAM": 3, "HAB": 3, "ZEP": 3, "HAG": 2, "ZEC": 14, "MAL": 4,
}
NEW = {
    "MAT": 28, "MRK": 16, "LUK": 24, "JHN": 21, "ACT": 28, "ROM": 16, "1CO": 16, "2CO": 13, "GAL": 6, "EPH": 6,
    "PHP": 4, "COL": 4, "1TH": 5, "2TH": 3, "1TI": 6, "2TI": 4, "TIT": 3, "PHM": 1, "HEB": 13, "JAS": 5,
    "1PE": 5, "2PE": 3, "1JN": 5, "2JN": 1, "3JN": 1, "JUD": 1, "REV": 22,
}


def canon(spark: SparkSession) -> DataFrame:
    """(b, ordinal, testament, chapters): 66 rows."""
    rows = [(b, i, "OT" if b in OLD else "NT", n) for i, (b, n) in enumerate((OLD | NEW).items())]
    return spark.createDataFrame(rows, "b string, ordinal int, testament string, chapters int").coalesce(1)
