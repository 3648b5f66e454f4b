"""Document fingerprints: a canonical exact digest.

The canonical form of a text is the composed normal form, case-folded, in composed normal form again
(folding can undo it), with runs of white space as one space and none at the ends. Its digest is two 64-bit xxhashes. Rows are grouped by
digest; inside a group the canonical bytes are compared, and should two different ones ever share a
digest, the later ones in byte order get a suffix, so fingerprints are equal exactly if the canonical
texts are. Only built-in expressions: normalisation and folding are static methods of the ICU library
that ships with Spark, called by `reflect`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stored, internal
from .urlfilter import may_hold

_WHITE = r"[\p{Z}\s\x{1C}-\x{1F}\x{85}]+"
#: Ranges of ids that are laid out together, at most, and ids a range on average at least.
_RANGES, _PER_RANGE = 65_536, 64


def canonical(text: Column) -> Column:
    """The canonical form; null is the empty text."""
    text = F.coalesce(text, F.lit(""))

    def compose(x: Column) -> Column:
        return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(False))

    def fold(x: Column) -> Column:
        return compose(F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), compose(x), F.lit(True)))

    # what ASCII alone holds needs neither table
    plain = F.octet_length(text) == F.char_length(text)
    return F.trim(F.regexp_replace(F.when(plain, F.lower(text)).otherwise(fold(text)), _WHITE, " "))


def digest(canon: Column) -> Column:
    """128 bits in hexadecimal."""
    return F.lower(F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(k), canon)), 16, "0") for k in (1, 2))))


def collisions(rows: DataFrame) -> DataFrame:
    """(digest, canon, suffix) of digests that different canonical texts share, but for the first.

    rows: (digest, text), with repeats. Only digests of two or more rows are looked into, and their texts
    meet as the least and the greatest of a digest, so a group of copies is one text a task.
    """
    often = Stored(rows.groupBy("digest").count().where("count > 1").select("digest"), "digests").df
    filtered = may_hold(often)  # so that few other texts are shuffled
    some = rows.where(filtered.holds(F.col("digest"))) if filtered else rows.join(often, "digest", "left_semi")
    some = some.select("digest", canonical(F.col("text")).alias("canon"))
    odd = Stored(some.groupBy("digest").agg(F.min("canon").alias("a"), F.max("canon").alias("b")).where("a <> b").select("digest"), "digests").df
    if odd.isEmpty():  # as ever with 128 bits
        return odd.select("digest", F.lit("").alias("canon"), F.lit("").alias("suffix"))
    rank = F.dense_rank().over(Window.partitionBy("digest").orderBy("canon"))
    return some.join(odd, "digest", "left_semi").distinct().select("digest", "canon", rank.alias("n")).where("n > 1").select("digest", "canon", F.concat(F.lit("-"), F.col("n")).alias("suffix"))


def _named(rows: DataFrame, odd: DataFrame, text: Column, digest_col: str, name: str) -> DataFrame:
    """`rows` with a fingerprint: the digest and the suffix of its canonical text, if it has one."""
    if odd.isEmpty():
        return rows.withColumn(name, F.col(digest_col))
    few = odd.select(F.col("digest").alias("__d"), F.col("canon").alias("__c"), "suffix")
    joined = rows.withColumn("__canon", canonical(text)).join(few, (F.col(digest_col) == F.col("__d")) & (F.col("__canon") == F.col("__c")), "left")
    return joined.withColumn(name, F.concat(digest_col, F.coalesce("suffix", F.lit("")))).drop("__canon", "__d", "__c", "suffix")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint), one row for each of `docs`.

    Null and empty texts share a fingerprint; repeated rows are repeated; very long texts are read once.
    """
    internal(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("digest", digest(canonical(F.col("text"))))
    odd = Stored(collisions(rows.select("digest", "text")), "collisions").df
    named = _named(rows, odd, F.col("text"), "digest", "fingerprint")
    return named.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "fingerprint")


def fingerprints_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, fingerprint, edited_sha256, edited_fingerprint, next_fingerprint) of each row.

    The edited text is that of `edited`, with the next row's text (`with_next`). An edited text whose
    digest is that of its own text, or of a text with a suffix, is compared by its canonical form too.
    Ids are numbers or their decimal form: other text is an error. Only the two columns are read, so others'
    names don't matter; an empty table gives an empty table.
    """
    internal(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn("digest", digest(canonical(F.col("text"))))
    odd = Stored(collisions(rows.select("digest", "text")), "collisions").df
    both = with_next(rows, "doc_id", "text", ("digest",)).withColumn("edit", edited(F.col("text"), F.col("next")))
    both = both.withColumn("edit_digest", digest(canonical(F.col("edit"))))
    same = (F.col("edit_digest") == F.col("digest")) & (canonical(F.col("edit")) != canonical(F.col("text")))
    both = both.withColumn("edit_digest", F.when(same, F.concat("edit_digest", F.lit("-edited"))).otherwise(F.col("edit_digest")))
    for text, column, name in (("text", "digest", "fingerprint"), ("edit", "edit_digest", "edited_fingerprint"), ("next", "next_digest", "next_fingerprint")):
        both = _named(both, odd, F.col(text), column, name)
    sha = F.sha2(F.col("edit").cast("binary"), 256).alias("edited_sha256")
    return both.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), sha, "fingerprint", "edited_fingerprint", "next_fingerprint")


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are at most the id, in two steps of about their square root."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    heads = cuts[step::step]
    coarse = F.size(F.filter(F.array(*map(F.lit, heads)) if heads else F.array().cast("array<bigint>"), lambda c: c <= doc_id))
    fine = F.array(*(F.array(*map(F.lit, cuts[i : i + step])) for i in range(0, len(cuts), step)))
    return coarse * step + F.size(F.filter(F.get(fine, coarse), lambda c: c <= doc_id))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text, next): the text of the next row by ascending id (then text); after the last, the first.

    Ids are cut in ranges of about equal numbers of rows; texts are shuffled once, by range, and the
    first row of a range also goes to the range before. Rows without an id come first. The columns of
    `also` and their next values (next_...) come along.
    """
    place = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), place.alias("o"), *also)
    k = max(1, min(_RANGES, rows.count() // _PER_RANGE))
    cuts: list[int] = []
    if k > 1:
        at = F.percentile_approx("o", F.array(*(F.lit(i / k) for i in range(1, k))), F.lit(max(10_000, 4 * k)))
        cuts = sorted(set(rows.agg(at.alias("at")).first()["at"]))
    ranged = rows.withColumn("r", _range_of(F.col("o"), cuts))
    firsts = {r["r"]: r["o"] for r in ranged.groupBy("r").agg(F.min("o").alias("o")).collect()}  # at most _RANGES rows
    if not firsts:
        return rows.select("doc_id", "text", F.lit("").alias("next"), *also, *(F.col(c).alias(f"next_{c}") for c in also))
    order = sorted(firsts)
    edges = docs.sparkSession.createDataFrame([(r, firsts[r], order[i - 1]) for i, r in enumerate(order)], "r int, o long, before int").coalesce(1)
    head = F.row_number().over(Window.partitionBy("r").orderBy("text"))
    heads = ranged.join(F.broadcast(edges), ["r", "o"]).withColumn("k", head).where("k = 1")
    both = ranged.withColumn("beyond", F.lit(False)).select("doc_id", "text", "o", "r", "beyond", *also)
    both = both.union(heads.select("doc_id", "text", "o", "before", F.lit(True), *also))
    there = Window.partitionBy("r").orderBy("beyond", "o", "text")
    led = {"next": F.lead("text").over(there)} | {f"next_{c}": F.lead(c).over(there) for c in also}
    return both.withColumns(led).where("not beyond").select("doc_id", "text", "next", *also, *(f"next_{c}" for c in also))


def edited(text: Column, following: Column) -> Column:
    """The last floor(n / 2) code points of the text replaced by as many (or all) of the following one's first."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))
