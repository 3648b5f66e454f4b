"""URL filters: a Bloom filter cascade over the corpus's keys, and host/path rules before it.

Level 0 holds the listed keys, level 1 the unlisted keys of the corpus that level 0 lets through,
level 2 the listed keys that level 1 lets through, and so on until nothing is let through. A key of
the corpus is listed if the first level that does not hold it is odd. As every key of the corpus was
seen while building, the answer is exact. A level is an array of longs that reaches the executors as
an uncorrelated scalar subquery: no join, no UDF.

The bits of a level are a set number for each key, so the arrays' size is known before they are made. A
level of over MAX_BITS bits is cut in shards by the key's hash, each an array of its own. Only where all
shards of a level were over ALL_BITS bits together (some 200 million listed keys that the corpus has), too
much for executors to hold, the same answer comes from a semi-join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stored, internal

#: Bits of the largest array that is sent to executors (32 MB), and of all arrays of a level (256 MB).
MAX_BITS, ALL_BITS = 1 << 28, 1 << 31
#: Bits and probes a key, in the first level and in the others.
FIRST, OTHER = (10, 5), (4, 2)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; without :// (or null) empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; without :// (or null) empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The index in `rules` of the longest that fits; null if none does. Of equally long ones the earlier."""
    order = sorted(range(len(rules)), key=lambda i: -len(rules[i].text))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in rules]
    return F.coalesce(*(F.when(fits[i], F.lit(i)) for i in order), F.lit(None).cast("int"))


def suffixes(host: Column, most: int) -> list[Column]:
    """The host's last 1, 2, ... labels (the whole host where it has no more), as many as a listed key has at most."""
    return [F.substring_index(host, ".", -n) for n in range(1, most + 1)]


def _positions(key: Column, level: int, bits: int, probes: int) -> list[Column]:
    """Double hashing from two halves of one 64-bit hash."""
    h = F.xxhash64(F.lit(level), key)
    a, b = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [F.pmod(a + F.lit(i) * b, F.lit(bits)) for i in range(probes)]


def _holds(words: Column, key: Column, level: int, bits: int, probes: int) -> Column:
    out = F.lit(True)
    for p in _positions(key, level, bits, probes):
        word = F.element_at(words, (F.shiftright(p, 6) + 1).cast("int"))
        out = out & (F.getbit(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
    return out


def _shard(key: Column, shards: int) -> Column:
    """Which of the shards a key is in; of a hash that no level probes with."""
    return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(shards)).cast("int")


@dataclass
class Level:
    """A Bloom filter; shards: for each a frame of one row, the array of its bits, and how many bits (0: no key)."""

    shards: list[tuple[DataFrame | None, int]]
    level: int
    probes: int

    def holds(self, key: Column) -> Column:
        inside = [_holds(words.scalar(), key, self.level, bits, self.probes) if words is not None else F.lit(False) for words, bits in self.shards]
        out, shard = inside[0], _shard(key, len(inside))
        for k, x in list(enumerate(inside))[1:]:
            out = F.when(shard == k, x).otherwise(out)
        return out


def _words(keys: DataFrame, level: int, bits: int, probes: int) -> DataFrame:
    """One row, the array of a filter's bits, set by an aggregation over 64-bit words."""
    p = keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits, probes))).alias("p"))
    some = p.select(F.shiftright("p", 6).alias("i"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(64)).cast("int")).alias("w"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("w"))
    words = some.groupBy("i").agg(F.bit_or("w").alias("w")).union(every).groupBy("i").agg(F.bit_or("w").alias("w"))
    row = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "w"))), lambda x: x["w"]).alias("words"))
    return Stored(row, "bloom").df


def build(keys: DataFrame, n: int, level: int, per_key: int, probes: int, max_bits: int = MAX_BITS) -> Level:
    """keys: one column, `n` rows. Of so many shards that each has `max_bits` bits at most, on average."""
    keys = keys.toDF("key")
    count = max(1, -(-n * per_key // max_bits))
    if count == 1:
        return Level([(_words(keys, level, max(64, (n * per_key + 63) // 64 * 64), probes), max(64, (n * per_key + 63) // 64 * 64))], level, probes)
    sizes = {r["s"]: r["count"] for r in keys.groupBy(_shard(F.col("key"), count).alias("s")).count().collect()}  # one row a shard
    bits = [(sizes.get(s, 0) * per_key + 63) // 64 * 64 for s in range(count)]
    return Level([(_words(keys.where(_shard(F.col("key"), count) == s), level, b, probes) if b else None, b) for s, b in enumerate(bits)], level, probes)


def may_hold(keys: DataFrame, max_bits: int = MAX_BITS, all_bits: int = ALL_BITS) -> Level | None:
    """A filter of 8 bits for each of `keys` (one column); none if it had over `all_bits`."""
    n = keys.count()
    return build(keys, n, 0, 8, 4, max_bits) if 8 * n <= all_bits else None


class Cascade:
    """keys: distinct listed keys; universe: distinct keys of the corpus. Both have one column, `key`."""

    def __init__(self, listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS, all_bits: int = ALL_BITS):
        self.spark: SparkSession = universe.sparkSession
        known = universe.where("key is not null").distinct().join(listed.where("key is not null").select("key").distinct().withColumn("in", F.lit(True)), "key", "left")
        self.all = Stored(known.select("key", F.coalesce("in", F.lit(False)).alias("in")), "urls").df
        self.levels: list[Level] = []
        self.exact: DataFrame | None = None
        inside, outside = self.all.where("in").select("key"), self.all.where("not in").select("key")
        while n := inside.count():
            per, probes = OTHER if self.levels else FIRST
            if n * per > all_bits:
                self.levels, self.exact = [], self.all.where("in").select("key")
                return
            self.levels.append(build(inside, n, len(self.levels), per, probes, max_bits))
            passed = Stored(outside.where(self._at(len(self.levels) - 1, F.col("key"))), "urls").df
            inside, outside = passed, inside

    def _at(self, level: int, key: Column) -> Column:
        return self.levels[level].holds(key)

    def contains(self, key: Column) -> Column:
        """Whether a key of the corpus is listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for k in reversed(range(len(self.levels))):
            out = F.when(~self._at(k, key), F.lit(k % 2 == 1)).otherwise(out)
        return out


def filter_urls(pages: DataFrame, listed: list[str] | DataFrame, rules: list[Rule], url_col: str = "url", max_bits: int = MAX_BITS, all_bits: int = ALL_BITS) -> DataFrame:
    """All columns of `pages` with __host, __path, __rule and __verdict (allow or block).

    listed: hosts (a frame has one column, `key`) that are blocked with their subdomains where no rule
    fits. Null, empty and odd urls have an empty host, which no rule and no list names: allowed. Urls
    of any length cost one pass; repeated rows stay; of rules of one length the earlier counts; an empty table
    gives an empty table. Columns of these names are replaced; keys of the corpus are its hosts' last labels,
    as many as a listed host has.
    """
    internal(pages, url_col)
    pages = pages.drop("__host", "__path", "__rule", "__verdict", "__i", "__bad")
    spark = pages.sparkSession
    if isinstance(listed, list):
        listed = spark.createDataFrame([(x,) for x in listed], "key string").coalesce(1)
    most = int(listed.agg(F.max(F.size(F.split("key", r"\."))).alias("n")).first()["n"] or 1)
    named = pages.withColumns({"__host": host_of(F.col(url_col)), "__path": path_of(F.col(url_col))})
    universe = named.select("__host").distinct().select(F.explode(F.array(*suffixes(F.col("__host"), most))).alias("key")).where("key <> ''")
    cascade = Cascade(listed, universe, max_bits, all_bits)
    index = rule_for(F.col("__host"), F.col("__path"), rules)
    text, verdict = F.array(*(F.lit(r.text) for r in rules), F.lit(None).cast("string")), F.array(*(F.lit(r.verdict) for r in rules), F.lit(None).cast("string"))
    named = named.withColumn("__i", index)
    if cascade.exact is None:
        blocked = F.lit(False)  # an empty host is no key of the corpus
        for key in suffixes(F.col("__host"), most) if cascade.levels else []:
            blocked = blocked | ((F.col("__host") != "") & cascade.contains(key))
    else:
        hosts = named.select("__host").distinct().select("__host", F.explode(F.array(*suffixes(F.col("__host"), most))).alias("key"))
        bad = hosts.join(cascade.exact, "key", "left_semi").select(F.col("__host").alias("__bad")).distinct()
        named = named.join(bad, F.col("__host") == F.col("__bad"), "left")
        blocked = F.col("__bad").isNotNull()
    named = named.withColumn("__verdict", F.coalesce(F.get(verdict, F.col("__i")), F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))))
    return named.withColumn("__rule", F.get(text, F.col("__i"))).select(*(F.col(f"`{c}`") for c in pages.columns), "__host", "__path", "__rule", "__verdict")
