"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has `64 * words` bits: a bit is 1 if it is set in over half the hashes of the text's
shingles. Fingerprints are cut in `blocks` equal blocks. Every distinct fingerprint emits, for each
block, all variants of that block within half the radius; two blocks within the radius share a
variant, so a shuffle on variants meets all of them. Rows of a variant are tied to the least id and
to their neighbour in id order (never all pairs), the pairs are deduplicated and verified by the
number of differing bits of the whole fingerprint, and connected components follow.

With one block whose radius is the limit, rows that share a variant are within the radius of each
other, so these ties give exactly the components of the full link graph. With several blocks the
candidates are those that agree in at least one block within the radius, and rows of a variant need not
be within the limit of each other: where a variant's rows are still in several components after the ties,
all rows of different components are compared, in pieces, and only links that join components come out. Pairs
whose differing bits leave it open whether they are similar enough are held against each other by their whole
sets of shingles.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stored, internal, lower_words, release, sliced, stored, texts
from .graph import components

#: Odd multipliers and shifts of the splitmix64 finaliser (fixed values), for the second and later words.
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)
_CHUNK = 1 << 13
#: Rows and bytes of shingles of a piece of a crowd; two pieces are compared at once.
_PIECE, _PIECE_BYTES = 2000, 8_000_000


@dataclass(frozen=True)
class Spec:
    """shingle: words a shingle; words: 64-bit words a fingerprint; blocks: blocks it is cut in; radius:
    differing bits within which two blocks meet; limit: differing bits within which fingerprints may link;
    sure: those within which they do; between the two, the Jaccard similarity of shingles must reach `similarity`."""

    shingle: int = 3
    words: int = 1
    blocks: int = 1
    radius: int = 2
    limit: int = 2
    sure: int = 2
    similarity: float = 0.0

    @property
    def bits(self) -> int:
        return 64 * self.words // self.blocks


#: Three-word shingles, 64 bits, links at two or fewer differing bits.
EXACT = Spec()
#: For similarity of 0.8 or more over five-word shingles: 512 bits, of which a Jaccard similarity of 0.8
#: leaves 512 * arccos(2 * 0.8 / 1.8) / pi = 78 different on average, with a deviation of 8.
NEAR = Spec(shingle=5, words=8, blocks=16, radius=2, limit=100, sure=64, similarity=0.8)
#: Blocks whose variants are shuffled at once.
_AT_ONCE = 4


def hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of a text; fewer words than that: of all its words; none: empty."""
    parts = lower_words(text)
    if not parts:
        return np.empty(0, np.uint64)
    joined, h = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= shingle:
        return np.array([h(joined, 42)], np.uint64)
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[: len(parts) - shingle + 1].tolist()
    return np.array([h(joined[s:e], 42) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], np.uint64)


def fold(h: np.ndarray, words: int) -> np.ndarray:
    """The fingerprint of shingle hashes, as signed 64-bit words; without hashes all zero."""
    salt = np.array([(_MIX[2] * k) & (2**64 - 1) for k in range(1, words)], np.uint64)
    ones = np.zeros(64 * words, np.int64)
    for i in range(0, len(h), _CHUNK):
        own = h[i : i + _CHUNK].astype(np.uint64)[:, None]
        x = own + salt
        x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
        every = np.ascontiguousarray(np.hstack([own, x ^ (x >> np.uint64(31))])).astype("<u8")
        ones += np.add.reduce(np.unpackbits(every.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.int32)
    return np.packbits(2 * ones > len(h), bitorder="little").view("<i8").astype(np.int64)


def fingerprints(docs: DataFrame, spec: Spec = EXACT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, f0, f1, ...): one row for each row of `docs`. Null text is empty; its fingerprint is zero."""
    internal(docs, id_col, text_col)
    names = [f"f{k}" for k in range(spec.words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            f = np.array([fold(hashes(t, spec.shingle), spec.words) for t in texts(b)], np.int64).reshape(-1, spec.words)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(f[:, k]) for k in range(spec.words))], ["doc_id", *names])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} long" for n in names))


def _block(spec: Spec, k: int) -> Column:
    """Block k of a fingerprint, as a long."""
    if spec.bits == 64:
        return F.col(f"f{k}")
    per = 64 // spec.bits
    return F.shiftrightunsigned(F.col(f"f{k // per}"), spec.bits * (k % per)).bitwiseAND(F.lit((1 << spec.bits) - 1))


def _masks(spec: Spec) -> list[int]:
    out = []
    for n in range(spec.radius // 2 + 1):
        for flips in itertools.combinations(range(spec.bits), n):
            m = sum(1 << i for i in flips)
            out.append(m - (1 << 64) if m >= 1 << 63 else m)
    return out


def differing(spec: Spec, a: str = "", b: str = "o") -> Column:
    return sum((F.bit_count(F.col(f"{a}f{k}").bitwiseXOR(F.col(f"{b}f{k}"))) for k in range(1, spec.words)), F.bit_count(F.col(f"{a}f0").bitwiseXOR(F.col(f"{b}f0"))))


def _keyed(nodes: DataFrame, spec: Spec, which: range | None = None) -> DataFrame:
    """(id, v): the variants of the blocks `which` (all) of each node.

    An odd radius would need one side to emit one more flip, so radii are even.
    """
    if spec.radius % 2 or 64 % spec.bits:
        raise ValueError("the radius must be even and blocks must divide 64 bits")
    blocks = F.array(*(F.struct(F.lit(k).cast("byte").alias("k"), _block(spec, k).alias("x")) for k in which or range(spec.blocks)))
    if spec.blocks == 1:
        rows = nodes.select("id", F.lit(0).cast("byte").alias("k"), _block(spec, 0).alias("x"))
    else:
        rows = nodes.select("id", F.inline(blocks))
    variants = F.transform(F.array(*map(F.lit, _masks(spec))), lambda m: m.cast("long").bitwiseXOR(F.col("x")))
    keyed = rows.select("id", "k", F.explode(variants).alias("v"))
    if spec.blocks > 1:  # one long as key: the block's number above its bits
        keyed = keyed.select("id", F.shiftleft(F.col("k").cast("long"), spec.bits).bitwiseOR(F.col("v")).alias("v"))
    return keyed.select("id", "v")


def meetings(nodes: DataFrame, spec: Spec, which: range | None = None) -> DataFrame:
    """(id, v, n, least, before): the nodes of each variant that two or more have; n: how many, least: the least id,
    before: the next smaller one. nodes: (id, f0, ...), distinct fingerprints; which: blocks, by default all."""
    near = Window.partitionBy("v").orderBy("id")
    every = near.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return _keyed(nodes, spec, which).select("id", "v", F.count("*").over(every).cast("int").alias("n"), F.first("id").over(near).alias("least"), F.lag("id").over(near).alias("before")).where("n > 1")


def candidate_pairs(met: DataFrame, spec: Spec, roots: DataFrame | None = None) -> DataFrame:
    """Distinct pairs (a > b) of ids that are tied in a variant of `meetings`: each to the least, and of up to three rows
    each to the one before, which are all pairs; of larger ones `crowded_pairs` compares what ties leave apart.

    With components `roots`, only pairs between two of them."""
    ties = [F.col("least")] if spec.blocks == 1 else [F.col("least"), F.when(F.col("n") <= 3, F.col("before"))]
    pairs = met.where("before is not null").select(F.col("id").alias("a"), F.explode(F.array_compact(F.array(*ties))).alias("b")).distinct()
    return pairs if roots is None else _between(pairs, roots)


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of `pairs` (a, b, ...) whose rows are in different components."""
    of = lambda k: roots.select(F.col("node").alias(k), F.col("component").alias(f"c{k}"))
    return pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(*pairs.columns)


def crowded_pairs(met: DataFrame, nodes: DataFrame, roots: DataFrame, spec: Spec, docs: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", piece: int | None = None) -> DataFrame:
    """(a, b): links that join all components `roots` between which any two rows of a variant of more than three link.

    nodes: (id, f0, ...), distinct fingerprints; docs: their texts, without which only `sure` bits link. Variants with
    the same least id are one crowd, so a row is in it once. Of crowds with rows in several components every two rows
    meet in a pair of pieces of at most `piece` rows and `_PIECE_BYTES` of shingles on average, where `spanning` tests
    all rows of different components, those that bits leave open by their whole sets of shingles.
    """
    piece = piece or _PIECE
    names = [f"f{k}" for k in range(spec.words)]
    whole = docs is not None and spec.limit > spec.sure
    rows = met.where("n > 3").select("least", "id").distinct().join(roots.withColumnRenamed("node", "id"), "id", "left")
    rows = rows.select("id", F.col("least").alias("v"), F.coalesce("component", "id").alias("c"))
    of = Window.partitionBy("v")
    rows = rows.select("*", F.min("c").over(of).alias("lo"), F.max("c").over(of).alias("hi")).where("lo <> hi").select("id", "v", "c")
    if whole:
        rows = Stored(rows, "simhash-crowded").df
        facts = Stored(nodes.join(shingle_sets(docs, nodes, rows.select("id").distinct(), spec, id_col, text_col), "id"), "simhash-crowded-sets").df
    else:
        facts = nodes.withColumn("s", F.lit(b""))
    pieces = F.greatest(F.ceil(F.count("*").over(of) / piece), F.ceil(F.sum(F.length("s")).over(of) / _PIECE_BYTES)).cast("int")
    dealt = rows.join(facts, "id").withColumn("pieces", pieces).withColumn("p", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("q"))
    dealt = dealt.select("v", F.least("p", "q").cast("long").alias("p"), F.greatest("p", "q").cast("long").alias("q"), "id", "c", *names, "s")

    def links(run: list[pa.RecordBatch]) -> list[tuple[int, int]]:
        table = np.stack([np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in run]) for k in range(3, 5 + spec.words)], axis=1)
        f = np.ascontiguousarray(table[:, 2:]).view(np.uint64)
        sets = Sets([np.frombuffer(x, np.uint32) for b in run for x in b.column(5 + spec.words).to_pylist()], spec.similarity) if whole else None
        return spanning(table[:, 0], table[:, 1], f, spec.sure, spec.limit, sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the run that goes on
        last = None
        for b in itertools.chain(batches, [None]):
            found = []
            keys = np.empty((0, 3), np.int64) if b is None else np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in range(3)], axis=1)
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            if held and (b is None or len(keys) and tuple(keys[0]) != last):
                found += links(held)
                held = []
            for lo, hi in itertools.pairwise(edges if len(keys) else []):
                held.append(b.slice(lo, hi - lo))
                if hi < len(keys):
                    found += links(held)
                    held = []
            last = tuple(keys[-1]) if len(keys) else last
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(2)], ["a", "b"])

    return dealt.repartition("v", "p", "q").sortWithinPartitions("v", "p", "q").mapInArrow(run, "a long, b long").distinct()


class Sets:
    """Sets of shingle hashes, of which one is held against many at once."""

    def __init__(self, sets: list[np.ndarray], similarity: float):
        self.similarity, self.size = similarity, np.array([len(x) for x in sets], np.int64)
        self.first = np.cumsum(self.size) - self.size
        kinds, self.code = np.unique(np.concatenate([np.empty(0, np.uint32), *sets]), return_inverse=True)
        self.on = np.zeros(len(kinds), bool)

    def like(self, i: int, others: np.ndarray) -> np.ndarray:
        """Whether each of `others` is similar enough to set i."""
        size, own = self.size[others], self.code[self.first[i] : self.first[i] + self.size[i]]
        out = np.minimum(size, len(own)) >= self.similarity * np.maximum(size, len(own))
        some, size = others[out], size[out]
        if len(some):
            of = np.repeat(np.arange(len(some)), size)
            at = np.arange(len(of)) + np.repeat(self.first[some] - (np.cumsum(size) - size), size)
            self.on[own] = True
            both = np.bincount(of, self.on[self.code[at]], len(some))
            self.on[own] = False
            out[out] = both >= self.similarity * (size + len(own) - both)
        return out


def spanning(ids: np.ndarray, c: np.ndarray, f: np.ndarray, limit: int, wide: int = 0, sets: Sets | None = None) -> list[tuple[int, int]]:
    """Links (a > b) within the limit that join all components `c` that any link joins.

    With `sets`, rows beyond the limit link too, if they are within `wide` bits and their sets are similar enough.
    Every row is compared with all later ones that are not yet in its component. Those nearest to the rows'
    bitwise majority come first, so that a family of copies is joined by its first row.
    """
    kinds, c = np.unique(c, return_inverse=True)
    left, out = len(kinds), []
    if left < 2:
        return out
    at = np.arange(len(ids))
    if len(ids) > 8:
        bits = np.unpackbits(f.view(np.uint8), axis=1)
        far = (bits != (2 * bits.sum(axis=0, dtype=np.int64) > len(ids))).sum(axis=1)
        at = np.argsort(far, kind="stable")
        ids, c, f = ids[at], c[at], f[at]
    for i in range(len(ids) - 1):
        other = np.flatnonzero(c[i + 1 :] != c[i]) + i + 1
        far = np.bitwise_count(f[other] ^ f[i]).sum(axis=1, dtype=np.int64)
        for told in (False, True) if sets else (False,):
            met = other[far <= limit] if not told else other[(far > limit) & (far <= wide) & (c[other] != c[i])]
            if told and len(met):
                met = met[sets.like(at[i], at[met])]
            for j in met.tolist():
                if c[j] != c[i]:
                    out.append((max(int(ids[i]), int(ids[j])), min(int(ids[i]), int(ids[j]))))
                    c[c == c[j]] = c[i]
                    left -= 1
        if left < 2:
            break
    return out


def shingle_sets(docs: DataFrame, nodes: DataFrame, ids: DataFrame, spec: Spec, id_col: str, text_col: str) -> DataFrame:
    """(id, s): the sorted distinct shingle hashes (32 bits) of the text of each node in `ids` (id). Only texts of those ids are read in Python."""
    names = [f"f{k}" for k in range(spec.words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 200):
            h = [hashes(t, spec.shingle) for t in texts(b)]
            f = np.array([fold(x, spec.words) for x in h], np.int64).reshape(-1, spec.words)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(f[:, k]) for k in range(spec.words)), pa.array([np.unique((x >> np.uint64(32)).astype(np.uint32)).tobytes() for x in h], pa.binary())], ["id", *names, "s"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(ids, "id", "left_semi")
    told = rows.mapInArrow(run, "id long, " + ", ".join(f"{n} long" for n in names) + ", s binary")
    return told.join(nodes, ["id", *names], "left_semi").groupBy("id").agg(F.max("s").alias("s"))


def distances(pairs: DataFrame, nodes: DataFrame, spec: Spec) -> DataFrame:
    """(a, b, far): the differing bits of those `pairs` (a, b) that are within the limit."""
    names = [f"f{k}" for k in range(spec.words)]
    one, other = nodes.withColumnRenamed("id", "a"), nodes.select(F.col("id").alias("b"), *(F.col(n).alias(f"o{n}") for n in names))
    return pairs.join(one, "a").join(other, "b").select("a", "b", differing(spec).alias("far")).where(F.col("far") <= spec.limit)


def similar(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, spec: Spec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Those of `pairs` (a, b) whose whole sets of shingles are similar enough."""
    pairs = Stored(pairs.select("a", "b"), "simhash-open").df
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    sets = Stored(shingle_sets(docs, nodes, ids, spec, id_col, text_col), "simhash-sets").df

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= spec.similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep, pa.bool_())), b.column(1).filter(pa.array(keep, pa.bool_()))], ["a", "b"])

    met = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")
    return met.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def joined(pairs: DataFrame, roots: DataFrame | None, nodes: DataFrame, docs: DataFrame, spec: Spec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, component) after the links among `pairs` are added to components `roots` (none: every node by itself).

    Pairs within `sure` bits link at once; of the others only those that still lie between two components are
    held against each other by their shingles, so a family of copies that is joined already costs no more.
    """
    told = Stored(distances(pairs, nodes, spec), "simhash-far")
    edges = told.df.where(F.col("far") <= spec.sure).select("a", "b")
    old = [roots.select(F.col("node").alias("a"), F.col("component").alias("b"))] if roots is not None else []
    now = components(functools.reduce(DataFrame.union, [edges, *old]))
    if spec.limit > spec.sure:
        more = similar(_between(told.df.where(F.col("far") > spec.sure).select("a", "b"), now), nodes, docs, spec, id_col, text_col)
        now = components(more.union(now.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    told.drop()
    return now


def near_duplicates(docs: DataFrame, spec: Spec = EXACT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, f0, ..., component_id): the class of each row, named by the smallest doc_id reachable.

    Equal fingerprints are one node, so a group of copies of any size costs what one text does. Null
    and empty texts have fingerprint zero and link like any other; a very long text is folded in pieces;
    repeated ids keep their rows; rows with a null id are returned with the class of their fingerprint. Ids are
    numbers or their decimal form: other text is an error. Half of a bit's hashes set (a tie) is a 0. Only
    the two columns are read, so others' names don't matter; an empty table gives an empty table.
    """
    names = [f"f{k}" for k in range(spec.words)]
    prints = stored(fingerprints(docs, spec, id_col, text_col), "simhash")
    nodes = Stored(prints.groupBy(*names).agg(F.min("doc_id").alias("id")), "simhash-nodes").df
    own = nodes.where("id is not null")
    if spec.blocks == 1 and spec.limit >= spec.radius:
        roots = components(candidate_pairs(meetings(own, spec), spec))  # rows of a variant are within the radius
    else:
        parts = []
        for k in range(0, spec.blocks, _AT_ONCE):
            parts.append(Stored(meetings(own, spec, range(k, min(spec.blocks, k + _AT_ONCE))), "simhash-met"))
            release(docs.sparkSession)
        roots = joined(candidate_pairs(parts[0].df, spec), None, own, docs, spec, id_col, text_col)
        if parts[1:]:  # what the first blocks have joined needs no more pairs, nor do larger variants, which are compared whole
            rest = functools.reduce(DataFrame.union, (p.df for p in parts[1:])).where("n <= 3")
            roots = joined(candidate_pairs(rest, spec, roots), roots, own, docs, spec, id_col, text_col)
        met = functools.reduce(DataFrame.union, (p.df for p in parts))
        more = crowded_pairs(met, own, roots, spec, docs, id_col, text_col)
        roots = components(more.union(roots.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        for p in parts:
            p.drop()
    classes = nodes.join(roots, nodes["id"] == roots["node"], "left").select(*names, F.coalesce("component", "id").alias("component_id"))
    return prints.join(classes, names).select("doc_id", *names, "component_id")


def hexadecimal(word: Column) -> Column:
    return F.lpad(F.lower(F.hex(word)), 16, "0")


def keep_one(docs: DataFrame, spec: Spec = NEAR) -> DataFrame:
    """The rows of `docs` without the near-duplicates of a smaller doc_id; of rows that repeat an id one stays.

    Columns are those of `docs`. Rows with a null id have nothing to be named by and stay.
    """
    classes = near_duplicates(docs, spec).where("doc_id is not null")
    gone = classes.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    left = docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
    twice = Stored(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__twice")), "simhash-repeats").df
    if twice.isEmpty():
        return left
    rows = left.select(F.struct(*left.columns).alias("row"), F.col("doc_id").alias("id"))
    again = rows.join(twice, rows["id"] == twice["__twice"], "left_semi")
    one = again.withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("row")))).where("n = 1")
    once = rows.join(twice, rows["id"] == twice["__twice"], "left_anti")
    return once.select("row.*").union(one.select("row.*"))
