"""Language-model scoring with a log-frequency Bloom filter.

Words, word pairs and word triples of the training texts are counted over all of them. The filter holds every
word, and every pair and triple that was seen twice, however large the corpus. A count c becomes the level
1 + floor(log_1.5 (c / least count held)), and the filter holds (n-gram, 1), (n-gram, 2), ... up to its level:
the level of an n-gram is how many memberships in a row hold, so an error can only raise a count, and by little.

The filter grows with the corpus, so it is never in one place and never broadcast: it is cut in shards by the
n-gram's hash, each of a set number of training tokens. Texts are kept as word numbers in chunks of a set number of
tokens. A chunk sends each of its distinct n-grams once to the n-gram's shard, with its count in training rows; one
task builds the shard from them, probes it, and sends their levels back. A row of that exchange holds at least one
n-gram, so it has never more rows than n-grams; an n-gram, however frequent, is in it once a chunk. Words travel as
they are written, so their counts are exact.

The probability of a word mixes its relative frequency after the two words before it, after the word before it and
its add-one frequency, all from the filter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, internal, lower_words, sliced

#: Bits and probes of a membership.
BITS, PROBES = 10, 4
#: The least count of a pair or triple that is held.
LEAST = 2
#: Tokens of a chunk, and training tokens of a shard on average.
_BLOCK, _PER_SHARD = 1_500_000, 1_000_000
_BASE = 1.5
_END = b"\n"  # never a word
_TOP = 120  # levels: 1.5 ** 119 is over 2 ** 64
#: A shard knows an n-gram by this many bits of its hash.
_KEY = np.uint64(40)
_GOLD = 0x9E3779B97F4A7C15


def level_of(count: np.ndarray, least: float = 1.0) -> np.ndarray:
    """0 below `least`, else 1 + floor(log_1.5 (count / least))."""
    ratio = np.asarray(count, float) / least
    return np.where(ratio < 1, 0, 1 + np.floor(np.log(np.maximum(ratio, 1)) / np.log(_BASE) + 1e-9)).astype(np.int64)


def values(least: float = 1.0) -> np.ndarray:
    """The count that each level stands for: the middle of the whole numbers that have it; 0 for level 0."""
    k = np.arange(1, _TOP + 1)
    lo, hi = np.ceil(least * _BASE ** (k - 1) - 1e-9), np.ceil(least * _BASE**k - 1e-9) - 1
    return np.concatenate([[0.0], (lo + np.maximum(lo, hi)) / 2])


def _mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined_hashes(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of all but their last words and those of their last words."""
    return _mixed(before * np.uint64(_GOLD) + word)


class Hashes(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 1)
        if len(self) < 300_000 and len(word) <= 48:
            self[word] = h
        return h


_hashes = Hashes()


def _probes(key: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    x = _mixed(key + np.uint64((level * _GOLD) & (2**64 - 1)))
    return x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)


class Filter:
    """The filter of some n-grams, given their keys and levels: bits of all memberships (n-gram, 1 ... level)."""

    def __init__(self, key: np.ndarray, level: np.ndarray):
        self.bits = max(64, BITS * int(level.sum()))
        on = np.zeros((self.bits + 7) // 8 * 8, bool)
        for k in range(1, int(level.max(initial=0)) + 1):
            a, b = _probes(key[level >= k], k)
            for i in range(PROBES):
                on[(a + np.uint64(i) * b) % np.uint64(self.bits)] = True
        self.data = np.packbits(on, bitorder="little")

    def levels(self, key: np.ndarray) -> np.ndarray:
        """Of each n-gram; repeated membership probes, each for what passed the one before."""
        out, at = np.zeros(len(key), np.uint8), np.arange(len(key))
        for k in range(1, _TOP + 1):
            a, b = _probes(key[at], k)
            for i in range(PROBES):
                p = (a + np.uint64(i) * b) % np.uint64(self.bits)
                hit = (self.data[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 > 0
                at, a, b = at[hit], a[hit], b[hit]
            if not len(at):
                break
            out[at] = k
        return out


def weights(before: np.ndarray) -> np.ndarray:
    """How much a pair's relative frequency counts, by the count of its first word."""
    return 0.5 * before / (before + 1000.0)


#: How much a triple's relative frequency counts where its first two words are held as a pair.
TRIPLE = 0.3


def score(before: np.ndarray, own: np.ndarray, pair: np.ndarray, pair_before: np.ndarray, triple: np.ndarray, total: int, kinds: int) -> np.ndarray:
    """log10 probabilities of words, from the counts of the words before them, their own, those of the pairs they
    end, of the pairs before them (0 at the begin of a text) and of the triples they end."""
    w = weights(before)
    p = (1 - w) * (own + 1) / (total + kinds + 1) + w * np.minimum(1.0, pair / np.maximum(before, 1))
    w = np.where(pair_before > 0, TRIPLE, 0.0)
    return np.log10((1 - w) * p + w * np.minimum(1.0, triple / np.maximum(pair_before, 1)))


def _pack(x: np.ndarray, width: int) -> bytes:
    """Whole numbers as compressed byte planes, `width` bytes each."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return zlib.compress(planes.tobytes(), 1)


def _unpack(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel().astype(np.uint64)


@dataclass
class Chunk:
    """Texts as numbers of words, each text with an end before it and one after it.

    words: the distinct words, frequent ones first; at: the word of each token; lens: tokens of each text;
    learned: whether it is learned from.
    """

    words: list[bytes]
    at: np.ndarray
    lens: np.ndarray
    learned: np.ndarray

    @classmethod
    def read(cls, words: bytes, at: bytes, lens: bytes, learned: bytes) -> Chunk:
        return cls(zlib.decompress(words).split(b" "), _unpack(at, 4).astype(np.int64), _unpack(lens, 5).astype(np.int64), np.frombuffer(learned, np.uint8))

    def __post_init__(self) -> None:
        first = np.cumsum(self.lens) - self.lens
        self.inner = np.ones(len(self.at), bool)  # tokens but for the end before a text
        self.inner[first] = False
        self.later = self.inner.copy()  # those with two tokens before them
        self.later[first + 1] = False

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(_hashes.__getitem__, self.words), np.uint64, len(self.words))

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The hashes of the words, of the pair that each inner token ends, and of the triple that each later one ends."""
        own = self.hashes()
        h = own[self.at]
        pair = joined_hashes(h[:-1], h[1:])  # of token i + 1
        triple = joined_hashes(pair[:-1] ^ np.uint64(_GOLD), h[2:])  # of token i + 2
        return own, pair[self.inner[1:]], triple[self.later[2:]]


def _by_shard(h: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each hash and the key it has there, as one number that sorts by shard, then key."""
    shard = (h >> np.uint64(24)) % np.uint64(shards)
    return (shard << _KEY) | (h & np.uint64((1 << 40) - 1))


def _cuts(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shards that occur, and where each begins, with the end."""
    shard, first = np.unique(sorted_keys >> _KEY, return_index=True)
    return shard.astype(np.int64), np.append(first, len(sorted_keys))


_CHUNK = "chunk long, tokens long, words binary, at binary, lens binary, learned binary"


def chunks_of(docs: DataFrame, train: Column, id_col: str, text_col: str) -> DataFrame:
    """(chunk, tokens, words, at, lens, learned, ids): see Chunk; tokens: training tokens of the chunk."""
    told = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("trained"))
    kind = told.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = (task.partitionId() if task else 0) << 40
        number: dict[bytes, int] = {}
        at: list[np.ndarray] = []
        lens, learned, ids = [], [], []

        def chunk() -> pa.RecordBatch:
            tokens = np.concatenate(at)
            order = np.argsort(-np.bincount(tokens, minlength=len(number)), kind="stable")  # frequent words get low numbers, whose bytes compress
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order))
            words, sizes = list(number), np.array(lens)
            row = [
                pa.array([name], pa.int64()), pa.array([int((sizes - 1) @ np.array(learned))], pa.int64()), pa.array([zlib.compress(b" ".join(words[i] for i in order.tolist()), 1)], pa.binary()),
                pa.array([_pack(place[tokens], 4)], pa.binary()), pa.array([_pack(sizes, 5)], pa.binary()), pa.array([np.array(learned, np.uint8).tobytes()], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(lens)], pa.int32()), pa.concat_arrays(ids)),
            ]
            return pa.RecordBatch.from_arrays(row, ["chunk", "tokens", "words", "at", "lens", "learned", "ids"])

        size = 0
        for b in sliced(batches, 200):
            for text, trained in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                ws = [_END, *lower_words(text or ""), _END]
                at.append(np.fromiter((number.setdefault(w, len(number)) for w in ws), np.uint32, len(ws)))
                lens.append(len(ws))
                learned.append(bool(trained))
                size += len(ws)
            ids.append(b.column(0))
            if size > _BLOCK:
                yield chunk()
                name, size = name + 1, 0
                number, at, lens, learned, ids = {}, [], [], [], []
        if lens:
            yield chunk()

    return told.mapInArrow(run, f"{_CHUNK}, ids array<{kind}>")


_GRAMS = ("pair", "triple")
_SHARE = "chunk long, shard int, words binary, word_counts binary, pair_keys binary, pair_counts binary, triple_keys binary, triple_counts binary"


def chunk_shares(chunks: DataFrame, shards: int) -> DataFrame:
    """Rows of _SHARE: the distinct n-grams of each chunk by shard (words by number, others by key), with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                name, *parts = (x[i].as_py() for x in b.columns)
                c = Chunk.read(*parts)
                learned = np.repeat(c.learned, c.lens)
                own, *grams = c.grams()
                rows: dict[int, dict[str, bytes]] = {}
                word = _by_shard(own, shards)
                order = np.argsort(word >> _KEY, kind="stable")
                counts = np.bincount(c.at[c.inner], learned[c.inner], len(own)).astype(np.int64)[order]
                shard, first = _cuts(word[order])
                for s, lo, hi in zip(shard.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                    rows[s] = {"words": zlib.compress(b" ".join(c.words[k] for k in order[lo:hi].tolist()), 1), "word_counts": _pack(counts[lo:hi], 5)}
                for kind, h, where in zip(_GRAMS, grams, (c.inner, c.later), strict=True):
                    u, at = np.unique(_by_shard(h, shards), return_inverse=True)
                    n = np.bincount(at, learned[where], len(u)).astype(np.int64)
                    shard, first = _cuts(u)
                    for s, lo, hi in zip(shard.tolist(), first[:-1].tolist(), first[1:].tolist(), strict=True):
                        rows.setdefault(s, {}).update({f"{kind}_keys": _pack(u[lo:hi], 5), f"{kind}_counts": _pack(n[lo:hi], 5)})
                some = sorted(rows)
                cols = [pa.array([name] * len(some), pa.int64()), pa.array(some, pa.int32())]
                names = [f.split()[0] for f in _SHARE.split(", ")]
                cols += [pa.array([rows[s].get(n) for s in some], pa.binary()) for n in names[2:]]
                yield pa.RecordBatch.from_arrays(cols, names)

    return chunks.select("chunk", "words", "at", "lens", "learned").mapInArrow(run, _SHARE)


_LEVELS = "chunk long, shard int, word_counts binary, word_levels binary, pair_levels binary, triple_levels binary, total long, kinds long"


def _parts(column: pa.ChunkedArray, read) -> tuple[list, np.ndarray]:
    """What each row of a column holds (nothing for null), and where each begins, with the end."""
    got = [read(x) if x is not None else read(None) for x in column.to_pylist()]
    return got, np.cumsum([0, *map(len, got)])


def shard_levels(shares: DataFrame) -> DataFrame:
    """Rows of _LEVELS: for each of `shares` the training counts of its words and the levels of its n-grams, in their order;
    total, kinds: training tokens and distinct training words of the shard, in one row of it."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        numbers = lambda x: np.empty(0, np.uint64) if x is None else _unpack(x, 5)
        words, edges = _parts(table.column("words"), lambda x: [] if x is None else zlib.decompress(x).split(b" "))
        coded = pa.array([w for part in words for w in part], pa.binary()).dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        own = np.fromiter(map(_hashes.__getitem__, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        count = _sums(at, np.concatenate([np.empty(0, np.uint64), *_parts(table.column("word_counts"), numbers)[0]]), len(own))
        found = [(own & np.uint64((1 << 40) - 1), at, edges, level_of(count))]
        for kind in _GRAMS:
            keys, edges2 = _parts(table.column(f"{kind}_keys"), numbers)
            u, place = np.unique(np.concatenate([np.empty(0, np.uint64), *keys]), return_inverse=True)
            n = _sums(place, np.concatenate([np.empty(0, np.uint64), *_parts(table.column(f"{kind}_counts"), numbers)[0]]), len(u))
            found.append((u, place, edges2, level_of(n, LEAST)))
        held = [level > 0 for *_, level in found]
        shard = Filter(np.concatenate([k[h] for (k, *_), h in zip(found, held, strict=True)]), np.concatenate([level[h] for (*_, level), h in zip(found, held, strict=True)]))
        cols = [table.column("chunk"), table.column("shard"), pa.array([_pack(count[at[lo:hi]], 6) for lo, hi in zip(edges[:-1], edges[1:], strict=True)], pa.binary())]
        for keys, place, ends, _ in found:
            got = shard.levels(keys)[place]
            cols.append(pa.array([_pack(got[lo:hi], 1) for lo, hi in zip(ends[:-1], ends[1:], strict=True)], pa.binary()))
        once = [None] * (table.num_rows - 1)
        cols += [pa.array([int(count.sum()), *once], pa.int64()), pa.array([int((count > 0).sum()), *once], pa.int64())]
        return pa.table(cols, names=[f.split()[0] for f in _LEVELS.split(", ")])

    return shares.groupBy("shard").applyInArrow(run, _LEVELS)


def _sums(at: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by place, exact below 2 ** 53."""
    return np.bincount(at, n.astype(np.float64), size).astype(np.int64)


def chunk_scores(chunks: DataFrame, levels: DataFrame, shards: int, total: int, kinds: int) -> DataFrame:
    """(doc_id, trained, n_tokens, n_known, train_tokens, base_score, score) of each text of the chunks."""
    kind = chunks.schema["ids"].dataType.elementType.simpleString()

    def run(key: tuple, chunk: pa.Table, levels: pa.Table) -> pa.Table:
        c = Chunk.read(*(chunk.column(n)[0].as_py() for n in ("words", "at", "lens", "learned")))
        by = levels.sort_by("shard")
        whole = lambda n, width: np.concatenate([np.empty(0, np.uint64), *(_unpack(x, width) for x in by.column(n).to_pylist())])
        own, pairs, triples = c.grams()
        order = np.argsort(_by_shard(own, shards) >> _KEY, kind="stable")
        count, level = np.empty(len(own)), np.empty(len(own), np.int64)
        count[order], level[order] = whole("word_counts", 6), whole("word_levels", 1)
        one = values()[level][c.at]
        two, three = np.zeros(len(c.at)), np.zeros(len(c.at))
        for h, out, where, name in ((pairs, two, c.inner, "pair_levels"), (triples, three, c.later, "triple_levels")):
            out[where] = values(LEAST)[whole(name, 1).astype(np.int64)[np.unique(_by_shard(h, shards), return_inverse=True)[1]]]
        inner = c.inner[1:]
        before = np.where(c.later[1:], two[:-1], 0.0)
        logs = score(one[:-1][inner], one[1:][inner], two[1:][inner], before[inner], three[1:][inner], total, kinds)
        exact = count[c.at[1:][inner]]
        inside = c.lens - 1  # at least the end
        first = np.cumsum(inside) - inside
        base = np.add.reduceat(np.log10((exact + 1) / (total + kinds + 1.0)), first)
        known = np.add.reduceat((exact > 0).astype(np.int64), first)
        cols = [chunk.column("ids").chunk(0).flatten(), pa.array(c.learned.astype(bool)), pa.array(inside), pa.array(known), pa.array(np.full(len(inside), total)), pa.array(base), pa.array(np.add.reduceat(logs, first))]
        return pa.table(cols, names=["doc_id", "trained", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = f"doc_id {kind}, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return chunks.drop("tokens").groupBy("chunk").cogroup(levels.drop("total", "kinds").groupBy("chunk")).applyInArrow(run, schema)


def score_documents(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, trained, n_tokens, n_known, train_tokens, base_score, score), one row for each of `docs`.

    `train`: whether a row is learned from (null: it isn't). Counts are exact for n_known and base_score (add-one word
    probabilities) and from the filter for `score`. Null and empty texts are one end; a very long text is in one
    chunk with others or by itself; repeated rows and ids count and are scored as often as they occur, and texts
    that tie get equal scores; without training rows every word is unknown; an empty table gives an empty table.
    Only the two columns are read, so others' names don't matter.
    """
    internal(docs, id_col, text_col)
    chunks = Stored(chunks_of(docs, train, id_col, text_col), "lm-chunks").df
    tokens = int(chunks.agg(F.sum("tokens").alias("n")).first()["n"] or 0)
    shards = max(1, min(1 << 24, -(-tokens // _PER_SHARD)))
    levels = Stored(shard_levels(chunk_shares(chunks, shards)), "lm-levels").df
    sums = levels.agg(F.sum("total").alias("n"), F.sum("kinds").alias("v")).first()
    return chunk_scores(chunks, levels, shards, int(sums["n"] or 0), int(sums["v"] or 0))
