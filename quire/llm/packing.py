"""Sum-of-squares online packing of token sequences into windows.

A document of n tokens fills n // window whole windows; what is left of it is one item. The item
goes to the fill level (or a new window) that minimises the sum over levels of the squared number
of partially filled windows at that level; the counts are kept in an array by level. Every partition
packs what it reads, in order, with its own array: state is bounded by the open windows.

At the end of a partition the items of windows that stayed open are laid out anew, cut where
needed, in whole windows and in sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, internal, sliced, texts

#: White space that a space follows: there a run of white space crosses the cut before a space.
_RUN = re.compile(r"\s ")
#: Texts between spaces whose ids a Python worker remembers, and the longest of them.
_REMEMBERED, _LONGEST = 300_000, 64
#: Documents that are encoded together.
_TOGETHER = 1000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tokenizer:
    """Byte-level BPE ids, as little-endian unsigned 32-bit numbers.

    A pre-token never goes on past a space that follows other text, so a text without runs of white
    space before a space is the join of its parts " word", whose ids are remembered. Parts not seen
    before are encoded together and told apart by the lengths of their tokens. The special tokens'
    strings in a text are one id each; what lies between them is encoded by itself.
    """

    def __init__(self, ranks: bytes, pattern: str, special: dict[str, int] | None = None):
        import tiktoken

        self.special = {t: int(i).to_bytes(4, "little") for t, i in (special or {}).items()}
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.widths = np.zeros(max(merges.values()) + 1, np.int64)
        for token, rank in merges.items():
            self.widths[rank] = len(token)

        class Parts(dict):
            others: dict[str, bytes] = {}  # of the texts at hand, beyond those remembered

            def __missing__(self, part: str) -> bytes:
                return self.others[part]

        self.parts = Parts()

    def plain(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def learn(self, parts: set[str]) -> None:
        new = [p for p in parts if p not in self.parts]
        odd = [p for p in new if not p or p[-1].isspace()]
        new = [p for p in new if p and not p[-1].isspace()]
        ids = np.array(self.encoding.encode_ordinary("".join(f" {p}" for p in new)), "<u4")
        ends = np.cumsum(np.fromiter((len(p.encode()) + 1 for p in new), np.int64, len(new)))
        cuts = np.searchsorted(np.cumsum(self.widths[ids]), ends, side="left") + 1
        raw, self.parts.others, a = ids.tobytes(), {p: self.plain(" " + p) for p in odd}, 0
        for p, b in zip(new, (4 * cuts).tolist(), strict=True):
            (self.parts if len(self.parts) < _REMEMBERED and len(p) <= _LONGEST else self.parts.others)[p] = raw[a:b]
            a = b

    def ids(self, texts: list[str]) -> list[bytes]:
        if not any(t in x for x in texts for t in self.special):
            return self.ordinary(texts)
        parts = [self.cuts.split(x) for x in texts]  # every second part is a special token
        between = iter(self.ordinary([x for p in parts for x in p[::2]]))
        return [b"".join(self.special[x] if k % 2 else next(between) for k, x in enumerate(p)) for p in parts]

    def ordinary(self, texts: list[str]) -> list[bytes]:
        """The ids of texts in which special tokens' strings are text like any other."""
        cut = [None if _RUN.search(t) else t.split(" ") for t in texts]
        self.learn({p for c in cut if c for p in c[1:]})
        return [self.plain(t) if c is None else self.plain(c[0]) + b"".join(map(self.parts.__getitem__, c[1:])) for t, c in zip(texts, cut, strict=True)]


class Packer:
    def __init__(self, window: int, first: int):
        self.window, self.next = window, first
        self.count = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list[tuple]]] = {}
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids) // 4, zlib.crc32(ids), total, self.next, offset))
            offset += len(ids) // 4
        self.next += 1

    def level(self, n: int) -> int:
        """The fill level (0: a new window) that an item of n tokens goes to; ties go to the fuller window."""
        c, w = self.count, self.window
        best, cost = 0, 2 * c[n] + 1
        if n < w:
            d = 2 * (c[n + 1 : w + 1] - c[1 : w - n + 1]) + 2
            d[-1] = 1 - 2 * c[w - n]  # a full window is no longer a partially filled one
            d[c[1 : w - n + 1] == 0] = np.iinfo(np.int64).max
            k = len(d) - 1 - int(np.argmin(d[::-1]))
            if d[k] <= cost:
                best = k + 1
        return best

    def add(self, doc: int | None, ids: bytes) -> None:
        total, w = len(ids) // 4, self.window
        whole = total // w * w
        for start in range(0, whole, w):
            self._emit([(doc, start, ids[4 * start : 4 * (start + w)], total)])
        if n := total - whole:
            h = self.level(n)
            pieces = self.open[h].pop() if h else []
            self.count[h] -= h > 0
            pieces.append((doc, whole, ids[4 * whole :], total))
            if h + n == w:
                self._emit(pieces)
            else:
                self.open.setdefault(h + n, []).append(pieces)
                self.count[h + n] += 1

    def close(self) -> None:
        """Lays out what open windows hold, without padding."""
        left = [p for h in sorted(self.open, reverse=True) for w in self.open[h] for p in w]
        total = sum(len(p[2]) // 4 for p in left)
        sizes = [self.window] * (total // self.window) + [1 << k for k in reversed(range(self.window.bit_length())) if total % self.window >> k & 1]
        at = iter(left)
        doc, start, ids, whole = None, 0, b"", 0
        for size in sizes:
            pieces, room = [], size
            while room:
                if not ids:
                    doc, start, ids, whole = next(at)
                take = min(room, len(ids) // 4)
                pieces.append((doc, start, ids[: 4 * take], whole))
                start, ids, room = start + take, ids[4 * take :], room - take
            self._emit(pieces)
        self.open, self.count[:] = {}, 0

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) or [[] for _ in range(7)]
        self.rows = []
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def special_tokens(path: str) -> dict[str, int]:
    """The special tokens of a tokenizer's JSON file and their ids."""
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}


def pack(
    docs: DataFrame, ranks_path: str | None = None, pattern: str | None = None, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", special: dict[str, int] | None = None
) -> DataFrame:
    """One row for each piece of a document: see SCHEMA; sequence ids are unique, offsets gapless from 0.

    ranks_path: a vocabulary of ranks on the driver (its bytes, under 1 MB, go to the workers) and special:
    its special tokens; the defaults are those of byte_bpe_50k.json. A null or empty text is the end id
    alone; a very long one fills whole windows, and only its rest is held. Rows that repeat are packed
    again; a null id stays null. Ids are numbers or their decimal form: other text is an error. Equal items
    are taken in the order they are read. No rows: no sequences. Only the two columns are read, so others'
    names don't matter.
    """
    internal(docs, id_col, text_col)
    if ranks_path is None or pattern is None or special is None:
        import public_tokenizers

        ranks_path, pattern = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
        special = special_tokens(public_tokenizers.path("byte_bpe_50k.json")) if special is None else special
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        packer, t = Packer(window, (task.partitionId() if task else 0) << 40), held("tokenizer", (zlib.crc32(ranks.value), pattern, *special.items()), lambda: Tokenizer(ranks.value, pattern, special))
        for b in sliced(batches, _TOGETHER):
            for doc, ids in zip(b.column(0).to_pylist(), t.ids(texts(b)), strict=True):
                packer.add(doc, ids + end)
            if len(packer.rows) >= 20_000:
                yield packer.batch()
        packer.close()
        yield packer.batch()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
