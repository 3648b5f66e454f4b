"""Language identification: script ranges, word scores, Viterbi with a switching penalty.

A word's script (by code point ranges) narrows the candidates to the languages whose training words
use that script. Its score under each of them is the log-probability of its letter n-grams. Viterbi
over the words, where a change of language costs a penalty, labels every word and so the spans of a
mixed text. A text gets the language of most of its letters.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held, internal, sliced

UNKNOWN = "und"
#: First code points of script ranges and their names, in order (fixed values of the Unicode charts).
SCRIPT_STARTS = (0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0750, 0x0900, 0x0980, 0x0A00, 0x0E00, 0x0E80, 0x10A0, 0x1100, 0x1200, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x30A0, 0x3100, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0xFB1D, 0xFB50, 0xFE00, 0xFF66, 0xFFA0, 0x20000)
SCRIPT_NAMES = ("latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "other", "devanagari", "bengali", "other", "thai", "other", "georgian", "hangul", "ethiopic", "latin", "greek", "other", "kana", "kana", "han", "hangul", "other", "han", "latin", "hebrew", "arabic", "other", "kana", "hangul", "han")
#: Letters, with the combining marks among and after them (vowel signs and the like).
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Buckets of hashed n-grams, n-gram lengths, words that are scored together.
_BUCKETS, _ORDERS, _TOGETHER = 1 << 16, (1, 2, 3, 4), 20_000
#: Documents a language that are fitted on at most (all, if it has fewer), chosen by a hash of the id.
MAX_DOCS = 2000
_REMEMBERED, _LONGEST, _BATCH = 300_000, 40, 3_000_000


def script(word: str) -> str:
    """The script of a word's first letter."""
    return SCRIPT_NAMES[bisect.bisect_right(SCRIPT_STARTS, ord(word[0])) - 1]


def _grams(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: hash buckets of the n-grams of UTF-8 bytes of lower-case words with their ends marked, and whose they are."""
    raw = [b"\x02" + w.lower().encode("utf-8", "surrogatepass") + b"\x03" for w in words]
    lens = np.fromiter(map(len, raw), np.int64, len(raw))
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(raw)), lens)
    left = np.cumsum(lens)[owner] - np.arange(len(data))  # bytes from here to the end of the word
    h = np.zeros(len(data) + 1, np.uint64)
    for n in range(1, max(_ORDERS) + 1):
        h = h[:-1] * np.uint64(1_000_003) + data[n - 1 :] + np.uint64(1)
        if n in _ORDERS:
            whole = left[: len(h)] >= n
            yield ((h[whole] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64) % _BUCKETS, owner[: len(h)][whole]


@dataclass
class Model:
    """languages in order; log_prob: (bucket, language); scripts: script -> which languages use it."""

    languages: list[str]
    log_prob: np.ndarray
    scripts: dict[str, np.ndarray]
    penalty: float = 8.0

    def words(self, words: list[str]) -> np.ndarray:
        """Scores of words, relative to the best; where no language uses the script all candidates are equal."""
        out = np.zeros((len(words), len(self.languages)))
        for lo in range(0, len(words), _TOGETHER):
            part = words[lo : lo + _TOGETHER]
            for bucket, owner in _grams(part):
                for k in range(len(self.languages)):
                    out[lo : lo + len(part), k] += np.bincount(owner, self.log_prob[bucket, k], len(part))
        out /= len(_ORDERS)
        kinds = np.array([script(w) for w in words])
        for name in set(kinds.tolist()):
            at, allowed = np.flatnonzero(kinds == name), self.scripts.get(name)
            if allowed is None:
                out[at] = 0
            else:
                out[np.ix_(at, np.flatnonzero(~allowed))] = out[at].min(axis=1, keepdims=True) - 30 if len(at) else 0
        return (out - out.max(axis=1, keepdims=True)).astype(np.float32) if len(words) else out.astype(np.float32)


class Labeller:
    """Labels texts; remembers the scores of words, most of which recur."""

    def __init__(self, model: Model):
        self.model = model
        self.scores = np.zeros((1024, len(model.languages)), np.float32)

        class Ids(dict):
            others: dict[str, int] = {}  # of the texts at hand, beyond those remembered

            def __missing__(self, word: str) -> int:
                return self.others[word]

        self.ids = Ids()

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.ids]
        room = _REMEMBERED - len(self.ids)
        kept = [w for w in new if len(w) <= _LONGEST][:room]
        known = set(kept)
        new = kept + [w for w in new if w not in known]
        first = len(self.ids)
        if first + len(new) > len(self.scores):
            self.scores = np.concatenate([self.scores[:first], np.zeros((first + 2 * len(new), self.scores.shape[1]), np.float32)])
        self.scores[first : first + len(new)] = self.model.words(new)
        self.ids.update(zip(kept, range(first, first + len(kept)), strict=True))
        self.ids.others = dict(zip(new[len(kept) :], range(first + len(kept), first + len(new)), strict=True))

    def paths(self, docs: list[list[int]]) -> list[np.ndarray]:
        """The best language of each word, for documents of word ids.

        All documents step together: they are in order of length, and the arrays hold the first words
        of all, then the second words of those that have two, and so on.
        """
        n, k = len(docs), len(self.model.languages)
        order = sorted(range(n), key=lambda i: -len(docs[i]))
        lens = np.array([len(docs[i]) for i in order], np.int64)
        longest = int(lens[0]) if n else 0
        alive = np.searchsorted(-lens, -np.arange(longest), side="left")  # documents with more than t words
        begin = np.concatenate([[0], np.cumsum(alive)])
        first = np.repeat(np.cumsum(lens) - lens, lens)
        place = begin[np.arange(len(first)) - first] + np.repeat(np.arange(n), lens)
        ids = np.empty(len(place), np.int64)
        ids[place] = np.fromiter((w for i in order for w in docs[i]), np.int64, len(place))
        flat = self.scores[ids]
        stay, came = np.empty((len(place), k), bool), np.empty(len(place), np.int16)
        best, begins, alives = np.zeros((n, k), np.float32), begin.tolist(), alive.tolist()
        for t, a in enumerate(alives):
            at, b = slice(begins[t], begins[t + 1]), best[:a]
            if t:
                switch = b.max(axis=1, keepdims=True) - self.model.penalty
                came[at] = b.argmax(axis=1)
                np.greater_equal(b, switch, out=stay[at])
                np.maximum(b, switch, out=b)
            b += flat[at]
        state, label = best.argmax(axis=1), np.empty(len(place), np.int16)
        row = np.arange(n)
        for t in range(longest - 1, -1, -1):
            a, at = alives[t], slice(begins[t], begins[t + 1])
            label[at] = now = state[:a]
            if t:
                state[:a] = np.where(stay[at][row[:a], now], now, came[at])
        out: list[np.ndarray] = [np.empty(0, np.int16)] * n
        for i, part in zip(order, np.split(label[place], np.cumsum(lens)[:-1]) if n else [], strict=True):
            out[i] = part
        return out

    def label(self, texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
        """(words, language of each) for each text."""
        for part in self._cuts(texts):
            found = [_WORD.findall(t) for t in texts[part]]
            self.learn(set().union(*found))
            yield from zip(found, self.paths([list(map(self.ids.__getitem__, w)) for w in found]), strict=True)

    @staticmethod
    def _cuts(texts: list[str]) -> Iterator[slice]:
        lo = chars = 0
        for i, t in enumerate(texts):
            chars += len(t)
            if chars > _BATCH:
                yield slice(lo, i + 1)
                lo, chars = i + 1, 0
        if lo < len(texts):
            yield slice(lo, len(texts))


def fit(rows: DataFrame, max_docs: int = MAX_DOCS, penalty: float = 8.0) -> Model:
    """rows: (doc_id, text, lang), lang not null. About `max_docs` documents a language, by a hash of the id."""
    spark = rows.sparkSession
    n = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not n:
        return Model([], np.zeros((_BUCKETS, 0), np.float32), {}, penalty)
    share = spark.createDataFrame([(k, min(1.0, max_docs / v)) for k, v in n.items()], "lang string, share double").coalesce(1)
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id"), 11) / F.lit(float(1 << 53))
    some = rows.join(F.broadcast(share), "lang").where(unit < F.col("share")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        for b in sliced(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words[lang].update(_WORD.findall(text or ""))
        langs, keys, counts = [], [], []
        for lang, c in words.items():
            total, scripts, names = np.zeros(_BUCKETS), Counter(), list(c)
            for w, k in c.items():
                scripts[script(w)] += k
            for lo in range(0, len(names), _TOGETHER):
                part = names[lo : lo + _TOGETHER]
                n = np.array([c[w] for w in part], float)
                for bucket, owner in _grams(part):
                    total += np.bincount(bucket, n[owner], _BUCKETS)
            grams = {g: int(total[g]) for g in np.flatnonzero(total).tolist()}
            for name, k in scripts.items():
                langs.append(lang), keys.append(f"s{name}"), counts.append(k)
            for g, k in grams.items():
                langs.append(lang), keys.append(str(g)), counts.append(k)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(keys, pa.string()), pa.array(counts, pa.int64())], ["lang", "key", "n"])

    # at most (buckets + scripts) rows a language
    got = some.mapInArrow(count, "lang string, key string, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(n)
    at = {x: i for i, x in enumerate(languages)}
    counts = np.full((_BUCKETS, len(languages)), 0.5, np.float64)
    is_script = got["key"].str.startswith("s")
    g, s = got[~is_script], got[is_script]
    counts[g["key"].astype(int).to_numpy(), g["lang"].map(at).to_numpy()] += g["n"].to_numpy()
    scripts: dict[str, np.ndarray] = {}
    for lang, part in s.groupby("lang"):
        for key, k in zip(part["key"], part["n"], strict=True):
            if k >= 0.01 * part["n"].sum():
                scripts.setdefault(key[1:], np.zeros(len(languages), bool))[at[lang]] = True
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32), scripts, penalty)


def spans(words: list[str], labels: np.ndarray, languages: list[str]) -> list[tuple[str, int, int]]:
    """(language, first word, words) of each run of one language."""
    cuts = np.flatnonzero(np.diff(labels)) + 1
    edges = [0, *cuts.tolist(), len(words)] if len(words) else []
    return [(languages[labels[a]], a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of `docs` with __lang, __score and __spans.

    __lang: the language of most letters, or `und` where the text is null or has no letter (or nothing
    was learned); ties go to the first in order. __score: its share of the letters; 0 for `und`.
    __spans: array of (lang, first word, words). Columns of these names are replaced; repeated rows stay; a very
    long text is labelled whole, by itself; an empty table gives an empty table.
    """
    internal(docs, text_col)
    docs = docs.drop("__lang", "__score", "__spans")
    at, shared = docs.columns.index(text_col), docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages
    span_type = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = held("langid", id(shared.value), lambda: Labeller(shared.value))  # it holds the model, so the id stays its own
        languages = labeller.model.languages
        for b in sliced(batches):
            langs, scores, every = [], [], []
            texts = [t or "" for t in b.column(at).to_pylist()]
            for words, labels in labeller.label(texts) if languages else (([], np.empty(0, np.int16)) for _ in texts):
                if not len(words):
                    langs.append(UNKNOWN), scores.append(0.0), every.append([])
                    continue
                letters = np.bincount(labels, np.fromiter(map(len, words), float, len(words)), len(languages))
                k = int(letters.argmax())
                langs.append(languages[k]), scores.append(float(letters[k] / letters.sum()))
                every.append([{"lang": x, "first": i, "words": n} for x, i, n in spans(words, labels, languages)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(every, span_type)], [*b.schema.names, "__lang", "__score", "__spans"])

    empty = F.array().cast("array<struct<lang:string,first:int,words:int>>")
    return docs.mapInArrow(run, docs.select("*", F.lit("").alias("__lang"), F.lit(0.0).alias("__score"), empty.alias("__spans")).schema)


def training(docs: DataFrame, keep: Column) -> DataFrame:
    return docs.where(keep & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
