"""Toxicity by cumulative-link ordinal regression.

The probability that a document's grade is at most k is logistic(threshold_k - w . x), with one weight
vector for all ordered thresholds. x holds log(1 + count) of sparse text features: words and their
first four to seven letters, and again those that occur twice or more. Labels are binary; the grade of a toxic
training document is 1, 2 or 3 by the tercile of its amount: how many of its words the other half of the sample
tells to be toxic, so that no document is graded by what was learned from itself. The severity is the expected grade.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, internal, sliced

#: Labelled documents that are fitted on at most, by a hash of the id; they bound the features, too.
MAX_LABELS = 20_000
#: A feature is in this many toxic training documents at least, and so many times as often as chance; in a half of the sample in so many.
MIN_DOCS, MIN_ODDS, MIN_HALF = 4, 8.0, 2
GRADES = 4
PREFIXES = (4, 5, 6, 7)
_WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def names(word: str) -> tuple[str, ...]:
    """The features of a word: itself, and prefixes marked by a star."""
    return (word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n))


def features(text: str) -> set[str]:
    """All features of a text; a plus marks those that occur twice or more."""
    counts: Counter = Counter()
    for w, n in Counter(tokens(text)).items():
        for x in names(w):
            counts[x] += n
    return {*counts, *(x + "+" for x, n in counts.items() if n > 1)}


@dataclass
class Model:
    """features: name -> column; weights; thresholds in order, one fewer than grades."""

    features: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def vector(self, text: str, seen: dict[str, tuple]) -> dict[int, int]:
        """Counts of features. seen: remembers words' features, as pairs of columns (once, twice or more; -1: none)."""
        counts: Counter = Counter()
        get = self.features.get
        for w, n in Counter(tokens(text)).items():
            f = seen.get(w)
            if f is None:
                f = tuple(p for x in names(w) if (p := (get(x, -1), get(x + "+", -1))) != (-1, -1))
                if len(seen) < 500_000 and len(w) <= 40:
                    seen[w] = f
            for p in f:
                counts[p] += n
        return {i: n for (once, twice), n in sorted(counts.items()) for i in ((once, twice) if n > 1 else (once,)) if i >= 0}


    def grades(self, x: dict[int, int]) -> np.ndarray:
        """The probability of each grade."""
        return _grades(self.thresholds, np.array([sum(self.weights[i] * np.log1p(n) for i, n in x.items())]))[0]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _grades(thresholds: np.ndarray, value: np.ndarray) -> np.ndarray:
    below = np.hstack([np.zeros((len(value), 1)), _sigmoid(thresholds[None, :] - value[:, None]), np.ones((len(value), 1))])
    return np.diff(below, axis=1)


def ordinal(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, grade: np.ndarray, k: int, grades: int = GRADES, steps: int = 400, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps (Adam) on the mean log-loss of a sparse matrix.

    Thresholds are the first and positive gaps, so they stay in order; weights are not negative, as
    features were chosen for occurring in toxic documents.
    """
    n = len(grade)
    theta = np.concatenate([np.full(k, 0.5), [1.0], np.zeros(grades - 2)])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        w, first, gaps = theta[:k], theta[k], np.exp(theta[k + 1 :])
        cut = first + np.concatenate([[0.0], np.cumsum(gaps)])
        value = np.bincount(rows, vals * w[cols], n)
        s = np.hstack([np.zeros((n, 1)), _sigmoid(cut[None, :] - value[:, None]), np.ones((n, 1))])
        p = np.maximum(s[np.arange(n), grade + 1] - s[np.arange(n), grade], 1e-12)
        d = s * (1 - s)
        hi, lo = d[np.arange(n), grade + 1] / p, d[np.arange(n), grade] / p
        by_value = (hi - lo) / n  # of the loss
        by_cut = np.array([(lo[grade == j + 1].sum() - hi[grade == j].sum()) / n for j in range(grades - 1)])
        g = np.concatenate([np.bincount(cols, vals * by_value[rows], k) + ridge * w, [by_cut.sum()], np.cumsum(by_cut[::-1])[::-1][1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        theta[:k] = np.maximum(theta[:k], 0)
    return theta[:k], theta[k] + np.concatenate([[0.0], np.cumsum(np.exp(theta[k + 1 :]))])


def amount(text: str, told: set[str]) -> int:
    """How many of a text's words have a feature in `told`."""
    return sum(n for w, n in Counter(tokens(text)).items() if not told.isdisjoint(names(w)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labels: int = MAX_LABELS, seed: int = 42) -> Model:
    """labels: (doc_id, label_col); only labels of 0 or 1 count. Without a toxic one every severity is 0.

    Null and empty texts have no features. A row counts as often as its id repeats in `docs` and `labels`;
    documents of one amount get one grade. An empty table is one without labels.
    """
    internal(docs, id_col, text_col)
    spark = docs.sparkSession
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col("doc_id").alias("__id"), F.col(label_col).cast("int").alias("y"))
    count = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = {y: min(1.0, max_labels / 2 / n) for y, n in count.items()}
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "__id"), 11) / F.lit(float(1 << 53))
    half = F.pmod(F.xxhash64(F.lit(seed + 1), "__id"), F.lit(2)).cast("int")
    some = known.where(unit < F.when(F.col("y") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0)))  # about max_labels rows
    told = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("text")).join(F.broadcast(some), F.col("__doc") == F.col("__id")).select("text", "y", half.alias("half"))
    sample = Stored(told, "toxicity-sample").df
    kinds = [(y, h) for y in (0, 1) for h in (0, 1)]

    def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            found: dict[tuple[int, int], Counter] = {k: Counter() for k in kinds}
            for text, y, h in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found[y, h].update(features(text or ""))
            f = list(set().union(*found.values()))
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), *(pa.array([found[k][x] for x in f], pa.int64()) for k in kinds)], ["f", *(f"n{y}{h}" for y, h in kinds)])

    size = {(r["y"], r["half"]): r["count"] for r in sample.groupBy("y", "half").count().collect()}
    counted = sample.mapInArrow(count_features, "f string, " + ", ".join(f"n{y}{h} long" for y, h in kinds)).groupBy("f").agg(*(F.sum(f"n{y}{h}").alias(f"n{y}{h}") for y, h in kinds))

    def marked(halves: tuple[int, ...], least: int) -> Column:
        n0, n1 = (sum((F.col(f"n{y}{h}") for h in halves), F.lit(0)) for y in (0, 1))
        s0, s1 = (sum(size.get((y, h), 0) for h in halves) for y in (0, 1))
        return (n1 >= least) & ((n1 + 0.5) / (s1 + 1.0) / ((n0 + 0.5) / (s0 + 1.0)) >= MIN_ODDS)

    freq = counted.select("f", marked((0, 1), MIN_DOCS).alias("chosen"), *(marked((h,), MIN_HALF).alias(f"told{h}") for h in (0, 1)))
    rows = freq.where("chosen or told0 or told1").orderBy("f").collect()  # features of a bounded sample
    chosen = [r["f"] for r in rows if r["chosen"]]
    model = Model({f: i for i, f in enumerate(chosen)}, np.zeros(len(chosen)), np.full(GRADES - 1, 30.0))
    if not chosen:
        return model
    by_half = [{r["f"] for r in rows if r[f"told{h}"]} for h in (0, 1)]
    shared = spark.sparkContext.broadcast((model, by_half))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (model, by_half), seen = shared.value, {}
        for b in sliced(batches):
            texts, y, h = (c.to_pylist() for c in b.columns)
            got = [model.vector(t or "", seen) for t in texts]
            much = [amount(t or "", by_half[1 - k]) if bad else 0 for t, bad, k in zip(texts, y, h, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([list(x) for x in got], pa.list_(pa.int32())), pa.array([list(x.values()) for x in got], pa.list_(pa.int32())), b.column(1), pa.array(much, pa.int64())], ["i", "n", "y", "much"])

    rows = sample.mapInArrow(vectors, "i array<int>, n array<int>, y int, much long").collect()  # about max_labels rows of a few features
    toxic, much = np.array([r["y"] for r in rows]) == 1, np.array([r["much"] for r in rows])
    cuts = np.quantile(much[toxic], [1 / 3, 2 / 3]) if toxic.any() else np.zeros(2)
    grade = np.where(toxic, 1 + np.searchsorted(cuts, much, side="left"), 0)
    at = np.repeat(np.arange(len(rows)), [len(r["i"]) for r in rows])
    cols = np.array([i for r in rows for i in r["i"]], np.int64)
    vals = np.log1p(np.array([n for r in rows for n in r["n"]], float))
    model.weights, model.thresholds = ordinal(at, cols, vals, grade, len(chosen))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, grade, p_toxic): expected and likeliest grade, probability of any grade above 0.

    One row for each of `docs`; a null or empty text has no features and the severity they leave; of grades that
    tie the least counts; equal texts, however long, get equal values. Only the two columns are read, so others' names
    don't matter; an empty table gives an empty table.
    """
    internal(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple] = {}
        for b in sliced(batches):
            value = np.array([sum(shared.value.weights[i] * np.log1p(n) for i, n in shared.value.vector(t or "", seen).items()) for t in b.column(1).to_pylist()], float)
            p = _grades(shared.value.thresholds, value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p @ np.arange(GRADES), pa.float64()), pa.array(p.argmax(axis=1), pa.int32()), pa.array(1 - p[:, 0], pa.float64())], ["doc_id", "severity", "grade", "p_toxic"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, severity double, grade int, p_toxic double")
