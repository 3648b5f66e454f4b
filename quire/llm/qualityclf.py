"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A document is a vector of statistics of its whole text. Random Fourier features approximate a
Gaussian kernel over the standardised vectors; the ridge weights solve normal equations that are
summed by partition; isotonic regression on training rows kept out of them turns the values into
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, internal, sliced
from .rules import SYMBOLS, duplicate_lines, repeated_words

#: Labelled rows that are fitted on at most, chosen by a hash of the id; random features; ridge; kernel width.
MAX_LABELS, FEATURES, RIDGE, WIDTH = 20_000, 256, 1e-2, 4.0
#: Partitions that sum the normal equations.
_PARTS = 8
NAMES = ("log_words", "log_chars", "word_length", "longest_word", "symbols", "exclamations", "digits", "capitals", "sentence_ends", "commas", "beyond_ascii", "lines", "kinds", "repeated", "adjacent", "duplicate_lines", "entropy", "marked_words")


def statistics(text: str) -> list[float]:
    """The values of NAMES; all zero for a text without words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    lower, upper, digits = int(hist[97:123].sum()), int(hist[65:91].sum()), int(hist[48:58].sum())
    p = hist[hist > 0] / size
    symbols = int(sum(hist[ord(c)] for c in SYMBOLS))
    marked = sum(any(c in w for c in SYMBOLS) for w in text.split()) if symbols else 0
    lines = int(hist[10]) + 1
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [
        np.log1p(n),
        np.log1p(size),
        sum(map(len, words)) / n,
        np.log1p(max(map(len, words))),
        min(1.0, symbols / n),
        min(1.0, int(hist[33]) / n),
        digits / size,
        upper / max(1, upper + lower),
        min(1.0, int(hist[46] + hist[63] + hist[33]) / n),
        min(1.0, int(hist[44]) / n),
        int(hist[128:].sum()) / size,
        min(1.0, lines / n),
        len(set(words)) / n**0.8,
        repeated_words(words) / n,
        same / n,
        duplicate_lines(raw) / lines,
        float(-(p * np.log2(p)).sum()),
        marked / n,
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of each row's text; null is the empty text, a very long one is read whole.

    Repeated rows are repeated. Only the two columns are read, so others' names don't matter; an empty table gives an
    empty table.
    """
    internal(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            x = [statistics(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<double>")


def isotonic(value: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (value, probability) of the non-decreasing least-squares fit, by pooling adjacent violators.

    Rows of one value are one block; probabilities are drawn in by half a row at either end.
    """
    uniq, at = np.unique(value, return_inverse=True)
    weight = np.bincount(at).astype(float)
    total = np.bincount(at, label)
    blocks: list[list[float]] = []  # sum, weight, sum of values
    for v, t, w in zip(uniq.tolist(), total.tolist(), weight.tolist(), strict=True):
        blocks.append([t, w, v * w])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    x = np.array([b[2] / b[1] for b in blocks])
    y = np.array([(b[0] + 0.5 * (len(blocks) > 1)) / (b[1] + (len(blocks) > 1)) for b in blocks])
    return x, np.clip(np.maximum.accumulate(y), 1e-6, 1 - 1e-6)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    freq: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]
    prior: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features, with a constant and the vector itself."""
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.freq + self.phase)
        return np.hstack([waves, np.ones((len(x), 1)), 0.1 * z])

    def value(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), self.prior)
        return np.interp(self.value(x), *self.knots)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def fit(rows: DataFrame, labels: DataFrame, label_col: str, max_labels: int = MAX_LABELS, seed: int = 42) -> Model:
    """rows: as of `features`. labels: (doc_id, label_col); only rows with a label of 0 or 1 count.

    Without labels, or with one class, every score is the share of label 1 (a half without labels); so it is
    with empty tables. A row counts as often as its id repeats in `rows` and `labels`; null ids match nothing.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col("doc_id").alias("__id"), F.col(label_col).cast("double").alias("y"))
    n = known.count()
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "__id"), 11) / F.lit(float(1 << 53))
    some = known.where(unit < min(1.0, max_labels / max(1, n)))  # about max_labels rows
    sample = Stored(rows.join(F.broadcast(some), rows["doc_id"] == some["__id"]).select("doc_id", "x", "y").repartition(_PARTS, "doc_id"), "quality-sample").df
    k = len(NAMES)
    s = sample.agg(F.count("*").alias("n"), F.avg("y").alias("y"), *(F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(k)), *(F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(k))).first()
    rng = np.random.default_rng(seed)
    prior = 0.5 if s["y"] is None else float(s["y"])
    mean = np.array([s[f"m{i}"] or 0.0 for i in range(k)])
    scale = np.array([max(s[f"s{i}"] or 0.0, 1e-6) for i in range(k)])
    model = Model(mean, scale, rng.normal(size=(k, FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES), np.empty(0), (np.array([0.0]), np.array([prior])), prior)
    if not s["n"] or prior in (0.0, 1.0):
        return model
    fold = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(4))

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = FEATURES + 1 + k
        a, b = np.zeros((m, m)), np.zeros(m)
        for batch in batches:
            z = model.expand(_matrix(batch.column(0)))
            a += z.T @ z
            b += z.T @ batch.column(1).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([b.tobytes()], pa.binary())], ["a", "b"])

    sums = sample.where(fold != 0).select("x", "y").mapInArrow(equations, "a binary, b binary").collect()  # one row a partition of _PARTS
    m = FEATURES + 1 + k
    a = sum((np.frombuffer(r["a"]).reshape(m, m) for r in sums), np.zeros((m, m)))
    b = sum((np.frombuffer(r["b"]) for r in sums), np.zeros(m))
    model.weights = np.linalg.solve(a + RIDGE * np.eye(m), b)
    rest = sample.where(fold == 0).select("x", "y").toPandas()  # a quarter of max_labels rows
    if len(rest):
        model.knots = isotonic(model.value(np.array(rest["x"].tolist()).reshape(-1, k)), rest["y"].to_numpy())
    return model


def score(rows: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): the probability of label 1 of rows as of `features`, one row for each; equal texts tie."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.score(_matrix(b.column(1))), pa.float64())], ["doc_id", "score"])

    return rows.select("doc_id", "x").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
