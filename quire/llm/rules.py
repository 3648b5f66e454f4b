"""Quality rules as weak supervision.

Every rule votes good (1), bad (0) or abstains (-1). The votes of a document are one pattern; the
patterns' counts over all documents (at most 3 ** number of rules, however many documents) are what
expectation-maximisation sees. It estimates each rule's accuracies on good and on bad documents and
the share of good ones; a document is kept if its posterior probability of being good reaches a half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stored, internal, sliced

#: Symbols counted by n_symbols (fixed values).
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACES = (" ", "\t", "\n", "\v", "\f", "\r")
_SPACES_B = b" \t\n\x0b\x0c\r"
#: Documents with fewer words, or with more than this share of their words in repeated windows, fail.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def repeated_words(parts: list[bytes], width: int = 3) -> int:
    """Words in windows of `width` words that occur twice or more, the first occurrence included."""
    n = len(parts)
    if n <= width:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in parts), np.int64, n)
    if len(seen) == n:
        return 0
    key = ids
    for k in range(1, width):  # codes of longer and longer windows, each below n
        key = key[: n - k] * len(seen) + ids[k:]
        if k < width - 1:
            key = np.unique(key, return_inverse=True)[1]
    _, code, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[code] > 1
    inside = np.zeros(n, bool)
    for k in range(width):
        inside[k : n - width + 1 + k] |= twice
    return int(inside.sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line; lines end at \\n alone."""
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACES_B)]
    return len(lines) - len(set(lines))


def stats(text: str) -> tuple[int, int, int, int, int]:
    raw = text.encode("utf-8", "surrogatepass")
    parts = raw.split()
    chars = len(text) - sum(map(text.count, _SPACES))
    return len(parts), chars, sum(map(text.count, SYMBOLS)), duplicate_lines(raw), repeated_words(parts)


#: The rules, in the order of their votes in a pattern.
RULES = ("length", "word_length", "symbols", "marked_words", "duplicate_lines", "repeats", "capitals", "letters", "sentences", "variety")


def votes(text: str, s: tuple[int, int, int, int, int]) -> str:
    """The pattern of a text: '+', '-' or '.' (abstains) for each of RULES."""
    n, chars, symbols, dup, repeats = s
    marked = 0
    if symbols:
        marked = sum(any(c in w for c in SYMBOLS) for w in text.split())
    if not n:
        return "-" + "." * (len(RULES) - 1)
    head = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    upper, lower = int(((head >= 65) & (head <= 90)).sum()), int(((head >= 97) & (head <= 122)).sum())
    other = int((head >= 0xC3).sum())  # first bytes of letters beyond ASCII, nearly all
    ends = sum(map(text.count, ".!?"))
    lines = text.count("\n") + 1
    mean, letters, cased = chars / n, (upper + lower + other) / chars, upper / max(1, upper + lower)
    tests = (
        (n >= 50, n < 20),
        (2.5 <= mean <= 12, mean < 2 or mean > 20),
        (symbols <= 0.02 * n, symbols > 0.1 * n),
        (marked <= 0.01 * n, marked > 0.05 * n),
        (dup <= 0.1 * lines, dup > 0.3 * lines),
        (repeats <= 0.15 * n, repeats > 0.3 * n),
        (cased <= 0.25, cased > 0.5),
        (letters >= 0.93, letters < 0.85),
        (0.01 * n <= ends <= 0.25 * n, n >= 20 and (ends < 0.002 * n or ends > 0.5 * n)),
    )
    out = ["+" if g else "-" if b else "." for g, b in tests]
    kinds = len(set(text.split())) if n >= 20 else 0
    out.append("." if n < 20 else "+" if kinds >= min(0.3 * n, 60) else "-" if kinds < min(0.1 * n, 20) else ".")
    return "".join(out)


def features(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """All columns of `docs` (the text only if it is kept) with __n_words ... __n_repeat_words (long) and __votes (string)."""
    internal(docs, text_col)
    at, kept = docs.columns.index(text_col), [i for i, c in enumerate(docs.columns) if keep_text or c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            rows = [(s := stats(t), votes(t, s)) for t in ((x or "") for x in b.column(at).to_pylist())]
            cols = [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(len(STATS))]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), *cols, pa.array([r[1] for r in rows], pa.string())], [*(b.schema.names[i] for i in kept), *(f"__{s}" for s in STATS), "__votes"])

    own = docs if keep_text else docs.drop(text_col)
    schema = own.select("*", *(F.lit(0).cast("long").alias(f"__{s}") for s in STATS), F.lit("").alias("__votes")).schema
    return docs.mapInArrow(run, schema)


def fit(patterns: dict[str, int], rounds: int = 200) -> dict[str, float]:
    """The posterior probability of good for each pattern.

    Two classes, votes independent given the class, abstentions without weight. It starts with the
    documents that two or more rules call bad as bad, and a few imagined votes (80 % right) keep every
    rule better than chance, so that the classes don't swap.
    """
    if not patterns:
        return {}
    names = sorted(patterns)
    count = np.array([patterns[p] for p in names], float)
    good = np.array([[c == "+" for c in p] for p in names], float)
    bad = np.array([[c == "-" for c in p] for p in names], float)
    voted = good + bad
    post = np.select([bad.sum(1) >= 2, bad.sum(1) == 1], [0.05, 0.6], 0.95)
    fancied = 5.0
    for _ in range(rounds):
        w1, w0 = count * post, count * (1 - post)
        right = (w1 @ good + 0.8 * fancied) / (w1 @ voted + fancied)  # votes good | good
        wrong = (w0 @ good + 0.2 * fancied) / (w0 @ voted + fancied)  # votes good | bad
        prior = (w1.sum() + 1) / (count.sum() + 2)
        odds = np.log(prior / (1 - prior)) + good @ np.log(right / wrong) + bad @ np.log((1 - right) / (1 - wrong))
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return dict(zip(names, post.tolist(), strict=True))


def base_failed(n_words: Column, repeats: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)


def judge(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """All columns of `docs`, the five statistics as __n_words ..., __votes, __quality (posterior) and __kept.

    Null and empty texts have no words: they fail; very long ones are read whole. Repeated rows count as often as they
    occur; a posterior of a half is kept. An empty table gives an empty table. Columns of the same names as the added
    ones are replaced. What was found is stored once, without the texts unless they are kept.
    """
    docs = docs.drop(*(f"__{s}" for s in STATS), "__votes", "__quality", "__kept")
    rows = Stored(features(docs, text_col, keep_text), "rules").df
    found = {r["__votes"]: r["count"] for r in rows.groupBy("__votes").count().collect()}  # at most 3 ** len(RULES) rows
    told = docs.sparkSession.createDataFrame(sorted(fit(found).items()), "__votes string, __quality double").coalesce(1)
    failed = base_failed(F.col("__n_words"), F.col("__n_repeat_words"))
    judged = rows.join(F.broadcast(told), "__votes").withColumn("__kept", ~failed & (F.col("__quality") >= 0.5))
    return judged.select(*rows.columns, "__quality", "__kept")
