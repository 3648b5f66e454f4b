import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import lm, queries


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def reference(docs, train):
    counts = Counter(w for i, t in docs if train(i) for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    return total, [(i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens(t))) for i, t in docs]


def test_base_scores_are_exact(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    train = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    total, want = reference([(r["doc_id"], r["text"]) for r in docs.collect()], train)
    from quire.llm.common import held_out

    got = {r["doc_id"]: r for r in lm.score_documents(docs, ~held_out(F.col("doc_id"), 7, 2)).collect()}
    for i, n, known, base in want:
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["trained"]) == (n, known, total, train(i))
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_filter_holds_levels_and_errs_upwards():
    rng = np.random.default_rng(1)
    key = np.unique(rng.integers(0, 1 << 40, 20_000, dtype=np.uint64))
    level = lm.level_of(rng.geometric(0.3, len(key)) ** 3)
    f = lm.Filter(key, level)
    got = f.levels(key)
    assert f.bits == lm.BITS * level.sum() and (got >= level).all() and (got == level).mean() > 0.97
    assert (f.levels(rng.integers(0, 1 << 40, 20_000, dtype=np.uint64)) > 0).mean() < 0.03


@pytest.mark.parametrize("least", [1.0, 2.0, 2.7, 1000.0])
def test_levels_and_values(least):
    c = np.array([1, 2, 3, 4, 5, 7, 8, 11, 12, 1000, 10**9])
    level = lm.level_of(c, least)
    assert (np.diff(level) >= 0).all() and ((level == 0) == (c < least)).all()
    held = c[level > 0]
    assert (abs(lm.values(least)[level[level > 0]] - held) <= 0.25 * held).all() and lm.values(least)[0] == 0
    assert lm.level_of(np.array([1]))[0] == 1 and lm.values()[1] == 1


def test_score_beats_the_base_on_held_out_documents(spark):
    rows = queries.op10_language_model(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("base_score").alias("b"), F.sum("score").alias("s")).first()
    assert rows["s"] > rows["b"]


def test_odd_rows(spark, odd, empty):
    rows = lm.score_documents(odd, F.lit(True)).collect()
    assert len(rows) == odd.count() and min(r["n_tokens"] for r in rows) == 1 and all(r["n_known"] == r["n_tokens"] for r in rows)
    none = lm.score_documents(odd, F.lit(False)).collect()
    assert {r["n_known"] for r in none} == {0} == {r["train_tokens"] for r in none}
    assert lm.score_documents(empty, F.lit(True)).collect() == []


def counted(rows, train):
    """Counts of words, pairs and triples of the training rows; the end before a text is no word of it."""
    words, pairs, triples = Counter(), Counter(), Counter()
    for i, t in rows:
        if train(i):
            t = [b"\n", *t]
            words.update(t[1:])
            pairs.update(zip(t, t[1:], strict=False))
            triples.update(zip(t, t[1:], t[2:], strict=False))
    return words, pairs, triples


@pytest.mark.parametrize("block, per_shard", [(lm._BLOCK, lm._PER_SHARD), (3000, 5000)])
def test_shards_score_as_counts_do(spark, monkeypatch, block, per_shard):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    train = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    rows = [(r["doc_id"], tokens(r["text"])) for r in docs.collect()]
    words, pairs, triples = counted(rows, train)
    total, kinds = sum(words.values()), len(words)
    told = lambda n, least: float(lm.values(least)[lm.level_of(np.array([n]), least)[0]])
    monkeypatch.setattr(lm, "_BLOCK", block)
    monkeypatch.setattr(lm, "_PER_SHARD", per_shard)
    from quire.llm.common import held_out

    got = {r["doc_id"]: r["score"] for r in lm.score_documents(docs, ~held_out(F.col("doc_id"), 7, 2)).collect()}
    off = []
    for i, t in rows:
        t, want = [b"\n", *t], 0.0
        for k in range(1, len(t)):
            before, own, pair = told(words[t[k - 1]], 1), told(words[t[k]], 1), told(pairs[t[k - 1], t[k]], 2)
            w = 0.5 * before / (before + 1000)
            p = (1 - w) * (own + 1) / (total + kinds + 1) + w * min(1, pair / max(before, 1))
            if k > 1 and (first := told(pairs[t[k - 2], t[k - 1]], 2)) > 0:
                p = 0.7 * p + 0.3 * min(1, told(triples[t[k - 2], t[k - 1], t[k]], 2) / first)
            want += math.log10(p)
        off.append(abs(got[i] - want) / abs(want))
    assert len(got) == len(rows) and max(off) < 0.1 and np.mean(off) < 0.01  # errors of the filter


def test_rare_and_frequent_n_grams_are_held_at_every_size():
    for copies in (1, 10**6):  # counts that a small and a very large corpus give
        key, level = np.arange(5, dtype=np.uint64), lm.level_of(np.array([1, 2, 3, 50, 2**40]) * copies)
        assert (lm.Filter(key, level).levels(key) >= level).all() and (level > 0).all()


def test_documents_that_occur_twice_stand_out(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(vocabulary, 60)) for _ in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts + texts[:20])), "doc_id long, text string")
    by = {r["doc_id"]: r["score"] - r["base_score"] for r in lm.score_documents(docs, F.lit(True)).collect()}
    assert min(by[i] for i in range(20)) > max(by[i] for i in range(20, 120))
