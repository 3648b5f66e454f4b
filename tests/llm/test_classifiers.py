import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import qualityclf, queries, toxicity


def test_isotonic_against_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 9)
        x, y = [rng.randrange(6) for _ in range(n)], [rng.randrange(2) for _ in range(n)]
        knots, p = qualityclf.isotonic(np.array(x, float), np.array(y, float))
        at = sorted(set(x))
        rows = lambda a, b: [k for k, z in zip(y, x, strict=True) if at[a] <= z <= at[b]]  # noqa: B023, E731
        mean = lambda a, b: Fraction(sum(rows(a, b)), len(rows(a, b)))  # noqa: B023, E731
        # the least-squares fit is the greatest, over where a block begins, of the least, over where it ends, mean
        fit = [max(min(mean(a, b) for b in range(i, len(at))) for a in range(i + 1)) for i in range(len(at))]
        blocks = [[i for i, v in enumerate(fit) if v == level] for level in sorted(set(fit))]
        assert knots.tolist() == pytest.approx([np.mean([z for z in x if at[b[0]] <= z <= at[b[-1]]]) for b in blocks])
        many = len(blocks) > 1
        want = [(sum(rows(b[0], b[-1])) + 0.5 * many) / (len(rows(b[0], b[-1])) + many) for b in blocks]
        assert p.tolist() == pytest.approx(np.clip(np.maximum.accumulate(want), 1e-6, 1 - 1e-6).tolist())


def test_ridge_against_a_direct_solution(spark):
    d = "/root/testdata/sf0.001"
    x = qualityclf.features(spark.read.parquet(f"{d}/documents.parquet"))
    labels = spark.read.parquet(f"{d}/labels.parquet")
    model = qualityclf.fit(x, labels, "quality")
    told = x.join(labels, "doc_id").select("x", "quality", (F.pmod(F.xxhash64(F.lit(43), "doc_id"), F.lit(4)) == 0).alias("kept")).collect()
    v, y, kept = np.array([r["x"] for r in told]), np.array([r["quality"] for r in told], float), np.array([r["kept"] for r in told])
    assert model.mean == pytest.approx(v.mean(0)) and model.scale == pytest.approx(np.maximum(v.std(0), 1e-6))
    z = model.expand(v[~kept])
    m = z.shape[1]
    direct = np.linalg.lstsq(np.vstack([z, qualityclf.RIDGE**0.5 * np.eye(m)]), np.concatenate([y[~kept], np.zeros(m)]), rcond=None)[0]
    assert np.abs(model.weights - direct).max() < 1e-6
    own, p = qualityclf.isotonic(model.value(v[kept]), y[kept])
    got = {r["doc_id"]: r["score"] for r in qualityclf.score(x, model).collect()}
    every = {r["doc_id"]: r["x"] for r in x.collect()}
    assert got == pytest.approx({i: float(np.interp(model.value(np.array([r])), own, p)[0]) for i, r in every.items()})


def test_kernel_is_approximated():
    rng = np.random.default_rng(1)
    k, d = len(qualityclf.NAMES), 20_000
    m = qualityclf.Model(np.zeros(k), np.ones(k), rng.normal(size=(k, d)) / qualityclf.WIDTH, rng.uniform(0, 2 * np.pi, d), np.empty(0), (np.zeros(1), np.zeros(1)), 0.5)
    x = rng.normal(size=(6, k))
    z = m.expand(x)[:, :d]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * qualityclf.WIDTH**2))
    assert np.abs(z @ z.T - want).max() < 0.05


def test_held_out_quality(spark):
    d = "/root/testdata/sf0.01"
    rows = queries.op3_quality_classifier(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r["predicted"] == r["quality"] for r in rows if r["held_out"]]
    assert sum(held) >= 0.97 * len(held)


def test_quality_of_odd_rows(spark, odd, empty):
    x = qualityclf.features(odd)
    labels = spark.createDataFrame([(1, 1), (8, 0), (3, None), (99, 1), (6, 1)], "doc_id long, quality int")
    rows = qualityclf.score(x, qualityclf.fit(x, labels, "quality")).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = qualityclf.fit(x, labels.limit(0), "quality")
    assert {r["score"] for r in qualityclf.score(x, none).collect()} == {0.5}
    e = qualityclf.features(empty)
    assert qualityclf.score(e, qualityclf.fit(e, labels, "quality")).collect() == []


def test_ordinal_gradient_finds_ordered_grades():
    rng = np.random.default_rng(0)
    n, k = 1500, 6
    x = rng.integers(0, 4, (n, k)).astype(float)
    value = x @ np.array([1.0, 0.5, 0, 0, 2.0, 0]) + rng.logistic(size=n) * 0.3
    grade = np.searchsorted([3.0, 5.5, 8.0], value)
    rows, cols = np.nonzero(x)
    w, cut = toxicity.ordinal(rows, cols, x[rows, cols], grade, k)
    p = toxicity._grades(cut, x @ w)
    assert (np.diff(cut) > 0).all() and np.allclose(p.sum(1), 1) and (p.argmax(1) == grade).mean() > 0.75 and (abs(p.argmax(1) - grade) <= 1).mean() > 0.98
    assert w[4] > w[0] > w[1] > max(w[2], w[3], w[5])


def test_held_out_toxicity(spark):
    d = "/root/testdata/sf0.1"
    rows = queries.op9_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet").select("doc_id", F.col("toxic").alias("y")), "doc_id").where("held_out").collect()
    hit, false = sum(r["toxic"] for r in rows if r["y"]), sum(r["toxic"] for r in rows if not r["y"])
    assert hit >= 0.9 * sum(r["y"] for r in rows) and false <= 0.02 * len(rows)
    assert all(0 <= r["severity"] <= 3 and 0 <= r["grade"] <= 3 for r in rows)


def test_toxicity_of_odd_rows(spark, odd, empty):
    rng = random.Random(1)
    bad = ["vile", "awful", "rotten"]
    words = [f"word{i}" for i in range(60)]
    text = lambda y: " ".join([*rng.choices(words, k=30), *(rng.choices(bad, k=3 + 3 * y) if y else [])])
    docs = spark.createDataFrame([(i, text(i % 3)) for i in range(240)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)] + [(500, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    by = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    severity = [np.mean([by[i]["severity"] for i in by if i % 3 == y]) for y in range(3)]
    assert severity[0] < 0.3 < severity[1] < severity[2]
    assert toxicity.score(odd, model).count() == odd.count() and toxicity.score(empty, model).collect() == []
    none = toxicity.fit(docs, labels.limit(0))
    assert max(r["severity"] for r in toxicity.score(odd, none).collect()) < 1e-6


def test_ordinal_fit_is_least():
    rng = np.random.default_rng(5)
    n, k = 300, 3
    x = rng.integers(0, 3, (n, k)).astype(float)
    grade = np.searchsorted([1.5, 3.0, 4.5], x @ np.array([1.0, 0.0, 1.5]) + rng.logistic(size=n) * 0.5)
    rows, cols = np.nonzero(x)

    def loss(w, cut):
        p = toxicity._grades(cut, x @ w)[np.arange(n), grade]
        return -np.log(np.maximum(p, 1e-12)).mean() + 0.5e-4 * (w**2).sum()

    w, cut = toxicity.ordinal(rows, cols, x[rows, cols], grade, k)
    least = loss(w, cut)
    for _ in range(2000):  # no other weights and ordered thresholds do better
        size = rng.choice([0.01, 0.1, 1.0])
        assert least <= loss(np.maximum(w + size * rng.normal(size=k), 0), np.sort(cut + size * rng.normal(size=3))) + 1e-4


def test_toxicity_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.fit(docs, labels)
    told = [(r["text"] or "", r["toxic"]) for r in docs.join(labels, "doc_id").where("toxic in (0, 1)").collect()]
    n = [Counter(), Counter()]
    for text, y in told:
        n[y].update(toxicity.features(text))
    size = [sum(y == k for _, y in told) for k in (0, 1)]
    odds = lambda f: (n[1][f] + 0.5) / (size[1] + 1) / ((n[0][f] + 0.5) / (size[0] + 1))
    assert set(model.features) == {f for f in n[1] if n[1][f] >= toxicity.MIN_DOCS and odds(f) >= toxicity.MIN_ODDS}
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    for r in docs.collect():
        counts = Counter()
        for w in toxicity.tokens(r["text"] or ""):
            counts.update(toxicity.names(w))
        counts |= Counter({f + "+": k for f, k in counts.items() if k > 1})
        value = sum(model.weights[i] * np.log1p(counts[f]) for f, i in model.features.items() if counts[f])
        below = [0.0, *(1 / (1 + np.exp(-np.clip(t - value, -60, 60))) for t in model.thresholds), 1.0]
        p = np.diff(below)
        assert got[r["doc_id"]]["severity"] == pytest.approx(float(p @ np.arange(4)), abs=1e-9) and got[r["doc_id"]]["p_toxic"] == pytest.approx(1 - p[0], abs=1e-9)


def test_amount():
    assert toxicity.amount("Vile vile word", {"vile"}) == 2 and toxicity.amount("vileness is", {"vile*"}) == 1
    assert toxicity.amount("", {"x"}) == 0 == toxicity.amount("a b", set())


@pytest.mark.parametrize("text, want", [("Idiots idiot", {"idiot", "idiots", "idio*", "idio*+", "idiot*", "idiot*+", "idiots*"})])
def test_features(text, want):
    assert toxicity.features(text) == want
