import random
import re
from collections import Counter

from quire.llm import queries, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reference(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_statistics_of_random_texts():
    rng = random.Random(1)
    for _ in range(400):
        t = "".join(rng.choices(["a", "b", " ", "\n", "#", "é", "\x1c", " ", "\t", "\r", "ab"], k=rng.randrange(80)))
        assert rules.stats(t) == reference(t)


def test_query(spark):
    d = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    for r in queries.op7_quality_rules(spark, d).collect():
        want = reference(texts[r["doc_id"]])
        assert tuple(r[s] for s in rules.STATS) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_kept_agrees_with_labels(spark):
    d = "/root/testdata/sf0.01"
    judged = queries.op7_quality_rules(spark, d).where("not base_failed").drop("quality")
    rows = judged.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_posterior_against_simulated_votes():
    rng = random.Random(4)
    truth, patterns = [], []
    for _ in range(4000):
        y = rng.random() < 0.8
        truth.append(y)
        right = (0.97, 0.95, 0.9, 0.96, 0.92, 0.97, 0.95, 0.9, 0.94, 0.96)
        patterns.append("".join("." if rng.random() < 0.1 else "+" if (rng.random() < a) == y else "-" for a in right))
    got = rules.fit(Counter(patterns))
    assert sum((got[p] >= 0.5) == y for p, y in zip(patterns, truth, strict=True)) >= 0.99 * len(truth)
    assert rules.fit({}) == {}


def test_odd_rows(odd, empty):
    rows = rules.judge(odd).collect()
    assert len(rows) == odd.count()
    assert all(not r["__kept"] for r in rows if not (r["text"] or "").strip())
    assert rules.judge(empty).collect() == []


def test_expectation_maximisation_against_plain_loops():
    """The same steps, document by document and vote by vote."""
    rng = random.Random(8)
    docs = ["".join(rng.choice("++-.") if rng.random() < 0.7 else "-" for _ in range(4)) for _ in range(150)]
    post = [0.05 if d.count("-") >= 2 else 0.6 if d.count("-") == 1 else 0.95 for d in docs]
    for _ in range(200):
        prior, right, wrong = (sum(post) + 1) / (len(docs) + 2), [], []
        for k in range(4):
            for out, w, sure in ((right, post, 0.8), (wrong, [1 - p for p in post], 0.2)):
                good = sum(x for x, d in zip(w, docs, strict=True) if d[k] == "+")
                voted = sum(x for x, d in zip(w, docs, strict=True) if d[k] != ".")
                out.append((good + 5 * sure) / (voted + 5))
        new = []
        for d in docs:
            yes, no = prior, 1 - prior
            for k, c in enumerate(d):
                if c != ".":
                    yes *= right[k] if c == "+" else 1 - right[k]
                    no *= wrong[k] if c == "+" else 1 - wrong[k]
            new.append(yes / (yes + no))
        done, post = max(abs(a - b) for a, b in zip(new, post, strict=True)) < 1e-9, new
        if done:
            break
    got = rules.fit(Counter(docs))
    assert max(abs(got[d] - p) for d, p in zip(docs, post, strict=True)) < 1e-6


def test_texts_are_kept_or_not(odd):
    whole, bare = rules.judge(odd), rules.judge(odd, keep_text=False)
    assert set(whole.columns) - set(bare.columns) == {"text"} and whole.drop("text").exceptAll(bare).isEmpty()
