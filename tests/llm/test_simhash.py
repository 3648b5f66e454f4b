import functools
import itertools
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import graph, queries, simhash


def reference_fingerprint(text, k=3):
    parts = (text or "").encode().lower().split()
    shingles = [b" ".join(parts[i : i + k]) for i in range(len(parts) - k + 1)] or ([b" ".join(parts)] if parts else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    for n, m in ((30, 20), (60, 90), (40, 0)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        want = {i: c for i, c in classes(range(n), edges).items() if i != c}
        got = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert {r["node"]: r["component"] for r in got} == want


def test_a_long_chain_is_one_component(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    got = graph.components(spark.createDataFrame(list(itertools.pairwise(order)), "a long, b long"))
    assert got.where("component <> 0").isEmpty() and got.count() == 199


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in queries.op4_simhash(spark, d).collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    prints = {i: reference_fingerprint(t) for i, t in texts.items()}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = classes(prints, links)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in rows.items()} == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


def test_links_at_one_and_two_bits_and_not_three(spark):
    nodes = [0, 1, 3, 7, 0b11 << 62, 1 << 63]
    rows = [(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(nodes)]
    pairs = simhash.candidate_pairs(simhash.meetings(spark.createDataFrame(rows, "id long, f0 long"), simhash.EXACT), simhash.EXACT).collect()
    got = classes(range(6), [(r["a"], r["b"]) for r in pairs])
    want = classes(range(6), [(a, b) for a, b in itertools.combinations(range(6), 2) if (nodes[a] ^ nodes[b]).bit_count() <= 2])
    assert got == want
    assert all((nodes[r["a"]] ^ nodes[r["b"]]).bit_count() <= 2 for r in pairs)


def test_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd, simhash.EXACT).collect()
    assert len(rows) == odd.count()
    of = defaultdict(set)
    for r in rows:
        of[r["doc_id"]].add((r["f0"], r["component_id"]))
    assert of[3] == of[4] == of[5] == {(0, 3)} and len(of[2]) == 1 and {c for _, c in of[2]} == {1}
    assert simhash.near_duplicates(empty, simhash.EXACT).collect() == []
    assert simhash.keep_one(empty).collect() == []


def test_keep_one(odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 6, 7, 8, 9, 10]


def test_near_copies_of_five_word_shingles(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    rows = []
    for g, changes in enumerate((0, 2, 60)):  # of 300 words
        base = [word() for _ in range(300)]
        copy = list(base)
        for i in rng.sample(range(300), changes):
            copy[i] = word()
        rows += [(10 * g, " ".join(base)), (10 * g + 1, " ".join(copy)), (10 * g + 2, " ".join(word() for _ in range(300)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == [0, 2, 10, 12, 20, 21, 22]


def test_variants_of_blocks_meet(spark):
    spec = simhash.Spec(words=1, blocks=2, radius=2, limit=40)
    rows = [(0, 0), (1, 0b11), (2, (1 << 40) - 1)]
    pairs = {(r["a"], r["b"]) for r in simhash.candidate_pairs(simhash.meetings(spark.createDataFrame(rows, "id long, f0 long"), spec), spec).collect()}
    assert (1, 0) in pairs and (2, 0) not in pairs
    assert simhash.differing(spec) is not None and F is not None


@pytest.mark.parametrize("piece", [simhash._PIECE, 2])
def test_crowded_variants_are_compared_whole(spark, monkeypatch, piece):
    monkeypatch.setattr(simhash, "_PIECE", piece)
    rng = random.Random(5)
    spec = simhash.Spec(shingle=5, words=4, blocks=8, radius=2, limit=38, sure=38)
    far = [rng.getrandbits(224) << 32 for _ in range(6)]  # one block in common, the others some 112 bits apart
    prints = {0: far[0], 1: far[1], 2: far[2], 3: far[3], 4: far[1] ^ (1 << 40) ^ (1 << 80) ^ (1 << 120), 5: far[4], 6: far[5]}
    for k in range(1, 8):  # three flips in each other block, so 1 and 4 meet in block 0 only
        prints[4] ^= 0b111 << (32 * k)
    word = lambda x, k: (lambda y: y - (1 << 64) if y >> 63 else y)(x >> (64 * k) & (2**64 - 1))
    rows = [(i, *(word(x, k) for k in range(4))) for i, x in prints.items()]
    assert 0 < (prints[1] ^ prints[4]).bit_count() <= spec.limit
    nodes = spark.createDataFrame(rows, "id long, f0 long, f1 long, f2 long, f3 long")
    met = simhash.meetings(nodes, spec)
    tied = {(r["a"], r["b"]) for r in simhash.candidate_pairs(met, spec).collect()}
    assert (4, 1) not in tied  # the ties alone miss it
    none = spark.createDataFrame([], "node long, component long")
    assert {(r["a"], r["b"]) for r in simhash.crowded_pairs(met, nodes, none, spec).collect()} == {(4, 1)}
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: nodes.withColumnRenamed("id", "doc_id"))
    assert {(r["a"], r["b"]) for r in simhash.distances(spark.createDataFrame([(4, 1), (3, 1)], "a long, b long"), nodes, spec).collect()} == {(4, 1)}
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(nodes, spec).collect()}
    assert got == {i: 1 if i == 4 else i for i in prints}


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_spanning_links_join_what_all_links_join(n):
    rng = np.random.default_rng(n)
    for _ in range(20):
        base = rng.integers(0, 2, (4, 128), dtype=np.uint8)
        bits = base[rng.integers(0, 4, n)] ^ (rng.random((n, 128)) < 0.08)
        f = np.packbits(bits, axis=1).view(np.uint64)
        ids, c = np.arange(n) * 3, rng.integers(0, max(1, n // 2), n)
        near = [(a, b) for a, b in itertools.combinations(range(n), 2) if (bits[a] != bits[b]).sum() <= 20]
        same = [(a, b) for a, b in itertools.combinations(range(n), 2) if c[a] == c[b]]
        got = simhash.spanning(ids, c, f, 20)
        assert all(a > b and (a // 3, b // 3) in {*near, *((y, x) for x, y in near)} for a, b in got)
        assert classes(range(n), [*same, *((a // 3, b // 3) for a, b in got)]) == classes(range(n), [*same, *near])


def test_fold_against_counting_bits():
    rng = random.Random(9)
    mix = lambda x: (lambda y: y ^ y >> 31)((lambda y: (y ^ y >> 27) * simhash._MIX[1] % 2**64)((x ^ x >> 30) * simhash._MIX[0] % 2**64))
    for n in (0, 1, 2, 9, 10_000):
        h = [rng.getrandbits(64) for _ in range(n)]
        for k, word in enumerate(simhash.fold(np.array(h, np.uint64), 3).tolist()):
            own = [mix((x + k * simhash._MIX[2]) % 2**64) if k else x for x in h]
            assert word % 2**64 == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > n)


def jaccard(a, b):
    x, y = set(simhash.hashes(a, 5).tolist()), set(simhash.hashes(b, 5).tolist())
    return len(x & y) / max(1, len(x | y))


def test_open_pairs_are_told_by_their_shingles(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    texts = {}
    for g in range(12):
        base = [word() for _ in range(240)]
        texts[100 * g] = " ".join(base)
        for n in range(1, 13):  # so many words changed, each of which takes five shingles
            copy = list(base)
            for i in rng.sample(range(240), n):
                copy[i] = word()
            texts[100 * g + n] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    pairs = [(a, b) for a, b in itertools.combinations(sorted(texts), 2) if a // 100 == b // 100]
    nodes = simhash.fingerprints(docs, simhash.NEAR).withColumnRenamed("doc_id", "id")
    nodes = spark.createDataFrame(nodes.collect(), nodes.schema)
    every = spark.createDataFrame([(b, a) for a, b in pairs], "a long, b long")
    want = {(a, b) for a, b in pairs if jaccard(texts[a], texts[b]) >= 0.8}
    assert {(r["b"], r["a"]) for r in simhash.similar(every, nodes, docs, simhash.NEAR).collect()} == want
    far = {(r["b"], r["a"]): r["far"] for r in simhash.distances(every, nodes, simhash.NEAR).collect()}
    assert len(far.keys() & want) >= 0.99 * len(want) and all(jaccard(texts[a], texts[b]) >= 0.77 for (a, b), n in far.items() if n <= simhash.NEAR.sure)
    roots = {r["node"]: r["component"] for r in simhash.joined(every, None, nodes, docs, simhash.NEAR).collect()}
    reach, least = classes(texts, want), classes(texts, far.keys() & want)
    assert all(roots.get(i, i) in (reach[i], least[i]) for i in texts)


def test_near_classes_against_brute_force(spark):
    """Nearly all pairs of a similarity of 0.8 or more end in one class, and classes hold nothing that no chain of such pairs reaches."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    sets = {i: frozenset(simhash.hashes(t, 5).tolist()) for i, t in texts.items()}
    by = defaultdict(set)
    for i, s in sets.items():
        for h in s:
            by[h].add(i)
    near = {(a, b) for ids in by.values() if len(ids) < 400 for a, b in itertools.combinations(sorted(ids), 2)}
    like = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in near}
    classed = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs, simhash.NEAR).collect()}
    found = [classed[a] == classed[b] for (a, b), x in like.items() if x >= 0.8]
    assert len(found) > 20 and np.mean(found) >= 0.9
    reach = classes(texts, [p for p, x in like.items() if x >= 0.77])
    empty = {i for i, s in sets.items() if not s}
    assert all(reach[i] == reach[c] or {i, c} <= empty for i, c in classed.items())


def test_a_similar_row_behind_a_nearer_one_is_found(spark, monkeypatch):
    """10 and 12 are similar, but each has a nearer row (11, 13) in another component that isn't."""
    rng = random.Random(8)
    spec = simhash.Spec(shingle=5, words=4, blocks=8, radius=2, limit=60, sure=10, similarity=0.8)
    flip = lambda x, mask: functools.reduce(lambda y, k: y ^ mask << (32 * k), range(1, 8), x)
    block, x = rng.getrandbits(32), rng.getrandbits(224) << 32
    prints = {i: rng.getrandbits(224) << 32 for i in range(4)} | {10: x, 11: flip(x, 0b111), 12: flip(x, 0b1111 << 8), 13: flip(x, 0b1111 << 8 | 0b111 << 16)}
    word = lambda y, k: (lambda z: z - (1 << 64) if z >> 63 else z)((y | block) >> (64 * k) & (2**64 - 1))
    schema = "id long, f0 long, f1 long, f2 long, f3 long"
    nodes = spark.createDataFrame([(i, *(word(y, k) for k in range(4))) for i, y in prints.items()], schema)
    own = {i: np.arange(100 * i, 100 * i + 50, dtype=np.uint32) for i in prints}
    own[12] = np.append(own[10][2:], np.arange(9000, 9002, dtype=np.uint32))
    sets = spark.createDataFrame([(i, y.tobytes()) for i, y in own.items()], "id long, s binary")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: nodes.withColumnRenamed("id", "doc_id"))
    monkeypatch.setattr(simhash, "shingle_sets", lambda docs, nodes, ids, *_: sets.join(ids, "id", "left_semi"))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(nodes, spec).collect()}
    assert got == {i: 10 if i == 12 else i for i in prints}


def test_sets_against_plain_ones():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, n, dtype=np.uint32)) for n in rng.integers(0, 120, 60)]
    told = simhash.Sets(sets, 0.7)
    for i, x in enumerate(sets):
        others = rng.permutation(60)[:30]
        want = [len(np.intersect1d(x, sets[j])) >= 0.7 * len(np.union1d(x, sets[j])) for j in others]
        assert told.like(i, others).tolist() == want
