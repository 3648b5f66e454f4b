import random

import pytest
from pyspark.sql import functions as F

from quire.llm import mixing, queries


def test_targets_are_shared_anew():
    got = mixing.targets({"a": 100, "b": 10, "c": 200}, {"a": 5, "b": 2, "c": 1})
    assert got["b"] == 30 and got["a"] == pytest.approx(280 * 5 / 6) and got["c"] == pytest.approx(280 / 6)
    assert mixing.targets({}, {}) == {}


def brute_cost(capacity, quota, taken):
    """Cost of words taken of each pattern: 0, 1, 2 for the first, second, third time."""
    cost = 0.0
    for p, n in taken.items():
        for k in range(3):
            cost += k * min(max(n - k * capacity[p], 0), capacity[p])
    return cost


def test_flow_of_overlapping_sources_is_cheapest():
    rng = random.Random(7)
    for _ in range(20):
        capacity = {("a",): rng.randrange(1, 6), ("b",): rng.randrange(1, 6), ("a", "b"): rng.randrange(1, 6)}
        quota = {"a": float(rng.randrange(0, 9)), "b": float(rng.randrange(0, 9))}
        got = mixing.flow(capacity, quota)
        # every split of the shared pattern's words, in whole words
        best = None
        for xa in range(3 * capacity["a", "b"] + 1):
            for xb in range(3 * capacity["a", "b"] - xa + 1):
                pa, pb = quota["a"] - xa, quota["b"] - xb
                if pa < 0 or pb < 0:
                    continue
                t = {("a",): min(pa, 3 * capacity["a",]), ("b",): min(pb, 3 * capacity["b",]), ("a", "b"): xa + xb}
                key = (-sum(t.values()), brute_cost(capacity, quota, t))
                best = min(best or key, key)
        assert sum(got.values()) == pytest.approx(-best[0]) and brute_cost(capacity, quota, got) == pytest.approx(best[1])


def test_query(spark):
    d = "/root/testdata/sf0.01"
    rows = queries.op8_mixing(spark, d)
    source = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "source")
    per = rows.join(source, "doc_id").groupBy("source").agg(F.sum("size").alias("size"), F.max("source_size").alias("told"), F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()
    total = sum(r["size"] for r in per)
    want = mixing.targets({r["source"]: r["size"] for r in per}, mixing.by_rank()(sorted(r["source"] for r in per)))
    for r in per:
        assert r["size"] == r["told"] and r["target"] == pytest.approx(want[r["source"]]) and r["over"] <= 0
        assert abs(r["taken"] - r["target"]) <= 0.01 * r["target"] + 1
    assert sum(r["target"] for r in per) == pytest.approx(total)
    again = queries.op8_mixing(spark, d)
    assert sorted(rows.collect()) == sorted(again.collect())


def test_odd_rows(odd, empty):
    rows = mixing.mix(odd, F.array("source"), mixing.by_rank()).collect()
    assert len(rows) == odd.count() and all(0 <= r["__copies"] <= 3 for r in rows)
    assert {r["__size"] for r in rows if not (r["text"] or "").strip()} == {0}
    assert mixing.mix(empty, F.array("source"), mixing.by_rank()).collect() == []
    taken = mixing.take(odd, F.array("source"), mixing.by_rank())
    assert taken.columns == odd.columns and taken.count() == sum(r["__copies"] for r in rows)


def test_what_is_left_over_fits_no_row_that_was_not_taken(spark):
    rng = random.Random(6)
    sizes = {s: [rng.choice([1, 3, 8, 40, 700]) for _ in range(400)] for s in "abc"} | {"d": [5000, 2, 2, 2]}
    rows = [(s, n) for s, ns in sizes.items() for n in ns]
    docs = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(rows)], "doc_id long, text string, source string")
    got = mixing.mix(docs, F.array("source"), mixing.by_rank()).collect()
    again = mixing.mix(docs.repartition(5), F.array("source"), mixing.by_rank()).collect()
    assert {r["doc_id"]: r["__copies"] for r in got} == {r["doc_id"]: r["__copies"] for r in again}
    for s, ns in sizes.items():
        mine = [r for r in got if r["source"] == s]
        whole = int(mine[0]["__target"] // sum(ns))
        assert {r["__copies"] for r in mine} <= {whole, whole + 1}
        room = mine[0]["__target"] - sum(r["__size"] * r["__copies"] for r in mine)
        left = [r["__size"] for r in mine if r["__copies"] == whole]
        assert room >= -0.5 and (not left or whole == 3 or room < min(left) + 1)


def test_rows_of_one_id_or_none_are_not_taken_as_one(spark):
    docs = spark.createDataFrame([(None if i % 2 else 7, f"w{i} " * 10, "ab"[i % 3 == 0]) for i in range(600)], "doc_id long, text string, source string")
    for r in mixing.mix(docs, F.array("source"), mixing.by_rank()).groupBy("source").agg(F.max("__target").alias("t"), F.sum(F.col("__size") * F.col("__copies")).alias("n")).collect():
        assert 0 <= r["t"] - r["n"] < 10


def test_flows_of_parts_are_the_flow_of_the_whole():
    rng = random.Random(2)
    capacity = {p: rng.randrange(1, 50) for p in [("a",), ("a", "b"), ("b",), ("c",), ("d", "e"), ("e",), (None,)]}
    quota = {s: float(rng.randrange(0, 90)) for s in ["a", "b", "c", "d", "e", None]}
    parts, whole = mixing.flow(capacity, quota), mixing._flow(capacity, quota, 3)
    assert sum(parts.values()) == pytest.approx(sum(whole.values())) and brute_cost(capacity, quota, parts) == pytest.approx(brute_cost(capacity, quota, whole))


def test_overlapping_sources_in_a_table(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), ["a"] if i % 3 else ["a", "b"]) for i in range(300)] + [(900, "w w", []), (901, "w", None)], "doc_id long, text string, s array<string>")
    rows = mixing.mix(docs, F.col("s"), {"a": 1, "b": 3})
    assert rows.count() == 302 and rows.where("doc_id >= 900 and __copies > 0").isEmpty()
    assert rows.agg(F.sum(F.col("__size") * F.col("__copies"))).first()[0] > 0
