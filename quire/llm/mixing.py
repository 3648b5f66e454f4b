"""Mixing sources to target weights as a minimum-cost flow.

Documents are aggregated by membership pattern: the set of sources they belong to. Word capacity
flows from patterns to source quotas; a pattern's first pass over its words is free, the second costs
one a word, the third two (convex costs of repetition), and there is no fourth. Then seeded documents
realise each pattern's flow: every document as often as whole passes went through, and of the last
pass those in the order of a seeded hash until the flow is met. Where it is met is found by histograms of
the seeded order, each finer than the one before; what room the last bucket leaves is filled from
further on in the order, until no document is left that fits.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, Stored, internal

#: Times a document is taken at most.
PASSES = 3
#: Bits of the seeded order, and those that a histogram adds at most.
_BITS, _STEP = 52, 12
#: Documents of a last bucket, on average at most.
_BUCKET = 64
#: Patterns whose plans are broadcast; more are joined as Spark chooses.
_SMALL = 10_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict, weights: dict, cap: int = PASSES) -> dict[object, float]:
    """Shares of the total size by weight; none over `cap` times its size, the excess shared anew by weight."""
    left, open_, out = float(sum(sizes.values())), set(sizes), {}
    while open_:
        total = sum(weights[s] for s in open_)
        full = [s for s in open_ if total <= 0 or left * weights[s] / total > cap * sizes[s]]
        if not full:
            out |= {s: left * weights[s] / total for s in open_}
            break
        for s in full:
            out[s] = float(cap * sizes[s])
        left -= sum(out[s] for s in full)
        open_ -= set(full)
    return out


@dataclass
class _Edge:
    to: int
    room: float
    cost: int
    back: int


def flow(capacity: dict[tuple, int], quota: dict[object, float], passes: int = PASSES) -> dict[tuple, float]:
    """Words taken of each pattern: a minimum-cost flow by successive shortest paths.

    capacity: words of each pattern (a tuple of sources). quota: words each source should get. A source
    gets less than its quota only if its patterns have no more to give. Patterns that share no source, not
    even by way of others, don't touch: each such part is a flow of its own.
    """
    root: dict[object, object] = {}

    def find(s: object) -> object:
        while root.setdefault(s, s) != s:
            root[s] = s = root[root[s]]
        return s

    for p in capacity:
        for s in p[1:]:
            root[find(s)] = find(p[0])
    parts: dict[object, list[tuple]] = {}
    for p in capacity:
        parts.setdefault(find(p[0]) if p else (), []).append(p)
    taken: dict[tuple, float] = {}
    for part in parts.values():
        sources = sorted({s for p in part for s in p if s in quota}, key=str)
        taken |= _flow({p: capacity[p] for p in part}, {s: quota[s] for s in sources}, passes)
    return taken


def _flow(capacity: dict[tuple, int], quota: dict[object, float], passes: int) -> dict[tuple, float]:
    todo, sources, taken = list(capacity), list(quota), {}
    node = {s: 1 + i for i, s in enumerate(sources)}
    first, sink = 1 + len(sources), 1 + len(sources) + len(todo)
    graph: list[list[_Edge]] = [[] for _ in range(sink + 1)]

    def edge(a: int, b: int, room: float, cost: int) -> None:
        graph[a].append(_Edge(b, room, cost, len(graph[b])))
        graph[b].append(_Edge(a, 0.0, -cost, len(graph[a]) - 1))

    for i, p in enumerate(todo):
        for k in range(passes):
            edge(0, first + i, float(capacity[p]), k)
        for s in sorted(p, key=str):
            if s in node:
                edge(first + i, node[s], float("inf"), 0)
    for s in sources:
        edge(node[s], sink, quota[s], 0)
    potential, least = [0.0] * len(graph), 1e-6
    while True:
        dist, via = [float("inf")] * len(graph), [None] * len(graph)
        dist[0], heap = 0.0, [(0.0, 0)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for k, e in enumerate(graph[u]):
                nd = d + e.cost + potential[u] - potential[e.to]
                if e.room > least and nd < dist[e.to] - 1e-9:
                    dist[e.to], via[e.to] = nd, (u, k)
                    heapq.heappush(heap, (nd, e.to))
        if dist[sink] == float("inf"):
            break
        potential = [p + d if d < float("inf") else p for p, d in zip(potential, dist, strict=True)]
        path, v = [], sink
        while v:
            u, k = via[v]
            path.append(graph[u][k])
            v = u
        push = min(e.room for e in path)
        for e in path:
            e.room -= push
            graph[e.to][e.back].room += push
    for i, p in enumerate(todo):
        taken[p] = sum(graph[e.to][e.back].room for e in graph[0] if e.to == first + i)
    return taken


def _order(seed: int) -> Column:
    """A row's place in the seeded order: a whole number below 2 ** _BITS of its id and text."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "__id", "__text"), 64 - _BITS)


def _last_pass(rows: DataFrame, rest: dict[str, float], counts: dict[str, int]) -> tuple[dict[str, list[tuple[int, int, int]]], dict[str, list[int]]]:
    """How the last pass takes `rest` words of each pattern: ranges (from, until, words at most) of the order, of which all
    rows go, and single places.

    rows: (__key, __size, __h). counts: rows of each pattern. A round finds the bucket of some _BUCKET rows in which the
    words are met (a small pattern is one bucket), takes what comes before it, and of the bucket the largest rows first
    that still fit; the next round goes on behind it with the rows that fit in what is left. Rows of one place
    (equal id and text) are taken together.
    """
    spark = rows.sparkSession
    ranges: dict[str, list[tuple[int, int, int]]] = {k: [] for k in rest}
    places: dict[str, list[int]] = {k: [] for k in rest}
    now = {k: (r, 0, 1 << 62) for k, r in rest.items() if r >= 1}  # what is left, from where, and the largest size

    def within(edge: dict[str, tuple[float, int, int]]) -> DataFrame:
        """The rows of each pattern's bucket, with what is to be taken of them. edge: (words, bucket, bits of buckets)."""
        plan = [(k, float(r), b, _BITS - bits, now[k][1], now[k][2]) for k, (r, b, bits) in edge.items()]
        told = spark.createDataFrame(plan, "__key string, rest double, edge long, shift int, start long, most long").coalesce(1)
        met = rows.join(F.broadcast(told) if len(plan) <= _SMALL else told, "__key")
        return met.where((F.col("__size") > 0) & (F.col("__size") <= F.col("most")) & (F.col("__h") >= F.col("start")) & F.expr("shiftright(__h, shift) = edge"))

    while now:
        edge = {k: (r, 0, 0) for k, (r, *_) in now.items()}
        left, bits = {k: counts[k] for k in now}, 0
        while (many := {k: edge[k] for k in edge if left[k] > _BUCKET}) and bits < _BITS:  # they all have as many bits
            step = min(_STEP, _BITS - bits, max(1, (max(left[k] for k in many) // _BUCKET).bit_length()))
            bits += step
            per = within(many).groupBy("__key", F.shiftright("__h", _BITS - bits).alias("bucket")).agg(F.sum("__size").alias("size"), F.count("*").alias("n"), F.max("rest").alias("rest"))
            upto = F.sum("size").over(Window.partitionBy("__key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
            met = per.withColumn("upto", upto).where("upto >= rest and upto - size < rest").select("__key", "bucket", "n", (F.col("rest") - (F.col("upto") - F.col("size"))).alias("rest")).collect()  # a row a pattern
            for k in many.keys() - {r["__key"] for r in met}:  # all that fits is less than what is left
                ranges[k].append((now[k][1], 1 << _BITS, now[k][2]))
                del edge[k]
            for r in met:
                edge[r["__key"]], left[r["__key"]] = (r["rest"], r["bucket"], bits), r["n"]
        if not edge:
            break
        bag = within(edge).groupBy("__key", "rest", "__h").agg(F.sum("__size").alias("s")).groupBy("__key", "rest").agg(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("s"), F.col("__h").alias("h")))).alias("items"))
        begin = F.struct(F.col("rest").alias("room"), F.array().cast("array<long>").alias("hs"))
        fits = lambda acc, x: F.when(acc["room"] + x["s"] >= -0.5, F.struct((acc["room"] + x["s"]).alias("room"), F.array_append(acc["hs"], x["h"]).alias("hs"))).otherwise(acc)
        nxt = {}
        for r in bag.select("__key", F.aggregate("items", begin, fits).alias("x")).collect():  # a row a pattern, of some _BUCKET places
            k, (room, hs) = r["__key"], r["x"]
            _, bucket, of = edge[k]
            width = 1 << (_BITS - of)
            ranges[k].append((now[k][1], bucket * width, now[k][2]))
            places[k] += hs
            if room >= 1 and (bucket + 1) * width < 1 << _BITS:
                nxt[k] = (room, (bucket + 1) * width, int(min(room, now[k][2])))
        now = nxt
    return ranges, places


def mix(docs: DataFrame, sources: Column, weights, id_col: str = "doc_id", text_col: str = "text", seed: int = 42) -> DataFrame:
    """All columns of `docs` with __size, __sources (sorted), __target and __source_size (of the first) and __copies.

    sources: an array of the sources a row belongs to (none: the row is not taken). weights: a function
    from the sorted list of sources (null last) to {source: weight}, or such a dict. Targets are
    `targets()` of the sources' sizes. Rows without words (null and empty texts) are taken as often as whole
    passes say; very long texts count like others. The seeded order depends on id and text alone, so reruns agree;
    rows equal in both are at one place of it and taken alike. The taken words fall short of the flow by less than the
    smallest row that was not taken. Columns of the operator's names are replaced; an empty table
    gives an empty table. The driver holds a few hundred bytes for each membership pattern that occurs.
    """
    internal(docs, id_col, text_col)
    docs = docs.drop(*(f"__{n}" for n in ("size", "sources", "id", "text", "key", "h", "target", "source_size", "whole", "ranges", "places", "copies")))
    kind = docs.select(sources.alias("s")).schema["s"].dataType.simpleString()
    member = F.coalesce(F.array_sort(F.array_distinct(sources)), F.array().cast(kind))
    told = docs.select("*", size_of(F.col(text_col)).alias("__size"), member.alias("__sources"), F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    told = told.withColumn("__key", F.to_json(F.struct("__sources"))).withColumn("__h", _order(seed)).drop("__id", "__text")
    rows = Stored(told.select("__key", "__sources", "__size", "__h"), "mixing").df
    found = list(rows.groupBy("__key").agg(F.first("__sources").alias("p"), F.count("*").alias("n"), F.sum("__size").alias("size")).toLocalIterator())
    found.sort(key=lambda r: r["__key"])
    capacity = {tuple(r["p"]): int(r["size"]) for r in found}
    sizes: dict = {}
    for p, n in capacity.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    weight = weights(sorted(sizes, key=lambda s: (s is None, s or ""))) if callable(weights) else weights
    quota = targets(sizes, weight)
    if (every := sum(sizes.values())) and (once := sum(n for p, n in capacity.items() if p)) != every:
        quota = {s: x * once / every for s, x in quota.items()}  # documents of several sources count once in what there is to share
    taken = flow({p: n for p, n in capacity.items() if p}, quota)
    plan, rest = [], {}
    for r in found:
        p = tuple(r["p"])
        n, words = taken.get(p, 0.0), capacity[p]
        whole = min(PASSES, int((n + 1e-6) // words)) if words else int(bool(p))
        if words and whole < PASSES and n - whole * words >= 1:
            rest[r["__key"]] = n - whole * words
        plan.append((r["__key"], float(quota[p[0]]) if p else 0.0, sizes[p[0]] if p else 0, whole))
    ranges, places = _last_pass(rows.drop("__sources"), rest, {r["__key"]: r["n"] for r in found}) if rest else ({}, {})
    fields = "__key string, __target double, __source_size long, __whole int, __ranges array<struct<a:long,b:long,most:long>>, __places array<long>"
    plans = docs.sparkSession.createDataFrame([(*x, ranges.get(x[0], []), places.get(x[0], [])) for x in plan], fields)  # a row a pattern
    inside = F.exists("__ranges", lambda x: (F.col("__h") >= x["a"]) & (F.col("__h") < x["b"]) & (F.col("__size") <= x["most"]))
    more = (F.col("__size") > 0) & (inside | F.array_contains("__places", F.col("__h")))
    out = told.join(F.broadcast(plans.coalesce(1)) if len(plan) <= _SMALL else plans, "__key").withColumn("__copies", (F.col("__whole") + more.cast("int")).cast("long"))
    return out.drop("__key", "__h", "__whole", "__ranges", "__places")


def by_rank(pattern: tuple[int, ...] = (5, 2, 1)):
    """Weights 5, 2, 1, 5, ... for the sources in order."""
    return lambda order: {s: pattern[i % len(pattern)] for i, s in enumerate(order)}


def take(docs: DataFrame, sources: Column, weights, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it; columns are those of `docs`, whatever their names."""
    names = docs.columns
    rows = docs.select(*(F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)), sources.alias("sources"))
    mixed = mix(rows, F.col("sources"), weights, f"c{names.index(id_col)}", f"c{names.index(text_col)}", **more).where("__copies > 0")
    again = mixed.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return again.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))
