import random

import pytest
from pyspark.sql import functions as F

import oracle
from quire.llm import queries, urlfilter

ODD = [None, "", "no scheme", "http://", "http://a.com", "HTTP://WWW.Example.COM/en/x?y=/fr/", "x://b.net?z", "http://c.example.org#f", "http://example.com/en/", "http://example.com/en", "http://notexample.com/en/", "ftp://u@spam.org/a://b", "http://" + "a." * 5000 + "spam.org/x", "http://bad.spam.org", "http://spam.org.uk/", "http://net/fr/", "http://[::1]/x", "http://Ü.com/"]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = lambda s, chars: min([s.find(c) for c in chars if c in s] or [len(s)])
    host = rest[: cut(rest, "/?#")]
    tail = rest[len(host) :]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[: cut(tail, "?#")]


def verdict(url, listed, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        r = max(fits, key=lambda r: len(r.text))
        return host, path, r.text, r.verdict
    return host, path, None, "block" if any(host == x or host.endswith("." + x) for x in listed) else "allow"


def test_odd_urls(spark):
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(ODD)], "page_id long, url string, __host string, host int")
    got = urlfilter.filter_urls(df, ["spam.org"], queries.RULES).collect()
    assert {r["page_id"]: (r["__host"], r["__path"], r["__rule"], r["__verdict"]) for r in got} == {i: verdict(u, ["spam.org"], queries.RULES) for i, u in enumerate(ODD)}
    assert urlfilter.filter_urls(df.limit(0), [], queries.RULES).collect() == []


def test_cascade_is_exact_and_has_levels(spark):
    rng = random.Random(1)
    keys = [f"h{i}.{rng.randrange(10**6)}" for i in range(6000)]
    listed = set(rng.sample(keys, 1500))
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    c = urlfilter.Cascade(spark.createDataFrame([(k,) for k in [*listed, "not in the corpus"]], "key string"), universe)
    assert len(c.levels) >= 2
    got = {r["key"]: r["x"] for r in universe.select("key", c.contains(F.col("key")).alias("x")).collect()}
    assert got == {k: k in listed for k in keys}


@pytest.mark.parametrize("bounds", [{"max_bits": 64}, {"all_bits": 1}])
def test_shards_and_the_semi_join_give_the_same(spark, bounds):
    df = spark.createDataFrame(list(enumerate(ODD)), "page_id long, url string")
    listed = ["spam.org", "b.net", *(f"x{i}.org" for i in range(40))]
    a = urlfilter.filter_urls(df, listed, queries.RULES).orderBy("page_id").collect()
    assert a == urlfilter.filter_urls(df, listed, queries.RULES, **bounds).orderBy("page_id").collect()


def test_a_sharded_cascade_is_exact(spark):
    rng = random.Random(2)
    keys = [f"h{i}.{rng.randrange(10**6)}" for i in range(1500)]
    listed = set(rng.sample(keys, 400))
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    c = urlfilter.Cascade(spark.createDataFrame([(k,) for k in listed], "key string"), universe, max_bits=1024)
    assert len(c.levels) >= 2 and len(c.levels[0].shards) == 4
    assert {r["key"]: r["x"] for r in universe.select("key", c.contains(F.col("key")).alias("x")).collect()} == {k: k in listed for k in keys}


def test_query_against_sql_and_brute_force(spark):
    d = "/root/testdata/sf0.01"
    assert not oracle.differences(queries.op2_url_filters(spark, d), queries.ORACLE_SQL["op2_url_filters"], oracle.connect(d))
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    for r in queries.op2_url_filters(spark, d).collect():
        assert tuple(r)[1:] == verdict(urls[r["page_id"]], queries.LISTED, queries.RULES)


def test_plan_has_no_python_and_no_join_on_the_main_path(spark):
    plan = queries.op2_url_filters(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan and "html" not in plan.split("ReadSchema")[1]
