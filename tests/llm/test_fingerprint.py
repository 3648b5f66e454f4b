import hashlib
import re
import unicodedata

from pyspark.sql import functions as F

from quire.llm import fingerprint, queries


def canonical(text):
    t = unicodedata.normalize("NFC", unicodedata.normalize("NFC", text or "").casefold())
    return re.sub(r"[\s\x1c-\x1f\x85]+", " ", t).strip(" ")


TEXTS = ["Schön  Test", "scho\u0308n\ttest ", "SCHÖN\ntest", "schon test", "", None, " ", "\u00a0x\u2003y", "X Y", "Straße", "STRASSE", "é" * 3, "e\u0301" * 3, "😀 a", "a😀", "İ", "a\x1cb", "a b", "α\u0301\u0345", "α\u0345\u0301", "ᾴ", "ΆΙ", "ﬁ", "FI", "ǰ", "J\u030c"]


def test_fingerprints_are_equal_exactly_if_canonical_texts_are(spark):
    rows = fingerprint.fingerprints(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()
    fp = {r["doc_id"]: r["fingerprint"] for r in rows}
    assert {r["doc_id"]: r["n_chars"] for r in rows} == {i: len(t or "") for i, t in enumerate(TEXTS)}
    for i, a in enumerate(TEXTS):
        for j, b in enumerate(TEXTS):
            assert (fp[i] == fp[j]) == (canonical(a) == canonical(b)), (a, b)


def test_shared_digests_get_suffixes(spark):
    rows = spark.createDataFrame([("d", "b"), ("d", "a"), ("d", "B "), ("e", "x"), ("e", "X"), ("f", "y")], "digest string, text string")
    assert [tuple(r) for r in fingerprint.collisions(rows).collect()] == [("d", "b", "-2")]
    named = fingerprint._named(rows, fingerprint.collisions(rows), F.col("text"), "digest", "fp")
    assert sorted((r["text"], r["fp"]) for r in named.collect()) == [("B ", "d-2"), ("X", "e"), ("a", "d"), ("b", "d-2"), ("x", "e"), ("y", "f")]


def reference(docs):
    """(n_chars, edited_sha256, is the edit the same, is the next the same) by id, for distinct ids."""
    order = sorted(docs)
    out = {}
    for i, doc in enumerate(order):
        text, nxt = docs[doc] or "", docs[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        edit = text[: len(text) - half] + nxt[:half]
        out[doc] = (len(text), hashlib.sha256(edit.encode()).hexdigest(), float(canonical(edit) == canonical(text)), float(canonical(nxt) == canonical(text)))
    return out


def told(rows):
    return {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in rows}


def test_query(spark):
    d = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    assert told(queries.op6_fingerprints(spark, d).collect()) == reference(docs)


def test_edits_of_odd_texts(spark, tmp_path):
    docs = {10 * i - 60: t for i, t in enumerate([*TEXTS, "same text", "same text", "same text", None, None])}
    spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs.items()], "doc_id long, text string, digest string, next string, r int").write.parquet(f"{tmp_path}/documents.parquet")
    assert told(queries.op6_fingerprints(spark, str(tmp_path)).collect()) == reference(docs)


def test_odd_rows(spark, odd, empty):
    assert fingerprint.fingerprints(odd).count() == odd.count() == fingerprint.fingerprints_with_edits(odd).count()
    assert fingerprint.fingerprints(empty).collect() == [] == fingerprint.fingerprints_with_edits(empty).collect()
    one = fingerprint.fingerprints_with_edits(odd.where("doc_id = 9")).first()
    assert one["fingerprint"] == one["next_fingerprint"] == one["edited_fingerprint"]


def test_plan_is_native(spark):
    plan = queries.op6_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
