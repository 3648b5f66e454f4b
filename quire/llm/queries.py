"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprint, langid, lm, mixing, packing, qualityclf, rules, simhash, toxicity, urlfilter
from .common import documents, held_out, stored


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned where crc32(doc_id) mod 4 is not 2."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.fit(langid.training(docs, ~held_out(F.col("doc_id"), 4, 2)))
    rows = langid.predict(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


#: Hosts blocked with their subdomains where no rule fits: each unwanted name under each domain; and the rules (fixed values).
LISTED = [f"{name}.example.{top}" for name in ("spam-farm", "casino-win", "ads-track", "cheap-pills", "free-bets", "adult-x") for top in ("com", "net", "org")]
RULES = [
    urlfilter.Rule("com", "/", "allow"),
    urlfilter.Rule("example.com", "/en/", "block"),
    urlfilter.Rule("www.example.com", "/en/", "allow"),
    urlfilter.Rule("net", "/es/", "block"),
    urlfilter.Rule("net", "/fr/", "block"),
]


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rows = urlfilter.filter_urls(pages, LISTED, RULES)
    return rows.select("page_id", F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"), F.col("__verdict").alias("verdict"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted; learned where crc32(doc_id) mod 3 is not 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id"), 3, 1))
    rows = stored(qualityclf.features(documents(spark, sf_dir)), "quality")
    scored = qualityclf.score(rows, qualityclf.fit(rows, labels, "quality"))
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id: links at two or fewer differing bits."""
    rows = simhash.near_duplicates(documents(spark, sf_dir), simhash.EXACT)
    return rows.select("doc_id", simhash.hexadecimal(F.col("f0")).alias("fingerprint"), "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packing.pack(documents(spark, sf_dir))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (1 if equal, else 0).

    A fingerprint is exact, so two are alike wholly or not at all.
    """
    docs = documents(spark, sf_dir).select("doc_id", "text")
    own = fingerprint.fingerprints_with_edits(docs)
    alike = lambda a, b: F.when(F.col(a) == F.col(b), F.lit(1.0)).otherwise(F.lit(0.0))
    return own.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", alike("fingerprint", "edited_fingerprint").alias("near_edited"), alike("fingerprint", "next_fingerprint").alias("near_next"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the five statistics, base_failed, kept, quality."""
    rows = rules.judge(documents(spark, sf_dir).select("doc_id", "text"), keep_text=False)
    failed = rules.base_failed(F.col("__n_words"), F.col("__n_repeat_words"))
    return rows.select("doc_id", *(F.col(f"__{s}").alias(s) for s in rules.STATS), failed.alias("base_failed"), F.col("__kept").alias("kept"), F.col("__quality").alias("quality"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken: sources weigh 5, 2, 1, ... by code point, null last."""
    rows = mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source"), F.array("source"), mixing.by_rank())
    return rows.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, severity, grade, p_toxic, toxic; learned where crc32(doc_id) mod 5 is not 3."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id"), 5, 3))
    rows = toxicity.score(docs, toxicity.fit(docs, labels))
    return rows.select("doc_id", held_out(F.col("doc_id"), 5, 3).alias("held_out"), "severity", "grade", "p_toxic", (F.col("p_toxic") >= 0.5).cast("int").alias("toxic"))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learned where crc32(doc_id) mod 7 is not 2."""
    rows = lm.score_documents(documents(spark, sf_dir), ~held_out(F.col("doc_id"), 7, 2))
    return rows.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_url_filters": op2_url_filters,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_simhash": op4_simhash,
    "op5_packing": op5_packing,
    "op6_fingerprints": op6_fingerprints,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_language_model": op10_language_model,
}

_LISTED = ", ".join(f"'{x}'" for x in LISTED)
_FITS = " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {i}" for i, r in sorted(enumerate(RULES), key=lambda x: -len(x[1].text)))
_CASES = lambda f: " ".join(f"WHEN {i} THEN '{f(r)}'" for i, r in enumerate(RULES))
ORACLE_SQL: dict[str, str] = {
    "op2_url_filters": f"""
WITH cut AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*(/[^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (SELECT *, CASE {_FITS} END AS i FROM cut)
SELECT page_id, host, path, CASE i {_CASES(lambda r: r.text)} END AS rule,
       CASE i {_CASES(lambda r: r.verdict)}
         ELSE CASE WHEN EXISTS (SELECT 1 FROM unnest([{_LISTED}]) t(x) WHERE host = x OR ends_with(host, '.' || x)) THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled""",
}
