"""Quality checks: each is rows in, findings out: (t, b, c, v, reason, severity, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import LETTERS, extract_root, letter_tokens, snippet, split_token, turkish_lower, word_count
from . import windows
from .vocab import character_counts, character_rates, combined_frequency

#: Rates per 1,000 characters: (low, high) of the detector and of the check after correction (fixed values).
DETECT = {"ı": (22.0, 52.0), "ş": (5.5, 20.0), "y": (16.0, 40.0), "b": (9.0, 27.0), "ğ": (3.5, 16.0)}
CLEAN = {"ı": (25.0, 50.0), "ş": (6.0, 18.0), "y": (16.0, 36.0), "b": (9.0, 26.0), "ğ": (4.0, 15.0)}
WEIGHTS = {"LOW_ı": 0.30, "LOW_ş": 0.25, "HIGH_y": 0.25, "HIGH_b": 0.12, "LOW_ğ": 0.05, "DIGIT_IN_WORD": 0.03}
CORRUPTED = 0.28
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
PAIRS = (("b", "ş"), ("y", "ı"), ("Y", "İ"), ("ö", "ğ"))
DIGIT_IN_WORD = rf"[{LETTERS}]\d+[{LETTERS}]"
SUSPICIOUS = rf"^[{LETTERS}]*(?:[yY]{{2,}}|[bB][yY]|[yY][bB]|9[a-zçğışöü])"
UNCORRECTED = "[yY]{2,}[a-zçğışöü]|[a-zçğışöü]{2,}[bB][yY]|[a-zçğışöü][yY][bB]"
GARBAGE = rf"[{LETTERS}][0-9]{{2,}}|[0-9]{{2,}}[{LETTERS}]|[A-Z]{{5,}}|[a-zçğışöü]{{2,}}[A-ZÇĞIŞÖÜ][a-zçğışöü]{{2,}}"


def _finding(df: DataFrame, reason: Column | str, severity: Column | str, detail: Column | str = "", v: str | None = "v", c: str | None = "c") -> DataFrame:
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    col = lambda n, k: F.col(n).cast(k) if n and n in df.columns else F.lit(None).cast(k)
    return df.select(col("t", "string").alias("t"), col("b", "string").alias("b"), col(c, "int").alias("c"), col(v, "int").alias("v"), lit(reason).alias("reason"), lit(severity).alias("severity"), lit(detail).cast("string").alias("detail"))


def union(*findings: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def rank_of(severity: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SEVERITIES)), severity)


def in_order(findings: DataFrame) -> DataFrame:
    """Worst first, then by place; nulls as 0."""
    return findings.orderBy(rank_of(F.col("severity")), "t", "b", F.coalesce("c", F.lit(0)), F.coalesce("v", F.lit(0)), "reason", "detail")


def count_by(findings: DataFrame, *keys: str, most: int | None = None) -> DataFrame:
    got = findings.groupBy(*keys).agg(F.count("*").alias("n"))
    return got.orderBy(F.desc("n"), *keys).limit(most) if most else got


def deviation(value: Column, bound: Column) -> Column:
    """Severity of a distance from a bound, relative to the bound (1 at least)."""
    r = F.abs(value - bound) / F.greatest(bound, F.lit(1.0))
    return F.when(r >= 0.5, "CRITICAL").when(r >= 0.25, "HIGH").when(r >= 0.10, "MEDIUM").otherwise("LOW")


def character_ranges(verses: DataFrame, keys: list[str], ranges: dict[str, tuple[float, float]] = DETECT, prefix: str = "") -> DataFrame:
    """(keys, type, value, severity): characters that are too rare or too frequent in a group with text."""
    chars = "".join(ranges)
    counts = character_counts(verses, keys, chars=chars).where("total > 0")
    rates = character_rates(counts, keys, chars)
    low, high = (F.create_map(*(F.lit(x) for c, r in ranges.items() for x in (c, r[i]))) for i in (0, 1))
    told = rates.withColumns({"low": F.element_at(low, F.col("char")), "high": F.element_at(high, F.col("char"))})
    told = told.where("rate < low or rate > high")
    below = F.col("rate") < F.col("low")
    return told.select(*keys, F.concat(F.lit(prefix), F.when(below, "LOW_").otherwise("HIGH_"), "char").alias("type"), F.col("rate").alias("value"), deviation(F.col("rate"), F.when(below, F.col("low")).otherwise(F.col("high"))).alias("severity"))


def corruption(verses: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, score, is_corrupted, issues) of each group; a group without text has the issue NO_TEXT."""
    ranges = character_ranges(verses, keys).select(*keys, "type")
    digits = verses.where(F.col("text").rlike(DIGIT_IN_WORD)).select(*keys).distinct().withColumn("type", F.lit("DIGIT_IN_WORD"))
    issues = ranges.unionByName(digits).groupBy(*keys).agg(F.array_sort(F.collect_set("type")).alias("issues"))
    groups = verses.groupBy(*keys).agg(F.max(F.coalesce(F.trim("text"), F.lit("")) != "").alias("__text"))
    told = groups.join(issues, keys, "left").withColumn("issues", F.when(~F.col("__text"), F.array(F.lit("NO_TEXT"))).otherwise(F.coalesce("issues", F.array().cast("array<string>"))))
    has = lambda x: F.array_contains("issues", x)
    score = F.least(F.lit(1.0), sum((F.when(has(k), w).otherwise(0.0) for k, w in WEIGHTS.items()), F.lit(0.0)))
    bad = (score >= CORRUPTED - 1e-9) | (has("LOW_ı") & has("HIGH_y")) | (has("LOW_ş") & has("HIGH_b"))
    return told.select(*keys, F.bround(score, 3).alias("score"), bad.alias("is_corrupted"), "issues")


def requested(books: DataFrame, report: DataFrame, keys: list[str], chapters: DataFrame | None = None) -> DataFrame:
    """The report for every requested book; those without rows have the issue NOT_FOUND, or NO_CHAPTERS if `chapters`
    (keys: the books that there are, with chapters or without) knows them."""
    told, none = books.join(report, keys, "left"), F.lit("NOT_FOUND")
    if chapters is not None:
        told = told.join(chapters.select(*keys).distinct().withColumn("__there", F.lit(True)), keys, "left")
        none = F.when(F.col("__there"), "NO_CHAPTERS").otherwise("NOT_FOUND")
    told = told.withColumn("issues", F.coalesce("issues", F.array(none))).drop("__there")
    return told.withColumns({ "score": F.coalesce("score", F.lit(0.0)), "is_corrupted": F.coalesce("is_corrupted", F.lit(False))})


def suspicious_tokens(words: DataFrame, keys: list[str], most: int = 30) -> DataFrame:
    """The first distinct odd tokens of a group. words: (keys, place, word), place ordering a group."""
    first = words.where(F.col("word").rlike(SUSPICIOUS)).groupBy(*keys, "word").agg(F.min("place").alias("place"))
    return windows.top_k(first, keys, most, ["place", "word"])


def validation(verses: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, type): what is left after correction: ranges, digits in words, odd tokens, short verses."""
    ranges = character_ranges(verses, keys, CLEAN, "STILL_").select(*keys, "type")
    kinds = F.array_compact(F.array(
        F.when(F.col("text").rlike(DIGIT_IN_WORD), "DIGIT_ARTEFACT"), F.when((F.length("text") > 0) & (F.length("text") < 8), "SHORT_VERSE"),
        F.when(F.lower("text").rlike(UNCORRECTED), "UNCORRECTED_TOKEN"),
    ))
    return ranges.unionByName(verses.select(*keys, F.explode(kinds).alias("type")))


def passed(groups: DataFrame, issues: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, passed): groups without an issue pass (short verses are told, but no issue)."""
    bad = issues.where("type <> 'SHORT_VERSE'").select(*keys).distinct().withColumn("__bad", F.lit(True))
    return groups.select(*keys).distinct().join(bad, keys, "left").select(*keys, F.col("__bad").isNull().alias("passed"))


def sequence(verses: DataFrame) -> DataFrame:
    """Duplicates, disorder and more than three missing numbers within a chapter."""
    k = ["t", "b", "c"]
    dup = windows.duplicates(verses, k, "v", ["pos"])
    order = windows.out_of_order(verses, k, "v", ["pos"], strict=False).select(*k).distinct()
    missing = windows.missing_total(verses, k, "v", 3)
    return union(_finding(dup, "DUPLICATE_VERSE", "CRITICAL"), _finding(order, "OUT_OF_ORDER", "HIGH"), _finding(missing, "MISSING_VERSES", "HIGH", F.col("missing")))


def structure(verses: DataFrame, canon: DataFrame, lengths: DataFrame | None = None, gap: int = 1, short_by: int = 2, long_by: int | None = 2) -> DataFrame:
    """Missing and extra chapters, empty ones, duplicates, disorder, gaps, and chapters far from their length.

    canon: (b, chapters); lengths: (b, c, n), the verses a chapter should have.
    """
    k = ["t", "b", "c"]
    have = verses.select(*k).distinct()
    editions = verses.select("t", "b").distinct()
    should = editions.join(F.broadcast(canon.select("b", "chapters")), "b").select("t", "b", F.explode(F.sequence(F.lit(1), "chapters")).alias("c"))
    out = [
        _finding(should.join(have, k, "left_anti"), "MISSING_CHAPTER", "CRITICAL"),
        _finding(have.join(should, k, "left_anti"), "EXTRA_CHAPTER", "HIGH"),
        _finding(windows.duplicates(verses, k, "v", ["pos"]), "DUPLICATE_VERSE", "CRITICAL"),
        _finding(windows.out_of_order(verses, k, "v", ["pos"]), "OUT_OF_ORDER", "HIGH", F.concat_ws(" > ", "previous", "v")),
        _finding(windows.gaps(verses, k, "v", gap), "VERSE_GAP", "CRITICAL", F.to_json("missing"), v="after"),
        _finding(verses.groupBy(*k).agg(F.max(F.trim("text") != "").alias("x")).where("not x"), "EMPTY_CHAPTER", "CRITICAL"),
    ]
    if lengths is not None:
        last = verses.groupBy(*k).agg(F.max("v").alias("v")).join(F.broadcast(lengths), ["b", "c"])
        out.append(_finding(last.where(F.col("v") < F.col("n") - short_by), "CHAPTER_TOO_SHORT", "HIGH", F.concat_ws("/", "v", "n")))
        if long_by is not None:
            out.append(_finding(last.where(F.col("v") > F.col("n") + long_by), "CHAPTER_TOO_LONG", "MEDIUM", F.concat_ws("/", "v", "n")))
    return union(*out)


def empty_or_short(verses: DataFrame, least: int = 8, marker: str = "[verse text missing") -> DataFrame:
    t = F.trim("text")
    told = verses.where((F.length(t) < least) & ~F.contains("text", F.lit(marker)))
    return _finding(told, F.when(F.trim("text") == "", "EMPTY_TEXT").otherwise("SHORT_TEXT"), F.when(F.trim("text") == "", "CRITICAL").otherwise("HIGH"), F.col("text"))


def characters(verses: DataFrame) -> DataFrame:
    """Character-level findings, once for each match where a rule looks at matches. One pass over the verses."""
    text, n = F.col("text"), word_count(F.col("text"))
    item = lambda r, s, d: F.struct(F.lit(r).alias("r"), F.lit(s).alias("s"), d.alias("d"))
    at = lambda i, k: F.substring("text", i, F.lit(k))
    near = lambda i: at(F.greatest(i - 1, F.lit(1)), 1).rlike(r"\p{L}") | F.trim(at(i + 1, 3)).rlike(r"^\p{L}")
    places = F.filter(F.sequence(F.lit(1), F.length("text")), lambda i: (at(i, 1) == "?") & near(i))
    places = F.when(text.rlike(r"\p{L}\?|\?\s{0,2}\p{L}"), places).otherwise(F.array().cast("array<int>"))
    every = lambda p, r: F.transform(F.regexp_extract_all("text", F.lit(p), F.lit(0)), lambda m: item(r, "HIGH", m))
    once = F.array_compact(F.array(
        F.when(text.rlike(r"(?i)dipnot|footnot|\bbkz\b|grekçede|asıl metinde"), item("FOOTNOTE_LEAK", "HIGH", F.substring("text", 1, 120))),
        F.when(text.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"), item("CONTROL_CHAR", "HIGH", F.substring("text", 1, 60))),
        F.when((n > 0) & (n < 5), item("VERY_SHORT_VERSE", "MEDIUM", text)),
        F.when(F.length("text") > 500, item("VERY_LONG_VERSE", "MEDIUM", F.substring("text", 1, 120))),
    ))
    found = F.concat(
        F.transform(places, lambda i: item("EMBEDDED_QUESTION_MARK", "HIGH", snippet(text, i, 15))),
        every(rf"[{LETTERS}]\d|\d[{LETTERS}]", "DIGIT_IN_WORD"), every(rf'[{LETTERS}]["“”„][{LETTERS}]', "QUOTE_CHAR_MID_WORD"), once,
    )
    told = verses.withColumn("x", F.explode(found))
    return _finding(told, F.col("x.r"), F.col("x.s"), F.col("x.d"))


def _tokens(verses: DataFrame, least: int = 3) -> DataFrame:
    return verses.select("t", "b", "c", "v", F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}'‘’]{{{least},}}"), F.lit(0))).alias("word"))


def rare_words(verses: DataFrame, vocab: DataFrame) -> DataFrame:
    """Garbage tokens, and tokens that neither the vocabulary nor (three times) their root knows."""
    tokens = _tokens(verses)
    distinct = tokens.select("word").distinct()
    told = combined_frequency(distinct, vocab, "word", "f").withColumn("root", extract_root(F.col("word")))
    told = told.join(vocab.select(F.col("word").alias("root"), F.col("freq").alias("rf")), "root", "left")
    unknown = told.where("f = 0 and coalesce(rf, 0) < 3").select("word")
    return union(_finding(tokens.where(F.col("word").rlike(GARBAGE)), "OCR_GARBAGE_TOKEN", "HIGH", F.col("word")), _finding(tokens.join(unknown, "word", "left_semi"), "UNKNOWN_TOKEN", "LOW", F.col("word")))


def length_by_median(verses: DataFrame, references: DataFrame, short: float = 0.35, long: float = 3.5, least: int = 3) -> DataFrame:
    """Word counts far from the upper median of the references'. references: (b, c, v, text)."""
    n = references.where("trim(text) <> ''").select("b", "c", "v", word_count(F.col("text")).alias("n"))
    median = n.groupBy("b", "c", "v").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY n DESC)").alias("m"))  # the upper one of two
    told = verses.join(median, ["b", "c", "v"]).where(F.col("m") >= least).withColumn("r", word_count(F.col("text")) / F.col("m"))
    return union(_finding(told.where(F.col("r") < short), "VERSE_TOO_SHORT_VS_REFS", "HIGH", F.bround("r", 2)), _finding(told.where(F.col("r") > long), "VERSE_TOO_LONG_VS_REFS", "MEDIUM", F.bround("r", 2)))


def length_by_mean(verses: DataFrame, references: DataFrame, short: float = 0.08, long: float = 15.0, least: int = 20) -> DataFrame:
    """Lengths extremely far from the references' mean length."""
    mean = references.groupBy("b", "c", "v").agg(F.avg(F.length("text")).alias("m"))
    told = verses.where("text <> ''").join(mean, ["b", "c", "v"]).where(F.col("m") >= least).withColumn("r", F.length("text") / F.col("m"))
    return union(_finding(told.where(F.col("r") < short), "EXTREMELY_SHORT", "HIGH", F.bround("r", 2)), _finding(told.where(F.col("r") > long), "EXTREMELY_LONG", "HIGH", F.bround("r", 2)))


def _substituted(words: DataFrame) -> DataFrame:
    """(word, core, pair, i, candidate): single substitutions of misread characters."""
    told = words.withColumn("core", split_token(F.col("word"))["core"])
    def places(k: int, old: str, new: str) -> Column:
        at = F.filter(F.sequence(F.lit(1), F.length("core")), lambda i: F.substring("core", i, F.lit(1)) == old)
        put = lambda i: F.concat(F.substring("core", F.lit(1), i - 1), F.lit(new), F.substring("core", i + 1, F.length("core")))
        return F.transform(at, lambda i: F.struct(F.lit(k).alias("pair"), i.alias("i"), put(i).alias("candidate")))

    return told.where("core <> ''").select("word", "core", F.inline(F.concat(*(places(k, *p) for k, p in enumerate(PAIRS)))))


def uncorrected(verses: DataFrame, vocab: DataFrame) -> DataFrame:
    """Tokens of which one substitution gives a far better known word: one finding for each pair of characters."""
    tokens = _tokens(verses)
    subs = _substituted(tokens.select("word").distinct().where(F.col("word").rlike("[byYö]")))
    told = combined_frequency(combined_frequency(subs, vocab, "core", "of"), vocab, "candidate", "cf")
    good = told.where("of < 200 and cf >= 20 and ((of = 0 and cf >= 50) or (of > 0 and cf / (of + 1) >= 20))")
    first = good.groupBy("word", "pair").agg(F.min_by("candidate", "i").alias("candidate"))
    return _finding(tokens.join(first, "word"), "UNCORRECTED_CORRUPTION_CANDIDATE", "MEDIUM", F.concat_ws(" > ", "word", "candidate"))


def not_in_references(verses: DataFrame, references: DataFrame, vocab: DataFrame) -> DataFrame:
    """Words that no reference of the verse has, of which one substitution is in the references twice or more."""
    k = ["b", "c", "v"]
    words = verses.select("t", *k, F.explode(letter_tokens(F.col("text"))).alias("word")).where(F.col("word").rlike("[ybö]"))
    ref = references.select(*k, F.explode(letter_tokens(F.col("text"))).alias("word")).groupBy(*k, "word").agg(F.count("*").alias("n"))
    common = vocab.where("freq >= 500").select("word")
    odd = words.join(common, "word", "left_anti").join(ref, [*k, "word"], "left_anti")
    subs = _substituted(odd.select("word").distinct()).select("word", "pair", "i", "candidate")
    hit = odd.join(subs, "word").join(ref.where("n >= 2").withColumnRenamed("word", "candidate"), [*k, "candidate"])
    one = hit.groupBy("t", *k, "word", "pair").agg(F.min_by("candidate", "i").alias("candidate"))
    return _finding(one, "WORD_NOT_IN_REFS", "HIGH", F.concat_ws(" > ", "word", "candidate"))


#: Sanity patterns: (pattern, what it is, severity) (fixed values).
SANITY = (
    (r"(?i)(?<!\p{L})babkâhin", "known misreading of a title", "CRITICAL"),
    ("ELÇ Dipnotları", "footnote block in verse text", "CRITICAL"),
    (r"[Dd]ipnot\p{L}*\s*:", "footnote label in verse text", "CRITICAL"),
    (r"\[verse text missing", "verse marked as missing", "HIGH"),
    ("Genel bakış:", "introduction in verse text", "HIGH"),
    (r"(?<!\d)\d{3,}(?=[A-ZÇĞİÖŞÜa-züşğçöı])", "large number before a word", "HIGH"),
    (r"haksyzIyk|arkadabiyk|adIy(?!\p{L})|yargyçIyk", "known capital-I misreading", "HIGH"),
    ("dü'ünceler", "apostrophe for a letter", "HIGH"),
    ("Permission should be obtained", "copyright notice", "CRITICAL"),
    (r"\(c\) The Translation Trust", "copyright notice", "CRITICAL"),
    (r"(?<!\p{L})Isa(?!\p{L})", "name without its dot", "HIGH"),
)


def sanity(verses: DataFrame, rules=SANITY) -> DataFrame:
    """One finding for each rule that fits a verse, and for each ASCII I between small letters."""
    hits = F.array_compact(F.array(*(F.when(F.col("text").rlike(p), F.struct(F.lit(d).alias("d"), F.lit(s).alias("s"))) for p, d, s in rules)))
    told = verses.withColumn("x", F.explode(hits))
    mid = verses.withColumn("m", F.explode(F.regexp_extract_all("text", F.lit("[a-züşğçöı]I(?=[a-züşğçöı])"), F.lit(0))))
    return union(_finding(told, F.col("x.d"), F.col("x.s")), _finding(mid, "capital I inside a word", "HIGH", F.col("m")))


def verse_lists(verses: DataFrame, expected: DataFrame) -> DataFrame:
    """Chapters whose numbers are not exactly those expected: one finding for each missing or extra number.

    expected: (b, c, v). Only chapters that it names, of editions that have the book, are looked at.
    """
    want = verses.select("t", "b").distinct().join(expected.select("b", "c", "v").distinct(), "b")
    have = verses.where("v is not null").select("t", "b", "c", "v").distinct().join(expected.select("b", "c").distinct(), ["b", "c"], "left_semi")
    k = ["t", "b", "c", "v"]
    return union(_finding(want.join(have, k, "left_anti"), "LIST_MISSING", "CRITICAL"), _finding(have.join(want, k, "left_anti"), "LIST_EXTRA", "CRITICAL"))


def spot_checks(verses: DataFrame, expected: DataFrame) -> DataFrame:
    """Places whose text lacks a keyword, or that are missing. expected: (b, c, v, keyword)."""
    told = expected.join(verses.select("t", "b", "c", "v", "text"), ["b", "c", "v"], "left").where(F.col("text").isNull() | ~F.contains(F.lower("text"), F.lower("keyword")))
    return _finding(told, F.when(F.col("text").isNull(), "SPOT_MISSING").otherwise("SPOT_KEYWORD"), "CRITICAL", F.col("keyword"))


def completeness(verses: DataFrame, canon: DataFrame, reference: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(coverage of each edition, missing chapters of present books, chapters that miss over three reference verses).

    coverage: (t, books, present, expected, permille, scope).
    """
    total = canon.agg(F.sum("chapters").alias("expected"))
    have = verses.select("t", "b", "c").distinct()
    told = have.join(F.broadcast(canon), "b").where(F.col("c").between(1, F.col("chapters")))
    per = told.groupBy("t").agg(F.count_distinct("b").alias("books"), F.count("*").alias("present"), F.max(F.col("testament") == "OT").alias("old"), F.max(F.col("testament") == "NT").alias("new"))
    scope = F.when(F.col("new") & ~F.col("old"), "NT-only").when(F.col("old") & ~F.col("new"), "OT-only").otherwise("Full Bible")
    coverage = per.crossJoin(F.broadcast(total)).select("t", "books", "present", "expected", (F.col("present") * 1000 / F.col("expected")).cast("int").alias("permille"), scope.alias("scope"))
    should = verses.select("t", "b").distinct().join(F.broadcast(canon), "b").select("t", "b", F.explode(F.sequence(F.lit(1), "chapters")).alias("c"))
    missing = should.join(have, ["t", "b", "c"], "left_anti")
    ref = verses.where(F.col("t") == reference).select("b", "c", "v").distinct()
    want = have.where(F.col("t") != reference).join(ref, ["b", "c"])
    flags = want.join(verses.select("t", "b", "c", "v").distinct(), ["t", "b", "c", "v"], "left_anti").groupBy("t", "b", "c").agg(F.count("*").alias("missing")).where("missing > 3")
    return coverage, missing, flags


def words_not_in(verses: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, word): distinct words of each verse that the same verse elsewhere lacks."""
    words = lambda x: x.select(*keys, F.explode(F.array_distinct(letter_tokens(F.col("text")))).alias("word"))
    return words(verses).join(words(others), [*keys, "word"], "left_anti")


def chapter_lists(missing: DataFrame) -> DataFrame:
    """(t, b, chapters): missing chapters as one text."""
    return missing.groupBy("t", "b").agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ", ").alias("chapters"))


def empty_counts(verses: DataFrame, keys: list[str]) -> DataFrame:
    return verses.groupBy(*keys).agg(F.count("*").alias("verses"), F.count_if(F.trim("text") == "").alias("empty"))


