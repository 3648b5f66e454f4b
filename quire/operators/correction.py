"""OCR repair guided by a vocabulary.

Corrections are found once for each distinct token: candidates are rows, their frequencies come by a
join with the vocabulary, and the best one is an aggregate. Only the passes that rewrite a verse from
right to left are Python.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.python import turkish_lower as lower_py
from ..functions.strings import LETTERS, ROOT_SUFFIXES, apply_rules, split_token, tokenise, turkish_lower
from .vocab import combined_frequency

#: Misread characters and what they were (fixed values); the wider map also takes a dotless i.
MISREAD = {"Y": "İ", "y": "ı", "b": "ş", "ö": "ğ"}
WIDER = MISREAD | {"ı": "i"}
DIGITS = {"0": "oöğ", "1": "iıl", "2": "zş", "3": "şğ", "4": "ş", "5": "şs", "6": "ğbö", "7": "t", "8": "şğ"}
QUESTION_INSIDE, QUESTION_FIRST, QUOTE_INSIDE = "ğşıi", "şğİŞĞ", "şğiı"
#: Steps of confidence, as (least value, confidence), highest first (fixed values).
UNKNOWN_STEPS = ((2000, 0.96), (500, 0.92), (100, 0.87), (20, 0.78), (5, 0.65), (1, 0.52))
RATIO_STEPS = ((100, 0.90), (30, 0.80), (10, 0.68), (5, 0.54), (3, 0.38))
PENALTY_STEPS = ((500, 0.72), (100, 0.52), (20, 0.32), (5, 0.14), (1, 0.05))
APPLY, FLAG = 0.55, 0.28
CANDIDATES, WIDER_CANDIDATES = 256, 512


def _steps(value: Column, steps, other: float) -> Column:
    out = F.lit(other)
    for least, x in reversed(steps):
        out = F.when(value >= least, F.lit(x)).otherwise(out)
    return out


def raw_confidence(original: Column, candidate: Column) -> Column:
    """By the candidate's frequency where the original is unknown, else by their ratio."""
    return F.when(original == 0, _steps(candidate, UNKNOWN_STEPS, 0.05)).otherwise(_steps(candidate / (original + 1), RATIO_STEPS, 0.12))


def protection(original: Column) -> Column:
    """What a known word's confidence loses."""
    return _steps(original, PENALTY_STEPS, 0.0)


def confidence(original: Column, candidate: Column, n: Column, dotless: Column | None = None) -> Column:
    c = raw_confidence(original, candidate) - protection(original) - (n - 1) * 0.05
    return F.greatest(F.lit(0.0), c - (0.15 * dotless if dotless is not None else F.lit(0.0)))


def action(conf: Column) -> Column:
    return F.when(conf >= APPLY, "applied").when(conf >= FLAG, "flagged_med").otherwise("flagged_low")


def nine_to_s(core: Column) -> Column:
    """A 9 after a letter or at a word's start, before a small letter, is ş."""
    t = F.regexp_replace(core, f"(?<=[{LETTERS}])9(?=[a-zçğışöü'‘’])", "ş")
    return F.regexp_replace(t, f"(?<![{LETTERS}0-9])9(?=[a-zçğışöü])", "ş")


def subsets(word: str, table: dict[str, str], most: int) -> Iterator[tuple[str, int, int]]:
    """(candidate, substitutions, dotless ones), fewer substitutions first, then by place; up to `most`."""
    places = [i for i, c in enumerate(word) if c in table]
    combos = (x for n in range(1, len(places) + 1) for x in itertools.combinations(places, n))
    for combo in itertools.islice(combos, most):
        chars = list(word)
        for i in combo:
            chars[i] = table[chars[i]]
        yield "".join(chars), len(combo), sum(word[i] == "ı" for i in combo)


def candidates(cores: DataFrame, table: dict[str, str] = MISREAD, most: int = CANDIDATES) -> DataFrame:
    """(core, i, candidate, n, dotless) of distinct cores: subsets of the misread places, in order of trial."""
    keep = cores.where(F.col("core").rlike(f"[{''.join(table)}]")).select("core")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(w, i, *x) for w in f["core"] for i, x in enumerate(subsets(w, table, most))]
            yield pd.DataFrame(rows, columns=["core", "i", "candidate", "n", "dotless"])

    return keep.mapInPandas(run, "core string, i int, candidate string, n int, dotless int")


def best_corrections(cores: DataFrame, vocab: DataFrame, wider: bool = False) -> DataFrame:
    """(core, fixed, conf, n_subs, orig_freq, fixed_freq): the first candidate of the greatest confidence above 0.

    cores: (core), distinct. Cores without one are not returned.
    """
    table, most = (WIDER, WIDER_CANDIDATES) if wider else (MISREAD, CANDIDATES)
    told = combined_frequency(candidates(cores, table, most), vocab, "candidate", "cf")
    of = combined_frequency(cores.select("core"), vocab, "core", "of")
    rated = told.join(of, "core").withColumn("conf", confidence(F.col("of"), F.col("cf"), F.col("n"), F.col("dotless") if wider else None))
    best = F.max(F.struct("conf", (-F.col("i")).alias("i"), "candidate", "n", "of", "cf")).alias("x")
    picked = rated.where("conf > 0").groupBy("core").agg(best)
    return picked.select("core", F.col("x.candidate").alias("fixed"), "x.conf", F.col("x.n").alias("n_subs"), F.col("x.of").alias("orig_freq"), F.col("x.cf").alias("fixed_freq"))


def correct_tokens(tokens: DataFrame, vocab: DataFrame, wider: bool = False) -> DataFrame:
    """(word, output, fixed, confidence, action, type, n_subs, orig_freq, fixed_freq) of distinct tokens with a change.

    A misread 9 comes first and is always applied (0.95); the wider pass has no such step.
    """
    cut = tokens.where(F.length("word") >= 2).select("word", split_token(F.col("word")).alias("p")).withColumn("nine", F.lit(None).cast("string") if wider else nine_to_s(F.col("p.core")))
    nine = cut.where("nine <> p.core").select("word", F.concat("p.prefix", "nine", "p.suffix").alias("fixed"))
    nine = combined_frequency(combined_frequency(nine, vocab, "word", "orig_freq"), vocab, "fixed", "fixed_freq")
    nine = nine.select("word", F.col("fixed").alias("output"), "fixed", F.lit(0.95).alias("confidence"), F.lit("applied").alias("action"), F.lit("9_ş").alias("type"), F.lit(1).alias("n_subs"), "orig_freq", "fixed_freq")
    rest = cut.where("nine is null or nine = p.core").select("word", "p")
    best = best_corrections(rest.select("p.core").distinct(), vocab, wider)
    subs = rest.join(best, rest["p.core"] == best["core"]).where("fixed <> core").withColumn("fixed", F.concat("p.prefix", "fixed", "p.suffix"))
    does = action(F.col("conf"))
    subs = subs.select("word", F.when(does == "applied", F.col("fixed")).otherwise(F.col("word")).alias("output"), "fixed", F.bround("conf", 3).alias("confidence"), does.alias("action"), F.lit("char_sub").alias("type"), "n_subs", "orig_freq", "fixed_freq")
    return nine.unionByName(subs)


def correct_verses(verses: DataFrame, vocab: DataFrame, keys: list[str], wider: bool = False) -> tuple[DataFrame, DataFrame]:
    """(verses with their corrected text, change rows with keys, place and token). keys: unique to a verse.

    Only tokens that hold a misread character meet the corrections, and only those that change are
    gathered by verse: spaces and common words, the hot keys of such a join, are never shuffled.
    """
    table = WIDER if wider else MISREAD
    parts = verses.select(*keys, F.posexplode(tokenise(F.col("text"))).alias("place", "word")).where(F.col("word").rlike(f"[{''.join(table)}9]"))
    fixes = correct_tokens(parts.select("word").distinct(), vocab, wider)
    changes = parts.join(fixes, "word")
    new = changes.where("output <> word").groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("place", "output"))).alias("__new"))
    text = F.array_join(F.transform(tokenise(F.col("text")), lambda w, i: F.coalesce(F.element_at("__new", i), w)), "")
    out = verses.join(new, keys, "left").withColumn("text", F.when(F.col("__new").isNull(), F.col("text")).otherwise(text)).drop("__new")
    return out, changes.drop("output")


#: Patterns of `clean_artifacts`, in order, with what replaces them and the change's name (fixed values).
_CAPITAL = "[A-ZÇĞİÖŞÜ]"
ARTIFACTS = (
    (r"(?is)\s{0,3}[A-Z0-9İI]{1,4}\s+Dipnotlar[ıiy]?[ıiy]?:?.*$", "", "FOOTNOTE_STRIPPED"),
    (r"(?is)\s+[0-9]\s+[A-Z]{1,3}\s+Dipnot.*$", "", "FOOTNOTE_STRIPPED"),
    (r"\s+[0-9]{1,2}[A-Z]{1,3}[0-9]{1,2}(?=[A-ZÇĞİÖŞÜa-zçğışöü])", " ", "INLINE_REF_REMOVED"),
    (r"\s+[<>]\s+", " ", "MID_GT_REMOVED"),
    (r"^>\s*", "", "GT_PREFIX_REMOVED"),
    (f"^-(?={_CAPITAL})", "", "DASH_PREFIX_REMOVED"),
    (f'^["“”„]{{1,2}}(?={_CAPITAL})', "", "QUOTE_PREFIX_REMOVED"),
    (f"^['‘’]{{1,2}}(?={_CAPITAL})", "", "APOS_PREFIX_REMOVED"),
    (rf"^\?(?={_CAPITAL})", "", "ORPHAN_QUEST_REMOVED"),
)


def clean_artifacts(text: Column) -> Column:
    """Struct of the cleaned text and the names of the changes, in order."""
    now, names = text, []
    for pattern, new, name in ARTIFACTS:
        nxt = F.regexp_replace(now, pattern, new)
        nxt = F.rtrim(nxt) if name == "FOOTNOTE_STRIPPED" else nxt
        names.append(F.when(nxt != now, F.lit(name)))
        now = nxt
    return F.struct(F.trim(now).alias("text"), F.array_compact(F.array(*names)).alias("changes"))


class Lexicon:
    """A vocabulary in a Python worker, with the plausibility of words."""

    def __init__(self, freq: dict[str, int]):
        self.freq = freq

    def of(self, word: str) -> int:
        return self.freq.get(word, 0) + self.freq.get(lower_py(word), 0)

    @staticmethod
    def root(word: str) -> str:
        w = lower_py(word)
        for s in sorted(ROOT_SUFFIXES, key=len, reverse=True):
            if w.endswith(s) and len(w) - len(s) >= 3:
                return w[: -len(s)]
        return w[: max(4, len(w) - 2)]

    def plausible(self, word: str) -> int:
        """The frequency, or for rarer words than 5 a quarter of a root's that has 80 or more."""
        f = self.of(word)
        if f >= 5:
            return f
        r = self.of(self.root(lower_py(word)))
        return r // 4 if r >= 80 else f

    def _rate(self, original: int, candidate: int, n: int, dotless: int) -> float:
        at = lambda v, steps, other: next((x for least, x in steps if v >= least), other)
        raw = at(candidate, UNKNOWN_STEPS, 0.05) if not original else at(candidate / (original + 1), RATIO_STEPS, 0.12)
        return max(0.0, raw - at(original, PENALTY_STEPS, 0.0) - (n - 1) * 0.05 - 0.15 * dotless)

    def fully_corrected(self, word: str) -> str:
        """The word after the wider correction, if that would be applied."""
        head, core, tail = re.match(f"(?s)^([^{LETTERS}]*)([{LETTERS}'‘’]*)(.*)$", word).groups()
        original, best, top = self.of(core), core, 0.0
        for w, n, dotless in subsets(core, WIDER, WIDER_CANDIDATES):
            if (c := self._rate(original, self.of(w), n, dotless)) > top:
                best, top = w, c
        return head + best + tail if top >= APPLY else word

    def _around(self, chars: list[str], at: int) -> tuple[int, int]:
        inside = re.compile(f"[{LETTERS}'‘’]")
        a, b = at, at + 1
        while a and inside.match(chars[a - 1]):
            a -= 1
        while b < len(chars) and inside.match(chars[b]):
            b += 1
        return a, b

    def fill(self, text: str, marks: str, inside: str, first: str | None) -> str:
        """Every mark, from the right, replaced by the character that makes the most plausible word (over 4).

        first: candidates at a word's start; None: marks there stay. A mark without a letter after it stays.
        """
        chars = list(text)
        for at in reversed([i for i, c in enumerate(chars) if c in marks]):
            a, b = self._around(chars, at)
            left, right = "".join(chars[a:at]), "".join(chars[at + 1 : b])
            if not any(map(str.isalpha, right)) or (not left and first is None):
                continue
            best, top = None, 4
            for c in inside if left else first:
                for w in dict.fromkeys((left + c + right, self.fully_corrected(left + c + right))):
                    if (s := self.plausible(w)) > top:
                        best, top = w, s
            if best:
                chars[a:b] = best
        return "".join(chars)

    def undigit(self, word: str) -> str:
        """A word with up to four of its digits (but 9) as letters, if that is a better known word."""
        places = [i for i, c in enumerate(word) if c in DIGITS]
        original = self.of(word)
        if not places or original >= 50:
            return word
        best, top, tried = word, max(original, 4), 0
        for n in range(1, min(4, len(places)) + 1):
            for combo in itertools.combinations(places, n):
                for letters in itertools.product(*(DIGITS[word[i]] for i in combo)):
                    if tried >= WIDER_CANDIDATES:
                        return best
                    tried += 1
                    chars = list(word)
                    for i, c in zip(combo, letters, strict=True):
                        chars[i] = c
                    for w in dict.fromkeys(("".join(chars), self.fully_corrected("".join(chars)))):
                        if (f := self.of(w)) > top:
                            best, top = w, f
        return best

    def repair(self, text: str) -> str:
        """Question marks, quote characters and digits inside words, in this order."""
        text = self.fill(text, "?", QUESTION_INSIDE, QUESTION_FIRST) if "?" in text else text
        text = self.fill(text, '"“”„', QUOTE_INSIDE, None)
        word = f"[{LETTERS}][{LETTERS}0-9]*[0-9][{LETTERS}0-9]*|[0-9]+[{LETTERS}][{LETTERS}0-9]*"
        return re.sub(word, lambda m: self.undigit(m[0]), text)


#: What `Lexicon.repair` puts in place of marks, digits and misread letters, with these, is one class in a skeleton.
_CLASS = 'bşyıiöğolzst012345678?"“”„'
_RUN = f"{LETTERS}0-9'‘’?\"“”„"


def _skeleton(word: Column) -> Column:
    return F.translate(turkish_lower(word), _CLASS, "*" * len(_CLASS))


def repaired_runs(runs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(run, fixed) of distinct runs of letters, digits, apostrophes and marks that `Lexicon.repair` changes.

    What it looks up has the skeleton of a beginning of what follows a mark, digit or apostrophe, or of the run itself;
    so a run meets the words it may need in an equi-join, and no task holds the vocabulary.
    """
    bare, n = _skeleton(F.col("run")), F.length("run")
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | F.substring("run", i - 1, F.lit(1)).rlike("[0-9'‘’?\"“”„]"))
    beginnings = lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.substring(bare, i, k))
    keys = runs.select("run", F.explode(F.array_distinct(F.flatten(F.transform(starts, beginnings)))).alias("skeleton"))
    known = vocab.select("word", "freq", _skeleton(F.col("word")).alias("skeleton"))
    need = keys.join(known, "skeleton").groupBy("run").agg(F.collect_list(F.struct("word", "freq")).alias("known"))

    @F.pandas_udf("string")
    def run(run: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([Lexicon({x["word"]: int(x["freq"]) for x in k}).repair(r) for r, k in zip(run, known, strict=True)], dtype=object)

    return need.withColumn("fixed", run("run", "known")).where("fixed <> run").select("run", "fixed")


def repair_characters(verses: DataFrame, vocab: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Verses with misread ?, quotes and digits inside words repaired. keys: unique to a verse.

    Each distinct run is repaired once, and only runs that change are gathered by verse.
    """
    cut = F.regexp_extract_all(text, F.lit(f"[{_RUN}]+|[^{_RUN}]+"), F.lit(0))
    odd = verses.where(F.col(text).rlike('[?"“”„]|[0-8]')).select(*keys, F.posexplode(cut).alias("place", "run"))
    odd = odd.where(F.col("run").rlike(f"[{LETTERS}]") & F.col("run").rlike('[?"“”„0-8]'))
    fixes = odd.join(repaired_runs(odd.select("run").distinct(), vocab), "run")
    new = fixes.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("place", "fixed"))).alias("__new"))
    put = F.array_join(F.transform(cut, lambda w, i: F.coalesce(F.element_at("__new", i), w)), "")
    return verses.join(new, keys, "left").withColumn(text, F.when(F.col("__new").isNull(), F.col(text)).otherwise(put)).drop("__new")


def change_counts(changes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, applied, flagged, total) of change rows."""
    return changes.groupBy(*keys).agg(F.count_if(F.col("action") == "applied").alias("applied"), F.count_if(F.col("action") != "applied").alias("flagged"), F.count("*").alias("total"))


def patch_then_truncate(verses: DataFrame, patches: DataFrame, keys: list[str], sentinels: DataFrame) -> DataFrame:
    """`apply_patches`, then the texts of the verses that `sentinels` (keys, sentinel) names up to their sentinel."""
    told = apply_patches(verses, patches, keys).join(sentinels.select(*keys, F.col("sentinel").alias("__s")), keys, "left")
    at = F.call_function("instr", F.col("text"), F.col("__s"))
    return told.withColumn("text", F.when(at > 0, F.substring("text", F.lit(1), at + F.length("__s") - 1)).otherwise(F.col("text"))).drop("__s")


def join_splits(tokens: list[str], known: set[str], most: int = 6, prefix: int = 7, suffix: int = 5) -> list[str]:
    """Words that a line break split, joined: of up to `most` following tokens the longest join that is known,
    or that begins with a known word of `prefix` or more letters and up to `suffix` more."""
    out, i = [], 0

    def accepted(w: str) -> bool:
        return w in known or any(w[:n] in known for n in range(max(prefix, len(w) - suffix), len(w)))

    while i < len(tokens):
        take = 0
        if lower_py(tokens[i]) not in known:
            for n in range(min(most, len(tokens) - i - 1), 0, -1):
                if accepted(lower_py("".join(tokens[i : i + n + 1]))):
                    take = n
                    break
        out.append("".join(tokens[i : i + take + 1]))
        i += take + 1
    return out


def join_split_words(verses: DataFrame, references: DataFrame, keys: list[str], longest: int = 400) -> DataFrame:
    """Verses of up to `longest` characters with split words joined, by the words of the same verse elsewhere.

    references: (keys, words array). Verses without a reference stay.
    """

    @F.pandas_udf("string")
    def run(text: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([t if k is None or t is None or len(t) > longest else " ".join(join_splits(t.split(), {lower_py(w) for w in k})) for t, k in zip(text, known, strict=True)])

    known = references.withColumnRenamed("words", "__known")
    told = verses.join(known, keys, "left")
    return told.withColumn("text", F.when(F.col("__known").isNull(), F.col("text")).otherwise(run("text", "__known"))).drop("__known")


def apply_patches(verses: DataFrame, patches: DataFrame, keys: list[str]) -> DataFrame:
    """Literal replacements by verse. patches: (keys, n, old, new), applied in order of n."""
    fold = patches.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("n", "old", "new"))).alias("__p"))
    text = F.aggregate("__p", F.col("text"), lambda t, p: F.replace(t, p["old"], p["new"]))
    return verses.join(fold, keys, "left").withColumn("text", F.coalesce(text, "text")).drop("__p")


def apply_pattern_rules(verses: DataFrame, rules: list[tuple[str, str]], text: str = "text") -> DataFrame:
    return verses.withColumn(text, apply_rules(F.col(text), rules))


def semantic_risks(changes: DataFrame, vocab: DataFrame, least: int = 50, ratio: int = 10) -> DataFrame:
    """Applied changes between two well-known words of which neither dominates."""
    told = combined_frequency(combined_frequency(changes.where("action = 'applied'"), vocab, "word", "__o"), vocab, "fixed", "__f")
    return told.where((F.col("__o") >= least) & (F.col("__f") >= least) & (F.col("__f") / (F.col("__o") + 1) < ratio)).drop("__o", "__f")


def verse_scores(verses: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, words, score): 100 less 10 for each whole unit of doubt and 1.5 for each flag, in 0 to 100."""
    doubt = F.sum(F.when(F.col("action") == "applied", (1 - F.least(F.col("confidence"), F.lit(1.0))) * 10).otherwise(1.5))
    lost = changes.groupBy(*keys).agg(doubt.alias("__lost"))
    words = F.greatest(F.regexp_count("text", F.lit(r"\S+")), F.lit(1))
    told = verses.join(lost, keys, "left").withColumn("words", words)
    return told.select(*keys, "words", F.least(F.lit(100), F.greatest(F.lit(0), F.bround(100 - F.coalesce("__lost", F.lit(0.0))))).cast("int").alias("score"))


BUCKETS = ("100", "90-99", "80-89", "70-79", "60-69", "<60")


def bucket(score: Column) -> Column:
    return F.when(score == 100, "100").when(score >= 90, "90-99").when(score >= 80, "80-89").when(score >= 70, "70-79").when(score >= 60, "60-69").otherwise("<60")


def histogram(scores: DataFrame) -> DataFrame:
    """(bucket, n) of all buckets, with zeros."""
    spark = scores.sparkSession
    every = spark.createDataFrame([(b,) for b in BUCKETS], "bucket string").coalesce(1)
    got = scores.groupBy(bucket(F.col("score")).alias("bucket")).agg(F.count("*").alias("n"))
    return F.broadcast(every).join(got, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def book_scores(scores: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, score): the mean by words, rounded to two places."""
    return scores.groupBy(*keys).agg(F.bround(F.sum(F.col("score") * F.col("words")) / F.sum("words"), 2).alias("score"))
