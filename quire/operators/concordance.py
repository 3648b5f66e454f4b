"""Usage indexes: distinctive terms of each lexicon id, and where they occur."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import inner_apostrophe_tokens, python_split, stop_word_tokens, turkish_lower
from .windows import bigrams, top_k, without_overlap

#: Beginnings of names that are left out, since they stand in most verses (fixed values).
SACRED = ("allah", "tanrı", "rab", "mesih", "isa", "efendi")
LEAST_VERSES, MOST_CHIPS, MOST_REFS, BIGRAM_BONUS = 4, 6, 50, 1.2


def is_sacred(stem: Column) -> Column:
    out = F.lit(False)
    for p in SACRED:
        out = out | stem.startswith(p)
    return out


def term_rows(verses: DataFrame, keys: list[str], stop: tuple[str, ...] = (), stems: DataFrame | None = None) -> DataFrame:
    """(keys, kind, place, term, surface): words and neighbouring pairs of every verse.

    stems: (surface, stem) of distinct words; without it a word is its own stem, and words and pairs come out of
    each verse's own array, without a shuffle.
    """
    if stems is None:
        kept = verses.select(*keys, F.filter(stop_word_tokens(F.col("text"), stop), lambda w: ~is_sacred(w)).alias("ws"))
        told = kept.select(*keys, F.inline(F.array(*(F.struct(F.lit(k).alias("kind"), c.alias("terms")) for k, c in ((1, F.col("ws")), (2, bigrams(F.col("ws"))))))))
        return told.select(*keys, "kind", F.posexplode("terms").alias("place", "term")).withColumn("surface", F.col("term"))
    words = verses.select(*keys, F.posexplode(F.filter(stop_word_tokens(F.col("text"), stop), lambda w: ~is_sacred(w))).alias("place", "surface"))
    told = words.join(stems, "surface", "left").withColumn("term", F.coalesce("stem", "surface"))
    w = Window.partitionBy(*keys).orderBy("place")
    pair = told.withColumns({"__t": F.lead("term").over(w), "__s": F.lead("surface").over(w)}).where("__t is not null")
    one = told.select(*keys, F.lit(1).alias("kind"), "place", "term", "surface")
    return one.unionByName(pair.select(*keys, F.lit(2).alias("kind"), "place", F.concat_ws(" ", "term", "__t").alias("term"), F.concat_ws(" ", "surface", "__s").alias("surface")))


def least_verses(n: Column, kind: Column) -> Column:
    """How many verses a term must be in: a quarter, a third or half of the id's; pairs three quarters of that."""
    cover = F.when(n >= 1000, 0.25).when(n >= 200, 0.35).otherwise(0.5)
    return F.greatest(F.lit(LEAST_VERSES), F.floor(n * cover * F.when(kind == 2, 0.75).otherwise(1.0)))


def usage(terms: DataFrame, owners: DataFrame, keys: list[str]) -> DataFrame:
    """(st, kind, term, tf, df, score) of the terms that are in enough of an id's verses.

    terms: as of `term_rows`; owners: (st, keys), distinct. The score is the term's rate in the id's
    verses by its rate in the corpus, times log(1 + verses), and a bonus for pairs. Occurrences are
    summed by verse first, so what meets the owners is one row for each verse and term.
    """
    per = terms.groupBy(*keys, "kind", "term").agg(F.count("*").alias("k"))
    corpus = per.groupBy("kind", "term").agg(F.sum("k").alias("cf"))
    total = corpus.groupBy("kind").agg(F.sum("cf").alias("ct"))
    mine = owners.join(per, keys)
    verses = mine.select("st", *keys).distinct().groupBy("st").agg(F.count("*").alias("n"))
    local = mine.groupBy("st", "kind", "term").agg(F.sum("k").alias("tf"), F.count("*").alias("df"))
    sums = local.groupBy("st", "kind").agg(F.sum("tf").alias("lt"))
    told = local.join(verses, "st").where(F.col("df") >= least_verses(F.col("n"), F.col("kind"))).join(sums, ["st", "kind"]).join(corpus, ["kind", "term"]).join(F.broadcast(total), "kind")
    return told.select("st", "kind", "term", "tf", "df", _score().alias("score"))


def _score() -> Column:
    return (F.col("tf") / F.col("lt")) / (F.col("cf") / F.col("ct")) * F.log1p("df") * F.when(F.col("kind") == 2, BIGRAM_BONUS).otherwise(1.0)


#: Bits of a sketch, and of those in a long.
_SKETCH, _LONG = 1 << 16, 64


def sketch(words: DataFrame, column: str) -> DataFrame:
    """One row (sketch): a set of fixed size, as longs, that surely has all words of a column and few others while they are few."""
    at = F.pmod(F.xxhash64(column), F.lit(_SKETCH)).cast("int")
    longs = words.where(F.col(column).isNotNull()).select((at / _LONG).cast("int").alias("k"), F.call_function("shiftleft", F.lit(1).cast("long"), at % _LONG).alias("bit"))
    by = longs.groupBy("k").agg(F.bit_or("bit").alias("bits")).agg(F.map_from_entries(F.collect_list(F.struct("k", "bits"))).alias("by"))
    return by.select(F.transform(F.sequence(F.lit(0), F.lit(_SKETCH // _LONG - 1)), lambda k: F.coalesce(F.try_element_at("by", k), F.lit(0).cast("long"))).alias("sketch"))


def may_have(sketch: Column, word: Column) -> Column:
    at = F.pmod(F.xxhash64(word), F.lit(_SKETCH)).cast("int")
    return F.getbit(F.get(sketch, (at / _LONG).cast("int")), at % _LONG) == 1


def verse_usage(verses: DataFrame, owners: DataFrame, keys: list[str], stop: tuple[str, ...] = ()) -> DataFrame:
    """As `usage` of `term_rows` without stems, for corpora whose words and pairs are too many to be dealt out by verse.

    Each verse's words meet its ids once, as one line, and are counted by id from there. A pair is in no more verses
    than its words are: only pairs of two words that are in enough of some id's verses are counted, as a sketch tells.
    """
    ws = F.filter(stop_word_tokens(F.col("text"), stop), lambda w: ~is_sacred(w))
    lines = verses.select(*keys, F.array_join(ws, " ").alias("line")).where("line <> ''")
    nameless = functools.reduce(lambda x, y: x | y, (F.col(k).isNull() for k in keys))  # of no id; not gathered in one row
    lines = lines.withColumn("__apart", F.when(nameless, F.xxhash64("line")).otherwise(0))
    own = owners.where("st is not null").groupBy(*keys).agg(F.collect_set("st").alias("sts")).withColumn("__apart", F.lit(0).cast("long"))
    ids = own.schema["sts"].dataType
    rows = lines.groupBy(*keys, "__apart").agg(F.array_join(F.collect_list("line"), " \n ").alias("line"))  # rows of a key are one verse, pairs don't cross them
    rows = rows.join(own, [*keys, "__apart"], "left").select("line", F.concat(F.coalesce("sts", F.array().cast(ids)), F.array(F.lit(None).cast(ids.elementType))).alias("sts"))  # the null id is the corpus
    parts = F.split("line", " ")
    words = F.filter(parts, lambda w: w != "\n")

    def counted(rows: DataFrame, terms: Column, *more: Column) -> DataFrame:
        """(st, term, tf, df). What is asked of it isn't pushed below the sums, so that all use one exchange."""
        item = lambda term, tf, df: F.struct(term.alias("term"), tf.cast("long").alias("tf"), F.lit(df).alias("df"))
        each = F.concat(F.transform(terms, lambda x: item(x, F.lit(1), 0)), F.transform(F.array_distinct(terms), lambda x: item(x, F.lit(0), 1)), *([F.array(*(item(F.lit(t), n, 1) for t, n in more))] if more else []))
        told = rows.select("sts", F.inline(each)).select(F.explode("sts").alias("st"), "term", "tf", "df").groupBy("st", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
        return told.withColumn("i", F.monotonically_increasing_id()).where("i >= 0 and df >= 0 and tf >= 0")

    n_words = F.size(words)
    n_lines = F.size(parts) - n_words + 1
    one = counted(rows, words, ("\n1", n_words), ("\n2", n_words - n_lines))  # the totals beside the words
    of = lambda k, c: F.max(F.when(F.col("term") == f"\n{k}", F.col(c)))
    sums = one.where(F.col("term").startswith("\n")).groupBy("st").agg(of(1, "df").alias("n"), of(1, "tf").alias("l1"), of(2, "tf").alias("l2"))
    one = one.where(~F.col("term").startswith("\n"))

    def local(told: DataFrame, kind: int) -> DataFrame:
        """Terms that are in as many of an id's verses as those of a kind must be."""
        return told.where("st is not null").join(F.broadcast(sums.select("st", "n", F.col(f"l{kind}").alias("lt"))), "st").where(F.col("df") >= least_verses(F.col("n"), F.lit(kind)))

    frequent = F.broadcast(sketch(local(one, 2).select("term").distinct(), "term"))
    met = rows.crossJoin(frequent)
    known = F.transform(parts, lambda w: F.when((w != "\n") & may_have(F.col("sketch"), w), w))
    pairs = F.zip_with(F.slice(known, 1, F.size(known) - 1), F.slice(known, 2, F.size(known)), lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.concat_ws(" ", a, b)))
    two = counted(met, F.array_compact(pairs))
    out = []
    for kind, told in ((1, one), (2, two)):
        cf = told.where("st is null")
        cf = (cf.crossJoin(frequent).where(may_have(F.col("sketch"), F.col("term"))) if kind == 1 else cf).select("term", F.col("tf").alias("cf"))
        ct = sums.where("st is null").select(F.col(f"l{kind}").alias("ct"))
        out.append(local(told, kind).withColumn("kind", F.lit(kind)).join(cf, "term").crossJoin(F.broadcast(ct)))
    return out[0].unionByName(out[1]).select("st", "kind", "term", "tf", "df", _score().alias("score"))


def surfaces(terms: DataFrame, owners: DataFrame, keys: list[str]) -> DataFrame:
    """(st, term, surface): each term's most frequent surface; ties go to the first in order."""
    n = owners.join(terms, keys).groupBy("st", "term", "surface").agg(F.count("*").alias("n"))
    return top_k(n, ["st", "term"], 1, [F.desc("n"), "surface"]).drop("n", "rank")


def chips(scored: DataFrame, most: int = MOST_CHIPS) -> DataFrame:
    """(st, rank, term): best terms first, none sharing a word with one before it."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "term")))
    terms = without_overlap(F.transform(ranked, lambda x: x["term"]), most)
    return scored.groupBy("st").agg(terms.alias("terms")).select("st", F.posexplode("terms").alias("rank", "term")).withColumn("rank", F.col("rank") + 1)


def plain_top(scored: DataFrame, most: int) -> DataFrame:
    """The best `most` terms of each id, overlapping or not; ties by the term, last first."""
    return top_k(scored, ["st"], most, [F.desc("score"), F.desc("term")])


def override(index: DataFrame, fixed: DataFrame, key: str = "st", value: str = "chips") -> DataFrame:
    """Given values over computed ones; an empty given value counts."""
    f = fixed.select(key, F.col(value).alias("__new"))
    return index.join(f, key, "full_outer").select(key, F.coalesce("__new", value).alias(value))


def occurs(tokens: Column, word: Column, more: int = 7) -> Column:
    """Whether a word (or neighbouring words) occurs among lower tokens: equal, or as their beginning with up to `more` characters after."""
    parts = F.split(turkish_lower(word), " ")
    fits = lambda t, p: (t == p) | (t.startswith(p) & F.length(t).between(F.length(p) + 1, F.length(p) + more))
    starts = F.when(F.size(tokens) >= F.size(parts), F.sequence(F.lit(1), F.size(tokens) - F.size(parts) + 1)).otherwise(F.array().cast("array<int>"))
    return F.exists(starts, lambda i: F.forall(F.zip_with(F.slice(tokens, i, F.size(parts)), parts, fits), lambda x: x))


def verse_index(words: DataFrame, owners: DataFrame, verses: DataFrame, keys: list[str], most: int = MOST_REFS) -> DataFrame:
    """(st, word, rank, keys): the first verses of an id in which each of its words occurs. words: (st, word).

    A verse's tokens give their beginnings that are as long as the first part of some word. Those that a sketch of the
    distinct first parts has are exploded, with as many tokens after them as words have parts, and meet the first
    parts in an equi-join, so what is shuffled is little more than what occurs.
    """
    told = words.where("word is not null").select("st", "word").distinct().withColumn("parts", F.split(turkish_lower(F.col("word")), " "))
    heads = told.select(F.col("parts")[0].alias("head"), "word", "parts").distinct()
    lengths = [tuple(r) for r in heads.select(F.length("head").alias("n"), F.size("parts").alias("m")).distinct().collect()]  # a row a length and number of parts
    if not lengths:
        return owners.join(told.select("st", "word"), "st").where("false").select("st", "word", *keys, F.lit(0).alias("rank"))
    more = max(m for _, m in lengths) - 1
    tokens = F.transform(inner_apostrophe_tokens(F.col("text")), turkish_lower)
    rows = verses.select(*keys, (tokens if more else F.array_distinct(tokens)).alias("tokens"))
    begun = lambda t: F.filter(F.array(*map(F.lit, sorted({n for n, _ in lengths}))), lambda n: F.length(t).between(n, n + 7))
    after = lambda i: F.slice("tokens", i + 2, F.lit(more)) if more else F.array().cast("array<string>")
    starts = F.flatten(F.transform("tokens", lambda t, i: F.transform(begun(t), lambda n: F.struct(F.substring(t, F.lit(1), n).alias("head"), after(i).alias("rest")))))
    rows = rows.select(*keys, starts.alias("starts")).crossJoin(F.broadcast(sketch(heads, "head")))
    met = rows.select(*keys, F.inline(F.array_distinct(F.filter("starts", lambda x: may_have(F.col("sketch"), x["head"]))))).join(heads, "head")
    fits = lambda t, p: (t == p) | (t.startswith(p) & F.length(t).between(F.length(p) + 1, F.length(p) + 7))
    rest = F.zip_with(F.slice("rest", F.lit(1), F.size("parts") - 1), F.slice("parts", F.lit(2), F.size("parts")), lambda t, p: t.isNotNull() & fits(t, p))
    found = met.where((F.size("parts") == 1) | F.forall(rest, lambda x: F.coalesce(x, F.lit(False)))).select(*keys, "word").distinct()
    return top_k(found.join(owners, keys).join(told.select("st", "word"), ["st", "word"]), ["st", "word"], most, list(keys))


def inverted(owners: DataFrame, keys: list[str], page: Column | None = None) -> DataFrame:
    """(st, page, refs): an id's verses in order, a row for each value of `page`, which bounds it (by default the first key)."""
    rows = owners.withColumn("page", F.col(keys[0]) if page is None else page)
    return rows.groupBy("st", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct(*keys))), lambda x: F.concat_ws(".", *(x[k] for k in keys))).alias("refs"))


def phrases_in(texts: DataFrame, phrases: DataFrame, key: str, name: str, head: int = 4) -> DataFrame:
    """(name, key) of phrases that a text contains as whole words. texts: (key, text); phrases: (name, text).

    White space is one space. A text's windows of up to `head` words (as long as the heads of phrases are) meet the
    phrases' first words in an equi-join, and what meets is tested in whole. Phrases without words match nothing.
    """
    flat = lambda c: F.concat(F.lit(" "), F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(" "))
    p = phrases.select(name, flat("text").alias("phrase")).where(F.trim("phrase") != "").withColumn("head", F.array_join(F.slice(python_split(F.col("phrase")), 1, head), " "))
    lengths = [r["n"] for r in p.select(F.size(F.split("head", " ")).alias("n")).distinct().collect()]  # at most `head` rows
    t = texts.select(key, python_split(F.col("text")).alias("ws"))
    at = F.when(F.size("ws") > 0, F.sequence(F.lit(1), F.size("ws"))).otherwise(F.array().cast("array<int>"))

    def windows_of(n: int) -> Column:
        return F.transform(at, lambda i: F.when(i + n - 1 <= F.size("ws"), F.array_join(F.slice("ws", i, F.lit(n)), " ")))

    every = F.array_compact(F.flatten(F.array(*map(windows_of, lengths)))) if lengths else F.array().cast("array<string>")
    hit = t.select(key, F.explode(F.array_distinct(every)).alias("head")).join(p, "head").select(key, name, "phrase")
    body = texts.select(key, flat("text").alias("body"))
    return hit.join(body, key).where(F.contains("body", "phrase")).select(name, key)


def pair_counts(verses: DataFrame) -> DataFrame:
    """(term, n): neighbouring word pairs of all texts."""
    return verses.select(F.explode(bigrams(F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != ""))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
