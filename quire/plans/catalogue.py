"""The query catalogue over the driver's tables: every query with the SQL that gives the same rows.

Stand-ins for the corpus relations: a document's lines are verses (chapter: doc_id, verse: line), documents
2k and 2k+1 are two editions of chapter k, lineitem holds numbered sequences with duplicates and gaps,
events hold places on a line, conversations ordered turns, pages HTML, benchmark phrases, labels sparse notes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


from ..functions import cleaning
from ..functions import python as P
from ..functions import similarity as sim
from ..functions import strings as st
from ..operators import alignment, concordance, correction, lexicon, quality, vocab, windows
from ..sources import documents as docs
from ..sources import html

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Shared parts of the SQL.
VERSE = "verse AS (SELECT doc_id AS c, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS v, unnest(string_split(text, chr(10))) AS text FROM documents)"
EDITION = f"{VERSE}, edition AS (SELECT c % 2 AS t, c // 2 AS b, v, text FROM verse)"
WORDS = r"list_filter(regexp_extract_all({}, '[\p{{L}}\p{{N}}_‘’''\-]+', 0), lambda w: length(w) >= 2)"
LOWER = "lower(translate({}, 'İI', 'iı'))"
VOCAB = f"""w AS (SELECT unnest({WORDS.format('text')}) AS word FROM documents),
 vocab AS (SELECT word, CAST(sum(n) AS BIGINT) AS freq FROM (SELECT word, count(*) AS n FROM w GROUP BY 1 UNION ALL SELECT {LOWER.format('word')}, count(*) FROM w GROUP BY 1) GROUP BY 1)"""
LETTERS = st.LETTERS


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def lines(spark: SparkSession, d: str) -> DataFrame:
    return docs.lines(table(spark, d, "documents"))


def editions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Lines of even and of odd documents: (b, v, pos, text)."""
    told = lines(spark, d).select(F.pmod("c", F.lit(2)).alias("t"), F.floor(F.col("c") / 2).alias("b"), F.col("v").cast("int").alias("v"), F.col("v").cast("int").alias("pos"), "text")
    return told.where("t = 0").drop("t"), told.where("t = 1").drop("t")


def numbered(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as a corpus: b is the order, v the line number, pos a total order within it."""
    li = table(spark, d, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    return li.select(F.col("l_orderkey").alias("b"), F.col("l_linenumber").alias("v"), F.row_number().over(w).alias("pos"))


NUMBERED = "numbered AS (SELECT l_orderkey AS b, l_linenumber AS v, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate) AS INTEGER) AS pos FROM lineitem)"


@query("verse_unnest", f"WITH {VERSE} SELECT c, v, text FROM verse")
def verse_unnest(spark, d):
    return lines(spark, d)


@query("vocab_freq", f"WITH {VOCAB} SELECT word, freq FROM vocab")
def vocab_freq(spark, d):
    return vocab.vocabulary(table(spark, d, "documents"))


@query("char_counts", "SELECT source, CAST(greatest(sum(CASE WHEN text <> '' THEN length(text) + 1 ELSE 0 END) - 1, 0) AS BIGINT) AS total, " + ", ".join(f"CAST(sum(length(text) - length(replace(text, '{c}', ''))) AS BIGINT) AS n_{i}" for i, c in enumerate(vocab.CHARACTERS)) + " FROM documents GROUP BY 1")
def char_counts(spark, d):
    return vocab.character_counts(table(spark, d, "documents"), ["source"])


_RATES = ", ".join(f"round_even(n_{i} * 1000.0 / greatest(total, 1), 2) AS r{i}" for i in range(5))
_ISSUES = ", ".join(f"CASE WHEN r{i} < {lo} THEN 'LOW_{c}' WHEN r{i} > {hi} THEN 'HIGH_{c}' END" for i, (c, (lo, hi)) in enumerate(quality.DETECT.items()))


@query(
    "corruption_flags",
    "WITH counts AS (SELECT doc_id, CAST(sum(length(text)) AS DOUBLE) AS total, " + ", ".join(f"CAST(sum(length(text) - length(replace(text, '{c}', ''))) AS DOUBLE) AS n_{i}" for i, c in enumerate(quality.DETECT)) + f", bool_or(regexp_matches(text, '{quality.DIGIT_IN_WORD}')) AS dig, bool_or(trim(text) <> '') AS has FROM documents GROUP BY 1), "
    f"rates AS (SELECT doc_id, dig, has, {_RATES} FROM counts), "
    f"told AS (SELECT doc_id, CASE WHEN has THEN list_sort(list_filter([{_ISSUES}, CASE WHEN dig THEN 'DIGIT_IN_WORD' END], lambda x: x IS NOT NULL)) ELSE ['NO_TEXT'] END AS i FROM rates) "
    "SELECT doc_id, round(least(1.0, " + " + ".join(f"CASE WHEN list_contains(i, '{k}') THEN {w} ELSE 0 END" for k, w in quality.WEIGHTS.items()) + "), 3)::DOUBLE AS score, "
    "(" + " + ".join(f"CASE WHEN list_contains(i, '{k}') THEN {w} ELSE 0 END" for k, w in quality.WEIGHTS.items()) + f" >= {quality.CORRUPTED} OR (list_contains(i, 'LOW_ı') AND list_contains(i, 'HIGH_y')) OR (list_contains(i, 'LOW_ş') AND list_contains(i, 'HIGH_b'))) AS is_corrupted, array_to_string(i, ',') AS issues FROM told",
)
def corruption_flags(spark, d):
    return quality.corruption(table(spark, d, "documents"), ["doc_id"]).withColumn("issues", F.array_join("issues", ","))


@query("duplicate_numbers", f"WITH {NUMBERED} SELECT * FROM (SELECT b, v, pos, row_number() OVER (PARTITION BY b, v ORDER BY pos)::INTEGER AS occurrence FROM numbered) WHERE occurrence > 1")
def duplicate_numbers(spark, d):
    return windows.duplicates(numbered(spark, d), ["b"], "v", ["pos"])


@query("number_gaps", "WITH x AS (SELECT DISTINCT l_orderkey AS b, l_linenumber AS v FROM lineitem), y AS (SELECT b, v, lead(v) OVER (PARTITION BY b ORDER BY v) AS nxt FROM x) SELECT b, v AS after, array_to_string(range(v + 1, nxt), ',') AS missing FROM y WHERE nxt - v > 1")
def number_gaps(spark, d):
    return windows.gaps(numbered(spark, d), ["b"], "v").withColumn("missing", F.array_join(F.transform("missing", lambda x: x.cast("string")), ","))


@query("number_gaps_over_2", "WITH x AS (SELECT DISTINCT l_orderkey AS b, l_linenumber AS v FROM lineitem), y AS (SELECT b, v, lead(v) OVER (PARTITION BY b ORDER BY v) AS nxt FROM x) SELECT b, v AS after, CAST(nxt - v - 1 AS INTEGER) AS missing FROM y WHERE nxt - v > 2")
def number_gaps_over_2(spark, d):
    return windows.gaps(numbered(spark, d), ["b"], "v", 2).withColumn("missing", F.size("missing"))


@query("missing_over_3", "SELECT l_orderkey AS b, CAST(max(l_linenumber) - min(l_linenumber) + 1 - count(DISTINCT l_linenumber) AS BIGINT) AS missing FROM lineitem GROUP BY 1 HAVING max(l_linenumber) - min(l_linenumber) + 1 - count(DISTINCT l_linenumber) > 3")
def missing_over_3(spark, d):
    return windows.missing_total(numbered(spark, d), ["b"], "v")


@query("out_of_order", f"WITH {NUMBERED}, x AS (SELECT b, v, pos, lag(v) OVER (PARTITION BY b ORDER BY pos) AS previous FROM numbered) SELECT * FROM x WHERE previous >= v")
def out_of_order(spark, d):
    return windows.out_of_order(numbered(spark, d), ["b"], "v", ["pos"])


@query("missing_parents", "SELECT c_custkey AS k, 'no orders' AS what FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) UNION ALL SELECT o_orderkey, 'no customer' FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)")
def missing_parents(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    one = c.join(o, c.c_custkey == o.o_custkey, "left_anti").select(F.col("c_custkey").alias("k"), F.lit("no orders").alias("what"))
    return one.union(o.join(c, c.c_custkey == o.o_custkey, "left_anti").select("o_orderkey", F.lit("no customer")))


@query("labelled_docs", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def labelled_docs(spark, d):
    return lexicon.only(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@query("unlabelled_docs", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unlabelled_docs(spark, d):
    return lexicon.todo(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@query("coverage_by_source", "SELECT source, count(*) AS docs, count(l.doc_id) AS present, CAST(1000 * count(l.doc_id) // count(*) AS BIGINT) AS permille, CASE WHEN bool_or(l.quality = 1) AND NOT bool_or(l.quality = 0) THEN 'good only' WHEN bool_or(l.quality = 0) AND NOT bool_or(l.quality = 1) THEN 'bad only' ELSE 'both' END AS scope FROM documents LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def coverage_by_source(spark, d):
    told = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").withColumn("there", F.lit(1)), "doc_id", "left")
    good, bad = F.max(F.col("quality") == 1), F.max(F.col("quality") == 0)
    scope = F.when(good & ~bad, "good only").when(bad & ~good, "bad only").otherwise("both")
    return told.groupBy("source").agg(F.count("*").alias("docs"), F.count("there").alias("present"), F.floor(1000 * F.count("there") / F.count("*")).alias("permille"), scope.alias("scope"))


def _places(spark, d, kind: str, others: bool = False) -> DataFrame:
    e = table(spark, d, "events")
    return e.where((F.col("event_type") != kind) if others else (F.col("event_type") == kind)).select("user_id", "event_id")


@query("asof_owner", "SELECT t.user_id, t.event_id, s.event_id AS owner_event_id FROM (SELECT user_id, event_id FROM events WHERE event_type <> 'view') t ASOF LEFT JOIN (SELECT user_id, event_id FROM events WHERE event_type = 'view') s ON t.user_id = s.user_id AND t.event_id >= s.event_id")
def asof_owner(spark, d):
    s = _places(spark, d, "view").withColumn("at", F.col("event_id"))
    return alignment.as_of(s, _places(spark, d, "view", True).withColumn("at", F.col("event_id")), ["user_id"], "at", ["event_id"]).drop("at")


@query("asof_owner_first", "SELECT t.user_id, t.event_id, coalesce(s.event_id, (SELECT min(f.event_id) FROM events f WHERE f.event_type = 'view' AND f.user_id = t.user_id)) AS owner_event_id FROM (SELECT user_id, event_id FROM events WHERE event_type <> 'view') t ASOF LEFT JOIN (SELECT user_id, event_id FROM events WHERE event_type = 'view') s ON t.user_id = s.user_id AND t.event_id >= s.event_id")
def asof_owner_first(spark, d):
    s = _places(spark, d, "view").withColumn("at", F.col("event_id"))
    return alignment.as_of(s, _places(spark, d, "view", True).withColumn("at", F.col("event_id")), ["user_id"], "at", ["event_id"], "first").drop("at")


@query("interval_owner", "WITH s AS (SELECT user_id, event_id AS owner, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS until FROM events WHERE event_type = 'view') SELECT t.user_id, t.event_id AS target, s.owner FROM events t JOIN s ON t.user_id = s.user_id AND s.owner <= t.event_id AND (s.until IS NULL OR t.event_id < s.until) WHERE t.event_type <> 'view'")
def interval_owner(spark, d):
    return alignment.interval_owner(_places(spark, d, "view"), _places(spark, d, "view", True), ["user_id"], "event_id")


@query("next_marker", "SELECT t.user_id, t.event_id, s.event_id AS next_event_id FROM (SELECT user_id, event_id FROM events WHERE event_type = 'error') t ASOF LEFT JOIN (SELECT user_id, event_id FROM events WHERE event_type = 'purchase') s ON t.user_id = s.user_id AND t.event_id <= s.event_id")
def next_marker(spark, d):
    at = lambda k: _places(spark, d, k).withColumn("at", F.col("event_id"))
    return alignment.forward(at("purchase"), at("error"), ["user_id"], "at", ["event_id"]).select("user_id", "event_id", F.col("owner_event_id").alias("next_event_id"))


_WC = r"len(regexp_extract_all({}, '\S+'))"


@query("length_vs_upper_median", f"WITH n AS (SELECT doc_id, lang, {_WC.format('text')} AS n FROM documents), m AS (SELECT lang, percentile_disc(0.5) WITHIN GROUP (ORDER BY n DESC) AS m FROM n WHERE n > 0 GROUP BY 1) SELECT doc_id, CASE WHEN n < 0.35 * m THEN 'TOO_SHORT' ELSE 'TOO_LONG' END AS reason FROM n JOIN m USING (lang) WHERE m >= 3 AND (n < 0.35 * m OR n > 3.5 * m)")
def length_vs_upper_median(spark, d):
    told = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("t"), F.col("lang").alias("b"), F.lit(1).alias("c"), F.lit(1).alias("v"), "text")
    f = quality.length_by_median(told, told.drop("t"))
    return f.select(F.col("t").cast("bigint").alias("doc_id"), F.when(F.col("reason") == "VERSE_TOO_SHORT_VS_REFS", "TOO_SHORT").otherwise("TOO_LONG").alias("reason"))


@query("length_vs_mean", f"WITH {EDITION}, r AS (SELECT b, v, length(text) AS n FROM edition WHERE t = 1) SELECT b, e.v, CASE WHEN length(e.text) < 0.5 * n THEN 'SHORT' ELSE 'LONG' END AS reason FROM edition e JOIN r USING (b, v) WHERE t = 0 AND e.text <> '' AND n >= 20 AND (length(e.text) < 0.5 * n OR length(e.text) > 2 * n)")
def length_vs_mean(spark, d):
    a, b = editions(spark, d)
    key = lambda x: x.select(F.lit("0").alias("t"), F.lit("x").alias("b"), F.col("b").alias("c"), "v", "text")
    f = quality.length_by_mean(key(a).withColumn("c", F.col("c").cast("int")), key(b).withColumn("c", F.col("c").cast("int")), 0.5, 2.0, 20)
    return f.select(F.col("c").cast("bigint").alias("b"), "v", F.when(F.col("reason") == "EXTREMELY_SHORT", "SHORT").otherwise("LONG").alias("reason"))


_NORM = r"trim(substr(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), 1, 200))"
_SET = f"list_distinct(list_filter(regexp_split_to_array({_NORM.format('text')}, '\\s+'), lambda w: w <> ''))"


@query(
    "best_line_by_jaccard",
    f"WITH {EDITION}, s AS (SELECT t, b, v, {_SET} AS ws FROM edition), j AS (SELECT x.b, x.v, y.v AS rv, len(list_intersect(x.ws, y.ws)) AS i, len(x.ws) + len(y.ws) - len(list_intersect(x.ws, y.ws)) AS u FROM s x JOIN s y ON x.b = y.b AND x.t = 0 AND y.t = 1 AND y.v BETWEEN x.v AND x.v + 14 WHERE len(x.ws) > 0 AND len(y.ws) > 0), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY b, v ORDER BY i::DOUBLE / u DESC, rv) AS k FROM j) SELECT b, v, rv, CAST(i AS INTEGER) AS common FROM r WHERE k = 1",
)
def best_line_by_jaccard(spark, d):
    return alignment.best_by_jaccard(*editions(spark, d), ["b"])


_TERMS = (
    r"tok AS (SELECT doc_id, source, list_filter(list_transform(list_filter(regexp_split_to_array(lower(translate(text, 'İI', 'iı')), '\s+'), lambda w: w <> ''), "
    r"lambda w: regexp_replace(CASE WHEN strpos(w, '''') > 1 THEN split_part(w, '''', 1) WHEN strpos(w, '’') > 1 THEN split_part(w, '’', 1) WHEN strpos(w, '‘') > 1 THEN split_part(w, '‘', 1) ELSE w END, '[^\p{L}\p{N}_\-]', '', 'g')), "
    r"lambda w: length(w) >= 3 AND NOT regexp_matches(w, '^\p{N}+$')) AS ts FROM documents), "
    "pos AS (SELECT doc_id, source, unnest(ts) AS term, unnest(range(1, len(ts) + 1)) AS place FROM tok), "
    "kept AS (SELECT * FROM pos WHERE NOT (" + " OR ".join(f"starts_with(term, '{p}')" for p in concordance.SACRED) + ")), "
    "term AS (SELECT doc_id, source, 1 AS kind, term FROM kept UNION ALL SELECT doc_id, source, 2, term || ' ' || nxt FROM (SELECT *, lead(term) OVER (PARTITION BY doc_id ORDER BY place) AS nxt FROM kept) WHERE nxt IS NOT NULL), "
    "per AS (SELECT doc_id, source, kind, term, count(*) AS k FROM term GROUP BY ALL), n AS (SELECT source, count(DISTINCT doc_id) AS n FROM term GROUP BY 1), "
    "loc AS (SELECT source AS st, kind, term, CAST(sum(k) AS BIGINT) AS tf, count(*) AS df FROM per GROUP BY ALL)"
)
_USAGE = f"WITH {_TERMS}, cor AS (SELECT kind, term, sum(k) AS cf FROM per GROUP BY ALL), tot AS (SELECT kind, sum(cf) AS ct FROM cor GROUP BY 1), lt AS (SELECT st, kind, sum(tf) AS lt FROM loc GROUP BY ALL) SELECT st, kind, term, tf, df, round((tf / lt) / (cf / ct) * ln(1 + df) * CASE WHEN kind = 2 THEN 1.2 ELSE 1.0 END, 6)::DOUBLE AS score FROM loc JOIN n ON n.source = loc.st JOIN lt USING (st, kind) JOIN cor USING (kind, term) JOIN tot USING (kind) WHERE df >= greatest(4, floor(n * CASE WHEN n >= 1000 THEN 0.25 WHEN n >= 200 THEN 0.35 ELSE 0.5 END * CASE WHEN kind = 2 THEN 0.75 ELSE 1.0 END))"


def _usage(spark, d) -> DataFrame:
    t = table(spark, d, "documents")
    owners = t.select(F.col("source").alias("st"), "doc_id").distinct()
    return concordance.verse_usage(t, owners, ["doc_id"]).withColumn("score", F.round("score", 6))


@query("usage_terms", _USAGE)
def usage_terms(spark, d):
    return _usage(spark, d)


@query("usage_topk", f"SELECT st, term, df, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY st ORDER BY score DESC, term DESC) AS r FROM ({_USAGE})) WHERE r <= 8")
def usage_topk(spark, d):
    return concordance.plain_top(_usage(spark, d), 8).select("st", "term", "df", "rank")


#: Chosen chips are a text between bars; a chip comes in while there are fewer than six and none has a word of it.
_CHOOSE = (
    "list_reduce(list(term ORDER BY score DESC, term), lambda a, x: CASE WHEN len(string_split(a, '|')) <= " + str(concordance.MOST_CHIPS) + " AND len(list_intersect(string_split(replace(a, '|', ' '), ' '), string_split(x, ' '))) = 0 THEN a || '|' || x ELSE a END, '')"
)


@query("usage_chips", f"WITH chosen AS (SELECT st, list_filter(string_split({_CHOOSE}, '|'), lambda x: x <> '') AS ts FROM ({_USAGE}) GROUP BY 1) SELECT st, CAST(unnest(range(1, len(ts) + 1)) AS INTEGER) AS rank, unnest(ts) AS term FROM chosen")
def usage_chips(spark, d):
    return concordance.chips(_usage(spark, d))


@query("bigrams", r"WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '') AS ws FROM documents), p AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM t), b AS (SELECT w || ' ' || lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS term FROM p) SELECT term, count(*) AS n FROM b WHERE term IS NOT NULL GROUP BY 1")
def bigrams(spark, d):
    return concordance.pair_counts(table(spark, d, "documents"))


@query("phrase_containment", "SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(' ' || trim(regexp_replace(d.text, '\\s+', ' ', 'g')) || ' ', ' ' || trim(regexp_replace(b.text, '\\s+', ' ', 'g')) || ' ') WHERE regexp_matches(b.text, '\\S')")
def phrase_containment(spark, d):
    return concordance.phrases_in(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "benchmark"), "doc_id", "item_id")


@query("short_phrases", "SELECT b.item_id, d.doc_id FROM (SELECT item_id, array_to_string(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')[1:1 + item_id % 3], ' ') AS phrase FROM benchmark) b JOIN (SELECT doc_id, ' ' || trim(regexp_replace(text, '\\s+', ' ', 'g')) || ' ' AS body FROM documents) d ON contains(body, ' ' || phrase || ' ') WHERE phrase <> ''")
def short_phrases(spark, d):
    """Phrases of one to three words."""
    p = table(spark, d, "benchmark").select("item_id", F.array_join(F.slice(st.python_split(F.col("text")), F.lit(1), (1 + F.col("item_id") % 3).cast("int")), " ").alias("text"))
    return concordance.phrases_in(table(spark, d, "documents").select("doc_id", "text"), p, "doc_id", "item_id")


_ENDS = "[.!?»\"“”''‘’)\\]…›,;:]+\\s*$"


@query(
    "fragment_merge",
    f"WITH {VERSE}, f AS (SELECT c, v, text, coalesce(lag(regexp_matches(text, '{_ENDS}')) OVER (PARTITION BY c ORDER BY v), true) AS starts FROM verse), i AS (SELECT *, sum(starts::INTEGER) OVER (PARTITION BY c ORDER BY v ROWS UNBOUNDED PRECEDING) AS island FROM f) "
    "SELECT c, min(v) AS v, CAST(count(*) AS INTEGER) AS merged, CASE WHEN count(*) = 1 THEN min(text) ELSE string_agg(trim(text), ' ' ORDER BY v) END AS text FROM i GROUP BY c, island",
)
def fragment_merge(spark, d):
    return alignment.merge_fragments(lines(spark, d).withColumn("pos", F.col("v")), ["c"]).select("c", "v", "merged", "text")


@query("monotone_clamp", f"WITH {NUMBERED} SELECT b, v, pos, CAST(pos + max(v - pos) OVER (PARTITION BY b ORDER BY pos ROWS UNBOUNDED PRECEDING) AS INTEGER) AS clamped FROM numbered")
def monotone_clamp(spark, d):
    return windows.clamp(numbered(spark, d), ["b"], "v", ["pos"])


@query("score_histogram", f"WITH s AS (SELECT least(100, {_WC.format('text')}) AS score FROM documents), b(bucket) AS (VALUES ('100'), ('90-99'), ('80-89'), ('70-79'), ('60-69'), ('<60')), g AS (SELECT CASE WHEN score = 100 THEN '100' WHEN score >= 90 THEN '90-99' WHEN score >= 80 THEN '80-89' WHEN score >= 70 THEN '70-79' WHEN score >= 60 THEN '60-69' ELSE '<60' END AS bucket, count(*) AS n FROM s GROUP BY 1) SELECT bucket, coalesce(n, 0) AS n FROM b LEFT JOIN g USING (bucket)")
def score_histogram(spark, d):
    return correction.histogram(table(spark, d, "documents").select(F.least(F.lit(100), st.word_count(F.col("text"))).alias("score")))


@query("weighted_mean", "SELECT l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 2) AS score FROM lineitem GROUP BY 1")
def weighted_mean(spark, d):
    li = table(spark, d, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("score"), F.col("l_quantity").alias("words"))
    return correction.book_scores(li, ["l_returnflag"])


_CHARS = (
    f"one AS (SELECT c, v, unnest(list_filter([CASE WHEN regexp_matches(text, '(?i)dipnot|footnot|\\bbkz\\b|grekçede|asıl metinde') THEN 'FOOTNOTE_LEAK' END, CASE WHEN regexp_matches(text, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F]') THEN 'CONTROL_CHAR' END, CASE WHEN {_WC.format('text')} BETWEEN 1 AND 4 THEN 'VERY_SHORT_VERSE' END, CASE WHEN length(text) > 500 THEN 'VERY_LONG_VERSE' END], lambda x: x IS NOT NULL)) AS reason FROM verse), "
    f"dig AS (SELECT c, v, unnest(regexp_extract_all(text, '[{LETTERS}]\\d|\\d[{LETTERS}]')) AS m FROM verse), quo AS (SELECT c, v, unnest(regexp_extract_all(text, '[{LETTERS}][\"“”„][{LETTERS}]')) AS m FROM verse), "
    "q AS (SELECT c, v, text, unnest(list_filter(range(1, length(text) + 1), lambda i: text[i] = '?')) AS i FROM verse WHERE contains(text, '?')), "
    "qq AS (SELECT c, v FROM q WHERE regexp_matches(substr(text, greatest(i - 1, 1)::INTEGER, 1), '\\p{L}') OR regexp_matches(trim(substr(text, (i + 1)::INTEGER, 3)), '^\\p{L}'))"
)
_ALLCHARS = f"WITH {VERSE}, {_CHARS} SELECT c, v, reason, CASE WHEN reason LIKE 'VERY%' THEN 'MEDIUM' ELSE 'HIGH' END AS severity FROM one UNION ALL SELECT c, v, 'DIGIT_IN_WORD', 'HIGH' FROM dig UNION ALL SELECT c, v, 'QUOTE_CHAR_MID_WORD', 'HIGH' FROM quo UNION ALL SELECT c, v, 'EMBEDDED_QUESTION_MARK', 'HIGH' FROM qq"


@query("character_findings", f"SELECT CAST(c AS INTEGER) AS c, CAST(v AS INTEGER) AS v, reason, severity FROM ({_ALLCHARS})")
def character_findings(spark, d):
    return quality.characters(lines(spark, d)).select("c", "v", "reason", "severity")


@query("findings_by_severity", f"SELECT severity, reason, count(*) AS n FROM ({_ALLCHARS}) GROUP BY 1, 2")
def findings_by_severity(spark, d):
    return quality.count_by(quality.characters(lines(spark, d)), "severity", "reason")


@query("totals_rollup", "SELECT source, lang, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(count_if(trim(text) = '') AS BIGINT) AS empty FROM documents GROUP BY ROLLUP (source, lang)")
def totals_rollup(spark, d):
    return table(spark, d, "documents").rollup("source", "lang").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"), F.count_if(F.trim("text") == "").alias("empty"))


def _clean_sql(x: str) -> str:
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    for name, c in st.ENTITIES.items():
        x = f"replace({x}, '{name}', '{c.replace(chr(39), chr(39) * 2)}')"
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


@query("html_fields", rf"SELECT page_id, nullif({_clean_sql(r'''regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)''')}, '') AS title, {_clean_sql(r'''regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g')''')} AS text FROM pages")
def html_fields(spark, d):
    return table(spark, d, "pages").select("page_id", html.title(F.col("html")).alias("title"), html.plain(F.col("html")).alias("text"))


@query("duplicate_text", "SELECT trim(text) AS text, count(*) AS n FROM documents WHERE trim(text) <> '' GROUP BY 1 HAVING count(*) > 1")
def duplicate_text(spark, d):
    return lexicon.repeated(table(spark, d, "documents").select("text"), "text")


@query("first_wins", f"WITH {NUMBERED}, r AS (SELECT *, row_number() OVER (PARTITION BY b, v ORDER BY pos) AS k FROM numbered) SELECT b, v, pos FROM r WHERE k = 1")
def first_wins(spark, d):
    return docs.first_wins(numbered(spark, d), ["b", "v"], ["pos"])


@query("last_wins", f"WITH {NUMBERED}, r AS (SELECT *, row_number() OVER (PARTITION BY b, v ORDER BY pos DESC) AS k FROM numbered) SELECT b, v, pos FROM r WHERE k = 1")
def last_wins(spark, d):
    return docs.last_wins(numbered(spark, d), ["b", "v"], ["pos"])


_ENG = ", ".join(f"'{w}'" for w in lexicon.ENGLISH)
_OTHER = "der die das und ist nicht ein eine zu den le la les et des en un une du que el los las y que de por".split()
_OTH = ", ".join(f"'{w}'" for w in _OTHER)
_LWORDS = r"regexp_extract_all(lower(text), '\p{L}+')"


@query("language_guess", f"SELECT doc_id, (len(list_filter({_LWORDS}, lambda w: w IN ({_ENG}))) > 3 * len(list_filter({_LWORDS}, lambda w: w IN ({_OTH}))) AND len(list_filter({_LWORDS}, lambda w: w IN ({_ENG}))) > 4) AS english FROM documents")
def language_guess(spark, d):
    return table(spark, d, "documents").select("doc_id", lexicon.is_english(F.col("text"), _OTHER).alias("english"))


_AWORDS = "regexp_extract_all(lower(text), '[a-z]{2,}')"


@query("english_ratio", f"SELECT doc_id, len({_AWORDS}) AS words, CASE WHEN len({_AWORDS}) < 2 THEN 0 ELSE CAST(round(1000 * (len(list_filter({_AWORDS}, lambda w: w IN ({_ENG})))::DOUBLE / len({_AWORDS}))) AS BIGINT) END AS permille FROM documents")
def english_ratio(spark, d):
    words = F.regexp_count(F.lower("text"), F.lit("[a-z]{2,}"))
    return table(spark, d, "documents").select("doc_id", words.cast("bigint").alias("words"), F.round(1000 * st.stop_ratio(F.col("text"), lexicon.ENGLISH)).cast("bigint").alias("permille"))


@query("upsert_merge", "SELECT coalesce(n.k, o.k) AS k, coalesce(n.x, o.x) AS x, o.y FROM (SELECT doc_id AS k, lang AS x, source AS y FROM documents) o FULL JOIN (SELECT item_id * 50 AS k, 'new' AS x FROM benchmark) n ON n.k = o.k")
def upsert_merge(spark, d):
    old = table(spark, d, "documents").select(F.col("doc_id").alias("k"), F.col("lang").alias("x"), F.col("source").alias("y"))
    return lexicon.upsert(old, table(spark, d, "benchmark").select((F.col("item_id") * 50).alias("k"), F.lit("new").alias("x")), ["k"])


@query("field_merge", "SELECT doc_id AS key, source, coalesce(CAST(quality AS VARCHAR), '') AS quality, coalesce(CAST(toxic AS VARCHAR), '') AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def field_merge(spark, d):
    lab = table(spark, d, "labels")
    maps = {c: lab.select(F.col("doc_id").alias("key"), F.col(c).cast("string").alias("value")) for c in ("quality", "toxic")}
    return lexicon.merge(table(spark, d, "documents").select(F.col("doc_id").alias("key"), "source"), maps)


@query("union_last", "SELECT coalesce(b.k, a.k) AS k, coalesce(b.x, a.x) AS x FROM (SELECT c_custkey AS k, c_name AS x FROM customer) a FULL JOIN (SELECT s_suppkey AS k, s_name AS x FROM supplier) b ON a.k = b.k")
def union_last(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("x"))
    return lexicon.union_last([a, table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("x"))], ["k"])


@query("set_ops", "SELECT 'both' AS op, k FROM (SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'left', k FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'right', k FROM (SELECT s_nationkey AS k FROM supplier EXCEPT SELECT c_nationkey FROM customer) UNION ALL SELECT 'any', k FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)")
def set_ops(spark, d):
    a, b = table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    named = lambda n, x: x.select(F.lit(n).alias("op"), "k")
    return named("both", a.intersect(b)).union(named("left", a.exceptAll(b).distinct().join(b, "k", "left_anti"))).union(named("right", b.join(a, "k", "left_anti").distinct())).union(named("any", a.union(b).distinct()))


@query("interpolate", "WITH e AS (SELECT user_id, event_id, CASE WHEN event_type IN ('view', 'click') THEN value END AS x FROM events), w AS (SELECT *, last_value(x IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN x IS NOT NULL THEN event_id END IGNORE NULLS) OVER b AS p0, first_value(x IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN x IS NOT NULL THEN event_id END IGNORE NULLS) OVER a AS p1 FROM e WINDOW b AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) SELECT user_id, event_id, CAST(floor(1000 * coalesce(x, v0 + (v1 - v0) * (event_id - p0) / nullif(p1 - p0, 0), v0, v1) + 0.0001) AS BIGINT) AS filled FROM w")
def interpolate(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type").isin("view", "click"), F.col("value")).alias("x"))
    return windows.interpolate(e, ["user_id"], "event_id", "x").select("user_id", "event_id", F.floor(1000 * F.col("filled") + 0.0001).alias("filled"))


@query("carry_forward", "SELECT user_id, event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state FROM events")
def carry_forward(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") == "signup", F.col("event_id")).alias("state"))
    return windows.carry_forward(e, ["user_id"], ["state"], ["event_id"])


_TOK = f"tokens AS (SELECT doc_id, unnest(regexp_extract_all(text, '[{LETTERS}''‘’]{{3,}}')) AS word FROM documents)"
_PAIRS = " UNION ALL ".join(f"SELECT word, core, {k} AS pair, i, substr(core, 1, i - 1) || '{n}' || substr(core, i + 1) AS candidate FROM (SELECT word, core, CAST(unnest(range(1, length(core) + 1)) AS INTEGER) AS i FROM cores) WHERE substr(core, i, 1) = '{o}'" for k, (o, n) in enumerate(quality.PAIRS))
_GF = "coalesce((SELECT freq FROM vocab WHERE vocab.word = {0}), 0) + coalesce((SELECT freq FROM vocab WHERE vocab.word = lower(translate({0}, 'İI', 'iı'))), 0)"


@query(
    "best_substitution",
    f"WITH {VOCAB}, {_TOK}, cores AS (SELECT DISTINCT word, regexp_extract(word, '^([^{LETTERS}]*)([{LETTERS}''‘’]*)', 2) AS core FROM tokens), subs AS ({_PAIRS}), "
    "told AS (SELECT s.*, coalesce(a.freq, 0) + coalesce(b.freq, 0) AS o, coalesce(x.freq, 0) + coalesce(y.freq, 0) AS f FROM subs s LEFT JOIN vocab a ON a.word = core LEFT JOIN vocab b ON b.word = lower(translate(core, 'İI', 'iı')) LEFT JOIN vocab x ON x.word = candidate LEFT JOIN vocab y ON y.word = lower(translate(candidate, 'İI', 'iı'))), "
    "good AS (SELECT * FROM told WHERE o < 200 AND f >= 20 AND ((o = 0 AND f >= 50) OR (o > 0 AND f / (o + 1) >= 20))), best AS (SELECT word, pair, arg_min(candidate, i) AS candidate FROM good GROUP BY 1, 2) SELECT doc_id, word || ' > ' || candidate AS detail FROM tokens JOIN best USING (word)",
)
def best_substitution(spark, d):
    t = table(spark, d, "documents")
    v = t.select(F.lit(None).cast("string").alias("t"), F.lit(None).cast("string").alias("b"), F.col("doc_id").alias("c"), F.lit(1).alias("v"), "text")
    return quality.uncorrected(v, vocab.vocabulary(t)).select(F.col("c").cast("bigint").alias("doc_id"), "detail")


@query("corrected_tokens")
def corrected_tokens(spark, d):
    t = table(spark, d, "documents")
    return correction.correct_tokens(vocab.words(t).distinct(), vocab.vocabulary(t))


@query("corrected_documents")
def corrected_documents(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text")
    return correction.correct_verses(t, vocab.vocabulary(t), ["doc_id"])[0]


@query("document_scores")
def document_scores(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text")
    return correction.verse_scores(t, correction.correct_verses(t, vocab.vocabulary(t), ["doc_id"])[1], ["doc_id"])


_ARTIFACTS_SQL = "text"
for _pattern, _new, _name in correction.ARTIFACTS:  # RE2 has no lookahead: what follows is put back
    _p = _pattern.replace("(?=", "(").replace("'", "''")
    _ARTIFACTS_SQL = f"regexp_replace({_ARTIFACTS_SQL}, '{_p}', '{_new}{chr(92) + '1' if '(?=' in _pattern else ''}', 'g')"
    if _name == "FOOTNOTE_STRIPPED":
        _ARTIFACTS_SQL = f"rtrim({_ARTIFACTS_SQL})"


@query("artifacts", f"SELECT doc_id, trim({_ARTIFACTS_SQL}) AS text FROM documents")
def artifacts(spark, d):
    return table(spark, d, "documents").select("doc_id", correction.clean_artifacts(F.col("text"))["text"].alias("text"))


_FOLD = (("the", "THE"), ("and", "&"), ("  ", " "))


@query("patch_fold", "SELECT doc_id, " + "replace(" * 3 + "text" + "".join(f", '{a}', '{b}')" for a, b in _FOLD) + " AS text FROM documents")
def patch_fold(spark, d):
    return table(spark, d, "documents").select("doc_id", st.fold_replaces(F.col("text"), _FOLD).alias("text"))


@query("patch_join", "SELECT doc_id, replace(d.text, substr(b.text, 1, 12), '<' || item_id || '>') AS text FROM documents d JOIN benchmark b ON b.item_id = d.doc_id UNION ALL SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT item_id FROM benchmark)")
def patch_join(spark, d):
    b = table(spark, d, "benchmark")
    p = b.select(F.col("item_id").alias("doc_id"), F.lit(1).alias("n"), F.substring("text", 1, 12).alias("old"), F.concat(F.lit("<"), "item_id", F.lit(">")).alias("new"))
    return correction.apply_patches(table(spark, d, "documents").select("doc_id", "text"), p, ["doc_id"])


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("turn_sequence", "WITH x AS (SELECT conv_id, turn, role, lag(role) OVER w AS previous_role, turn - lag(turn) OVER w AS step FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn, CASE WHEN step > 1 THEN 'GAP' WHEN step = 0 THEN 'DUPLICATE' ELSE 'SAME_ROLE' END AS reason FROM x WHERE step > 1 OR step = 0 OR previous_role = role")
def turn_sequence(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    x = table(spark, d, "conversations").select("conv_id", "turn", "role", F.lag("role").over(w).alias("p"), (F.col("turn") - F.lag("turn").over(w)).alias("step"))
    return x.where("step > 1 or step = 0 or p = role").select("conv_id", "turn", F.expr("CASE WHEN step > 1 THEN 'GAP' WHEN step = 0 THEN 'DUPLICATE' ELSE 'SAME_ROLE' END").alias("reason"))


@query("tokenise", rf"SELECT doc_id, unnest(range(1, len(t) + 1)) AS place, unnest(t) AS token FROM (SELECT doc_id, regexp_extract_all(text, '[\p{{L}}\p{{N}}_‘’''\-]+|[^\p{{L}}\p{{N}}_‘’''\-]+') AS t FROM documents)")
def tokenise(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(st.tokenise(F.col("text"))).alias("place", "token")).withColumn("place", F.col("place") + 1)


_ROOTS = "|".join(st.ROOT_SUFFIXES)


@query("word_roots", f"WITH w AS (SELECT DISTINCT unnest({WORDS.format('text')}) AS word FROM documents), l AS (SELECT word, {LOWER.format('word')} AS w FROM w) SELECT word, CASE WHEN regexp_extract(w, '^(.{{3,}}?)(?:{_ROOTS})$', 1) <> '' THEN regexp_extract(w, '^(.{{3,}}?)(?:{_ROOTS})$', 1) ELSE substr(w, 1, greatest(4, length(w) - 2)) END AS root FROM l")
def word_roots(spark, d):
    return vocab.words(table(spark, d, "documents")).distinct().select("word", st.extract_root(F.col("word")).alias("root"))


@query("token_parts", f"WITH w AS (SELECT DISTINCT unnest({WORDS.format('text')}) AS word FROM documents) SELECT word, regexp_extract(word, '(?s)^([^{LETTERS}]*)([{LETTERS}''‘’]*)(.*)$', 1) AS prefix, regexp_extract(word, '(?s)^([^{LETTERS}]*)([{LETTERS}''‘’]*)(.*)$', 2) AS core, regexp_extract(word, '(?s)^([^{LETTERS}]*)([{LETTERS}''‘’]*)(.*)$', 3) AS suffix FROM w")
def token_parts(spark, d):
    return vocab.words(table(spark, d, "documents")).distinct().select("word", st.split_token(F.col("word")).alias("p")).select("word", "p.*")


@query("comma_lists", rf"WITH {VERSE} SELECT c, v, array_to_string(list_transform(string_split(text, ','), lambda p: trim(regexp_replace(trim(p), '^X\s+', ''))), ', ') AS text FROM verse")
def comma_lists(spark, d):
    return lines(spark, d).select("c", "v", st.clean_x(F.col("text")).alias("text"))


_BARE = r"lower(regexp_replace(regexp_replace(regexp_replace(trim({}), '^\d+\.\s*', ''), '\([^)]*\)\s*', '', 'g'), '[^\p{{L}}\p{{N}}_]', '', 'g'))"


@query(
    "dedupe_items",
    f"WITH {VERSE}, p AS (SELECT c, v, text, unnest(range(1, len(string_split(text, ',')) + 1)) AS i, trim(unnest(string_split(text, ','))) AS item FROM verse), b AS (SELECT *, {_BARE.format('item')} AS bare FROM p), k AS (SELECT *, row_number() OVER (PARTITION BY c, v, bare ORDER BY i) AS n FROM b) "
    "SELECT c, v, string_agg(item, ', ' ORDER BY i) AS text FROM k WHERE contains(text, ',') AND (bare = '' OR n = 1) GROUP BY c, v UNION ALL SELECT c, v, text FROM verse WHERE NOT contains(text, ',')",
)
def dedupe_items(spark, d):
    return lines(spark, d).select("c", "v", st.dedupe_items(F.col("text")).alias("text"))


@query("similarity_pairs", f"WITH {EDITION}, s AS (SELECT t, b, v, {_SET} AS ws FROM edition) SELECT x.b, x.v, CAST(round(1000000 * CASE WHEN len(x.ws) = 0 OR len(y.ws) = 0 THEN 0 ELSE len(list_intersect(x.ws, y.ws))::DOUBLE / (len(x.ws) + len(y.ws) - len(list_intersect(x.ws, y.ws))) END) AS BIGINT) AS jaccard, CAST(round(1000000 * CASE WHEN len(x.ws) = 0 OR len(y.ws) = 0 THEN 0 ELSE len(list_intersect(x.ws, y.ws))::DOUBLE / greatest(len(x.ws), len(y.ws)) END) AS BIGINT) AS overlap FROM s x JOIN s y ON x.b = y.b AND x.v = y.v AND x.t = 0 AND y.t = 1")
def similarity_pairs(spark, d):
    a, b = editions(spark, d)
    p = a.join(b.select("b", "v", F.col("text").alias("rt")), ["b", "v"])
    words = lambda c: st.python_split(st.normal_prefix(F.col(c), 200))
    million = lambda x: F.round(1_000_000 * x).cast("bigint")
    return p.select("b", "v", million(sim.word_jaccard(F.col("text"), F.col("rt"))).alias("jaccard"), million(sim.word_overlap(words("text"), words("rt"))).alias("overlap"))


@query("char_sim")
def char_sim(spark, d):
    a, b = editions(spark, d)
    return a.join(b.select("b", "v", F.col("text").alias("rt")), ["b", "v"]).select("b", "v", P.char_sim("text", "rt").alias("score"))


@query("dp_align")
def dp_align(spark, d):
    return alignment.align_chapters(*editions(spark, d), ["b"])


@query("greedy_renumber")
def greedy_renumber(spark, d):
    return alignment.renumber(*editions(spark, d), ["b"])


@query("rebuilt_chapters")
def rebuilt_chapters(spark, d):
    return alignment.rebuild(*editions(spark, d), ["b"])


@query("segmented_chapters")
def segmented_chapters(spark, d):
    a, b = editions(spark, d)
    flat = vocab.joined_text(a, ["b"], ["pos"])
    return alignment.segment_flat(flat, b.where("trim(text) <> ''"), ["b"])


@query("flat_text", f"WITH {EDITION} SELECT b, string_agg(text, ' ' ORDER BY v) AS text FROM edition WHERE t = 0 AND text <> '' GROUP BY b")
def flat_text(spark, d):
    return vocab.joined_text(editions(spark, d)[0], ["b"], ["pos"])


@query("structure_findings", f"WITH {NUMBERED}, o AS (SELECT b, v, pos, lag(v) OVER (PARTITION BY b ORDER BY pos) AS p, row_number() OVER (PARTITION BY b, v ORDER BY pos) AS k FROM numbered), m AS (SELECT b, max(v) - min(v) + 1 - count(DISTINCT v) AS missing FROM numbered GROUP BY 1) SELECT 'DUPLICATE_VERSE' AS reason, count(*) AS n FROM o WHERE k > 1 UNION ALL SELECT 'OUT_OF_ORDER', count(DISTINCT b) FROM o WHERE p > v UNION ALL SELECT 'MISSING_VERSES', count(*) FROM m WHERE missing > 3")
def structure_findings(spark, d):
    v = numbered(spark, d).select(F.lit("x").alias("t"), F.col("b").cast("string").alias("b"), F.lit(1).alias("c"), "v", "pos")
    return quality.count_by(quality.sequence(v), "reason")


@query("completeness", "WITH canon AS (SELECT n_nationkey AS b, 7 AS chapters FROM nation), have AS (SELECT DISTINCT l_returnflag AS t, s_nationkey AS b, l_linenumber AS c FROM lineitem JOIN supplier ON s_suppkey = l_suppkey) SELECT t, count(DISTINCT b) AS books, count(*) AS present, CAST((SELECT sum(chapters) FROM canon) AS BIGINT) AS expected, CAST(floor(count(*) * 1000 / (SELECT sum(chapters) FROM canon)) AS INTEGER) AS permille, CASE WHEN min(b) >= 12 THEN 'NT-only' WHEN max(b) < 12 THEN 'OT-only' ELSE 'Full Bible' END AS scope FROM have JOIN canon USING (b) WHERE c BETWEEN 1 AND chapters GROUP BY 1")
def completeness(spark, d):
    li, s = table(spark, d, "lineitem"), table(spark, d, "supplier")
    v = li.join(s, li.l_suppkey == s.s_suppkey).select(F.col("l_returnflag").alias("t"), F.col("s_nationkey").alias("b"), F.col("l_linenumber").alias("c"), F.lit(1).alias("v"))
    canon = table(spark, d, "nation").select(F.col("n_nationkey").alias("b"), F.lit(7).alias("chapters"), F.when(F.col("n_nationkey") < 12, "OT").otherwise("NT").alias("testament"))
    return quality.completeness(v, canon, "A")[0]


@query("spot_checks", "WITH v AS (SELECT doc_id, lower(text) AS text FROM documents) SELECT CAST(item_id AS INTEGER) AS c, CASE WHEN v.text IS NULL THEN 'SPOT_MISSING' ELSE 'SPOT_KEYWORD' END AS reason FROM benchmark b LEFT JOIN v ON v.doc_id = b.item_id WHERE v.text IS NULL OR NOT contains(v.text, lower(split_part(b.text, ' ', 1)))")
def spot_checks(spark, d):
    e = table(spark, d, "benchmark").select(F.lit("x").alias("b"), F.col("item_id").alias("c"), F.lit(1).alias("v"), F.split_part("text", F.lit(" "), F.lit(1)).alias("keyword"))
    v = table(spark, d, "documents").select(F.lit("x").alias("t"), F.lit("x").alias("b"), F.col("doc_id").alias("c"), F.lit(1).alias("v"), "text")
    return quality.spot_checks(v, e).select("c", "reason")


#: The rules of `quality.SANITY` without lookaround, which DuckDB's expressions lack.
_PLAIN = lambda p: "(^|[^0-9])" + p[len(r"(?<!\d)") :].replace("(?=", "(?:") if p.startswith(r"(?<!\d)") else p.replace(r"(?<!\p{L})", r"(?:^|[^\p{L}])").replace(r"(?!\p{L})", r"(?:$|[^\p{L}])")
_SANITY = " UNION ALL ".join(f"SELECT CAST(doc_id AS INTEGER) AS c, '{what}' AS reason, '{severity}' AS severity FROM documents WHERE regexp_matches(text, '{_PLAIN(p).replace(chr(39), chr(39) * 2)}')" for p, what, severity in quality.SANITY)
_INNER_I = "SELECT CAST(doc_id AS INTEGER), 'capital I inside a word', 'HIGH' FROM (SELECT doc_id, text, unnest(range(1, length(text))) AS i FROM documents WHERE contains(text, 'I')) WHERE regexp_matches(substr(text, i::INTEGER, 3), '^[a-züşğçöı]I[a-züşğçöı]')"


@query("sanity_findings", f"{_SANITY} UNION ALL {_INNER_I}")
def sanity_findings(spark, d):
    v = table(spark, d, "documents").select(F.col("doc_id").alias("c"), "text")
    return quality.sanity(v).select("c", "reason", "severity")


@query("verse_index", "WITH t AS (SELECT doc_id, source, list_transform(regexp_extract_all(text, '\\p{L}+(?:''\\p{L}+)*'), lambda w: lower(translate(w, 'İI', 'iı'))) AS ts FROM documents), w(word) AS (VALUES ('the'), ('der'), ('tion')), m AS (SELECT source AS st, word, doc_id FROM t, w WHERE len(list_filter(ts, lambda x: x = word OR (starts_with(x, word) AND length(x) BETWEEN length(word) + 1 AND length(word) + 7))) > 0) SELECT st, word, doc_id, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY st, word ORDER BY doc_id) AS r FROM m) WHERE r <= 50")
def verse_index(spark, d):
    t = table(spark, d, "documents")
    owners = t.select(F.col("source").alias("st"), "doc_id")
    words = owners.select("st").distinct().select("st", F.explode(F.array(*map(F.lit, ("the", "der", "tion")))).alias("word"))
    return concordance.verse_index(words, owners, t, ["doc_id"])


@query("inverted_index", "SELECT source AS st, doc_id // 1000 AS page, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS refs FROM documents GROUP BY 1, 2")
def inverted_index(spark, d):
    owners = table(spark, d, "documents").select(F.col("source").alias("st"), "doc_id").distinct()
    return concordance.inverted(owners, ["doc_id"], F.floor(F.col("doc_id") / 1000)).withColumn("refs", F.array_join("refs", ","))


@query("section_placement", "WITH h AS (SELECT user_id, event_id AS v FROM events WHERE event_type = 'signup') SELECT user_id, v, kind, CAST(row_number() OVER (PARTITION BY user_id ORDER BY v, kind, text) AS INTEGER) AS n, text FROM (SELECT user_id, v, 0 AS kind, 'heading' AS text FROM h UNION ALL SELECT user_id, event_id, 1, event_type FROM events)")
def section_placement(spark, d):
    e = table(spark, d, "events")
    s = e.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("v"), F.lit("heading").alias("section"))
    return alignment.place_sections(s, e.select("user_id", F.col("event_id").alias("v"), F.col("event_type").alias("text")), ["user_id"])


@query("empty_counts", f"WITH {VERSE} SELECT c, count(*) AS verses, CAST(count_if(trim(text) = '') AS BIGINT) AS empty FROM verse GROUP BY 1")
def empty_counts(spark, d):
    return quality.empty_counts(lines(spark, d), ["c"])


@query("canon_order", "SELECT n_name, n_regionkey, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INTEGER) AS rank FROM nation")
def canon_order(spark, d):
    n = table(spark, d, "nation")
    return windows.top_k(n, ["n_regionkey"], 1 << 30, ["n_nationkey"]).select("n_name", "n_regionkey", "rank")


@query("snippets", "SELECT doc_id, substr(text, greatest(1, strpos(text, '.') - 8), strpos(text, '.') + 8 - greatest(1, strpos(text, '.') - 8)) AS snippet FROM documents WHERE strpos(text, '.') > 0")
def snippets(spark, d):
    at = F.instr("text", ".")
    return table(spark, d, "documents").where(at > 0).select("doc_id", st.snippet(F.col("text"), at, 8).alias("snippet"))


@query("truncated", "SELECT doc_id, CASE WHEN strpos(text, '.') > 0 THEN substr(text, 1, strpos(text, '.')) ELSE text END AS text FROM documents")
def truncated(spark, d):
    return table(spark, d, "documents").select("doc_id", st.truncate_after(F.col("text"), ".").alias("text"))


@query("labelled_fields", "SELECT doc_id, concat_ws(' | ', CASE WHEN lang <> '' THEN 'lang: ' || substr(lang, 1, 10) END, CASE WHEN source <> '' THEN 'source: ' || substr(source, 1, 4) END) AS text FROM documents")
def labelled_fields(spark, d):
    return table(spark, d, "documents").select("doc_id", st.labelled(("lang", F.col("lang"), 10), ("source", F.col("source"), 4)).alias("text"))




@query("merged_blocks", "WITH x AS (SELECT user_id, event_id AS pos, event_id AS v, event_id + CAST(floor(value) AS BIGINT) AS until, event_type AS text FROM events), f AS (SELECT *, CASE WHEN v > coalesce(max(until) OVER (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), v - 1) THEN 1 ELSE 0 END AS s FROM x), i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY pos) AS island FROM f) SELECT user_id, min(v) AS v, max(until) AS until, string_agg(text, ' ' ORDER BY pos) AS text FROM i GROUP BY user_id, island")
def merged_blocks(spark, d):
    e = table(spark, d, "events")
    blocks = e.select("user_id", F.col("event_id").alias("pos"), F.col("event_id").alias("v"), (F.col("event_id") + F.floor("value")).alias("until"), F.col("event_type").alias("text"))
    return alignment.merge_blocks(blocks, ["user_id"])


@query("sentence_ends", f"WITH {VERSE} SELECT c, v, regexp_matches(text, '{_ENDS}') AS closed FROM verse")
def sentence_ends(spark, d):
    return lines(spark, d).select("c", "v", st.ends_sentence(F.col("text")).alias("closed"))


@query("ascii_folded", r"SELECT doc_id, trim(regexp_replace(regexp_replace(translate(lower(translate(text, 'İI', 'iı')), 'ıüöşçğâîû', 'iuoscgaiu'), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g')) AS text FROM documents")
def ascii_folded(spark, d):
    return table(spark, d, "documents").select("doc_id", cleaning.ascii_fold(F.col("text")).alias("text"))


@query("letter_words", r"SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(translate(text, 'İI', 'iı')), '[\p{L}''’]+'), lambda w: length(w) >= 2), ' ') AS words FROM documents")
def letter_words(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(st.letter_tokens(F.col("text")), " ").alias("words"))


@query("verse_references", f"WITH {VERSE} SELECT CAST(c AS VARCHAR) || '.' || CAST(v AS VARCHAR) AS ref, length(text) AS n FROM verse")
def verse_references(spark, d):
    return lines(spark, d).select(st.reference(F.col("c"), F.col("v")).alias("ref"), F.length("text").cast("bigint").alias("n"))


@query("reference_words", f"WITH {EDITION}, w AS (SELECT t, b, v, unnest(regexp_extract_all(lower(translate(text, 'İI', 'iı')), '[\\p{{L}}''’]+')) AS word FROM edition), r AS (SELECT DISTINCT b, v, word FROM w WHERE t = 1 AND length(word) >= 2) SELECT b, v, count(*) AS missing FROM (SELECT DISTINCT b, v, word FROM w WHERE t = 0 AND length(word) >= 2) x WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.b = x.b AND r.v = x.v AND r.word = x.word) GROUP BY b, v")
def reference_words(spark, d):
    """Words of each verse that the same verse of the other edition lacks."""
    return quality.words_not_in(*editions(spark, d), ["b", "v"]).groupBy("b", "v").agg(F.count("*").alias("missing"))


from . import text_queries  # noqa: E402, F401  it adds its queries to QUERIES and SQL
