"""More of the catalogue: text functions, document shapes, reports and corrections, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema
from ..functions import cleaning
from ..functions import python as P
from ..functions import similarity as sim
from ..functions import strings as st
from ..operators import concordance, correction, lexicon, quality, vocab
from ..sources import documents as docs
from ..sources import html, reports
from . import catalogue as cat
from .catalogue import EDITION, LETTERS, LOWER, VERSE, VOCAB, WORDS, editions, lines, query, table


def _q(text: str) -> str:
    return text.replace("'", "''")


# --- text functions

_PARTS = r"list_filter(regexp_split_to_array({}, '\s+'), lambda w: w <> '')"


@query("anchors", f"SELECT doc_id, list_reduce({_PARTS.format('text')}, lambda a, x: CASE WHEN length(a) + length(x) + (CASE WHEN a = '' THEN 0 ELSE 1 END) <= 55 THEN (CASE WHEN a = '' THEN x ELSE a || ' ' || x END) ELSE a END, '') AS anchor FROM documents")
def anchors(spark, d):
    return table(spark, d, "documents").select("doc_id", st.anchor(F.col("text"), 55).alias("anchor"))


_MARKED = "replace(replace(text, ' the ', ' **the** '), ' de ', ' **de** ')"


@query("bold_marks", rf"SELECT doc_id, regexp_replace({_MARKED}, '(?s)\*\*(.+?)\*\*', '<b>\1</b>', 'g') AS bold, regexp_replace(regexp_replace({_MARKED}, '(?s)\*\*(.+?)\*\*', '<b>\1</b>', 'g'), '(?s)<b>(.*?)</b>', '**\1**', 'g') AS back FROM documents")
def bold_marks(spark, d):
    bold = st.bold_to_tags(st.fold_replaces(F.col("text"), ((" the ", " **the** "), (" de ", " **de** "))))
    return table(spark, d, "documents").select("doc_id", bold.alias("bold"), st.tags_to_bold(bold).alias("back"))


@query("reverted_marks", r"SELECT doc_id, regexp_replace(replace(text, 'e', 'ğ'''), 'ğ(['''||'’])($|[^\p{L}])', '?\1\2', 'g') AS text FROM documents")
def reverted_marks(spark, d):
    return table(spark, d, "documents").select("doc_id", st.revert_mark(F.replace("text", F.lit("e"), F.lit("ğ'"))).alias("text"))


@query("unquoted", "SELECT doc_id, regexp_replace(CASE WHEN doc_id % 2 = 0 THEN '“'' ' || text ELSE text END, '^[''\"‘’‚‛“”]+\\s*', '') AS text FROM documents")
def unquoted(spark, d):
    return table(spark, d, "documents").select("doc_id", st.strip_leading_quotes(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("“' "), "text")).otherwise(F.col("text"))).alias("text"))


@query("sentence_parts", r"WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '([.!?])\s+(\p{Lu})', '\1' || chr(10) || '\2', 'g'), '\n+'), lambda x: trim(x)), lambda x: x <> '') AS ss FROM documents) SELECT doc_id, CAST(unnest(range(1, len(ss) + 1)) AS INTEGER) AS n, unnest(ss) AS sentence FROM s")
def sentence_parts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(st.sentences(F.col("text"))).alias("n", "sentence")).withColumn("n", F.col("n") + 1)


@query("found_places", "WITH k AS (SELECT doc_id, d.text, string_split(d.lang || ' ' || b.text, ' ')[2:4] AS ws FROM documents d JOIN benchmark b ON b.item_id = d.doc_id) SELECT doc_id, coalesce(list_filter(list_transform(range(len(ws), 0, -1), lambda n: CASE WHEN strpos(substr(text, 5), array_to_string(ws[1:n], ' ')) > 0 THEN CAST(strpos(substr(text, 5), array_to_string(ws[1:n], ' ')) + 4 AS INTEGER) ELSE 0 END), lambda p: p > 0)[1], 0) AS place FROM k")
def found_places(spark, d):
    b = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), F.array_join(F.slice(F.split("text", " "), 1, 3), " ").alias("key"))
    return table(spark, d, "documents").join(b, "doc_id").select("doc_id", st.find_from(F.col("text"), F.col("key"), F.lit(5)).alias("place"))


@query("snapped_places", r"WITH x AS (SELECT doc_id, text, doc_id % 37 + 1 AS p FROM documents) SELECT doc_id, CAST(CASE WHEN p <= 1 OR regexp_matches(substr(text, p - 1, 1), '\s') THEN p ELSE p + length(regexp_extract(substr(text, p), '^\S*\s*')) END AS INTEGER) AS place FROM x")
def snapped_places(spark, d):
    return table(spark, d, "documents").select("doc_id", st.snap_to_word(F.col("text"), (F.col("doc_id") % 37 + 1).cast("int")).alias("place"))


_ORD = ", ".join(f"'{n}'" for n in cleaning.ORDINALS)


@query("headings", f"WITH x AS (SELECT doc_id, text, coalesce([{_ORD}][(doc_id % 12)::INTEGER], 'Yok') || ' Bölüm : ' || substr(text, 1, 20) AS heading FROM documents) SELECT doc_id, length(text) > 500 OR regexp_matches(text, 'Genel|overview') AS intro, CASE WHEN contains(text, 'the ') THEN 'T' WHEN contains(text, 'der ') THEN 'D' END AS title, " + "CASE " + " ".join(f"WHEN starts_with(heading, '{n}') THEN {i}" for n, i in cleaning.ORDINALS.items()) + " END AS chapter, lpad(CAST(doc_id % 500 AS VARCHAR), 3, '0') AS number FROM x")
def headings(spark, d):
    heading = F.concat(F.coalesce(F.get(F.array(*map(F.lit, cleaning.ORDINALS)), (F.col("doc_id") % 12 - 1).cast("int")), F.lit("Yok")), F.lit(" Bölüm : "), F.substring("text", 1, 20))
    t = table(spark, d, "documents")
    return t.select("doc_id", cleaning.is_intro(F.col("text"), ("Genel|overview",)).alias("intro"), cleaning.title_in(F.col("text"), (("the ", "T"), ("der ", "D"))).alias("title"), cleaning.ordinal_chapter(heading).alias("chapter"), cleaning.padded(F.col("doc_id") % 500).alias("number"))


_RULES = (("(?i)the", "T"), ("([aeiou])n", "$1N"), (r"\s+", "_"), ("ğ|ş", "-"))


@query("pattern_rules", "SELECT doc_id, " + "regexp_replace(" * len(_RULES) + "text" + "".join(f", '{p}', '{n.replace('$1', chr(92) + '1')}', 'g')" for p, n in _RULES) + " AS text FROM documents")
def pattern_rules(spark, d):
    return correction.apply_pattern_rules(table(spark, d, "documents").select("doc_id", "text"), list(_RULES))


@query("noise_stripped", r"SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text || ' 12 34; 5:6-7', '>{1,3}[^<\n]*', ' ', 'g'), '\s+[\d:;.,\- ]{10,}$', ' ', 'g'), '\s+\d+\s*$', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM documents")
def noise_stripped(spark, d):
    return table(spark, d, "documents").select("doc_id", cleaning.strip_noise(F.concat("text", F.lit(" 12 34; 5:6-7")), ("headings", "trailing_references", "trailing_number")).alias("text"))


@query("straight_quotes", "SELECT doc_id, translate(replace(text, 'e', '’'), '’‘', '''''') AS text FROM documents")
def straight_quotes(spark, d):
    return table(spark, d, "documents").select("doc_id", cleaning.straight_apostrophes(F.replace("text", F.lit("e"), F.lit("’"))).alias("text"))


@query("first_values", "SELECT doc_id, coalesce(nullif(CASE WHEN lang = 'en' THEN '' ELSE lang END, ''), nullif(source, ''), '') AS value FROM documents")
def first_values(spark, d):
    t = table(spark, d, "documents").withColumn("lang", F.when(F.col("lang") == "en", "").otherwise(F.col("lang")))
    return t.select("doc_id", lexicon.best_text("lang", "source").alias("value"))


@query("verse_labels", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id AS INTEGER) END AS v FROM documents")
def verse_labels(spark, d):
    label = F.when(F.col("doc_id") % 3 == 0, F.col("doc_id").cast("string")).when(F.col("doc_id") % 3 == 1, F.concat("doc_id", F.lit("-9"))).otherwise("x")
    return table(spark, d, "documents").select("doc_id", st.verse_number(label).alias("v"))


@query("footnote_lines", r"WITH x AS (SELECT doc_id, repeat(' ' || doc_id || '/7', (doc_id % 4)::INTEGER) || CASE WHEN doc_id % 5 = 0 THEN ' 3*' ELSE '' END AS t FROM documents) SELECT doc_id, len(regexp_extract_all(t, '\d+/\d+')) >= 2 AND NOT regexp_matches(t, '\d+\*') AS footnote FROM x")
def footnote_lines(spark, d):
    t = F.concat(F.repeat(F.concat(F.lit(" "), "doc_id", F.lit("/7")), (F.col("doc_id") % 4).cast("int")), F.when(F.col("doc_id") % 5 == 0, " 3*").otherwise(""))
    return table(spark, d, "documents").select("doc_id", st.is_footnote_line(t).alias("footnote"))


@query("empty_notes", "SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) = '')) > 0 AS empty FROM documents")
def empty_notes(spark, d):
    return table(spark, d, "documents").select("doc_id", lexicon.has_empty_note(F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text")))).alias("empty"))


_STOP = "len(list_filter({0}, lambda w: w IN (" + ", ".join(f"'{w}'" for w in lexicon.ENGLISH) + ")))::DOUBLE / len({0})"
_AZ = r"regexp_extract_all(lower({}), '[a-z]{{2,}}')"
_BARE = r"regexp_replace(regexp_replace(t, '\{[^}]*\}', '', 'g'), '\([^)]*\)', '', 'g')"


@query("needs_translation", f"WITH x AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE d.text END AS t, coalesce(b.text, '') AS o FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id), w AS (SELECT *, list_distinct({_AZ.format('o')}) AS ow, list_distinct({_AZ.format('t')}) AS tw, {_AZ.format(_BARE)} AS bw FROM x) SELECT doc_id, trim(t) = '' OR (len(ow) > 0 AND len(list_intersect(ow, tw)) > 0.6 * len(ow)) OR (len(bw) >= 2 AND {_STOP.format('bw')} > 0.35) AS needs FROM w")
def needs_translation(spark, d):
    b = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("text").alias("o"))
    t = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("text")).alias("t")).join(b, "doc_id", "left")
    return t.select("doc_id", lexicon.needs_translation(F.col("t"), F.col("o")).alias("needs"))


@query("origin_markers", "SELECT doc_id, " + " OR ".join(f"contains(lower(text), '{m}')" for m in lexicon.MARKERS) + " AS marked FROM documents")
def origin_markers(spark, d):
    return table(spark, d, "documents").select("doc_id", lexicon.has_marker(F.col("text")).alias("marked"))


@query("work_shards", "SELECT doc_id % 3 AS worker, count(*) AS n FROM documents GROUP BY 1")
def work_shards(spark, d):
    t = table(spark, d, "documents")
    parts = [lexicon.shard(t, F.col("doc_id"), 3, k).groupBy().agg(F.lit(k).cast("bigint").alias("worker"), F.count("*").alias("n")) for k in range(3)]
    return parts[0].union(parts[1]).union(parts[2])


@query("composed_words", f"SELECT DISTINCT word, lower(translate(nfc_normalize(word), 'İI', 'iı')) AS lower FROM (SELECT unnest({WORDS.format('text')}) AS word FROM documents)")
def composed_words(spark, d):
    return vocab.words(table(spark, d, "documents")).distinct().select("word", P.normal_lower_udf("word").alias("lower"))


@query("long_words", rf"SELECT DISTINCT {LOWER.format('word')} AS word FROM (SELECT unnest(list_filter(regexp_extract_all(text, '[\p{{L}}\p{{N}}_‘’''\-]+', 0), lambda w: length(w) >= 6)) AS word FROM documents)")
def long_words(spark, d):
    return vocab.distinct_words(table(spark, d, "documents"), 6)


@query("anchor_overlap", f"WITH {EDITION}, p AS (SELECT b, v, x.text, {_PARTS.format('y.text')} AS ws FROM edition x JOIN edition y USING (b, v) WHERE x.t = 0 AND y.t = 1) SELECT b, v, CAST(round(1000 * CASE WHEN len(ws) = 0 THEN 0 ELSE len(list_filter(ws[1:5], lambda w: contains(text, w)))::DOUBLE / len(ws[1:5]) END) AS BIGINT) AS permille, CASE WHEN len(ws) = 0 THEN NULL WHEN split_part(text, ' ', 1) = ws[1] THEN 2 WHEN substr(split_part(text, ' ', 1), 1, greatest(1, floor(0.7 * least(length(split_part(text, ' ', 1)), length(ws[1]))))::INTEGER) = substr(ws[1], 1, greatest(1, floor(0.7 * least(length(split_part(text, ' ', 1)), length(ws[1]))))::INTEGER) THEN 1 ELSE 0 END AS score FROM p")
def anchor_overlap(spark, d):
    a, b = editions(spark, d)
    p = a.join(b.select("b", "v", st.python_split(F.col("text")).alias("ws")), ["b", "v"])
    first, other = F.split_part("text", F.lit(" "), F.lit(1)), F.get("ws", F.lit(0))
    return p.select("b", "v", F.round(1000 * sim.starts_overlap(F.col("text"), F.col("ws"))).cast("bigint").alias("permille"), F.when(F.size("ws") > 0, sim.word_score(first, other)).alias("score"))


# --- document shapes

_ITEMS = f"{VERSE}, item AS (SELECT c, v - 1 AS pos, CASE WHEN v % 5 = 0 THEN NULL WHEN v % 7 = 0 THEN v || '-' || (v + 1) ELSE CAST(v AS VARCHAR) END AS label, CASE WHEN v % 5 = 0 THEN NULL ELSE text END AS text, CASE WHEN v % 5 = 0 THEN 'S' || v END AS section FROM verse)"


def _chapters(spark, d):
    """Documents as chapter files: every fifth line is a heading, every seventh a range of verses."""
    v = lambda i: i + 1
    item = lambda x, i: F.struct(
        F.when(v(i) % 5 == 0, None).when(v(i) % 7 == 0, F.concat(v(i), F.lit("-"), v(i) + 1)).otherwise(v(i).cast("string")).alias("v"),
        F.when(v(i) % 5 != 0, x).alias("text"), F.when(v(i) % 5 == 0, F.concat(F.lit("S"), v(i))).alias("section"),
    )
    return table(spark, d, "documents").select(F.col("lang").alias("t"), F.col("source").alias("b"), F.col("doc_id").alias("c"), F.transform(F.split("text", "\n"), item).alias("content"))


@query("chapter_verses", rf"WITH {_ITEMS} SELECT c, CASE WHEN regexp_matches(label, '^\d{{1,9}}$') THEN CAST(label AS INTEGER) END AS v, CAST(pos AS INTEGER) AS pos, label, text FROM item WHERE label IS NOT NULL")
def chapter_verses(spark, d):
    return docs.verses(_chapters(spark, d)).select("c", "v", "pos", "label", "text")


@query("chapter_sections", rf"WITH {_ITEMS}, n AS (SELECT *, CASE WHEN regexp_matches(label, '^\d{{1,9}}$') THEN CAST(label AS INTEGER) END AS v FROM item), x AS (SELECT *, first_value(v IGNORE NULLS) OVER (PARTITION BY c ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nxt FROM n) SELECT c, CAST(pos AS INTEGER) AS pos, section, nxt AS v FROM x WHERE section IS NOT NULL")
def chapter_sections(spark, d):
    return docs.sections(_chapters(spark, d)).select("c", "pos", "section", "v")


@query("verse_texts", f"WITH {cat.NUMBERED} SELECT 'L.' || b || '.' || v AS ref, CAST(max(pos) AS VARCHAR) AS text FROM numbered GROUP BY b, v")
def verse_texts(spark, d):
    v = cat.numbered(spark, d).select(F.lit("x").alias("t"), F.lit("L").alias("b"), F.col("b").alias("c"), "v", "pos", F.col("pos").cast("string").alias("text"))
    return docs.verse_map(v).select("ref", "text")


@query("chapter_sizes", "SELECT lang AS t, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n FROM documents GROUP BY ROLLUP (lang)")
def chapter_sizes(spark, d):
    """Items of each edition and of all (no edition)."""
    return docs.verse_counts(_chapters(spark, d)).rollup("t").agg(F.sum("n").alias("n"))


@query("strong_verses", "SELECT DISTINCT 'G' || l_returnflag AS st, 'L' AS b, l_linenumber AS c, CAST(l_quantity AS INTEGER) AS v FROM lineitem WHERE l_linestatus <> 'F'")
def strong_verses(spark, d):
    li = table(spark, d, "lineitem")
    w = li.select(F.when(F.col("l_linestatus") != "F", F.concat(F.lit("G"), "l_returnflag")).otherwise("").alias("st"), F.lit("L").alias("b"), F.col("l_linenumber").alias("c"), F.col("l_quantity").cast("int").alias("v"))
    return docs.strong_verses(w)


@query("service_rows", "SELECT coalesce(try_cast(CASE WHEN event_id % 2 = 0 THEN 'x' ELSE CAST(user_id AS VARCHAR) END AS INTEGER), CAST(event_id AS INTEGER)) AS v, trim(event_type) AS text FROM (SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN '  ' ELSE ' ' || event_type || ' ' END AS event_type FROM events) WHERE trim(event_type) <> ''")
def service_rows(spark, d):
    e = table(spark, d, "events").select(F.when(F.col("event_id") % 2 == 0, "x").otherwise(F.col("user_id").cast("string")).alias("number"), F.col("event_id").cast("string").alias("id"), F.when(F.col("event_id") % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), "event_type", F.lit(" "))).alias("body"))
    return docs.api_rows(e, ["number", "id"], "body")


@query("nested_index", "SELECT l_orderkey AS k, string_agg(l_linenumber || '=' || n, ',' ORDER BY l_linenumber) AS entries FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1")
def nested_index(spark, d):
    n = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    told = docs.nested_map(n, "l_orderkey", "l_linenumber", "n")
    m = [c for c in told.columns if c != "l_orderkey"][0]
    return told.select(F.col("l_orderkey").alias("k"), F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda x: F.concat_ws("=", x["key"], x["value"])), ",").alias("entries"))


@query("merged_notes", "SELECT coalesce(n.k, o.k) AS k, coalesce(n.note, o.note) AS note FROM (SELECT doc_id AS k, lang AS note FROM documents) o FULL JOIN (SELECT item_id * 3 AS k, CASE WHEN item_id % 2 = 0 THEN ' ' ELSE 'new' END AS note FROM benchmark) n ON n.k = o.k WHERE trim(coalesce(n.note, o.note)) <> ''")
def merged_notes(spark, d):
    old = table(spark, d, "documents").select(F.col("doc_id").alias("k"), F.col("lang").alias("note"))
    new = table(spark, d, "benchmark").select((F.col("item_id") * 3).alias("k"), F.when(F.col("item_id") % 2 == 0, " ").otherwise("new").alias("note"))
    return docs.merge_notes(old, new, ["k"])


_HEAD, _LINK = "<h1[^>]*>(.*?)</h1>", '<a href="([^"]*)"[^>]*>(.*?)</a>'


def _cleaned(x: str, gap: str) -> str:
    x = f"regexp_replace({x}, '<[^>]+>', '{gap}', 'g')"
    for name, c in st.ENTITIES.items():
        x = f"replace({x}, '{name}', '{_q(c)}')"
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


@query(
    "page_items",
    f"WITH w AS (SELECT page_id, regexp_extract_all(html, '(?s){_HEAD}|{_LINK}') AS xs FROM pages), i AS (SELECT page_id, unnest(range(0, len(xs))) AS pos, unnest(xs) AS x FROM w), "
    f"t AS (SELECT page_id, pos, CASE WHEN regexp_matches(x, '(?s)^(?:{_HEAD})$') THEN 'heading' ELSE 'verse' END AS kind, CASE WHEN NOT regexp_matches(x, '(?s)^(?:{_HEAD})$') THEN regexp_extract(x, '(?s)^(?:{_LINK})$', 1) END AS label, CASE WHEN regexp_matches(x, '(?s)^(?:{_HEAD})$') THEN regexp_extract(x, '(?s)^(?:{_HEAD})$', 1) ELSE regexp_extract(x, '(?s)^(?:{_LINK})$', 2) END AS inner_html FROM i), "
    f"c AS (SELECT page_id, pos, kind, label, {_cleaned('''regexp_replace(inner_html, '(?s)<sup[^>]*>.*?</sup>|<h6[^>]*>.*?</h6>', '', 'g')''', '')} AS text FROM t) "
    "SELECT page_id, CAST(pos AS INTEGER) AS pos, kind, label, text FROM (SELECT *, lag(CASE WHEN kind = 'heading' THEN text END) OVER (PARTITION BY page_id ORDER BY pos) AS before FROM c WHERE text <> '') WHERE kind = 'verse' OR before IS NULL OR before <> text",
)
def page_items(spark, d):
    return html.chapter(table(spark, d, "pages"), ["page_id"], "html", _HEAD, _LINK).drop("v")


@query("page_notes", f"SELECT page_id, array_to_string(list_filter(list_transform(regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1), lambda x: {_cleaned('x', ' ')}), lambda x: x <> ''), ' — ') AS notes FROM pages")
def page_notes(spark, d):
    return table(spark, d, "pages").select("page_id", html.notes(F.col("html"), "<li>(.*?)</li>").alias("notes"))


# --- indexes and reports


@query("overridden", "SELECT coalesce(n.st, o.st) AS st, coalesce(n.chips, o.chips) AS chips FROM (SELECT doc_id AS st, lang AS chips FROM documents) o FULL JOIN (SELECT item_id * 7 AS st, '' AS chips FROM benchmark) n ON n.st = o.st")
def overridden(spark, d):
    o = table(spark, d, "documents").select(F.col("doc_id").alias("st"), F.col("lang").alias("chips"))
    return concordance.override(o, table(spark, d, "benchmark").select((F.col("item_id") * 7).alias("st"), F.lit("").alias("chips")))


@query("canon_books", "SELECT doc_id, b, ordinal, testament, chapters FROM documents JOIN (VALUES " + ", ".join(f"('{b}', {i}, '{'OT' if b in schema.OLD else 'NT'}', {n})" for i, (b, n) in enumerate((schema.OLD | schema.NEW).items())) + ") c(b, ordinal, testament, chapters) ON ordinal = doc_id % 66")
def canon_books(spark, d):
    t = table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 66).cast("int").alias("ordinal"))
    return t.join(F.broadcast(schema.canon(spark)), "ordinal")


#: lineitem as editions of books (suppliers), chapters (line numbers) and verses (quantities), in a total order.
_LI = "l_orderkey, l_partkey, l_linenumber, l_extendedprice, l_discount, l_tax, l_shipdate"
_BOOKS = f"bk AS (SELECT l_linestatus AS t, CAST(l_suppkey AS VARCHAR) AS b, l_linenumber AS c, CAST(l_quantity AS INTEGER) AS v, CAST(row_number() OVER (PARTITION BY l_linestatus, l_suppkey, l_linenumber ORDER BY {_LI}) AS INTEGER) AS pos FROM lineitem)"


def _books(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("l_linestatus", "l_suppkey", "l_linenumber").orderBy(*_LI.split(", "))
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_linestatus").alias("t"), F.col("l_suppkey").cast("string").alias("b"), F.col("l_linenumber").alias("c"), F.col("l_quantity").cast("int").alias("v"), F.row_number().over(w).alias("pos"), F.when(F.col("l_linenumber") == 5, " ").otherwise("x").alias("text"))


@query(
    "chapter_structure",
    f"WITH {_BOOKS}, canon AS (SELECT CAST(s_suppkey AS VARCHAR) AS b, 6 AS chapters FROM supplier), have AS (SELECT DISTINCT t, b, c FROM bk), should AS (SELECT DISTINCT t, b, unnest(range(1, chapters + 1)) AS c FROM bk JOIN canon USING (b)), "
    "o AS (SELECT *, lag(v) OVER (PARTITION BY t, b, c ORDER BY pos) AS p, row_number() OVER (PARTITION BY t, b, c, v ORDER BY pos) AS k FROM bk), dv AS (SELECT DISTINCT t, b, c, v FROM bk), g AS (SELECT *, lead(v) OVER (PARTITION BY t, b, c ORDER BY v) AS nxt FROM dv), l AS (SELECT t, b, c, max(v) AS v FROM bk GROUP BY ALL) "
    "SELECT t, b, CAST(c AS INTEGER) AS c, v, reason, severity, detail FROM ("
    "SELECT t, b, c, NULL::INTEGER AS v, 'MISSING_CHAPTER' AS reason, 'CRITICAL' AS severity, '' AS detail FROM should ANTI JOIN have USING (t, b, c) "
    "UNION ALL SELECT t, b, c, NULL, 'EXTRA_CHAPTER', 'HIGH', '' FROM have ANTI JOIN should USING (t, b, c) "
    "UNION ALL SELECT t, b, c, v, 'DUPLICATE_VERSE', 'CRITICAL', '' FROM o WHERE k > 1 UNION ALL SELECT t, b, c, v, 'OUT_OF_ORDER', 'HIGH', p || ' > ' || v FROM o WHERE p >= v "
    "UNION ALL SELECT t, b, c, v, 'VERSE_GAP', 'CRITICAL', '[' || array_to_string(range(v + 1, nxt), ',') || ']' FROM g WHERE nxt - v > 1 "
    "UNION ALL SELECT t, b, c, NULL, 'EMPTY_CHAPTER', 'CRITICAL', '' FROM have WHERE c = 5 "
    "UNION ALL SELECT t, b, c, v, 'CHAPTER_TOO_SHORT', 'HIGH', v || '/30' FROM l WHERE v < 28 UNION ALL SELECT t, b, c, v, 'CHAPTER_TOO_LONG', 'MEDIUM', v || '/30' FROM l WHERE v > 32)",
)
def chapter_structure(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("b"))
    lengths = s.select("b", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("c"), F.lit(30).alias("n"))
    return quality.structure(_books(spark, d), s.withColumn("chapters", F.lit(6)), lengths)


@query("missing_chapter_lists", f"WITH {_BOOKS}, should AS (SELECT DISTINCT t, b, unnest(range(1, 10)) AS c FROM bk) SELECT t, b, string_agg(CAST(c AS VARCHAR), ', ' ORDER BY c) AS chapters FROM should ANTI JOIN (SELECT DISTINCT t, b, c FROM bk) USING (t, b, c) GROUP BY t, b")
def missing_chapter_lists(spark, d):
    canon = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("b"), F.lit(9).alias("chapters"), F.lit("NT").alias("testament"))
    return quality.chapter_lists(quality.completeness(_books(spark, d), canon, "O")[1])


@query("exact_lists", f"WITH {_BOOKS}, e AS (SELECT CAST(s_suppkey AS VARCHAR) AS b, 1 AS c, unnest(range(1, 21)) AS v FROM supplier), want AS (SELECT DISTINCT bk.t, e.b, e.c, e.v FROM (SELECT DISTINCT t, b FROM bk) bk JOIN e USING (b)), have AS (SELECT DISTINCT t, b, c, v FROM bk WHERE c = 1 AND b IN (SELECT b FROM e)) SELECT t, b, CAST(c AS INTEGER) AS c, CAST(v AS INTEGER) AS v, 'LIST_MISSING' AS reason FROM want ANTI JOIN have USING (t, b, c, v) UNION ALL SELECT t, b, c, v, 'LIST_EXTRA' FROM have ANTI JOIN want USING (t, b, c, v)")
def exact_lists(spark, d):
    e = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("b"), F.lit(1).alias("c"), F.explode(F.sequence(F.lit(1), F.lit(20))).alias("v"))
    return quality.verse_lists(_books(spark, d), e).select("t", "b", "c", "v", "reason")


@query("coverage_order", f"WITH {_BOOKS}, n AS (SELECT t, b, count(DISTINCT c) AS present FROM bk GROUP BY ALL) SELECT t, b, present, row_number() OVER (PARTITION BY t ORDER BY present DESC, b)::INTEGER AS rank FROM n")
def coverage_order(spark, d):
    n = _books(spark, d).groupBy("t", "b").agg(F.count_distinct("c").alias("present"))
    return cat.windows.top_k(n, ["t"], 1 << 30, [F.desc("present"), "b"])


@query("requested_books", "WITH have AS (SELECT DISTINCT source AS b FROM documents WHERE text <> ''), want(b) AS (SELECT DISTINCT source FROM documents UNION ALL SELECT 'none' UNION ALL SELECT 'empty') SELECT b, CASE WHEN b IN (SELECT b FROM have) THEN 'told' WHEN b = 'empty' THEN 'NO_CHAPTERS' ELSE 'NOT_FOUND' END AS issue FROM want")
def requested_books(spark, d):
    t = table(spark, d, "documents").select(F.lit("x").alias("t"), F.col("source").alias("b"), "text")
    named = t.select("b").distinct().union(spark.range(2).select(F.when(F.col("id") == 0, "none").otherwise("empty")))
    report = quality.corruption(t.where("text <> ''"), ["b"]).withColumn("issues", F.array(F.lit("told")))
    return quality.requested(named, report, ["b"], spark.range(1).select(F.lit("empty").alias("b"))).select("b", F.array_join("issues", ",").alias("issue"))


@query("severities", f"SELECT severity, CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END::BIGINT AS rank, count(*) AS n FROM ({cat._ALLCHARS}) GROUP BY 1, 2")
def severities(spark, d):
    return quality.characters(lines(spark, d)).groupBy("severity").agg(quality.rank_of(F.first("severity")).cast("bigint").alias("rank"), F.count("*").alias("n"))


@query("short_verses", f"WITH {VERSE} SELECT CAST(c AS INTEGER) AS c, CAST(v AS INTEGER) AS v, CASE WHEN trim(text) = '' THEN 'EMPTY_TEXT' ELSE 'SHORT_TEXT' END AS reason FROM verse WHERE length(trim(text)) < 8 AND NOT contains(text, '[verse text missing')")
def short_verses(spark, d):
    return quality.empty_or_short(lines(spark, d)).select("c", "v", "reason")


@query("extreme_lengths", f"WITH {EDITION}, r AS (SELECT b, v, avg(length(text)) AS n FROM edition WHERE t = 1 GROUP BY ALL) SELECT b, CAST(e.v AS INTEGER) AS v, CASE WHEN length(e.text) / n < 0.08 THEN 'EXTREMELY_SHORT' ELSE 'EXTREMELY_LONG' END AS reason FROM edition e JOIN r USING (b, v) WHERE t = 0 AND e.text <> '' AND n >= 20 AND (length(e.text) / n < 0.08 OR length(e.text) / n > 15)")
def extreme_lengths(spark, d):
    key = lambda x: x.select(F.lit("0").alias("t"), F.lit("x").alias("b"), F.col("b").cast("int").alias("c"), "v", "text")
    a, b = editions(spark, d)
    return quality.length_by_mean(key(a), key(b)).select(F.col("c").cast("bigint").alias("b"), "v", "reason")


@query("suspicious_tokens", f"WITH t AS (SELECT doc_id, {WORDS.format('text')} AS ws FROM documents), p AS (SELECT doc_id, unnest(range(0, len(ws))) AS place, unnest(ws) AS word FROM t), f AS (SELECT doc_id, word, CAST(min(place) AS INTEGER) AS place FROM p WHERE regexp_matches(word, '{_q(quality.SUSPICIOUS)}') GROUP BY ALL) SELECT doc_id, word, place, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place, word) AS r FROM f) WHERE r <= 30")
def suspicious_tokens(spark, d):
    w = table(spark, d, "documents").select("doc_id", F.posexplode(st.extract_words(F.col("text"))).alias("place", "word"))
    return quality.suspicious_tokens(w, ["doc_id"])


_VRATES = ", ".join(f"round_even(n_{i} * 1000.0 / greatest(total, 1), 2) AS r{i}" for i in range(len(quality.CLEAN)))
_VRANGE = " UNION ALL ".join(f"SELECT source AS b, CASE WHEN r{i} < {lo} THEN 'STILL_LOW_{c}' ELSE 'STILL_HIGH_{c}' END AS type FROM rates WHERE total > 0 AND (r{i} < {lo} OR r{i} > {hi})" for i, (c, (lo, hi)) in enumerate(quality.CLEAN.items()))


@query(
    "validation_issues",
    "WITH counts AS (SELECT source, CAST(greatest(sum(CASE WHEN text <> '' THEN length(text) + 1 ELSE 0 END) - 1, 0) AS DOUBLE) AS total, " + ", ".join(f"CAST(sum(length(text) - length(replace(text, '{c}', ''))) AS DOUBLE) AS n_{i}" for i, c in enumerate(quality.CLEAN)) + f" FROM documents GROUP BY 1), rates AS (SELECT source, total, {_VRATES} FROM counts), "
    f"each AS ({_VRANGE} UNION ALL SELECT source, 'DIGIT_ARTEFACT' FROM documents WHERE regexp_matches(text, '{_q(quality.DIGIT_IN_WORD)}') UNION ALL SELECT source, 'SHORT_VERSE' FROM documents WHERE length(text) BETWEEN 1 AND 7 UNION ALL SELECT source, 'UNCORRECTED_TOKEN' FROM documents WHERE regexp_matches(lower(text), '{_q(quality.UNCORRECTED)}')) "
    "SELECT b, type, count(*) AS n FROM each GROUP BY ALL UNION ALL SELECT source, 'PASSED', CASE WHEN source IN (SELECT b FROM each WHERE type <> 'SHORT_VERSE') THEN 0 ELSE 1 END FROM counts",
)
def validation_issues(spark, d):
    t = table(spark, d, "documents").select(F.col("source").alias("b"), "text")
    issues = quality.validation(t, ["b"])
    return quality.count_by(issues, "b", "type").union(quality.passed(t, issues, ["b"]).select("b", F.lit("PASSED"), F.col("passed").cast("bigint")))


_ROOT = f"CASE WHEN regexp_extract(l, '^(.{{3,}}?)(?:{cat._ROOTS})$', 1) <> '' THEN regexp_extract(l, '^(.{{3,}}?)(?:{cat._ROOTS})$', 1) ELSE substr(l, 1, greatest(4, length(l) - 2)) END"


@query(
    "rare_words",
    f"WITH {VOCAB.replace('FROM documents', 'FROM conversations')}, tok AS (SELECT doc_id, unnest(regexp_extract_all(text, '[{LETTERS}''‘’]{{3,}}')) AS word FROM documents), dis AS (SELECT DISTINCT word, {LOWER.format('word')} AS l FROM tok), "
    f"told AS (SELECT dis.word, coalesce(a.freq, 0) + coalesce(c.freq, 0) AS f, coalesce(r.freq, 0) AS rf FROM (SELECT *, {_ROOT} AS root FROM dis) dis LEFT JOIN vocab a ON a.word = dis.word LEFT JOIN vocab c ON c.word = dis.l LEFT JOIN vocab r ON r.word = root) "
    f"SELECT doc_id, 'OCR_GARBAGE_TOKEN' AS reason, word AS detail FROM tok WHERE regexp_matches(word, '{_q(quality.GARBAGE)}') UNION ALL SELECT doc_id, 'UNKNOWN_TOKEN', word FROM tok JOIN (SELECT word FROM told WHERE f = 0 AND rf < 3) USING (word)",
)
def rare_words(spark, d):
    """Words of documents that the conversations, as reference, do not know."""
    t = table(spark, d, "documents")
    v = t.select(F.lit("x").alias("t"), F.lit("x").alias("b"), F.col("doc_id").alias("c"), F.lit(1).alias("v"), "text")
    return quality.rare_words(v, vocab.vocabulary(table(spark, d, "conversations"))).select(F.col("c").cast("bigint").alias("doc_id"), "reason", "detail")


_CARRIED = "SELECT n.k, n.x, coalesce(nullif(n.y, ''), o.y) AS y FROM (SELECT doc_id AS k, lang AS x, CASE WHEN doc_id % 2 = 0 THEN '' ELSE source END AS y FROM documents) n LEFT JOIN (SELECT doc_id AS k, 'old' AS y FROM labels) o USING (k)"


@query("carried_fields", _CARRIED)
def carried_fields(spark, d):
    new = table(spark, d, "documents").select(F.col("doc_id").alias("k"), F.col("lang").alias("x"), F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("source")).alias("y"))
    return lexicon.carried(new, table(spark, d, "labels").select(F.col("doc_id").alias("k"), F.lit("old").alias("y")), ["k"], ["y"])


# --- corrections

_MIS = correction.MISREAD
_STEPS = lambda x, steps, other: "CASE " + " ".join(f"WHEN {x} >= {least} THEN {v}" for least, v in steps) + f" ELSE {other} END"
_PUT = "array_to_string(list_transform(range(1, length(core) + 1), lambda i: CASE WHEN list_contains(places, i) THEN translate(substr(core, i::INTEGER, 1), '" + "".join(_MIS) + "', '" + "".join(_MIS.values()) + "') ELSE substr(core, i::INTEGER, 1) END), '')"
_SPLIT = lambda k: f"regexp_extract(word, '(?s)^([^{LETTERS}]*)([{LETTERS}''‘’]*)(.*)$', {k})"
#: A 9 inside a core, by hand: characters are looked at with their neighbours, as DuckDB's patterns have no lookaround.
_NINE = (
    f"array_to_string(list_transform(range(1, length(core) + 1), lambda i: CASE WHEN substr(core, i::INTEGER, 1) = '9' AND ((i > 1 AND regexp_matches(substr(core, (i - 1)::INTEGER, 1), '[{LETTERS}]') AND regexp_matches(substr(core, (i + 1)::INTEGER, 1), '[a-zçğışöü''‘’]')) "
    f"OR ((i = 1 OR NOT regexp_matches(substr(core, (i - 1)::INTEGER, 1), '[{LETTERS}0-9]')) AND regexp_matches(substr(core, (i + 1)::INTEGER, 1), '[a-zçğışöü]'))) THEN 'ş' ELSE substr(core, i::INTEGER, 1) END), '')"
)
_FREQ = lambda x, v: f"coalesce((SELECT freq FROM {v} WHERE word = {x}), 0)"
#: (word, output, fixed, confidence, action, type, n_subs, orig_freq, fixed_freq) of the distinct words of documents.
_CORRECTED = (
    f"{VOCAB}, words AS (SELECT DISTINCT word FROM w), cut AS (SELECT word, {_SPLIT(1)} AS prefix, {_SPLIT(2)} AS core, {_SPLIT(3)} AS suffix FROM words), "
    f"nined AS (SELECT *, {_NINE} AS nine FROM cut), "
    f"cores AS (SELECT DISTINCT core, list_filter(range(1, length(core) + 1), lambda i: contains('{''.join(_MIS)}', substr(core, i::INTEGER, 1))) AS spots FROM nined WHERE nine = core AND regexp_matches(core, '[{''.join(_MIS)}]')), "
    "masks AS (SELECT core, spots, unnest(range(1, 1 << len(spots)::INTEGER)) AS mask FROM cores), "
    "subs AS (SELECT core, list_filter(spots, lambda p, k: (mask >> (k - 1)::INTEGER) & 1 = 1) AS places FROM masks), "
    f"tried AS (SELECT core, places, len(places) AS n, row_number() OVER (PARTITION BY core ORDER BY len(places), places) AS i FROM subs), "
    f"cand AS (SELECT core, n, i, {_PUT} AS candidate FROM tried WHERE i <= {correction.CANDIDATES}), "
    f"freqs AS (SELECT x AS word, coalesce(a.freq, 0) + coalesce(b.freq, 0) AS f FROM (SELECT DISTINCT x FROM (SELECT core AS x FROM cores UNION ALL SELECT candidate FROM cand)) LEFT JOIN vocab a ON a.word = x LEFT JOIN vocab b ON b.word = {LOWER.format('x')}), "
    f"rated AS (SELECT c.core, c.n, c.i, c.candidate, o.f AS orig, k.f AS cf, greatest(0.0::DOUBLE, (CASE WHEN o.f = 0 THEN {_STEPS('k.f', correction.UNKNOWN_STEPS, 0.05)} ELSE {_STEPS('k.f::DOUBLE / (o.f + 1)', correction.RATIO_STEPS, 0.12)} END)::DOUBLE - ({_STEPS('o.f', correction.PENALTY_STEPS, 0.0)})::DOUBLE - (c.n - 1) * 0.05::DOUBLE) AS conf FROM cand c JOIN freqs o ON o.word = c.core JOIN freqs k ON k.word = c.candidate), "
    "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY core ORDER BY conf DESC, i) AS r FROM rated WHERE conf > 0) WHERE r = 1), "
    f"fixes AS (SELECT word, prefix || candidate || suffix AS fixed, conf, CASE WHEN conf >= {correction.APPLY} THEN 'applied' WHEN conf >= {correction.FLAG} THEN 'flagged_med' ELSE 'flagged_low' END AS action, 'char_sub' AS type, n AS n_subs, orig AS orig_freq, cf AS fixed_freq FROM nined JOIN best USING (core) WHERE nine = core AND candidate <> core "
    f"UNION ALL SELECT word, prefix || nine || suffix, 0.95, 'applied', '9_ş', 1, coalesce((SELECT freq FROM vocab v WHERE v.word = nined.word), 0) + coalesce((SELECT freq FROM vocab v WHERE v.word = {LOWER.format('nined.word')}), 0), coalesce((SELECT freq FROM vocab v WHERE v.word = prefix || nine || suffix), 0) + coalesce((SELECT freq FROM vocab v WHERE v.word = {LOWER.format('(prefix || nine || suffix)')}), 0) FROM nined WHERE nine <> core), "
    "tokens AS (SELECT word, CASE WHEN action = 'applied' THEN fixed ELSE word END AS output, fixed, round_even(conf, 3)::DOUBLE AS confidence, action, type, CAST(n_subs AS INTEGER) AS n_subs, CAST(orig_freq AS BIGINT) AS orig_freq, CAST(fixed_freq AS BIGINT) AS fixed_freq FROM fixes)"
)
_RUNS = r"regexp_extract_all(text, '[\p{L}\p{N}_‘’''\-]+|[^\p{L}\p{N}_‘’''\-]+')"
_PLACED = f"runs AS (SELECT doc_id, {_RUNS} AS rs FROM documents), placed AS (SELECT doc_id, unnest(range(0, len(rs))) AS place, unnest(rs) AS word FROM runs)"

cat.SQL["corrected_tokens"] = f"WITH {_CORRECTED} SELECT * FROM tokens"
cat.SQL["corrected_documents"] = (
    f"WITH {_CORRECTED}, {_PLACED}, changed AS (SELECT DISTINCT doc_id FROM placed JOIN tokens USING (word) WHERE output <> word) "
    "SELECT doc_id, string_agg(coalesce(output, placed.word), '' ORDER BY place) AS text FROM placed LEFT JOIN tokens ON tokens.word = placed.word WHERE doc_id IN (SELECT doc_id FROM changed) GROUP BY doc_id UNION ALL SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM changed)"
)
_CHANGES = f"{_CORRECTED}, {_PLACED}, changes AS (SELECT placed.doc_id, place, tokens.* FROM placed JOIN tokens ON tokens.word = placed.word)"
cat.SQL["document_scores"] = (
    f"WITH {_CHANGES}, lost AS (SELECT doc_id, sum(CASE WHEN action = 'applied' THEN (1 - least(confidence, 1.0)) * 10 ELSE 1.5 END) AS lost FROM changes GROUP BY 1) "
    r"SELECT doc_id, CAST(greatest(len(regexp_extract_all(text, '\S+')), 1) AS INTEGER) AS words, CAST(least(100, greatest(0, round_even(100 - coalesce(lost, 0), 0))) AS INTEGER) AS score FROM documents LEFT JOIN lost USING (doc_id)"
)


def _corrected(spark, d):
    t = table(spark, d, "documents").select("doc_id", "text")
    words = vocab.vocabulary(t)
    return correction.correct_verses(t, words, ["doc_id"])[1], words


@query("change_counts", f"WITH {_CHANGES} SELECT doc_id, count_if(action = 'applied')::BIGINT AS applied, count_if(action <> 'applied')::BIGINT AS flagged, count(*) AS total FROM changes GROUP BY 1")
def change_counts(spark, d):
    return correction.change_counts(_corrected(spark, d)[0], ["doc_id"])


@query("change_logs", f"WITH {_CHANGES} SELECT doc_id, count_if(action = 'applied')::BIGINT AS applied, count_if(action <> 'applied')::BIGINT AS flagged, count(*) AS total, string_agg(place || ' ' || word || ' > ' || fixed, ', ' ORDER BY place) AS changes, string_agg(CAST(place AS VARCHAR), ',' ORDER BY place) FILTER (WHERE action <> 'applied') AS flags FROM changes GROUP BY 1")
def change_logs(spark, d):
    changes, _ = _corrected(spark, d)
    logs = reports.book_logs(changes, ["doc_id"], ["place"]).withColumn("changes", F.array_join(F.transform("changes", lambda x: F.concat(x["place"], F.lit(" "), x["word"], F.lit(" > "), x["fixed"])), ", "))
    flags = reports.book_flags(changes, ["doc_id"], ["place"]).select("doc_id", F.array_join(F.transform("flags", lambda x: x["place"].cast("string")), ",").alias("flags"))
    return logs.join(flags, "doc_id", "left")


@query("merged_scores", r"SELECT string_agg(source || '=' || CAST(n AS VARCHAR), ',' ORDER BY source) AS scores, round_even(avg(n), 2) AS mean FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1)")
def merged_scores(spark, d):
    n = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"))
    told = reports.merged_scores(n, "source", "n")
    return told.select(F.array_join(F.transform(F.array_sort(F.map_entries("scores")), lambda x: F.concat_ws("=", x["key"], x["value"])), ",").alias("scores"), "mean")


@query("report_sections", f"WITH {VERSE}, f AS (SELECT CAST(c AS INTEGER) AS c, CAST(v AS INTEGER) AS v, CASE WHEN trim(text) = '' THEN 'EMPTY_TEXT' ELSE 'SHORT_TEXT' END AS reason, CASE WHEN trim(text) = '' THEN 'CRITICAL' ELSE 'HIGH' END AS severity, text FROM verse WHERE length(trim(text)) < 8 AND NOT contains(text, '[verse text missing')), r AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY c, v, text) AS n FROM f) SELECT severity || '/' || reason AS section, CAST(n AS INTEGER) AS n, concat_ws(' ', c || ':' || v, text) AS line FROM r WHERE n <= 20 UNION ALL SELECT severity || '/' || reason, 0, severity || ' ' || reason || ': ' || count(*) FROM f GROUP BY severity, reason")
def report_sections(spark, d):
    return reports.sections(quality.empty_or_short(lines(spark, d)))


@query("semantic_risks", f"WITH {_CHANGES}, f AS (SELECT DISTINCT word, fixed, coalesce((SELECT freq FROM vocab v WHERE v.word = t.word), 0) + coalesce((SELECT freq FROM vocab v WHERE v.word = {LOWER.format('t.word')}), 0) AS o, coalesce((SELECT freq FROM vocab v WHERE v.word = t.fixed), 0) + coalesce((SELECT freq FROM vocab v WHERE v.word = {LOWER.format('t.fixed')}), 0) AS x FROM tokens t WHERE action = 'applied') SELECT c.doc_id, CAST(c.place AS INTEGER) AS place, c.word, c.fixed FROM changes c JOIN f USING (word) WHERE c.action = 'applied' AND o >= 1 AND x >= 2 AND x / (o + 1) < 200")
def semantic_risks(spark, d):
    changes, words = _corrected(spark, d)
    return correction.semantic_risks(changes, words, 1, 200).where(F.col("fixed_freq") >= 2).select("doc_id", "place", "word", "fixed")


@query("patched_and_cut", "SELECT doc_id, CASE WHEN b.item_id IS NOT NULL AND strpos(x, '.') > 0 THEN substr(x, 1, strpos(x, '.')) ELSE x END AS text FROM (SELECT d.doc_id, b.item_id, CASE WHEN b.item_id IS NOT NULL THEN replace(d.text, ' ', '_') ELSE d.text END AS x FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id) b")
def patched_and_cut(spark, d):
    b = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"))
    patches = b.select("doc_id", F.lit(1).alias("n"), F.lit(" ").alias("old"), F.lit("_").alias("new"))
    return correction.patch_then_truncate(table(spark, d, "documents").select("doc_id", "text"), patches, ["doc_id"], b.withColumn("sentinel", F.lit(".")))
