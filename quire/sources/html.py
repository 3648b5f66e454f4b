"""Fields, verses, headings, notes and words out of HTML, with regular expressions inside Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import clean_html, clean_x, collapse, strip_tags, verse_number


def field(html: Column, pattern: str) -> Column:
    """The first group of the first match, cleaned; null if there is none."""
    return F.nullif(clean_html(F.regexp_extract(html, f"(?s){pattern}", 1)), F.lit(""))


def title(html: Column) -> Column:
    return field(html, "<title[^>]*>(.*?)</title>")


def plain(html: Column) -> Column:
    """Text without scripts, styles, comments and tags."""
    return clean_html(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "))


def labelled_fields(html: Column, labels: dict[str, str], comma_lists: tuple[str, ...] = ()) -> list[Column]:
    """One column a label: what follows the label's pattern up to the next paragraph or heading."""
    out = []
    for name, pattern in labels.items():
        x = field(html, pattern)
        out.append((clean_x(x) if name in comma_lists else x).alias(name))
    return out


def items(html: Column, heading: str, verse: str) -> Column:
    """Headings and verses in document order: array of (pos, kind, label, html).

    heading, verse: patterns with one group (text) and two groups (label, text).
    """
    both = f"(?s){heading}|{verse}"
    whole = F.regexp_extract_all(html, F.lit(both), F.lit(0))

    def item(x: Column, i: Column) -> Column:
        is_heading = x.rlike(f"(?s)^(?:{heading})$")
        return F.struct(
            i.alias("pos"), F.when(is_heading, "heading").otherwise("verse").alias("kind"), F.when(~is_heading, F.regexp_extract(x, f"(?s)^(?:{verse})$", 1)).alias("label"),
            F.when(is_heading, F.regexp_extract(x, f"(?s)^(?:{heading})$", 1)).otherwise(F.regexp_extract(x, f"(?s)^(?:{verse})$", 2)).alias("html"),
        )

    return F.transform(whole, item)


def chapter(pages: DataFrame, keys: list[str], html_col: str, heading: str, verse: str, drop: str = r"<sup[^>]*>.*?</sup>|<h6[^>]*>.*?</h6>") -> DataFrame:
    """(keys, pos, kind, label, v, text): a page's headings and verses; empty verses and repeated headings go."""
    told = pages.select(*keys, F.inline(items(F.col(html_col), heading, verse)))
    text = told.withColumn("text", clean_html(F.regexp_replace("html", f"(?s){drop}", ""), "")).where("text <> ''")
    from pyspark.sql import Window

    last = F.lag(F.when(F.col("kind") == "heading", F.col("text")), 1).over(Window.partitionBy(*keys).orderBy("pos"))
    kept = text.withColumn("before", last).where("kind = 'verse' or before is null or before <> text")
    return kept.select(*keys, "pos", "kind", "label", verse_number(F.col("label")).alias("v"), "text")


def embedded_json(html: Column, element: str, schema: str) -> Column:
    """JSON in <script id="element">."""
    return F.from_json(F.regexp_extract(html, f'(?s)<script[^>]*id="{element}"[^>]*>(.*?)</script>', 1), schema)


def notes(html: Column, pattern: str) -> Column:
    """Cleaned texts of all matches, joined by ' — '; empty if there is none."""
    found = F.regexp_extract_all(html, F.lit(f"(?s){pattern}"), F.lit(1))
    return F.array_join(F.filter(F.transform(found, lambda x: clean_html(x)), lambda x: x != ""), " — ")


def greek_words(scripture: Column) -> Column:
    """Array of words of <div style=...> blocks: w, l, tr, st, mp, gl, stv, tx, cx, var; empty ones go.

    The tags grk, gray, num, tvm, gra, blu and red hold the fields; a second num is the lexicon id.
    """
    blocks = F.regexp_extract_all(scripture, F.lit(r"(?s)<div[^>]*>.*?</div>"), F.lit(0))

    def tag(x: Column, name: str, n: int) -> Column:
        found = F.regexp_extract_all(x, F.lit(f"(?s)<{name}>(.*?)</{name}>"), F.lit(1))
        return F.trim(strip_tags(F.get(found, F.lit(n))))

    def word(x: Column) -> Column:
        first = F.coalesce(tag(x, "grk", 0), F.lit(""))
        two = tag(x, "num", 1).isNotNull()
        none = F.lit(None).cast("string")
        cols = {
            "w": first, "l": F.coalesce(tag(x, "grk", 1), first), "tr": tag(x, "gray", 0), "st": F.coalesce(tag(x, "num", 1), tag(x, "num", 0)), "mp": tag(x, "tvm", 0), "gl": tag(x, "gra", 0),
            "stv": F.when(two, F.nullif(tag(x, "num", 0), F.lit(""))).otherwise(none), "tx": F.nullif(tag(x, "blu", 0), F.lit("")), "cx": F.nullif(tag(x, "red", 0), F.lit("")),
            "var": x.rlike("^<div[^>]*background-color: ?#CCCCCC"),
        }
        return F.struct(*(c.alias(n) for n, c in cols.items()))

    return F.filter(F.transform(blocks, word), lambda w: w["w"] != "")


def hebrew_words(html: Column) -> Column:
    """Array of (w, st, tr, cx) of the parts that begin with <heb>."""
    parts = F.filter(F.split(html, "(?=<heb>)"), lambda p: p.startswith("<heb>"))

    def some(x: Column, pattern: str) -> Column:
        return F.nullif(F.trim(strip_tags(F.regexp_extract(x, f"(?s){pattern}", 1))), F.lit(""))

    def word(x: Column) -> Column:
        return F.struct(
            F.trim(F.regexp_extract(x, "(?s)<heb>(.*?)</heb>", 1)).alias("w"), some(x, r"<num>(H\d+[a-z]?)</num>").alias("st"), some(x, "color:#757575[^>]*><sup>(.*?)</sup>").alias("tr"),
            F.coalesce(some(x, "color:#2E78C2[^>]*><sup>(.*?)</sup>"), some(x, "<tvm>(.*?)</tvm>")).alias("cx"),
        )

    return F.transform(parts, word)


def ocr_lines(dump: DataFrame, first: int = 0, last: int = 1 << 30, column_x: float = 215.0, header_y: float = 0.0) -> DataFrame:
    """(page, pos, x, y, side, text, n): lines in reading order: header, left column, right column, each by y.

    Page numbers (up to four digits) and lines of two or fewer characters are noise.
    """
    from pyspark.sql import Window

    item = dump.select(F.posexplode("pages").alias("page", "p")).where(F.col("page").between(first, last)).select("page", F.posexplode("p.content").alias("pos", "i"))
    x, y = F.get(F.col("i.position"), F.lit(0)), F.get(F.col("i.position"), F.lit(1))
    told = item.select("page", "pos", x.alias("x"), y.alias("y"), collapse(F.col("i.text")).alias("text")).where(~F.col("text").rlike(r"^\d{1,4}$") & (F.length("text") > 2))
    side = F.when(F.col("y") < header_y, 0).when(F.col("x") < column_x, 1).otherwise(2)
    return told.withColumn("side", side).withColumn("n", F.row_number().over(Window.partitionBy("page").orderBy("side", "y", "pos")))
