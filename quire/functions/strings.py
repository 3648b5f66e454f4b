"""Text functions as Column expressions, all inside whole-stage code generation.

Character classes are spelled out with \\p{L} and \\p{N}: \\w and \\b are ASCII in Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = r"\p{L}\p{N}_‘’'\-"
LETTERS = "a-zA-ZÇçĞğİıÖöŞşÜü"
#: Suffixes of `extract_root` (fixed values).
ROOT_SUFFIXES = """
acağınız eceğiniz lacağınız landırdığı leştirilmiş leşmekten laştığından laştığı larından larınızı larımızı
larımızın layıcısı maktadırlar maktadır lılığından ılığından tıracağını lılığını leşmek malıdır meliyiz larında
larının larını ından ınkine üğünü ığından acağı eceği tirilmiş dırdığı ırdığı dığını yıcı ıcı ların lerin andan
enden madan meden lara lere dan den tan ten nın nin nün nun mak mek miş mış müş muş ler lar yım yiz dı di du dü
ın in un ün da de ta te na ne ya ye yı yi yü yu ım im um üm nı ni nu nü
""".split()


def turkish_lower(text: Column) -> Column:
    """Lower case with dotted and dotless i told apart: İ to i, I to ı."""
    return F.lower(F.translate(text, "İI", "iı"))


def tokenise(text: Column) -> Column:
    """Runs of word characters and runs of others, in turn; joined they give the text again."""
    return F.regexp_extract_all(text, F.lit(f"[{_WORD}]+|[^{_WORD}]+"), F.lit(0))


def extract_words(text: Column, least: int = 2) -> Column:
    """Words (letters, digits, _, apostrophes, hyphens) of `least` or more characters."""
    return F.filter(F.regexp_extract_all(text, F.lit(f"[{_WORD}]+"), F.lit(0)), lambda w: F.length(w) >= least)


def letter_tokens(text: Column, least: int = 2) -> Column:
    """Lower-case runs of letters and apostrophes of `least` or more characters."""
    return F.filter(F.regexp_extract_all(turkish_lower(text), F.lit(r"[\p{L}'’]+"), F.lit(0)), lambda w: F.length(w) >= least)


def inner_apostrophe_tokens(text: Column) -> Column:
    """Runs of letters that may hold single apostrophes."""
    return F.regexp_extract_all(text, F.lit(r"\p{L}+(?:'\p{L}+)*"), F.lit(0))


def python_split(text: Column) -> Column:
    """Parts between runs of white space, without empty ones."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def stop_word_tokens(text: Column, stop: Iterable[str], least: int = 3) -> Column:
    """Lower-case words without punctuation, of `least` or more characters, neither numbers nor in `stop`."""
    bare = F.transform(python_split(turkish_lower(text)), lambda w: F.regexp_replace(strip_apostrophe(w), r"[^\p{L}\p{N}_\-]", ""))
    stop = F.array(*map(F.lit, stop)) if stop else F.array().cast("array<string>")
    return F.filter(bare, lambda w: (F.length(w) >= least) & ~w.rlike(r"^\p{N}+$") & ~F.array_contains(stop, w))


def extract_root(word: Column, suffixes: Iterable[str] = tuple(ROOT_SUFFIXES)) -> Column:
    """The word without its longest suffix that leaves 3 characters; else its first max(4, length - 2)."""
    w = turkish_lower(word)
    stem = F.regexp_extract(w, f"^(.{{3,}}?)(?:{'|'.join(suffixes)})$", 1)
    return F.when(stem != "", stem).otherwise(F.substring(w, F.lit(1), F.greatest(F.lit(4), F.length(w) - 2)))


def strip_apostrophe(word: Column) -> Column:
    """What is before an apostrophe that isn't first; of the three kinds ', ’ and ‘ in this order."""
    kinds = ("'", "’", "‘")
    cases = [F.when(F.instr(word, k) > 1, F.substring_index(word, k, 1)) for k in kinds]
    # substring_index cuts at the first; a word that begins with the same mark is left to the next kind
    return F.coalesce(*cases, word)


def split_token(word: Column) -> Column:
    """Struct of the parts before, in and after the run of letters and apostrophes."""
    p = f"(?s)^([^{LETTERS}]*)([{LETTERS}'‘’]*)(.*)$"
    return F.struct(*(F.regexp_extract(word, p, i).alias(n) for i, n in ((1, "prefix"), (2, "core"), (3, "suffix"))))


def normal_prefix(text: Column, n: int) -> Column:
    """Lower case without punctuation, its first n characters, trimmed."""
    return F.trim(F.substring(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_\s]", ""), 1, n))


def first_words(text: Column, n: int) -> Column:
    return F.slice(python_split(text), 1, n)


def anchor(text: Column, chars: int = 55) -> Column:
    """The first words whose join is within `chars` characters."""
    step = lambda acc, w: F.when((F.length(acc) + F.length(w) + F.when(acc == "", 0).otherwise(1)) <= chars, F.concat_ws(" ", F.nullif(acc, F.lit("")), w)).otherwise(acc)
    return F.aggregate(python_split(text), F.lit(""), step)


#: Named character entities that are decoded (fixed values); &amp; comes last.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}


def strip_tags(html: Column, gap: str = "") -> Column:
    return F.regexp_replace(html, "<[^>]+>", gap)


def decode_entities(text: Column) -> Column:
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def clean_html(html: Column, gap: str = " ", keep_em: bool = False) -> Column:
    """Plain text of a fragment; with keep_em, <em> becomes a pair of **."""
    if keep_em:
        html = F.regexp_replace(html, "(?s)<em>(.*?)</em>", "**$1**")
    return collapse(decode_entities(strip_tags(html, gap)))


def bold_to_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\*\*(.+?)\*\*", "<b>$1</b>")


def tags_to_bold(text: Column) -> Column:
    return F.regexp_replace(text, "(?s)<b>(.*?)</b>", "**$1**")


def clean_x(text: Column) -> Column:
    """Items of a comma list without a leading 'X '."""
    return F.array_join(F.transform(F.split(text, ","), lambda p: F.trim(F.regexp_replace(F.trim(p), r"^X\s+", ""))), ", ")


def fold_replaces(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal replacements, in order."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def apply_rules(text: Column, rules: Iterable[tuple[str, str]], ignore_case: bool = False) -> Column:
    """Regular-expression replacements, in order; `$1` in the new text is a group."""
    for pattern, new in rules:
        text = F.regexp_replace(text, ("(?i)" if ignore_case else "") + pattern, new)
    return text


def truncate_after(text: Column, sentinel: str) -> Column:
    """Up to and with the first sentinel; the text as it is where there is none."""
    at = F.instr(text, sentinel)
    return F.when(at > 0, F.substring(text, F.lit(1), at + len(sentinel) - 1)).otherwise(text)


def revert_mark(text: Column) -> Column:
    """ğ before an apostrophe at the end of a word back to a question mark."""
    return F.regexp_replace(text, r"ğ(['’])(?!\p{L})", "?$1")


def strip_leading_quotes(text: Column) -> Column:
    return F.regexp_replace(text, "^['\"‘’‚‛“”]+\\s*", "")


def sentences(text: Column) -> Column:
    """Parts that begin after . ! or ? and white space before a capital, and after new lines."""
    parts = F.split(text, r"(?<=[.!?])\s+(?=\p{Lu})|\n+")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda s: s != "")


def numbered_items(text: Column) -> Column:
    """Array of (number, body) of '1. foo2. bar'; text before the first number has an empty one."""
    found = F.regexp_extract_all(text, F.lit(r"\d+\.[^\d]*(?:\d+(?!\.|\d)[^\d]*)*|^[^\d]+"), F.lit(0))
    item = lambda x: F.struct(F.regexp_extract(x, r"^(\d+\.)?", 0).alias("number"), F.trim(F.regexp_replace(x, r"^\d+\.", "")).alias("body"))
    return F.filter(F.transform(found, item), lambda x: (x["number"] != "") | (x["body"] != ""))


def bare_item(text: Column) -> Column:
    """An item's letters and digits, lower case, without its number and bracketed qualifiers."""
    t = F.regexp_replace(F.regexp_replace(F.trim(text), r"^\d+\.\s*", ""), r"\([^)]*\)\s*", "")
    return F.lower(F.regexp_replace(t, r"[^\p{L}\p{N}_]", ""))


def dedupe_items(line: Column) -> Column:
    """A comma list without items whose bare form came before; bare-less items stay; without a comma as it is."""
    items = F.transform(F.split(line, ","), lambda x: F.trim(x))
    keep = F.filter(items, lambda x, i: (bare_item(x) == "") | (F.array_position(F.transform(items, bare_item), bare_item(x)) == i + 1))
    return F.when(F.instr(line, ",") > 0, F.array_join(keep, ", ")).otherwise(line)


def dedupe_lines(text: Column) -> Column:
    """`dedupe_items` for each line."""
    return F.array_join(F.transform(F.split(text, "\n"), dedupe_items), "\n")


def snippet(text: Column, at: Column, around: int) -> Column:
    """The characters up to `around` before and after the 1-based place `at`."""
    start = F.greatest(F.lit(1), at - around)
    return F.substring(text, start, at + around - start)


def find_from(text: Column, key: Column, start: Column) -> Column:
    """The 1-based place of `key` from `start` on, or of ever shorter beginnings of it (words), 0 if none."""
    words = F.split(key, " ")
    beginning = lambda n: F.array_join(F.slice(words, F.lit(1), n), " ")
    shorter = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.call_function("locate", beginning(n), text, start))
    return F.coalesce(F.get(F.filter(shorter, lambda p: p > 0), F.lit(0)), F.lit(0))


def snap_to_word(text: Column, at: Column) -> Column:
    """The first place at or after `at` (1-based) where a word begins."""
    rest = F.substring(text, at, F.length(text))
    begun = (at <= 1) | F.substring(text, at - 1, F.lit(1)).rlike(r"\s")
    return F.when(begun, at).otherwise(at + F.length(F.regexp_extract(rest, r"^\S*\s*", 0)))


def reference(*parts: Column, sep: str = ".") -> Column:
    return F.concat_ws(sep, *(p.cast("string") for p in parts))


def first_non_empty(*columns: Column) -> Column:
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), F.lit(""))


def labelled(*fields: tuple[str, Column, int], sep: str = " | ") -> Column:
    """'name: value' of the fields that have one, each cut to its length, joined."""
    return F.concat_ws(sep, *(F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{n}: "), F.substring(c, 1, k))) for n, c, k in fields))


def json_array_in(text: Column, schema: str) -> Column:
    """The first [...] of free text as an array; null if it doesn't parse."""
    return F.from_json(F.regexp_extract(text, r"(?s)\[.*\]", 0), schema)


def verse_number(label: Column) -> Column:
    """The number of a label of digits; null for ranges such as 1-3."""
    return F.when(label.rlike(r"^\d{1,9}$"), label.cast("int"))


def ends_sentence(text: Column) -> Column:
    """Ends with sentence or clause punctuation, a closing quote or bracket."""
    return text.rlike("[.!?»\"“”'‘’)\\]…›,;:]+\\s*$")


def is_footnote_line(text: Column) -> Column:
    """Two or more n/n and no n*."""
    return (F.regexp_count(text, F.lit(r"\d+/\d+")) >= 2) & ~text.rlike(r"\d+\*")


def stop_ratio(text: Column, stop: Iterable[str]) -> Column:
    """The share of ASCII words of two or more letters that are in `stop`; 0 for fewer than two words."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z]{2,}"), F.lit(0))
    known = F.filter(words, lambda w: w.isin(*stop))
    return F.when(F.size(words) < 2, F.lit(0.0)).otherwise(F.size(known) / F.size(words))


def escape(literal: str) -> str:
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", literal)
