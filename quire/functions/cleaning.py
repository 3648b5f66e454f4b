"""Cleaners for scanned and scraped verse text: each is an ordered list of patterns, applied inside Spark."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import apply_rules, collapse

_L, _S = r"[A-Za-zÀ-ÿğüşıöçĞÜŞİÖÇ]", "[a-zğüşıöç]"
#: What a scan leaves in a verse (fixed values): a page's number, a note's mark, a reference to another book.
PAGE, NOTE, ELSEWHERE = r"\d{3,}", r"\((?:\d+|[*§‡+†])\)", r"(?<!\p{L})\p{L}+\.\d+/\d+[,\s]?"
#: Kinds of noise that `strip_noise` takes out, by name (fixed values).
NOISE = {
    "book_references": r"(?<![\p{L}\p{N}])[1-3]?\p{L}{1,4}\.\s*\d+:\d+(?:-\d+)?",
    "references": r"(?<![\p{L}\p{N}])\d{1,3}:\d{1,3}(?:-\d{1,3})?(?![\p{L}\p{N}])",
    "see": r"(?i)(?<!\p{L})bkz\.?\s*\S*",
    "notes_heading": r"(?i)Dipnotlar[ıi](?!\p{L})",
    "notes_block": r"(?s)(?<!\p{L})Dipnotlar[ıi](?!\p{L}).*$",
    "sources_heading": r"(?i)Kaynak\s+ayetler(?!\p{L})",
    "sources_block": r"(?s)Kaynak\s+ayetler?(?!\p{L}).*$",
    "edition_mark": r"(?<!\p{L})ELÇ(?!\p{L})",
    "roman": r"(?<![\p{L}\p{N}])(?:X{1,3}(?:IX|IV|V?I{0,3})|IX|IV|VI{0,3}|I{1,3})(?![\p{L}\p{N}])",
    "numbers": r"(?<![\p{L}\p{N}])\d{1,3}(?![\p{L}\p{N}])",
    "digit": r"(?<![\p{L}\p{N}])\d(?![\p{L}\p{N}])",
    "headings": r">{1,3}[^<\n]*",
    "marks": r"(?<=\p{L})!|[§!]{1,3}",
    "stuck_letter": r"(?<![\p{L}\p{N}])[a-z](?=[A-ZÇĞİÖŞÜ])",
    "orphan_x": r"(?<![\p{L}\p{N}])X(?![\p{L}\p{N}])",
    "trailing_references": r"\s+[\d:;.,\- ]{10,}$",
    "trailing_number": r"\s+\d+\s*$",
}
ORDINALS = {"Birinci": 1, "İkinci": 2, "Üçüncü": 3, "Dördüncü": 4, "Beşinci": 5, "Altıncı": 6, "Yedinci": 7, "Sekizinci": 8, "Dokuzuncu": 9, "Onuncu": 10}


def whole_words(text: Column) -> Column:
    """Words that a line's end cut in two, joined: the hyphen goes with the white space, the page's number or the
    comma beside it. A hyphen between letters without any of these goes only before a small letter."""
    wide = rf"\s+[-–]\s*[,.]?\s*(?={_L})|-(?:\s+|\s*{PAGE}\s+)(?={_L})"
    return F.regexp_replace(text, f"(?<={_L})(?:{wide}|-(?={_S}))", "")


def ocr_verse(text: Column) -> Column:
    """A scanned verse without page numbers, note marks and references; a mark between two letters leaves a space."""
    numbered = F.regexp_replace(whole_words(text), rf"\s{PAGE}(?!\S)", " ")
    outside = F.regexp_replace(numbered, f"{NOTE}(?!{_L})|(?<!{_L}){NOTE}", "")
    return collapse(F.regexp_replace(F.regexp_replace(outside, NOTE, " "), ELSEWHERE, ""))


def strip_noise(text: Column, kinds: Iterable[str], gap: str = " ") -> Column:
    """The text without the kinds of noise named, in their order, each replaced by `gap`."""
    return collapse(apply_rules(text, [(NOISE[k], gap) for k in kinds]))


def straight_apostrophes(text: Column) -> Column:
    return F.translate(text, "’‘", "''")


def is_intro(text: Column, patterns: Iterable[str] = (), longest: int = 500) -> Column:
    out = F.length(text) > longest
    for p in patterns:
        out = out | text.rlike(p)
    return out


def title_in(text: Column, titles: Iterable[tuple[str, str]]) -> Column:
    """The code of the first title that the text contains; null if none."""
    return F.coalesce(*(F.when(F.contains(text, F.lit(t)), F.lit(code)) for t, code in titles), F.lit(None).cast("string"))


def ordinal_chapter(text: Column) -> Column:
    """The chapter of a heading such as 'Yedinci Bölüm:'; null if there is none."""
    names = F.create_map(*(F.lit(x) for kv in ORDINALS.items() for x in kv))
    found = F.regexp_extract(text, rf"({'|'.join(ORDINALS)})\s+Bölüm\s*:", 1)
    return F.element_at(names, F.nullif(found, F.lit("")))


def padded(number: Column, width: int = 3) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def ascii_fold(text: Column) -> Column:
    """Lower case without Turkish marks, letters and digits only: for matching."""
    folded = F.translate(F.lower(F.translate(text, "İI", "iı")), "ıüöşçğâîû", "iuoscgaiu")
    return collapse(F.regexp_replace(folded, r"[^a-z0-9\s]", ""))
