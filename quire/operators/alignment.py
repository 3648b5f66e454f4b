"""Ownership joins, order-preserving alignment and segmentation.

Ownership is windows over a union of both sides, so nothing is joined on a range alone. Alignment and
segmentation work on one chapter at a time: the truly sequential part is a grouped map whose groups are
chapters, which are small whatever the corpus's size.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.python import best_window, similarities, similarity, stem
from ..functions.similarity import set_jaccard
from ..functions.strings import ends_sentence, normal_prefix, python_split, strip_leading_quotes
from . import windows

BEFORE_FIRST = ("none", "first")


def as_of(sources: DataFrame, targets: DataFrame, keys: list[str], at: str, columns: list[str], before_first: str = "none") -> DataFrame:
    """Targets with the `columns` of the last source at or before them.

    Targets before the first source get nulls ('none') or the first source ('first'). Of sources at one
    place the greatest columns count. One shuffle by keys, no range join.
    """
    value = F.struct(*columns)
    kinds = targets.columns
    s = sources.select(*keys, F.col(at).alias("__at"), value.alias("__v"), F.lit(0).alias("__k"), F.lit(None).cast(targets.select(F.struct(*kinds).alias("x")).schema["x"].dataType).alias("__row"))
    t = targets.select(*keys, F.col(at).alias("__at"), F.lit(None).cast(s.schema["__v"].dataType).alias("__v"), F.lit(1).alias("__k"), F.struct(*kinds).alias("__row"))
    w = Window.partitionBy(*keys).orderBy("__at", "__k", "__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = s.unionByName(t).withColumn("__o", F.last("__v", True).over(w))
    if before_first == "first":
        told = told.withColumn("__first", F.first("__v", True).over(Window.partitionBy(*keys).orderBy("__at", "__k", "__v").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        told = told.withColumn("__o", F.coalesce("__o", "__first"))
    return told.where("__k = 1").select("__row.*", *(F.col(f"__o.{c}").alias(f"owner_{c}") for c in columns))


def forward(sources: DataFrame, targets: DataFrame, keys: list[str], at: str, columns: list[str]) -> DataFrame:
    """Targets with the columns of the first source at or after them; `at` must be numeric."""
    back = lambda d: d.withColumn(at, -F.col(at))
    return as_of(back(sources), back(targets), keys, at, columns).withColumn(at, -F.col(at))


def intervals(sources: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Sources with `until`, the next source's place (exclusive); null for the last, whose interval is open."""
    return sources.withColumn("until", F.lead(at).over(Window.partitionBy(*keys).orderBy(at)))


def interval_owner(sources: DataFrame, targets: DataFrame, keys: list[str], at: str) -> DataFrame:
    """(keys, target, owner): from <= target < until, the last interval without end; targets before the first drop out."""
    own = as_of(sources.select(*keys, F.col(at).alias("__from")).withColumn(at, F.col("__from")), targets.select(*keys, at), keys, at, ["__from"])
    return own.where("owner___from is not null").select(*keys, F.col(at).alias("target"), F.col("owner___from").alias("owner"))


def best_by_jaccard(verses: DataFrame, references: DataFrame, keys: list[str], window: int = 15, chars: int = 200) -> DataFrame:
    """(keys, v, rv, common): of the references numbered v to v + window - 1 the one with the greatest word overlap.

    Numbers are cut in bands of `window`: a verse meets the references of its band and the next, so a chapter of
    any length costs what its bands do. Verses and references without words drop out; ties go to the first reference.
    """
    words = lambda x: F.array_distinct(python_split(normal_prefix(F.col(x), chars)))
    band = lambda x: F.floor(F.col(x) / window)
    x = verses.select(*keys, "v", words("text").alias("ws")).where("size(ws) > 0").withColumn("band", band("v"))
    y = references.select(*keys, F.col("v").alias("rv"), words("text").alias("rs")).where("size(rs) > 0")
    y = y.withColumn("band", F.explode(F.array(band("rv"), band("rv") - 1)))
    near = x.join(y, [*keys, "band"]).where(F.col("rv").between(F.col("v"), F.col("v") + window - 1)).withColumn("s", set_jaccard(F.col("ws"), F.col("rs")))
    best = F.max(F.struct("s", (-F.col("rv")).alias("r"), F.size(F.array_intersect("ws", "rs")).alias("common"))).alias("x")
    return near.groupBy(*keys, "v").agg(best).select(*keys, "v", (-F.col("x.r")).alias("rv"), "x.common")


def merge_blocks(blocks: DataFrame, keys: list[str], order: str = "pos") -> DataFrame:
    """(keys, v, until, text): blocks, in order, merged where one begins at or before the greatest end so far.

    blocks: (keys, order, v, until, text); `until` is the last number a block covers. A block whose
    number goes back, or is covered already, is the going-on of the block before.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.max("until").over(w.rowsBetween(Window.unboundedPreceding, -1))
    told = windows.islands(blocks.withColumn("__starts", F.col("v") > F.coalesce(before, F.col("v") - 1)), keys, F.col("__starts"), [order])
    parts = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.trim("text").alias("t")))), lambda x: x["t"])
    return told.groupBy(*keys, "island").agg(F.min_by("v", order).alias("v"), F.max("until").alias("until"), F.trim(F.array_join(parts, " ")).alias("text")).drop("island")


def place_sections(sections: DataFrame, verses: DataFrame, keys: list[str]) -> DataFrame:
    """Headings and verses in one order: a heading stands before the verse it names, or before the next there is."""
    v = verses.select(*keys, "v", F.lit(1).alias("kind"), "text")
    s = sections.select(*keys, "v", F.lit(0).alias("kind"), F.col("section").alias("text"))
    return v.unionByName(s).withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy("v", "kind", "text")))


def merge_fragments(verses: DataFrame, keys: list[str], order: str = "pos") -> DataFrame:
    """Verses that follow one without closing punctuation, merged into it; number and place are the first's."""
    w = Window.partitionBy(*keys).orderBy(order)
    starts = F.coalesce(F.lag(ends_sentence(F.col("text"))).over(w), F.lit(True))
    told = windows.islands(verses.withColumn("__starts", starts), keys, F.col("__starts"), [order])
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.trim("text").alias("t"))))
    merged = F.array_join(F.transform("parts", lambda x: x["t"]), " ")
    agg = told.groupBy(*keys, "island").agg(F.min_by("v", order).alias("v"), F.min(order).alias(order), parts.alias("parts"), F.min_by("text", order).alias("__one"))
    return agg.select(*keys, "v", order, F.when(F.size("parts") == 1, F.col("__one")).otherwise(merged).alias("text"), F.size("parts").alias("merged"))


def align(texts: list[str], numbers: list[int], refs: list[str], ref_numbers: list[int], score: Callable[[str, str], float] | None = None, least: float = 0.20) -> list[tuple[int, float]]:
    """(number, score) of each text: the strictly increasing assignment to references of the greatest total score.

    With more texts than references the numbers stay, made strictly increasing; so does a number whose
    score is under `least`. Ties go to the first reference. The default score is `similarity`.
    """
    n, m = len(texts), len(refs)
    if not m:
        return [(v, 0.0) for v in numbers]
    out: list[tuple[int, float]] = []
    if n > m:
        for v in numbers:
            out.append((max(v, out[-1][0] + 1) if out else v, 0.0))
        return out
    s = [[score(a, b) for b in refs] for a in texts] if score else similarities(texts, refs)
    total = [s[0]] if n else []
    for i in range(1, n):
        best, row = float("-inf"), []
        for j in range(m):
            row.append(s[i][j] + best)
            best = max(best, total[-1][j])
        total.append(row)
    at, chosen = m, [0] * n
    for i in reversed(range(n)):
        at = max(range(at), key=lambda j: total[i][j], default=0)
        chosen[i] = at
    for i, j in enumerate(chosen):
        out.append((ref_numbers[j], s[i][j]) if s[i][j] >= least else (max(numbers[i], out[-1][0] + 1 if out else 1), s[i][j]))
    return out


def greedy(texts: list[str], numbers: list[int], refs: list[str], ref_numbers: list[int], score: Callable[[str, str], float] = similarity, least: float = 0.25, window: int = 15) -> list[tuple[int, float]]:
    """(number, score): the best of the next `window` references from a floor that goes up, else the own number."""
    out, floor = [], 0
    for text, v in zip(texts, numbers, strict=True):
        at = bisect.bisect_left(ref_numbers, floor)
        found = [(score(text, refs[j]), -j) for j in range(at, min(at + window, len(refs)))]
        s, j = max(found, default=(-1.0, 0))
        number = ref_numbers[-j] if s >= least else max(v, floor)
        out.append((number, max(s, 0.0)))
        floor = number + 1
    return out


def _two_sided(left: DataFrame, right: DataFrame, keys: list[str], f: Callable, **more) -> DataFrame:
    """Chapters of both sides through f(texts, numbers, refs, ref_numbers); chapters of one side drop out."""
    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return (b if a.empty else a)[[*keys, "pos", "v"]].iloc[:0].assign(new_v=pd.Series(dtype="int32"), score=pd.Series(dtype="float64"))
        a, b = a.sort_values(["pos"]), b.drop_duplicates("v", keep="last").sort_values("v")
        got = f(a["text"].fillna("").tolist(), a["v"].tolist(), b["text"].fillna("").tolist(), b["v"].tolist(), **more)
        out = a[[*keys, "pos", "v"]].copy()
        out["new_v"], out["score"] = [x for x, _ in got], [x for _, x in got]
        return out

    kinds = dict(left.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", pos int, v int, new_v int, score double"
    # aliases give both sides columns of their own, should they come from one frame
    new = lambda n, k: F.col(n).cast(k).alias(n)
    cut = lambda d: d.where("v is not null").select(*(F.col(k).alias(k) for k in keys), new("pos", "int"), new("v", "int"), F.concat("text", F.lit("")).alias("text"))
    return cut(left).groupBy(*keys).cogroup(cut(right).groupBy(*keys)).applyInPandas(run, schema)


def align_chapters(verses: DataFrame, references: DataFrame, keys: list[str], least: float = 0.20) -> DataFrame:
    """(keys, pos, v, new_v, score) of every verse of chapters that both sides have."""
    return _two_sided(verses, references, keys, align, least=least)


def renumber(verses: DataFrame, references: DataFrame, keys: list[str], least: float = 0.25, window: int = 15) -> DataFrame:
    return _two_sided(verses, references, keys, greedy, least=least, window=window)


SPLIT = r"[.!»'] ?\?(?=[A-ZÇĞIÖŞÜ])|[.!»']\s+\?(?=[A-ZÇĞIÖŞÜ])"


def split_markers(verses: DataFrame, keys: list[str]) -> DataFrame:
    """Verses with a misread marker ('. ?Capital') as two rows: (keys, pos, part, v, text); v of part 1 is null."""
    at = F.regexp_instr("text", F.lit(SPLIT))
    parts = F.when(at > 0, F.array(
        F.struct(F.lit(0).alias("part"), F.col("v").cast("int").alias("v"), F.trim(F.substring("text", F.lit(1), at)).alias("text")),
        F.struct(F.lit(1).alias("part"), F.lit(None).cast("int").alias("v"), F.trim(F.regexp_replace(F.substring("text", at + 1, F.length("text")), r"^\s*\?", "")).alias("text")),
    )).otherwise(F.array(F.struct(F.lit(0).alias("part"), F.col("v").cast("int").alias("v"), F.col("text").alias("text"))))
    return verses.select(*keys, "pos", F.inline(parts))


def number_splits(split: DataFrame, verses: DataFrame, references: DataFrame, keys: list[str], least: float = 0.20, window: int = 15) -> DataFrame:
    """`split_markers` rows with part 1 numbered by the best of the next references, else the number after part 0's."""
    from ..functions.python import blend_sim

    first = verses.select(*keys, "pos", F.col("v").cast("int").alias("__v"))
    second = split.where("part = 1").join(first, [*keys, "pos"])
    ref = references.select(*keys, F.col("v").cast("int").alias("rv"), F.col("text").alias("rt"), F.row_number().over(Window.partitionBy(*keys).orderBy("v")).alias("k"))
    # the references after a verse are those of the next ranks, so ranks are joined
    told = as_of(ref.select(*keys, F.col("rv").alias("__v"), "k"), second, keys, "__v", ["k"])
    ranks = told.withColumn("k", F.explode(F.sequence(F.coalesce("owner_k", F.lit(0)) + 1, F.coalesce("owner_k", F.lit(0)) + window)))
    near = ranks.join(ref, [*keys, "k"])
    best = near.withColumn("s", blend_sim("text", "rt")).groupBy(*keys, "pos").agg(F.max(F.struct("s", (-F.col("rv")).alias("r"))).alias("x"))
    told = second.join(best, [*keys, "pos"], "left").select(*keys, "pos", "part", F.when(F.col("x.s") >= least, -F.col("x.r")).otherwise(F.col("__v") + 1).alias("v"), "text")
    return split.where("part = 0").unionByName(told)


def rebuild(verses: DataFrame, references: DataFrame, keys: list[str]) -> DataFrame:
    """Leading quotes off, fragments merged, numbers aligned, markers split, first of each number kept."""
    clean = verses.where("v is not null").withColumn("text", strip_leading_quotes(F.col("text")))
    merged = merge_fragments(clean, keys)
    numbered = merged.join(align_chapters(merged, references, keys).select(*keys, F.col("pos").cast(dict(merged.dtypes)["pos"]).alias("pos"), "new_v"), [*keys, "pos"], "left")
    numbered = numbered.select(*keys, "pos", F.coalesce("new_v", "v").cast("int").alias("v"), "text")
    out = number_splits(split_markers(numbered, keys), numbered, references, keys)
    w = Window.partitionBy(*keys, "v").orderBy("pos", "part")
    return out.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "part")


def _places(words: list[str], anchors: list[list[str]], fuzzy: bool) -> list[int | None]:
    """Where each anchor begins, each after the one before; ever shorter beginnings of it, then (fuzzy) stems."""
    out: list[int | None] = []
    at = 0
    for a in anchors:
        hit = None
        for n in range(len(a), 0, -1):
            hit = next((i for i in range(at, len(words) - n + 1) if words[i : i + n] == a[:n]), None)
            if hit is not None:
                break
        if hit is None and fuzzy and a:
            i, _ = best_window([stem(w) for w in words[at:]], [stem(w) for w in a])
            hit = at + i if i >= 0 else None
        out.append(hit)
        at = hit + 1 if hit is not None else at
    return out


def _interpolated(places: list[int | None], end: int) -> list[int]:
    """Unknown places on the line between known neighbours; the ends are 0 and `end`."""
    known = [(-1, 0), *((i, p) for i, p in enumerate(places) if p is not None), (len(places), end)]
    out = []
    for i, p in enumerate(places):
        if p is None:
            (i0, p0), (i1, p1) = max(k for k in known if k[0] < i), min(k for k in known if k[0] > i)
            p = p0 + (p1 - p0) * (i - i0) // (i1 - i0)
        out.append(p)
    return out


def segment(text: str, anchors: list[list[str]], missing: str = "interpolate", fuzzy: bool = False, snap: bool = False) -> list[str]:
    """A text cut in as many parts as there are anchors (the first words of each part elsewhere).

    missing: parts whose anchor isn't found begin on the line between their neighbours ('interpolate') or
    stay empty ('empty'). snap: a cut moves back to the start of its sentence if that is within 5 words.
    The first part begins at the start. Joined by spaces, the parts are the text's words.
    """
    raw = text.split()
    words = [re.sub(r"[^\w]", "", w.lower()) for w in raw]
    norm = [[re.sub(r"[^\w]", "", w.lower()) for w in a] for a in anchors]
    if not anchors:
        return []
    places = [0, *_places(words[1:], norm[1:], fuzzy)] if len(anchors) > 1 else [0]
    places = [p if p is None or i == 0 else p + 1 for i, p in enumerate(places)]
    if missing == "interpolate":
        places = _interpolated(places, len(words))
    if snap:
        for i, p in enumerate(places):
            if p and i:
                back = next((q for q in range(p, max(0, p - 6), -1) if raw[q - 1][-1:] in ".!?"), p)
                places[i] = back
    out, known = [""] * len(anchors), [(i, p) for i, p in enumerate(places) if p is not None]
    floor = 0
    for k, (i, p) in enumerate(known):
        end = known[k + 1][1] if k + 1 < len(known) else len(raw)
        start, end = max(floor, p), max(floor, end)
        out[i] = " ".join(raw[start:end])
        floor = max(floor, end)
    return out


def repair_empty(parts: list[str]) -> list[str]:
    """Empty parts get half of the words of the part before them, if it has two or more."""
    out = list(parts)
    for i in range(1, len(out)):
        if not out[i] and len(w := out[i - 1].split()) > 1:
            out[i - 1], out[i] = " ".join(w[: (len(w) + 1) // 2]), " ".join(w[(len(w) + 1) // 2 :])
    return out


def segment_chapters(blocks: DataFrame, references: DataFrame, keys: list[str], words: int = 5, before_first: str = "first", missing: str = "interpolate", fuzzy: bool = False, snap: bool = False, repair: bool = True) -> DataFrame:
    """(keys, v, owner, text): each block's text cut along the reference verses that it owns.

    blocks: (keys, v, text), a block owning the reference verses up to the next block's number; what
    `as_of` says of verses before the first. references: (keys, v, text), whose first words are anchors.
    """
    ref = references.where("v is not null").select(*keys, F.col("v").cast("int").alias("v"), F.slice(F.filter(F.split("text", r"\s+"), lambda w: w != ""), 1, words).alias("anchor"))
    own = as_of(blocks.select(*keys, F.col("v").cast("int").alias("v"), "text"), ref, keys, "v", ["v", "text"], before_first)
    parts = F.array_sort(F.collect_list(F.struct("v", "anchor")))
    grouped = own.where("owner_v is not null").groupBy(*keys, "owner_v").agg(F.first("owner_text").alias("text"), parts.alias("parts"))

    @F.pandas_udf("array<string>")
    def cut(text: pd.Series, targets: pd.Series) -> pd.Series:
        def one(t: str, ps) -> list[str]:
            got = segment(t or "", [list(p["anchor"]) for p in ps], missing, fuzzy, snap)
            return repair_empty(got) if repair else got

        return pd.Series([one(t, ps) for t, ps in zip(text, targets, strict=True)])

    told = grouped.withColumn("texts", cut("text", "parts")).select(*keys, "owner_v", F.inline(F.arrays_zip(F.transform("parts", lambda p: p["v"]).alias("v"), "texts")).alias("v", "text"))
    empty = own.where("owner_v is null").select(*keys, F.lit(None).cast("int").alias("owner_v"), "v", F.lit("").alias("text"))
    return told.unionByName(empty).select(*keys, "v", F.col("owner_v").alias("owner"), "text")


def segment_flat(chapters: DataFrame, references: DataFrame, keys: list[str], words: int = 5) -> DataFrame:
    """A chapter's whole text cut along all reference verses of the chapter. chapters: (keys, text)."""
    return segment_chapters(chapters.select(*keys, F.lit(0).alias("v"), "text"), references, keys, words).drop("owner")


def valid_segmentation(text: Column, parts: Column) -> Column:
    """Whether parts, joined, hold the text's words in order and none is empty."""
    words = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    return (words(F.array_join(parts, " ")) == words(text)) & ~F.exists(parts, lambda p: F.trim(p) == "")


def ocr_state(lines: list[tuple[str, int | None, int | None]]) -> list[tuple[str | None, int, int, str]]:
    """(book, chapter, verse, text) of lines in reading order: (text, page header's book ordinal or None, marker or None).

    A header changes the book; a marker of 1 after a greater one, or a big jump back, begins a chapter;
    other lines belong to the verse before.
    """
    out: list[list] = []
    book, chapter, verse = None, 0, 0
    for text, header, marker in lines:
        if header is not None and header != book:
            book, chapter, verse = header, 0, 0
        if marker is not None:
            if marker == 1 or not chapter or marker < verse - 5:
                chapter += 1
            verse = marker
            out.append([book, chapter, verse, text])
        elif out and out[-1][0] == book:
            joined = out[-1][3]
            out[-1][3] = joined[:-1] + text if joined.endswith("-") else f"{joined} {text}"
    return [tuple(x) for x in out]


def extract_ocr(lines: DataFrame, headers: DataFrame, source: str = "source") -> DataFrame:
    """(source, b, c, v, text) of OCR lines: (source, page, n, text); headers: (source, page, b).

    The state machine is sequential, so a scanned volume is one group; volumes run in parallel.
    """
    told = lines.join(headers, [source, "page"], "left")

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["page", "n"])
        rows = []
        for text, b in zip(f["text"], f["b"], strict=True):
            m = re.match(r"^(\d{1,3})(?!\d)[.\s]*(.*)$", text)
            rows.append((m[2] if m else text, None if pd.isna(b) else b, int(m[1]) if m else None))
        got = ocr_state(rows)
        return pd.DataFrame([(f[source].iloc[0], *x) for x in got], columns=[source, "b", "c", "v", "text"])

    return told.groupBy(source).applyInPandas(run, f"{source} {dict(lines.dtypes)[source]}, b string, c int, v int, text string")


def similarity_matrix(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, v, rv, score) of all pairs of verses of one chapter."""
    from ..functions.python import blend_sim

    r = right.select(*keys, F.col("v").alias("rv"), F.col("text").alias("rt"))
    return left.join(r, keys).select(*keys, "v", "rv", blend_sim("text", "rt").alias("score"))
