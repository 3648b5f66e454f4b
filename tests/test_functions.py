"""Scalar functions on cases worked out by hand, and properties."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from quire.functions import cleaning as cl
from quire.functions import python as P
from quire.functions import similarity as sim
from quire.functions import strings as st


def one(spark, f, *values):
    """f of the values as string columns."""
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first()["x"]


CASES = [
    (st.turkish_lower, "ISPARTA İL", "ısparta il"),
    (st.extract_root, "kitaplardan", "kitaplar"),
    (st.extract_root, "abcdefg", "abcde"),
    (st.extract_root, "ab", "ab"),
    (st.extract_words, "Tanrı'nın evi, a 12", ["Tanrı'nın", "evi", "12"]),
    (st.strip_apostrophe, "tanrı'nın", "tanrı"),
    (st.strip_apostrophe, "'x", "'x"),
    (st.clean_x, "X this, X that, a", "this, that, a"),
    (st.dedupe_items, "4. (x) Kurtarıcı, Kurtarıcı", "4. (x) Kurtarıcı"),
    (st.dedupe_items, "a, A, -, b", "a, -, b"),
    (st.dedupe_items, "no comma", "no comma"),
    (st.dedupe_lines, "a, a\nb, b", "a\nb"),
    (lambda c: st.truncate_after(c, "son."), "a son. b", "a son."),
    (lambda c: st.truncate_after(c, "son."), "a b", "a b"),
    (st.revert_mark, "bilmiyorğ' dedi", "bilmiyor?' dedi"),
    (st.is_footnote_line, "1/2 3/4", True),
    (st.is_footnote_line, "1/2 3/4 5*", False),
    (st.ends_sentence, "Bir,", True),
    (st.ends_sentence, "Bir", False),
    (st.ends_sentence, "Bir.”  ", True),
    (st.strip_leading_quotes, "'“ Bir", "Bir"),
    (st.clean_html, "<p>a&nbsp;<b>b</b> &amp;lt;</p>\n c", "a b &lt; c"),
    (lambda c: st.clean_html(c, keep_em=True), "x <em>y</em> z", "x **y** z"),
    (st.bold_to_tags, "a **b** c", "a <b>b</b> c"),
    (st.tags_to_bold, "a <b>b</b> c", "a **b** c"),
    (st.sentences, "Bir iki. Üç dört! beş\nAltı", ["Bir iki.", "Üç dört! beş", "Altı"]),
    (st.numbered_items, "x 1. foo2. bar 33 b", [("", "x"), ("1.", "foo"), ("2.", "bar 33 b")]),
    (st.anchor, "aaaa bbbb cccc", "aaaa bbbb cccc"),
    (lambda c: st.anchor(c, 9), "aaaa bbbb cccc", "aaaa bbbb"),
    (st.verse_number, "12", 12),
    (st.verse_number, "1-3", None),
    (lambda c: st.find_from(c, F.lit("kara at gitti"), F.lit(1)), "ak kara at geldi", 4),
    (lambda c: st.find_from(c, F.lit("yok"), F.lit(1)), "ak kara", 0),
    (lambda c: st.snap_to_word(c, F.lit(5)), "bir ikisi uc", 5),
    (lambda c: st.snap_to_word(c, F.lit(6)), "bir ikisi uc", 11),
    (lambda c: st.json_array_in(c, "array<struct<id:int>>"), 'text [{"id": 1}] more', [(1,)]),
    (lambda c: st.apply_rules(c, [(r"(\d)x", "$1y")]), "1x 2X", "1y 2X"),
    (lambda c: st.stop_ratio(c, ["the", "of"]), "the king of Spain", 0.5),
    (P.stem_udf, "kitaplarından", "kitap"),
    (cl.ocr_verse, "yol - larını du-  runcaya vaf-tiz (3) söz(12)ler Mat.11/10, son 842", "yollarını duruncaya vaftiz söz ler son"),
    (cl.ocr_verse, "Baş-Melek ve ya- 123 zdı – , son (*) söz(†).", "Baş-Melek ve yazdıson söz."),
    (cl.ocr_verse, "bir 12 iki 345 üç-456 beş", "bir 12 iki üçbeş"),
    (cl.whole_words, "ev -de ev- den ev-den Ev-Den", "evde evden evden Ev-Den"),
    (lambda c: cl.strip_noise(c, ["book_references", "references", "see", "edition_mark", "roman"]), "Bak Kol.3:4 ve 5:1-3 bkz. xy ELÇ IV son", "Bak ve son"),
    (lambda c: cl.strip_noise(c, ["notes_block"]), "Söz. Dipnotları bir iki", "Söz."),
    (lambda c: cl.title_in(c, [("MARKOS", "MRK"), ("MATTA", "MAT")]), "MATTA - 1", "MAT"),
    (lambda c: cl.title_in(c, [("MARKOS", "MRK")]), "x", None),
    (cl.ordinal_chapter, "Yedinci Bölüm: x", 7),
    (cl.ordinal_chapter, "Bölüm", None),
    (cl.ascii_fold, "İYİ Şey, ışık!", "iyi sey isik"),
    (lambda c: cl.padded(c), "7", "007"),
    (lambda c: cl.is_intro(c, ["yazar"]), "Bu kitabın yazarı", True),
]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(spark, i):
    f, value, want = CASES[i]
    got = one(spark, f, value)
    assert [tuple(x) if not isinstance(x, str) else x for x in got] == want if isinstance(want, list) else got == want


def test_similarities(spark):
    assert one(spark, sim.word_jaccard, "a b c", "b c d") == 0.5
    assert one(spark, sim.word_jaccard, "", "b") == 0.0
    assert P.word_jaccard("a b c", "b, c d") == 0.5
    assert P.char_similarity("abc", "abc") == 1.0 and P.char_similarity("", "x") == 0.0
    assert P.similarity("a b", "a b") == pytest.approx(1.0)
    some_texts = ["bir iki üç", "", "Dört, beş!", "iki üç bir", "x" * 300]
    assert P.similarities(some_texts, some_texts[::-1]) == [[P.similarity(a, b) for b in some_texts[::-1]] for a in some_texts]
    assert one(spark, lambda a, b: sim.word_score(a, b), "kitaplar", "kitaplık") == 1
    assert one(spark, lambda a: sim.starts_overlap(a, F.array(F.lit("bir"), F.lit("yok"))), "bir iki") == 0.5


def test_split_token(spark):
    assert tuple(one(spark, st.split_token, "12Tanrı'nın,")) == ("12", "Tanrı'nın", ",")


def test_python_functions():
    assert P.distinct_items("1. kral, krallar, ev {x, x} ev") == "1. kral, ev{x, x}ev"
    assert P.translate_protected("from H12 and G345", str.upper) == "FROM H12 AND G345"
    assert P.translate_protected("x", lambda _: "") == "x"
    assert P.find_names("1.SAMUEL 3 - 2.SAMUEL", {"1.SAMUEL": "1SA", "2.SAMUEL": "2SA", "SAMUEL": "X"}) == ["1SA", "2SA"]
    assert P.best_window("bir iki uc dort".split(), ["uc", "dort"]) == (2, 1.0) and P.best_window(["a"], ["b"]) == (-1, 0.0)


def test_translation_keeps_the_input_on_failure(spark):
    def make():
        def translate(x):
            if "fail" in x:
                raise ValueError
            return x.upper()

        return translate

    rows = spark.createDataFrame([("some text",), ("fail here",), (None,), ("ab",)], "t string")
    assert [r["x"] for r in rows.select(P.translate_udf(make)("t").alias("x")).collect()] == ["SOME TEXT", "fail here", None, "ab"]


@settings(max_examples=5, deadline=None)
@given(some.lists(some.text(alphabet=some.characters(exclude_categories=["Cs", "Cc"]), max_size=30), min_size=1, max_size=30))
def test_tokens_give_the_text_again(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r["x"] for r in df.select(F.array_join(st.tokenise(F.col("t")), "").alias("x")).collect()] == texts
