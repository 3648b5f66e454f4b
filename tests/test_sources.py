"""Readers and writers on files written here."""

import json
import sqlite3

from pyspark.sql import functions as F

from quire import streaming
from quire.sources import documents as docs
from quire.sources import html
from quire.sources.sqlite import SqliteSource


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(data if isinstance(data, str) else json.dumps(data, ensure_ascii=False), "utf-8")


def tree(tmp_path):
    put(tmp_path / "in/A/MAT/1.json", {"t": "A", "b": "MAT", "c": 1, "title": "T", "content": [{"section": "Baş"}, {"v": 1, "text": "bir"}, {"v": "2-3", "text": "iki"}, {"v": 1, "text": "yine"}]})
    put(tmp_path / "in/A/MAT/10.json", {"content": [{"v": 1, "text": "on"}, {"v": 2, "text": ""}]})
    put(tmp_path / "in/B/LUK/2.json", {"content": [{"v": 5, "text": "beş"}]})
    put(tmp_path / "in/B/LUK/3.json", "{broken")
    return str(tmp_path / "in")


def test_chapter_tree(spark, tmp_path):
    ch = docs.chapters(spark, tree(tmp_path))
    assert {(r["t"], r["b"], r["c"]) for r in ch.collect()} == {("A", "MAT", 1), ("A", "MAT", 10), ("B", "LUK", 2)}
    v = docs.verses(ch)
    assert sorted((r["c"], r["pos"], r["v"], r["label"]) for r in v.where("t = 'A'").collect()) == [(1, 1, 1, "1"), (1, 2, None, "2-3"), (1, 3, 1, "1"), (10, 0, 1, "1"), (10, 1, 2, "2")]
    assert {(r["ref"], r["text"]) for r in docs.verse_map(v).where("t = 'A'").collect()} == {("MAT.1.1", "yine"), ("MAT.10.1", "on"), ("MAT.10.2", "")}
    assert [tuple(r) for r in docs.sections(ch).collect()] == [("A", "MAT", 1, 0, "Baş", 1)]
    assert {r["c"]: r["n"] for r in docs.verse_counts(ch).where("t = 'A'").collect()} == {1: 4, 10: 2}
    assert docs.chapters(spark, str(tmp_path / "in"), ["B"]).count() == 1


def test_written_chapters_read_back(spark, tmp_path):
    v = docs.verses(docs.chapters(spark, tree(tmp_path)))
    docs.write_chapters(v, str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert {(r["t"], r["b"], r["c"], len(r["content"])) for r in back.collect()} == {("A", "MAT", 1, 3), ("A", "MAT", 10, 1), ("B", "LUK", 2, 1)}
    docs.write_log(v.select("label", "text"), str(tmp_path / "log"), 2)
    assert max(len(r["text"] or "") for r in spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "log")).collect()) == 2


def test_notes_of_both_shapes(spark, tmp_path):
    put(tmp_path / "n/A_MAT.json", {"1": {"2": "düz"}})
    put(tmp_path / "n/B_MAT.json", {"3": {"4": [{"anchor": "x", "note": "bir"}, {"anchor": "y", "note": "iki"}]}})
    got = sorted((r["name"], r["c"], r["v"], r["anchor"] or "", r["note"]) for r in docs.notes(spark, str(tmp_path / "n")).collect())
    assert got == [("A_MAT", 1, 2, "", "düz"), ("B_MAT", 3, 4, "x", "bir"), ("B_MAT", 3, 4, "y", "iki")]


def test_other_documents(spark, tmp_path):
    put(tmp_path / "c/MAT/3.json", {"intro": "i", "notes": [{"ref": "1", "text": "a"}]})
    assert [tuple(r) for r in docs.commentary(spark, str(tmp_path / "c")).collect()] == [("MAT", 3, "i", 0, "1", "a")]
    put(tmp_path / "i/MAT/1.json", {"b": "MAT", "c": 1, "verses": [{"v": 1, "words": [{"w": "x", "st": "G1"}, {"w": "y", "st": "G1"}, {"w": "z"}]}]})
    words = docs.interlinear(spark, str(tmp_path / "i"))
    assert words.count() == 3 and [tuple(r) for r in docs.strong_verses(words).collect()] == [("G1", "MAT", 1, 1)]
    put(tmp_path / "l.json", [{"id": 1, "word": "a"}, {"id": 2, "error": "x"}])
    assert [r["key"] for r in docs.lexicon(spark, str(tmp_path / "l.json"), "G").collect()] == ["G1"]
    put(tmp_path / "m1.json", {"G1": "a", "G2": "b"})
    put(tmp_path / "m2.json", {"G2": "c"})
    assert {r["key"]: r["value"] for r in docs.field_map(spark, [str(tmp_path / "m1.json"), str(tmp_path / "m2.json")]).collect()} == {"G1": "a", "G2": "c"}
    put(tmp_path / "g.txt", "010101 N- x Ἰησοῦς a b\n010101 V- x εἶπεν a b\n\nshort\n010203 N- x λόγος a b\n")
    assert sorted(tuple(r) for r in docs.morph_lines(spark, str(tmp_path / "g.txt")).collect()) == [(1, 1, "Ἰησοῦς εἶπεν"), (2, 3, "λόγος")]


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "x.db")
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE Bible(Book INT, Chapter INT, Verse INT, Scripture TEXT)")
        db.executemany("INSERT INTO Bible VALUES (?, ?, ?, ?)", [(b, 1, v, f"{b}:{v}") for b in range(1, 6) for v in range(3)])
    spark.dataSource.register(SqliteSource)
    r = spark.read.format("quire_sqlite").option("path", path).option("query", "SELECT Book, Verse, Scripture FROM Bible").option("schema", "b int, v int, s string")
    want = {(b, v, f"{b}:{v}") for b in range(1, 6) for v in range(3)}
    assert {tuple(x) for x in r.load().collect()} == want
    parts = r.option("column", "Book").option("lower", 1).option("upper", 5).option("parts", 3).load()
    assert {tuple(x) for x in parts.collect()} == want and parts.count() == 15
    with sqlite3.connect(path) as db:  # bounds only set the width of ranges: these rows are outside them, or nowhere
        db.executemany("INSERT INTO Bible VALUES (?, 1, 0, 'x')", [(-7,), (900,), (None,)])
    for n in (1, 2, 3, 50):
        assert r.option("column", "Book").option("lower", 2).option("upper", 4).option("parts", n).load().count() == 18


def test_html(spark):
    page = '<h4 class="baslik">Giriş</h4><span class="verse" id="v1"><sup>1</sup>Bir <b>iki</b></span><span class="verse" id="v2-3"><sup>2-3</sup>Üç&nbsp;dört</span><h4 class="baslik">Son</h4><span class="verse" id="v4"></span>'
    df = spark.createDataFrame([("MAT", 1, page)], "b string, c int, html string")
    got = html.chapter(df, ["b", "c"], "html", r'<h4 class="baslik">(.*?)</h4>', r'<span class="verse" id="v([\d-]+)">(.*?)</span>').orderBy("pos").collect()
    assert [(r["kind"], r["label"], r["v"], r["text"]) for r in got] == [("heading", None, None, "Giriş"), ("verse", "1", 1, "Bir iki"), ("verse", "2-3", None, "Üç dört"), ("heading", None, None, "Son")]
    greek = "<div style='background-color:#CCCCCC'><grk>λόγος</grk><gray>logos</gray><num>G5</num><num>G3056</num><tvm>N</tvm><grk>λόγος2</grk><gra>word</gra></div><div><grk></grk></div>"
    w = spark.createDataFrame([(greek,)], "h string").select(html.greek_words(F.col("h")).alias("w")).first()["w"]
    assert len(w) == 1 and (w[0]["w"], w[0]["l"], w[0]["st"], w[0]["stv"], w[0]["gl"], w[0]["var"]) == ("λόγος", "λόγος2", "G3056", "G5", "word", True)
    heb = 'x<heb>אור</heb><num>H216</num><span style="color:#757575"><sup>or</sup></span><heb>ב</heb><tvm>prep</tvm>'
    h = spark.createDataFrame([(heb,)], "h string").select(html.hebrew_words(F.col("h")).alias("w")).first()["w"]
    assert [(x["w"], x["st"], x["tr"], x["cx"]) for x in h] == [("אור", "H216", "or", None), ("ב", None, None, "prep")]
    j = spark.createDataFrame([('<script id="D" type="x">{"a": {"b": 3}}</script><i>n1</i> <i>n2</i>',)], "h string")
    r = j.select(html.embedded_json(F.col("h"), "D", "a struct<b:int>").alias("j"), html.notes(F.col("h"), "<i>(.*?)</i>").alias("n")).first()
    assert r["j"]["a"]["b"] == 3 and r["n"] == "n1 — n2"


def test_ocr_reading_order(spark):
    page = {"content": [{"text": "right", "position": [300.0, 50.0]}, {"text": "left two", "position": [10.0, 60.0]}, {"text": "left one", "position": [12.0, 50.0]}, {"text": "HEADER", "position": [100.0, 5.0]}, {"text": "123", "position": [1.0, 1.0]}]}
    df = spark.createDataFrame([(json.dumps({"pages": [{"content": []}, page]}),)], "j string").select(F.from_json("j", "pages array<struct<content:array<struct<text:string,position:array<double>>>>>").alias("x")).select("x.pages")
    got = html.ocr_lines(df, header_y=20).orderBy("n").collect()
    assert [r["text"] for r in got] == ["HEADER", "left one", "left two", "right"] and {r["page"] for r in got} == {1}


def test_streaming_resumes(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    put(tmp_path / "in/1.json", {"t": "A", "b": "MAT", "c": 1, "content": [{"v": 1, "text": "bir"}]})
    streaming.incremental(spark, src, out, ck, lambda v: v.select("b", "c", "v", "text")).awaitTermination()
    put(tmp_path / "in/2.json", {"t": "A", "b": "MAT", "c": 2, "content": [{"v": 1, "text": "iki"}]})
    streaming.incremental(spark, src, out, ck, lambda v: v.select("b", "c", "v", "text")).awaitTermination()
    assert sorted(r["text"] for r in spark.read.parquet(out).collect()) == ["bir", "iki"]


def test_merge_notes(spark):
    a, b = (spark.createDataFrame(x, "c int, v int, note string") for x in ([(1, 1, "a"), (1, 2, "b")], [(1, 2, "c"), (1, 3, " ")]))
    assert {(r["v"], r["note"]) for r in docs.merge_notes(a, b, ["c", "v"]).collect()} == {(1, "a"), (2, "c")}


def test_reports(spark, tmp_path):
    from quire.sources import reports

    rows = [("MAT", 2, "b", "flagged_low"), ("MAT", 1, "a", "applied"), ("LUK", 1, "c", "applied")]
    changes = spark.createDataFrame(rows, "b string, place int, word string, action string")
    logs = {r["b"]: r for r in reports.book_logs(changes, ["b"], ["place"]).collect()}
    assert (logs["MAT"]["applied"], logs["MAT"]["flagged"], [x["word"] for x in logs["MAT"]["changes"]]) == (1, 1, ["a", "b"])
    assert [(r["b"], len(r["flags"])) for r in reports.book_flags(changes, ["b"], ["place"]).collect()] == [("MAT", 1)]
    reports.write_json(reports.book_logs(changes, ["b"], ["place"]), f"{tmp_path}/logs", ["b"])
    assert spark.read.json(f"{tmp_path}/logs").count() == 2
    found = spark.createDataFrame([("x", "MAT", 1, k, "SHORT", "HIGH", "d") for k in range(5)], "t string, b string, c int, v int, reason string, severity string, detail string")
    assert reports.report_text(reports.sections(found, 2)).split("\n") == ["HIGH SHORT: 5", "x MAT 1:0 d", "x MAT 1:1 d"]
    path = f"{tmp_path}/table"
    spark.range(5).write.parquet(path)
    reports.staged_swap(spark.read.parquet(path).where("id > 1"), path)  # it reads what it replaces
    assert spark.read.parquet(path).count() == 3 and not (tmp_path / "table.old").exists() and not (tmp_path / "table.new").exists()
