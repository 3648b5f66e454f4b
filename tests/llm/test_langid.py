import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from quire.llm import langid, queries


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    lab = langid.Labeller(langid.Model(["a", "b", "c"], np.zeros((langid._BUCKETS, 3), np.float32), {}, 2.0))
    lab.scores[:50] = rng.normal(size=(50, 3)) * 2
    docs = [list(rng.integers(0, 50, n)) for n in (0, 1, 5, 7, 0, 6, 3, 3)]

    def score(d, p):
        return sum(lab.scores[w, x] for w, x in zip(d, p, strict=True)) - 2.0 * sum(x != y for x, y in itertools.pairwise(p))

    for d, p in zip(docs, lab.paths(docs), strict=True):
        assert len(p) == len(d)
        if d:
            assert abs(max(score(d, q) for q in itertools.product(range(3), repeat=len(d))) - score(d, p)) < 1e-4


def _toy(spark):
    en = "the of and to in is that it was for on are with they this have from one had word".split()
    de = "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch".split()
    ru = "и в не на я быть он с что а по это она этот к но они мы весь".split()
    rows = [(i, " ".join(np.random.default_rng(i).choice(ws, 40)), lang) for lang, ws in (("en", en), ("de", de), ("ru", ru)) for i in range({"en": 0, "de": 100, "ru": 200}[lang], {"en": 40, "de": 140, "ru": 240}[lang])]
    return langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), penalty=4.0)


def test_mixed_text_is_cut_in_spans(spark):
    model = _toy(spark)
    text = "the word that was for this and they are with it der die und den von das mit sich nicht ein auch и в не на что это она"
    row = langid.predict(spark.createDataFrame([(text,)], "text string"), model).first()
    assert [s["lang"] for s in row["__spans"]] == ["en", "de", "ru"]
    assert row["__spans"][0]["words"] in (10, 11, 12) and sum(s["words"] for s in row["__spans"]) == len(text.split())


def test_script_narrows_candidates(spark):
    model = _toy(spark)
    assert langid.script("слово") == "cyrillic" and langid.script("word") == "latin" and langid.script("ひ") == "kana"
    s = model.words(["ъъъ", "qqq", "ひらがな"])
    assert model.languages == ["de", "en", "ru"] and s[0].argmax() == 2 and s[1].argmax() != 2 and not s[2].any()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = queries.op1_language_id(spark, d)
    rows = got.join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]
    assert sum(held) >= 0.98 * len(held)


def test_n_gram_counts_against_plain_loops(spark):
    rows = [(1, "Aé bc, bc 12", "x"), (2, "bc d", "x"), (3, "éé", "y")]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts = np.full((langid._BUCKETS, 2), 0.5)
    for _, text, lang in rows:
        for w in langid._WORD.findall(text):
            raw = b"\x02" + w.lower().encode() + b"\x03"
            for n in (1, 2, 3, 4):
                for i in range(len(raw) - n + 1):
                    h = 0
                    for c in raw[i : i + n]:
                        h = (h * 1_000_003 + c + 1) % 2**64
                    counts[(h * 0x9E3779B97F4A7C15 % 2**64 >> 48) % langid._BUCKETS, "xy".index(lang)] += 1
    assert model.languages == ["x", "y"] and np.allclose(model.log_prob, np.log(counts / counts.sum(axis=0)), atol=1e-5)


def test_rows_against_the_labels_of_their_words(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(langid.training(docs, F.lit(True)))
    labeller = langid.Labeller(model)
    for r in langid.predict(docs, model).collect():
        words, labels = next(labeller.label([r["text"] or ""]))
        letters = {x: sum(len(w) for w, k in zip(words, labels, strict=True) if model.languages[k] == x) for x in model.languages}
        assert (r["__lang"], r["__score"]) == (max(model.languages, key=lambda x: letters[x]), max(letters.values()) / sum(letters.values())) if words else ("und", 0.0)
        assert [tuple(s) for s in r["__spans"]] == langid.spans(words, labels, model.languages)


def test_numerals_and_marks(spark):
    model = _toy(spark)
    rows = langid.predict(spark.createDataFrame([("½ ² Ⅷ ١٢",), ("ไม่ใช่",)], "text string"), model).collect()
    assert (rows[0]["__lang"], rows[0]["__score"]) == ("und", 0.0) and rows[1]["__spans"][0]["words"] == 1


def test_odd_rows(spark, odd, empty):
    model = langid.fit(langid.training(odd, F.lit(True)))
    rows = langid.predict(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r["__lang"] == "und") == (not any(map(str.isalpha, r["text"] or "")))
    assert langid.predict(empty, model).collect() == []
    none = langid.fit(langid.training(empty, F.lit(True)))
    assert {r["__lang"] for r in langid.predict(odd, none).collect()} == {"und"}
