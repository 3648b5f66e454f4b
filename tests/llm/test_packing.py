import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quire.llm import packing, queries


@pytest.fixture(scope="module")
def own():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return packing.Tokenizer(f.read(), public_tokenizers.PATTERN, packing.special_tokens(public_tokenizers.path("byte_bpe_50k.json")))


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizer(own, plain, spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = random.Random(5)
    texts += ["", " ", "  a  b ", "a \n b", "don't we'll\t\tx", "é ñ 日本 語 😀", "a  b", "x " * 50 + "\n\n", "<|endoftext|> a", "a<|endoftext|>b  <|endoftext|>", " x <|endoftext|>  y\n<|endoftext|>", "<|endoftext|><|endoftext|>", "<|endoftext|", "<|<|endoftext|>|>"]
    texts += ["".join(rng.choices("ab 1\n.,'\t é", k=rng.randrange(60))) for _ in range(300)]
    for _ in range(2):  # again, with remembered parts
        got = own.ids(texts)
        assert [np.frombuffer(b, "<u4").tolist() for b in got] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def check(rows, tokens, window=1024):
    """rows against the ids of each document: every id once, in order; gapless sequences; little padding."""
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append(r)
    assert set(pieces) == set(tokens)
    for doc, ps in pieces.items():
        ids, at = tokens[doc], 0
        for p in sorted(ps, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) // 4
            assert zlib.crc32(ids[4 * at : 4 * (at + p["length"])]) == p["ids_crc32"]
            at += p["length"]
        assert 4 * at == len(ids)
    padded = 0
    for ps in seqs.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window
        padded += 0 if at & (at - 1) == 0 else window - at
    assert padded == 0


def test_query(spark, own):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    tokens = dict(zip((r["doc_id"] for r in docs), (b + bytes(4) for b in own.ids([r["text"] or "" for r in docs])), strict=True))
    check(queries.op5_packing(spark, d).collect(), tokens)


def test_special_tokens_in_texts(spark, plain):
    texts = ["<|endoftext|> a", "x <|endoftext|>", "no special <|endoftext| here"]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    check(rows, {i: np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for i, t in enumerate(texts)})


def test_odd_rows(odd, empty, own):
    rows = packing.pack(odd.where("doc_id <> 2")).collect()
    docs = odd.where("doc_id <> 2").collect()
    check(rows, {r["doc_id"]: own.ids([r["text"] or ""])[0] + bytes(4) for r in docs})
    assert packing.pack(odd).count() > len(rows) and packing.pack(empty).collect() == []


def test_level_minimises_the_sum_of_squares():
    rng = random.Random(2)
    p = packing.Packer(32, 0)
    for doc in range(400):
        n = rng.randrange(1, 32)
        options = {0: 0, **{h: 0 for h in range(1, 33 - n) if p.count[h]}}
        for h in options:
            c = p.count.copy()
            if h:
                c[h] -= 1
            if h + n < 32:
                c[h + n] += 1
            options[h] = int((c * c).sum())
        assert options[p.level(n)] == min(options.values())
        p.add(doc, bytes(4 * n))
    assert p.count[0] == 0 and all(p.count[h] == len(w) for h, w in p.open.items())
    p.close()
    assert sum(r[2] for r in p.rows) == sum(r[4] for r in {r[0]: r for r in p.rows}.values())


def test_long_documents_fill_whole_windows():
    p = packing.Packer(8, 100)
    p.add(1, bytes(4 * 19))
    p.close()
    assert [(r[1], r[2], r[5], r[6]) for r in p.rows] == [(0, 8, 100, 0), (8, 8, 101, 0), (16, 2, 102, 0), (18, 1, 103, 0)]
