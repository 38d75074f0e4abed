"""Encoding against the tokenizers library: joins at any cut, shared chunks, odd characters; decoding back."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from larkspur.llm import bpe
from tests.llm import corpus as C

LIBRARY = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
CODEC = bpe.Codec(bpe.VOCABULARY)
BITS = ["a", "The", " word", "'s", "'", "'ll", "l", "l ", "'re", " '", "12", " 7", "  ", " ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "　", "!", "...", " ?", "é", "Ñ", "ÿ", "×", "ß", "ſ", "ª", "²", "½", "ø",
        "日本", "語", "🙂", "é", "ا", "\x00", "<|endoftext|>", "<|endof", "text|>", "<|", "|>", "<", "ǅ", "Ⅷ", "​", "﻿", "x" * 60, "-" * 70]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=40))
def test_encode_alone(bits):
    text = "".join(bits)
    ids = CODEC.encode(text.encode()) & bpe._ID
    assert ids.tolist() == library(text) == CODEC.encode(text.encode(), marked=False).tolist()
    assert CODEC.decode(ids) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=60), st.randoms(use_true_random=False), st.floats(0.0, 0.5))
def test_join_at_any_cuts(bits, rng, rate):
    text = "".join(bits).encode()
    at = [p for p in range(1, len(text)) if text[p] & 0xC0 != 0x80 and rng.random() < rate]
    ends = [0, *at, len(text)]
    parts = [(a, b, CODEC.encode(text[a:b])) for a, b in zip(ends, ends[1:]) if b > a]
    assert CODEC.join(text, parts).tolist() == library(text.decode())


def test_join_long_pieces():
    rng = random.Random(4)
    for text in ("a" * 5000, " " * 5000 + "x", C.prose(3, 3000), "日本語" * 1500, "\n" * 3000, "ab<|endoftext|>" * 300):
        data = text.encode()
        ends = sorted({0, len(data), *[p for p in (rng.randrange(len(data)) for _ in range(40)) if data[p] & 0xC0 != 0x80]})
        parts = [(a, b, CODEC.encode(data[a:b])) for a, b in zip(ends, ends[1:])]
        assert CODEC.join(data, parts).tolist() == library(text)


def test_cuts_follow_the_content(monkeypatch):
    body = C.prose(5, 4000).encode()
    chunks = lambda t: {t[a:b] for a, b in zip([0, *bpe.cuts(t)], bpe.cuts(t))}
    shared = chunks(body) & chunks(b"something else first, " * 7 + body + b" and after")
    assert sum(map(len, shared)) > 0.8 * len(body)
    whole = bpe.cuts(body)
    monkeypatch.setattr(bpe, "_SLICE", 500)
    assert bpe.cuts(body) == whole and whole[-1] == len(body)
    assert bpe.cuts(b"") == [] and bpe.cuts(b"abc") == [3]
    japanese = ("日本語テキスト" * 900).encode()
    for end in bpe.cuts(japanese):
        japanese[:end].decode()


def awkward():
    docs = C.documents()
    passage = C.prose(70, 1500)
    more = [(100 + n, C.prose(200 + n, 40 * n) + passage + "'ll <|endoftext|>" + C.prose(300 + n, 50)) for n in range(8)]
    more += [(200, passage), (201, passage), (202, "日本語 " * 2000), (203, "x 日本語 " * 3 + "日本語 " * 2000), (204, "a" * 60_000), (205, " " * 30_000)]
    return docs + [(i, t, None, None, 0, "k", "ids", "f", "h", "s") for i, t in more]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), C.DOCS).repartition(4)


def test_encode(docs):
    got = Counter((r["own"]["doc_id"], r["own"]["text"], bytes(r["ids"])) for r in bpe.encode(docs).collect())
    want = Counter((r[0], r[1], np.array(library(r[1] or ""), "<u4").tobytes()) for r in awkward())
    assert got == want


def test_chunks_are_shared(spark, docs):
    """Copied passages are encoded once: chunks with one owner cover most of the bytes of the texts that hold them."""
    texts = bpe.texts_of(docs)
    found = [(bytes(r["k"]), r["begin"], r["end"], bytes(r["h"])) for r in bpe._chunks(texts).collect()]
    many = Counter(h for *_, h in found)
    assert sum(e - b for _, b, e, h in found if many[h] > 1) > 60_000


def test_texts_are_shuffled_once(spark, docs):
    plan = bpe.encode_texts(docs)
    plan.collect()
    shown = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # four uses of the distinct texts, three of them from the shuffle of the first
    assert shown.count("ReusedExchange [k") == 3
    assert shown.count("any_value(text") + shown.count("REPARTITION_BY_NUM") == 1


def test_decode(spark, docs):
    rows = bpe.decode(bpe.encode(docs).select("own.text", "ids"))
    for r in rows.collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert r["decoded"] == LIBRARY.decode(ids, skip_special_tokens=False) == (r["text"] or "")


def test_empty(docs):
    assert bpe.encode(docs.limit(0)).collect() == []


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for r in rows:
        ids = library(r["text"] or "")
        want[r["doc_id"], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(LIBRARY.decode(ids, skip_special_tokens=False).encode())] += 1
    assert Counter(tuple(r) for r in bpe.query(spark, small).collect()) == want
