"""Byte-level BPE against the tiktoken library, on nulls, empties, repeats, very long texts and clashing columns."""

import random
import unicodedata

import numpy as np
import pytest

from spanloom.llm import byte_pairs

PATH, PATTERN = byte_pairs.default_ranks()
DOCS = "doc_id long, text string, lang string, ids string, block long"


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "en", "x", 1) for i, t in zip(ids or range(len(texts)), texts, strict=True)], DOCS)


def theirs(text):
    return byte_pairs.encoder(PATH, PATTERN).encode_ordinary(text or "")


def check(spark, texts, parts=3):
    rows = byte_pairs.encode_documents(frame(spark, texts).repartition(parts)).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    for r in rows:
        ids = theirs(texts[r["doc_id"]])
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert bytes(r["decoded"]).decode() == (texts[r["doc_id"]] or "")


def random_text(rng):
    pools = ["abc XYZ'", "'s'll 't'S", "  \t\n\r 　\x85", "0189½²Ⅷ٣", "äéßИ中日ह्", "!?.,-_@#€😀👩‍👩‍👧", "́‍﻿\u0000\x1c"]
    return "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randrange(120)))


def test_ids_are_those_of_tiktoken_and_decode_to_the_text(spark):
    rng = random.Random(8)
    texts = [None, "", " ", "  \n ", "a", "<|endoftext|> it's", "don't  stop\r\n\r\n  x", "The cat", "The cat", *[random_text(rng) for _ in range(200)]]
    check(spark, texts)


def test_characters_of_other_unicode_versions(spark):
    newer = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn"][:: 997]
    known = ["՘", "౜", "꟎", "\U00011de0", "\U0003fc3b", "Ᲊ", "Ɤ"]
    check(spark, [f"a{c}b {c}{c} 1{c}2 !{c}" for c in [*known, *newer]])


def test_long_texts_and_long_words(spark, monkeypatch):
    texts = ["word " * 400_000, "x" * 30_000, " " * 300_000 + "y", "ab,1 " * 500]
    monkeypatch.setattr(byte_pairs, "LONG_TEXT", 1000)
    monkeypatch.setattr(byte_pairs, "BLOCK_CHARS", 5000)
    check(spark, texts, parts=1)


def test_empty_tables_null_ids_and_repeated_rows(spark):
    assert byte_pairs.encode_documents(frame(spark, [])).collect() == []
    rows = byte_pairs.encode_documents(frame(spark, ["a b", "a b", "c"], [None, None, 5])).collect()
    assert sorted((r["doc_id"] or -1, bytes(r["decoded"])) for r in rows) == [(-1, b"a b"), (-1, b"a b"), (5, b"c")]
    assert byte_pairs.encode_documents(frame(spark, ["a"])).columns == ["doc_id", "n_tokens", "ids", "decoded"]


def test_decoding_of_rows(spark):
    rows = [(1, theirs("naïve 日本")), (None, []), (2, None), (3, theirs("x" * 40_000)), (3, theirs("y"))]
    found = byte_pairs.decode(spark.createDataFrame(rows, "k long, ids array<int>").coalesce(1), PATH, "k").collect()
    assert [(r["k"], bytes(r["decoded"]).decode()) for r in found] == [(1, "naïve 日本"), (None, ""), (2, ""), (3, "x" * 40_000), (3, "y")]
    assert [np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in found] == [i or [] for _, i in rows]
    with pytest.raises(Exception, match="no token"):
        byte_pairs.decode(spark.createDataFrame([(1, [10_000_000])], "k long, ids array<int>"), PATH, "k").collect()
