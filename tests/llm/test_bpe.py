from __future__ import annotations

import random
from pathlib import Path

import pytest

from brindle.llm.bpe import VOCABULARY, Encoder, encode_corpus, load_ranks, merge_piece

if not Path(VOCABULARY).exists():
    pytest.skip("no vocabulary", allow_module_level=True)
RANKS = load_ranks()
ODD = [
    "a\x1cb", "a\x85 b", "᠎ x", "<|endoftext|> is text", "x\n\n\ny \n\n z", "  lead", "a\r\nb\r\n\r\nc", " x\n\ny ", "\n\n", "a\n​b", "é" * 3000, "ab" * 5000, "'S 'll's don't", "日本語テキスト 🏔️", "काम", "tab\tand  blanks   ", "x" * 20001, "0123456789" * 50, "﻿", "a b c", "\x00\x01",
]


def reference(text):
    tokenizers = pytest.importorskip("tokenizers")
    if not hasattr(reference, "t"):
        reference.t = tokenizers.Tokenizer.from_file(VOCABULARY.replace(".tiktoken", ".json"))
        reference.t.encode_special_tokens = True
    return reference.t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_as_the_public_library(text):
    assert Encoder(RANKS).encode(text) == reference(text)


def test_random_texts_round_trip():
    rng = random.Random(1)
    tokens = {i: b for b, i in RANKS.items()}
    e = Encoder(RANKS)
    for _ in range(300):
        text = "".join(rng.choice(["a", "é", " ", "\n", "the ", "7", "—", "ß", "한", "'s", "\t", "Q", "."]) for _ in range(rng.randint(0, 80)))
        ids = e.encode(text)
        assert ids == reference(text)
        assert b"".join(tokens[i] for i in ids).decode() == text


def test_every_token_is_reached_by_merging():
    assert all(merge_piece(b, RANKS) == [i] for b, i in list(RANKS.items())[::7])


def test_corpus(spark):
    rows = [(1, "Hello <|endoftext|>"), (2, None), (3, ""), (3, ""), (4, " "), (None, "x"), (5, "word " * 40_000)]
    df = spark.createDataFrame([(*r, [1]) for r in rows], "doc_id bigint, text string, ids array<int>")
    got = sorted(((r["doc_id"], r["ids"]) for r in encode_corpus(df, "doc_id", "text").collect()), key=str)
    assert got == sorted(((d, reference(t) if t else []) for d, t in rows), key=str)
    assert encode_corpus(df.limit(0), "doc_id", "text").count() == 0
