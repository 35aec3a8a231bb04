"""The tokenizer against the public library, and its parts against brute force."""

from __future__ import annotations

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm.bpe import PATTERN, Encoder, PerfectHash, read_ranks
from lectern.llm.budget import TrieWalk, piece_counts, piece_tokens, token_totals
from lectern.llm.encode import VOCABULARY, encode

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="needs the public rank file")

ODD = ["", " ", "\n\n  \n", "don't I'M we'LL 's", "<|endoftext|>", "１２３ ²³ ٣٤٥ Ⅷ", "中文，标点。abc中", "a  b \x0bc\x1cd", "\x1c \x1d", "𝔘𝔫𝔦 🙂🙂", "é" * 50, "a" * 5000, "日" * 900, "_x__y-–—", "﻿x​y", "x ¹ª", "\t\t1\r\n2 "]


@pytest.fixture(scope="module")
def enc():
    return Encoder(read_ranks(VOCABULARY))


@pytest.fixture(scope="module")
def library(enc):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(enc.tokens)}, special_tokens={})


def test_perfect_hash():
    keys = [f"k{i}".encode() for i in range(3000)]
    h = PerfectHash(keys)
    assert [h.get(k) for k in keys] == list(range(3000)) and len(h.slots) == 3000
    assert h.get(b"other") == -1 and PerfectHash([]).get(b"x") == -1


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(enc, library, text):
    assert list(enc.encode(text)) == library.encode_ordinary(text)
    assert enc.decode(enc.encode(text)) == text


def test_null(enc):
    assert list(enc.encode(None)) == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("abc '  \n1é的s")), max_size=60))
def test_any_text(enc, library, text):
    assert list(enc.encode(text)) == library.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aeinrst' 01.-é的一ab", min_size=1, max_size=25), min_size=1, max_size=30))
def test_trie_counts_like_merging(enc, texts):
    pieces = sorted({p for t in texts for p in enc.cut(t.encode())})
    walk = TrieWalk(enc)
    assert [walk.count(p) for p in pieces] == [1 if enc.find(p) >= 0 else len(enc.merge(p)) for p in pieces]


def test_encode_table(spark, library):
    rows = [(i, t, 1) for i, t in enumerate([*ODD, None])] + [(0, "again", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    got = sorted((r.doc_id, r.ids) for r in encode(df, "doc_id", "text").collect())
    assert got == sorted((i, library.encode_ordinary(t) if t else []) for i, t, _ in rows)
    assert encode(df.limit(0), "doc_id", "text").count() == 0


def test_totals(spark, library):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b"]), " ".join(rng.choice(["the", "Kuverholt", "1984", "中文字", "x"]) for _ in range(40))) for _ in range(30)] + [("a", None), ("c", ""), (None, "x y")]
    df = spark.createDataFrame(rows, "source string, text string")
    want: dict = {}
    for s, t in rows:
        if t:
            want[s] = want.get(s, 0) + len(library.encode_ordinary(t))
    assert {r.source: r.tokens for r in token_totals(df, ["source"]).collect()} == want
    assert token_totals(df.limit(0), ["source"]).count() == 0
    assert piece_counts(df.limit(0), ["source"]).count() == 0
    assert piece_tokens(spark.createDataFrame([(b"Kuverholt",), (b"Kuverholt",)], "piece binary")).count() == 1
