from __future__ import annotations

import random

import numpy as np
import pytest

from lectern.llm import leaks

P1 = "Clerk Naethos weighed 8392 pamphlets at Laraldwick and wrote the sum beside seal 22 before the office closed on Thursday evening."
P2 = "书记员萨芬洛在莫芬利镇称了7942桶，其中27桶另外存放，后来没有人再去清点。"


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 37, 500)
    w = leaks.WaveletMatrix(v, 6)
    at, sym = rng.integers(0, 501, 200), rng.integers(0, 37, 200)
    assert w.rank(sym, at).tolist() == [int((v[:a] == s).sum()) for s, a in zip(sym, at)]
    got, before = w.access_rank(np.arange(500))
    assert got.tolist() == v.tolist() and before.tolist() == [int((v[:i] == v[i]).sum()) for i in range(500)]


@pytest.mark.parametrize("seed", range(4))
def test_index_like_brute_force(seed):
    rng = random.Random(seed)
    part = [rng.randint(1, 4) for _ in range(120)]
    text = part * 3 + [rng.randint(1, 4) for _ in range(200)] + [0]  # with long repeats
    seq = np.array(text, dtype=np.int32)
    index = leaks.FMIndex(seq, 5)
    phrases = [text[i : i + n] for n in (1, 3, 9, 60) for i in range(0, 400, 37)] + [[4, 4, 4, 4, 4, 4, 4, 4, 1, 2]]
    width = max(map(len, phrases))
    table = np.zeros((len(phrases), width), dtype=np.int64)
    for i, p in enumerate(phrases):
        table[i, width - len(p) :] = p
    lo, hi = index.search(table, np.array([len(p) for p in phrases]))
    for p, a, b in zip(phrases, lo, hi):
        want = [i for i in range(len(text) - len(p) + 1) if text[i : i + len(p)] == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, item_id string")


def items(spark, rows=((1, P1), (2, P2), (3, None), (4, ""))):
    return spark.createDataFrame(list(rows), "item_id long, passage string")


def test_cases(spark):
    w = P1.split(" ")
    altered = " ".join("quietly" if i in (4, 13) else x for i, x in enumerate(w) if i != 8)
    rows = [
        (1, "Intro. " + " ".join(w[3:15]) + " End.", None), (2, " ".join(w[3:14]) + " End.", None), (3, "> " + P1.upper().replace(" AND", " ,\n> AND"), None), (4, f"x {altered} y", None),
        (5, "前言。" + P2[3:26].replace("，", "、\n") + "结束", None), (6, P2[:17], None), (7, None, None), (8, "", None), (9, P1 + " " + P1 + "\n" + P2, None), (9, "repeated key " + P1, None),
        (10, "Which of the two records is older? weighed pamphlets and wrote the sum beside", None),
    ]
    got = sorted(tuple(r) for r in leaks.leaked(docs(spark, rows).repartition(2), items(spark)).collect())
    assert got == [(1, 1), (3, 1), (4, 1), (5, 2), (9, 1), (9, 2)]
    spans = {(r.doc_id, r.item_id, r.start_pos): r for r in leaks.leak_spans(docs(spark, rows[:1]), items(spark)).collect()}
    ((_, _, a), r), = spans.items()
    assert rows[0][1][a - 1 : r.end_pos] == " ".join(w[3:15])


def test_short_items_must_be_whole(spark):
    it = items(spark, [(7, "one two three four five")])
    got = sorted(r.doc_id for r in leaks.leaked(docs(spark, [(1, "say one two three four five", None), (2, "say one two three four", None)]), it).collect())
    assert got == [1]


def test_empty(spark):
    d = docs(spark, [(1, P1, None)])
    assert leaks.leaked(d.limit(0), items(spark)).count() == 0
    assert leaks.leaked(d, items(spark).limit(0)).count() == 0


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK", 40)
    assert sorted(tuple(r) for r in leaks.leaked(docs(spark, [(1, P1 + P2, None)]), items(spark)).collect()) == [(1, 1), (1, 2)]


def test_shards(monkeypatch):
    monkeypatch.setattr(leaks, "SHARD", 50)
    it = leaks.Items([(str(i), leaks.words(p), set(leaks.words(p))) for i, p in ((1, P1), (2, P2))])
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(20), pa.int64()), pa.array([P1 if i % 3 else P2 for i in range(20)])], names=["k", "t"])
    got = sorted((k, i) for b in leaks._search(it, pa.int64())(iter([batch])) for k, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    assert got == [(i, "1" if i % 3 else "2") for i in range(20)]


def altered(text: str, every: int, rng: random.Random) -> str:
    w = text.split(" ")
    return " ".join(rng.choice(["quietly", "seldom", "bramble"]) if i % every == every - 1 else x for i, x in enumerate(w))


def invented(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["ka", "lo", "mer", "ti", "vun", "so", "dra"]) for _ in range(rng.randint(2, 4))) for _ in range(n))


@pytest.mark.parametrize("block", [40, 4_000_000])
def test_shared_passages_and_all_copies(spark, monkeypatch, block):
    """Items that share a passage or most of it, every fourth word altered, two altered copies; in one block and in many."""
    monkeypatch.setattr(leaks, "BLOCK", block)
    rng = random.Random(4)
    shared, near, other = invented(rng, 40), invented(rng, 40), invented(rng, 40)
    rows = [(1, shared), (2, shared.upper()), (3, shared + "."), (4, near), (5, near + " with a closing clause of its own"), (6, near + " and another ending of six words"), (7, other)]
    filler = invented(rng, 300)
    texts = [
        (1, f"{filler} {altered(shared, 9, rng)} {filler}", None), (2, f"{filler} {altered(near, 7, rng)} with a closing clause of its own", None), (3, f"{altered(other, 4, rng)} {filler}", None),
        (4, f"{altered(other, 6, rng)} {filler} {altered(other, 5, rng)} tail", None), (5, f"{other} {filler} {altered(other, 6, rng)}", None), (6, filler, None),
    ]
    found = [tuple(r) for r in leaks.leak_spans(docs(spark, texts), items(spark, rows)).collect()]
    assert sorted({(d, i) for d, i, *_ in found}) == [(1, 1), (1, 2), (1, 3), (2, 4), (2, 5), (3, 7), (4, 7), (5, 7)]
    assert len([1 for d, *_ in found if d == 4]) == 2 and sorted(k for d, _, k, *_ in found if d == 5) == ["altered", "run"]
    for d, _, _, a, b in found:
        assert b - a > 0.7 * len(other)
