from __future__ import annotations

import random
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import names

SURNAMES = ["Zaetunt", "Haevurd", "Pastax", "Dalmis", "Keinorn", "Thalvaern", "Mirnaeth"]


def brute(a: str, b: str) -> int:
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i or not j:
                d[i][j] = i + j
                continue
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=9), st.text("abc", max_size=9), st.integers(0, 3))
def test_banded_distance(a, b, k):
    assert names.osa(a, b, k) == min(brute(a, b), k + 1)


def test_some_segment_survives_any_allowed_error():
    rng = random.Random(2)
    for _ in range(3000):
        n = rng.randint(4, 14)
        k = names.errors(n)
        word = "".join(rng.choice(string.ascii_lowercase) for _ in range(n))
        typed = list(word)
        for _ in range(k):
            i = rng.randrange(len(typed))
            op = rng.randrange(4)
            if op == 0:
                typed[i] = rng.choice(string.ascii_lowercase)
            elif op == 1:
                typed.insert(i, rng.choice(string.ascii_lowercase))
            elif op == 2 and len(typed) > 2:
                del typed[i]
            elif i + 1 < len(typed):
                typed[i], typed[i + 1] = typed[i + 1], typed[i]
        t = "".join(typed)
        if brute(t, word) <= k:
            assert names.entry_segments(word, k) & {p[1:] for p in names.typed_segments(t) if p[0] == n}, (word, t)


INDEX = "id string, title string, page_type string, aliases array<string>, entry_id string"


@pytest.fixture(scope="module")
def index(spark):
    rows = [(f"{g}-{s}".lower(), f"{g} {s}", "entity", None, None) for g, s in zip(["Andrew", "Zoltan", "Leila", "Benjamin", "Andrew", "Benjamin", "Leila"], SURNAMES)]
    rows += [(f"{g}-{i}".lower(), f"{g} {''.join(random.Random(i).choices('qwxz', k=9)).title()}", "entity", None, None) for i in range(3) for g in ("Andrew", "Zoltan", "Leila", "Benjamin")]
    rows += [(f"archive-{p}".lower(), f"National Archive of {p}", "entity", [f"NA {p[:3]}"], None) for p in ("Staervein", "Nosiax", "Gaelmax", "Peibult")]
    rows += [(f"inst-{p}".lower(), f"{p} Institute of Learning Research", "entity", [], None) for p in ("Staervein", "Tentaer", "Wiamiak")]
    rows += [("topic-x", "Andrew Zaetunt", "topic", None, None), ("andrew-j-brol", "Andrew J. Brolvist", "entity", None, None), ("andrew-k-brol", "Andrew K. Brolvist", "entity", None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, INDEX)


CASES = [
    ("Zaetunt, Andy", "andrew-zaetunt"), ("A. Zaetunt", "andrew-zaetunt"), ("ZAETUNT Andrew", "andrew-zaetunt"), ("Dr. Andrew Zaetnut, ed.", "andrew-zaetunt"), ("Andrew_Zaetunt", "andrew-zaetunt"),
    ("AndrewZaetunt", "andrew-zaetunt"), ("Andrew Q. Zaetunt", "andrew-zaetunt"), ("Zolnan Haevurd", "zoltan-haevurd"), ("Lelia Pastax", "leila-pastax"), ("Léila Pastax", "leila-pastax"), ("Leila Haevurd", None),
    ("Natl. Arch. of Nosiax", "archive-nosiax"), ("Nosiax, Nat. Arch.", "archive-nosiax"), ("The National Archive of Gaelmax (est. 1871), Ltd.", "archive-gaelmax"), ("national-archive-of-peibult", "archive-peibult"),
    ("National Archive Peibutl", "archive-peibult"), ("Staervein Inst. of Learning Res.", "inst-staervein"), ("Institute of Learning Research (Tentaer)", "inst-tentaer"), ("National Archive of Tentaer", None),
    ("Andrew Brolvist", None), ("Andrew J Brolvist", "andrew-j-brol"), ("K. Brolvist", None), ("andrew zaetunt ", None), ("NA Nos", None), ("", None), (None, None), ("Nobody Known", None), ("???", None),
]


def test_cases(spark, index):
    rows = [(i, t, "entity", ["clash"], "x") for i, (t, _) in enumerate(CASES)] + [(900, "A. Zaetunt", "entity", None, "x"), (901, "A. Zaetunt", "concept", None, "x"), (None, "A. Zaetunt", "entity", None, "x")]
    cand = spark.createDataFrame(rows, "candidate_id long, title string, page_type string, aliases array<string>, id string")
    got = {r.candidate_id: r.entry_id for r in names.linked(cand, index).collect()}
    assert got == {i: e for i, (_, e) in enumerate(CASES) if e} | {900: "andrew-zaetunt"}


def test_empty(spark, index):
    cand = spark.createDataFrame([(1, "A. Zaetunt", "entity")], "candidate_id long, title string, page_type string")
    assert names.linked(cand.limit(0), index).count() == 0
    assert names.linked(cand, index.limit(0)).count() == 0


def test_shared_surnames_and_rare_given_names(spark):
    titles = ["Maria Thomas", "Benjamin Thomas", "Quillon Thomas", "Maria Keinorn", "Maria Dalmis", "Yusuf Tregur", "Ingrid Hezisk", "Tentaerion"]
    frames = names.Frames(["maria", "thomas"], ["maria"], longest=20)
    assert frames.cuts("Maria Thomas") == [("maria", "thomas", ""), ("m.", "thomas", "")]
    index = spark.createDataFrame([(t.lower().replace(" ", "-"), t, "entity", None) for t in titles], "id string, title string, page_type string, aliases array<string>")
    cases = {
        "Thomas, Maria": "maria-thomas", "M. Thomas": "maria-thomas", "Maria Thomsa": "maria-thomas", "Thomas, Ben": "benjamin-thomas", "Q. Thomas": "quillon-thomas", "Quilon Thomas": "quillon-thomas",
        "Tregur, Yusuf": "yusuf-tregur", "Y. Tregur": "yusuf-tregur", "Joe Tregur": "yusuf-tregur", "Yusuf Tregru": "yusuf-tregur", "Hezisk, Inge": "ingrid-hezisk", "Tentaeroin": "tentaerion",
        "Maria Tregur": None, "Thomas": None, "X. Hezisk": None, "Keinorn, Maria": "maria-keinorn",
    }
    cand = spark.createDataFrame([(i, t, "entity") for i, t in enumerate(cases)], "candidate_id long, title string, page_type string")
    got = {r.candidate_id: r.entry_id for r in names.linked(cand, index).collect()}
    assert {t: got.get(i) for i, t in enumerate(cases)} == cases
