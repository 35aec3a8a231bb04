from __future__ import annotations

import random

import numpy as np
import pytest

from lectern.llm import pii, pii_model, pii_train
from lectern.llm.pii_model import KINDS
from lectern.llm.pii_rules import label

TEXTS = [
    "My name is Odile Woberd and I live at 202 Alder Street, Drimbolholt. Call 303-555-0187 before visiting the reading room.",
    "Bearbeitet von HOVREIX, Katherine, Tel. 0049 30 23125 476, Mail gembirn_60 AT stiambaes DOT INVALID. Die Abschrift ging an Lindenweg 125c, 00203 Triatuvstedt.",
    "Documento de identidad 00397236-X anotado en la ficha. Samuel Thiatan vive en Calle del Olmo 165, 00999 Golmeivera.",
    "La copie fut envoyée au 12, quai des Brumes à Luzeily. Annoté par A. Seifus, tél. 01.99.00.80.32.",
    "批注人：奥斯卡·兰诺，电话：+86 100 0000 6335，邮箱：leila.brun@vebin.example。副本已寄往洛维里尔谷新柳路228号。",
    "Passport QQ 80 86 23 X was noted on the loan slip. Write to leila9695@vebin.example.org or call +44 20 7946 0080.",
]
KINDS_OF = [["person", "address", "phone"], ["person", "phone", "email", "address"], ["id_number", "person", "address"], ["address", "person", "phone"], ["person", "phone", "email", "address"], ["id_number", "email", "phone"]]
CLEAN = ["ISBN 978-0-00-82226666-X is listed on pp. 3274-4663 of vol. 12.", "The key @Bonduk3608 is used in the bibliography.", "Parnael Mill Lane was paved in 1842.", "Order no. 1958-4826 covers 17 volumes.", "## [2024-02-20] merge | Zeigald Canon", "", "  \n"]


@pytest.fixture(scope="module")
def finder():
    return pii.Finder(*pii_model.load(pii.WEIGHTS))


def test_written_forms():
    assert [[k for *_, k in label(t)] for t in TEXTS] == KINDS_OF
    assert all(label(t) == [] for t in CLEAN)


def test_finds_all(finder):
    got = finder.find(TEXTS + CLEAN + [None])
    assert [[k for *_, k in g] for g in got[: len(TEXTS)]] == KINDS_OF
    assert all(g == [] for g in got[len(TEXTS) :])
    a, b, k = got[0][0]
    assert (TEXTS[0][a:b], k) == ("Odile Woberd", "person")


def test_long_text(finder):
    text = ("The author compares the northern travel diary with the lighthouse log. " * 40 + TEXTS[0] + " ") * 4
    assert len(finder.find([text])[0]) == 12


def test_held_out_accuracy(finder):
    """On sentences of new names, numbers and places."""
    rng = random.Random(9)
    name = lambda: rng.choice(["Helen", "Marcel", "Ingrid", "Yusuf"]) + " " + "".join(rng.choice(["ta", "ro", "vi", "ske", "lun"]) for _ in range(3)).title()
    texts, want = [], []
    for _ in range(200):
        n = name()
        t = f"The survey map was closed. If found, return to {n}, {rng.randint(1, 99)} Mill Lane, Brumford. Tax number {rng.randint(900, 999)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)} appears on the receipt."
        texts.append(t)
        want.append({(t.index(n), "person"), (t.index(n) + len(n) + 2, "address"), (t.index("number ") + 7, "id_number")})
    got = [{(a, k) for a, _, k in g} for g in finder.find(texts)]
    good = sum(len(g & w) for g, w in zip(got, want))
    assert good / sum(map(len, want)) > 0.95 and good / max(1, sum(map(len, got))) > 0.95


def test_tables(spark, finder):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS + CLEAN)] + [(99, None, None, None), (0, TEXTS[0], "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string, key int").repartition(3)
    got = sorted(tuple(r) for r in pii.personal_data(df).select("doc_id", "kind", "start_pos").collect())
    want = sorted((r[0], k, a + 1) for r in rows for a, _, k in finder.find([r[1]])[0])
    assert got == want
    out = [r.text for r in pii.masked(df.where("doc_id = 0")).collect()]
    assert out == ["My name is [PERSON] and I live at [ADDRESS]. Call [PHONE] before visiting the reading room."] * 2
    assert pii.masked(df).where("doc_id in (99, 7)").count() == 2
    assert pii.personal_data(df.limit(0)).count() == 0


def test_gradients():
    """Against finite differences, in double precision."""
    rng = np.random.default_rng(3)
    w = {n: a.astype(np.float64) for n, a in pii_model.initial(12).items()}
    ids, length = pii_model.pad([[5, 6, 7, 8], [9, 5]])
    tags = np.array([[0, 1], [1, 2], [2, 0], [0, 0]])
    loss, g = pii_model.gradients(w, ids, tags, length)
    for name in ("embed", "xf", "hb", "cb", "out", "trans", "bias"):
        at = tuple(rng.integers(0, s) for s in w[name].shape)
        if name == "embed":
            at = (5, at[1])
        if name == "trans":
            at = (1, 2)
        eps = 1e-2
        old = w[name][at]
        w[name][at] = old + eps
        up, _ = pii_model.gradients(w, ids, tags, length)
        w[name][at] = old - eps
        down, _ = pii_model.gradients(w, ids, tags, length)
        w[name][at] = old
        assert abs((up - down) / (2 * eps) - g[name][at]) < 2e-4, name


def test_viterbi_like_brute_force():
    from itertools import product

    rng = np.random.default_rng(4)
    k = len(pii_model.TAGS)
    scores, trans = rng.normal(0, 2, (4, 1, k)).astype(np.float32), rng.normal(0, 1, (k, k)).astype(np.float32)
    (path,) = pii_model.viterbi(scores, trans, np.array([4]))
    ok = pii_model.allowed()
    best = max(
        (p for p in product(range(k), repeat=4) if pii_model.TAGS[p[0]][0] != "I" and all(ok[a, b] for a, b in zip(p, p[1:]))),
        key=lambda p: sum(scores[i, 0, t] for i, t in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:])),
    )
    assert path == list(best)


def test_reader_like_plain_network():
    """Scores as those of training, and paths as those of a search over all of each text."""
    rng = np.random.default_rng(5)
    w = {n: a * 2 for n, a in pii_model.initial(40).items()}
    w["bias"] = np.r_[np.float32(2.5), np.zeros(len(pii_model.TAGS) - 1, dtype=np.float32)]
    rows = [rng.integers(1, 40, n) for n in (1, 2, 50, 90, 90, 7)]
    reader = pii_model.Reader(w)
    ids, length = pii_model.pad(rows)
    want, _ = pii_model.forward(w, ids, length)
    got, _ = reader.scores(rows)
    for j, n in enumerate(length):
        assert np.allclose(got[:n, :, j], (want[:n, j] - want[:n, j, :1])[:, reader.order], atol=1e-4)
    paths = [p if any(p) else None for p in pii_model.viterbi(want, w["trans"], length)]
    assert [None if p is None else p.tolist() for p in reader.paths(rows)] == paths and any(paths) and None in paths


def test_training_learns():
    rng = random.Random(1)
    texts = [f"ab {''.join(rng.choices('xyz', k=4))} call {rng.randint(1000000, 9999999)} now" for _ in range(120)]
    spans = [[(t.index("call") + 5, t.index("call") + 12, "phone")] for t in texts]
    v, w = pii_model.train(texts[:100], spans[:100], epochs=12, batch=25, rate=2e-2)
    got = pii.Finder(v, w).decode(texts[100:])
    assert sum(g == s for g, s in zip(got, spans[100:])) >= 18
    assert set(KINDS) == {"email", "phone", "id_number", "address", "person"}
    windows, labels = pii_train.sample(TEXTS * 3, most=5)
    assert len(windows) == len(labels) == 5


def test_names_in_no_list(finder):
    """Names that neither the written forms nor the trainer's lists have, after words that often come before names."""
    from lectern.llm import pii_rules

    names = "Torvald Ekström|Quinlan Abernathy|Ottoline Fairweather|Radovan Jelínek|Ignatius Harcourt|Casimir Wójcik|Desmond Okonkwo|Hildegard Rottmann|Fabrice Delacourt|Gunnhild Thorsen".split("|")
    assert not {w for n in names for w in n.split()} & {*pii_rules.GIVEN, *pii_train.GIVEN, *pii_train.SURNAME}
    texts = [f"The report was signed by {n}." for n in names]
    got = finder.find(texts)
    assert [[(t[a:b], k) for a, b, k in g] for t, g in zip(texts, got)] == [[(n, "person")] for n in names]
    assert finder.find(["信由 王小明 签署"])[0] == [(3, 6, "person")]
    places = ["The Great Northern Railway opened in 1862. Trinity College and the Royal Society disagreed.", "Bodleian Library, Oxford University Press, Black Forest and Lake Constance are places.", "La Bibliothèque Nationale se trouve à Paris."]
    assert finder.find(places) == [[]] * 3


def test_no_rules_when_data_is_found():
    """Neither finding nor masking imports the written forms."""
    import subprocess
    import sys

    code = "import sys; from lectern.llm import pii; pii.Finder(*pii.load(pii.WEIGHTS)).find(['signed by Anna Lindqvist']); assert 'lectern.llm.pii_rules' not in sys.modules"
    subprocess.run([sys.executable, "-c", code], check=True)


@pytest.mark.parametrize("n", [1001, 1090, 1921, 5000, 20_011])
def test_windows_are_of_equal_length(n):
    """They cover a text with the overlap that is asked for, and read no more than that."""
    got = pii.windows(n)
    assert got[0][0] == 0 and got[-1][1] == n and all(b - a <= pii.WINDOW for a, b in got)
    assert all(b - c >= pii.OVERLAP for (_, b), (c, _) in zip(got, got[1:]))
    assert sum(b - a for a, b in got) <= n + (len(got) - 1) * pii.OVERLAP + len(got)


def test_texts_take_part_up_to_their_end():
    """One long text among short ones doesn't make these as long, and scores are those of the plain network in any order."""
    rng = np.random.default_rng(6)
    w = {n: a * 2 for n, a in pii_model.initial_gate(40).items()}
    rows = [rng.integers(1, 40, n) for n in (3, 600, 16, 17, 1, 40, 40)] + [rng.integers(1, 40, 30) for _ in range(200)]
    ids, length = pii_model.pad(rows)
    odds, _ = pii_model.forward(w, ids, length)
    gate = pii_model.Gate(w)
    for got, row in zip(gate.above(rows, 0.5), range(len(rows))):
        assert got.tolist() == np.flatnonzero(odds[: length[row], row, 0] > 0.5).tolist()
    out, said = gate.scored(rows)
    assert said.tolist() == length.tolist() and not out[64:, 0, length < 64].any()


def test_viterbi_of_several_lengths():
    """Each text's path is that of the text alone, and equal sums give the first tag."""
    rng = np.random.default_rng(7)
    k, length = len(pii_model.TAGS), np.array([5, 1, 9, 2])
    scores, trans = rng.integers(-2, 3, (9, 4, k)).astype(np.float32), rng.integers(-1, 2, (k, k)).astype(np.float32)
    alone = [pii_model.viterbi(scores[:n, j : j + 1], trans, length[j : j + 1])[0] for j, n in enumerate(length)]
    assert pii_model.viterbi(scores, trans, length) == alone
    assert pii_model.viterbi(np.zeros((3, 1, k), np.float32), np.zeros((k, k), np.float32), np.array([3])) == [[0, 0, 0]]


def test_parts_are_bounded_by_characters(monkeypatch):
    """All rows come once and in order, a long text alone, and null and empty texts with others."""
    import pyarrow as pa

    monkeypatch.setattr(pii, "PART", 10)
    texts = ["abcd", None, "中文", "", "x" * 50, None, "abc", "y" * 8, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["doc_id", "text"])
    got = [p.column(1).to_pylist() for p in pii.parts(batch)]
    assert got == [["abcd", None, "中文", ""], ["x" * 50], [None, "abc"], ["y" * 8, ""]]
    assert list(pii.parts(batch.slice(0, 0))) == []
    void = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.nulls(2)], names=["doc_id", "text"])
    assert [p.num_rows for p in pii.parts(void)] == [2]
