from __future__ import annotations

import pytest

from lectern.llm import langid

EN = "The town kept the old reading room until the end of the war, and nobody knew why it was closed."
DE = "Der Bericht war bis zum Ende des Krieges in der Stadt zu sehen und gilt seitdem als verloren."
FR = "Le rapport se trouvait encore dans la ville quand la crue arriva, et il ne restait que le journal."
ES = "La copia seguía en la ciudad cuando llegó la crecida y no se puede responder a la pregunta sin ella."
ZH = "目前还不清楚这份报告是否曾在这里使用过，编者核对了目录，只发现三处错误。"
MORE = {
    "en": "What looks like a mistake is explained by the second part of the book, which returns to the same argument with more examples than before.",
    "de": "Wer den ersten Teil kennt, versteht auch den Aufbau des zweiten, denn der Verfasser vergleicht ihn mit einer Liste von Einträgen, die ohne Erklärung bleibt.",
    "fr": "Les éditeurs ont relu la lettre et relevé plusieurs erreurs dans les notices qui ont été recopiées à la main par les élèves de la maison.",
    "es": "Los editores revisaron la carta y encontraron solamente algunos errores en las notas que se copiaron a mano durante los años de la guerra.",
    "zh": "如果没有这座石桥，就无法解释后来的变化，熟悉这本书的读者很快就能理解后半部分的内容，关于地图的说法主要来自古老的账簿中的记录和笔记。",
}
ALL = {"en": EN, "de": DE, "fr": FR, "es": ES, "zh": ZH}


@pytest.fixture(scope="module")
def model():
    return langid.fit([(c, t) for c, t in ALL.items()] * 3 + [("en", DE)])  # one wrong label


def test_each_language(model):
    for code, text in ALL.items():
        got, sure = model.classify([text])[0]
        assert got == code and 0 < sure <= 1


def test_nothing_to_tell(model):
    assert [c for c, _ in model.classify(["", "123 456", "Zisk", "🙂"])] == [None] * 4
    assert langid.Profiles({}).classify(["x"]) == [(None, 0.0)]


def test_paragraphs():
    text = f"---\ntitle: Der die das\n---\n\n# Überschrift\n\n<!-- PAGE:3 -->\n\nChapter 5: Nom\n\n{EN}\n\n- {DE}\n- {EN} [raw/books/x.pdf#p1]\n\n| 1 | 2 |"
    p = langid.paragraphs(text)
    assert p[0] == EN and p[1] == DE and p[2].startswith(EN) and "raw/" not in p[2]


def test_quotations_do_not_count(model):
    quoted = f"{EN} In the margin stands “{FR}” without more. {EN}"
    (_, found), = langid.texts_languages([quoted], model)
    assert {c for c, _ in found} == {"en"}


def test_mixed_and_tables(spark, model):
    rows = [(1, f"{EN}\n\n{FR}\n\n{EN}", "x"), (2, None, "x"), (3, "", "x"), (4, "12", "x"), (1, ZH * 3, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, language string")
    got = sorted((r.rec_key, r.language, tuple(r.languages)) for r in langid.detect(df, "doc_id", "text", model).collect() if r.language)
    assert got == [("1", "en", ("en", "fr")), ("1", "zh", ("zh",))]
    assert langid.detect(df, "doc_id", "text", model).count() == 5
    seg = sorted((r.segment, r.language) for r in langid.detect(df.limit(1), "doc_id", "text", model, segments=True).collect())
    assert seg == [(1, "en"), (2, "fr"), (3, "en")]
    assert langid.detect(df.limit(0), "doc_id", "text", model).count() == 0


UNKNOWN = [
    "Il consiglio comunale ha deciso di chiudere la vecchia biblioteca alla fine dell'anno, e nessuno ha capito perché questa scelta fosse necessaria per la città.",
    "De gemeenteraad besloot de oude bibliotheek aan het einde van het jaar te sluiten, en niemand begreep waarom dat voor de stad noodzakelijk was geweest.",
    "Rada miejska postanowiła zamknąć starą bibliotekę pod koniec roku i nikt nie zrozumiał, dlaczego było to konieczne dla miasta.",
    "Городской совет решил закрыть старую библиотеку в конце года, и никто не понял зачем.",
    "市議会は年末に古い図書館を閉鎖することを決定しましたが、その理由は誰にも理解できませんでした。",
]
KNOWN = [
    ("en", "The committee decided to close the old library by the end of the year, and nobody knew why."), ("de", "Der Bericht war bis zum Ende des Krieges in der Stadt zu sehen."),
    ("fr", "Le rapport se trouvait encore dans la ville à la fin."), ("es", "La copia seguía en la ciudad cuando llegó la crecida."), ("zh", "目前还不清楚这份报告是否曾在这里使用过。"),
]


def test_unknown_languages_and_short_paragraphs(spark, sf):
    """With the profiles of the test tables: no label of the five for other languages, and short paragraphs count."""
    model = langid.profiles_of(spark.read.parquet(f"{sf}/md_doc.parquet"), spark.read.parquet(f"{sf}/documents.parquet"))
    assert [c for c, _ in model.classify(UNKNOWN)] == [None] * len(UNKNOWN)
    assert [c for c, _ in model.classify([t for _, t in KNOWN])] == [c for c, _ in KNOWN]
    (_, found), = langid.texts_languages([f"{EN}\n\n{KNOWN[1][1]}\n\n{EN}"], model)
    assert [c for c, _ in found] == ["en", "de", "en"]
    assert model.classify(["Victoria Stemeint wohnt Lindenweg 131, 00312 Nofaeltstedt."]) == [(None, 0.0)]


def test_distance_like_brute_force(model):
    """Ranks of all n-grams of a text, known or not, against each profile."""
    text = KNOWN[0][1].lower().replace(",", "").replace(".", "")
    grams, n = langid.np.unique(langid._grams([text]), return_counts=True)
    known = {g for r in model.ranked.values() for g in r}
    order = sorted(zip(grams.tolist(), n.tolist()), key=lambda x: (-x[1], x[0] not in known, x[0]))[: langid.COMPARED]
    dist = {c: sum(abs(r.index(g) - int(i * len(r) / langid.COMPARED / 2)) if g in r else langid.PROFILE for i, (g, _) in enumerate(order)) for c, r in model.ranked.items()}
    first, second = sorted(dist.values())[:2]
    got, sure = model.classify([text])[0]
    assert got == min(dist, key=dist.get) and abs(sure - (second - first) / second) < 1e-9


def test_labels(spark):
    names = ["EN", "en-GB", "English", " fra ", "zh_CN", "deutsch", "und", "", None, "n/a"]
    df = spark.createDataFrame([(n,) for n in names], "l string").select("l", langid.label_code(langid.F.col("l")).alias("c"))
    assert [r.c for r in df.collect()] == ["en", "en", "en", "fr", "zh", "de", None, None, None, None]


def test_mislabelled(spark):
    md = spark.createDataFrame([(f"b{i}", "en", f"{EN}\n\n{MORE['en']}") for i in range(4)] + [("m", "de", f"{DE}\n\n{FR}"), ("m", "de", f"{DE}\n\n{FR}"), ("n", None, None)], "stem string, language string, text string")
    docs = spark.createDataFrame([(i, c, f"{t}\n\n{MORE[c]}") for i, (c, t) in enumerate(list(ALL.items()) * 4)] + [(99, "en", ES), (98, "n/a", ZH), (97, None, None), (96, "en", "")], "doc_id long, lang string, text string")
    runs = spark.createDataFrame([(1, "m", "fr"), (2, "m", None), (3, "none", "en"), (4, None, None)], "run_id long, stem string, language string")
    got = sorted(tuple(r) for r in langid.mislabelled(md, runs, docs).collect())
    assert got == [("documents", "98", "zh"), ("documents", "99", "es"), ("md_doc", "m", "fr"), ("run_status", "1", "de"), ("run_status", "2", "de"), ("run_status", "2", "fr")]
