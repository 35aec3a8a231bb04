"""Token slices by language: the language of a text is that which problem 1 gives it."""

from __future__ import annotations

import os

import pytest

from lectern.llm import langid
from lectern.llm.budget import piece_counts, token_totals
from lectern.llm.encode import VOCABULARY
from tests.llm.test_langid import ALL, DE, EN, ES, FR, MORE, ZH

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="needs the public rank file")


def test_language_by_paragraphs(spark):
    model = langid.fit([(c, t) for c, t in ALL.items()] * 3 + list(MORE.items()))
    texts = [
        f"{EN}\n\n{FR}\n\n{EN}", f"{DE}\n\n{EN}\n\n{MORE['de']}", f"{ES}\n\n{FR}\n\n{ES}", f"{FR}\n\n{ES}\n\n{MORE['fr']}", f"{ZH}\n\n{EN}\n\n{ZH}",
        f"---\nnote: {MORE['de']} {DE}\n---\n\n{EN}", f"# {DE}\n\n# {MORE['de']}\n\n{EN}", f"{EN} In the margin stands “{MORE['fr']} {FR}” without more.", "12", "", None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {int(r.rec_key): r.language or "" for r in langid.detect(df, "doc_id", "text", model).collect()}
    assert [want[i] for i in range(9)] == ["en", "de", "es", "fr", "zh", "en", "en", "en", ""]
    got = {r.doc_id: r.language for r in piece_counts(df, ["doc_id"], model=model).select("doc_id", "language").distinct().collect()}
    assert got == {i: want[i] for i in range(9)}
    plain = {r.doc_id: r.tokens for r in token_totals(df, ["doc_id"]).collect()}
    assert {r.doc_id: r.tokens for r in token_totals(df, ["doc_id"], model=model).collect()} == plain
