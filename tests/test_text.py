"""Column expressions against values worked out by hand, and their properties."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lectern.functions import names, text as t


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("value, want", [("Hello big world", 3), ("第一章 abc", 4), ("éclair", 1), ("", 0), ("<!-- PAGE:3 -->", 1)])
def test_word_count(spark, value, want):
    assert one(spark, value, t.word_count) == want


@pytest.mark.parametrize(
    "value, want",
    [("Chapter 3", True), ("chapter 3: X", True), ("Part ivory", True), ("# Title", True), ("第十二章 名", True), ("Chapters", False), ("The Chapter 3", False), ("#nospace", False), ("Chapter 3", True)],
)
def test_chapter(spark, value, want):
    assert one(spark, value, t.is_chapter) is want


def test_page_of(spark):
    s = "a <!-- PAGE:3 --> b <!--PAGE:7--> c"
    assert (one(spark, s, t.page_of), one(spark, s, lambda c: t.page_of(c, True)), one(spark, "x", t.page_of)) == (3, 7, None)


@pytest.mark.parametrize("value, want", [("My Page_Title!", "my-page-title"), ("a-b", "a-b"), ("  A ", "a")])
def test_slug_id(spark, value, want):
    assert one(spark, value, t.slug_id) == want


def test_slug_id_without_letters(spark):
    import hashlib

    assert one(spark, "知识", t.slug_id) == "page-" + hashlib.sha1("知识".encode()).hexdigest()[:10]


@pytest.mark.parametrize("value, want", [("the-long_way", "long-way"), ("a-b-c-the", "b-c"), ("x (old)", "x "), ("an-an-x", "an-x")])
def test_slug_key(spark, value, want):
    assert one(spark, value, t.slug_key) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("[raw/books/x.pdf.pdf#p3]", "[raw/books/x.pdf#p3]"), ("raw/books/x.pdf#p3]", "[raw/books/x.pdf#p3]"), ("[raw/books/x.pdf#LL3-LL9]", "[raw/books/x.pdf#L3-L9]"),
        ("[raw/y/book.pdf#pp4]", "[raw/books/a/book.pdf#p4]"), ("note", "note"), ("[raw/no-anchor.pdf]", "[raw/no-anchor.pdf]"), (None, None),
    ],
)
def test_normal_provenance(spark, value, want):
    assert one(spark, value, lambda c: t.normal_provenance(c, F.lit("raw/books/a/book.pdf"))) == want


@pytest.mark.parametrize("value, want", [("x#p108,115]", "x#p108-115]"), ("x#p1-#p2]", "x#p1-p2]"), ("x#p1-9]", "x#p1-9]")])
def test_fix_anchor(spark, value, want):
    assert one(spark, value, t.fix_anchor) == want


@pytest.mark.parametrize(
    "value, want",
    [("[series] 【x】01. Name_  of  book.PDF", "Name_ of book.pdf"), ("a<b>:c.epub", "abc.epub"), ("[x].pdf", "untitled.pdf"), ("名·[美]某人 著.pdf", "名.pdf"), ("", "")],
)
def test_clean_file_name(spark, value, want):
    got = one(spark, value, t.clean_file_name)
    assert got == want
    assert one(spark, got, t.clean_file_name) == got


def test_one_line_is_cut(spark):
    got = one(spark, "word " * 100 + "\n\nnext", t.one_line)
    assert len(got) == 200 and got.endswith("...")


def test_json_and_tags(spark):
    assert one(spark, 'x {"a": {"b": 1}} y', t.loose_json) == '{"a": {"b": 1}}'
    assert one(spark, "none", t.loose_json) is None
    assert one(spark, '{"tags": "#a #b"}', t.repair_tags) == '{"tags": ["a", "b"]}'
    assert one(spark, '{"tags": ["a"]}', t.repair_tags) == '{"tags": ["a"]}'


@pytest.mark.parametrize("value, want", [("[[A b|c]]", "A b"), ("[[]]", None), (" x ", " x "), ("a#b", "a"), (None, None)])
def test_link_target(spark, value, want):
    assert one(spark, value, names.link_target) == want


def test_name_key(spark):
    assert {one(spark, v, names.name_key) for v in ("Ab  Cd", "ab-cd", "AB_CD", " ab cd ")} == {"ab-cd"}


@pytest.mark.parametrize("value, want", [("中文字ab", "zh"), ("中a", "en"), ("12", "unknown")])
def test_language(spark, value, want):
    assert one(spark, value, t.language_zh_en) == want
