from __future__ import annotations

from datetime import datetime

import pytest

from lectern.operators import drafts, merge

CAND = "candidate_id long, stem string, chunk_index int, ord int, page_type string, id string, title string, aliases array<string>, summary string, tags array<string>, extracted_at timestamp, extra map<string,string>, path string"
DAY = datetime(2024, 5, 6)
ROWS = [
    (1, "bk", 0, 0, "entity", "ada", "Ada", ["A."], "She wrote.", ["x"], DAY, {"confidence": "certain", "note": "n", "canonical": "false"}, None),
    (2, "bk", 1, 0, "concept", "ada", "Other", None, "later", None, DAY, None, None),
    (3, "bk", 0, 1, "source", "src-a", "Source A", ["no"], "", None, DAY, {"reliability": "superb", "source_kind": "paper"}, None),
    (4, "bk", 2, 0, "source", "src-b", "Source B", None, None, None, DAY, None, None),
    (5, "cd", 0, 0, "analysis", "why", "Why?", None, None, None, DAY, None, None),
    (6, None, 0, 0, "topic", "t", "T", None, None, None, DAY, None, None), (7, "cd", 0, 0, "topic", None, "T", None, None, None, DAY, None, None),
]
ITEM = "stem string, id string, chunk_index int, ord int, kind string, value string, provenance string"
ITEMS = [
    ("bk", "ada", 0, 0, "claim", "It ran.", "[raw/b.pdf#p1]"), ("bk", "ada", 1, 0, "claim", "It ran.", "[raw/b.pdf#p9]"), ("bk", "ada", 1, 1, "claim", "It stopped..", "[raw/b.pdf#p2]"),
    ("bk", "ada", 0, 0, "inference", "Inference: nice", None), ("bk", "ada", 0, 0, "uncertainty", "Uncertain: perhaps", None), ("bk", "ada", 0, 1, "topics", "sums", None), ("bk", "ada", 0, 0, "broader", "art", None),
    ("bk", "src-b", 0, 0, "claim", "From B", "[raw/b.pdf#p3]"), ("bk", "src-b", 0, 0, "topics", "lost", None), ("bk", "none", 0, 0, "claim", "nobody's", None), ("bk", "ada", 0, 2, "claim", None, None),
]


@pytest.fixture(scope="module")
def made(spark):
    cand = spark.createDataFrame(ROWS, CAND).drop("path")
    return drafts.merged_candidates(cand), merge.merge_items(spark.createDataFrame(ITEMS, ITEM), cand), spark.createDataFrame([("bk", "raw/b.pdf", "clash")], "stem string, path string, title string")


def test_fields(spark, made):
    d, _, paths = made
    links = spark.createDataFrame([("bk", "ada", "topics", ["sums"]), ("bk", "ada", "broader", ["art"])], "stem string, id string, bucket string, targets array<string>")
    got = {}
    for r in drafts.draft_fields(d, paths, links).orderBy("place").collect():
        got.setdefault((r.stem, r.id), []).append((r.key, r.value))
    assert set(got) == {("bk", "ada"), ("bk", "src-a"), ("cd", "why")}
    ada = dict(got["bk", "ada"])
    assert [k for k, _ in got["bk", "ada"]] == ["id", "title", "type", "status", "created", "updated", "sources", "aliases", "canonical", "confidence", "note", "tags", "related.topics"]
    assert ada["confidence"] == "medium" and ada["canonical"] == "false" and ada["aliases"] == '["A."]' and ada["sources"] == '["raw/b.pdf"]' and ada["related.topics"] == '["sums"]' and ada["created"] == "2024-05-06"
    src = dict(got["bk", "src-a"])
    assert src["reliability"] == "unknown" and src["source_kind"] == "paper" and src["source_path"] == "raw/b.pdf" and "aliases" not in src and "confidence" not in src
    assert dict(got["cd", "why"])["sources"] == "[]" and dict(got["cd", "why"])["question"] == ""


def test_whole_page(made):
    d, items, paths = made
    md = {(r.stem, r.id): r.md for r in drafts.as_markdown(drafts.draft_fields(d, paths), drafts.draft_lines(d, items, paths), d).collect()}
    assert md["bk", "ada"] == (
        '---\nid: ada\ntitle: Ada\ntype: entity\nstatus: draft\ncreated: 2024-05-06\nupdated: 2024-05-06\nsources: ["raw/b.pdf"]\naliases: ["A."]\ncanonical: false\nconfidence: medium\nnote: n\ntags: ["x"]\n---\n\n# Ada\n\n'
        "## Summary\n\nShe wrote.\n\n## Key facts\n\n- It ran. [raw/b.pdf#p1]\n- It stopped. [raw/b.pdf#p2]\n\n## Inferences\n\n- Inference: nice\n\n## Uncertainties\n\n- Uncertain: perhaps\n\n"
        "## Related pages\n\n- Broader: [[art]]\n- Topics: [[sums]]\n\n## Provenance\n\n- Primary source: raw/b.pdf\n\n## Change notes\n\n- 2024-05-06 — page created by auto ingest.\n"
    )
    # the book's further source page gave its claim, not its links
    assert "- From B. [raw/b.pdf#p3]" in md["bk", "src-a"] and "lost" not in md["bk", "src-a"]
    assert "## Summary\n\n- (none recorded)\n\n## Key facts\n\n- (none recorded)\n" in md["cd", "why"]


def test_source_drafts(spark, made):
    books = spark.createDataFrame([("bk", "raw/b.pdf", 3, "2024-01-01"), ("my_book", "raw/x/my_Old-book.pdf", 12, "2024-01-02"), ("zh", "raw/x/旧书.epub", None, "2024-01-03")], "stem string, path string, pages_total int, day string")
    rows, items = drafts.source_drafts(made[0], books)
    assert {(r.stem, r.id, r.title) for r in rows.collect()} == {("my_book", "my-book", "My Old Book"), ("zh", "zh", "旧书")}
    assert {(r.id, r.provenance) for r in items.where("kind = 'claim'").collect()} == {("my-book", "[raw/x/my_Old-book.pdf#p1-p12]"), ("zh", "[raw/x/旧书.epub#L1-L1]")}
    assert rows.columns == made[0].columns


PAGE = "page_row_id long, slug string, landed_at timestamp, frontmatter string, title_line string, sections array<struct<ord int, header string, body string>>, side int"


def at(n: int) -> datetime:
    return datetime(2024, 1, n)


PAGES = [
    (1, "a", at(1), '{"title": "A", "status": null, "sources": ["raw/x/one.pdf"], "updated": "2023-01-01"}', "# A", [(0, "Summary", "First."), (1, "Key facts", "- One. [raw/x.pdf#p1]\n- one. [raw/y.pdf#p1]\nplain"), (2, "Provenance", "- Primary source: raw/x/one.pdf")], 0),
    (2, "a", at(2), '{"title": "B", "kind": "k", "sources": ["raw/x/two.pdf"], "updated": "2025-01-01"}', "# B", [(0, "Summary", "Second."), (1, "Key facts", "- ONE. [raw/z.pdf#p1]\n- Two. [raw/z.pdf#p2]\ntext"), (2, "Inferences", "- Inference: x"), (3, "Uncertainties", " ")], 0),
    (3, "a", at(3), None, None, [(0, "Uncertainties", "- Uncertain: y"), (1, "Inferences", "- Inference: X\n- Inference: z"), (2, "Related pages", "- Topics: [[t]]")], 0),
    (4, "b", at(1), "{}", None, None, 0), (5, None, at(1), "{}", None, [(0, "Summary", "x")], 0), (6, "c", at(4), "not json", None, [(0, "Summary", "only"), (1, "Change notes", "- old")], 0),
]


def test_merged_pages(spark):
    page = spark.createDataFrame(PAGES, PAGE).repartition(3).drop("side")
    fields = {(r.slug, r.key): r.value for r in drafts.merged_fields(page).collect()}
    assert fields == {("a", "title"): "A", ("a", "status"): None, ("a", "kind"): "k", ("a", "updated"): "2024-01-03"}
    lines = {}
    for r in drafts.merged_lines(page).orderBy("row", "at").collect():
        lines.setdefault((r.slug, r.section), []).append(r.line)
    assert lines == {
        ("a", "Summary"): ["First."], ("a", "Key facts"): ["- One. [raw/x.pdf#p1]", "- one. [raw/y.pdf#p1]", "plain", "- Two. [raw/z.pdf#p2]"], ("a", "Inferences"): ["- Inference: x", "- Inference: z"],
        ("a", "Uncertainties"): ["- Uncertain: y"], ("a", "Related pages"): ["- Topics: [[t]]"], ("a", "Provenance"): ["- Primary source: raw/x/one.pdf", "- Additional source: raw/x/two.pdf"],
        ("a", "Change notes"): ["- 2024-01-02 — merged contributions from `two`.", "- 2024-01-03 — merged contributions from ``."], ("c", "Summary"): ["only"], ("c", "Change notes"): ["- old"],
    }
    order = {}
    for r in drafts.merged_order(page).orderBy("place").collect():
        order.setdefault(r.slug, []).append(r.section)
    assert order == {"a": ["Summary", "Key facts", "Inferences", "Uncertainties", "Related pages", "Provenance", "Change notes"], "c": ["Summary", "Change notes"]}
    none = page.limit(0)
    assert drafts.merged_fields(none).count() == drafts.merged_lines(none).count() == drafts.merged_order(none).count() == 0
