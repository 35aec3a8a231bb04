"""Pages: rendering and reading back, rules, links, search, merging, repair and imports on small tables."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lectern.operators import collide, extract, imports, links, merge, pages, repair, rules, runs, search
from lectern.sources import files

PAGE = "page_row_id long, slug string, page_type string, path string, landed_at timestamp, removed_at timestamp, frontmatter string, title_line string, sections array<struct<ord int, header string, body string>>, id string"


def row(i, slug, kind="concept", title=None, sections=(), at=1, **fm):
    title = title or slug.replace("-", " ").title()
    front = {"id": slug, "title": title, "type": kind, "status": "active", "created": "2024-01-01", "updated": "2024-01-02", "sources": ["raw/books/x.pdf"], "tags": ["t"], **fm}
    return (i, slug, kind, f"wiki/{kind}s/{slug}.md", datetime(2024, 1, at), None, json.dumps(front), f"# {title}", [(n, h, b) for n, (h, b) in enumerate(sections)], None)


FACTS = "- The Kite Bridge stood. [raw/books/x.pdf#p3]\n- No source here\n- A second one, [raw/books/y.pdf#p9-p7]."


@pytest.fixture(scope="module")
def page(spark):
    rows = [
        row(1, "alpha-one", sections=[("Summary", "About alpha."), ("Key facts", FACTS), ("Inferences", "")], confidence="high"),
        row(2, "alpha-one", sections=[("Summary", "Old."), ("Key facts", "- the kite bridge STOOD. [raw/books/z.pdf#p1]\n- New fact. [raw/books/z.pdf#p2]")], at=3, tags=["u", "t"]),
        row(3, "the-alpha-one", sections=[("Summary", "Twin: see [[alpha-one]] and [[ ]] and [[|x]].")], title="Alpha One", confidence="odd"),
        row(4, "beta", "topic", sections=[("Summary", "See [[Alpha One]] Inference: not a bullet.")], colour="red"),
        row(5, "gamma", "dashboard", title='Quote "x": y'),
        (6, None, None, None, None, None, None, None, None, None),
        (7, "bare", None, None, datetime(2024, 1, 1), None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, PAGE)


@pytest.fixture(scope="module")
def md(page):
    return pages.rendered(page).select("slug", "md")


LINK = "link_id long, src_slug string, origin string, bucket string, ord int, target string, recorded_at timestamp, loaded_at timestamp"


@pytest.fixture(scope="module")
def link(spark):
    t = datetime(2024, 1, 1)
    rows = [
        (1, "beta", "frontmatter", "concepts", 0, "Alpha One", t, t), (2, "beta", "frontmatter", "concepts", 1, "alpha_one", t, t), (3, "alpha-one", "body", None, 0, "[[beta|b]]", t, t),
        (4, "beta", "body", None, 0, "nowhere", t, t), (5, "beta", "body", None, 0, None, t, t), (6, "the-alpha-one", "body", None, 0, "gamma", t, t),
    ]
    return spark.createDataFrame(rows, LINK)


INDEX = "id string, title string, page_type string, path string, aliases array<string>"


@pytest.fixture(scope="module")
def index(spark):
    return spark.createDataFrame([("alpha-one", "Alpha One", "concept", None, ["First Letter"]), ("omega", "Omega", "concept", None, None), ("omega-2", "OMEGA ", "concept", None, ["first  letter"])], INDEX)


def got(df, *cols):
    return sorted(tuple(r) for r in df.select(*(cols or df.columns)).collect())


def test_landed_takes_the_last_copy(page):
    assert got(pages.landed(page).where("slug = 'alpha-one'"), "page_row_id") == [(2,)]


def test_round_trip(page, md):
    want = {(r.slug, s.header, (s.body or "- (none recorded)")) for r in pages.landed(page).where("sections is not null").collect() for s in r.sections}
    back = pages.parsed(md).select("slug", F.explode("sections").alias("s")).where("s.header <> ''")
    assert {(r.slug, r.s.header, r.s.body) for r in back.collect()} == want
    assert got(pages.parsed(md).where("slug = 'gamma'"), "title", "type") == [('Quote "x": y', "dashboard")]


def test_facts(md):
    f = got(pages.facts_of(md).where("slug = 'alpha-one'"), "ord", "claim", "provenance")
    assert f == [(0, "the kite bridge STOOD", "[raw/books/z.pdf#p1]"), (1, "New fact", "[raw/books/z.pdf#p2]")]


def test_frontmatter_rule(md):
    m = {(r.slug, r.message) for r in rules.frontmatter_schema(md).collect()}
    assert ("the-alpha-one", "bad confidence: odd") in m and ("bare", "unknown page type: ") not in m
    assert ("beta", "missing field: confidence") in m
    assert ("alpha-one", "missing field: confidence") in m  # the later copy lacks it
    assert {x for x in m if x[0] == "gamma"} == set()


def test_other_rules(spark, md):
    assert [r.slug for r in rules.link_format(md).collect()] == ["the-alpha-one"] * 2
    assert got(rules.prefix_syntax(md), "slug") == [("beta",)]
    own = spark.createDataFrame([("p", f"---\ntype: concept\n---\n\n# P\n\n## Key facts\n\n{FACTS}\n- Odd. [raw/books/x.pdf]\n\n## Inferences\n\n- Inference: fine: yes\n")], "slug string, md string")
    assert got(rules.unsourced_facts(own), "message") == [("no source: No source here",), ("no source: Odd. [raw/books/x.pdf]",)]
    assert got(rules.provenance_format(own), "message") == [("malformed anchor: [raw/books/x.pdf]",), ("page out of range: [raw/books/y.pdf#p9-p7]",)]
    there = spark.createDataFrame([("raw/books/x.pdf",)], "path string")
    assert ("missing file: [raw/books/y.pdf#p9-p7]",) in got(rules.provenance_format(own, there), "message")
    assert rules.prefix_syntax(own).count() == 0
    source = spark.createDataFrame([("p", "nothing of the sort")], "slug string, text string")
    assert got(rules.scope_boundary(own, source), "message") == [("not in the source: Kite Bridge",)]
    assert rules.scope_boundary(own, spark.createDataFrame([("p", "a bridge of stone")], "slug string, text string")).count() == 0
    assert got(rules.language_consistency(own, spark.createDataFrame([("p", "中文文本")], "slug string, text string")), "slug") == [("p",)]
    assert got(rules.raw_paths(spark.createDataFrame([("./raw/x.md",), ("raw/inbox/_manifest.md",), ("wiki/a.md",)], "path string"))) == [("./raw/x.md",)]
    bare = spark.createDataFrame([("q", "# only a title"), ("n", None)], "slug string, md string")
    assert got(rules.frontmatter_schema(bare), "slug", "message") == [("n", "no front matter"), ("q", "no front matter")]
    assert got(rules.lint_totals(rules.lint(bare)))[0][0] == "frontmatter_schema"


def test_links(page, link, index):
    wiki = pages.wiki(page)
    assert got(links.dangling(link, wiki, index), "link_id") == [(4,), (5,)]
    e = links.edges(link, wiki, index)
    assert got(e) == [("alpha-one", "beta"), ("beta", "alpha-one"), ("the-alpha-one", "gamma")]
    seeds = wiki.where("slug = 'beta'").select("slug")
    assert got(links.neighbors(e, seeds, 3), "slug", "depth") == [("alpha-one", 1)]
    assert got(links.unlinked_pages(link, wiki)) == [("bare",), ("the-alpha-one",)]
    assert ("omega", "index") in got(links.index_drift(wiki, index))


def test_outbound_and_provenance(md, link):
    assert got(links.outbound(md, link).where("slug = 'beta'"), "ord", "target") == [(0, "Alpha One"), (1, "alpha_one")]
    assert got(links.provenance_of(md).where("slug = 'alpha-one'"), "ord", "ref") == [(0, "raw/books/x.pdf"), (1, "[raw/books/z.pdf#p1]"), (2, "[raw/books/z.pdf#p2]")]


def test_index_titles(spark):
    df = spark.createDataFrame([("- [[A]] — x\n```\n- [[B]]\n```\n- [[C|d]]",)], "text string")
    assert got(links.index_titles(df)) == [("A",), ("C",)]


def test_collisions(spark, index):
    cand = spark.createDataFrame(
        [(1, "alpha-one", "X", None), (2, "n", " alpha  ONE", ["omega"]), (3, "n", "first letter", []), (4, "n", "N", ["First Letter"]), (5, None, None, None)],
        "candidate_id long, id string, title string, aliases array<string>",
    )
    assert got(collide.collision_reports(cand, index)) == [(1, "id", 1, "alpha-one"), (2, "title", 1, "alpha-one"), (3, "alias", 2, "alpha-one"), (4, "alias", 2, "alpha-one")]
    assert got(collide.shared_names(index)) == [("first letter", 2), ("omega", 2)]
    assert got(collide.near_duplicate_slugs(spark.createDataFrame([("the-x",), ("x",), ("y",)], "slug string"))) == [("x", 2, "the-x"), ("x", 2, "x")]


def test_search(page):
    wiki = pages.wiki(page)
    assert got(search.search(wiki, "alpha one"), "slug", "score") == [("alpha-one", 8), ("beta", 3), ("the-alpha-one", 11)]
    assert got(search.search(wiki, "kite"), "slug", "score", "hits") == [("alpha-one", 2, "key_facts")]
    assert search.search(wiki, " ").count() == 0
    q = wiki.sparkSession.createDataFrame([("beta",), ("ALPHA one",), ("Beta!",), ("none",)], "query string")
    assert got(search.find_pages(q, wiki)) == [("ALPHA one", "the-alpha-one", "title"), ("Beta!", "beta", "kebab"), ("beta", "beta", "slug")]
    assert got(search.find_pages(q, wiki, None, "topic"), "query") == [("Beta!",), ("beta",)]


def test_merge(page, link):
    m = got(merge.merged_sections(page).where("slug = 'alpha-one' and section = 'Key facts'"), "ord", "line")
    assert [x[1][:12] for x in m] == ["The Kite Bri", "No source he", "A second one", "New fact. [r"]
    assert got(merge.merged_frontmatter(page).where("slug = 'alpha-one'"), "title", "updated") == [("Alpha One", "2024-01-02")]
    assert got(merge.merged_lists(page).where("slug = 'alpha-one'"), "field", "ord", "value") == [("sources", 0, "raw/books/x.pdf"), ("tags", 0, "t"), ("tags", 1, "u")]
    assert got(merge.provenance_lines(page).where("slug = 'alpha-one'"), "line") == [("- Primary source: raw/books/x.pdf",)]
    again = page.unionByName(page)
    assert got(merge.merged_sections(again), "slug", "section", "ord", "line") == got(merge.merged_sections(page), "slug", "section", "ord", "line")
    assert got(merge.related_links(link)) == [("beta", "concepts", 4, 0, "Alpha One"), ("beta", "concepts", 4, 1, "alpha_one")]
    assert got(merge.same_title_plan(page), "canonical", "duplicate") == [("alpha-one", "the-alpha-one")]
    plan = merge.near_slug_plan(page)
    assert got(merge.rewrite_links(link, plan).where("link_id = 6"), "src_slug") == [("alpha-one",)]


def test_maps_and_fields(spark):
    df = spark.createDataFrame([({"a": ["x"], "b": []}, {"a": ["y", "x"]}, ["id", "title", "colour"], "topic")], "a map<string,array<string>>, b map<string,array<string>>, k array<string>, t string")
    r = df.select(merge.merge_related(F.col("a"), F.col("b")).alias("m"), merge.allowed_fields(F.col("k"), F.col("t")).alias("f")).first()
    assert r.m == {"a": ["x", "y"]} and r.f == ["id", "title"]


def test_repair(spark):
    long = "a" * 45 + ".pdf"
    there = spark.createDataFrame([("raw/a/x.pdf",), ("raw/b/y.pdf",), ("raw/c/y.pdf",), (f"raw/c/{long}",)], "path string")
    refs = spark.createDataFrame([("[raw/q/x.pdf#p1,2]",), ("[raw/q/y.pdf#p1]",), (f"[raw/q/zz{long}#p1]",), ("[raw/a/x.pdf#p1]",), ("[raw/no.pdf#p1]",), (None,)], "ref string")
    assert got(repair.repaired_anchors(refs, there)) == sorted(
        [
            ("[raw/q/x.pdf#p1,2]", "[raw/a/x.pdf#p1-2]", "basename"), ("[raw/q/y.pdf#p1]", "[raw/q/y.pdf#p1]", "basename-ambiguous (2)"), (f"[raw/q/zz{long}#p1]", f"[raw/c/{long}#p1]", "suffix"),
            ("[raw/a/x.pdf#p1]", "[raw/a/x.pdf#p1]", "exact"), ("[raw/no.pdf#p1]", "[raw/no.pdf#p1]", "no-match"),
        ]
    )


def test_imports(spark):
    f = spark.createDataFrame([("raw/books/a/X y.pdf",), ("raw/books/b/x_Y.epub",), ("raw/books/b/x-y.pdf",), ("raw/books/z.pdf",), ("raw/books/n.txt",), ("else/x.pdf",)], "path string")
    assert got(imports.discover(f), "stem", "discipline") == [("x-y", "a"), ("x-y-3", "b"), ("x-y-b", "b"), ("z", "uncategorized")]
    assert got(imports.discover(f, discipline="a"), "stem") == [("x-y",)]
    assert got(imports.layout(spark.createDataFrame([("a/x.pdf",), ("y.pdf",)], "path string"))) == [("mixed",)]
    assert imports.layout(f.limit(0)).count() == 0
    new = spark.createDataFrame([("a/[s] B.pdf", "1"), ("a/[t] B.pdf", "4"), ("a/B.PDF", "2"), ("a/C.pdf", "1"), ("d.pdf", "9")], "path string, sha256 string")
    old = spark.createDataFrame([("uncategorized", "q.pdf", "9")], "discipline string, name string, sha256 string")
    assert got(imports.import_plan(new, old), "path", "name", "action") == [("a/B.PDF", "B.pdf", "copy"), ("a/C.pdf", "C.pdf", "copy"), ("a/[s] B.pdf", "B.pdf", "skip"), ("a/[t] B.pdf", "B-2.pdf", "copy"), ("d.pdf", "d.pdf", "skip")]
    raw = spark.createDataFrame([("p", "1", "x" * 600), ("q", "2", "short"), ("r", "3", None)], "path string, sha256 string, text string")
    assert got(imports.conversion_state(raw, spark.createDataFrame([("1",)], "sha256 string")), "path", "state") == [("p", "cached"), ("q", "needs_ocr"), ("r", "needs_ocr")]


def test_files(spark, tmp_path, md):
    (tmp_path / "in" / "a").mkdir(parents=True)
    (tmp_path / "in" / "a" / "x.md").write_text("text " * 200)
    (tmp_path / "in" / "y.txt").write_text("one\fpage\f")
    raw = files.raw_files(spark, str(tmp_path / "in"), content=True)
    done = {r.path.rpartition("/")[2]: r for r in files.converted(raw).collect()}
    assert done["x.md"].state == "converted" and done["x.md"].language == "en"
    assert done["y.txt"].pages_total == 2 and "<!-- PAGE:2 -->" in done["y.txt"].text and done["y.txt"].state == "needs_ocr"
    assert files.read_html(b"<script>x</script><p>a &amp; b</p><p>c</p>") == "a & b\n\nc"
    assert files.read_epub(b"no zip") is None
    wiki = tmp_path / "wiki" / "concepts"
    wiki.mkdir(parents=True)
    (wiki / "a b.md").write_text("---\ntype: concept\n---\n# A\n")
    r = files.read_pages(spark, str(tmp_path / "wiki")).collect()
    assert [(x.slug, x.type) for x in r] == [("a b", "concept")]
    (tmp_path / "index.json").write_text(json.dumps({"version": 1, "page_count": 1, "pages": [{"slug": "s", "title": "S"}]}))
    assert files.read_index(spark, str(tmp_path / "index.json"), lambda: None).first().slug == "s"
    (tmp_path / "bad.json").write_text("not json")
    fallback = spark.createDataFrame([("w",)], "slug string")
    index = files.read_index(spark, str(tmp_path / "bad.json"), lambda: fallback)
    assert index is fallback or index.count() == 0
    files.write_pages(md.withColumn("type", F.lit("x")), str(tmp_path / "out"))
    assert files.read_snapshot(spark, str(tmp_path / "out")).count() == md.count()
    # a batch that fails leaves the last snapshot in place, a later one takes over
    with pytest.raises(Exception, match="no page"):
        files.write_pages(md.withColumn("type", F.raise_error(F.lit("no page")).cast("string")), str(tmp_path / "out"))
    assert files.read_snapshot(spark, str(tmp_path / "out")).count() == md.count()
    files.write_pages(md.limit(1).withColumn("type", F.lit("y")), str(tmp_path / "out"))
    assert [r.type for r in files.read_snapshot(spark, str(tmp_path / "out")).collect()] == ["y"]


def test_extract(spark):
    chunk = spark.createDataFrame([("b", "raw/books/b.pdf", 0, 1, 2, 3, 4, "We saw the Kite bridge. the Kite bridge fell."), ("b", "raw/books/b.pdf", 1, 5, 9, None, None, None)], "stem string, source_path string, chunk_index int, start_line int, end_line int, start_page int, end_page int, text string")
    r = got(extract.extract(chunk), "id", "claim", "provenance")
    assert r == [("kite-bridge", "We saw the Kite bridge", "[raw/books/b.pdf#p3-p4]"), ("kite-bridge", "the Kite bridge fell", "[raw/books/b.pdf#p3-p4]")]

    def broken(text, tag, anchor):
        raise ValueError("no")

    assert got(extract.extract(chunk, broken), "page_type", "summary") == [("failed", "ValueError: no")] * 2


def test_runs(spark, page, link, index):
    cols = "run_id long, stem string, source_path string, status string, chunk_count int, candidate_count int, staging_files int, validation_errors int, tokens_in long, tokens_out long, elapsed_sec double, finished_at timestamp, loaded_at timestamp"
    t = lambda d: datetime(2024, 1, d)
    rows = [(1, "a", "raw/books/h/a.pdf", "failed", 1, 1, 0, 0, 5, 1, 1.0, t(1), t(1)), (2, "a", "raw/books/h/a.pdf", "ok", 2, 3, 1, 0, 7, None, 2.0, t(2), t(2)), (2, "a", "raw/books/h/a.pdf", "ok", 2, 3, 1, 0, 9, None, 2.0, t(2), t(3)), (3, "b", "x.pdf", None, None, None, None, None, None, None, None, None, t(1))]
    run = spark.createDataFrame(rows, cols)
    assert got(runs.batch_report(run), "discipline", "books", "ok", "failed") == [("h", 1, 1, 0), ("uncategorized", 1, 0, 1)]
    assert got(runs.token_summary(run)) == [("a", 2, 14, 1, 3.0), ("b", 1, 0, 0, 0.0)]
    docs = spark.createDataFrame([("a",), ("c",), (None,)], "stem string")
    assert got(runs.to_do(docs, run)) == [("c",)]
    cand = spark.createDataFrame([("a", "i"), ("z", "i")], "stem string, id string")
    assert got(runs.expected_and_staged(docs, cand)) == [("a", "staged", 1), ("c", "missing", 0), ("z", "unexpected", 1)]
    wiki = pages.wiki(page)
    assert got(runs.by_alias(index)) == [("first letter", "omega-2")]
    assert got(runs.agents_index(wiki, link).where("slug = 'beta'"), "related_count") == [(2,)]
    assert runs.human_index(wiki).where("type = 'topic'").first().line.startswith("- [[Beta]] — See [[Alpha One]]")
    assert ("t", "beta") in got(runs.by_tag(wiki))
    assert runs.report_digest(runs.type_histogram(wiki), "type").first().sha256 == runs.report_digest(runs.type_histogram(wiki), "type").first().sha256


def test_links_by_title_follow_a_merge(spark, page):
    rows = [row(1, "kites", title="Kites"), row(2, "the-kites", title="On Kites"), row(3, "beta", title="Beta"), row(4, "the-beta", title="BETA")]
    twins = spark.createDataFrame(rows, PAGE)
    plan = spark.createDataFrame([("kites", "the-kites"), ("beta", "the-beta")], "canonical string, duplicate string")
    targets = ["the-kites", "On Kites", "[[on  kites|see]]", "Kites", "beta", "BETA", "the-beta", "nowhere", None]
    link = spark.createDataFrame([(i, "x", t) for i, t in enumerate(targets)], "link_id long, src_slug string, target string")
    want = ["kites", "Kites", "Kites", "Kites", "beta", "Beta", "beta", "nowhere", None]
    assert [r.target for r in merge.rewrite_links(link, plan, twins).orderBy("link_id").collect()] == want


def test_merged_candidates_keep_all_values(spark):
    cand = [(1, "b", 0, 0, "source", "s1"), (2, "b", 0, 1, "topic", "t"), (3, "b", 1, 0, "topic", "t"), (4, "b", 1, 1, "source", "s2"), (5, "c", 0, 0, "topic", "t")]
    cand = spark.createDataFrame(cand, "candidate_id long, stem string, chunk_index int, ord int, page_type string, id string")
    item = [
        ("b", "t", 1, 0, "claim", "A", "p9"), ("b", "t", 0, 0, "claim", "A", "p1"), ("b", "t", 0, 1, "claim", "B", "p2"), ("b", "t", 1, 1, "claim", "C", "p3"), ("b", "t", 1, 0, "adjacent", "x", None),
        ("b", "s2", 1, 0, "claim", "D", "p4"), ("b", "s1", 0, 5, "claim", "E", "p5"), ("b", "s2", 1, 0, "inference", "I", None), ("b", "s2", 1, 0, "topics", "t", None), ("c", "t", 0, 0, "claim", "A", "p1"),
    ]
    item = spark.createDataFrame(item, "stem string, id string, chunk_index int, ord int, kind string, value string, provenance string")
    assert got(merge.merge_items(item, cand), "stem", "id", "kind", "ord", "value", "provenance") == [
        ("b", "s1", "claim", 0, "E", "p5"), ("b", "s1", "claim", 1, "D", "p4"), ("b", "s1", "inference", 0, "I", None), ("b", "t", "adjacent", 0, "x", None),
        ("b", "t", "claim", 0, "A", "p1"), ("b", "t", "claim", 1, "B", "p2"), ("b", "t", "claim", 2, "C", "p3"), ("c", "t", "claim", 0, "A", "p1"),
    ]
