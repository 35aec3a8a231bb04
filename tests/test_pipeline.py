from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lectern.operators import collide, pipeline, repair, rules, runs, search, segment
from lectern.operators.extract import rule_extractor

DOC = "stem string, source_path string, pages_total int, sha256 string, text string, converted_at timestamp, title string"
AT = datetime(2024, 3, 2)
TEXT = "# One\n\nWe saw the Kite bridge near town. It stood.\n\n# Two\n\nLater the Kite bridge fell. And the Opal tower rose."
DOCS = [
    ("kite", "raw/books/x/kite.pdf", 9, "s1", TEXT, AT, "clash"), ("kite", "raw/books/x/kite.pdf", 9, "s1", TEXT, datetime(2024, 4, 2), "clash"), ("plain_one", "raw/books/x/plain_one.epub", None, "s2", "nothing to see", AT, None),
    ("bad", "raw/books/x/bad.pdf", 1, "s3", "BOOM", AT, None), (None, "x", 1, "s4", "text", AT, None), ("null", "raw/books/x/null.pdf", 1, "s5", None, AT, None),
]


def test_all_steps(spark):
    def extractor(text: str, tag: str, anchor: str) -> list[dict]:
        if "BOOM" in text:
            raise ValueError("no")
        return rule_extractor(text, tag, anchor)

    df = spark.createDataFrame(DOCS, DOC).repartition(3)
    md, status = pipeline.ingest(df, extractor=extractor, most=20, least=2)
    pages = {(r.stem, r.id): r.md for r in md.collect()}
    assert set(pages) == {("kite", "kite-bridge"), ("kite", "opal-tower"), ("kite", "kite"), ("plain_one", "plain-one"), ("bad", "bad")}
    kite = pages["kite", "kite-bridge"]
    assert "We saw the Kite bridge near town. [raw/books/x/kite.pdf#L" in kite and "Later the Kite bridge fell. [raw/books/x/kite.pdf#L" in kite and "created: 2024-03-02" in kite
    assert "[raw/books/x/kite.pdf#p1-p9]" in pages["kite", "kite"]
    got = {r.stem: r for r in status.collect()}
    assert {k: (r.chunk_count, r.failed_chunks, r.candidate_count, r.staging_files, r.status) for k, r in got.items()} == {"kite": (2, 0, 3, 3, "ok"), "plain_one": (1, 0, 1, 1, "ok"), "bad": (1, 1, 1, 1, "failed")}
    again, one = pipeline.ingest(df, df.where("stem = 'kite'"), extractor, 20, 2)
    assert {(r.stem, r.id): r.md for r in again.collect()} == {k: v for k, v in pages.items() if k[0] == "kite"} and one.count() == 1
    broken = md.withColumn("md", F.when(F.col("id") == "opal-tower", F.replace("md", F.lit("type: concept"), F.lit("type: nonsense"))).otherwise(F.col("md")))
    seen = {r.stem: (r.was, r.now) for r in pipeline.revalidated(broken, status).collect()}
    assert seen["kite"] == (got["kite"].validation_errors, got["kite"].validation_errors + 1) and seen["bad"][0] == seen["bad"][1]
    none, empty = pipeline.ingest(df.limit(0), extractor=extractor)
    assert none.count() == empty.count() == 0


def test_packed_ranges_are_linear():
    assert segment.packed_ranges([], 5, 2) == [] and segment.packed_ranges([9], 5, 2) == [(0, 1, 0, 9)]
    assert segment.packed_ranges([2, 2, 4, 1], 5, 2) == [(0, 2, 0, 4), (2, 2, 0, 5)]
    assert segment.packed_ranges([5, 1], 5, 2) == [(0, 2, 1, 6)]
    assert sum(r[1] for r in segment.packed_ranges([1] * 300_000, 100, 2)) == 300_000


def test_repaired_bodies(spark):
    rows = [
        (1, "a", AT, [(0, "Key facts", "- One [raw/books/x/kite.pdf#p3,5] and [raw/wrong/kite.pdf#p1]"), (1, "Summary", "none"), (2, "Empty", None)], "c"),
        (2, "a", datetime(2020, 1, 1), [(0, "Key facts", "- Old [raw/books/x/kite.pdf#p3,5]")], "c"), (3, None, AT, None, None), (4, "b", AT, None, None),
    ]
    page = spark.createDataFrame(rows, "page_row_id long, slug string, landed_at timestamp, sections array<struct<ord int, header string, body string>>, path string")
    got = [tuple(r) for r in repair.repaired_bodies(page, spark.createDataFrame([("raw/books/x/kite.pdf",)], "path string")).collect()]
    assert got == [("a", 0, "- One [raw/books/x/kite.pdf#p3-5] and [raw/books/x/kite.pdf#p1]")]


def test_first_violations_of_each_rule(spark):
    rows = [("r", f"m{i:03d}", f"p{i % 7}") for i in range(200)] + [("q", "only", "x")]
    df = spark.createDataFrame(rows, "rule string, message string, slug string").repartition(5)
    got = [(r.place, r.slug, r.message) for r in rules.examples(df, 5).where("rule = 'r'").orderBy("place").collect()]
    assert got == [(i + 1, s, m) for i, (s, m) in enumerate(sorted((s, m) for _, m, s in rows[:200])[:5])]
    assert [r.rule for r in rules.examples(df, 5, "q").collect()] == ["q"] and rules.examples(df.limit(0)).count() == 0


def test_index_page_and_lookups(spark):
    wiki = spark.createDataFrame([("b", "Beta", "concept", "s"), ("a", "alpha", "concept", "")], "slug string, title string, type string, summary string")
    lines = [r.line for r in runs.index_page(wiki).orderBy("section", "title", "slug").collect()]
    assert lines[:6] == ["## Entities", "_None yet._", "## Concepts", "- [[alpha]]", "- [[Beta]] — s", "## Topics"]
    index = spark.createDataFrame([("x", "One", ["U", None]), ("y", "one ", None)], "id string, title string, aliases array<string>")
    assert {tuple(r) for r in runs.lookups(index).collect()} == {("by_title", "one", "y"), ("by_alias", "u", "x")}
    cand = spark.createDataFrame([(1, "x", "ONE", ["u"]), (2, "z", "none", None)], "candidate_id long, id string, title string, aliases array<string>")
    assert [tuple(r) for r in collide.collision_hits(cand, index).orderBy("place").collect()] == [(1, 1, "id", "x"), (1, 2, "title", "y")]
    names = spark.createDataFrame([("alpha",), ("gone",), (None,)], "query string")
    got = {r.query: (r.slug, r.error) for r in search.read_pages(names, wiki).collect()}
    assert got == {"alpha": ("a", None), "gone": (None, "no page: gone"), None: (None, "no page: ")}


def test_command_line(spark, sf, tmp_path, capsys):
    from lectern.__main__ import main

    assert main(["list"]) == 0 and "p2_report" in capsys.readouterr().out.split()
    assert main(["run", "k8_types", sf, str(tmp_path / "out")], spark) == 0 and spark.read.parquet(str(tmp_path / "out")).count() > 0
    assert main(["run", "nothing", sf], spark) == 2
    capsys.readouterr()
    assert main(["lint", sf, "--rule", "frontmatter_schema", "--limit", "3"], spark) == 1
    assert [x.split("\t")[0] for x in capsys.readouterr().out.splitlines()] == ["frontmatter_schema"] * 3
    assert main(["lint", sf, "--rule", "no such rule"], spark) == 0
