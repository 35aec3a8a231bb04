from __future__ import annotations

import json
import math
from datetime import datetime

from pyspark.sql import functions as F

from lectern.llm import survivors

PAGE = "page_row_id long, slug string, page_type string, path string, landed_at timestamp, removed_at timestamp, frontmatter string, title_line string, sections array<struct<ord int, header string, body string>>, value string, truth double"


def row(i, slug, at=1, sections=(), bad=None, **fm):
    return (i, slug, "concept", None, datetime(2024, 1, at), None, bad if bad is not None else json.dumps(fm), None, [(n, h, b) for n, (h, b) in enumerate(sections)], None, None)


ROWS = [
    row(1, "a", updated="2024-03-01", confidence="high", source_date="1851", sections=[("Summary", "The long story of it.")], sources=["s1"], tags=["x"]),
    row(2, "a", updated="5 March 2024", confidence="N/A", source_date="18", sections=[("Summary", "The long st…")], sources=["s2"], tags=["x", "y"]),
    row(3, "a", updated="2024/02/01", confidence="low", source_date="1851", sections=[("Key facts", "- (none recorded)"), ("Summary", "The long")], sources=["s1"], tags=["x"]),
    row(4, "b", updated="2024-01-01", confidence="low", source_author="  "), row(5, "b", updated=None, confidence="low"),
    row(6, "c", updated="March 3, 2024", reliability="primary"), row(7, "c", updated="2024-03-03", at=2, reliability="tertiary"),
    row(8, "d", updated="soon", source_author="X Y"), row(9, "d", updated="2020-01-01", source_author="Z"), row(10, "d", bad="not json"),
    row(11, "e", updated="2024-01-01", confidence="unknown"), row(12, "e", updated="2024-01-01", confidence=None),
    (13, None, None, None, None, None, None, None, None, None, None), (14, "f", None, None, None, None, None, None, None, None, None),
]


def test_rule(spark):
    got = {(r.slug, r.field_name): r.page_row_id for r in survivors.surviving_values(spark.createDataFrame(ROWS, PAGE).repartition(3)).collect()}
    assert got == {("a", "confidence"): 1, ("a", "source_date"): 1, ("a", "Summary"): 1, ("c", "reliability"): 7, ("d", "source_author"): 9}


def test_cut_off_without_pairs(spark):
    values = ["a", "ab", "abc", "x" * 30, "x" * 30 + "y", "x" * 40, "x" * 29 + "…", "x" * 24, "x" * 23, "q...", "qr", "lone...", "同", "同样", "some words [...]", "some words and more"]
    df = spark.createDataFrame([("s", "f", v) for v in values] + [("t", "f", "a"), ("s", "g", "abcd")], "slug string, field_name string, value string")
    got = {(r.slug, r.value) for r in survivors.cut_off(df).collect()}
    stem = lambda v: v.removesuffix("[...]").rstrip().removesuffix("…").removesuffix("...").rstrip()
    want = {("s", v) for v in values if any(o != v and stem(o).startswith(stem(v)) and (stem(o) != stem(v) or v != stem(v)) for o in values)}
    assert got == want


def test_dates(spark):
    texts = ["2024-01-02", "2024/1/2", "2 January 2024", "2 Jan 2024", "January 2, 2024", "2024年1月2日", "2024-01-02T10:00:00", "02.01.2024", "2nd January 2024", "", None, "soon", "2024"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(survivors.updated_on(F.col("t")).alias("d"))
    assert [str(r.d) for r in df.collect()] == ["2024-01-02"] * 9 + ["None"] * 4


def test_nothing(spark):
    texts = ["unknown", "N/A", "- (none recorded)", "(empty)", "?", "待补", "-", "TBD.", "todo", "not recorded", "real", "none of these"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(survivors.says_nothing(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [True] * 10 + [False] * 2


def brute(counts, copies, rounds):
    """The same model with a number for every pair of copy and value."""
    total = {}
    for slug, s, n in copies:
        total[slug] = total.get(slug, 0) + n
    keys = sorted({(a, f, v) for a, f, v, *_ in counts})
    said = {(a, f, v, s): n for a, f, v, s, n, _ in counts}
    truth = {k: (sum(n for (a, f, v, s), n in said.items() if (a, f, v) == k) + 0.5) / (total[k[0]] + 1) for k in keys}
    for _ in range(rounds):
        q = {}
        for s in {s for _, s, _ in copies}:
            t = fchance = ts = fs = 0.0
            for k in keys:
                n = sum(n for a, x, n in copies if a == k[0] and x == s)
                t, fchance = t + n * truth[k], fchance + n * (1 - truth[k])
                m = said.get((*k, s), 0)
                ts, fs = ts + m * truth[k], fs + m * (1 - truth[k])
            clip = lambda x: min(max(x, 0.01), 0.99)
            q[s] = clip((ts + 2) / (t + 4)), clip(1 - (fs + 1) / (fchance + 4))
        new = {}
        for k in keys:
            odds = 0.0
            for a, s, n in copies:
                if a == k[0]:
                    m = said.get((*k, s), 0)
                    silent = math.log((1 - q[s][0]) / q[s][1])
                    odds += n * silent + m * max(math.log(q[s][0] / (1 - q[s][1])) - silent, survivors.LEAST)
            new[k] = 1 / (1 + math.exp(-odds))
        truth = new
    return truth


def test_inference_like_brute_force(spark):
    counts = [("a", "tags", "x", "s1", 2, 1), ("a", "tags", "y", "s2", 1, 1), ("a", "c", "hi", "s1", 1, 1), ("b", "tags", "x", "s1", 1, 1), ("b", "tags", "z", "s3", 1, 1), ("b", "tags", "z", "s2", 1, 1)]
    copies = [("a", "s1", 2), ("a", "s2", 1), ("b", "s1", 1), ("b", "s2", 1), ("b", "s3", 1)]
    c = spark.createDataFrame([(*x[:5], float(x[4]), x[5]) for x in counts], "slug string, field_name string, value string, source string, n long, evidence double, possible int")
    could = [(a, f, s, n) for a, s, n in copies for f in {x[1] for x in counts if x[0] == a}]
    got = {(r.slug, r.field_name, r.value): r.truth for r in survivors.infer(c, spark.createDataFrame(could, "slug string, field_name string, source string, n long"), 3, 0.0).collect()}
    want = brute(counts, copies, 3)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def bad_source(latest: str) -> list[tuple]:
    """A source that states nothing but cut-off and empty values elsewhere states the latest value of ``z``."""
    rows = [row(100 + i, f"p{i}", updated="2024-01-01", source_author="A Long Name", sources=["good"]) for i in range(40)]
    rows += [row(200 + i, f"p{i}", updated="2024-02-01", source_author=["A Long", "unknown"][i % 2], sources=["bad"]) for i in range(40)]
    return rows + [row(300, "z", updated="2024-01-01", reliability="primary", sources=["good"]), row(301, "z", updated="2024-03-01", reliability="tertiary", sources=[latest])]


def test_posterior_decides(spark, monkeypatch):
    """The latest value survives unless its source is known to be bad; without the inference it always would."""
    at = lambda rows: {(r.slug, r.field_name): r.page_row_id for r in survivors.surviving_values(spark.createDataFrame(rows, PAGE)).collect()}["z", "reliability"]
    assert at(bad_source("new")) == 301
    assert at(bad_source("bad")) == 300
    monkeypatch.setattr(survivors, "infer", lambda counts, copies: counts.groupBy("slug", "field_name", "value").agg(F.sum("evidence").alias("odds")))
    assert at(bad_source("bad")) == 301


def test_last_section_of_a_header(spark):
    rows = [row(1, "a", updated="2024-01-01", sections=[("Summary", "First."), ("Summary", "Second.")]), row(2, "a", updated="2023-01-01", sections=[("Summary", "Other.")])]
    assert {r.summary for r in survivors.surviving_pages(spark.createDataFrame(rows, PAGE)).collect()} == {"Second."}


def test_pages(spark):
    got = {r.slug: r for r in survivors.surviving_pages(spark.createDataFrame(ROWS, PAGE)).collect()}
    assert set(got) == set("abcdef")
    assert got["a"].summary == "The long story of it." and got["a"].confidence == "high" and "x" in got["a"].tags
    assert got["f"].summary is None


def test_empty(spark):
    df = spark.createDataFrame([], PAGE)
    assert survivors.surviving_values(df).count() == 0 and survivors.surviving_pages(df).count() == 0
