"""The core queries by name, and the SQL that each is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import catalog_pages
from lectern.catalog_sql import SQL as _CORE_SQL
from lectern.functions import text as t
from lectern.operators import collide, extract, imports, links, merge, pages, repair, rules, runs, search, segment
from lectern.operators.orphans import orphan_links, orphan_report
from lectern.plans.shared import read, stage_table

__all__ = ["QUERIES", "SQL"]

SQL = _CORE_SQL | catalog_pages.SQL | {"p2_by_year": _CORE_SQL["p2_report"]}


def _texts(s: SparkSession, d: str) -> DataFrame:
    """Distinct converted texts."""
    return read(s, d, "md_doc").where("text is not null").select("sha256", "text").distinct()


def _md(s: SparkSession, d: str) -> DataFrame:
    return pages.rendered(read(s, d, "page")).select("slug", "md")


def _wiki(s: SparkSession, d: str) -> DataFrame:
    return pages.wiki(read(s, d, "page"))


def _files(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "md_doc").select(F.col("source_path").alias("path")).where("path is not null").distinct()


def _sources(s: SparkSession, d: str) -> DataFrame:
    """The text of the book that a page names first, by its stem."""
    first = pages.landed(read(s, d, "page")).select("slug", F.regexp_extract(pages.fm("sources[0]"), r"([^/]+)\.[a-z]+$", 1).alias("stem"))
    books = read(s, d, "md_doc").where("text is not null").groupBy("stem").agg(F.min("text").alias("text"))
    return first.join(books, "stem").select("slug", "text")


def _queries_of(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "candidate").select(F.col("title").alias("query")).where("query is not null").distinct()


def _graph(s: SparkSession, d: str) -> DataFrame:
    return links.edges(read(s, d, "link"), _wiki(s, d))


def _seeds(s: SparkSession, d: str) -> DataFrame:
    return _wiki(s, d).where("type = 'analysis'").select("slug")


def _named(s: SparkSession, d: str) -> DataFrame:
    """Landed pages and index entries by slug and title."""
    return _wiki(s, d).select("slug", "title").unionByName(read(s, d, "wiki_index").select(F.col("id").alias("slug"), "title"))


def _refs(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "fact").select(F.col("provenance").alias("ref")).where("ref is not null").distinct()


def _book_files(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "md_doc").where("source_path is not null and sha256 is not null")
    return rows.select(F.regexp_replace("source_path", "^raw/books/", "").alias("path"), "sha256").distinct()


def _parsed_sections(s: SparkSession, d: str) -> DataFrame:
    rows = pages.parsed(_md(s, d)).select("slug", F.explode("sections").alias("x"))
    return rows.select("slug", F.col("x.header").alias("header"), F.col("x.body").alias("body")).where("header <> ''")


def _chunks(s: SparkSession, d: str) -> DataFrame:
    rows = segment.chunks(_texts(s, d), "sha256", most=300, least=60)
    return rows.select("sha256", F.col("chunk_index").cast("bigint").alias("chunk_index"), "start_line", "end_line", "start_page", "end_page", "word_count", "tag")


def _conversion(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "md_doc")
    done = read(s, d, "run_status").where("status = 'ok'").join(docs.select("stem", "sha256"), "stem").select("sha256").distinct()
    return imports.conversion_state(docs.select(F.col("source_path").alias("path"), "sha256", "text").distinct(), done)


def _extracted(s: SparkSession, d: str) -> DataFrame:
    paths = read(s, d, "md_doc").groupBy("stem").agg(F.min("source_path").alias("source_path"))
    return extract.extract(read(s, d, "chunk").join(paths, "stem", "left"))


def _plan(s: SparkSession, d: str) -> DataFrame:
    return merge.near_slug_plan(read(s, d, "page"))


def lint_of(s: SparkSession, d: str) -> DataFrame:
    return stage_table(rules.lint(stage_table(_md(s, d), "rendered"), None, _sources(s, d)), "violations")


QUERIES = {
    "p2_found": lambda s, d: orphan_links(read(s, d, "link"), read(s, d, "page")).select("link_id"),
    "p2_by_year": lambda s, d: orphan_report(read(s, d, "link"), read(s, d, "page"), by_year=True),
    "p2_report": lambda s, d: orphan_report(read(s, d, "link"), read(s, d, "page")),
    # sources, segmentation
    "s1_discover": lambda s, d: imports.discover(_files(s, d)),
    "s2_stems": lambda s, d: _files(s, d).select("path", t.book_stem(F.col("path")).alias("stem")),
    "s3_pages": lambda s, d: segment.mark_pages(read(s, d, "chunk"), "chunk_id").select("chunk_id", "page", F.length("body").cast("bigint").alias("chars")),
    "s6_conversion": _conversion,
    "s7_usable_chars": lambda s, d: _texts(s, d).select("sha256", t.usable_chars(F.col("text")).alias("usable")),
    "s13_raw_index": lambda s, d: repair.raw_index(_files(s, d)),
    "s14_import_plan": lambda s, d: imports.import_plan(_book_files(s, d), _book_files(s, d).select(F.lit("history").alias("discipline"), F.lit("none.pdf").alias("name"), "sha256").limit(0)),
    "b1_word_counts": lambda s, d: read(s, d, "chunk").where("text is not null").select("chunk_id", t.word_count(F.col("text")).alias("words"), "word_count"),
    "b2_paragraphs": lambda s, d: segment.paragraphs(_texts(s, d), "sha256"),
    "b4_chapters": lambda s, d: segment.chapters(segment.paragraphs(_texts(s, d), "sha256"), "sha256").groupBy("sha256", "chapter").agg(F.count("*").alias("paragraphs"), F.sum("words").alias("words")),
    "b7_page_spans": lambda s, d: read(s, d, "chunk").where("text is not null").select("chunk_id", t.page_of(F.col("text")).alias("first_page"), t.page_of(F.col("text"), last=True).alias("last_page")),
    "b9_chunks": _chunks,
    # extraction
    "c1_extract": _extracted,
    "c6_slug_ids": lambda s, d: read(s, d, "candidate").select("candidate_id", t.slug_id(F.col("title")).alias("slug_id")),
    "c7_provenance": lambda s, d: read(s, d, "fact").select("fact_id", t.normal_provenance(F.col("provenance"), F.lit("raw/books/history/the-paernon-studies.pdf")).alias("provenance")),
    "c9_merge_candidates": lambda s, d: merge.merge_candidates(read(s, d, "candidate")),
    "c11_source_pages": lambda s, d: merge.source_pages(read(s, d, "candidate"), read(s, d, "md_doc")),
    # rendering, parsing
    "r4_rendered": _md,
    "q1_sections": _parsed_sections,
    "q2_facts": lambda s, d: pages.facts_of(_md(s, d)),
    # rules
    "v1_frontmatter": lambda s, d: rules.frontmatter_schema(_md(s, d)),
    "v2_provenance": lambda s, d: rules.provenance_format(_md(s, d), None, 300),
    "v2_files": lambda s, d: rules.provenance_format(_md(s, d), _files(s, d)),
    "v3_prefixes": lambda s, d: rules.prefix_syntax(_md(s, d)),
    "v4_ids": lambda s, d: rules.id_uniqueness(_md(s, d), read(s, d, "wiki_index").select("id")),
    "v5_links": lambda s, d: rules.link_format(read(s, d, "link").where("target is not null").select(F.col("link_id").alias("slug"), F.concat(F.lit("[["), "target", F.lit("]]")).alias("md"))),
    "v6_unsourced": lambda s, d: rules.unsourced_facts(_md(s, d)),
    "v7_scope": lambda s, d: rules.scope_boundary(_md(s, d), _sources(s, d)),
    "v11_language": lambda s, d: rules.language_consistency(_md(s, d), _sources(s, d)),
    "v13_language": lambda s, d: read(s, d, "documents").where("text is not null").select("doc_id", t.language_zh_en(F.col("text")).alias("language")),
    "v10_raw_paths": lambda s, d: rules.raw_paths(read(s, d, "page").select("path").unionByName(_files(s, d)).distinct()),
    "f11_lint_totals": lambda s, d: rules.lint_totals(lint_of(s, d)),
    "f11_examples": lambda s, d: rules.examples(lint_of(s, d)),
    "f11_worst_pages": lambda s, d: rules.worst_pages(lint_of(s, d)),
    # collisions, links
    "f2_collisions": lambda s, d: collide.collision_reports(read(s, d, "candidate"), read(s, d, "wiki_index")),
    "f3_same_title": lambda s, d: collide.same_title(_named(s, d)),
    "f4_shared_names": lambda s, d: collide.shared_names(read(s, d, "wiki_index")),
    "f6_near_slugs": lambda s, d: collide.near_duplicate_slugs(_named(s, d)),
    "f7_report": lambda s, d: collide.top_conflicts(collide.same_title(_named(s, d).unionByName(read(s, d, "candidate").select("id", "title").toDF("slug", "title").where("slug is not null"))), "title"),
    "f9_dangling": lambda s, d: links.dangling(read(s, d, "link"), _wiki(s, d), read(s, d, "wiki_index")),
    "f10_index_drift": lambda s, d: links.index_drift(_wiki(s, d), read(s, d, "wiki_index")),
    "x_unlinked_pages": lambda s, d: links.unlinked_pages(read(s, d, "link"), _wiki(s, d)),
    # merge and repair
    "m4_frontmatter": lambda s, d: merge.merged_frontmatter(read(s, d, "page")),
    "m2_lists": lambda s, d: merge.merged_lists(read(s, d, "page")),
    "m5_claim_keys": lambda s, d: read(s, d, "fact").select("fact_id", merge.claim_key(F.concat(F.lit("- "), "claim", F.lit(" "), F.coalesce("provenance", F.lit("")))).alias("claim_key")),
    "m8_provenance": lambda s, d: merge.provenance_lines(read(s, d, "page")),
    "m12_fields": lambda s, d: _md(s, d).select("slug", F.explode(merge.allowed_fields(pages.front_keys(F.col("md")), pages.front_value(F.col("md"), "type"))).alias("field")),
    "m6_sections": lambda s, d: merge.merged_sections(read(s, d, "page")),
    "m7_related": lambda s, d: merge.related_links(read(s, d, "link")),
    "m10_land": lambda s, d: merge.land(read(s, d, "candidate").where("id is not null").select("page_type", F.col("id").alias("slug")), read(s, d, "page").select("page_type", "slug")),
    "m11_same_title_plan": lambda s, d: merge.same_title_plan(read(s, d, "page")),
    "m13_rewritten": lambda s, d: merge.rewrite_links(read(s, d, "link"), _plan(s, d), read(s, d, "page")),
    "m14_near_slug_plan": _plan,
    "m15_anchors": lambda s, d: _refs(s, d).select("ref", t.fix_anchor(F.col("ref")).alias("fixed")),
    "m16_paths": lambda s, d: repair.resolve_paths(_refs(s, d).select(F.regexp_extract("ref", r"(raw/[^#\]]+?)\s*#", 1).alias("path")).where("path <> ''"), _files(s, d)),
    "m17_repaired": lambda s, d: repair.repair_totals(repair.repaired_anchors(_refs(s, d), _files(s, d))),
    # queries
    "q3_bullets": lambda s, d: pages.landed(read(s, d, "page")).select("slug", F.posexplode(pages.bullets(pages.section("Inferences"))).alias("ord", "line")),
    "q4_list": lambda s, d: search.list_pages(_wiki(s, d), "topic").select("slug", "title"),
    "q5_find": lambda s, d: search.find_pages(_queries_of(s, d), _wiki(s, d), read(s, d, "wiki_index")),
    "q7_search": lambda s, d: search.search(_wiki(s, d), "survey map"),
    "q7_search_facts": lambda s, d: search.search(_wiki(s, d), "ing brid", ("title", "tags", "key_facts"), 50),
    "q8_outbound": lambda s, d: links.outbound(_md(s, d), read(s, d, "link")),
    "q9_neighbors": lambda s, d: links.neighbors(_graph(s, d), _seeds(s, d), 2),
    "q10_provenance": lambda s, d: links.provenance_of(_md(s, d)),
    # indexes, runs
    "k3_summaries": lambda s, d: pages.landed(read(s, d, "page")).select("slug", t.one_line(pages.section("Summary"), 90).alias("line")),
    "k4_agents_index": lambda s, d: runs.agents_index(_wiki(s, d), read(s, d, "link")),
    "k4_by_alias": lambda s, d: runs.by_alias(read(s, d, "wiki_index")),
    "k4_by_tag": lambda s, d: runs.by_tag(_wiki(s, d)),
    "k5_human_index": lambda s, d: runs.human_index(_wiki(s, d)),
    "k6_batch_report": lambda s, d: runs.batch_report(read(s, d, "run_status")),
    "k7_expected": lambda s, d: runs.expected_and_staged(read(s, d, "md_doc"), read(s, d, "candidate")),
    "k7_digest": lambda s, d: runs.report_digest(runs.type_histogram(_wiki(s, d)), "type"),
    "k8_types": lambda s, d: runs.type_histogram(_wiki(s, d)),
    "k10_to_do": lambda s, d: runs.to_do(read(s, d, "md_doc"), read(s, d, "run_status")),
    "k2_tokens": lambda s, d: runs.token_summary(read(s, d, "run_status")),
    # import
    "i1_file_names": lambda s, d: _files(s, d).select("path", t.clean_file_name(F.regexp_replace("path", "^.*/", "")).alias("name")),
    "i2_layout": lambda s, d: imports.layout(_book_files(s, d)),
}

QUERIES |= catalog_pages.QUERIES
