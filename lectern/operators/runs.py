"""Indexes, reports and run bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.names import squeeze


def agents_index(wiki: DataFrame, link: DataFrame) -> DataFrame:
    """``slug, title, type, path, summary, fact_count, tag_count, related_count`` of each page."""
    related = link.where("origin = 'frontmatter'").groupBy(F.col("src_slug").alias("slug")).agg(F.countDistinct("bucket", "target").alias("related_count"))
    return wiki.join(related, "slug", "left").select(
        "slug", "title", "type", "path", "summary", F.size("facts").cast("bigint").alias("fact_count"), F.size("tags").cast("bigint").alias("tag_count"), F.coalesce("related_count", F.lit(0)).alias("related_count")
    )


def by_alias(index: DataFrame) -> DataFrame:
    """``alias, slug``: each alias in lower case; of several entries the last by id has it."""
    return index.select(F.explode("aliases").alias("a"), "id").groupBy(squeeze(F.col("a")).alias("alias")).agg(F.max("id").alias("slug"))


def by_tag(wiki: DataFrame) -> DataFrame:
    """``tag, slug`` of each page's tags, each once."""
    return wiki.select(F.explode("tags").alias("tag"), "slug").distinct()


def human_index(wiki: DataFrame) -> DataFrame:
    """``type, slug, line``: the index's lines in their order, by type and title; written in partitions, they are its sections."""
    line = F.concat(F.lit("- [["), "title", F.lit("]]"), F.when(F.col("summary") != "", F.concat(F.lit(" — "), "summary")).otherwise(""))
    return wiki.orderBy("type", F.lower("title"), "slug").select("type", "slug", line.alias("line"))


#: The sections of the index and their types, in their order.
INDEX_SECTIONS = {"entity": "Entities", "concept": "Concepts", "topic": "Topics", "source": "Sources", "analysis": "Analyses", "conflict": "Conflicts", "dashboard": "Dashboards"}


def index_page(wiki: DataFrame) -> DataFrame:
    """``section, title, slug, line``: the index as a page: a head for each section, its lines by title, and a note where it has none.

    Heads have an empty title and slug, so that sorting by the first three columns gives the page.
    """
    kinds = wiki.sparkSession.createDataFrame([(i, k, h) for i, (k, h) in enumerate(INDEX_SECTIONS.items())], "section int, type string, head string")
    heads = kinds.select("section", F.lit("").alias("title"), F.lit("").alias("slug"), F.concat(F.lit("## "), "head").alias("line"))
    lines = human_index(wiki).join(kinds, "type").join(wiki.select("slug", F.lower("title").alias("title")), "slug").select("section", "title", "slug", "line")
    none = kinds.join(wiki.select("type").distinct(), "type", "left_anti").select("section", F.lit("").alias("title"), F.lit("-").alias("slug"), F.lit("_None yet._").alias("line"))
    return heads.unionByName(lines).unionByName(none)


def lookups(index: DataFrame) -> DataFrame:
    """``kind, key, slug``: what a query index is asked by: titles and aliases in lower case; of several entries the last by id has one."""
    names = index.select(F.lit("by_title").alias("kind"), F.col("title").alias("name"), "id").unionByName(index.select(F.lit("by_alias").alias("kind"), F.explode("aliases").alias("name"), "id"))
    return names.where("name is not null").groupBy("kind", squeeze(F.col("name")).alias("key")).agg(F.max("id").alias("slug"))


def type_histogram(pages: DataFrame) -> DataFrame:
    return pages.groupBy("type").agg(F.count("*").alias("pages"))


def last_runs(run_status: DataFrame) -> DataFrame:
    """The row of each book's last run; redelivered rows count as they were loaded last."""
    rest = [c for c in run_status.columns if c != "stem"]
    best = run_status.where("stem is not null").groupBy("stem").agg(F.max_by(F.struct(*rest), F.struct("finished_at", "loaded_at", "run_id")).alias("r"))
    return best.select("stem", "r.*")


def batch_report(run_status: DataFrame) -> DataFrame:
    """``discipline, books, ok, failed, clean, chunks, candidates, violations`` of the last runs; the discipline is the folder in the path."""
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("bigint")
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    folder = F.regexp_extract("source_path", r"^raw/books/([^/]+)/", 1)
    return last_runs(run_status).groupBy(F.when(folder == "", "uncategorized").otherwise(folder).alias("discipline")).agg(
        F.count("*").alias("books"), one(ok).alias("ok"), one(~ok).alias("failed"), one(ok & (F.coalesce("validation_errors", F.lit(0)) == 0)).alias("clean"),
        total("chunk_count").alias("chunks"), total("candidate_count").alias("candidates"), total("validation_errors").alias("violations"),
    )


def expected_and_staged(md_doc: DataFrame, candidate: DataFrame) -> DataFrame:
    """``stem, state, pages``: converted books beside their candidates; books without any are ``missing``, unknown ones ``unexpected``."""
    a = md_doc.where("stem is not null").select("stem").distinct().withColumn("there", F.lit(True))
    b = candidate.where("stem is not null").groupBy("stem").agg(F.countDistinct("id").alias("pages"))
    both = a.join(b, "stem", "full_outer")
    state = F.when(F.col("there").isNull(), "unexpected").when(F.col("pages").isNull(), "missing").otherwise("staged")
    return both.select("stem", state.alias("state"), F.coalesce("pages", F.lit(0)).alias("pages"))


def to_do(md_doc: DataFrame, run_status: DataFrame) -> DataFrame:
    """``stem`` of the converted books whose last run isn't ok with staged files."""
    done = last_runs(run_status).where("status = 'ok' and staging_files > 0").select("stem")
    return md_doc.where("stem is not null").select("stem").distinct().join(done, "stem", "left_anti")


def token_summary(run_status: DataFrame) -> DataFrame:
    """``stem, runs, tokens_in, tokens_out, seconds`` over all runs of each book, redelivered rows once."""
    rows = run_status.where("stem is not null").groupBy("stem", "run_id").agg(*[F.max_by(c, "loaded_at").alias(c) for c in ("tokens_in", "tokens_out", "elapsed_sec")])
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("bigint").alias(c)
    return rows.groupBy("stem").agg(F.count("*").alias("runs"), total("tokens_in"), total("tokens_out"), F.round(F.sum(F.coalesce("elapsed_sec", F.lit(0.0))), 1).alias("seconds"))


def report_digest(report: DataFrame, *order: str) -> DataFrame:
    """``sha256`` of a small report's lines in the given order."""
    line = F.concat_ws("|", *[F.col(c).cast("string") for c in report.columns])
    rows = report.agg(F.array_sort(F.collect_list(F.struct(*order, line.alias("line")))).alias("all"))
    return rows.select(F.sha2(F.array_join(F.transform("all", lambda x: x["line"]), "\n"), 256).alias("sha256"))
