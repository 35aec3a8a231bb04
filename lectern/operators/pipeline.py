"""All steps from converted books to checked drafts, for all books at once or for some again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators import drafts, extract, merge, rules, segment
from lectern.plans.shared import stage_table


def books_of(md_doc: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """``stem, path, pages_total, day, text``: each book as it was converted first; with ``only(stem)`` just those."""
    best = F.min_by(F.struct(F.col("source_path").alias("path"), F.col("pages_total").cast("int").alias("pages_total"), F.date_format("converted_at", "yyyy-MM-dd").alias("day"), "text"), F.struct("converted_at", "sha256"))
    rows = md_doc.where("stem is not null and text is not null").groupBy("stem").agg(best.alias("b")).select("stem", "b.*")
    return rows if only is None else rows.join(only.select("stem").distinct(), "stem", "left_semi")


def ingest(md_doc: DataFrame, only: DataFrame | None = None, extractor: extract.Extractor = extract.rule_extractor, most: int = 30_000, least: int = 300) -> tuple[DataFrame, DataFrame]:
    """(``stem, id, md`` of the drafts, ``stem, chunk_count, failed_chunks, candidate_count, staging_files, validation_errors, status``).

    Chunks are cut, extracted, merged per book, rendered and checked. A book whose extraction fails in all chunks is
    ``failed``; one without candidates still gets its source page. With ``only(stem)`` just those books run again.
    """
    books = stage_table(books_of(md_doc, only), "books")
    chunks = segment.chunks(books, "stem", most=most, least=least).withColumnRenamed("body", "text")
    found = extract.extract(chunks.join(books.select("stem", F.col("path").alias("source_path")), "stem"), extractor)
    found = stage_table(found, "extracted")
    good = found.where("page_type <> 'failed'").join(books.select("stem", "day"), "stem")
    first = good.groupBy("stem", "chunk_index", "ord", "id").agg(*[F.min(c).alias(c) for c in ("page_type", "title", "summary", "day")])
    none = F.array().cast("array<string>")
    candidate = first.select(F.lit(0).alias("candidate_id"), "stem", "chunk_index", "ord", "page_type", "id", "title", none.alias("aliases"), "summary", none.alias("tags"), F.to_timestamp("day").alias("extracted_at"))
    drafted = drafts.merged_candidates(candidate)
    items = merge.merge_items(good.select("stem", "id", "chunk_index", "ord", F.lit("claim").alias("kind"), F.col("claim").alias("value"), "provenance"), candidate)
    made, made_items = drafts.source_drafts(drafted, books)
    drafted, items = stage_table(drafted.unionByName(made), "drafts"), items.unionByName(made_items)
    md = stage_table(drafts.as_markdown(drafts.draft_fields(drafted, books), drafts.draft_lines(drafted, items, books), drafted), "draft-pages")
    return md, _status(books, chunks, found, drafted, md)


def _status(books: DataFrame, chunks: DataFrame, found: DataFrame, drafted: DataFrame, md: DataFrame) -> DataFrame:
    per = lambda df, name, what=F.count("*"): df.groupBy("stem").agg(what.alias(name))
    rows = books.select("stem")
    failed = found.where("page_type = 'failed'")
    for one in (per(chunks, "chunk_count"), per(failed, "failed_chunks", F.countDistinct("chunk_index")), per(drafted, "candidate_count"), per(md, "staging_files"), validation(md)):
        rows = rows.join(one, "stem", "left")
    rows = rows.fillna(0)
    bad = (F.col("failed_chunks") > 0) & (F.col("failed_chunks") == F.col("chunk_count"))
    return rows.withColumn("status", F.when(bad, "failed").otherwise("ok"))


def validation(md: DataFrame) -> DataFrame:
    """``stem, validation_errors`` of drafts ``stem, id, md``: what the page rules find, books without any left out."""
    pages = md.select(F.concat("stem", F.lit("/"), "id").alias("slug"), "md")
    return rules.lint(pages).groupBy(F.substring_index("slug", "/", 1).alias("stem")).agg(F.count("*").alias("validation_errors"))


def revalidated(md: DataFrame, status: DataFrame) -> DataFrame:
    """``stem, was, now``: the violations of staged drafts beside those that ``status(stem, validation_errors)`` has."""
    now = md.select("stem").distinct().join(validation(md), "stem", "left").select("stem", F.coalesce("validation_errors", F.lit(0)).alias("now"))
    return now.join(status.select("stem", F.col("validation_errors").alias("was")), "stem", "left").select("stem", "was", "now")
