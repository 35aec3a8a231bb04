"""From converted text to chunks: pages, paragraphs, chapters, and greedy packing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import text as t


def mark_pages(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, page, body`` of text whose pages end in form feeds; blank pages are dropped but keep their number."""
    rows = df.select(key, F.posexplode(F.split(text, "\f")).alias("at", "body"))
    return rows.where(t.strip(F.col("body")) != "").select(key, (F.col("at") + 1).alias("page"), "body")


def paragraphs(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, start_line, end_line, body`` of maximal runs of non-blank lines; a null or blank text has none.

    Lines are folded inside the row, so nothing is shuffled however many documents there are.
    """
    # Each line carries its number, blank ones become marks; the text is then cut at the marks.
    plain = t.lines(F.translate(text, "\u0000\u0001", ""))
    marked = F.transform(plain, lambda x, i: F.when(t.strip(x) == "", "\u0000").otherwise(F.concat((i + 1).cast("string"), F.lit("\u0001"), x)))
    parts = F.filter(F.split(F.array_join(marked, "\n"), "\n?\u0000\n?(?:\u0000\n?)*"), lambda x: x != "")
    rows = df.select(key, F.explode(parts).alias("part"))
    first = F.regexp_extract("part", "^([0-9]+)\u0001", 1).cast("int")
    body = F.regexp_replace("part", "(?m)^[0-9]+\u0001", "")
    return rows.select(key, first.alias("start_line"), (first + F.regexp_count("part", F.lit("\n"))).cast("int").alias("end_line"), body.alias("body"))


def chapters(paras: DataFrame, key: str) -> DataFrame:
    """Paragraphs with ``chapter`` (0 for what precedes the first heading) and ``words``.

    A page marker above a heading doesn't hide it.
    """
    first = F.get(F.split(F.regexp_replace("body", rf"^(?:\s*{t.PAGE_MARKER}\s*\n)+", ""), "\n"), F.lit(0))
    order = Window.partitionBy(key).orderBy("start_line").rowsBetween(Window.unboundedPreceding, 0)
    return paras.select("*", t.is_chapter(first).alias("heads"), t.word_count(F.col("body")).alias("words")).withColumn(
        "chapter", F.sum(F.col("heads").cast("int")).over(order).cast("int")
    )


def packed_ranges(words: list[int], most: int, least: int) -> list[tuple[int, int, int, int]]:
    """(first paragraph, paragraphs, how many of them are a joined tail, words) of each chunk of a chapter.

    A chunk is closed when the next paragraph would carry it beyond ``most`` words; a last one with fewer than ``least``
    joins the one before. One pass.
    """
    out: list[tuple[int, int, int, int]] = []
    for i, n in enumerate(words):
        if out and out[-1][3] + n <= most:
            first, count, _, total = out[-1]
            out[-1] = first, count + 1, 0, total + n
        else:
            out.append((i, 1, 0, n))
    if len(out) > 1 and out[-1][3] < least:
        _, count, _, total = out.pop()
        first, before, _, sum_ = out[-1]
        out[-1] = first, before + count, count, sum_ + total
    return out


def _ranges(words: Column, most: int, least: int) -> Column:
    """``packed_ranges`` of a column of word counts; only the counts go to Python, in Arrow batches."""

    @F.pandas_udf("array<struct<first:int,n:int,tail:int,words:bigint>>")
    def cut(col: pd.Series) -> pd.Series:
        return col.map(lambda ws: [dict(zip(("first", "n", "tail", "words"), r)) for r in packed_ranges([int(w) for w in ws], most, least)])

    return cut(words)


def chunks(df: DataFrame, key: str, text: str = "text", most: int = 30_000, least: int = 300) -> DataFrame:
    """``key, chunk_index, start_line, end_line, start_page, end_page, word_count, tag, body``.

    Chunks never cross chapters; a paragraph longer than ``most`` words stays whole; a chapter's last chunk with fewer
    than ``least`` words joins the one before. A chapter is gathered in one row, and packed in time linear in its length.
    Chunks without a page marker have the page that was last seen before.
    """
    p = chapters(paragraphs(df, key, text), key)
    one = F.struct("start_line", "end_line", "words", "body", "heads")
    per = p.groupBy(key, "chapter").agg(F.array_sort(F.collect_list(one)).alias("paras"))
    per = per.select(key, "chapter", "paras", F.get("paras", F.lit(0)).alias("head"), _ranges(F.transform("paras", lambda x: x["words"]), most, least).alias("ranges"))
    joined = lambda first, n: F.array_join(F.transform(F.slice("paras", first + 1, n), lambda x: x["body"]), "\n")
    whole = lambda r: F.when(r["tail"] == 0, joined(r["first"], r["n"])).otherwise(
        F.concat(joined(r["first"], r["n"] - r["tail"]), F.lit("\n\n"), joined(r["first"] + r["n"] - r["tail"], r["tail"]))
    )
    packed = F.transform(
        "ranges",
        lambda r: F.struct(
            F.get("paras", r["first"])["start_line"].alias("start_line"), F.get("paras", r["first"] + r["n"] - 1)["end_line"].alias("end_line"), r["words"].alias("words"), whole(r).alias("body")
        ),
    )
    heading = F.regexp_replace(F.col("head.body"), rf"^(?:\s*{t.PAGE_MARKER}\s*\n)+", "")
    tag = F.when(F.col("head.heads"), F.substring(t.strip(F.get(F.split(heading, "\n"), F.lit(0))), 1, 80))
    rows = per.select(key, tag.alias("tag"), F.explode(packed).alias("c")).select(key, "tag", "c.*")
    order = Window.partitionBy(key).orderBy("start_line")
    seen = F.last(t.page_of(F.col("body"), last=True), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return rows.select(
        key, (F.row_number().over(order) - 1).alias("chunk_index"), "start_line", "end_line",
        F.coalesce(t.page_of(F.col("body")), seen).alias("start_page"),
        F.coalesce(t.page_of(F.col("body"), last=True), seen).alias("end_page"),
        F.col("words").alias("word_count"), "tag", "body",
    )
