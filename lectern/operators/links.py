"""Links between pages: what they may name, dangling ones, neighbours, provenance lists and index drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import text as t
from lectern.functions.names import kebab, link_target, squeeze
from lectern.operators.pages import body_text
from lectern.plans.shared import stage_table


def link_names(wiki: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``name, slug``: every name a link may use, lower case; slugs come before titles and those before aliases.

    Of two pages under one name the first by (kind of name, slug) has it.
    """
    names = wiki.select(F.lower("slug").alias("name"), F.lit(0).alias("rank"), "slug").unionByName(wiki.select(squeeze(F.col("title")).alias("name"), F.lit(1).alias("rank"), "slug"))
    names = names.unionByName(wiki.select(kebab(F.col("title")).alias("name"), F.lit(3).alias("rank"), "slug"))
    if index is not None:
        alias = index.select(F.explode("aliases").alias("alias"), F.col("id").alias("slug"))
        names = names.unionByName(alias.select(squeeze(F.col("alias")).alias("name"), F.lit(2).alias("rank"), "slug"))
    return names.where("name <> ''").groupBy("name").agg(F.min(F.struct("rank", "slug")).alias("m")).select("name", F.col("m.slug").alias("slug"))


def resolved(link: DataFrame, wiki: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``link_id, src_slug, ord, target, slug`` with the page each target names, null if none; the target or its kebab form must be a name.

    Both joins have unique right sides, so hot targets are split by adaptive execution.
    """
    rows = link.select("link_id", "src_slug", "ord", "target", link_target(F.col("target")).alias("t"))
    rows = rows.select("*", squeeze(F.col("t")).alias("name"), kebab(F.col("t")).alias("kebab"))
    names = stage_table(link_names(wiki, index), "link-names")
    rows = rows.join(names.select("name", F.col("slug").alias("by_name")), "name", "left")
    rows = rows.join(names.select(F.col("name").alias("kebab"), F.col("slug").alias("by_kebab")), "kebab", "left")
    return rows.select("link_id", "src_slug", "ord", "target", F.coalesce("by_name", "by_kebab").alias("slug"))


def dangling(link: DataFrame, wiki: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``link_id, src_slug, target`` of the links that name no page."""
    return resolved(link, wiki, index).where("slug is null").select("link_id", "src_slug", "target")


def edges(link: DataFrame, wiki: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Distinct ``src, dst`` of links between pages, without loops."""
    return resolved(link, wiki, index).where("slug is not null and slug <> src_slug").select(F.col("src_slug").alias("src"), F.col("slug").alias("dst")).distinct()


def neighbors(graph: DataFrame, seeds: DataFrame, depth: int = 2) -> DataFrame:
    """``seed, slug, depth``: pages within ``depth`` links of each seed, at their least depth, seeds left out.

    Breadth first: each step joins the frontier with the edges and drops what was reached before.
    """
    reached = seeds.select(F.col("slug").alias("seed"), "slug", F.lit(0).alias("depth")).distinct()
    frontier = reached
    for d in range(1, depth + 1):
        step = frontier.join(graph, frontier["slug"] == graph["src"]).select("seed", F.col("dst").alias("slug")).distinct()
        frontier = stage_table(step.join(reached, ["seed", "slug"], "left_anti").withColumn("depth", F.lit(d)), "frontier")
        reached = reached.unionByName(frontier)
    return reached.where("depth > 0")


def outbound(md: DataFrame, link: DataFrame) -> DataFrame:
    """``slug, ord, target``: front matter links in their order, then the body's wiki links, each target once."""
    front = link.where("origin = 'frontmatter' and target is not null").select(F.col("src_slug").alias("slug"), F.struct(F.lit(0).alias("part"), "bucket", "ord", "link_id").alias("at"), "target")
    front = front.join(md.select("slug"), "slug", "left_semi")
    found = F.transform(F.regexp_extract_all(body_text(F.col("md")), F.lit(t.WIKILINK), F.lit(1)), lambda x: t.strip(F.regexp_replace(x, r"\|.*$", "")))
    body = md.select("slug", F.posexplode(found).alias("n", "target")).where("target <> ''")
    body = body.select("slug", F.struct(F.lit(1).alias("part"), F.lit(None).cast("string").alias("bucket"), F.col("n").alias("ord"), F.lit(None).cast("bigint").alias("link_id")).alias("at"), "target")
    first = front.unionByName(body).groupBy("slug", "target").agg(F.min("at").alias("at"))
    order = F.row_number().over(Window.partitionBy("slug").orderBy("at"))
    return first.select("slug", (order - 1).alias("ord"), "target")


def provenance_of(md: DataFrame) -> DataFrame:
    """``slug, ord, ref``: the front matter's sources, then the body's anchors, each once."""
    line = F.regexp_extract(F.col("md"), r"(?m)^sources: (\[.*\])$", 1)
    sources = F.coalesce(F.from_json(line, "array<string>"), F.array().cast("array<string>"))
    anchors = F.regexp_extract_all(body_text(F.col("md")), F.lit(t.ANY_ANCHOR), F.lit(0))
    return md.select("slug", F.posexplode(F.array_distinct(F.concat(sources, anchors))).alias("ord", "ref"))


def index_drift(wiki: DataFrame, index: DataFrame) -> DataFrame:
    """``title, side``: titles of the index without a page (``index``) and of pages without entry (``pages``)."""
    a = wiki.select(squeeze(F.col("title")).alias("title")).distinct().withColumn("page", F.lit(True))
    b = index.select(squeeze(F.col("title")).alias("title")).distinct().withColumn("entry", F.lit(True))
    return a.join(b, "title", "full_outer").where("page is null or entry is null").select("title", F.when(F.col("page").isNull(), "index").otherwise("pages").alias("side"))


def index_titles(index_md: DataFrame) -> DataFrame:
    """``title`` of the list items ``- [[title]]`` in the index's Markdown, code fences left out; ``index_md`` has ``text``."""
    bare = F.regexp_replace("text", r"(?ms)^```.*?^```\s*$", "")
    return index_md.select(F.explode(F.regexp_extract_all(bare, F.lit(r"(?m)^\s*-\s*\[\[([^\[\]|]+)"), F.lit(1))).alias("title")).select(t.strip(F.col("title")).alias("title"))


def unlinked_pages(link: DataFrame, wiki: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``slug`` of pages to which no other page links."""
    return wiki.select("slug").join(edges(link, wiki, index).select(F.col("dst").alias("slug")), "slug", "left_anti")
