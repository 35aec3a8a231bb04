"""Merging of pages and candidates: ordered unions, claims, whole pages, and plans for duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.names import link_target, squeeze
from lectern.functions.text import slug_key, strip
from lectern.operators.pages import bullets, landed, section
from lectern.operators.rules import OPTIONAL, REQUIRED

#: The buckets of related links, in the order in which they are written.
BUCKETS = ("broader", "narrower", "adjacent", "concepts", "topics", "entities")


def ordered_union(a: Column, b: Column) -> Column:
    """The values of both lists, each where it comes first; null lists are empty."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(a, none), F.coalesce(b, none)))


def merge_related(a: Column, b: Column) -> Column:
    """The union of two maps of lists by key, without empty lists."""
    return F.map_filter(F.map_zip_with(a, b, lambda k, x, y: ordered_union(x, y)), lambda k, v: F.size(v) > 0)


def claim_key(line: Column) -> Column:
    """What two bullets share that state the same: no list sign, no anchors at the end, lower case."""
    bare = F.regexp_replace(line, r"^\s*-\s*", "")
    return F.lower(strip(F.when(bare.rlike(r"\]\s*$"), F.regexp_replace(bare, r"(?s)\[raw/.*$", "")).otherwise(bare)))


def merge_bullets(rows: DataFrame) -> DataFrame:
    """``slug, section, ord, line``: of ``slug, section, side, ord, line`` the first line of each claim, in the order of the sides.

    A claim counts once per section however many copies state it; claims are reduced before they are numbered, and
    numbering streams through a sorted partition.
    """
    key = claim_key(F.col("line"))
    first = rows.groupBy("slug", "section", key.alias("key")).agg(F.min(F.struct("side", "ord", "line")).alias("f"))
    order = F.row_number().over(Window.partitionBy("slug", "section").orderBy("f"))
    return first.select("slug", "section", (order - 1).alias("ord"), F.col("f.line").alias("line"))


def merged_sections(page: DataFrame) -> DataFrame:
    """``slug, section, ord, line`` of the bullet sections of all copies of each slug, earlier landings first."""
    rows = None
    for h in ("Key facts", "Inferences", "Uncertainties"):
        one = page.where("slug is not null").select("slug", F.lit(h).alias("section"), F.struct("landed_at", "page_row_id").alias("side"), F.posexplode(bullets(section(h))).alias("ord", "line"))
        rows = one if rows is None else rows.unionByName(one)
    return merge_bullets(rows)


def merged_frontmatter(page: DataFrame) -> DataFrame:
    """``slug, title, created, updated``: of the copies of each slug the first landed title and creation date, and the last update."""
    get = lambda k: F.get_json_object("frontmatter", f"$.{k}")
    when = F.struct("landed_at", "page_row_id")
    scalar = lambda k: F.min_by(get(k), F.when(get(k).isNotNull(), when)).alias(k)
    iso = F.when(get("updated").rlike(r"^\d{4}-\d{2}-\d{2}$"), get("updated"))
    return page.where("slug is not null").groupBy("slug").agg(scalar("title"), scalar("created"), F.max(iso).alias("updated"))


def merged_lists(page: DataFrame) -> DataFrame:
    """``slug, field, ord, value``: the union of the copies' sources, tags and aliases, each value where it came first."""
    rows = None
    for k in ("sources", "tags", "aliases"):
        values = F.from_json(F.get_json_object("frontmatter", f"$.{k}"), "array<string>")
        one = page.where("slug is not null").select("slug", F.lit(k).alias("field"), F.struct("landed_at", "page_row_id").alias("w"), F.posexplode(values).alias("at", "value"))
        rows = one if rows is None else rows.unionByName(one)
    first = rows.where("value is not null").groupBy("slug", "field", "value").agg(F.min(F.struct("w", "at")).alias("f"))
    order = F.row_number().over(Window.partitionBy("slug", "field").orderBy("f", "value"))
    return first.select("slug", "field", (order - 1).alias("ord"), "value")


def related_links(link: DataFrame) -> DataFrame:
    """``src_slug, bucket, place, ord, target``: each bucket's targets once, in the order in which they were first recorded; place is the bucket's."""
    place = F.array_position(F.array(*map(F.lit, BUCKETS)), F.col("bucket"))
    rows = link.where(F.col("bucket").isin(*BUCKETS)).select("src_slug", "bucket", place.alias("place"), link_target(F.col("target")).alias("t"), "recorded_at", "ord", "link_id").where("t is not null")
    first = rows.groupBy("src_slug", "bucket", "place", squeeze(F.col("t")).alias("key")).agg(F.min(F.struct("recorded_at", "ord", "link_id", "t")).alias("f"))
    order = F.row_number().over(Window.partitionBy("src_slug", "bucket").orderBy("f"))
    return first.select("src_slug", "bucket", "place", (order - 1).alias("ord"), strip(F.col("f.t")).alias("target"))


def land(staged: DataFrame, existing: DataFrame) -> DataFrame:
    """``page_type, slug, action`` of staged pages: ``merged`` into one that is there, or ``created``; later copies of one slug merge into the first."""
    rows = staged.groupBy("page_type", "slug").agg(F.count("*").alias("copies"))
    there = existing.select("page_type", "slug").distinct().withColumn("there", F.lit(True))
    joined = rows.join(there, ["page_type", "slug"], "left")
    return joined.select("page_type", "slug", F.when(F.col("there"), "merged").otherwise("created").alias("action"), (F.col("copies") - F.when(F.col("there"), 0).otherwise(1)).alias("merges"))


def merge_candidates(candidate: DataFrame) -> DataFrame:
    """``stem, id, page_type, title, summary, parts`` of a book's candidates with one id: the first chunk's values."""
    when = F.struct("chunk_index", "ord", "candidate_id")
    rows = candidate.where("stem is not null and id is not null").groupBy("stem", "id").agg(F.min(F.struct(when.alias("w"), "page_type", "title", "summary")).alias("f"), F.count("*").alias("parts"))
    return rows.select("stem", "id", F.col("f.page_type").alias("page_type"), F.col("f.title").alias("title"), F.col("f.summary").alias("summary"), "parts")


def merge_items(item: DataFrame, candidate: DataFrame) -> DataFrame:
    """``stem, id, kind, ord, value, provenance``: each value of merged candidates once per kind, as it came first.

    ``item`` has ``stem, id, chunk_index, ord, kind, value, provenance``; a kind is ``claim``, ``inference``,
    ``uncertainty`` or a bucket of links. A book's further source pages give their values, but for links, to its first.
    """
    when = F.struct("chunk_index", "ord", "candidate_id")
    ids = candidate.where("stem is not null and id is not null").groupBy("stem", "id").agg(F.min(F.struct(when.alias("w"), "page_type")).alias("c"))
    first = ids.where("c.page_type = 'source'").groupBy("stem").agg(F.min(F.struct("c.w", "id")).alias("s"))
    rows = item.where("value is not null").join(ids, ["stem", "id"]).join(first, "stem", "left")
    rows = rows.withColumn("owner", F.when(F.col("c.page_type") == "source", F.col("s.id")).otherwise(F.col("id")))
    rows = rows.where((F.col("owner") == F.col("id")) | ~F.col("kind").isin(*BUCKETS))
    once = rows.groupBy("stem", "owner", "kind", "value").agg(F.min(F.struct("c.w", "chunk_index", "ord", "provenance")).alias("f"))
    order = F.row_number().over(Window.partitionBy("stem", "owner", "kind").orderBy("f", "value"))
    return once.select("stem", F.col("owner").alias("id"), "kind", (order - 1).alias("ord"), "value", F.col("f.provenance").alias("provenance"))


def provenance_lines(page: DataFrame) -> DataFrame:
    """``slug, ord, line``: the provenance section of each merged page; its first source is the primary one."""
    rows = merged_lists(page).where("field = 'sources'")
    return rows.select("slug", "ord", F.concat(F.when(F.col("ord") == 0, "- Primary source: ").otherwise("- Additional source: "), "value").alias("line"))


def source_pages(candidate: DataFrame, md_doc: DataFrame) -> DataFrame:
    """``stem, title, made``: one source page per book; the first candidate of that type, or one made from the path."""
    first = candidate.where("page_type = 'source' and stem is not null").groupBy("stem").agg(F.min(F.struct("chunk_index", "ord", "candidate_id", "title")).alias("f"))
    books = md_doc.where("stem is not null").groupBy("stem").agg(F.min("source_path").alias("path"))
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace("path", "^.*/", ""), r"\.[^.]+$", ""), "[_-]+", " ")
    return books.join(first, "stem", "left").select("stem", F.coalesce("f.title", strip(name)).alias("title"), F.col("f").isNull().alias("made"))


def page_sizes(page: DataFrame) -> DataFrame:
    """``slug, title, page_type, size`` of the landed pages; the size is the bytes of their sections."""
    size = F.aggregate(F.transform("sections", lambda s: F.octet_length(F.coalesce(s["body"], F.lit("")))), F.lit(0), lambda a, x: a + x)
    return landed(page).select("slug", squeeze(F.coalesce(F.get_json_object("frontmatter", "$.title"), F.col("slug"))).alias("title"), "page_type", F.coalesce(size, F.lit(0)).cast("bigint").alias("size"))


def _plan(rows: DataFrame, key: str, across_types: bool) -> DataFrame:
    """Groups with a canonical page each: the largest, then that of the shortest slug, then by slug."""
    rank = F.struct((-F.col("size")).alias("size"), F.length("slug").alias("n"), "slug")
    per = rows.groupBy(key).agg(F.count("*").alias("n"), F.countDistinct("page_type").alias("types"), F.collect_set("page_type").alias("kinds"), F.min(rank).alias("best"))
    per = per.where("n > 1 and not (array_contains(kinds, 'concept') and array_contains(kinds, 'source'))")
    if not across_types:
        per = per.where("types = 1")
    return rows.join(per.select(key, F.col("best.slug").alias("canonical")), key).where("slug <> canonical").select(key, "canonical", F.col("slug").alias("duplicate"))


def same_title_plan(page: DataFrame, across_types: bool = False) -> DataFrame:
    """``title, canonical, duplicate``: pages to merge because their titles agree; never concepts with sources."""
    return _plan(page_sizes(page), "title", across_types)


def near_slug_plan(page: DataFrame) -> DataFrame:
    """``slug_key, canonical, duplicate``: pages to merge because their slugs nearly agree."""
    return _plan(page_sizes(page).withColumn("slug_key", slug_key(F.col("slug"))), "slug_key", False)


def rewrite_links(link: DataFrame, plan: DataFrame, page: DataFrame | None = None) -> DataFrame:
    """``link_id, src_slug, target``: links to and from duplicates now name the canonical page.

    A link that has a duplicate's slug gets the canonical slug; with ``page`` one that has its title gets the canonical
    title, letter case and white space aside.
    """
    moves = plan.select(F.col("duplicate").alias("slug"), "canonical").distinct()
    rows = link.select("link_id", "src_slug", "target", link_target(F.col("target")).alias("t"))
    rows = rows.join(moves.select(F.col("slug").alias("t"), F.col("canonical").alias("to")), "t", "left")
    rows = rows.join(moves.select(F.col("slug").alias("src_slug"), F.col("canonical").alias("from")), "src_slug", "left")
    to = [F.col("to")]
    if page is not None:
        named = landed(page).select("slug", strip(F.coalesce(F.get_json_object("frontmatter", "$.title"), F.col("slug"))).alias("title"))
        titles = moves.join(named, "slug").select("canonical", squeeze(F.col("title")).alias("key"))
        titles = titles.join(named.select(F.col("slug").alias("canonical"), F.col("title").alias("to_title")), "canonical")
        titles = titles.where("key <> ''")
        titles = titles.groupBy("key").agg(F.min(F.struct("canonical", "to_title")).alias("by_title"))
        rows = rows.withColumn("key", squeeze(F.col("t"))).join(titles, "key", "left")
        to.append(F.when(F.col("t") != F.col("by_title.canonical"), F.col("by_title.to_title")))
    return rows.select("link_id", F.coalesce("from", "src_slug").alias("src_slug"), F.coalesce(*to, "target").alias("target"))


def allowed_fields(keys: Column, kind: Column) -> Column:
    """The keys that a page of the type may have; all where the type is unknown."""
    both = F.create_map(*[x for k in REQUIRED for x in (F.lit(k), F.array(*map(F.lit, {*REQUIRED[k], *OPTIONAL[k], "id"})))])[kind]
    return F.when(both.isNull(), keys).otherwise(F.array_intersect(keys, both))
