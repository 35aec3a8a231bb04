"""Pages from candidates, and copies of pages merged whole.

A page is given as rows: its fields in their order, and its lines by section and place. So a page of any size stays
distributed; written sorted, the rows are the page, and ``as_markdown`` gathers those of pages of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import strip
from lectern.operators.merge import BUCKETS, claim_key, merged_lists
from lectern.operators.rules import ENUMS

#: The sections of a page in their order; the tail ones stay behind sections that are added.
SECTIONS = ("Summary", "Key facts", "Inferences", "Uncertainties", "Related pages", "Provenance", "Change notes")
TAIL = ("Related pages", "Provenance", "Change notes")
BULLETS = ("Key facts", "Inferences", "Uncertainties")
#: The fields that a type has beside the common ones, and what they hold where nothing is given.
DEFAULTS = {
    "entity": (("canonical", "true"), ("confidence", "medium")),
    "concept": (("confidence", "medium"),),
    "topic": (("confidence", "medium"),),
    "source": (("source_kind", "book"), ("source_path", None), ("source_date", ""), ("source_author", ""), ("reliability", "unknown")),
    "analysis": (("question", ""), ("confidence", "medium")),
}
#: What a field outside its set of values becomes, and the types whose related links its front matter lists.
FALLBACK = {"source_kind": "book", "reliability": "unknown", "confidence": "medium"}
RELATED = {"entity": ("concepts", "topics", "entities"), "concept": ("broader", "narrower", "adjacent"), "topic": ("concepts", "entities")}


def _json(values: Column) -> Column:
    return F.to_json(F.coalesce(values, F.array().cast("array<string>")))


def merged_candidates(candidate: DataFrame) -> DataFrame:
    """One row per book and id: the first chunk's ``page_type, title, summary, aliases, tags, extra``, its place, and ``day``.

    Of a book's source pages only the first is kept; ``merge.merge_items`` gives it the parts of the others.
    ``candidate`` may have ``extra``, a map of further fields. The day is that of the first extraction.
    """
    none = F.lit(None).cast("map<string,string>")
    rows = candidate.where("stem is not null and id is not null").withColumn("extra", F.col("extra") if "extra" in candidate.columns else none)
    value = F.struct(F.struct("chunk_index", "ord", "candidate_id").alias("w"), "page_type", "title", "summary", "aliases", "tags", F.col("extra").alias("extra"))
    best = F.min_by(value, value["w"])
    out = rows.groupBy("stem", "id").agg(best.alias("f"), F.date_format(F.min("extracted_at"), "yyyy-MM-dd").alias("day"))
    out = out.select("stem", "id", *[F.col(f"f.{c}").alias(c) for c in ("page_type", "title", "summary", "aliases", "tags", "extra")], F.col("f.w").alias("first"), "day")
    source = out.where("page_type = 'source'").groupBy("stem").agg(F.min(F.struct("first", "id")).alias("s"))
    out = out.join(source, "stem", "left").where("coalesce(page_type, '') <> 'source' or id = s.id")
    return out.drop("s")


def draft_fields(drafts: DataFrame, paths: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``stem, id, place, key, value``: the front matter of each merged candidate, with its type's defaults.

    ``paths`` has ``stem, path``; ``links`` has ``stem, id, bucket, targets``. Given fields come before defaults; values
    outside a field's set become its fallback; only entities have aliases. Lists are JSON arrays.
    """
    rows = drafts.join(paths.select("stem", "path"), "stem", "left")
    extra = F.coalesce("extra", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    entity = F.col("page_type") == "entity"

    def field(key: str, default: Column) -> Column:
        given = F.try_element_at(extra, F.lit(key))
        value = F.coalesce(given, default)
        if key in FALLBACK:
            value = F.when(value.isin(*ENUMS[key]), value).otherwise(FALLBACK[key])
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    path = F.coalesce("path", F.lit(""))
    common = [
        ("id", F.col("id")), ("title", F.col("title")), ("type", F.col("page_type")), ("status", F.lit("draft")), ("created", F.col("day")), ("updated", F.col("day")),
        ("sources", F.when(path == "", F.lit("[]")).otherwise(F.to_json(F.array(path)))),
    ]
    known = {k for k, _ in common} | {"aliases", "tags"}
    out = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in common])
    none = F.array().cast("array<struct<key:string,value:string>>")
    out = F.concat(out, F.when(entity, F.array(field("aliases", _json(F.col("aliases"))))).otherwise(none))
    typed = none
    for kind, fields in DEFAULTS.items():
        typed = F.when(F.col("page_type") == kind, F.array(*[field(k, path if v is None else F.lit(v)) for k, v in fields])).otherwise(typed)
        known |= {k for k, _ in fields}
    rest = F.transform(F.map_entries(F.map_filter(extra, lambda k, v: ~k.isin(*known))), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    out = F.concat(out, typed, F.array_sort(rest), F.array(field("tags", _json(F.col("tags")))))
    rows = rows.select("stem", "id", F.posexplode(out).alias("place", "f"))
    fields = rows.select("stem", "id", "place", "f.key", "f.value")
    if links is not None:
        kinds = drafts.select("stem", "id", "page_type")
        listed = F.create_map(*[x for k, v in RELATED.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
        some = links.join(kinds, ["stem", "id"]).where(F.array_contains(listed[F.col("page_type")], F.col("bucket")))
        at = F.array_position(F.array(*map(F.lit, BUCKETS)), F.col("bucket")).cast("int")
        fields = fields.unionByName(some.select("stem", "id", (100 + at).alias("place"), F.concat(F.lit("related."), "bucket").alias("key"), _json(F.col("targets")).alias("value")))
    return fields


def draft_lines(drafts: DataFrame, items: DataFrame, paths: DataFrame) -> DataFrame:
    """``stem, id, section, at, line``: the body of each merged candidate's page.

    ``items`` is what ``merge.merge_items`` gives: ``stem, id, kind, ord, value, provenance``. An empty summary and a page
    without facts say so; the prefixes of inferences and uncertainties are written once.
    """
    rows = drafts.join(paths.select("stem", "path"), "stem", "left")
    no_fact = items.where("kind = 'claim'").select("stem", "id").distinct().withColumn("has", F.lit(True))
    rows = rows.join(no_fact, ["stem", "id"], "left")
    one = lambda s, c: F.struct(F.lit(s).alias("section"), c.alias("line"))
    none = F.lit("- (none recorded)")
    fixed = F.array(
        one("Summary", F.coalesce(F.nullif(strip(F.col("summary")), F.lit("")), none)),
        one("Key facts", F.when(F.col("has").isNull(), none)),
        one("Provenance", F.concat(F.lit("- Primary source: "), F.coalesce("path", F.lit("")))),
        one("Change notes", F.concat(F.lit("- "), "day", F.lit(" — page created by auto ingest."))),
    )
    fixed_rows = rows.select("stem", "id", F.explode(fixed).alias("f")).select("stem", "id", "f.section", F.lit(0).alias("at"), "f.line").where("line is not null")
    place = F.array_position(F.array(*map(F.lit, BUCKETS)), F.col("kind")).cast("int")
    prefix = lambda word: F.concat(F.lit(f"- {word}: "), strip(F.regexp_replace("value", rf"^\s*(?:{word}:\s*)+", "")))
    line = (
        F.when(F.col("kind") == "claim", F.concat(F.lit("- "), F.rtrim(strip(F.regexp_replace("value", r"\s+", " ")), F.lit(".")), F.lit(". "), F.coalesce("provenance", F.lit(""))))
        .when(F.col("kind") == "inference", prefix("Inference"))
        .when(F.col("kind") == "uncertainty", prefix("Uncertain"))
        .otherwise(F.concat(F.lit("- "), F.initcap("kind"), F.lit(": [["), "value", F.lit("]]")))
    )
    section = F.when(F.col("kind") == "claim", "Key facts").when(F.col("kind") == "inference", "Inferences").when(F.col("kind") == "uncertainty", "Uncertainties").otherwise("Related pages")
    more = items.join(drafts.select("stem", "id"), ["stem", "id"], "left_semi")
    more = more.select("stem", "id", section.alias("section"), (F.coalesce(place, F.lit(0)) * 1_000_000 + F.col("ord")).alias("at"), line.alias("line"))
    return fixed_rows.unionByName(more)


def as_markdown(fields: DataFrame, lines: DataFrame, titles: DataFrame) -> DataFrame:
    """``stem, id, md`` of drafts, gathered; for pages of one book, whose size is bounded by the book."""
    plain = F.when(F.col("value").rlike(r"^(?:[A-Za-z0-9_][A-Za-z0-9_ ./-]*|\[.*\])$"), F.col("value")).otherwise(F.concat(F.lit('"'), F.replace(F.replace(F.coalesce("value", F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))
    front = fields.groupBy("stem", "id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", F.concat("key", F.lit(": "), plain).alias("line")))), lambda x: x["line"]), "\n").alias("front"))
    order = F.array_position(F.array(*map(F.lit, SECTIONS)), F.col("section"))
    body = lines.groupBy("stem", "id", "section").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("body"))
    one = F.struct(order.alias("o"), F.concat(F.lit("## "), "section", F.lit("\n\n"), "body", F.lit("\n")).alias("text"))
    body = body.groupBy("stem", "id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["text"]), "\n").alias("body"))
    rows = front.join(body, ["stem", "id"]).join(titles.select("stem", "id", "title"), ["stem", "id"])
    return rows.select("stem", "id", F.concat(F.lit("---\n"), "front", F.lit("\n---\n\n# "), F.coalesce("title", "id"), F.lit("\n\n"), "body").alias("md"))


def source_drafts(drafts: DataFrame, books: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(drafts, items) of source pages for the books that have none, made from what is known of the file.

    ``books`` has ``stem, path, pages_total, day``. The page has one fact, anchored to all pages or the first line, and
    an uncertainty; its reliability is unknown.
    """
    there = drafts.where("page_type = 'source'").select("stem").distinct()
    rows = books.join(there, "stem", "left_anti")
    base = F.regexp_replace(F.regexp_replace("path", "^.*/", ""), r"\.[^.]+$", "")
    words = strip(F.regexp_replace(base, "[_-]", " "))
    title = F.coalesce(F.nullif(F.when(words.rlike(r"^[\x00-\x7f]*$"), F.initcap(words)).otherwise(words), F.lit("")), F.col("stem"))
    slug = F.coalesce(F.nullif(F.regexp_replace(F.replace(F.lower("stem"), F.lit("_"), F.lit("-")), "^-+|-+$", ""), F.lit("")), F.lit("source"))
    none = F.array().cast("array<string>")
    made = rows.select(
        "stem", slug.alias("id"), F.lit("source").alias("page_type"), title.alias("title"),
        F.concat(F.lit("Source page made for "), "path", F.lit(", as none was extracted. Author, date and summary are to be filled in.")).alias("summary"),
        none.alias("aliases"), none.alias("tags"), F.lit(None).cast("map<string,string>").alias("extra"), F.lit(None).cast(drafts.schema["first"].dataType).alias("first"), "day",
    )
    anchor = F.when(F.col("pages_total") > 0, F.concat(F.lit("["), "path", F.lit("#p1-p"), F.col("pages_total").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("["), "path", F.lit("#L1-L1]")))
    items = F.array(
        F.struct(F.lit("claim").alias("kind"), F.concat(F.lit("Document ingested from "), "path", F.lit(".")).alias("value"), anchor.alias("provenance")),
        F.struct(F.lit("uncertainty").alias("kind"), F.lit("Uncertain: made without extraction; its fields are to be checked.").alias("value"), F.lit(None).cast("string").alias("provenance")),
    )
    rows = rows.select("stem", slug.alias("id"), F.explode(items).alias("i")).select("stem", "id", "i.kind", F.lit(0).alias("ord"), "i.value", "i.provenance")
    return made, rows


def _copies(page: DataFrame) -> DataFrame:
    return page.where("slug is not null").withColumn("side", F.struct("landed_at", "page_row_id"))


def merged_fields(page: DataFrame) -> DataFrame:
    """``slug, key, value``: the scalar front matter of all copies of a slug merged in the order of their landing.

    The first copy that has a field keeps it, null or not; ``updated`` is the day of the last landing where copies were
    merged. Lists are united by ``merge.merged_lists``.
    """
    lists = ("sources", "tags", "aliases", "related")
    rows = _copies(page).select("slug", "side", "landed_at", F.explode(F.map_entries(F.from_json("frontmatter", "map<string,string>"))).alias("e"))
    rows = rows.where(~F.col("e.key").isin(*lists)).groupBy("slug", F.col("e.key").alias("key")).agg(F.min_by(F.struct(F.col("e.value").alias("value")), "side").alias("f"))
    last = page.where("slug is not null").groupBy("slug").agg(F.count("*").alias("copies"), F.date_format(F.max("landed_at"), "yyyy-MM-dd").alias("day"))
    kept = rows.select("slug", "key", F.col("f.value").alias("value"))
    dated = last.where("copies > 1").select("slug", F.lit("updated").alias("key"), F.col("day").alias("value"))
    return kept.join(dated.select("slug", "key"), ["slug", "key"], "left_anti").unionByName(dated)


def _lines(page: DataFrame) -> DataFrame:
    """Each line of each section of each copy; of sections with one header the last counts."""
    rows = _copies(page).select("slug", "side", F.explode("sections").alias("s"))
    rows = rows.groupBy("slug", "side", F.col("s.header").alias("section")).agg(F.max(F.struct("s.ord", "s.body")).alias("x"))
    lines = F.posexplode(F.split(F.col("x.body"), "\n")).alias("at", "line")
    return rows.where("trim(x.body) <> ''").select("slug", "side", "section", F.col("x.ord").alias("ord"), lines)


def merged_lines(page: DataFrame) -> DataFrame:
    """``slug, section, row, at, line``: the body lines of all copies of a slug merged; ``row`` is the copy that a line is from.

    A section is that of the first copy that has it with any text; bullets of later copies whose claim it lacks follow.
    Other sections of later copies are not taken, if the first copy has none, but for related pages, which are united.
    Provenance lists the united sources where the first copy has such a section, and each merge leaves a note.
    """
    lines = _lines(page)
    first = _copies(page).groupBy("slug").agg(F.min("side").alias("first"), F.count("*").alias("copies"))
    base = lines.groupBy("slug", "section").agg(F.min("side").alias("base"))
    rows = lines.join(base, ["slug", "section"]).join(first, "slug")
    united = F.col("section").isin(*BULLETS, "Related pages")
    own = rows.where((F.col("side") == F.col("base")) & (united | (F.col("base") == F.col("first"))))
    own = own.where("not (section = 'Provenance' and copies > 1)")
    key = claim_key(F.col("line"))
    bullet = F.col("line").rlike(r"^\s*-")
    later = rows.where(united & (F.col("side") > F.col("base")) & bullet).withColumn("key", key)
    known = rows.where(united & (F.col("side") == F.col("base")) & bullet).select("slug", "section", key.alias("key")).distinct()
    later = later.join(known, ["slug", "section", "key"], "left_anti").groupBy("slug", "section", "key").agg(F.min(F.struct("side", "at", "line")).alias("f"))
    out = own.select("slug", "section", F.col("side.page_row_id").alias("row"), "at", "line")
    out = out.unionByName(later.select("slug", "section", F.col("f.side.page_row_id").alias("row"), F.col("f.at").alias("at"), F.col("f.line").alias("line")))
    refreshed = rows.where("section = 'Provenance' and side = first and copies > 1").select("slug", F.col("side.page_row_id").alias("row")).distinct()
    sources = merged_lists(page).where("field = 'sources'").join(refreshed, "slug")
    sources = sources.select("slug", F.lit("Provenance").alias("section"), "row", F.col("ord").alias("at"), F.concat(F.when(F.col("ord") == 0, "- Primary source: ").otherwise("- Additional source: "), "value").alias("line"))
    stem = F.regexp_extract(F.coalesce(F.get_json_object("frontmatter", "$.sources[0]"), F.lit("")), r"([^/]+?)(?:\.[^./]*)?$", 1)
    notes = _copies(page).join(first, "slug").where("side > first")
    note = F.concat(F.lit("- "), F.date_format("landed_at", "yyyy-MM-dd"), F.lit(" — merged contributions from `"), stem, F.lit("`."))
    notes = notes.groupBy("slug", note.alias("line")).agg(F.min("page_row_id").alias("row"))
    notes = notes.select("slug", F.lit("Change notes").alias("section"), "row", F.lit(1_000_000).alias("at"), "line")
    return out.unionByName(sources).unionByName(notes)


def merged_order(page: DataFrame) -> DataFrame:
    """``slug, section, place``: the sections of a merged page in their order.

    The first copy's sections keep theirs; those that later copies add stand before its first tail section, or last, in
    the order in which they came.
    """
    lines = _lines(page)
    first = _copies(page).groupBy("slug").agg(F.min("side").alias("first"), F.count("*").alias("copies"))
    heads = lines.groupBy("slug", "section").agg(F.min("side").alias("side"), F.min_by("ord", "side").alias("ord")).join(first, "slug")
    own = heads.where("side = first").select("slug", "section", "ord")
    tail = own.where(F.col("section").isin(*TAIL)).groupBy("slug").agg(F.min("ord").alias("tail"))
    number = F.array_position(F.array(*map(F.lit, SECTIONS)), F.col("section")).cast("int")
    added = heads.where((F.col("side") > F.col("first")) & F.col("section").isin(*BULLETS, "Related pages"))
    added = added.select("slug", "section", F.col("side").alias("s"), number.alias("n"))
    noted = first.where("copies > 1").select("slug").join(own.where("section = 'Change notes'").select("slug"), "slug", "left_anti").select("slug", F.lit("Change notes").alias("section"))
    end = F.lit(2_000_000)
    nowhere = F.lit(None).cast(lines.schema["side"].dataType)
    rows = own.select("slug", "section", F.struct(F.col("ord").cast("int").alias("a"), F.lit(1).alias("b"), nowhere.alias("s"), F.lit(0).alias("n")).alias("k"))
    rows = rows.unionByName(added.join(tail, "slug", "left").select("slug", "section", F.struct(F.coalesce("tail", F.lit(1_000_000)).cast("int").alias("a"), F.lit(0).alias("b"), "s", "n").alias("k")))
    rows = rows.unionByName(noted.select("slug", "section", F.struct(end.alias("a"), F.lit(0).alias("b"), nowhere.alias("s"), F.lit(0).alias("n")).alias("k")))
    per = rows.groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("k", "section"))).alias("all"))  # a page's headers, few
    return per.select("slug", F.posexplode(F.transform("all", lambda x: x["section"])).alias("place", "section")).select("slug", "section", "place")
