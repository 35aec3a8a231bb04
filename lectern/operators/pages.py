"""Wiki pages: the landed page of each slug, rendering to Markdown, and parsing back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as t

#: Front matter keys in the order they are written, of which some hold lists.
KEYS = ("id", "title", "type", "status", "created", "updated", "sources", "confidence", "source_author", "source_date", "reliability", "tags")
LISTS = ("sources", "tags")
NONE = "- (none recorded)"


def landed(page: DataFrame) -> DataFrame:
    """The copy of each slug that landed last; ties go to the greater row id. Rows without slug are left out."""
    best = page.where("slug is not null").groupBy("slug").agg(F.max_by(F.struct(*[c for c in page.columns if c != "slug"]), F.struct("landed_at", "page_row_id")).alias("p"))
    return best.select("slug", "p.*")


def fm(key: str) -> Column:
    return F.get_json_object("frontmatter", f"$.{key}")


def section(header: str, sections: str = "sections") -> Column:
    """The body under a header, the last one's where it comes twice; null without it."""
    return F.try_element_at(F.filter(sections, lambda s: s["header"] == header), F.lit(-1))["body"]


def bullets(body: Column) -> Column:
    """The text of the lines that begin with a hyphen, without those that say that there is none."""
    rows = F.filter(F.split(F.coalesce(body, F.lit("")), "\n"), lambda x: x.rlike(r"^\s*- ") & ~x.startswith("- (none"))
    return F.transform(rows, lambda x: t.strip(F.regexp_replace(x, r"^\s*- ", "")))


def wiki(page: DataFrame) -> DataFrame:
    """``slug, title, type, path, summary, tags, facts`` of each landed page; summaries are cut at 200 characters."""
    return landed(page).select(
        "slug",
        F.coalesce(fm("title"), F.regexp_replace("title_line", r"^#\s*", ""), F.col("slug")).alias("title"),
        F.col("page_type").alias("type"),
        "path",
        F.coalesce(t.one_line(section("Summary")), F.lit("")).alias("summary"),
        F.coalesce(F.from_json(fm("tags"), "array<string>"), F.array().cast("array<string>")).alias("tags"),
        bullets(section("Key facts")).alias("facts"),
    )


def _scalar(c: Column) -> Column:
    """A YAML scalar: quoted unless it is plain."""
    return F.when(c.rlike(r"^[A-Za-z0-9_][A-Za-z0-9_ ./-]*$"), c).otherwise(F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')))


def render_frontmatter() -> Column:
    """YAML of the known keys that are there, in their order; lists in flow style."""
    rows = [F.when(fm(k).isNotNull(), F.concat(F.lit(f"{k}: "), fm(k) if k in LISTS else _scalar(fm(k)))) for k in KEYS]
    return F.array_join(F.filter(F.array(*rows), lambda x: x.isNotNull()), "\n")


def render_sections(sections: str = "sections") -> Column:
    one = lambda s: F.concat(F.lit("## "), s["header"], F.lit("\n\n"), F.coalesce(F.nullif(s["body"], F.lit("")), F.lit(NONE)), F.lit("\n"))
    return F.array_join(F.transform(F.array_sort(sections, lambda a, b: a["ord"].cast("int") - b["ord"].cast("int")), one), "\n")


def rendered(page: DataFrame) -> DataFrame:
    """``slug, page_type, path, md``: each landed page as Markdown with front matter; empty sections say so."""
    md = F.concat(F.lit("---\n"), render_frontmatter(), F.lit("\n---\n\n"), F.coalesce("title_line", F.concat(F.lit("# "), F.col("slug"))), F.lit("\n\n"), render_sections())
    return landed(page).select("slug", "page_type", "path", md.alias("md"))


def front_text(md: Column) -> Column:
    """The YAML block, or null without one."""
    return F.nullif(F.regexp_extract(md, r"(?s)\A---\n(.*?)\n---\n", 1), F.lit(""))


def body_text(md: Column) -> Column:
    return F.regexp_replace(md, r"(?s)\A---\n.*?\n---\n", "")


def front_value(md: Column, key: str) -> Column:
    """A scalar of the front matter, unquoted; null when absent."""
    return scalar_of(front_text(md), key)


def scalar_of(front: Column, key: str) -> Column:
    """The same from the YAML block, for those who need several values of one."""
    raw = F.regexp_extract(front, rf"(?m)^{key}:[ \t]*(.*?)[ \t]*$", 1)
    bare = F.regexp_replace(raw, r"^(['\"])(.*)\1$", "$2")
    return F.nullif(F.replace(bare, F.lit('\\"'), F.lit('"')), F.lit(""))


def front_keys(md: Column) -> Column:
    return keys_of(front_text(md))


def keys_of(front: Column) -> Column:
    return F.regexp_extract_all(front, F.lit(r"(?m)^([A-Za-z_][A-Za-z0-9_]*):"), F.lit(1))


def md_sections(md: Column) -> Column:
    """``array<struct<header, body>>`` of the level-two headings in their order; text before the first has the header ''."""
    parts = F.split(body_text(md), r"(?m)^(?=## )")
    clean = lambda x: F.regexp_replace(x, r"\A\n+|\n+\z", "")
    one = lambda x: F.struct(
        F.when(x.startswith("## "), t.strip(F.regexp_extract(x, r"\A## (.*)", 1))).otherwise("").alias("header"),
        clean(F.when(x.startswith("## "), F.regexp_replace(x, r"\A## .*", "")).otherwise(F.regexp_replace(x, r"(?m)\A\s*# .*$", ""))).alias("body"),
    )
    return F.filter(F.transform(parts, one), lambda s: (s["header"] != "") | (s["body"] != ""))


def parsed(md: DataFrame) -> DataFrame:
    """``slug, title, type, sections`` read back from ``slug, md``."""
    title = t.strip(F.regexp_extract(body_text(F.col("md")), r"(?m)^# (.*)$", 1))
    return md.select("slug", title.alias("title"), front_value(F.col("md"), "type").alias("type"), md_sections(F.col("md")).alias("sections"))


def facts_of(md: DataFrame) -> DataFrame:
    """``slug, ord, claim, provenance`` of the bullets under Key facts; provenance is the first anchor, '' without one."""
    body = F.try_element_at(F.filter(md_sections(F.col("md")), lambda s: s["header"] == "Key facts"), F.lit(-1))["body"]
    rows = md.select("slug", F.posexplode(bullets(body)).alias("ord", "line"))
    rows = rows.withColumn("anchor", F.regexp_extract("line", t.ANY_ANCHOR, 0))
    claim = F.when(F.col("anchor") == "", F.col("line")).otherwise(F.expr("left(line, instr(line, anchor) - 1)"))
    return rows.select("slug", "ord", F.regexp_replace(claim, r"[ .;,]+$", "").alias("claim"), F.col("anchor").alias("provenance"))
