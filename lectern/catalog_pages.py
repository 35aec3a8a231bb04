"""Queries of pages made from candidates and of copies merged whole, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import catalog_sql
from lectern.catalog_sql import _claim_key
from lectern.functions import text as t
from lectern.operators import collide, drafts, imports, merge, pages, pipeline, rules, runs, search
from lectern.plans.shared import read


def _paths(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "md_doc").where("stem is not null").groupBy("stem").agg(F.min("source_path").alias("path"))


def _drafts(s: SparkSession, d: str) -> DataFrame:
    return drafts.merged_candidates(read(s, d, "candidate"))


def _items(s: SparkSession, d: str) -> DataFrame:
    """The facts of a candidate's id, under the first book that has it."""
    owner = read(s, d, "candidate").where("stem is not null and id is not null").groupBy("id").agg(F.min("stem").alias("stem"))
    facts = read(s, d, "fact").where("claim is not null").select(F.col("slug").alias("id"), F.lit(0).alias("chunk_index"), "ord", F.lit("claim").alias("kind"), F.col("claim").alias("value"), "provenance")
    return merge.merge_items(facts.join(owner, "id"), read(s, d, "candidate"))


def _source_drafts(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    books = read(s, d, "md_doc").where("stem is not null").groupBy("stem").agg(F.min("source_path").alias("path"), F.max("pages_total").alias("pages_total"), F.date_format(F.min("converted_at"), "yyyy-MM-dd").alias("day"))
    return drafts.source_drafts(_drafts(s, d), books)


def _planted(s: SparkSession, d: str) -> DataFrame:
    """All pages, some with a slug or title that nearly agrees with another's: defects by ``page_row_id``."""
    title = F.regexp_replace("frontmatter", F.lit('"title": "[^"]*"'), F.concat(F.lit('"title": "Shared '), (F.col("page_row_id") % 3).cast("string"), F.lit('"')))
    page = read(s, d, "page").withColumn("slug", F.when(F.col("page_row_id") % 10 == 3, F.concat("slug", F.lit("-the"))).otherwise(F.col("slug")))
    return page.withColumn("frontmatter", F.when(F.col("page_row_id") % 8 == 5, title).otherwise(F.col("frontmatter")))


def _planted_links(s: SparkSession, d: str) -> DataFrame:
    """All links, some with a target that is empty or has only a label, and some that name a planted title: by ``link_id``."""
    k = F.col("link_id") % 50
    return read(s, d, "link").withColumn("target", F.when(k == 0, " ").when(k == 1, F.concat(F.lit("|"), "target")).when(k == 2, "Shared 1").otherwise(F.col("target")))


def _planted_md(s: SparkSession, d: str) -> DataFrame:
    """All pages as Markdown, some with an id that others have and with prefixes inside a sentence: by the slug's length."""
    md = pages.rendered(read(s, d, "page")).select("slug", "md")
    n = F.length("slug")
    md = md.withColumn("md", F.when(n % 9 == 0, F.regexp_replace("md", "(?m)^id: .*$", "id: shared-id")).otherwise(F.col("md")))
    more = F.when(n % 5 == 0, "\nOne says Inference: it was so.\n").when(n % 5 == 1, "\nOn “The Great Inference: a Book” and Causal Inference: Methods.\n").when(n % 5 == 2, "\nthe rest is Uncertain: nobody saw it.\n").otherwise("")
    return md.withColumn("md", F.concat("md", more))


def _planted_wiki(s: SparkSession, d: str) -> DataFrame:
    return pages.wiki(_planted(s, d))


def _names(s: SparkSession, d: str) -> DataFrame:
    """Titles and slugs of pages as somebody may ask for them: by the slug's length as it is, as its title, in capitals or with underscores."""
    n = F.length("slug") % 4
    query = F.when(n == 0, F.col("slug")).when(n == 1, F.concat(F.lit(" "), F.upper("title"))).when(n == 2, F.replace("title", F.lit(" "), F.lit("_"))).otherwise(F.concat("title", F.lit(" nowhere")))
    return pages.wiki(read(s, d, "page")).select(query.alias("query"))


def _import_target(s: SparkSession, d: str) -> DataFrame:
    """Of all book files those whose digest begins with a figure are there already, others' names are taken."""
    rows = read(s, d, "md_doc").where("source_path is not null and sha256 is not null").select(F.regexp_replace("source_path", "^raw/books/", "").alias("path"), "sha256").distinct()
    plan = imports.import_plan(rows, rows.select(F.lit("").alias("discipline"), F.lit("").alias("name"), "sha256").where("false")).join(rows, "path")
    return plan.select("discipline", "name", F.when(F.col("sha256").rlike("^[0-9]"), F.col("sha256")).when(F.col("sha256").rlike("^[ab]"), F.reverse("sha256")).alias("sha256")).where("sha256 is not null").distinct()


def _files(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "md_doc").where("source_path is not null and sha256 is not null").select(F.regexp_replace("source_path", "^raw/books/", "").alias("path"), "sha256").distinct()


#: Whole tables with defects planted by key, so that checks which clean tables pass have something to find.
PLANTED = {
    "m11_planted": lambda s, d: merge.same_title_plan(_planted(s, d)),
    "m13_planted": lambda s, d: merge.rewrite_links(_planted_links(s, d), merge.same_title_plan(_planted(s, d)), _planted(s, d)),
    "m14_planted": lambda s, d: merge.near_slug_plan(_planted(s, d)),
    "f3_planted": lambda s, d: collide.same_title(_planted_wiki(s, d).select("slug", "title")),
    "f6_planted": lambda s, d: collide.near_duplicate_slugs(_planted_wiki(s, d).select("slug", "title")),
    "v2_planted": lambda s, d: rules.provenance_format(pages.rendered(read(s, d, "page")).select("slug", "md"), None, 40),
    "v3_planted": lambda s, d: rules.prefix_syntax(_planted_md(s, d)),
    "v4_planted": lambda s, d: rules.id_uniqueness(_planted_md(s, d), read(s, d, "wiki_index").select("id")),
    "v5_planted": lambda s, d: rules.link_format(_planted_links(s, d).where("target is not null").select(F.col("link_id").alias("slug"), F.concat(F.lit("[["), "target", F.lit("]]")).alias("md"))),
    "q5_planted": lambda s, d: search.find_pages(_names(s, d), pages.wiki(read(s, d, "page")), read(s, d, "wiki_index")),
    "s14_planted": lambda s, d: imports.import_plan(_files(s, d), _import_target(s, d)),
    "c7_planted": lambda s, d: read(s, d, "fact").select("fact_id", t.normal_provenance(F.replace("provenance", F.lit(".pdf#"), F.lit(".pdf.PDF#")), F.concat(F.lit("raw/books/all/"), F.regexp_extract("provenance", r"([^/]+\.pdf)#", 1))).alias("provenance")),
}

QUERIES = {
    "c9_claims": _items,
    "c11_source_drafts": lambda s, d: _source_drafts(s, d)[0].select("stem", "id", "title", "summary", "day"),
    "c11_source_items": lambda s, d: _source_drafts(s, d)[1].select("stem", "id", "kind", "value", "provenance"),
    "r1_draft_fields": lambda s, d: drafts.draft_fields(_drafts(s, d), _paths(s, d)),
    "r4_draft_lines": lambda s, d: drafts.draft_lines(_drafts(s, d), _items(s, d), _paths(s, d)),
    "m9_fields": lambda s, d: drafts.merged_fields(read(s, d, "page")),
    "m9_lines": lambda s, d: drafts.merged_lines(read(s, d, "page")),
    "m9_order": lambda s, d: drafts.merged_order(read(s, d, "page")),
}

_PATHS = "paths AS (SELECT stem, min(source_path) AS path FROM md_doc WHERE stem IS NOT NULL GROUP BY stem)"
_DRAFTS = """c0 AS (SELECT *, row_number() OVER (PARTITION BY stem, id ORDER BY chunk_index NULLS FIRST, ord NULLS FIRST, candidate_id) AS rn, strftime(min(extracted_at) OVER (PARTITION BY stem, id), '%Y-%m-%d') AS day FROM candidate WHERE stem IS NOT NULL AND id IS NOT NULL),
    c1 AS (SELECT * FROM c0 WHERE rn = 1), src AS (SELECT stem, arg_min(id, (chunk_index, ord, candidate_id, id)) AS sid FROM c1 WHERE page_type = 'source' GROUP BY stem),
    drafts AS (SELECT c1.* FROM c1 LEFT JOIN src ON src.stem = c1.stem WHERE coalesce(page_type, '') <> 'source' OR id = sid)"""
_ITEMS = (
    _DRAFTS
    + """, o AS (SELECT id, min(stem) AS stem FROM c1 GROUP BY id), f AS (SELECT o.stem, o.id, fact.ord AS iord, claim AS value, provenance FROM fact JOIN o ON o.id = fact.slug WHERE claim IS NOT NULL),
    j AS (SELECT f.*, CASE WHEN d.page_type = 'source' THEN src.sid ELSE f.id END AS owner, d.chunk_index AS ci, d.ord AS co, d.candidate_id AS cid FROM f JOIN c1 d ON d.stem = f.stem AND d.id = f.id LEFT JOIN src ON src.stem = f.stem),
    once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stem, owner, value ORDER BY ci NULLS FIRST, co NULLS FIRST, cid, iord NULLS FIRST, provenance NULLS FIRST) AS rn FROM j) WHERE rn = 1),
    items AS (SELECT stem, owner AS id, 'claim' AS kind, CAST(row_number() OVER (PARTITION BY stem, owner ORDER BY ci NULLS FIRST, co NULLS FIRST, cid, iord NULLS FIRST, provenance NULLS FIRST, value) - 1 AS INTEGER) AS ord, value, provenance FROM once)"""
)
_SRC = (
    _DRAFTS
    + r""", b AS (SELECT stem, min(source_path) AS path, max(pages_total) AS pages, strftime(min(converted_at), '%Y-%m-%d') AS day FROM md_doc WHERE stem IS NOT NULL GROUP BY stem),
    w AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(path, '^.*/', ''), '\.[^.]+$', ''), '[_-]', ' ', 'g')) AS words FROM b WHERE stem NOT IN (SELECT stem FROM drafts WHERE page_type = 'source')),
    made AS (SELECT stem, coalesce(nullif(trim(replace(lower(stem), '_', '-'), '-'), ''), 'source') AS id, array_to_string(list_transform(string_split(words, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS title, path, pages, day FROM w)"""
)


def _kinds(*pairs: tuple[str, str]) -> str:
    return "[" + ", ".join(f"{{'key': '{k}', 'value': {v}}}" for k, v in pairs) + "]"


_RANKED = "rk AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY landed_at NULLS FIRST, page_row_id) AS side, count(*) OVER (PARTITION BY slug) AS copies FROM page WHERE slug IS NOT NULL)"
_UNITED = "('Key facts', 'Inferences', 'Uncertainties', 'Related pages')"
_PAGE_LINES = _RANKED + ", sec AS (SELECT slug, side, copies, page_row_id, unnest(sections) AS s FROM rk), ln AS (SELECT slug, side, copies, page_row_id, s.header AS section, s.ord AS ord, unnest(string_split(s.body, chr(10))) AS line, generate_subscripts(string_split(s.body, chr(10)), 1) - 1 AS at FROM sec WHERE trim(s.body) <> '')"

SQL = {
    "c9_claims": f"WITH {_ITEMS} SELECT * FROM items",
    "c11_source_drafts": f"WITH {_SRC} SELECT stem, id, title, 'Source page made for ' || path || ', as none was extracted. Author, date and summary are to be filled in.' AS summary, day FROM made",
    "c11_source_items": f"""WITH {_SRC} SELECT stem, id, 'claim' AS kind, 'Document ingested from ' || path || '.' AS value, CASE WHEN pages > 0 THEN '[' || path || '#p1-p' || CAST(pages AS VARCHAR) || ']' ELSE '[' || path || '#L1-L1]' END AS provenance FROM made
        UNION ALL SELECT stem, id, 'uncertainty', 'Uncertain: made without extraction; its fields are to be checked.', NULL FROM made""",
    "r1_draft_fields": f"""WITH {_DRAFTS}, {_PATHS}, x AS (SELECT d.*, coalesce(p.path, '') AS path FROM drafts d LEFT JOIN paths p ON p.stem = d.stem),
        l AS (SELECT stem, id, list_concat({_kinds(('id', 'id'), ('title', 'title'), ('type', 'page_type'), ('status', "'draft'"), ('created', 'day'), ('updated', 'day'), ('sources', "CASE WHEN path = '' THEN '[]' ELSE CAST(to_json([path]) AS VARCHAR) END"))},
        CASE page_type WHEN 'entity' THEN {_kinds(('aliases', 'CAST(to_json(coalesce(aliases, [])) AS VARCHAR)'), ('canonical', "'true'"), ('confidence', "'medium'"))} WHEN 'source' THEN {_kinds(('source_kind', "'book'"), ('source_path', 'path'), ('source_date', "''"), ('source_author', "''"), ('reliability', "'unknown'"))}
        WHEN 'analysis' THEN {_kinds(('question', "''"), ('confidence', "'medium'"))} ELSE {_kinds(('confidence', "'medium'"))} END, {_kinds(('tags', 'CAST(to_json(coalesce(tags, [])) AS VARCHAR)'))}) AS fs FROM x),
        u AS (SELECT stem, id, unnest(fs) AS f, generate_subscripts(fs, 1) - 1 AS place FROM l) SELECT stem, id, CAST(place AS INTEGER) AS place, f.key AS key, f.value AS value FROM u""",
    "r4_draft_lines": f"""WITH {_ITEMS}, {_PATHS} SELECT stem, id, 'Summary' AS section, 0 AS at, coalesce(nullif(trim(summary), ''), '- (none recorded)') AS line FROM drafts
        UNION ALL SELECT stem, id, 'Key facts', 0, '- (none recorded)' FROM drafts d WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.stem = d.stem AND i.id = d.id)
        UNION ALL SELECT d.stem, id, 'Provenance', 0, '- Primary source: ' || coalesce(path, '') FROM drafts d LEFT JOIN paths p ON p.stem = d.stem
        UNION ALL SELECT stem, id, 'Change notes', 0, '- ' || day || ' — page created by auto ingest.' FROM drafts
        UNION ALL SELECT stem, id, 'Key facts', ord, '- ' || rtrim(trim(regexp_replace(value, '\\s+', ' ', 'g')), '.') || '. ' || coalesce(provenance, '') FROM items""",
    "m9_fields": f"""WITH {_RANKED}, k AS (SELECT slug, side, copies, frontmatter, unnest(json_keys(frontmatter)) AS key FROM rk), v AS (SELECT slug, copies, key, frontmatter->>('$.' || key) AS value, row_number() OVER (PARTITION BY slug, key ORDER BY side) AS rn FROM k WHERE key NOT IN ('sources', 'tags', 'aliases', 'related'))
        SELECT slug, key, value FROM v WHERE rn = 1 AND NOT (key = 'updated' AND copies > 1) UNION ALL SELECT slug, 'updated', strftime(max(landed_at), '%Y-%m-%d') FROM rk GROUP BY slug HAVING count(*) > 1""",
    "m9_lines": f"""WITH {_PAGE_LINES}, base AS (SELECT slug, section, min(side) AS base FROM ln GROUP BY 1, 2), r AS (SELECT ln.*, base FROM ln JOIN base b ON b.slug = ln.slug AND b.section = ln.section),
        k AS (SELECT *, {_claim_key('line')} AS key FROM r WHERE section IN {_UNITED} AND regexp_matches(line, '^\\s*-')), known AS (SELECT DISTINCT slug, section, key FROM k WHERE side = base),
        later AS (SELECT k.*, row_number() OVER (PARTITION BY k.slug, k.section, k.key ORDER BY side, "at") AS rn FROM k LEFT JOIN known n ON n.slug = k.slug AND n.section = k.section AND n.key = k.key WHERE side > base AND n.slug IS NULL),
        sv AS (SELECT slug, side, unnest(CAST(json_extract(frontmatter, '$.sources') AS VARCHAR[])) AS value, generate_subscripts(CAST(json_extract(frontmatter, '$.sources') AS VARCHAR[]), 1) AS i FROM rk),
        s1 AS (SELECT slug, value, min((side, i)) AS f FROM sv WHERE value IS NOT NULL GROUP BY 1, 2), s2 AS (SELECT slug, value, row_number() OVER (PARTITION BY slug ORDER BY f, value) - 1 AS n FROM s1),
        fresh AS (SELECT DISTINCT slug, page_row_id FROM ln WHERE section = 'Provenance' AND side = 1 AND copies > 1)
        SELECT slug, section, page_row_id AS row, CAST("at" AS INTEGER) AS at, line FROM r WHERE side = base AND (section IN {_UNITED} OR base = 1) AND NOT (section = 'Provenance' AND copies > 1)
        UNION ALL SELECT slug, section, page_row_id, CAST("at" AS INTEGER), line FROM later WHERE rn = 1
        UNION ALL SELECT s2.slug, 'Provenance', page_row_id, CAST(n AS INTEGER), CASE WHEN n = 0 THEN '- Primary source: ' ELSE '- Additional source: ' END || value FROM s2 JOIN fresh ON fresh.slug = s2.slug
        UNION ALL SELECT slug, 'Change notes', min(page_row_id), 1000000, line FROM (SELECT slug, page_row_id, '- ' || strftime(landed_at, '%Y-%m-%d') || ' — merged contributions from `' || regexp_extract(coalesce(frontmatter->>'$.sources[0]', ''), '([^/]+?)(?:\\.[^./]*)?$', 1) || '`.' AS line FROM rk WHERE side > 1) GROUP BY slug, line""",
    "m9_order": f"""WITH {_PAGE_LINES}, h AS (SELECT slug, section, min(side) AS side, arg_min(ord, side) AS ord, any_value(copies) AS copies FROM ln GROUP BY 1, 2), tail AS (SELECT slug, min(ord) AS tail FROM h WHERE side = 1 AND section IN ('Related pages', 'Provenance', 'Change notes') GROUP BY slug),
        n AS (SELECT * FROM (VALUES ('Key facts', 2), ('Inferences', 3), ('Uncertainties', 4), ('Related pages', 5)) AS t(section, n)),
        a AS (SELECT slug, section, ord AS a, 1 AS b, 0 AS c, 0 AS d FROM h WHERE side = 1 UNION ALL SELECT h.slug, h.section, coalesce(tail, 1000000), 0, side, n FROM h JOIN n ON n.section = h.section LEFT JOIN tail ON tail.slug = h.slug WHERE side > 1
        UNION ALL SELECT slug, 'Change notes', 2000000, 0, 0, 0 FROM rk WHERE copies > 1 AND slug NOT IN (SELECT slug FROM h WHERE side = 1 AND section = 'Change notes') GROUP BY slug)
        SELECT slug, section, CAST(row_number() OVER (PARTITION BY slug ORDER BY a, b, c, d) - 1 AS INTEGER) AS place FROM a""",
}

_SQL = catalog_sql.SQL
_PLANT = """planted AS (SELECT * REPLACE (CASE WHEN page_row_id % 10 = 3 THEN slug || '-the' ELSE slug END AS slug, CASE WHEN page_row_id % 8 = 5 THEN regexp_replace(frontmatter, '"title": "[^"]*"', '"title": "Shared ' || CAST(page_row_id % 3 AS VARCHAR) || '"') ELSE frontmatter END AS frontmatter) FROM page),
    links AS (SELECT * REPLACE (CASE link_id % 50 WHEN 0 THEN ' ' WHEN 1 THEN '|' || target WHEN 2 THEN 'Shared 1' ELSE target END AS target) FROM link)"""


def _on_planted(sql: str) -> str:
    return sql.replace("FROM page ", "FROM planted ").replace("FROM link ", "FROM links ").replace("FROM link)", "FROM links)").replace("WITH ", f"WITH {_PLANT}, ", 1)


_NAMED_PLANTED = catalog_sql._NAMED.split(", named AS")[0] + ", named AS (SELECT slug, title FROM wiki)"
_PLANTED_MD = catalog_sql._RENDERED + r""", pm AS (SELECT slug, CASE WHEN length(slug) % 9 = 0 THEN regexp_replace(md, '(?m)^id: .*$', 'id: shared-id') ELSE md END || CASE length(slug) % 5 WHEN 0 THEN chr(10) || 'One says Inference: it was so.' || chr(10)
    WHEN 1 THEN chr(10) || 'On “The Great Inference: a Book” and Causal Inference: Methods.' || chr(10) WHEN 2 THEN chr(10) || 'the rest is Uncertain: nobody saw it.' || chr(10) ELSE '' END AS md FROM md)"""

SQL |= {
    "m11_planted": _on_planted(_SQL["m11_same_title_plan"]),
    "m14_planted": _on_planted(_SQL["m14_near_slug_plan"]),
    "m13_planted": _on_planted(f"""WITH {catalog_sql._SIZES}, {catalog_sql._plan('title', 'sizes')}, m AS (SELECT DISTINCT duplicate AS slug, canonical FROM plan), nm AS (SELECT slug, coalesce(frontmatter->>'title', slug) AS title FROM landed),
        bt AS (SELECT {catalog_sql._squeeze('a.title')} AS key, min((m.canonical, b.title)) AS by_title FROM m JOIN nm a ON a.slug = m.slug JOIN nm b ON b.slug = m.canonical GROUP BY 1),
        x AS (SELECT link_id, src_slug, target, {catalog_sql._target('target')} AS t FROM link )
        SELECT link_id, coalesce(b.canonical, src_slug) AS src_slug, coalesce(a.canonical, CASE WHEN x.t <> bt.by_title[1] THEN bt.by_title[2] END, target) AS target FROM x LEFT JOIN m a ON a.slug = x.t LEFT JOIN m b ON b.slug = x.src_slug LEFT JOIN bt ON bt.key = {catalog_sql._squeeze('x.t')}""".replace("$$title$$", "'title'")),
    "f3_planted": _on_planted(_SQL["f3_same_title"].replace(catalog_sql._NAMED, _NAMED_PLANTED)),
    "f6_planted": _on_planted(_SQL["f6_near_slugs"].replace(catalog_sql._NAMED, _NAMED_PLANTED)),
    "v2_planted": _SQL["v2_provenance"].replace("> 300", "> 40"),
    "v3_planted": f"""WITH {_PLANTED_MD} SELECT 'prefix_syntax' AS rule, CASE WHEN length(slug) % 5 = 0 THEN '''Inference:'' in mid-sentence' ELSE '''Uncertain:'' in mid-sentence' END AS message, slug FROM pm WHERE length(slug) % 5 IN (0, 2)""",
    "v4_planted": f"""WITH {_PLANTED_MD}, i AS (SELECT slug, nullif(trim(regexp_extract(md, '(?m)^id: (.*)$', 1), '"'), '') AS id FROM pm), tw AS (SELECT id FROM i WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1 UNION SELECT id FROM wiki_index)
        SELECT 'id_uniqueness' AS rule, 'missing id' AS message, slug FROM i WHERE id IS NULL UNION ALL SELECT 'id_uniqueness', 'id taken: ' || id, slug FROM i WHERE id IN (SELECT id FROM tw)""",
    "v5_planted": """SELECT 'link_format' AS rule, 'empty link target: [[' || trim(x) || ']]' AS message, link_id AS slug FROM (SELECT link_id, unnest(regexp_extract_all('[[' || target || ']]', '\\[\\[([^\\[\\]]*?)\\]\\]', 1)) AS x FROM (SELECT link_id, CASE link_id % 50 WHEN 0 THEN ' ' WHEN 1 THEN '|' || target WHEN 2 THEN 'Shared 1' ELSE target END AS target FROM link) WHERE target IS NOT NULL)
        WHERE trim(x) = '' OR starts_with(trim(x), '|')""",
    "q5_planted": _SQL["q5_find"].replace("q AS (SELECT DISTINCT title AS query FROM candidate WHERE title IS NOT NULL)", "q AS (SELECT DISTINCT CASE length(slug) % 4 WHEN 0 THEN slug WHEN 1 THEN ' ' || upper(title) WHEN 2 THEN replace(title, ' ', '_') ELSE title || ' nowhere' END AS query FROM wiki)"),
    "s14_planted": _SQL["s14_import_plan"].split("SELECT path, discipline, CASE WHEN skip")[0].rstrip().replace("m AS (", "m0 AS (").replace(" k AS (", " k0 AS (").replace("FROM k)", "FROM k0)") + """,
        p0 AS (SELECT path, discipline, sha256, CASE WHEN skip OR pos <= 1 THEN name ELSE regexp_replace(name, '\\.[^.]*$', '') || '-' || CAST(CAST(pos AS BIGINT) AS VARCHAR) || regexp_extract(name, '(\\.[^.]*)$', 1) END AS name FROM m0),
        tg AS (SELECT DISTINCT discipline, name, CASE WHEN regexp_matches(sha256, '^[0-9]') THEN sha256 WHEN regexp_matches(sha256, '^[ab]') THEN reverse(sha256) END AS sha256 FROM p0), there AS (SELECT DISTINCT discipline, sha256 FROM tg WHERE sha256 IS NOT NULL),
        taken AS (SELECT discipline, name, count(*) AS taken FROM tg WHERE sha256 IS NOT NULL GROUP BY 1, 2),
        k AS (SELECT n.*, th.sha256 IS NOT NULL OR row_number() OVER (PARTITION BY n.discipline, n.sha256 ORDER BY path) > 1 AS skip, coalesce(taken, 0) AS taken FROM n LEFT JOIN there th ON th.discipline = n.discipline AND th.sha256 = n.sha256 LEFT JOIN taken ON taken.discipline = n.discipline AND taken.name = n.name),
        m AS (SELECT *, taken + sum(CASE WHEN skip THEN 0 ELSE 1 END) OVER (PARTITION BY discipline, name ORDER BY path ROWS UNBOUNDED PRECEDING) AS pos FROM k)
        SELECT path, discipline, CASE WHEN skip OR pos <= 1 THEN name ELSE regexp_replace(name, '\\.[^.]*$', '') || '-' || CAST(CAST(pos AS BIGINT) AS VARCHAR) || regexp_extract(name, '(\\.[^.]*)$', 1) END AS name, CASE WHEN skip THEN 'skip' ELSE 'copy' END AS action FROM m""",
    "c7_planted": r"""WITH a AS (SELECT fact_id, regexp_replace(replace(provenance, '.pdf#', '.pdf.PDF#'), '^\s+|\s+$', '', 'g') AS a, regexp_extract(provenance, '([^/]+\.pdf)#', 1) AS f FROM fact), b AS (SELECT fact_id, f, CASE WHEN NOT starts_with(a, '[') AND ends_with(a, ']') AND starts_with(a, 'raw/') THEN '[' || a ELSE a END AS a FROM a),
        i AS (SELECT *, regexp_replace(a, '^[\[\]]+|[\[\]]+$', '', 'g') AS inn FROM b), p AS (SELECT *, regexp_replace(regexp_extract(inn, '^([^#]*)', 1), '(?i)(\.pdf)(\.pdf)+', '\1') AS path, regexp_replace(regexp_replace(regexp_extract(inn, '^[^#]*#(.*)$', 1), 'L{2,}(\d)', 'L\1', 'g'), 'p{2,}(\d)', 'p\1', 'g') AS place FROM i),
        q AS (SELECT *, regexp_replace(path, '^.*/', '') AS b FROM p)
        SELECT fact_id, CASE WHEN starts_with(a, '[') AND contains(a, '#') THEN '[' || CASE WHEN b = f OR (length(b) > 30 AND length(f) > 30 AND right(b, 30) = right(f, 30)) THEN 'raw/books/all/' || f ELSE path END || '#' || place || ']' ELSE a END AS provenance FROM q""",
}
QUERIES |= PLANTED

QUERIES |= {
    "f2_hits": lambda s, d: collide.collision_hits(read(s, d, "candidate"), read(s, d, "wiki_index")),
    "f7_classes": lambda s, d: collide.conflict_classes(_planted_wiki(s, d).select("slug", "title"), read(s, d, "wiki_index")),
    "s12_lookups": lambda s, d: runs.lookups(read(s, d, "wiki_index")),
    "q6_read": lambda s, d: search.read_pages(_names(s, d), pages.wiki(read(s, d, "page")), read(s, d, "wiki_index")),
    "k5_index_page": lambda s, d: runs.index_page(pages.wiki(read(s, d, "page"))),
    "i6_books": lambda s, d: pipeline.ingest(read(s, d, "md_doc"), most=300, least=60)[1],
}

_HITS = _SQL["f2_collisions"].split("SELECT candidate_id, CASE min(rank)")[0]
_INDEX_KINDS = "kinds AS (SELECT * FROM (VALUES (0, 'entity', 'Entities'), (1, 'concept', 'Concepts'), (2, 'topic', 'Topics'), (3, 'source', 'Sources'), (4, 'analysis', 'Analyses'), (5, 'conflict', 'Conflicts'), (6, 'dashboard', 'Dashboards')) AS t(section, type, head))"
SQL |= {
    "f2_hits": f"{_HITS} SELECT candidate_id, CAST(row_number() OVER (PARTITION BY candidate_id ORDER BY rank, e) AS INTEGER) AS place, CASE rank WHEN 0 THEN 'id' WHEN 1 THEN 'title' ELSE 'alias' END AS reason, e AS entry_id FROM b",
    "f7_classes": f"SELECT DISTINCT 'same_title' AS conflict, title AS key, n FROM ({SQL['f3_planted']}) UNION ALL SELECT DISTINCT 'near_slug', slug_key, n FROM ({SQL['f6_planted']}) UNION ALL SELECT 'shared_name', name, owners FROM ({_SQL['f4_shared_names']})",
    "s12_lookups": f"""SELECT kind, {catalog_sql._squeeze('name')} AS key, max(id) AS slug FROM (SELECT 'by_title' AS kind, title AS name, id FROM wiki_index UNION ALL SELECT 'by_alias', unnest(aliases), id FROM wiki_index) WHERE name IS NOT NULL GROUP BY 1, 2""",
    "q6_read": SQL["q5_planted"].split("SELECT query, slug, CASE rank")[0].rstrip() + ", ok AS (SELECT query, slug FROM b WHERE slug IN (SELECT slug FROM wiki)) SELECT q.query, ok.slug, CASE WHEN ok.slug IS NULL THEN 'no page: ' || coalesce(q.query, '') END AS error FROM q LEFT JOIN ok ON ok.query = q.query",
    "k5_index_page": f"""WITH {catalog_sql._WIKI}, {_INDEX_KINDS} SELECT section, '' AS title, '' AS slug, '## ' || head AS line FROM kinds
        UNION ALL SELECT section, lower(title), slug, '- [[' || title || ']]' || CASE WHEN summary <> '' THEN ' — ' || summary ELSE '' END FROM wiki JOIN kinds k ON k.type = wiki.type
        UNION ALL SELECT section, '', '-', '_None yet._' FROM kinds WHERE type NOT IN (SELECT type FROM wiki)""",
}

_RULES = ("v1_frontmatter", "v2_provenance", "v3_prefixes", "v4_ids", "v6_unsourced", "v7_scope", "v11_language")
_LINT = " UNION ALL ".join(f"SELECT rule, message, slug FROM ({_SQL[q]})" for q in _RULES).replace("> 300", "> 5000").replace(" UNION SELECT id FROM wiki_index", "")
_LINT = f"SELECT * FROM ({_LINT})"
SQL |= {
    "f11_lint_totals": f"SELECT rule, count(*) AS violations, count(DISTINCT slug) AS pages FROM ({_LINT}) GROUP BY rule ORDER BY violations DESC, rule",
    "f11_worst_pages": f"SELECT slug, count(*) AS violations FROM ({_LINT}) GROUP BY slug ORDER BY violations DESC, slug LIMIT 25",
    "f11_examples": f"SELECT rule, CAST(place AS INTEGER) AS place, slug, message FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY slug, message) AS place FROM ({_LINT})) WHERE place <= 8",
}

_MARKER = r"<!--\s*PAGE:\d+\s*-->"
_HEADS = _SQL["b4_chapters"].split("SELECT sha256, chapter, count(*)")[0]
SQL |= {
    "c1_extract": r"""WITH paths AS (SELECT stem, min(source_path) AS path FROM md_doc GROUP BY stem), c AS (SELECT ch.*, coalesce(p.path, '') AS path FROM chunk ch LEFT JOIN paths p ON p.stem = ch.stem),
        z AS (SELECT *, string_split(regexp_replace(text, '([.!?。！？])\s*', '\1' || chr(1), 'g'), chr(1)) AS ss FROM c WHERE text IS NOT NULL), s AS (SELECT chunk_id, unnest(ss) AS sent, generate_subscripts(ss, 1) AS si FROM z),
        h AS (SELECT *, regexp_extract_all(sent, '\b[Tt]he [A-Z][a-z]{2,} [a-z]{4,}\b') AS hs FROM s), m AS (SELECT chunk_id, sent, si, unnest(hs) AS hit, generate_subscripts(hs, 1) AS mi FROM h),
        f AS (SELECT chunk_id, substr(hit, 5) AS title, trim(regexp_replace(sent, '\s+', ' ', 'g')) AS s, min(si * 1000000 + mi) AS pos FROM m GROUP BY 1, 2, 3),
        t AS (SELECT chunk_id, title, arg_min(s, pos) AS summary, row_number() OVER (PARTITION BY chunk_id ORDER BY min(pos)) - 1 AS ord FROM f GROUP BY 1, 2)
        SELECT c.stem, CAST(c.chunk_index AS INTEGER) AS chunk_index, CAST(t.ord AS INTEGER) AS ord, 'concept' AS page_type, f.title, t.summary, rtrim(f.s, ' .;,') AS claim,
        '[' || path || CASE WHEN start_page IS NOT NULL THEN '#p' || start_page || CASE WHEN end_page IS NULL OR end_page = start_page THEN '' ELSE '-p' || end_page END ELSE '#L' || coalesce(start_line, 0) || '-L' || coalesce(end_line, 0) END || ']' AS provenance, replace(lower(f.title), ' ', '-') AS id
        FROM f JOIN t ON t.chunk_id = f.chunk_id AND t.title = f.title JOIN c ON c.chunk_id = f.chunk_id""",
    "b9_chunks": _HEADS.replace("WITH texts", "WITH RECURSIVE texts", 1)
    + rf""", p AS (SELECT *, row_number() OVER (PARTITION BY sha256, chapter ORDER BY start_line) AS n FROM c),
        r AS (SELECT sha256, chapter, n, words AS acc, 1 AS k FROM p WHERE n = 1 UNION ALL SELECT p.sha256, p.chapter, p.n, CASE WHEN r.acc + p.words <= 300 THEN r.acc + p.words ELSE p.words END, CASE WHEN r.acc + p.words <= 300 THEN r.k ELSE r.k + 1 END FROM r JOIN p ON p.sha256 = r.sha256 AND p.chapter = r.chapter AND p.n = r.n + 1),
        g AS (SELECT sha256, chapter, k, sum(words) AS w, max(k) OVER (PARTITION BY sha256, chapter) AS ks FROM (SELECT r.*, p.words FROM r JOIN p ON p.sha256 = r.sha256 AND p.chapter = r.chapter AND p.n = r.n) GROUP BY sha256, chapter, k),
        q AS (SELECT p.*, CASE WHEN r.k = g.ks AND g.ks > 1 AND g.w < 60 THEN r.k - 1 ELSE r.k END AS k FROM p JOIN r ON r.sha256 = p.sha256 AND r.chapter = p.chapter AND r.n = p.n JOIN g ON g.sha256 = p.sha256 AND g.chapter = p.chapter AND g.k = r.k),
        tags AS (SELECT sha256, chapter, CASE WHEN heads THEN substr(trim(string_split(regexp_replace(body, '^(?:\s*{_MARKER}\s*\n)+', ''), chr(10))[1]), 1, 80) END AS tag FROM p WHERE n = 1),
        u AS (SELECT sha256, chapter, k, min(start_line) AS start_line, max(end_line) AS end_line, sum(words) AS word_count, string_agg(body, chr(10) ORDER BY n) AS body FROM q GROUP BY 1, 2, 3),
        v AS (SELECT *, TRY_CAST(regexp_extract_all(body, '<!--\s*PAGE:(\d+)\s*-->', 1)[1] AS INTEGER) AS a, TRY_CAST(regexp_extract_all(body, '<!--\s*PAGE:(\d+)\s*-->', 1)[-1] AS INTEGER) AS b FROM u),
        x AS (SELECT *, last_value(b IGNORE NULLS) OVER (PARTITION BY sha256 ORDER BY start_line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen, row_number() OVER (PARTITION BY sha256 ORDER BY start_line) - 1 AS i FROM v)
        SELECT x.sha256, CAST(i AS BIGINT) AS chunk_index, start_line, end_line, coalesce(a, seen) AS start_page, coalesce(b, seen) AS end_page, CAST(word_count AS BIGINT) AS word_count, tag FROM x JOIN tags t ON t.sha256 = x.sha256 AND t.chapter = x.chapter""",
}
