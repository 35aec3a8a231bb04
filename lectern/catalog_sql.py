"""ANSI SQL, as DuckDB runs it, for the core queries that SQL can express."""

from __future__ import annotations

_REFS = r"""
refs AS (
  SELECT link_id, bucket, recorded_at,
    CASE bucket WHEN 'concepts' THEN 'concept' WHEN 'entities' THEN 'entity' ELSE 'topic' END AS kind,
    trim(regexp_replace(lower(regexp_replace(regexp_replace(coalesce(target, ''), '^\s*\[\[|\]\]\s*$', '', 'g'), '[|#].*$', '')), '[^\p{L}\p{M}\p{N}]+', '-', 'g'), '-') AS k
  FROM link WHERE bucket IN ('concepts', 'entities', 'topics') AND recorded_at IS NOT NULL),
pgs AS (
  SELECT slug, page_type AS kind, min(landed_at) AS a, max(removed_at) AS b,
    list_distinct(flatten(list([slug, title_line, frontmatter->>'title']))) AS names
  FROM page WHERE slug IS NOT NULL AND landed_at IS NOT NULL GROUP BY slug, page_type),
parents AS (
  SELECT DISTINCT kind, a, b, trim(regexp_replace(lower(n), '[^\p{L}\p{M}\p{N}]+', '-', 'g'), '-') AS k
  FROM (SELECT kind, a, b, unnest(names) AS n FROM pgs)),
judged AS (
  SELECT r.*, NOT EXISTS (SELECT 1 FROM parents p WHERE p.kind = r.kind AND p.k = r.k AND r.k <> ''
    AND p.a < date_trunc('month', r.recorded_at) + INTERVAL 1 MONTH
    AND (p.b IS NULL OR p.b >= date_trunc('month', r.recorded_at) + INTERVAL 1 MONTH)) AS orphan
  FROM refs r)
"""

_LANDED = """
landed AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY landed_at DESC, page_row_id DESC) AS rn FROM page WHERE slug IS NOT NULL) WHERE rn = 1)
"""


def _body(header: str) -> str:
    return f"list_filter(sections, lambda s: s.header = '{header}')[-1].body"


def _bullets(body: str) -> str:
    return (
        f"list_transform(list_filter(string_split(coalesce({body}, ''), chr(10)), lambda x: regexp_matches(x, '^\\s*- ') AND NOT starts_with(x, '- (none')), "
        "lambda x: regexp_replace(regexp_replace(x, '^\\s*- ', ''), '^\\s+|\\s+$', '', 'g'))"
    )


_FIRST = "regexp_replace(regexp_replace(string_split(regexp_replace({b}, '^\\s+|\\s+$', '', 'g'), chr(10) || chr(10))[1], '\\s+', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"
_WIKI = (
    _LANDED
    + ", w0 AS (SELECT slug, coalesce(frontmatter->>'title', regexp_replace(title_line, '^#\\s*', ''), slug) AS title, page_type AS type, path, "
    + _FIRST.format(b=_body("Summary"))
    + " AS s, coalesce(CAST(json_extract(frontmatter, '$.tags') AS VARCHAR[]), CAST([] AS VARCHAR[])) AS tags, "
    + _bullets(_body("Key facts"))
    + " AS facts FROM landed), wiki AS (SELECT slug, title, type, path, coalesce(CASE WHEN length(s) > 200 THEN substr(s, 1, 197) || '...' ELSE s END, '') AS summary, tags, facts FROM w0)"
)
_TEXTS = "texts AS (SELECT DISTINCT sha256, text FROM md_doc WHERE text IS NOT NULL)"
_LINES = _TEXTS + (
    ", l AS (SELECT sha256, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM texts)"
    ", f AS (SELECT *, no - row_number() OVER (PARTITION BY sha256 ORDER BY no) AS run FROM l WHERE regexp_matches(line, '\\S'))"
    ", para AS (SELECT sha256, CAST(min(no) AS INTEGER) AS start_line, CAST(max(no) AS INTEGER) AS end_line, string_agg(line, chr(10) ORDER BY no) AS body FROM f GROUP BY sha256, run)"
)
_WORDS = "CAST(len(regexp_extract_all({0}, '[A-Za-z]+')) + len(regexp_extract_all({0}, '[\\x{{4e00}}-\\x{{9fff}}]')) AS BIGINT)"
_FILES = "files AS (SELECT DISTINCT source_path AS path FROM md_doc WHERE source_path IS NOT NULL)"


def _stem(path: str) -> str:
    name = f"regexp_replace(regexp_replace({path}, '^.*/', ''), '\\.[^.]+$', '')"
    s = f"trim(regexp_replace(lower({name}), '[^a-z0-9\\x{{4e00}}-\\x{{9fff}}]+', '-', 'g'), '-')"
    return f"coalesce(nullif(rtrim(substr({s}, 1, 60), '-'), ''), 'untitled')"


def _squeeze(c: str) -> str:
    return f"lower(regexp_replace(regexp_replace({c}, '[\\s\\x{{a0}}]+', ' ', 'g'), '^ | $', '', 'g'))"


def _kebab(c: str) -> str:
    return f"regexp_replace(regexp_replace({_squeeze(c)}, '[\\s_]+', '-', 'g'), '[^a-z0-9-]', '', 'g')"


def _target(c: str) -> str:
    x = f"regexp_replace(regexp_replace({c}, '^\\s*\\[\\[|\\]\\]\\s*$', '', 'g'), '[|#].*$', '')"
    return f"CASE WHEN trim({x}) <> '' THEN {x} END"


def _slug_key(c: str) -> str:
    s = f"trim(regexp_replace(regexp_replace(lower({c}), '\\(.*?\\)', '', 'g'), '[-_]+', '-', 'g'), '-')"
    for a in ("the", "a", "an"):
        s = f"regexp_replace(regexp_replace({s}, '^{a}-', ''), '-{a}$', '')"
    return s


def _lang(c: str) -> str:
    zh, en = f"len(regexp_extract_all({c}, '[\\x{{4e00}}-\\x{{9fff}}]'))", f"len(regexp_extract_all({c}, '[A-Za-z]'))"
    return f"CASE WHEN {zh} = 0 AND {en} = 0 THEN 'unknown' WHEN {zh} > {en} THEN 'zh' ELSE 'en' END"


_KEYS = ("id", "title", "type", "status", "created", "updated", "sources", "confidence", "source_author", "source_date", "reliability", "tags")


def _yaml(k: str) -> str:
    v = f"(frontmatter->>'{k}')"
    if k not in ("sources", "tags"):
        v = f"CASE WHEN regexp_matches({v}, '^[A-Za-z0-9_][A-Za-z0-9_ ./-]*$') THEN {v} ELSE '\"' || replace(replace({v}, '\\', '\\\\'), '\"', '\\\"') || '\"' END"
    return f"CASE WHEN (frontmatter->>'{k}') IS NOT NULL THEN '{k}: ' || {v} END"


_SECTION_BODY = "coalesce(nullif(s.body, ''), '- (none recorded)')"
_RENDERED = (
    _LANDED
    + ", md AS (SELECT slug, '---' || chr(10) || concat_ws(chr(10), "
    + ", ".join(map(_yaml, _KEYS))
    + ") || chr(10) || '---' || chr(10) || chr(10) || coalesce(title_line, '# ' || slug) || chr(10) || chr(10) || "
    + f"array_to_string(list_transform(list_sort(list_transform(sections, lambda s: {{'ord': s.ord, 'header': s.header, 'body': s.body}})), lambda s: '## ' || s.header || chr(10) || chr(10) || {_SECTION_BODY} || chr(10)), chr(10)) AS md FROM landed)"
)
_SOURCES = _LANDED + (
    ", books AS (SELECT stem, min(text) AS text FROM md_doc WHERE text IS NOT NULL GROUP BY stem)"
    ", src AS (SELECT slug, books.text AS source_text FROM landed JOIN books ON books.stem = regexp_extract(frontmatter->>'$.sources[0]', '([^/]+)\\.[a-z]+$', 1))"
)
_ANCHOR = r"\[raw/[^\n]+?\.(?:pdf|epub|md|txt)#(?:p\d+(?:-p?\d+)?|L\d+(?:-L?\d+)?)\]"
_ANY = r"\[raw/[^\n]+?\.(?:pdf|epub|md|txt)(?:#(?:p\d+(?:-p?\d+)?|L\d+(?:-L?\d+)?))?\]"
_ALL_BODIES = "array_to_string(list_transform(list_sort(list_transform(sections, lambda s: {'ord': s.ord, 'body': s.body})), lambda s: coalesce(s.body, '')), chr(10))"
_REQUIRED = "(VALUES ('entity', 'aliases'), ('entity', 'canonical'), ('entity', 'confidence'), ('concept', 'confidence'), ('topic', 'confidence'), ('source', 'source_kind'), ('source', 'source_path'), ('source', 'source_date'), ('source', 'source_author'), ('source', 'reliability'), ('analysis', 'question'), ('analysis', 'confidence')"
_REQUIRED += "".join(f", ('{p}', '{f}')" for p in ("entity", "concept", "topic", "source", "analysis") for f in ("title", "type", "status", "created", "updated", "sources")) + ") AS r(kind, field)"
_MAY = "(VALUES ('entity', 'tags'), ('concept', 'tags'), ('topic', 'tags'), ('source', 'tags'), ('analysis', 'tags')) AS m(kind, field)"
_NAMES = _WIKI + (
    f", n0 AS (SELECT lower(slug) AS name, 0 AS rank, slug FROM wiki UNION ALL SELECT {_squeeze('title')}, 1, slug FROM wiki UNION ALL SELECT {_kebab('title')}, 3, slug FROM wiki"
    "{alias}), names AS (SELECT name, arg_min(slug, (rank, slug)) AS slug FROM n0 WHERE name <> '' GROUP BY name)"
    f", tg AS (SELECT *, {_target('target')} AS t FROM link), tk AS (SELECT *, {_squeeze('t')} AS name, {_kebab('t')} AS kebab FROM tg)"
    ", res AS (SELECT tk.link_id, tk.src_slug, tk.ord, tk.target, coalesce(a.slug, b.slug) AS slug FROM tk LEFT JOIN names a ON a.name = tk.name LEFT JOIN names b ON b.name = tk.kebab)"
)
_WITH_ALIAS = _NAMES.replace("{alias}", f" UNION ALL SELECT {_squeeze('a')}, 2, id FROM (SELECT id, unnest(aliases) AS a FROM wiki_index)")
_WITHOUT_ALIAS = _NAMES.replace("{alias}", "")
_NAMED = _WIKI + ", named AS (SELECT slug, title FROM wiki UNION ALL SELECT id, title FROM wiki_index)"
_LAST_RUNS = "runs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY finished_at DESC, loaded_at DESC, run_id DESC) AS rn FROM run_status WHERE stem IS NOT NULL) WHERE rn = 1)"
_SIZES = _LANDED + f", sizes AS (SELECT slug, {_squeeze('coalesce(frontmatter->>$$title$$, slug)')} AS title, page_type, list_sum(list_transform(sections, lambda s: strlen(coalesce(s.body, '')))) AS size FROM landed)"


def _plan(key: str, rows: str) -> str:
    return (
        f"plan AS (SELECT r.{key}, g.canonical, r.slug AS duplicate FROM {rows} r JOIN (SELECT {key}, arg_min(slug, (-size, length(slug), slug)) AS canonical FROM {rows} "
        f"GROUP BY {key} HAVING count(*) > 1 AND count(DISTINCT page_type) = 1) g ON g.{key} = r.{key} WHERE r.slug <> g.canonical)"
    )


_NEAR = _SIZES + f", keyed AS (SELECT *, {_slug_key('slug')} AS slug_key FROM sizes), " + _plan("slug_key", "keyed")


def _search(terms: list[str], fields: dict[str, tuple[str, int]], facts: bool, limit: int, snippet: str) -> str:
    def has(c: str) -> str:
        return "(" + " AND ".join(f"contains(lower({c}), '{x}')" for x in terms) + ")"

    score = " + ".join(f"CASE WHEN {has(c)} THEN {w} ELSE 0 END" for c, w in fields.values())
    names = ", ".join(f"CASE WHEN {has(c)} THEN '{f}' END" for f, (c, _) in fields.items())
    hit = f"list_filter(facts, lambda x: {has('x')})" if facts else "CAST([] AS VARCHAR[])"
    return (
        f"WITH {_WIKI}, s AS (SELECT *, {score} AS cheap, {hit} AS hit, concat_ws(',', {names}) AS names FROM wiki), "
        "d AS (SELECT *, cheap = 0 AND len(hit) > 0 AS deep FROM s) "
        f"SELECT slug, title, type, CAST(CASE WHEN deep THEN 2 ELSE cheap END AS INTEGER) AS score, CASE WHEN deep THEN 'key_facts' ELSE names END AS hits, CASE WHEN deep THEN substr(hit[1], 1, 160) {snippet} ELSE title END AS snippet "
        f"FROM d WHERE cheap > 0 OR deep ORDER BY score DESC, lower(title), slug LIMIT {limit}"
    )


def _claim_key(line: str) -> str:
    bare = f"regexp_replace({line}, '^\\s*-\\s*', '')"
    cut = f"CASE WHEN regexp_matches({bare}, '\\]\\s*$') THEN regexp_replace({bare}, '(?s)\\[raw/.*$', '') ELSE {bare} END"
    return f"lower(regexp_replace({cut}, '^[\\s\\x{{a0}}]+|[\\s\\x{{a0}}]+$', '', 'g'))"


def _three_sections() -> str:
    one = "SELECT slug, landed_at, page_row_id, '{h}' AS section, {b} AS lines FROM page WHERE slug IS NOT NULL"
    return " UNION ALL ".join(one.format(h=h, b=_bullets(_body(h))) for h in ("Key facts", "Inferences", "Uncertainties"))


_BUCKETS = "(VALUES ('broader', 1), ('narrower', 2), ('adjacent', 3), ('concepts', 4), ('topics', 5), ('entities', 6)) AS o(bucket, place)"
_PLAIN_BODY = f"regexp_replace(regexp_replace({_ALL_BODIES}, '\\[raw/[^\\]]+\\]', '', 'g'), '\\[\\[[^\\]]*\\]\\]', '', 'g')"


def _without_template(c: str) -> str:
    for w in ("Primary source:", "Inference:", "Uncertain:", "Broader:", "Narrower:", "Adjacent:", "Concepts:", "Topics:", "Entities:", "page created by auto ingest"):
        c = f"replace({c}, '{w}', '')"
    return c


def _file_name(c: str) -> str:
    s = f"regexp_replace({c}, '(.)\\.[^./]+$', '\\1')"
    s = f"regexp_replace({s}, '^(?:\\s*\\[[^\\]]*\\]\\s*|\\s*【[^】]*】\\s*)+', '')"
    s = f"regexp_replace({s}, '^\\d+[._-]\\s*', '')"
    s = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
    s = f"trim(regexp_replace({s}, '_+', '_', 'g'), '_')"
    s = f"rtrim(substr(regexp_replace({s}, '[<>:\"|?*]', '', 'g'), 1, 100))"
    return f"coalesce(nullif({s}, ''), 'untitled') || lower(regexp_extract({c}, '.(\\.[^./]+)$', 1))"


_BASE = "regexp_replace(path, '^.*/', '')"

SQL = {
    "p2_found": f"WITH {_REFS} SELECT link_id FROM judged WHERE orphan",
    "p2_report": f"""WITH {_REFS} SELECT bucket, strftime(recorded_at, '%Y-%m') AS month, count(*) AS links,
        CAST(sum(CASE WHEN orphan THEN 1 ELSE 0 END) AS BIGINT) AS orphans FROM judged GROUP BY 1, 2""",
    "s2_stems": f"WITH {_FILES} SELECT path, {_stem('path')} AS stem FROM files",
    "s1_discover": f"""WITH {_FILES}, b AS (SELECT path, regexp_extract(path, '^raw/books/([^/]+)/', 1) AS folder, {_stem('path')} AS base FROM files WHERE starts_with(path, 'raw/books/') AND regexp_matches(lower(path), '\\.(pdf|epub)$')),
        c AS (SELECT path, base, CASE WHEN folder = '' THEN 'uncategorized' ELSE folder END AS discipline FROM b),
        n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY path) AS n, row_number() OVER (PARTITION BY base, discipline ORDER BY path) AS again FROM c),
        o AS (SELECT *, again = 1 OR (again = 2 AND min(n) OVER (PARTITION BY base, discipline) = 1) AS own FROM n),
        k AS (SELECT *, sum(CASE WHEN own THEN 0 ELSE 1 END) OVER (PARTITION BY base ORDER BY path ROWS UNBOUNDED PRECEDING) + 2 AS number FROM o)
        SELECT CASE WHEN n = 1 THEN base WHEN own THEN base || '-' || discipline ELSE base || '-' || CAST(CAST(number AS BIGINT) AS VARCHAR) END AS stem, path, discipline FROM k""",
    "s3_pages": """WITH p AS (SELECT chunk_id, unnest(string_split(text, chr(12))) AS body, generate_subscripts(string_split(text, chr(12)), 1) AS page FROM chunk)
        SELECT chunk_id, CAST(page AS INTEGER) AS page, CAST(length(body) AS BIGINT) AS chars FROM p WHERE regexp_matches(body, '[^\\s\\x{3000}\\x{a0}]')""",
    "s7_usable_chars": f"WITH {_TEXTS} SELECT sha256, CAST(length(regexp_replace(regexp_replace(text, '<!--\\s*PAGE:\\d+\\s*-->', '', 'g'), '^\\s+|\\s+$', '', 'g')) AS BIGINT) AS usable FROM texts",
    "s13_raw_index": f"WITH {_FILES} SELECT regexp_replace(path, '^.*/', '') AS name, min(path) AS path, count(*) AS n FROM files WHERE regexp_matches(lower(path), '\\.(pdf|epub|md|txt)$') GROUP BY 1",
    "b1_word_counts": f"SELECT chunk_id, {_WORDS.format('text')} AS words, word_count FROM chunk WHERE text IS NOT NULL",
    "b2_paragraphs": f"WITH {_LINES} SELECT * FROM para",
    "b4_chapters": f"""WITH {_LINES}, h AS (SELECT *, regexp_matches(string_split(regexp_replace(body, '^(?:\\s*<!--\\s*PAGE:\\d+\\s*-->\\s*\\n)+', ''), chr(10))[1],
        '(?i)^\\s*(?:#{{1,6}}\\s+.+|Chapter\\s+\\d+|Part\\s+[IVX\\d]+|Section\\s+\\d+|第[一二三四五六七八九十百千]+[章节篇部])') AS heads, {_WORDS.format('body')} AS words FROM para),
        c AS (SELECT *, CAST(sum(CAST(heads AS INTEGER)) OVER (PARTITION BY sha256 ORDER BY start_line ROWS UNBOUNDED PRECEDING) AS INTEGER) AS chapter FROM h)
        SELECT sha256, chapter, count(*) AS paragraphs, CAST(sum(words) AS BIGINT) AS words FROM c GROUP BY 1, 2""",
    "b7_page_spans": """SELECT chunk_id, TRY_CAST(regexp_extract_all(text, '<!--\\s*PAGE:(\\d+)\\s*-->', 1)[1] AS INTEGER) AS first_page,
        TRY_CAST(regexp_extract_all(text, '<!--\\s*PAGE:(\\d+)\\s*-->', 1)[-1] AS INTEGER) AS last_page FROM chunk WHERE text IS NOT NULL""",
    "c6_slug_ids": """WITH s AS (SELECT candidate_id, title, lower(regexp_replace(title, '^\\s+|\\s+$', '', 'g')) AS low FROM candidate), k AS (SELECT *, trim(regexp_replace(low, '[^a-z0-9]+', '-', 'g'), '-') AS k FROM s)
        SELECT candidate_id, CASE WHEN regexp_matches(low, '^[a-z0-9]+(?:-[a-z0-9]+)*$') THEN low WHEN k <> '' THEN k ELSE 'page-' || substr(sha1(title), 1, 10) END AS slug_id FROM k""",
    "c9_merge_candidates": """SELECT stem, id, arg_min(page_type, (chunk_index, ord, candidate_id)) AS page_type, arg_min(title, (chunk_index, ord, candidate_id)) AS title,
        arg_min(summary, (chunk_index, ord, candidate_id)) AS summary, count(*) AS parts FROM candidate WHERE stem IS NOT NULL AND id IS NOT NULL GROUP BY stem, id""",
    "c11_source_pages": """WITH f AS (SELECT stem, arg_min(title, (chunk_index, ord, candidate_id)) AS title FROM candidate WHERE page_type = 'source' AND stem IS NOT NULL GROUP BY stem),
        b AS (SELECT stem, min(source_path) AS path FROM md_doc WHERE stem IS NOT NULL GROUP BY stem)
        SELECT b.stem, coalesce(f.title, trim(regexp_replace(regexp_replace(regexp_replace(path, '^.*/', ''), '\\.[^.]+$', ''), '[_-]+', ' ', 'g'))) AS title, f.stem IS NULL AS made FROM b LEFT JOIN f ON f.stem = b.stem""",
    "r4_rendered": f"WITH {_RENDERED} SELECT slug, md FROM md",
    "q1_sections": f"WITH {_LANDED} SELECT slug, s.header AS header, trim({_SECTION_BODY}, chr(10)) AS body FROM (SELECT slug, unnest(sections) AS s FROM landed)",
    "q2_facts": f"""WITH {_WIKI}, f AS (SELECT slug, unnest(facts) AS line, generate_subscripts(facts, 1) - 1 AS ord FROM wiki), a AS (SELECT *, regexp_extract(line, '{_ANY}') AS anchor FROM f)
        SELECT slug, CAST(ord AS INTEGER) AS ord, rtrim(CASE WHEN anchor = '' THEN line ELSE string_split(line, anchor)[1] END, ' .;,') AS claim, anchor AS provenance FROM a""",
    "v1_frontmatter": f"""WITH {_LANDED}, k AS (SELECT slug, page_type AS kind, key FROM (SELECT slug, page_type, frontmatter, unnest(json_keys(frontmatter)) AS key FROM landed) WHERE (frontmatter->>('$.' || key)) IS NOT NULL)
        SELECT 'frontmatter_schema' AS rule, 'missing field: ' || r.field AS message, l.slug FROM landed l JOIN {_REQUIRED} ON r.kind = l.page_type WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.slug = l.slug AND k.key = r.field)
        UNION ALL SELECT 'frontmatter_schema', 'unknown field: ' || k.key, k.slug FROM k WHERE k.key <> 'id' AND NOT EXISTS (SELECT 1 FROM {_REQUIRED} WHERE r.kind = k.kind AND r.field = k.key) AND NOT EXISTS (SELECT 1 FROM {_MAY} WHERE m.kind = k.kind AND m.field = k.key)
        UNION ALL SELECT 'frontmatter_schema', 'bad status: ' || (frontmatter->>'status'), slug FROM landed WHERE (frontmatter->>'status') NOT IN ('draft', 'active', 'deprecated', 'conflicted') AND (frontmatter->>'status') <> ''
        UNION ALL SELECT 'frontmatter_schema', 'bad confidence: ' || (frontmatter->>'confidence'), slug FROM landed WHERE page_type <> 'source' AND (frontmatter->>'confidence') NOT IN ('low', 'medium', 'high') AND (frontmatter->>'confidence') <> ''
        UNION ALL SELECT 'frontmatter_schema', 'bad reliability: ' || (frontmatter->>'reliability'), slug FROM landed WHERE page_type = 'source' AND (frontmatter->>'reliability') NOT IN ('low', 'medium', 'high', 'unknown') AND (frontmatter->>'reliability') <> ''""",
    "v2_files": f"""WITH {_LANDED}, {_FILES}, a AS (SELECT DISTINCT slug, unnest(regexp_extract_all({_ALL_BODIES}, '{_ANCHOR}')) AS ref FROM landed)
        SELECT 'provenance_format' AS rule, 'missing file: ' || ref AS message, slug FROM a WHERE regexp_extract(ref, '^\\[([^#]+)#', 1) NOT IN (SELECT path FROM files)""",
    "v2_provenance": f"""WITH {_LANDED}, a AS (SELECT DISTINCT slug, unnest(regexp_extract_all({_ALL_BODIES}, '{_ANCHOR}')) AS ref FROM landed),
        b AS (SELECT *, TRY_CAST(regexp_extract(ref, '#[pL](\\d+)', 1) AS BIGINT) AS lo, TRY_CAST(regexp_extract(ref, '-[pL]?(\\d+)\\]', 1) AS BIGINT) AS hi FROM a)
        SELECT 'provenance_format' AS rule, 'page out of range: ' || ref AS message, slug FROM b WHERE contains(ref, '#p') AND (lo < 1 OR coalesce(hi, lo) > 300 OR coalesce(hi < lo, false))""",
    "v4_ids": f"""WITH {_LANDED}, i AS (SELECT slug, nullif(frontmatter->>'id', '') AS id FROM landed), t AS (SELECT id FROM i WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1 UNION SELECT id FROM wiki_index)
        SELECT 'id_uniqueness' AS rule, 'missing id' AS message, slug FROM i WHERE id IS NULL UNION ALL SELECT 'id_uniqueness', 'id taken: ' || id, slug FROM i WHERE id IN (SELECT id FROM t)""",
    "v5_links": """SELECT 'link_format' AS rule, 'empty link target: [[' || trim(x) || ']]' AS message, link_id AS slug FROM (SELECT link_id, unnest(regexp_extract_all('[[' || target || ']]', '\\[\\[([^\\[\\]]*?)\\]\\]', 1)) AS x FROM link WHERE target IS NOT NULL)
        WHERE trim(x) = '' OR starts_with(trim(x), '|')""",
    "v6_unsourced": f"WITH {_WIKI} SELECT 'unsourced_facts' AS rule, 'no source: ' || substr(x, 1, 80) AS message, slug FROM (SELECT slug, unnest(facts) AS x FROM wiki) WHERE NOT regexp_matches(x, '{_ANCHOR}')",
    "v13_language": f"SELECT doc_id, {_lang('text')} AS language FROM documents WHERE text IS NOT NULL",
    "v10_raw_paths": f"WITH {_FILES} SELECT DISTINCT path FROM (SELECT path FROM page UNION ALL SELECT path FROM files) WHERE starts_with(ltrim(path, './'), 'raw/') AND ltrim(path, './') <> 'raw/inbox/_manifest.md'",
    "f2_collisions": f"""WITH c AS (SELECT candidate_id, id, {_squeeze('title')} AS title, aliases FROM candidate), t AS (SELECT {_squeeze('title')} AS k, id AS e FROM wiki_index),
        a AS (SELECT DISTINCT {_squeeze('x')} AS k, id AS e FROM (SELECT id, unnest(aliases) AS x FROM wiki_index)), ca AS (SELECT DISTINCT candidate_id, {_squeeze('x')} AS k FROM (SELECT candidate_id, unnest(aliases) AS x FROM c)),
        h AS (SELECT candidate_id, w.id AS e, 0 AS rank FROM c JOIN wiki_index w ON w.id = c.id UNION ALL SELECT candidate_id, e, 1 FROM c JOIN t ON t.k = c.title UNION ALL SELECT candidate_id, e, 2 FROM ca JOIN a ON a.k = ca.k UNION ALL SELECT candidate_id, e, 2 FROM c JOIN a ON a.k = c.title),
        b AS (SELECT candidate_id, e, min(rank) AS rank FROM h GROUP BY 1, 2)
        SELECT candidate_id, CASE min(rank) WHEN 0 THEN 'id' WHEN 1 THEN 'title' ELSE 'alias' END AS reason, count(*) AS hits, arg_min(e, (rank, e)) AS entry_id FROM b GROUP BY candidate_id""",
    "f3_same_title": f"WITH {_NAMED}, g AS (SELECT DISTINCT {_squeeze('title')} AS title, slug FROM named) SELECT title, n, slug FROM (SELECT *, count(*) OVER (PARTITION BY title) AS n FROM g) WHERE n > 1",
    "f4_shared_names": f"SELECT {_squeeze('x')} AS name, count(DISTINCT id) AS owners FROM (SELECT id, title AS x FROM wiki_index UNION ALL SELECT id, unnest(aliases) FROM wiki_index) GROUP BY 1 HAVING count(DISTINCT id) > 1",
    "f6_near_slugs": f"WITH {_NAMED}, g AS (SELECT DISTINCT {_slug_key('slug')} AS slug_key, slug FROM named) SELECT slug_key, n, slug FROM (SELECT *, count(*) OVER (PARTITION BY slug_key) AS n FROM g) WHERE n > 1",
    "f7_report": f"WITH {_NAMED}, u AS (SELECT * FROM named UNION ALL SELECT id, title FROM candidate WHERE id IS NOT NULL), g AS (SELECT DISTINCT {_squeeze('title')} AS title, slug FROM u WHERE title IS NOT NULL) SELECT title, count(*) AS n FROM g GROUP BY title HAVING count(*) > 1 ORDER BY title LIMIT 60",
    "f9_dangling": f"WITH {_WITH_ALIAS} SELECT link_id, src_slug, target FROM res WHERE slug IS NULL",
    "f10_index_drift": f"""WITH {_WIKI}, a AS (SELECT DISTINCT {_squeeze('title')} AS title FROM wiki), b AS (SELECT DISTINCT {_squeeze('title')} AS title FROM wiki_index)
        SELECT title, 'pages' AS side FROM a WHERE title NOT IN (SELECT title FROM b) UNION ALL SELECT title, 'index' FROM b WHERE title NOT IN (SELECT title FROM a)""",
    "x_unlinked_pages": f"WITH {_WITHOUT_ALIAS} SELECT slug FROM wiki WHERE slug NOT IN (SELECT slug FROM res WHERE slug IS NOT NULL AND slug <> src_slug)",
    "m4_frontmatter": """SELECT slug, arg_min(frontmatter->>'title', (landed_at, page_row_id)) FILTER (WHERE (frontmatter->>'title') IS NOT NULL) AS title, arg_min(frontmatter->>'created', (landed_at, page_row_id)) FILTER (WHERE (frontmatter->>'created') IS NOT NULL) AS created,
        max(CASE WHEN regexp_matches(frontmatter->>'updated', '^\\d{4}-\\d{2}-\\d{2}$') THEN frontmatter->>'updated' END) AS updated FROM page WHERE slug IS NOT NULL GROUP BY slug""",
    "m10_land": """WITH g AS (SELECT page_type, id AS slug, count(*) AS copies FROM candidate WHERE id IS NOT NULL GROUP BY 1, 2), e AS (SELECT DISTINCT page_type, slug FROM page)
        SELECT g.page_type, g.slug, CASE WHEN e.slug IS NULL THEN 'created' ELSE 'merged' END AS action, copies - CASE WHEN e.slug IS NULL THEN 1 ELSE 0 END AS merges FROM g LEFT JOIN e ON e.page_type = g.page_type AND e.slug = g.slug""",
    "m11_same_title_plan": f"WITH {_SIZES}, {_plan('title', 'sizes')} SELECT * FROM plan".replace("$$title$$", "'title'"),
    "m14_near_slug_plan": f"WITH {_NEAR} SELECT * FROM plan".replace("$$title$$", "'title'"),
    "m13_rewritten": f"""WITH {_NEAR}, m AS (SELECT DISTINCT duplicate AS slug, canonical FROM plan), x AS (SELECT link_id, src_slug, target, {_target('target')} AS t FROM link)
        SELECT link_id, coalesce(b.canonical, src_slug) AS src_slug, coalesce(a.canonical, target) AS target FROM x LEFT JOIN m a ON a.slug = x.t LEFT JOIN m b ON b.slug = x.src_slug""".replace("$$title$$", "'title'"),
    "m15_anchors": """SELECT DISTINCT provenance AS ref, regexp_replace(regexp_replace(provenance, '#(p|L)(\\d+),\\s*(p|L)?(\\d+)\\]', '#\\1\\2-\\3\\4]', 'g'), '#(p|L)(\\d+)-#(p|L)(\\d+)\\]', '#\\1\\2-\\3\\4]', 'g') AS fixed FROM fact WHERE provenance IS NOT NULL""",
    "m16_paths": f"""WITH {_FILES}, ix AS (SELECT regexp_replace(path, '^.*/', '') AS name, min(path) AS path, count(*) AS n FROM files WHERE regexp_matches(lower(path), '\\.(pdf|epub|md|txt)$') GROUP BY 1),
        sx AS (SELECT right(name, 40) AS suffix, min(path) AS path, CAST(sum(n) AS BIGINT) AS n FROM ix WHERE length(name) >= 40 GROUP BY 1),
        r AS (SELECT DISTINCT regexp_extract(provenance, '(raw/[^#\\]]+?)\\s*#', 1) AS path FROM fact WHERE provenance IS NOT NULL), q AS (SELECT path, regexp_replace(path, '^.*/', '') AS name FROM r WHERE path <> ''),
        j AS (SELECT q.path, f.path AS there, ix.path AS by_name, ix.n AS names, sx.path AS by_suffix, sx.n AS suffixes FROM q LEFT JOIN files f ON f.path = q.path LEFT JOIN ix ON ix.name = q.name LEFT JOIN sx ON length(q.name) >= 40 AND sx.suffix = right(q.name, 40))
        SELECT path, CASE WHEN there IS NOT NULL THEN path WHEN names = 1 THEN by_name WHEN names IS NULL AND suffixes = 1 THEN by_suffix END AS resolved,
        CASE WHEN there IS NOT NULL THEN 'exact' WHEN names = 1 THEN 'basename' WHEN names > 1 THEN 'basename-ambiguous (' || names || ')' WHEN suffixes = 1 THEN 'suffix' WHEN suffixes > 1 THEN 'suffix-ambiguous (' || suffixes || ')' ELSE 'no-match' END AS reason FROM j""",
    "q4_list": f"WITH {_WIKI} SELECT slug, title FROM wiki WHERE type = 'topic'",
    "q5_find": f"""WITH {_WIKI}, p0 AS (SELECT slug AS k, 0 AS rank, slug FROM wiki UNION ALL SELECT {_squeeze('title')}, 1, slug FROM wiki UNION ALL SELECT {_squeeze('a')}, 2, id FROM (SELECT id, unnest(aliases) AS a FROM wiki_index) UNION ALL SELECT lower(slug), 3, slug FROM wiki),
        p AS (SELECT k, rank, max(slug) AS slug FROM p0 GROUP BY 1, 2), q AS (SELECT DISTINCT title AS query FROM candidate WHERE title IS NOT NULL),
        h AS (SELECT query, rank, slug FROM q JOIN p ON (rank = 0 AND k = query) OR (rank IN (1, 2) AND k = {_squeeze('query')}) OR (rank = 3 AND k = {_kebab('query')})),
        b AS (SELECT query, min(rank) AS rank, arg_min(slug, (rank, slug)) AS slug FROM h GROUP BY query)
        SELECT query, slug, CASE rank WHEN 0 THEN 'slug' WHEN 1 THEN 'title' WHEN 2 THEN 'alias' ELSE 'kebab' END AS how FROM b WHERE slug IN (SELECT slug FROM wiki)""",
    "q7_search": _search(["survey", "map"], {"title": ("title", 8), "summary": ("summary", 3)}, True, 20,
        "WHEN contains(lower(title), 'survey') AND contains(lower(title), 'map') THEN title WHEN contains(lower(summary), 'survey') AND contains(lower(summary), 'map') THEN substr(summary, greatest(instr(lower(summary), 'survey') - 40, 1), 120)"),
    "q7_search_facts": _search(["ing", "brid"], {"title": ("title", 8), "tags": ("array_to_string(tags, ' ')", 1)}, True, 50, "WHEN contains(lower(title), 'ing') AND contains(lower(title), 'brid') THEN title"),
    "q9_neighbors": f"""WITH RECURSIVE {_WITHOUT_ALIAS}, e AS (SELECT DISTINCT src_slug AS src, slug AS dst FROM res WHERE slug IS NOT NULL AND slug <> src_slug), s AS (SELECT slug FROM wiki WHERE type = 'analysis'),
        r1 AS (SELECT DISTINCT s.slug AS seed, e.dst AS slug, 1 AS depth FROM s JOIN e ON e.src = s.slug), r2 AS (SELECT DISTINCT seed, e.dst AS slug, 2 AS depth FROM r1 JOIN e ON e.src = r1.slug)
        SELECT seed, slug, min(depth) AS depth FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2) WHERE slug <> seed GROUP BY 1, 2""",
    "k4_agents_index": f"""WITH {_WIKI}, r AS (SELECT src_slug, count(DISTINCT (bucket, target)) AS n FROM link WHERE origin = 'frontmatter' AND bucket IS NOT NULL AND target IS NOT NULL GROUP BY 1)
        SELECT slug, title, type, path, summary, CAST(len(facts) AS BIGINT) AS fact_count, CAST(len(tags) AS BIGINT) AS tag_count, coalesce(n, 0) AS related_count FROM wiki LEFT JOIN r ON r.src_slug = wiki.slug""",
    "k4_by_alias": f"SELECT {_squeeze('a')} AS alias, max(id) AS slug FROM (SELECT id, unnest(aliases) AS a FROM wiki_index) GROUP BY 1",
    "k3_summaries": f"WITH {_LANDED}, s AS (SELECT slug, {_FIRST.format(b=_body('Summary'))} AS s FROM landed) SELECT slug, CASE WHEN length(s) > 90 THEN substr(s, 1, 87) || '...' ELSE s END AS line FROM s",
    "k4_by_tag": f"WITH {_WIKI} SELECT DISTINCT unnest(tags) AS tag, slug FROM wiki",
    "k5_human_index": f"""WITH {_WIKI} SELECT type, slug, '- [[' || title || ']]' || CASE WHEN summary <> '' THEN ' — ' || summary ELSE '' END AS line FROM wiki""",
    "q3_bullets": f"WITH {_LANDED}, b AS (SELECT slug, {_bullets(_body('Inferences'))} AS x FROM landed) SELECT slug, CAST(ord - 1 AS INTEGER) AS ord, line FROM (SELECT slug, unnest(x) AS line, generate_subscripts(x, 1) AS ord FROM b)",
    "m2_lists": """WITH r AS (SELECT slug, landed_at, page_row_id, 'sources' AS field, CAST(json_extract(frontmatter, '$.sources') AS VARCHAR[]) AS v FROM page WHERE slug IS NOT NULL UNION ALL SELECT slug, landed_at, page_row_id, 'tags', CAST(json_extract(frontmatter, '$.tags') AS VARCHAR[]) FROM page WHERE slug IS NOT NULL
        UNION ALL SELECT slug, landed_at, page_row_id, 'aliases', CAST(json_extract(frontmatter, '$.aliases') AS VARCHAR[]) FROM page WHERE slug IS NOT NULL), u AS (SELECT slug, field, landed_at, page_row_id, unnest(v) AS value, generate_subscripts(v, 1) AS pos FROM r),
        f AS (SELECT slug, field, value, min((landed_at, page_row_id, pos)) AS w FROM u WHERE value IS NOT NULL GROUP BY 1, 2, 3) SELECT slug, field, CAST(row_number() OVER (PARTITION BY slug, field ORDER BY w, value) - 1 AS INTEGER) AS ord, value FROM f""",
    "m5_claim_keys": r"""WITH c AS (SELECT fact_id, regexp_replace('- ' || claim || ' ' || coalesce(provenance, ''), '^\s*-\s*', '') AS b FROM fact) SELECT fact_id, lower(regexp_replace(CASE WHEN regexp_matches(b, '\]\s*$') THEN regexp_replace(b, '(?s)\[raw/.*$', '') ELSE b END, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g')) AS claim_key FROM c""",
    "k6_batch_report": f"""WITH {_LAST_RUNS}, d AS (SELECT *, CASE WHEN regexp_extract(source_path, '^raw/books/([^/]+)/', 1) = '' THEN 'uncategorized' ELSE regexp_extract(source_path, '^raw/books/([^/]+)/', 1) END AS discipline, coalesce(status = 'ok', false) AS good FROM runs)
        SELECT discipline, count(*) AS books, CAST(sum(CASE WHEN good THEN 1 ELSE 0 END) AS BIGINT) AS ok, CAST(sum(CASE WHEN good THEN 0 ELSE 1 END) AS BIGINT) AS failed, CAST(sum(CASE WHEN good AND coalesce(validation_errors, 0) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS clean,
        CAST(sum(coalesce(chunk_count, 0)) AS BIGINT) AS chunks, CAST(sum(coalesce(candidate_count, 0)) AS BIGINT) AS candidates, CAST(sum(coalesce(validation_errors, 0)) AS BIGINT) AS violations FROM d GROUP BY discipline""",
    "k7_expected": """WITH a AS (SELECT DISTINCT stem FROM md_doc WHERE stem IS NOT NULL), b AS (SELECT stem, count(DISTINCT id) AS pages FROM candidate WHERE stem IS NOT NULL GROUP BY stem)
        SELECT coalesce(a.stem, b.stem) AS stem, CASE WHEN a.stem IS NULL THEN 'unexpected' WHEN b.stem IS NULL THEN 'missing' ELSE 'staged' END AS state, coalesce(pages, 0) AS pages FROM a FULL OUTER JOIN b ON a.stem = b.stem""",
    "k7_digest": f"WITH {_WIKI}, h AS (SELECT type, count(*) AS pages FROM wiki GROUP BY type) SELECT sha256(string_agg(type || '|' || pages, chr(10) ORDER BY type)) AS sha256 FROM h",
    "k8_types": f"WITH {_WIKI} SELECT type, count(*) AS pages FROM wiki GROUP BY type",
    "k10_to_do": f"WITH {_LAST_RUNS} SELECT DISTINCT stem FROM md_doc WHERE stem IS NOT NULL AND stem NOT IN (SELECT stem FROM runs WHERE status = 'ok' AND staging_files > 0)",
    "k2_tokens": """WITH r AS (SELECT stem, run_id, arg_max(tokens_in, loaded_at) FILTER (WHERE true) AS i, arg_max(tokens_out, loaded_at) AS o, arg_max(elapsed_sec, loaded_at) AS s FROM run_status WHERE stem IS NOT NULL GROUP BY 1, 2)
        SELECT stem, count(*) AS runs, CAST(sum(coalesce(i, 0)) AS BIGINT) AS tokens_in, CAST(sum(coalesce(o, 0)) AS BIGINT) AS tokens_out, round(sum(coalesce(s, 0.0)), 1) AS seconds FROM r GROUP BY stem""",
    "i2_layout": """WITH b AS (SELECT DISTINCT regexp_replace(source_path, '^raw/books/', '') AS path FROM md_doc WHERE source_path IS NOT NULL AND sha256 IS NOT NULL), d AS (SELECT len(string_split(path, '/')) - 1 AS n FROM b WHERE regexp_matches(lower(path), '\\.(pdf|epub)$'))
        SELECT CASE WHEN min(n) = 1 AND max(n) = 1 THEN 'subdir' WHEN max(n) = 0 THEN 'flat' ELSE 'mixed' END AS layout FROM d""",
    "m6_sections": f"""WITH c AS ({_three_sections()}), l AS (SELECT slug, landed_at, page_row_id, section, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM c), k AS (SELECT *, {_claim_key('line')} AS key FROM l),
        f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slug, section, key ORDER BY landed_at, page_row_id, pos, line) AS rn FROM k) WHERE rn = 1)
        SELECT slug, section, CAST(row_number() OVER (PARTITION BY slug, section ORDER BY landed_at, page_row_id, pos, line) - 1 AS INTEGER) AS ord, line FROM f""",
    "m7_related": f"""WITH x AS (SELECT src_slug, l.bucket, place, {_target('target')} AS t, recorded_at, ord, link_id FROM link l JOIN {_BUCKETS} ON o.bucket = l.bucket), k AS (SELECT *, {_squeeze('t')} AS key FROM x WHERE t IS NOT NULL),
        f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src_slug, bucket, key ORDER BY recorded_at, ord, link_id) AS rn FROM k) WHERE rn = 1)
        SELECT src_slug, bucket, CAST(place AS BIGINT) AS place, CAST(row_number() OVER (PARTITION BY src_slug, bucket ORDER BY recorded_at, ord, link_id, t) - 1 AS INTEGER) AS ord, regexp_replace(t, '^\\s+|\\s+$', '', 'g') AS target FROM f""",
    "m8_provenance": """WITH r AS (SELECT slug, landed_at, page_row_id, CAST(json_extract(frontmatter, '$.sources') AS VARCHAR[]) AS v FROM page WHERE slug IS NOT NULL), u AS (SELECT slug, landed_at, page_row_id, unnest(v) AS value, generate_subscripts(v, 1) AS pos FROM r),
        f AS (SELECT slug, value, min((landed_at, page_row_id, pos)) AS w FROM u GROUP BY 1, 2), o AS (SELECT *, CAST(row_number() OVER (PARTITION BY slug ORDER BY w, value) - 1 AS INTEGER) AS ord FROM f)
        SELECT slug, ord, CASE WHEN ord = 0 THEN '- Primary source: ' ELSE '- Additional source: ' END || value AS line FROM o""",
    "m12_fields": f"""WITH {_LANDED}, k AS (SELECT slug, page_type AS kind, unnest(json_keys(frontmatter)) AS field, frontmatter FROM landed)
        SELECT slug, field FROM k WHERE (frontmatter->>('$.' || field)) IS NOT NULL AND (field = 'id' OR EXISTS (SELECT 1 FROM {_REQUIRED} WHERE r.kind = k.kind AND r.field = k.field) OR EXISTS (SELECT 1 FROM {_MAY} WHERE m.kind = k.kind AND m.field = k.field))""",
    "m17_repaired": f"""WITH {_FILES}, r AS (SELECT DISTINCT provenance AS ref FROM fact WHERE provenance IS NOT NULL),
        fm AS (SELECT ref, regexp_replace(regexp_replace(ref, '#(p|L)(\\d+),\\s*(p|L)?(\\d+)\\]', '#\\1\\2-\\3\\4]', 'g'), '#(p|L)(\\d+)-#(p|L)(\\d+)\\]', '#\\1\\2-\\3\\4]', 'g') AS form FROM r),
        p AS (SELECT *, regexp_extract(form, '^\\[?\\s*([^#\\]]+?)\\s*[#\\]]', 1) AS path FROM fm), q AS (SELECT *, regexp_replace(path, '^.*/', '') AS name FROM p),
        ix AS (SELECT regexp_replace(path, '^.*/', '') AS name, min(path) AS path, count(*) AS n FROM files WHERE regexp_matches(lower(path), '\\.(pdf|epub|md|txt)$') GROUP BY 1),
        sx AS (SELECT right(name, 40) AS suffix, min(path) AS path, CAST(sum(n) AS BIGINT) AS n FROM ix WHERE length(name) >= 40 GROUP BY 1),
        j AS (SELECT q.*, f.path AS there, ix.path AS by_name, ix.n AS names, sx.path AS by_suffix, sx.n AS suffixes FROM q LEFT JOIN files f ON f.path = q.path LEFT JOIN ix ON ix.name = q.name AND q.path <> '' LEFT JOIN sx ON length(q.name) >= 40 AND sx.suffix = right(q.name, 40)),
        z AS (SELECT ref, form, path, CASE WHEN there IS NOT NULL THEN path WHEN names = 1 THEN by_name WHEN names IS NULL AND suffixes = 1 THEN by_suffix END AS resolved,
        CASE WHEN path = '' THEN 'no-path' WHEN there IS NOT NULL THEN 'exact' WHEN names = 1 THEN 'basename' WHEN names > 1 THEN 'basename-ambiguous (' || names || ')' WHEN suffixes = 1 THEN 'suffix' WHEN suffixes > 1 THEN 'suffix-ambiguous (' || suffixes || ')' ELSE 'no-match' END AS reason FROM j)
        SELECT reason, count(*) AS refs, CAST(sum(CASE WHEN ref <> CASE WHEN resolved IS NOT NULL AND resolved <> path THEN replace(form, path, resolved) ELSE form END THEN 1 ELSE 0 END) AS BIGINT) AS changed FROM z GROUP BY reason""",
    "q8_outbound": f"""WITH {_LANDED}, f AS (SELECT src_slug AS slug, 0 AS part, bucket, ord, link_id, target FROM link WHERE origin = 'frontmatter' AND target IS NOT NULL AND src_slug IN (SELECT slug FROM landed)),
        b AS (SELECT slug, unnest(regexp_extract_all({_ALL_BODIES}, '\\[\\[([^\\[\\]]*?)\\]\\]', 1)) AS x, generate_subscripts(regexp_extract_all({_ALL_BODIES}, '\\[\\[([^\\[\\]]*?)\\]\\]', 1), 1) AS pos FROM landed),
        u AS (SELECT * FROM f UNION ALL SELECT slug, 1, NULL, pos, NULL, trim(regexp_replace(x, '\\|.*$', '')) FROM b WHERE trim(regexp_replace(x, '\\|.*$', '')) <> ''),
        d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slug, target ORDER BY part, bucket NULLS FIRST, ord, link_id) AS rn FROM u) WHERE rn = 1)
        SELECT slug, CAST(row_number() OVER (PARTITION BY slug ORDER BY part, bucket NULLS FIRST, ord, link_id) - 1 AS INTEGER) AS ord, target FROM d""",
    "q10_provenance": f"""WITH {_LANDED}, l AS (SELECT slug, list_concat(coalesce(CAST(json_extract(frontmatter, '$.sources') AS VARCHAR[]), CAST([] AS VARCHAR[])), regexp_extract_all({_ALL_BODIES}, '{_ANY}')) AS v FROM landed),
        u AS (SELECT slug, unnest(v) AS ref, generate_subscripts(v, 1) AS pos FROM l), f AS (SELECT slug, ref, min(pos) AS pos FROM u GROUP BY 1, 2) SELECT slug, CAST(row_number() OVER (PARTITION BY slug ORDER BY pos) - 1 AS INTEGER) AS ord, ref FROM f""",
    "v11_language": f"""WITH {_SOURCES}, x AS (SELECT landed.slug, {_lang(_without_template(_PLAIN_BODY))} AS p, {_lang('source_text')} AS o FROM landed JOIN src ON src.slug = landed.slug)
        SELECT 'language_consistency' AS rule, 'page is ' || p || ' and source is ' || o AS message, slug FROM x WHERE p <> o AND p <> 'unknown' AND o <> 'unknown'""",
    "s6_conversion": """WITH d AS (SELECT DISTINCT m.sha256 FROM run_status r JOIN md_doc m ON m.stem = r.stem WHERE r.status = 'ok' AND m.sha256 IS NOT NULL), x AS (SELECT DISTINCT source_path AS path, sha256, text FROM md_doc)
        SELECT path, x.sha256, CASE WHEN d.sha256 IS NOT NULL THEN 'cached' WHEN coalesce(length(regexp_replace(regexp_replace(text, '<!--\\s*PAGE:\\d+\\s*-->', '', 'g'), '^\\s+|\\s+$', '', 'g')), 0) < 500 THEN 'needs_ocr' ELSE 'converted' END AS state FROM x LEFT JOIN d ON d.sha256 = x.sha256""",
    "i1_file_names": f"WITH {_FILES} SELECT path, {_file_name(_BASE)} AS name FROM files",
}


def _collapsed(c: str) -> str:
    for e in ("pdf", "epub", "md", "txt"):
        c = f"regexp_replace({c}, '(?i)(\\.{e})(?:\\.{e})+', '\\1', 'g')"
    return c


_STOP = "A An The In On At By For From Of To With Into Onto Like As Via It Its This That These Those His Her Their Our Your My Each Every Any Some All Both Such Is Are Was Were Be Been Being".split()


def _prefix(word: str) -> str:
    body = f"regexp_replace({_ALL_BODIES}, '(?:[\"''‘“][^\"''‘’“”:\\n]*|\\b[A-Z][a-z]+[ \\t]+)\\b(?:Inference|Uncertain):', '', 'g')"
    return f"SELECT 'prefix_syntax' AS rule, chr(39) || '{word}:' || chr(39) || ' in mid-sentence' AS message, slug FROM landed WHERE regexp_matches({body}, '(?:[^\\n]{{2}}[^ \\n]|[^\\n][^-\\n] ){word}:\\s')"


SQL |= {
    "c7_provenance": f"""WITH a AS (SELECT fact_id, regexp_replace(provenance, '^\\s+|\\s+$', '', 'g') AS a FROM fact), b AS (SELECT fact_id, CASE WHEN NOT starts_with(a, '[') AND ends_with(a, ']') AND starts_with(a, 'raw/') THEN '[' || a ELSE a END AS a FROM a),
        i AS (SELECT *, regexp_replace(a, '^[\\[\\]]+|[\\[\\]]+$', '', 'g') AS inn FROM b), p AS (SELECT *, {_collapsed("regexp_extract(inn, '^([^#]*)', 1)")} AS path, regexp_replace(regexp_replace(regexp_extract(inn, '^[^#]*#(.*)$', 1), '\\bL{{2,}}(\\d)', 'L\\1', 'g'), '\\bp{{2,}}(\\d)', 'p\\1', 'g') AS place FROM i)
        SELECT fact_id, CASE WHEN starts_with(a, '[') AND contains(a, '#') THEN '[' || CASE WHEN regexp_replace(path, '^.*/', '') = 'the-paernon-studies.pdf' THEN 'raw/books/history/the-paernon-studies.pdf' ELSE path END || '#' || place || ']' ELSE a END AS provenance FROM p""",
    "s14_import_plan": f"""WITH b AS (SELECT DISTINCT regexp_replace(source_path, '^raw/books/', '') AS path, sha256 FROM md_doc WHERE source_path IS NOT NULL AND sha256 IS NOT NULL),
        n AS (SELECT path, sha256, CASE WHEN contains(path, '/') THEN regexp_replace(lower(regexp_extract(path, '^([^/]+)/', 1)), '[^a-z0-9]+', '-', 'g') ELSE 'uncategorized' END AS discipline, {_file_name(_BASE)} AS name FROM b),
        k AS (SELECT *, row_number() OVER (PARTITION BY discipline, sha256 ORDER BY path) > 1 AS skip FROM n), m AS (SELECT *, sum(CASE WHEN skip THEN 0 ELSE 1 END) OVER (PARTITION BY discipline, name ORDER BY path ROWS UNBOUNDED PRECEDING) AS pos FROM k)
        SELECT path, discipline, CASE WHEN skip OR pos <= 1 THEN name ELSE regexp_replace(name, '\\.[^.]*$', '') || '-' || CAST(CAST(pos AS BIGINT) AS VARCHAR) || regexp_extract(name, '(\\.[^.]*)$', 1) END AS name, CASE WHEN skip THEN 'skip' ELSE 'copy' END AS action FROM m""",
    "v3_prefixes": f"WITH {_LANDED} {_prefix('Inference')} UNION ALL {_prefix('Uncertain')}",
    "v7_scope": f"""WITH {_WIKI}, books AS (SELECT stem, min(text) AS text FROM md_doc WHERE text IS NOT NULL GROUP BY stem), src AS (SELECT slug, books.text AS st FROM landed JOIN books ON books.stem = regexp_extract(frontmatter->>'$.sources[0]', '([^/]+)\\.[a-z]+$', 1)),
        f AS (SELECT slug, unnest(facts) AS x FROM wiki), h AS (SELECT slug, unnest(regexp_extract_all(x, '\\b([A-Z][A-Za-z0-9]+(?:[ \\t]+[A-Z][A-Za-z0-9]+){{1,3}})\\b', 1)) AS x FROM f),
        c AS (SELECT DISTINCT slug, regexp_replace(x, '^(?:(?:{"|".join(_STOP)})\\s+)+', '') AS x FROM h), w AS (SELECT c.slug, x, st, string_split_regex(x, '\\s+') AS ws FROM c JOIN src ON src.slug = c.slug WHERE contains(x, ' ') AND length(x) >= 4),
        a AS (SELECT slug, x FROM w WHERE NOT contains(st, x) AND len(list_filter(ws, lambda v: length(v) >= 3 AND NOT list_contains({_STOP}, v) AND contains(lower(st), lower(v)))) = 0 AND len(list_filter(ws, lambda v: NOT contains(st, v))) > 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY x) AS rn FROM a)
        SELECT 'scope_boundary' AS rule, 'not in the source: ' || string_agg(x, '; ' ORDER BY x) AS message, slug FROM r WHERE rn <= 5 GROUP BY slug""",
}
