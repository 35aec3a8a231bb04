"""The training-data queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from lectern.llm.budget import book_totals, slice_totals
from lectern.llm.encode import encode
from lectern.llm.langid import detect, mislabelled, profiles_of
from lectern.llm.leaks import leak_spans, leaked
from lectern.llm.names import linked
from lectern.llm.pii import masked, personal_data
from lectern.llm.repeats import collapsed_facts, repeated_facts
from lectern.llm.scans import noisy_lines, repaired
from lectern.llm.survivors import FRONT, NOTHING, SECTIONS, surviving_pages, surviving_values
from lectern.plans.shared import read



def p1_documents(s, d):
    docs = read(s, d, "documents")
    return detect(docs, "doc_id", "text", profiles_of(read(s, d, "md_doc"), docs)).drop("languages")


def p1_segments(s, d):
    docs = read(s, d, "documents")
    return detect(docs, "doc_id", "text", profiles_of(read(s, d, "md_doc"), docs), segments=True)


QUERIES = {
    "p1_found": lambda s, d: mislabelled(read(s, d, "md_doc"), read(s, d, "run_status"), read(s, d, "documents")),
    "p1_documents": p1_documents,
    "p1_segments": p1_segments,
    "p5_found": lambda s, d: repeated_facts(read(s, d, "fact")),
    "p7_budget": lambda s, d: slice_totals(read(s, d, "documents"), read(s, d, "chunk"), read(s, d, "md_doc")),
    "p7_books": lambda s, d: book_totals(read(s, d, "chunk"), read(s, d, "run_status")),
    "p8_ids": lambda s, d: encode(read(s, d, "documents"), "doc_id", "text"),
    "p9_found": lambda s, d: leaked(read(s, d, "documents"), read(s, d, "eval_item")),
    "p9_spans": lambda s, d: leak_spans(read(s, d, "documents"), read(s, d, "eval_item")),
    "p6_found": lambda s, d: noisy_lines(read(s, d, "chunk")),
    "p6_repaired": lambda s, d: repaired(read(s, d, "chunk")),
    "p3_found": lambda s, d: linked(read(s, d, "candidate"), read(s, d, "wiki_index")),
    "p4_found": lambda s, d: surviving_values(read(s, d, "page")),
    "p4_pages": lambda s, d: surviving_pages(read(s, d, "page")),
    "p10_found": lambda s, d: personal_data(read(s, d, "documents")).select("doc_id", "kind", "start_pos"),
    "p10_masked": lambda s, d: masked(read(s, d, "documents")),
    "p5_records": lambda s, d: collapsed_facts(read(s, d, "fact")),
}

_FIELDS = ", ".join([f"{{'f': '{k}', 'v': frontmatter->>'{k}'}}" for k in FRONT] + [f"{{'f': '{h}', 'v': list_filter(sections, lambda s: s.header = '{h}')[-1].body}}" for h in SECTIONS])
_NOTHING = ", ".join(f"'{w}'" for w in NOTHING)

SQL: dict[str, str] = {
    "p4_found": f"""WITH c AS (SELECT slug, page_row_id, landed_at, frontmatter->>'updated' AS u, unnest([{_FIELDS}]) AS x FROM page WHERE slug IS NOT NULL),
        v AS (SELECT slug, page_row_id, landed_at, x.f AS field_name, nullif(regexp_replace(x.v, '^\\s+|\\s+$', '', 'g'), '') AS value, coalesce(try_strptime(u, '%Y-%m-%d'), try_strptime(u, '%Y/%m/%d'), try_strptime(u, '%d %B %Y')) AS upd FROM c),
        d AS (SELECT slug, field_name FROM v GROUP BY 1, 2 HAVING count(value) > 0 AND (count(DISTINCT value) > 1 OR count(value) < count(*))),
        s AS (SELECT *, coalesce(nullif(regexp_replace(value, '\\s*(?:…|\\.\\.\\.|\\[(?:…|\\.\\.\\.)\\])$', ''), ''), value) AS stem FROM v WHERE value IS NOT NULL
            AND regexp_replace(lower(value), '^[\\s\\-–—*•_(\\[{{<]+|[\\s\\-–—*•_.!)\\]}}>]+$', '', 'g') NOT IN ({_NOTHING})),
        o AS (SELECT * FROM s a WHERE NOT EXISTS (SELECT 1 FROM s b WHERE b.slug = a.slug AND b.field_name = a.field_name AND b.value <> a.value AND starts_with(b.stem, a.stem) AND (b.stem <> a.stem OR a.value <> a.stem))),
        r AS (SELECT *, row_number() OVER (PARTITION BY slug, field_name ORDER BY upd DESC NULLS LAST, landed_at DESC, page_row_id) AS rn FROM o)
        SELECT r.slug, r.field_name, page_row_id FROM r JOIN d ON d.slug = r.slug AND d.field_name = r.field_name WHERE rn = 1""",
}
