"""Looking pages up and searching them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.names import kebab, squeeze

#: What a hit in a field counts, and the fields that are searched unless others are named.
WEIGHTS = {"title": 8, "aliases": 6, "summary": 3, "key_facts": 2, "tags": 1}
FIELDS = ("title", "summary", "key_facts")


def list_pages(wiki: DataFrame, kind: str | None = None) -> DataFrame:
    """All pages, or those of one type."""
    return wiki if kind is None else wiki.where(F.col("type") == kind)


def find_pages(names: DataFrame, wiki: DataFrame, index: DataFrame | None = None, kind: str | None = None) -> DataFrame:
    """``query, slug, how`` of each query in ``names(query)`` that names a page.

    In this order: its slug, its title, an alias, or the slug that the query's kebab form makes; of several pages the
    last by slug. With ``kind`` a page of another type is no answer.
    """
    probes = wiki.select(F.col("slug").alias("k"), F.lit(0).alias("rank"), "slug").unionByName(wiki.select(squeeze(F.col("title")).alias("k"), F.lit(1).alias("rank"), "slug"))
    if index is not None:
        probes = probes.unionByName(index.select(F.explode("aliases").alias("a"), "id").select(squeeze(F.col("a")).alias("k"), F.lit(2).alias("rank"), F.col("id").alias("slug")))
    probes = probes.unionByName(wiki.select(F.lower("slug").alias("k"), F.lit(3).alias("rank"), "slug"))
    probes = probes.groupBy("k", "rank").agg(F.max("slug").alias("slug"))
    q = names.select("query").distinct()
    keys = F.array(F.struct(F.col("query").alias("k"), F.lit(0).alias("rank")), *[F.struct(squeeze(F.col("query")).alias("k"), F.lit(r).alias("rank")) for r in (1, 2)], F.struct(kebab(F.col("query")).alias("k"), F.lit(3).alias("rank")))
    rows = q.select("query", F.explode(keys).alias("p")).select("query", "p.*").join(probes, ["k", "rank"])
    best = rows.groupBy("query").agg(F.min(F.struct("rank", "slug")).alias("b")).select("query", F.col("b.slug").alias("slug"), F.array(*map(F.lit, ("slug", "title", "alias", "kebab")))[F.col("b.rank")].alias("how"))
    return best.join(list_pages(wiki, kind).select("slug"), "slug", "left_semi").select("query", "slug", "how")


def read_pages(names: DataFrame, wiki: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``query, slug, error``: the page that each query names, or why it can't be read."""
    found = find_pages(names, wiki, index).select("query", "slug")
    rows = names.select("query").distinct().join(found, "query", "left")
    return rows.select("query", "slug", F.when(F.col("slug").isNull(), F.concat(F.lit("no page: "), F.coalesce("query", F.lit("")))).alias("error"))


def search(wiki: DataFrame, query: str, fields: tuple[str, ...] = FIELDS, limit: int = 20) -> DataFrame:
    """``slug, title, type, score, hits, snippet`` of the pages of which a field has all terms of the query.

    A field counts its weight; key facts are tried only where no other field hits. The best come first, then by title
    and slug. An empty query finds nothing. The cut is a top-k, not a sort of all pages.
    """
    terms = query.lower().split()
    has = lambda c: F.forall(F.array(*map(F.lit, terms)), lambda x: F.lower(c).contains(x))
    columns = {"title": F.col("title"), "summary": F.col("summary"), "tags": F.array_join("tags", " "), "aliases": F.array_join("aliases", " ") if "aliases" in wiki.columns else F.lit("")}
    if not terms:
        return wiki.select("slug", "title", "type", F.lit(0).alias("score"), F.lit("").alias("hits"), F.lit("").alias("snippet")).limit(0)
    cheap = [f for f in fields if f != "key_facts"]
    hit = {f: has(columns[f]) for f in cheap}
    score = sum((F.when(hit[f], WEIGHTS[f]).otherwise(0) for f in cheap), F.lit(0))
    facts = F.filter("facts", has) if "key_facts" in fields else F.array().cast("array<string>")
    deep = (score == 0) & (F.size(facts) > 0)
    place = F.locate(terms[0], F.lower(F.col("summary")))
    snippet = (
        F.when(deep, F.substring(F.get(facts, F.lit(0)), 1, 160))
        .when(hit.get("title", F.lit(False)), F.col("title"))
        .when(hit.get("summary", F.lit(False)), F.substring(F.col("summary"), F.greatest(place - 40, F.lit(1)), F.lit(120)))
        .otherwise(F.col("title"))
    )
    names = F.array_join(F.filter(F.array(*[F.when(hit[f], F.lit(f)) for f in cheap], F.when(deep, F.lit("key_facts"))), lambda x: x.isNotNull()), ",")
    rows = wiki.select("slug", "title", "type", F.when(deep, WEIGHTS["key_facts"]).otherwise(score).alias("score"), names.alias("hits"), snippet.alias("snippet")).where("score > 0")
    return rows.orderBy(F.desc("score"), F.lower("title"), "slug").limit(limit)
