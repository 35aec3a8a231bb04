"""Candidates that collide with landed pages, and pages that collide with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.names import squeeze
from lectern.functions.text import slug_key


def collisions(candidate: DataFrame, index: DataFrame) -> DataFrame:
    """``candidate_id, reason, entry_id, rank`` of each candidate and entry it collides with, by the strongest reason.

    An entry collides by its id (0), its title (1), an alias that the candidate has too, or one that is the
    candidate's title (2). Right sides are distinct, and candidates with a common title are split by adaptive execution.
    """
    by_id = index.select(F.col("id").alias("k"), F.col("id").alias("entry_id"))
    by_title = index.select(squeeze(F.col("title")).alias("k"), F.col("id").alias("entry_id"))
    by_alias = index.select(F.explode("aliases").alias("a"), F.col("id").alias("entry_id")).select(squeeze(F.col("a")).alias("k"), "entry_id").distinct()
    cand = candidate.select("candidate_id", F.col("id").alias("own"), squeeze(F.col("title")).alias("title"))
    alias = candidate.select("candidate_id", F.explode("aliases").alias("a")).select("candidate_id", squeeze(F.col("a")).alias("k")).distinct()

    def hit(left: DataFrame, right: DataFrame, reason: str, rank: int) -> DataFrame:
        return left.join(right, "k").select("candidate_id", "entry_id", F.struct(F.lit(rank).alias("rank"), F.lit(reason).alias("reason")).alias("why"))

    out = hit(cand.select("candidate_id", F.col("own").alias("k")), by_id, "id", 0)
    out = out.unionByName(hit(cand.select("candidate_id", F.col("title").alias("k")), by_title, "title", 1))
    out = out.unionByName(hit(alias, by_alias, "alias", 2)).unionByName(hit(cand.select("candidate_id", F.col("title").alias("k")), by_alias, "alias", 2))
    best = out.groupBy("candidate_id", "entry_id").agg(F.min("why").alias("why"))
    return best.select("candidate_id", F.col("why.reason").alias("reason"), "entry_id", F.col("why.rank").alias("rank"))


def collision_reports(candidate: DataFrame, index: DataFrame) -> DataFrame:
    """``candidate_id, reason, hits, entry_id``: one row per candidate with its first reason, how many entries it hits, and the first."""
    per = collisions(candidate, index).groupBy("candidate_id").agg(F.min(F.struct("rank", "entry_id", "reason")).alias("why"), F.count("*").alias("hits"))
    return per.select("candidate_id", F.col("why.reason").alias("reason"), "hits", F.col("why.entry_id").alias("entry_id"))


def collision_hits(candidate: DataFrame, index: DataFrame) -> DataFrame:
    """``candidate_id, place, reason, entry_id``: each candidate's collisions in order, the strongest first, then by entry."""
    order = F.row_number().over(Window.partitionBy("candidate_id").orderBy("rank", "entry_id"))
    return collisions(candidate, index).withColumn("place", order).select("candidate_id", "place", "reason", "entry_id")


def conflict_classes(pages: DataFrame, index: DataFrame) -> DataFrame:
    """``conflict, key, n``: all conflicts by class: ``same_title``, ``near_slug`` and ``shared_name``, with how many pages share the key."""
    one = lambda df, name, key, n: df.select(F.lit(name).alias("conflict"), F.col(key).alias("key"), F.col(n).alias("n")).distinct()
    out = one(same_title(pages), "same_title", "title", "n").unionByName(one(near_duplicate_slugs(pages), "near_slug", "slug_key", "n"))
    return out.unionByName(one(shared_names(index), "shared_name", "name", "owners"))


def _groups(rows: DataFrame, key: str) -> DataFrame:
    """``key, n, slug``: the members of groups of several slugs. Groups are counted first and joined back, however large."""
    rows = rows.select(key, "slug").where(f"{key} is not null").distinct()
    many = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(many, key).select(key, "n", "slug")


def same_title(pages: DataFrame) -> DataFrame:
    """``title, n, slug`` of the pages whose title others have, letter case and white space aside; ``pages`` has ``slug, title``."""
    return _groups(pages.select(squeeze(F.col("title")).alias("title"), "slug"), "title")


def shared_names(index: DataFrame) -> DataFrame:
    """``name, owners``: titles and aliases that more than one entry has."""
    names = index.select("id", F.explode(F.concat(F.array("title"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    return names.select("id", squeeze(F.col("name")).alias("name")).where("name <> ''").groupBy("name").agg(F.countDistinct("id").alias("owners")).where("owners > 1")


def near_duplicate_slugs(pages: DataFrame) -> DataFrame:
    """``slug_key, n, slug`` of slugs that differ from others by articles, brackets and repeated hyphens only."""
    return _groups(pages.select(slug_key(F.col("slug")).alias("slug_key"), "slug"), "slug_key")


def top_conflicts(groups: DataFrame, key: str, most: int = 60) -> DataFrame:
    """The report's first groups of a class, in order of their key."""
    return groups.select(key, "n").distinct().orderBy(key).limit(most)
