"""Repair of provenance: anchors in the wrong form and paths that lead nowhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import LOOSE_ANCHOR, fix_anchor
from lectern.operators.pages import landed

SUFFIX = 40


def raw_index(files: DataFrame) -> DataFrame:
    """``name, path, n``: the first path of each base name, and how many there are, among ``files(path)`` of a readable kind."""
    rows = files.where(F.lower("path").rlike(r"\.(pdf|epub|md|txt)$")).select(F.regexp_replace("path", "^.*/", "").alias("name"), "path").distinct()
    return rows.groupBy("name").agg(F.min("path").alias("path"), F.count("*").alias("n"))


def resolve_paths(refs: DataFrame, files: DataFrame) -> DataFrame:
    """``path, resolved, reason`` of each distinct path: there as it is, by its unique base name, or by the last 40 characters of one.

    Ambiguous ones have no resolution and their number in the reason.
    """
    index = raw_index(files)
    rows = refs.select("path").where("path is not null").distinct().withColumn("name", F.regexp_replace("path", "^.*/", ""))
    exact = files.select("path").distinct().withColumn("there", F.lit(True))
    rows = rows.join(exact, "path", "left").join(index.select("name", F.col("path").alias("by_name"), F.col("n").alias("names")), "name", "left")
    long = index.where(F.length("name") >= SUFFIX).select(F.right("name", F.lit(SUFFIX)).alias("suffix"), "path", "n")
    long = long.groupBy("suffix").agg(F.min("path").alias("by_suffix"), F.sum("n").alias("suffixes"))
    rows = rows.withColumn("suffix", F.when(F.length("name") >= SUFFIX, F.right("name", F.lit(SUFFIX)))).join(long, "suffix", "left")
    reason = (
        F.when(F.col("there"), "exact")
        .when(F.col("names") == 1, "basename")
        .when(F.col("names") > 1, F.concat(F.lit("basename-ambiguous ("), F.col("names").cast("string"), F.lit(")")))
        .when(F.col("suffixes") == 1, "suffix")
        .when(F.col("suffixes") > 1, F.concat(F.lit("suffix-ambiguous ("), F.col("suffixes").cast("string"), F.lit(")")))
        .otherwise("no-match")
    )
    found = F.when(F.col("there"), F.col("path")).when(F.col("names") == 1, F.col("by_name")).when(F.col("names").isNull() & (F.col("suffixes") == 1), F.col("by_suffix"))
    return rows.select("path", found.alias("resolved"), reason.alias("reason"))


def repaired_anchors(refs: DataFrame, files: DataFrame) -> DataFrame:
    """``ref, fixed, reason`` of each distinct anchor in ``refs(ref)``: its form corrected and its path resolved where that is possible."""
    rows = refs.select("ref").where("ref is not null").distinct().withColumn("form", fix_anchor(F.col("ref")))
    rows = rows.withColumn("path", F.regexp_extract("form", r"^\[?\s*([^#\]]+?)\s*[#\]]", 1))
    paths = resolve_paths(rows.where("path <> ''").select("path"), files)
    rows = rows.join(paths, "path", "left")
    fixed = F.when(F.col("resolved").isNotNull() & (F.col("resolved") != F.col("path")), F.replace("form", F.col("path"), F.col("resolved"))).otherwise(F.col("form"))
    return rows.select("ref", fixed.alias("fixed"), F.coalesce("reason", F.lit("no-path")).alias("reason"))


def repair_totals(repaired: DataFrame) -> DataFrame:
    """``reason, refs, changed`` of a repair."""
    return repaired.groupBy("reason").agg(F.count("*").alias("refs"), F.sum((F.col("ref") != F.col("fixed")).cast("bigint")).alias("changed"))


def repaired_bodies(page: DataFrame, files: DataFrame) -> DataFrame:
    """``slug, ord, body`` of the sections of landed pages that a repair of their anchors changes."""
    bodies = landed(page).select("slug", F.explode("sections").alias("s")).select("slug", F.col("s.ord").alias("ord"), F.col("s.body").alias("body"))
    anchors = bodies.select("slug", "ord", F.explode(F.array_distinct(F.regexp_extract_all("body", F.lit(LOOSE_ANCHOR), F.lit(0)))).alias("ref"))
    fixed = repaired_anchors(anchors.select("ref"), files).where("ref <> fixed").select("ref", "fixed")
    per = anchors.join(fixed, "ref").groupBy("slug", "ord").agg(F.array_sort(F.collect_set(F.struct("ref", "fixed"))).alias("fixes"))
    body = F.aggregate("fixes", F.col("body"), lambda acc, f: F.replace(acc, f["ref"], f["fixed"]))
    return bodies.join(per, ["slug", "ord"]).select("slug", "ord", body.alias("body"))
