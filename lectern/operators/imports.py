"""Finding and importing books."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import book_stem, clean_file_name, usable_chars

DEFAULT = "uncategorized"


def discover(files: DataFrame, root: str = "raw/books", discipline: str | None = None, names: dict[str, str] | None = None) -> DataFrame:
    """``stem, path, discipline`` of the PDF and EPUB files under ``root`` in ``files(path)``.

    The discipline is the first folder; stems that several files share get their discipline, then a number from 3 on,
    in order of the path. ``names`` has hand-made stems by file name. Only the files of one stem are ordered together.
    """
    prefix = root.rstrip("/") + "/"
    rows = files.where(F.col("path").startswith(prefix) & F.lower("path").rlike(r"\.(pdf|epub)$")).select("path").distinct()
    folder = F.regexp_extract(F.substring("path", len(prefix) + 1, 1_000_000), "^([^/]+)/", 1)
    rows = rows.withColumn("discipline", F.when(folder == "", DEFAULT).otherwise(folder))
    if discipline is not None:
        rows = rows.where(F.col("discipline") == discipline)
    base = book_stem(F.col("path"))
    if names:
        base = F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.regexp_replace("path", "^.*/", "")], base)
    rows = rows.withColumn("base", base)
    n = F.row_number().over(Window.partitionBy("base").orderBy("path"))
    again = F.row_number().over(Window.partitionBy("base", "discipline").orderBy("path"))
    rows = rows.withColumn("n", n).withColumn("again", again)
    # The first keeps the stem; the first of each other discipline takes its name; the others are numbered.
    own = (F.col("again") == 1) | ((F.col("again") == 2) & (F.min("n").over(Window.partitionBy("base", "discipline")) == 1))
    number = F.sum(F.when(own, 0).otherwise(1)).over(Window.partitionBy("base").orderBy("path").rowsBetween(Window.unboundedPreceding, 0)) + 2
    stem = F.when(F.col("n") == 1, F.col("base")).when(own, F.concat_ws("-", "base", "discipline")).otherwise(F.concat_ws("-", "base", number.cast("string")))
    return rows.select(stem.alias("stem"), "path", "discipline")


def conversion_state(raw: DataFrame, done: DataFrame, least: int = 500) -> DataFrame:
    """``path, sha256, state``: files of ``raw(path, sha256, text)`` that are ``cached`` by their digest, ``converted`` or, with too few characters, ``needs_ocr``."""
    known = done.select("sha256").where("sha256 is not null").distinct().withColumn("cached", F.lit(True))
    rows = raw.join(known, "sha256", "left")
    few = F.coalesce(usable_chars(F.col("text")), F.lit(0)) < least
    return rows.select("path", "sha256", F.when(F.col("cached"), "cached").when(few, "needs_ocr").otherwise("converted").alias("state"))


def layout(files: DataFrame) -> DataFrame:
    """``layout`` of a folder of books in ``files(path)``, relative paths: ``subdir`` if all lie one folder deep, ``flat`` if none does, else ``mixed``; no row without books."""
    depth = F.size(F.split("path", "/")) - 1
    books = files.where(F.lower("path").rlike(r"\.(pdf|epub)$")).agg(F.count("*").alias("n"), F.min(depth).alias("lo"), F.max(depth).alias("hi")).where("n > 0")
    return books.select(F.when((F.col("lo") == 1) & (F.col("hi") == 1), "subdir").when(F.col("hi") == 0, "flat").otherwise("mixed").alias("layout"))


def import_plan(files: DataFrame, target: DataFrame, default: str = DEFAULT) -> DataFrame:
    """``path, discipline, name, action``: where each of ``files(path, sha256)`` goes under readable names.

    Content that the target ``(discipline, name, sha256)`` has is skipped; a name that is taken gets a number. Content
    that comes twice is imported once.
    """
    folder = F.regexp_extract("path", "^([^/]+)/", 1)
    rows = files.select("path", "sha256", F.when(folder == "", default).otherwise(F.regexp_replace(F.lower(folder), "[^a-z0-9一-鿿]+", "-")).alias("discipline"), clean_file_name(F.regexp_replace("path", "^.*/", "")).alias("name"))
    there = target.select("discipline", "sha256").distinct().withColumn("there", F.lit(True))
    rows = rows.join(there, ["discipline", "sha256"], "left")
    twice = F.row_number().over(Window.partitionBy("discipline", "sha256").orderBy("path"))
    rows = rows.withColumn("skip", F.coalesce("there", F.lit(False)) | (twice > 1))
    taken = target.groupBy("discipline", "name").agg(F.count("*").alias("taken"))
    rows = rows.join(taken, ["discipline", "name"], "left")
    at = F.sum(F.when(F.col("skip"), 0).otherwise(1)).over(Window.partitionBy("discipline", "name").orderBy("path").rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("taken", F.lit(0))
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    numbered = F.when(at > 1, F.concat(stem, F.lit("-"), at.cast("string"), F.regexp_extract("name", r"(\.[^.]*)$", 1))).otherwise(F.col("name"))
    return rows.select("path", "discipline", F.when(F.col("skip"), F.col("name")).otherwise(numbered).alias("name"), F.when(F.col("skip"), "skip").otherwise("copy").alias("action"))
