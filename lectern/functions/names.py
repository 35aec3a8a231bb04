"""Column expressions for slugs, titles and link targets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(c: Column) -> Column:
    """Outer white space off, inner white space to one blank, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"^ | $", ""))


def kebab(c: Column) -> Column:
    """Lower case, blanks and underscores to hyphens, everything but a-z, 0-9 and hyphens dropped."""
    return F.regexp_replace(F.regexp_replace(squeeze(c), r"[\s_]+", "-"), r"[^a-z0-9-]", "")


def name_key(c: Column) -> Column:
    """One key for all writings of a slug or title: letters and digits of any script, joined by hyphens."""
    words = F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}\p{N}]+", "-")
    return F.regexp_replace(words, r"^-+|-+$", "")


def link_target(c: Column) -> Column:
    """What a link names: without the double brackets, a label after ``|`` and a part after ``#``."""
    inner = F.regexp_replace(F.regexp_replace(c, r"(?U)^\s*\[\[|\]\]\s*$", ""), r"[|#].*$", "")
    return F.when(F.trim(inner) != "", inner)
