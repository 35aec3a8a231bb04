"""Problem 5: records that differ only in formatting.

Columns are dictionary-encoded. Each distinct raw value is canonicalised once into its set of fields, each distinct
field gets an integer, a record becomes a tuple of sorted integers per column, and the tuples are grouped. A raw value
is referred to by its 16-byte digest, so the strings are shuffled once, to be made distinct. A field's integer is its
64-bit hash; the dictionary is searched for integers that two fields share, and those fields get another one, so that
no join is needed to look them up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.plans.shared import stage_table

#: Two or more of these, parted by semicolons, bars, line ends or else commas, make a claim of fields.
FIELD = r"\s*[^:;.,|\n]+:[^:]*"


def _wide(c: Column) -> Column:
    """Full-width forms and ideographic blanks to their ASCII counterparts."""
    full = "".join(chr(x) for x in range(0xFF01, 0xFF5F)) + "　。"
    return F.when(c.rlike("[\uff01-\uff5e\u3000。]"), F.translate(c, full, "".join(chr(x) for x in range(0x21, 0x7F)) + " .")).otherwise(c)


def _words(c: Column) -> Column:
    """Lower-case words, parted by one blank each."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{M}\p{N}]+", " "))


def _glue(words: Column) -> Column:
    """The words without blanks, but for those between two figures: ``1.5`` is not 15."""
    kept = F.regexp_replace(words, r"(?<=\p{N}) (?=\p{N})", "\u0001")
    return F.translate(F.when(words.rlike(r"\p{N} \p{N}"), kept).otherwise(words), " ", "")


def compact(c: Column) -> Column:
    """What is left when white space, letter case and punctuation don't count; accents are part of the words."""
    return _glue(_words(c))


def _parts(c: Column, separators: str) -> tuple[Column, Column]:
    got = F.filter(F.split(c, separators), lambda x: F.trim(x) != "")
    return (F.size(got) > 1) & F.forall(got, lambda x: F.trim(x).rlike(f"^{FIELD}$")), got


def claims(values: DataFrame) -> DataFrame:
    """``digest, bag, fields, run`` of each distinct claim ``v``: its fields if all its parts have the form ``name: value``, else one.

    bag is a hash of its words whatever their order; what shares one is compared in full later.
    """
    rows = values.select(F.unhex(F.md5("v")).alias("digest"), _wide(F.col("v")).alias("w"))
    rows = rows.select("digest", "w", _words(F.col("w")).alias("words"))
    body = F.regexp_replace("w", r"^[\s\-*•\"'“”„«»‘’]+|[\s;.,!|\"'“”„«»‘’]+$", "")
    (strong, by_strong), (weak, by_weak) = _parts(body, r"[;\n|]"), _parts(body, r"[;\n|,]")
    parts = F.when(F.instr("w", ":") == 0, F.lit(None)).when(strong, by_strong).when(weak, by_weak)
    rows = rows.select("digest", "words", F.transform(parts, compact).alias("whole"), _glue(F.col("words")).alias("run"))
    bag = F.xxhash64(F.array_join(F.array_sort(F.split("words", " ")), " "))
    return rows.select("digest", bag.alias("bag"), F.array_sort("whole").alias("whole"), _codes(F.coalesce("whole", F.filter(F.array("run"), lambda x: x != ""))).alias("fields"))


def provenances(values: DataFrame) -> DataFrame:
    """``digest, fields`` of each distinct provenance: its anchors, each from ``raw/`` to the next one.

    A page sign's blank and dot do not count.
    """
    rows = values.select(F.unhex(F.md5("v")).alias("digest"), F.lower(_wide(F.col("v"))).alias("w"))
    parts = F.when(F.locate("raw", F.col("w"), 8) > 0, F.split("w", r"(?=\braw\s*[/\\])")).otherwise(F.array("w"))
    return rows.select("digest", _codes(F.filter(F.transform(parts, compact), lambda x: x != "")).alias("fields"))


def _codes(fields: Column) -> Column:
    """Each field's integer, and a second hash that tells apart the fields that share it."""
    return F.transform(fields, lambda x: F.struct(F.xxhash64(x).alias("id"), F.xxhash64(x, F.lit(1)).alias("other")))


def find_lost_fields(values: DataFrame, raw: DataFrame) -> DataFrame:
    """Give claims whose separators were lost the fields of a claim that still has them.

    Such a claim has the same words, and is made up of the other's fields in some order. Only digests are joined;
    the few claims with the words of another are then looked up in ``raw``. They are written first, so that the
    planner knows their size and leaves ``raw`` unshuffled where they are few.
    """
    plain = lambda c: F.translate(c, "\u0001", "")
    whole = values.where("whole is not null").groupBy("bag", "whole").agg(F.min("fields").alias("whole_fields"))
    lost = stage_table(values.where("whole is null and size(fields) > 0").select("digest", "bag").join(whole, "bag").drop("bag"), "claim-lost")
    text = raw.select(F.unhex(F.md5("v")).alias("digest"), "v").join(lost, "digest")
    text = text.select("digest", "whole", "whole_fields", _wide(F.col("v")).alias("w"))
    text = text.select("digest", "whole_fields", F.transform("whole", plain).alias("pieces"), plain(compact(F.col("w"))).alias("run"))
    # The pieces, the longest first, are struck from the run; nothing else may be left.
    longest_first = F.array_sort("pieces", lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    at = lambda run, x: F.instr(run, x)
    strike = lambda run, x: F.when(at(run, x) == 0, F.concat(run, F.lit("\u0003"))).otherwise(F.concat(F.left(run, at(run, x) - 1), F.lit("\u0002"), F.substr(run, at(run, x) + F.length(x))))
    same = F.aggregate(longest_first, F.col("run"), strike).rlike("^\u0002*$")
    found = stage_table(text.where(same).groupBy("digest").agg(F.min("whole_fields").alias("whole_fields")), "claim-found")
    return values.join(found, "digest", "left").select("digest", F.coalesce("whole_fields", "fields").alias("fields"))


def shared_integers(values: DataFrame) -> list[int]:
    """Integers that two different fields have: at n fields about n*n / 2**65 of them, so few at any size."""
    words = values.select(F.explode("fields").alias("f")).groupBy("f.id").agg(F.min("f.other").alias("a"), F.max("f.other").alias("b"))
    return [r.id for r in words.where("a <> b").collect()]


def _encode(fields: DataFrame, all_fields: DataFrame) -> DataFrame:
    """``(digest, code)`` of each distinct raw value; code is the sorted array of its fields' integers."""
    taken = shared_integers(all_fields)
    one = lambda f: F.when(f["id"].isin(taken), f["other"]).otherwise(f["id"]) if taken else f["id"]
    return fields.select("digest", F.array_sort(F.transform("fields", one)).alias("code"))


def encode_facts(fact: DataFrame) -> DataFrame:
    """``(fact_id, claim_code, provenance_code)``; null or anchorless columns have an empty code."""
    digest = lambda c: F.unhex(F.md5(c))
    raw = fact.select(F.col("claim").alias("v")).where("v is not null")
    values = stage_table(claims(raw.distinct()), "claim-values")
    by_claim = _encode(find_lost_fields(values, raw), values)
    prov = fact.select(F.col("provenance").alias("v")).where("v is not null").distinct()
    prov = stage_table(provenances(prov), "provenance-values")
    by_prov = _encode(prov, prov)
    none = F.array().cast("array<bigint>")
    rows = fact.where("fact_id is not null").select("fact_id", digest("claim").alias("c"), digest("provenance").alias("p"))
    rows = rows.join(by_claim.select(F.col("digest").alias("c"), F.col("code").alias("claim_code")), "c", "left")
    rows = rows.join(by_prov.select(F.col("digest").alias("p"), F.col("code").alias("provenance_code")), "p", "left")
    return rows.select("fact_id", F.coalesce("claim_code", none).alias("claim_code"), F.coalesce("provenance_code", none).alias("provenance_code"))


def _groups(fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = stage_table(encode_facts(fact), "fact-codes")
    keys = ["claim_code", "provenance_code"]
    return rows, rows.groupBy(*keys).agg(F.min("fact_id").alias("first_fact_id"), F.count("*").alias("copies"))


def repeated_facts(fact: DataFrame) -> DataFrame:
    """``first_fact_id, fact_id``: each record that repeats an earlier one but for formatting.

    A null or empty provenance equals only another such one; claims likewise. An empty table gives no row. A group
    of any size is summed before the shuffle; its rows meet only the group's single summary row, and adaptive
    execution splits such a partition.
    """
    rows, groups = _groups(fact)
    more = groups.where("copies > 1").drop("copies")
    return rows.join(more, ["claim_code", "provenance_code"]).where("fact_id > first_fact_id").select("first_fact_id", "fact_id")


def collapsed_facts(fact: DataFrame) -> DataFrame:
    """One record of each group: the row with the smallest id, as written, and its number of copies."""
    _, groups = _groups(fact)
    first = groups.select(F.col("first_fact_id").alias("fact_id"), "copies")
    return fact.join(first, "fact_id").select("fact_id", "claim", "provenance", "copies")
