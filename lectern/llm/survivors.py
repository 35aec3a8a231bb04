"""Problem 4: one surviving page of the copies of each slug, each field with its best value.

Every copy comes from a source (the book it names first). Which values are true, and how good the sources are, is
inferred together by expectation-maximisation: a source has a sensitivity (it states a true value) and a specificity
(it states no false one). Values that say nothing and values that are a cut-off beginning of another are known to be
false, and tell of their source. Multi-valued fields keep every value judged true. Of a single-valued field the value of
the highest posterior survives; as later copies overtake earlier ones, a statement of the latest date counts in full and
all earlier ones together as ``OVERTAKEN``, so that an earlier value wins only against a source that is known to be bad.
Of the copies that state the surviving value the latest is named.

All steps are aggregates over (slug, field, value, source) counts; no two values or copies are paired, and only fields
in which values compete are inferred.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.plans.shared import stage_table

FRONT = ("confidence", "source_author", "source_date", "reliability")
SECTIONS = ("Summary", "Key facts", "Inferences", "Uncertainties")
LISTS = ("tags", "sources")

#: Writings of "nothing is known", lower case, without list marks and brackets.
NOTHING = (
    "", "unknown", "not recorded", "none recorded", "none", "null", "nil", "n/a", "na", "tbd", "tba", "todo", "to do", "?", "??", "???", "empty", "missing", "not known", "not available",
    "unspecified", "undefined", "no data", "pending", "xxx", "待补", "未知", "无", "不详", "暂无", "unbekannt", "inconnu", "desconocido", "…", "...",
)
#: What a statement of the worst source adds to the log-odds: no source is taken to say the contrary of what is true.
LEAST = 0.05
#: Evidence of all earlier statements of a single-valued field together, beside 1 for one of the latest date.
OVERTAKEN = 0.05
#: Expectation-maximisation ends when no source's quality changes by more than this, or after so many rounds.
SETTLED, ROUNDS = 0.02, 12
#: Prefixes up to here are looked up, longer ones are found as neighbours in sorted order.
SHORT = 12


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def says_nothing(c: Column) -> Column:
    bare = F.regexp_replace(F.lower(c), r"(?U)^[\s\-–—*•_(\[{<]+|[\s\-–—*•_.!)\]}>]+$", "")
    return bare.isin(*NOTHING)


def updated_on(c: Column) -> Column:
    """The date in any of the usual writings, or null."""
    text = _trim(c)
    day = F.regexp_replace(F.regexp_replace(text, r"[/.年月]", "-"), r"日|[T ]\d{1,2}:.*$", "")
    tries = [F.try_to_timestamp(day, F.lit("y-M-d")), F.try_to_timestamp(day, F.lit("d-M-y"))]
    words = F.regexp_replace(F.regexp_replace(text, r"(?<=\d)(?:st|nd|rd|th)\b|[.,]", ""), r"(?U)\s+", " ")
    tries += [F.try_to_timestamp(words, F.lit(f)) for f in ("d MMMM y", "d MMM y", "MMMM d y", "MMM d y")]
    iso = day.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    turned = day.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$")
    return F.when(iso, tries[0]).when(turned, tries[1]).otherwise(F.coalesce(*tries[2:])).cast("date")


_FRONT_MATTER = ", ".join(f"{k} string" for k in (*FRONT, "updated")) + ", " + ", ".join(f"{k} array<string>" for k in LISTS)


def _parsed(page: DataFrame, *columns: Column | str) -> DataFrame:
    """The copies with a slug, their front matter parsed once to ``fm``, and their source."""
    rows = page.where("slug is not null").select("slug", *columns, F.from_json("frontmatter", _FRONT_MATTER).alias("fm"))
    return rows.withColumn("source", F.coalesce(F.get("fm.sources", F.lit(0)), F.lit("")))


def claims(page: DataFrame) -> DataFrame:
    """A row per copy and single-valued field that it states: ``slug, field_name, page_row_id, value, updated, landed_at, source``.

    Of sections with one header the last counts.
    """
    section = lambda h: F.try_element_at(F.filter("sections", lambda s: s["header"] == h), F.lit(-1))["body"]
    rows = _parsed(page, "page_row_id", "landed_at", F.array(*[section(h) for h in SECTIONS]).alias("bodies"))
    fields = F.array(
        *[F.struct(F.lit(k).alias("field_name"), _trim(F.col(f"fm.{k}")).alias("value")) for k in FRONT],
        *[F.struct(F.lit(h).alias("field_name"), _trim(F.col("bodies")[i]).alias("value")) for i, h in enumerate(SECTIONS)],
    )
    rows = rows.select("slug", "page_row_id", "landed_at", updated_on(F.col("fm.updated")).alias("updated"), "source", fields.alias("fields"))
    rows = rows.select("slug", "page_row_id", "landed_at", "updated", "source", F.explode(F.filter("fields", lambda f: f["value"] != "")).alias("f"))
    return rows.select("slug", F.col("f.field_name").alias("field_name"), "page_row_id", F.col("f.value").alias("value"), "updated", "landed_at", "source")


def list_claims(page: DataFrame) -> DataFrame:
    """``slug, field_name, value, source`` of each value of the multi-valued fields, once per copy."""
    kinds = F.array(*[F.struct(F.lit(k).alias("field_name"), F.array_distinct(F.col(f"fm.{k}")).alias("all")) for k in LISTS])
    rows = _parsed(page).select("slug", "source", F.explode(kinds).alias("f")).select("slug", "source", "f.field_name", F.explode("f.all").alias("value"))
    return rows.where("value is not null and value <> ''").select("slug", "field_name", "value", "source")


def cut_off(values: DataFrame) -> DataFrame:
    """Of distinct ``slug, field_name, value``: those that another value of the field begins with, a closing ellipsis aside."""
    stem = F.regexp_replace("value", r"\s*(?:…|\.\.\.|\[(?:…|\.\.\.)\])$", "")
    rows = values.select("slug", "field_name", "value", F.when(stem != "", stem).otherwise(F.col("value")).alias("stem"))
    # A stem and what it begins share their first characters, so long ones are next to each other in sorted order.
    head = F.substring("stem", 1, SHORT)
    long = rows.where(F.length("stem") >= SHORT).withColumn("head", head)
    order = Window.partitionBy("slug", "field_name", "head").orderBy("stem", F.desc("value"))
    after = F.lead("stem").over(order)
    long = long.select("slug", "field_name", "value", "stem", after.alias("after")).where(
        F.col("after").startswith(F.col("stem")) & ((F.col("after") != F.col("stem")) | (F.col("value") != F.col("stem")))
    )
    short = rows.where(F.length("stem") < SHORT)
    # A stem of just the prefixes' length is found among the long ones, or is equal to what it begins.
    heads = rows.select("slug", "field_name", head.alias("head")).distinct()
    starts = heads.select("slug", "field_name", F.explode(F.expr(f"filter(transform(sequence(1, length(head)), n -> left(head, n)), x -> length(x) < {SHORT} and x <> head)")).alias("stem"))
    starts = starts.where("stem is not null").distinct()
    short = short.join(starts, ["slug", "field_name", "stem"], "left_semi")
    return long.select("slug", "field_name", "value").unionByName(short.select("slug", "field_name", "value")).distinct()


def infer(counts: DataFrame, copies: DataFrame, rounds: int = ROUNDS, settled: float = SETTLED) -> DataFrame:
    """``slug, field_name, value, odds, truth``: the log-odds and posterior of each value.

    counts has ``slug, field_name, value, source, n, evidence, possible``: how many copies of a source state the value,
    what these statements weigh, and whether it may be true; copies has ``slug, field_name, source, n``: the copies that
    could have stated it. The log-odds are linear in the counts, so a copy that leaves a value out needs no row.
    """
    group, keys = ["slug", "field_name"], ["slug", "field_name", "value"]
    keep = lambda c: F.least(F.greatest(c, F.lit(0.01)), F.lit(0.99))

    def qualities(truth: DataFrame) -> DataFrame:
        """How often each source could have stated true and false values, and did."""
        field = truth.groupBy(*group).agg(F.sum("truth").alias("t"), F.sum(1 - F.col("truth")).alias("f"))
        zero = F.lit(0.0)
        could = copies.join(field, group).select("source", (F.col("n") * F.col("t")).alias("tc"), (F.col("n") * F.col("f")).alias("fc"), zero.alias("ts"), zero.alias("fs"))
        did = counts.join(truth.select(*keys, "truth"), keys).select("source", zero.alias("tc"), zero.alias("fc"), (F.col("n") * F.col("truth")).alias("ts"), (F.col("n") * (1 - F.col("truth"))).alias("fs"))
        sums = could.unionByName(did).groupBy("source").agg(*[F.sum(c).alias(c) for c in ("tc", "fc", "ts", "fs")])
        a, b = (F.col("ts") + 2) / (F.col("tc") + 4), 1 - (F.col("fs") + 1) / (F.col("fc") + 4)
        return stage_table(sums.select("source", keep(a).alias("a"), keep(b).alias("b")), "quality")

    def posterior(quality: DataFrame) -> DataFrame:
        silent, stated = F.log((1 - F.col("a")) / F.col("b")), F.log(F.col("a") / (1 - F.col("b")))
        base = copies.join(quality, "source").groupBy(*group).agg(F.sum(F.col("n") * silent).alias("base"))
        plus = counts.join(quality, "source").groupBy(*keys).agg(F.sum(F.col("evidence") * F.greatest(stated - silent, F.lit(LEAST))).alias("plus"), F.min("possible").alias("possible"))
        odds = plus.join(base, group, "left").withColumn("odds", F.coalesce("base", F.lit(0.0)) + F.col("plus"))
        return odds.select(*keys, "odds", F.when(F.col("possible") == 0, 0.0).otherwise(1 / (1 + F.exp(-F.col("odds")))).alias("truth"))

    size = counts.groupBy(*keys).agg(F.sum("evidence").alias("n"), F.min("possible").alias("possible"))
    total = copies.groupBy(*group).agg(F.sum("n").alias("copies"))
    share = F.least((F.col("n") + 0.5) / (F.coalesce("copies", F.lit(0)) + 1.0), F.lit(1.0))
    truth = size.join(total, group, "left").select(*keys, F.when(F.col("possible") == 0, 0.0).otherwise(share).alias("truth"))
    quality = qualities(truth)
    for _ in range(rounds - 1):
        new = qualities(posterior(quality))
        moved = new.join(quality.select("source", F.col("a").alias("a0"), F.col("b").alias("b0")), "source")
        change = moved.agg(F.max(F.greatest(F.abs(F.col("a") - F.col("a0")), F.abs(F.col("b") - F.col("b0"))))).first()[0]
        quality = new
        if change is None or change <= settled:
            break
    return posterior(quality)


def _key(value: Column) -> Column:
    """A value that stands for itself if it is short, else its digest: texts are not shuffled where equality is enough."""
    return F.when(F.length(value) <= 32, value).otherwise(F.concat(F.lit("#"), F.md5(value)))


def _single(page: DataFrame, differing: bool) -> DataFrame:
    """``slug, field_name, page_row_id, value`` of the surviving values, of fields in which copies differ or of all."""
    group, keys = ["slug", "field_name"], ["slug", "field_name", "key"]
    rows = claims(page).withColumn("key", _key(F.col("value"))).withColumn("nothing", says_nothing(F.col("value")))
    rows = stage_table(rows, "page-claims")
    copies = page.where("slug is not null").groupBy("slug").agg(F.count("*").alias("copies"))
    told = rows.groupBy(*group).agg(F.min("key").alias("a"), F.max("key").alias("b"), F.count("*").alias("n"), F.max(F.when(~F.col("nothing"), F.col("key"))).alias("some"))
    told = told.join(copies, "slug").where("some is not null")
    if differing:
        told = told.where("a <> b or n < copies")
    # Only fields with several values need to be judged, and only they can hold a beginning of another.
    told = stage_table(told.select(*group, (F.col("a") != F.col("b")).alias("several")), "page-fields")
    bare = rows.drop("value").join(told, group)
    texts = rows.where("not nothing").select(*group, "value").join(told.where("several"), group, "left_semi").distinct()
    cut = cut_off(texts).select(*group, _key(F.col("value")).alias("key"), F.lit(True).alias("cut"))
    bare = bare.join(stage_table(cut, "page-cut"), keys, "left")
    bare = stage_table(bare.withColumn("possible", F.when(F.col("nothing") | F.col("cut"), 0).otherwise(1)).drop("nothing", "cut"), "page-statements")
    judged = bare.where("several")
    latest = judged.where("possible = 1").groupBy(*group).agg(F.max("updated").alias("latest"), F.count("*").alias("open"))
    judged = judged.join(latest, group)
    now = F.col("updated").eqNullSafe(F.col("latest"))
    old = (F.col("possible") == 1) & ~now
    counts = judged.groupBy(*group, F.col("key").alias("value"), "source").agg(
        F.sum(F.when(old, 0).otherwise(1)).alias("n"), F.sum(F.when(old, OVERTAKEN / F.col("open")).otherwise(1.0)).alias("evidence"), F.min("possible").alias("possible")
    )
    could = judged.where(~old).groupBy(*group, "source").agg(F.count("*").alias("n"))
    truth = infer(stage_table(counts, "page-counts"), stage_table(could, "page-could")).withColumnRenamed("value", "key")
    open_ = bare.where("possible = 1").join(truth.select(*keys, F.round("odds", 6).alias("odds")), keys, "left")
    best = F.max(F.struct("odds", "updated", "landed_at", (-F.col("page_row_id")).alias("first")))
    won = open_.groupBy(*group).agg(best.alias("best")).select(*group, (-F.col("best.first")).alias("page_row_id"))
    return won if differing else won.join(rows.select(*group, "page_row_id", "value"), [*group, "page_row_id"])


def surviving_values(page: DataFrame) -> DataFrame:
    """``slug, field_name, page_row_id`` of the surviving value of each field in which a slug's copies differ.

    Absent, null and empty values count as one value and never survive; a field without any other value has no row.
    The value of the highest posterior survives. Its copy is the latest that states it; copies without a readable date
    come last, copies of one date are told apart by the later landing, then by the smaller id.
    """
    return _single(page, differing=True)


def surviving_pages(page: DataFrame) -> DataFrame:
    """One page per slug: its single-valued fields, and as lists the tags and sources judged true (the likeliest if none is)."""
    single = _single(page, differing=False).groupBy("slug").pivot("field_name", [*FRONT, *SECTIONS]).agg(F.min("value"))
    for c in SECTIONS:
        single = single.withColumnRenamed(c, c.lower().replace(" ", "_"))
    group, keys = ["slug", "field_name"], ["slug", "field_name", "value"]
    counts = list_claims(page).groupBy(*keys, "source").agg(F.count("*").alias("n"))
    counts = stage_table(counts.select(*keys, "source", "n", F.col("n").cast("double").alias("evidence"), F.lit(1).alias("possible")), "page-lists")
    fields = counts.select(*group).distinct()
    could = _parsed(page).groupBy("slug", "source").agg(F.count("*").alias("n")).join(fields, "slug").select(*group, "source", "n")
    lists = infer(counts, stage_table(could, "page-list-copies")).select(*keys, F.round("truth", 6).alias("truth"))
    top = lists.groupBy(*group).agg(F.max("truth").alias("top"))
    kept = lists.join(top, group).where("truth >= 0.5 or truth = top")
    kept = kept.groupBy("slug").pivot("field_name", list(LISTS)).agg(F.array_join(F.array_sort(F.collect_list("value")), "; "))
    return page.where("slug is not null").select("slug").distinct().join(single, "slug", "left").join(kept, "slug", "left")
