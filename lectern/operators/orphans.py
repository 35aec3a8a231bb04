"""References to records that do not exist.

The operator keeps one state row per parent key and moves it forward by deltas: references that arrive, parents that
arrive and parents that are deleted. A key's references wait while no parent of that key is there, are resolved when
one arrives and wait again when the last one is deleted. Deltas are summed per key and period before they are
shuffled, so a key that holds a third of all references costs one row per period and map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.names import link_target, name_key
from lectern.plans.shared import stage_table

#: Bucket of a link and the type of the pages it may name.
BUCKETS = {"concepts": "concept", "entities": "entity", "topics": "topic"}


def page_parents(page: DataFrame) -> DataFrame:
    """``(kind, ref_key, from_ts, to_ts)``: each page under its slug and its titles, from its earliest landing to its removal.

    Rows without slug, type or landing are no page. Copies of a slug count as one page.
    """
    titles = F.array(
        "slug",
        F.regexp_replace("title_line", r"^\s*#+\s*", ""),
        F.get_json_object("frontmatter", "$.title"),
    )
    rows = page.where("slug is not null and page_type is not null and landed_at is not null").select(
        "slug", F.col("page_type").alias("kind"), "landed_at", "removed_at", F.explode(F.array_distinct(titles)).alias("name")
    )
    rows = rows.select("slug", "kind", "landed_at", "removed_at", name_key(F.col("name")).alias("ref_key"))
    span = rows.groupBy("kind", "slug").agg(
        F.min("landed_at").alias("from_ts"), F.max("removed_at").alias("to_ts"), F.collect_set("ref_key").alias("keys")
    )
    return span.select("kind", F.explode("keys").alias("ref_key"), "from_ts", "to_ts").where("ref_key <> ''")


def link_refs(link: DataFrame) -> DataFrame:
    """``(link_id, kind, ref_key, period)`` of the links in the checked buckets; an empty target has the key ''.

    The period is the month of ``recorded_at``; links without one have no period and are left out.
    """
    kind = F.create_map(*[F.lit(x) for kv in BUCKETS.items() for x in kv])[F.col("bucket")]
    return link.where(F.col("bucket").isin(*BUCKETS) & F.col("recorded_at").isNotNull()).select(
        "link_id",
        "bucket",
        kind.alias("kind"),
        F.coalesce(name_key(link_target(F.col("target"))), F.lit("")).alias("ref_key"),
        F.trunc("recorded_at", "month").alias("period"),
    )


def _deltas(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """One row per key and period: parents that arrived less parents that left by its end, and new references."""
    month = lambda c: F.trunc(c, "month")
    zero = F.lit(0).cast("bigint")
    came = parents.where("from_ts is not null").select("kind", "ref_key", month("from_ts").alias("period"), F.lit(1).cast("bigint").alias("d"), zero.alias("n"))
    left = parents.where("to_ts is not null").select(
        "kind", "ref_key", month(F.greatest("to_ts", "from_ts")).alias("period"), F.lit(-1).cast("bigint").alias("d"), zero.alias("n")
    )
    new = refs.select("kind", "ref_key", "period", zero.alias("d"), F.lit(1).cast("bigint").alias("n"))
    return came.unionByName(left).unionByName(new).groupBy("kind", "ref_key", "period").agg(F.sum("d").alias("d"), F.sum("n").alias("n"))


def advance(refs: DataFrame, parents: DataFrame, state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Move the state forward by new references and parent spans; returns (history, new state).

    A span without ``from_ts`` is the deletion of a parent that came in an earlier call, one without ``to_ts`` an arrival.

    history has a row per key and period in which something happened: ``new_refs``, ``parents`` there at the end of the
    period, ``waiting`` references, and how many were ``resolved`` or ``reopened`` in it. The state carries over between
    calls: feeding the periods one by one, in order, gives the history of feeding them all at once.
    """
    rows = _deltas(refs, parents)
    if state is not None:
        old = state.select("kind", "ref_key", F.lit(None).cast("date").alias("period"), F.col("parents").alias("d"), F.col("refs").alias("n"))
        rows = rows.unionByName(old)
    so_far = Window.partitionBy("kind", "ref_key").orderBy(F.col("period").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    order = Window.partitionBy("kind", "ref_key").orderBy(F.col("period").asc_nulls_first())
    rows = rows.select("*", F.sum("d").over(so_far).alias("parents"), F.sum("n").over(so_far).alias("refs"))
    before = F.coalesce(F.lag("parents").over(order), F.lit(0))
    held = F.coalesce(F.lag("refs").over(order), F.lit(0))
    rows = rows.select("*", before.alias("was"), held.alias("held"))
    history = rows.where("period is not null").select(
        "kind", "ref_key", "period",
        F.col("n").alias("new_refs"),
        "parents",
        F.when(F.col("parents") > 0, 0).otherwise(F.col("refs")).cast("bigint").alias("waiting"),
        F.when((F.col("was") <= 0) & (F.col("parents") > 0), F.col("held")).otherwise(0).cast("bigint").alias("resolved"),
        F.when((F.col("was") > 0) & (F.col("parents") <= 0), F.col("held")).otherwise(0).cast("bigint").alias("reopened"),
    )
    new = rows.groupBy("kind", "ref_key").agg(F.sum("d").alias("parents"), F.sum("n").alias("refs"))
    return history, new


def advance_by_year(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """The history, made year by year: each call of ``advance`` gets one year's arrivals, deletions and references and
    the written state of the one before, as a job does that runs once a period."""
    gone = F.greatest("to_ts", "from_ts")
    seen = refs.select(F.year("period").alias("y")).unionByName(parents.select(F.year("from_ts").alias("y"))).unionByName(parents.select(F.year(gone).alias("y")))
    state, out = None, None
    for (year,) in seen.where("y is not null").distinct().orderBy("y").collect():
        came = parents.where(F.year("from_ts") == year).select("kind", "ref_key", "from_ts", F.when(F.year(gone) == year, F.col("to_ts")).alias("to_ts"))
        left = parents.where((F.year(gone) == year) & (F.year("from_ts") != year)).select("kind", "ref_key", F.lit(None).cast(parents.schema["from_ts"].dataType).alias("from_ts"), gone.alias("to_ts"))
        history, state = advance(refs.where(F.year("period") == year), came.unionByName(left), state)
        history, state = stage_table(history, "orphan-history"), stage_table(state, "orphan-state")
        out = history if out is None else out.unionByName(history)
    return advance(refs, parents)[0] if out is None else out


def orphan_links(link: DataFrame, page: DataFrame) -> DataFrame:
    """``link_id, bucket, period`` of the links that name no page at the end of their own period.

    Null or empty targets name nothing, so they are orphans; repeated rows are reported each. Without pages every
    link is an orphan, without links the result is empty. Only keys that are waiting reach the join, one row per key
    and period, so a hot key is split by the adaptive skew join and never meets itself.
    """
    refs = link_refs(link)
    history, _ = advance(refs, page_parents(page))
    waiting = history.where("new_refs > 0 and parents <= 0").select("kind", "ref_key", "period")
    return refs.join(waiting, ["kind", "ref_key", "period"]).select("link_id", "bucket", "period")


def orphan_report(link: DataFrame, page: DataFrame, by_year: bool = False) -> DataFrame:
    """Snapshot per bucket and month: links recorded in it, and how many of them name no page at its end.

    With ``by_year`` the state is carried from year to year; the result is the same.
    """
    refs, parents = link_refs(link), page_parents(page)
    history = advance_by_year(refs, parents) if by_year else advance(refs, parents)[0]
    bucket = F.create_map(*[F.lit(x) for k, v in BUCKETS.items() for x in (v, k)])[F.col("kind")]
    return (
        history.where("new_refs > 0")
        .groupBy(bucket.alias("bucket"), "period")
        .agg(F.sum("new_refs").alias("links"), F.sum(F.when(F.col("parents") <= 0, F.col("new_refs")).otherwise(0)).alias("orphans"))
        .select("bucket", F.date_format("period", "yyyy-MM").alias("month"), "links", "orphans")
    )
