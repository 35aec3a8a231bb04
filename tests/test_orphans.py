from __future__ import annotations

import random
from datetime import datetime

from pyspark.sql import functions as F

from lectern.operators import orphans

LINK = "link_id long, src_slug string, origin string, bucket string, ord int, target string, recorded_at timestamp, loaded_at timestamp, slug string"
PAGE = "page_row_id long, slug string, page_type string, path string, landed_at timestamp, removed_at timestamp, frontmatter string, title_line string"


def day(y, m, d=1):
    return datetime(y, m, d)


def test_writings_and_times(spark):
    page = spark.createDataFrame(
        [
            (1, "blue-cat", "concept", None, day(2024, 2, 10), day(2024, 4, 5), '{"title": "Blue Cat"}', "# Blue Cat"),
            (2, "blue-cat", "concept", None, day(2024, 1, 10), day(2024, 4, 5), None, None),
            (3, "red-dog", "topic", None, day(2024, 1, 1), None, "{}", "# Red Hound"),
            (4, None, "topic", None, None, None, None, None),
        ],
        PAGE,
    )
    link = spark.createDataFrame(
        [
            (1, "x", "f", "concepts", 0, "BLUE_CAT", day(2024, 1, 5), None, "clash"),
            (2, "x", "f", "concepts", 0, "[[Blue  Cat|see]]", day(2024, 3, 5), None, None),
            (3, "x", "f", "concepts", 0, "blue cat", day(2024, 4, 1), None, None),
            (4, "x", "f", "topics", 0, "red hound", day(2023, 12, 31), None, None),
            (5, "x", "f", "topics", 0, "Red Hound", day(2024, 1, 31), None, None),
            (6, "x", "f", "topics", 0, None, day(2024, 1, 31), None, None),
            (7, "x", "f", "entities", 0, "red-dog", day(2024, 1, 31), None, None),
            (8, "x", "b", None, 0, "nothing", day(2024, 1, 31), None, None),
            (9, "x", "f", "topics", 0, "red-dog", None, None, None),
        ],
        LINK,
    )
    assert sorted(r.link_id for r in orphans.orphan_links(link, page).collect()) == [3, 4, 6, 7]
    assert orphans.orphan_links(link.limit(0), page).count() == 0
    assert orphans.orphan_links(link, page.limit(0)).count() == 7


def test_periods_one_by_one_are_like_all_at_once(spark):
    rng = random.Random(3)
    keys = [f"k{i}" for i in range(5)]
    refs = [(i, "topics", "topic", rng.choice(keys), day(2024, rng.randint(1, 6))) for i in range(60)]
    parents = []
    for k in keys[:4]:
        a = rng.randint(1, 4)
        parents.append(("topic", k, day(2024, a, 3), day(2024, rng.randint(a, 6), 20) if rng.random() < 0.6 else None))
    r = spark.createDataFrame(refs, "link_id int, bucket string, kind string, ref_key string, at timestamp").withColumn("period", F.to_date("at"))
    p = spark.createDataFrame(parents, "kind string, ref_key string, from_ts timestamp, to_ts timestamp")
    whole, end = orphans.advance(r, p)
    cols = ["kind", "ref_key", "period", "new_refs", "parents", "waiting", "resolved", "reopened"]
    state, parts = None, []
    for m in range(1, 8):
        here = lambda c: F.month(c) == m  # noqa: E731, B023
        came = p.where(here("from_ts")).select("kind", "ref_key", "from_ts", F.lit(None).cast("timestamp").alias("to_ts"))
        left = p.where(here("to_ts")).select("kind", "ref_key", F.lit(None).cast("timestamp").alias("from_ts"), "to_ts")
        history, state = orphans.advance(r.where(here("at")), came.unionByName(left), state)
        parts += [tuple(x) for x in history.select(*cols).collect()]
        state = spark.createDataFrame(state.collect(), state.schema)
    assert sorted(parts) == sorted(tuple(x) for x in whole.select(*cols).collect())
    assert {(x.kind, x.ref_key, x.parents, x.refs) for x in state.collect()} == {(x.kind, x.ref_key, x.parents, x.refs) for x in end.collect()}
    brute = {}
    for _, _, _, k, at in refs:
        end_of = day(2024, at.month + 1)
        there = any(x == k and a < end_of and (b is None or b >= end_of) for _, x, a, b in parents)
        brute[k, at.month] = brute.get((k, at.month), 0) + (not there)
    got = {(h.ref_key, h.period.month): h.new_refs * (h.parents <= 0) for h in whole.where("new_refs > 0").collect()}
    assert got == brute
    assert end.agg(F.sum("refs")).first()[0] == 60


def test_stream_state(spark, tmp_path):
    from lectern.streaming.ingest import stream_orphans

    rows = [("a", day(2024, 1, 1), "ref", 1), ("a", day(2024, 1, 2), "parent", 0), ("a", day(2024, 1, 3), "ref", 2), ("a", day(2024, 1, 4), "gone", 0), ("b", day(2024, 1, 1), "ref", 3)]
    spark.createDataFrame(rows, "ref_key string, at timestamp, what string, ref_id long").write.parquet(str(tmp_path / "in"))
    stream = stream_orphans(spark.readStream.schema("ref_key string, at timestamp, what string, ref_id long").parquet(str(tmp_path / "in")))
    q = stream.writeStream.outputMode("update").format("memory").queryName("orphans_out").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.ref_key: (r.parents, r.waiting, r.resolved, r.reopened) for r in spark.table("orphans_out").collect()}
    assert got == {"a": (0, 2, 1, 2), "b": (0, 1, 0, 0)}
