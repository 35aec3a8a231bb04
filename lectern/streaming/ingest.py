"""Streaming forms: files as they arrive, and pending orphans as events arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources.files import converted

ORPHAN_EVENTS = "ref_key string, at timestamp, what string, ref_id bigint"


def stream_books(spark: SparkSession, root: str) -> DataFrame:
    """Books under ``root`` converted as they arrive; the query's checkpoint is the record of what was done."""
    rows = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("recursiveFileLookup", "true").load(root)
    return converted(rows.select("path", F.sha2("content", 256).alias("sha256"), "content"))


def stream_orphans(events: DataFrame) -> DataFrame:
    """``ref_key, parents, waiting, resolved, reopened`` of each key that a micro-batch touches.

    Events are ``ref`` (a new reference), ``parent`` (one arrives) and ``gone`` (one is deleted). The state of a key is
    two numbers, however many references wait for it.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        parents, refs = state.get if state.exists else (0, 0)
        resolved = reopened = 0
        rows = pd.concat(list(frames))
        for what in rows.sort_values(["at", "ref_id"], na_position="last")["what"]:
            if what == "ref":
                refs += 1
            elif what == "parent":
                parents += 1
                resolved += refs if parents == 1 else 0
            elif parents:
                parents -= 1
                reopened += refs if parents == 0 else 0
        state.update((parents, refs))
        yield pd.DataFrame({"ref_key": [key[0]], "parents": [parents], "waiting": [0 if parents else refs], "resolved": [resolved], "reopened": [reopened]})

    return events.groupBy("ref_key").applyInPandasWithState(
        step, "ref_key string, parents bigint, waiting bigint, resolved bigint, reopened bigint", "parents bigint, refs bigint", "update", "NoTimeout"
    )
