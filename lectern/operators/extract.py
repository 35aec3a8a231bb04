"""Extraction of page candidates from chunks, by an extractor that can be replaced."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import normal_provenance, slug_id

#: (text, tag, anchor) of a chunk to dicts with page_type, title, summary and facts (claim, provenance).
Extractor = Callable[[str, str, str], list[dict]]


def rule_extractor(text: str, tag: str, anchor: str) -> list[dict]:
    """A concept page for each ``the <Name> <noun>`` that a chunk mentions, with the sentences that do as its facts."""
    found: dict[str, list[str]] = {}
    for sentence in re.split(r"(?<=[.!?。！？])\s*", text):
        for m in re.finditer(r"\b[Tt]he ([A-Z][a-z]{2,}) ([a-z]{4,})\b", sentence):
            found.setdefault(f"{m.group(1)} {m.group(2)}", []).append(re.sub(r"\s+", " ", sentence).strip())
    return [{"page_type": "concept", "title": t, "summary": s[0], "facts": [(x.rstrip(" .;,"), anchor) for x in dict.fromkeys(s)]} for t, s in found.items()]


def anchor_of(path: str, start_page: int | None, end_page: int | None, start_line: int, end_line: int) -> str:
    """The anchor of a chunk: its pages, or its lines where it has none."""
    if start_page is not None:
        return f"[{path}#p{start_page}]" if end_page in (None, start_page) else f"[{path}#p{start_page}-p{end_page}]"
    return f"[{path}#L{start_line}-L{end_line}]"


def extract(chunk: DataFrame, extractor: Extractor = rule_extractor) -> DataFrame:
    """``stem, chunk_index, ord, page_type, id, title, summary, claim, provenance`` of the candidates' facts.

    ``chunk`` has ``stem, source_path, chunk_index, start_line, end_line, start_page, end_page, text``. A chunk that the
    extractor fails on gives one row with its error in ``summary`` and the page type ``failed``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["stem", "source_path", "chunk_index", "ord", "page_type", "title", "summary", "claim", "provenance"]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), *[pa.string()] * 5]
        for b in batches:
            rows: list[tuple] = []
            for r in b.to_pylist():
                anchor = anchor_of(r["source_path"] or "", r["start_page"], r["end_page"], r["start_line"] or 0, r["end_line"] or 0)
                try:
                    pages = extractor(r["text"] or "", "", anchor)
                except Exception as e:  # noqa: BLE001 - a failed chunk must not fail the job
                    rows.append((r["stem"], r["source_path"], r["chunk_index"], 0, "failed", None, f"{type(e).__name__}: {e}", None, None))
                    continue
                for i, p in enumerate(pages):
                    rows += [(r["stem"], r["source_path"], r["chunk_index"], i, p["page_type"], p["title"], p["summary"], c, a) for c, a in p["facts"]]
            cols = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    columns = ["stem", "source_path", F.col("chunk_index").cast("int"), *[F.col(c).cast("int") for c in ("start_line", "end_line", "start_page", "end_page")], "text"]
    rows = chunk.select(*columns).mapInArrow(run, "stem string, source_path string, chunk_index int, ord int, page_type string, title string, summary string, claim string, provenance string")
    return rows.withColumn("id", slug_id(F.col("title"))).withColumn("provenance", normal_provenance(F.col("provenance"), F.col("source_path"))).drop("source_path")
