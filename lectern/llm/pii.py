"""Problem 10: personal data in free text, found by a character-level BiLSTM-CRF and replaced by typed placeholders.

Overlapping windows lie over the whole of every text and are read by two networks of this kind, trained on the same
labels: a small one (the gate) reads everything and tells where personal data may be, with a threshold at which it
hardly misses any; the large one reads the surroundings of these places and tags them. Its decoded spans are reconciled
over the text (of two windows' spans the one that lies farther from its window's borders stands), and a last check
vetoes what a kind can't do without. No list, pattern or rule finds, moves or widens a span.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lectern.llm.pii_model import TAGS, Gate, Reader, Vocabulary, load

#: Trained by ``python -m lectern.llm.pii_train``; about 50 kB.
WEIGHTS = os.path.join(os.path.dirname(__file__), "pii_weights.npz")
#: Characters of a window, and of the overlap of two.
WINDOW, OVERLAP = 1000, 80
#: Characters of texts that are taken at once, about, and of those that the gate and the large network read side by side.
PART, GATE_BATCH, BATCH = 3_000_000, 2_400_000, 200_000
#: Log-odds from which the gate calls the large network, and the characters around such a place that this reads.
THRESHOLD, AROUND = 0.5, 48


def windows(n: int) -> list[tuple[int, int]]:
    """Windows over all of ``n`` characters, of nearly equal length and with an overlap of ``OVERLAP`` or more."""
    if n <= WINDOW:
        return [(0, n)] if n else []
    count = -(-(n - OVERLAP) // (WINDOW - OVERLAP))
    size = -(-(n + (count - 1) * OVERLAP) // count)
    step = (n - size) / (count - 1)
    return [(a, a + size) for a in (round(i * step) for i in range(count))]


def batches_of(sizes: list[int], most: int) -> Iterator[list[int]]:
    """Indices in parts of similar size, each of about ``most`` when padded."""
    order = sorted(range(len(sizes)), key=sizes.__getitem__)
    part: list[int] = []
    for i in order:
        if part and sizes[i] * (len(part) + 1) > most:
            yield part
            part = []
        part.append(i)
    if part:
        yield part


def spans_of(path) -> list[tuple[int, int, str]]:
    """(start, end, kind) of a path of tags."""
    spans, start = [], -1
    for j in (*np.flatnonzero(path).tolist(), len(path)):
        name = TAGS[path[j]] if j < len(path) else "O"
        if start >= 0 and (name[0] != "I" or j > last + 1):
            spans.append((start, last + 1, TAGS[path[start]][2:]))
            start = -1
        if name[0] == "B":
            start = j
        last = j
    return spans


class Finder:
    """Finds spans in texts with trained weights."""

    def __init__(self, vocabulary: Vocabulary, weights: dict[str, np.ndarray], gate: dict[str, np.ndarray] | None = None):
        self.vocabulary, self.reader, self.gate = vocabulary, Reader(weights), Gate(gate) if gate else None

    def tagged(self, rows: list[np.ndarray]) -> list[list[tuple[int, int, str]]]:
        """Spans of encoded windows, as the large network sees them."""
        out: list[list[tuple[int, int, str]]] = [[] for _ in rows]
        for part in batches_of([len(r) for r in rows], BATCH):
            for i, path in zip(part, self.reader.paths([rows[i] for i in part])):
                out[i] = [] if path is None else spans_of(path)
        return out

    def decode(self, texts: list[str]) -> list[list[tuple[int, int, str]]]:
        return self.tagged([self.vocabulary.encode(t) for t in texts])

    def places(self, codes: list[np.ndarray]) -> list[list[tuple[int, int]]]:
        """The stretches of encoded texts that the large network is to read: all where there is no gate."""
        if self.gate is None:
            return [[(0, len(c))] if len(c) else [] for c in codes]
        where = [(d, a, b) for d, c in enumerate(codes) for a, b in windows(len(c))]
        hits: list[list[np.ndarray]] = [[] for _ in codes]
        for part in batches_of([b - a for _, a, b in where], GATE_BATCH):
            for i, at in zip(part, self.gate.above([codes[where[i][0]][where[i][1] : where[i][2]] for i in part], THRESHOLD)):
                if len(at):
                    hits[where[i][0]].append(at + where[i][1])
        out = []
        for code, found in zip(codes, hits):
            stretches: list[tuple[int, int]] = []
            if found:
                at = np.sort(np.concatenate(found))
                edges = [0, *(np.flatnonzero(np.diff(at) > 2 * AROUND) + 1).tolist(), len(at)]
                stretches = [(max(0, int(at[i]) - AROUND), min(len(code), int(at[j - 1]) + AROUND + 1)) for i, j in zip(edges, edges[1:])]
            out.append(stretches)
        return out

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        """(start, end, kind) in each text, in order, without overlaps; null and empty texts have none. Equal texts are read once."""
        distinct = sorted({t for t in texts if t})
        codes = [self.vocabulary.encode(t) for t in distinct]
        where = [[(a + x, a + y) for a, b in stretches for x, y in windows(b - a)] for stretches in self.places(codes)]
        flat = self.tagged([c[a:b] for c, ws in zip(codes, where) for a, b in ws])
        found, at = {}, 0
        for text, ws in zip(distinct, where):
            got = flat[at : at + len(ws)]
            at += len(ws)
            found[text] = _reconcile(text, ws, got) if any(got) else []
        return [found[t] if t else [] for t in texts]


def _reconcile(text: str, ws: list[tuple[int, int]], got: list[list[tuple[int, int, str]]]) -> list[tuple[int, int, str]]:
    """Of overlapping windows' spans the one farther from its window's borders, if its kind may look like that."""
    votes = []
    for (a, b), spans in zip(ws, got):
        for x, y, kind in spans:
            inner = min(x if a > 0 else WINDOW, (b - a - y) if b < len(text) else WINDOW)
            votes.append((-min(inner, OVERLAP // 2), a + x, a + y, kind))
    kept: list[tuple[int, int, str]] = []
    for _, a, b, kind in sorted(votes):
        while b > a and text[b - 1].isspace():
            b -= 1
        while b > a and text[a].isspace():
            a += 1
        if _may_be(text[a:b], kind) and all(b <= x or a >= y for x, y, _ in kept):
            kept.append((a, b, kind))
    return sorted(kept)


def _may_be(s: str, kind: str) -> bool:
    """Whether a span has what its kind can't do without."""
    digits = sum(c.isdigit() for c in s)
    if kind == "email":
        low = s.lower()
        return "@" in s or ("at" in low and ("dot" in low or "." in s))
    if kind == "phone":
        return digits >= 7
    if kind == "id_number":
        return digits >= 4
    if kind == "address":
        return digits >= 1 and sum(c.isalpha() for c in s) >= 2
    return digits == 0 and sum(c.isalpha() for c in s) >= 2


def parts(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows (key, text) in order, each part of about ``PART`` characters, and one row at least."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(b.column(1).cast(pa.large_string())), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = done = 0
    while start < len(ends):
        end = max(start + 1, int(np.searchsorted(ends, done + PART, side="right")))
        yield b.slice(start, end - start)
        start, done = end, int(ends[end - 1])


_FINDERS: dict[str, Finder] = {}


def _finder(model, weights: str) -> Finder:
    """One finder per worker process and weights."""
    if weights not in _FINDERS:
        chars, w, gate = model.value
        _FINDERS[weights] = Finder(Vocabulary(chars), w, gate)
    return _FINDERS[weights]


def _model(df: DataFrame, weights: str):
    vocabulary, w, gate = load(weights)
    return df.sparkSession.sparkContext.broadcast((vocabulary.chars, w, gate))


def _kind_of(df: DataFrame, key: str) -> str:
    return dict(df.dtypes)[key]


def personal_data(documents: DataFrame, key: str = "doc_id", weights: str = WEIGHTS) -> DataFrame:
    """``key, kind, start_pos, end_pos`` of each occurrence; positions are 1-based characters, the end is the last.

    Null, empty and blank texts have none; repeated rows are reported each. Nothing is shuffled, and the broadcast
    weights are of fixed size.
    """
    model = _model(documents, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(model, weights)
        for b in batches:
            for part in parts(b):
                rows = [
                    (k, kind, a + 1, e)
                    for k, spans in zip(part.column(0).to_pylist(), finder.find(part.column(1).to_pylist()))
                    for a, e, kind in spans
                ]
                cols = list(zip(*rows)) or [()] * 4
                kinds = [b.column(0).type, pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["key", "kind", "start_pos", "end_pos"])

    schema = f"key {_kind_of(documents, key)}, kind string, start_pos bigint, end_pos bigint"
    return documents.select(key, "text").mapInArrow(run, schema).withColumnRenamed("key", key)


def masked(documents: DataFrame, key: str = "doc_id", weights: str = WEIGHTS) -> DataFrame:
    """``key, text`` with ``[EMAIL]``, ``[PHONE]`` and so on in place of personal data, otherwise unchanged."""
    model = _model(documents, weights)

    def mask(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
        for a, b, kind in reversed(spans):
            text = f"{text[:a]}[{kind.upper()}]{text[b:]}"
        return text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(model, weights)
        for b in batches:
            for part in parts(b):
                texts = part.column(1).to_pylist()
                done = [mask(t, s) for t, s in zip(texts, finder.find(texts))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(done, pa.string())], names=["key", "text"])

    return documents.select(key, "text").mapInArrow(run, f"key {_kind_of(documents, key)}, text string").withColumnRenamed("key", key)
