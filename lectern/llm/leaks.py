"""Problem 9: passages of held-out test items inside the training corpus.

The documents of a partition are cut into shards, and each shard's words become an FM-index: a wavelet matrix over
the transform of its sorted suffixes, with every eighth suffix position kept. All phrases of all items are searched
backwards at once. Words that no item uses are one symbol, and a run of them one
occurrence, so the index holds only what a phrase could meet. Found phrases are located, verified on the text and
merged into spans. Equal passages of several items are searched once; a phrase that several passages share is searched
once and stands for all of them.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.plans.shared import stage_table

#: Consecutive words (Chinese: characters) of a passage that make a leak.
RUN_WORDS, RUN_CHARS = 12, 20
#: Words (Chinese: characters) of the phrases that lead to altered copies, and the share of them that must be met.
#: Of a longer text with less than 3 of 10 words altered some three neighbours always stay.
SEED_WORDS, SEED_CHARS, SEED_SHARE = 3, 4, 0.1
#: A word is rare that at most this share of the passages has, or two of them.
RARE = 0.02
#: Share of a passage's words, and of its rare words, that an altered copy keeps in order.
KEPT, KEPT_RARE = 0.7, 0.6
#: Symbols of a shard; a longer document is a shard of its own.
SHARD = 1_000_000
#: Characters of passages that are searched in one pass over the corpus; more items take more passes.
BLOCK = 4_000_000
#: Every so many-th text position is kept.
SAMPLED = 8

_WORD = re.compile(r"[一-鿿㐀-䶿]|(?:(?![一-鿿㐀-䶿])[^\W_])+(?:['’](?:(?![一-鿿㐀-䶿])[^\W_])+)*")
_PLAIN = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_HAN = re.compile(r"[一-鿿㐀-䶿]")


def words(text: str) -> list[str]:
    """Lower-case words; each Chinese character is one."""
    low = text.lower()
    found = (_WORD if _HAN.search(low) else _PLAIN).findall(low)
    return [w.replace("’", "'") for w in found] if "’" in low else found


def word_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _WORD.finditer(text)]


class WaveletMatrix:
    """Rank and access over integers, a bit vector per level with running counts."""

    def __init__(self, values: np.ndarray, levels: int):
        self.levels = levels
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for b in range(levels - 1, -1, -1):
            bit = (values >> b) & 1
            count = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(values) - int(count[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        lo = np.zeros_like(at)
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.levels - 1 - i)) & 1
            at, lo = (np.where(bit, zeros + ones[x], x - ones[x]) for x in (at, lo))
        return at - lo

    def access_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and how often it occurs before."""
        symbol, lo = np.zeros_like(at), np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[at + 1] - ones[at]
            symbol = symbol << 1 | bit
            at, lo = (np.where(bit, zeros + ones[x], x - ones[x]) for x in (at, lo))
        return symbol, at - lo


class FMIndex:
    """Counts and places of phrases in a sequence."""

    def __init__(self, seq: np.ndarray, symbols: int):
        n = len(seq)
        order = np.argsort(seq, kind="stable")
        rank, tied = self._ranked(np.empty(n, dtype=np.int64), order, seq[order], np.arange(n))
        known = 1
        while len(tied):  # doubling, over the suffixes that are still equal
            at = order[tied]
            after = np.where(at + known < n, rank[np.minimum(at + known, n - 1)] + 1, 0)
            key = rank[at] * (n + 1) + after
            by = np.argsort(key, kind="stable")
            order[tied] = at[by]
            rank, tied = self._ranked(rank, order, key[by], tied)
            known *= 2
        self.n = n
        last = seq[order - 1]  # the symbol before each suffix; the last symbol is the smallest and occurs once
        self.before = np.zeros(symbols + 1, dtype=np.int64)
        np.cumsum(np.bincount(seq, minlength=symbols), out=self.before[1:])
        self.wavelet = WaveletMatrix(last.astype(np.int64), max(1, int(symbols - 1).bit_length()))
        self.kept = np.full(n, -1, dtype=np.int32)
        held = order % SAMPLED == 0
        self.kept[held] = order[held]

    @staticmethod
    def _ranked(rank: np.ndarray, order: np.ndarray, key: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each suffix's rank becomes the first slot of its equals; returns the slots that are still tied."""
        new = np.r_[True, key[1:] != key[:-1]]
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(key)])
        rank[order[slots]] = np.repeat(slots[first], size)
        return rank, slots[np.repeat(size > 1, size)]

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of right-aligned phrases, by backward search of all at once."""
        width = phrases.shape[1]
        lo, hi = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n, dtype=np.int64)
        for step in range(width):
            on = np.flatnonzero((length > step) & (lo < hi))
            if not len(on):
                break
            c = phrases[on, width - 1 - step]
            lo[on] = self.before[c] + self.wavelet.rank(c, lo[on])
            hi[on] = self.before[c] + self.wavelet.rank(c, hi[on])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: steps back until a kept one."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        out = self.kept[at].astype(np.int64)
        for _ in range(SAMPLED):
            on = np.flatnonzero(out < 0)
            if not len(on):
                break
            symbol, before = self.wavelet.access_rank(at[on])
            at[on] = self.before[symbol] + before
            steps[on] += 1
            got = self.kept[at[on]].astype(np.int64)
            out[on] = np.where(got >= 0, (got + steps[on]) % self.n, -1)
        return out


class Items:
    """The passages' phrases: runs that prove a leak, and short ones with a rare word that lead to altered copies.

    Rows are (key, words, rare words) of distinct passages. A passage without rare words is led to by all its phrases.
    """

    def __init__(self, rows: list[tuple[str, list[str], set[str]]]):
        self.ids = [k for k, *_ in rows]
        self.words = [ws for _, ws, _ in rows]
        self.rare = [rare for *_, rare in rows]
        self.symbol = {w: i + 1 for i, w in enumerate(sorted({w for ws in self.words for w in ws}))}
        self.size = np.array([len(ws) for ws in self.words] or [0], dtype=np.int64)
        owners: dict[tuple[int, tuple[int, ...]], list[tuple[int, int]]] = defaultdict(list)  # (kind, symbols): (passage, first word)
        seeds = np.zeros(max(1, len(rows)), dtype=np.int64)
        for k, ws in enumerate(self.words):
            code = [self.symbol[w] for w in ws]
            han = sum(len(w) == 1 and bool(_HAN.match(w)) for w in ws) * 2 > len(ws)
            ends = self._run_ends(ws, han)
            for a, b in ends or [(0, len(ws))] * bool(ws):
                owners[0, tuple(code[a:b])].append((k, a))
            if not ends:  # shorter than a run: only all of it proves a leak
                continue
            size = min(SEED_CHARS if han else SEED_WORDS, len(code))
            all_ = range(len(code) - size + 1)
            own = [a for a in all_ if any(w in self.rare[k] for w in ws[a : a + size])] or list(all_)
            for a in own:
                owners[1, tuple(code[a : a + size])].append((k, a))
            seeds[k] = len(own)
        self.need = np.maximum(np.minimum(seeds, 2), np.ceil(SEED_SHARE * seeds)).astype(np.int64)
        phrases = sorted(owners)
        self.depth = max((len(p) for _, p in phrases), default=1)
        self.length = np.array([len(p) for _, p in phrases], dtype=np.int64)
        self.kind = np.array([kind for kind, _ in phrases], dtype=np.int64)
        self.table = np.zeros((len(phrases), self.depth), dtype=np.int64)
        for i, (_, p) in enumerate(phrases):
            self.table[i, self.depth - len(p) :] = p
        of = [owners[p] for p in phrases]
        self.many = np.array([len(x) for x in of], dtype=np.int64)
        self.start = np.cumsum(self.many) - self.many
        self.owner = np.array([k for x in of for k, _ in x], dtype=np.int64)
        self.first = np.array([a for x in of for _, a in x], dtype=np.int64)

    @staticmethod
    def _run_ends(ws: list[str], han: bool) -> list[tuple[int, int]]:
        if not han:
            return [(a, a + RUN_WORDS) for a in range(len(ws) - RUN_WORDS + 1)]
        out = []
        for a in range(len(ws)):
            n, b = 0, a
            while b < len(ws) and n < RUN_CHARS:
                n += len(ws[b])
                b += 1
            if n >= RUN_CHARS:
                out.append((a, b))
        return out


def _ordered(masks: dict[str, int], size: int, text: list[str]) -> int:
    """Length of the longest common subsequence, a machine word of the pattern at a time."""
    v = full = (1 << size) - 1
    for w in text:
        if m := masks.get(w):
            u = v & m
            v = (v + u | v - u) & full
    return size - v.bit_count()


def _masks(ws: list[str]) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, w in enumerate(ws):
        out[w] = out.get(w, 0) | 1 << i
    return out


def is_altered_copy(items: Items, k: int, text: list[str]) -> bool:
    """Whether the text keeps most of the passage's words, and most of its rare ones, in their order."""
    ws = items.words[k]
    rare = [w for w in ws if w in items.rare[k]]
    lost = len(rare) - _ordered(_masks(rare), len(rare), [w for w in text if w in items.rare[k]])
    if lost > max(2, (1 - KEPT_RARE) * len(rare)):
        return False
    return _ordered(_masks(ws), len(ws), text) >= KEPT * len(ws)


def _spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, place within it) of each of ``count`` things of every row."""
    which = np.repeat(np.arange(len(count)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)


def _altered(items: Items, d: np.ndarray, k: np.ndarray, at: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(doc, passage, first, last place of a phrase) of each stretch of a document that enough phrases of a passage lead to.

    Phrases of one copy lie on nearly the same diagonal (place in the text less place in the passage). Diagonals are
    counted in strips of half a passage, two neighbouring strips together, so that each copy is met whole by one pair.
    """
    half = np.maximum(4, items.size[k] // 2)
    strip = (at - first) // half
    order = np.lexsort((first, strip, k, d))
    d, k, at, first, strip = (x[order] for x in (d, k, at, first, strip))
    new = np.r_[True, (d[1:] != d[:-1]) | (k[1:] != k[:-1]) | (strip[1:] != strip[:-1])]
    begin = np.flatnonzero(new)
    end = np.r_[begin[1:], len(d)]
    met = np.add.reduceat((new | np.r_[True, first[1:] != first[:-1]]).astype(np.int64), begin)
    after = np.r_[(d[begin[1:]] == d[begin[:-1]]) & (k[begin[1:]] == k[begin[:-1]]) & (strip[begin[1:]] == strip[begin[:-1]] + 1), False]
    both = met + np.where(after, np.r_[met[1:], 0], 0)
    for i in np.flatnonzero(both >= items.need[k[begin]]).tolist():
        a, b = begin[i], end[i + 1] if after[i] else end[i]
        diagonal = at[a:b] - first[a:b]
        yield int(d[a]), int(k[a]), int(diagonal.min()), int(diagonal.max())


def _shard_leaks(docs: list[tuple[object, str, list[str], np.ndarray]], items: Items) -> Iterator[tuple]:
    """(doc, passage key, kind, start, end) of one shard; places are 1-based characters, the end is the last."""
    parts, where, owner = [np.zeros(1, dtype=np.int32)], [np.zeros(1, dtype=np.int32)], [np.zeros(1, dtype=np.int32)]
    for d, (_, _, _, code) in enumerate(docs):
        keep = np.flatnonzero((code != 0) | np.r_[True, code[:-1] != 0]) if len(code) else np.zeros(0, dtype=np.int64)
        parts += [code[keep], np.zeros(1, dtype=np.int32)]
        where += [keep.astype(np.int32), np.zeros(1, dtype=np.int32)]
        owner.append(np.full(len(keep) + 1, d, dtype=np.int32))
    place, who = np.concatenate(where), np.concatenate(owner)
    seq = np.r_[np.concatenate(parts) + 1, 0]  # 0 ends the text, 1 is a word that no item uses
    index = FMIndex(seq, len(items.symbol) + 2)
    lo, hi = index.search(items.table + 1, items.length)
    phrase, nth = _spread(hi - lo)
    at = index.locate(lo[phrase] + nth)
    hit, nth = _spread(items.many[phrase])
    phrase, at = phrase[hit], at[hit]
    own = items.start[phrase] + nth
    d, x, k, first, kind = who[at].astype(np.int64), place[at].astype(np.int64), items.owner[own], items.first[own], items.kind[phrase]
    found: dict[tuple[int, int], list[tuple[int, int, str]]] = defaultdict(list)
    for i in np.flatnonzero(kind == 0).tolist():
        found[int(d[i]), int(k[i])].append((int(x[i]), int(x[i] + items.length[phrase[i]]), "run"))
    lead = kind == 1
    if lead.any():
        for doc, passage, least, most in _altered(items, d[lead], k[lead], x[lead], first[lead]):
            ws, m = docs[doc][2], int(items.size[passage])
            a, b = max(0, least - m // 4), min(len(ws), most + m + m // 4)
            if any(r <= max(least, 0) and e >= min(most + m, len(ws)) for r, e, _ in found.get((doc, passage), ())) or not is_altered_copy(items, passage, ws[a:b]):
                continue
            mine = set(items.words[passage])
            rare = items.rare[passage] if 2 * len(items.rare[passage]) >= len(mine) else mine
            near = [i for i in range(max(0, least), min(len(ws), most + m)) if ws[i] in rare]
            found[doc, passage].append((near[0] if near else a, near[-1] + 1 if near else b, "altered"))
    for (doc, passage), stretches in sorted(found.items()):
        key, text, _, _ = docs[doc]
        spans = word_spans(text)
        merged: list[list] = []
        for a, b, how in sorted(stretches):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
                merged[-1][2] = max(how, merged[-1][2])  # a run proves more
            else:
                merged.append([a, b, how])
        for a, b, how in merged:
            yield key, items.ids[passage], how, spans[a][0] + 1, spans[min(b, len(spans)) - 1][1]


def _search(items: Items, key_type: pa.DataType):
    names = ["key", "passage_key", "kind", "start_pos", "end_pos"]
    kinds = [key_type, pa.string(), pa.string(), pa.int64(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = items.symbol.get
        docs, size = [], 0
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                ws = words(text)
                code = np.array([get(w, 0) for w in ws], dtype=np.int32)
                if not code.any():
                    continue
                docs.append((key, text, ws, code))
                size += len(code)
                if size >= SHARD:
                    yield batch(list(_shard_leaks(docs, items)))
                    docs, size = [], 0
        if docs:
            yield batch(list(_shard_leaks(docs, items)))

    return run


def passage_key(ws: list[str]) -> str:
    """Equal for passages of the same words."""
    return hashlib.md5(" ".join(ws).encode("utf-8", "surrogatepass")).hexdigest()


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ws = [words(t) for t in b.column(1).to_pylist()]
        cols = [b.column(0), pa.array([passage_key(w) for w in ws], pa.string()), pa.array(ws, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(cols, names=["item_id", "passage_key", "ws"])


def leak_spans(documents: DataFrame, eval_item: DataFrame) -> DataFrame:
    """``doc_id, item_id, kind, start_pos, end_pos``: the spans to remove, merged per document and item.

    Null or empty texts and passages have no span; repeated documents are reported each. An item shorter than a run
    must be there whole. Which words are rare is counted over all items. The passages are searched in blocks of
    ``BLOCK`` characters, so what is shipped to the workers is bounded; the corpus isn't shuffled.
    """
    from pyspark.sql.types import LongType, StringType

    kind = eval_item.schema["item_id"].dataType.simpleString()
    items = eval_item.where("passage is not null and item_id is not null").select("item_id", "passage")
    items = stage_table(items.mapInArrow(_passages, f"item_id {kind}, passage_key string, ws array<string>").where("size(ws) > 0"), "test-passages")
    passages = items.groupBy("passage_key").agg(F.first("ws").alias("ws"))
    n, total = passages.agg(F.count("*"), F.sum(F.length(F.array_join("ws", " ")))).first()
    used = passages.select("passage_key", F.explode(F.array_distinct("ws")).alias("w"))
    rare = used.groupBy("w").count().where(F.col("count") <= max(2, int(RARE * n))).select("w")
    rare = used.join(rare, "w").groupBy("passage_key").agg(F.collect_list("w").alias("rare"))
    passages = stage_table(passages.join(rare, "passage_key", "left"), "test-words")
    blocks = (total or 0) // BLOCK + 1
    doc = documents.schema["doc_id"].dataType
    arrow = {LongType(): pa.int64(), StringType(): pa.string()}.get(doc, pa.int64())
    schema = f"key {doc.simpleString()}, passage_key string, kind string, start_pos bigint, end_pos bigint"
    out = None
    for b in range(blocks):
        rows = passages.where(F.pmod(F.xxhash64("passage_key"), F.lit(blocks)) == b).collect()
        block = Items(sorted((r.passage_key, list(r.ws), set(r.rare or ())) for r in rows))
        part = documents.select("doc_id", "text").mapInArrow(_search(block, arrow), schema)
        out = part if out is None else out.unionByName(part)
    out = out.join(items.select("item_id", "passage_key"), "passage_key")
    return out.select(F.col("key").alias("doc_id"), "item_id", "kind", "start_pos", "end_pos")


def leaked(documents: DataFrame, eval_item: DataFrame) -> DataFrame:
    """``doc_id, item_id``, each pair once."""
    return leak_spans(documents, eval_item).select("doc_id", "item_id").distinct()
