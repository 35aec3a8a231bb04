"""Problem 7: token totals per slice, counted exactly without encoding every text.

Distinct pre-tokens are range-partitioned and sorted, so that each partition is a prefix trie walked depth first: the
stack holds the tokenization state of the current path, and pieces with a common prefix share its states. A state is
the last token of the prefix and the number of tokens; a token may end a prefix if it may follow the last token of
what is before it, that is if encoding the two side by side gives the two back. Terminal counts are joined to the
slices' piece counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.bpe import MEMO, Encoder, encoder, read_ranks
from lectern.llm.encode import VOCABULARY
from lectern.llm.langid import Profiles, main_language, profiles_of, texts_languages

#: Pre-tokens that a task holds before it counts them and hands the counts on.
HELD = 3_000_000


class TrieWalk:
    """Token counts of pieces that come in byte order, by states on the path from the trie's root."""

    def __init__(self, enc: Encoder):
        self.enc = enc
        self.ids = {t: i for i, t in enumerate(enc.tokens) if t}
        self.longest = max(map(len, enc.tokens))
        self.path = b""
        self.states: list[tuple[int, int]] = [(-1, 0)]  # (last token, tokens) after each byte of the path
        self.pairs: dict[tuple[int, int], bool] = {}
        self.edges: dict[tuple[int, bool], list[tuple[bytes, int, int]]] = {}

    def _edge(self, token: int, right: bool) -> list[tuple[bytes, int, int]]:
        """The tokens that stand at one edge of an entry while it is merged: (bytes, when made, when taken up).

        Ranks are the times; single bytes are there from the start. Empty if merging never makes the entry.
        """
        key = (token, right)
        if (out := self.edges.get(key)) is None:
            out, end, part = [], 1 << 30, token
            while True:
                word = self.enc.tokens[part]
                out.append((word, part if len(word) > 1 else -1, end))
                if len(word) == 1:
                    break
                halves = self.enc.merge(word, part)
                if len(halves) != 2:
                    out = []
                    break
                end, part = part, halves[1 if right else 0]
            self.edges[key] = out
        return out

    def _may_follow(self, a: int, b: int) -> bool:
        """Whether encoding the two entries side by side gives the two back.

        It does unless two tokens at the border are there at a time at which their merge comes first; of equal merges
        the left one does.
        """
        key = (a, b)
        if (ok := self.pairs.get(key)) is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            ok, ids = True, self.ids
            for x, made_x, end_x in self._edge(a, True):
                for y, made_y, end_y in self._edge(b, False):
                    if (r := ids.get(x + y)) is not None:
                        at = max(r, made_x, made_y)
                        if at < end_x and (at < end_y or (at == r == end_y)):
                            ok = False
                            break
                if not ok:
                    break
            self.pairs[key] = ok
        return ok

    def _step(self, end: int) -> tuple[int, int]:
        path, states, ids = self.path, self.states, self.ids
        for start in range(max(0, end - self.longest), end):
            if (token := ids.get(path[start:end])) is not None and self._own(token):
                last, n = states[start]
                if start == 0 or self._may_follow(last, token):
                    return token, n + 1
        raise ValueError("a byte without an entry")

    def _own(self, token: int) -> bool:
        """Whether merging the entry's own bytes makes it; the others are never made."""
        return bool(self._edge(token, True))

    def count(self, piece: bytes) -> int:
        if piece in self.ids or not piece:
            return 1  # whole entries are taken as they are, and need no states
        shared, stop = 0, min(len(piece), len(self.path), len(self.states) - 1)
        while shared < stop and piece[shared] == self.path[shared]:
            shared += 1
        self.path = piece
        del self.states[shared + 1 :]
        for end in range(len(self.states), len(piece) + 1):
            self.states.append(self._step(end))
        return self.states[-1][1]


class _Pieces(dict):
    """Numbers of pre-tokens in the order in which they are met; how many entries each holds, and its other parts."""

    def __init__(self, enc: Encoder):
        super().__init__()
        self.enc, self.ids = enc, set(enc.tokens)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.entries: list[int] = []
        self.others: list[bool] = []
        self.parts: list[tuple[bytes, ...]] = []

    def __missing__(self, text: str) -> int:
        piece = text.encode("utf-8", "surrogatepass")
        cut = (piece,) if piece in self.ids or text.isascii() else self.enc.cut(piece)
        rest = tuple([p for p in cut if p not in self.ids])
        self.entries.append(len(cut) - len(rest))
        self.others.append(bool(rest))
        self.parts.append(rest)
        self[text] = n = len(self.parts) - 1
        return n


def piece_counts(texts: DataFrame, keys: list[str], vocabulary: str = VOCABULARY, model: Profiles | None = None) -> DataFrame:
    """``*keys, [language,] piece, n`` of the columns ``*keys, text``, summed within each task.

    A piece is a part of a pre-token that no entry of the vocabulary goes beyond. Pieces that are entries themselves are
    one token each and counted together, under the empty piece. With a model the language of most of each text's paragraphs is a further key, '' where none has one.
    """
    sc = texts.sparkSession.sparkContext
    tokens = sc.broadcast(read_ranks(vocabulary))
    ranked = sc.broadcast(model.ranked) if model else None
    kinds = dict(texts.dtypes)
    names = keys + (["language"] if model else [])
    types = {k: kinds[k] for k in keys} | {"language": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, tokens.value)
        langs = Profiles(ranked.value) if ranked else None
        pieces = _Pieces(enc)
        slices: dict[tuple, int] = {}
        held: list[np.ndarray] = []
        size = 0
        arrow: list[pa.DataType] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys = list(slices)
            pair, n = np.unique(np.concatenate(held) if held else np.zeros(0, dtype=np.int64), return_counts=True)
            owner, piece = pair >> 32, pair & 0xFFFFFFFF
            whole = np.bincount(owner, weights=n * np.array(pieces.entries, dtype=np.int64)[piece], minlength=len(keys))
            some = np.flatnonzero(np.array(pieces.others, dtype=bool)[piece]) if len(pair) else []
            counts: dict[int, Counter] = {k: Counter({b"": int(x)}) for k, x in enumerate(whole) if x}
            parts = pieces.parts
            for k, p, m in zip(owner[some].tolist(), piece[some].tolist(), n[some].tolist()):
                count = counts.setdefault(k, Counter())
                for part in parts[p]:
                    count[part] += m
            for k, count in counts.items():
                cols = [pa.array([v] * len(count), t) for v, t in zip(keys[k], arrow)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], names=[*names, "piece", "n"])
            held.clear()
            slices.clear()
            if len(pieces) > MEMO:
                pieces.forget()

        for b in batches:
            arrow = [b.column(i).type for i in range(len(keys))] + ([pa.string()] if langs else [])
            for start in range(0, b.num_rows, 1000):
                part = b.slice(start, 1000)
                columns = [part.column(i).to_pylist() for i in range(len(keys))]
                texts_ = part.column(len(keys)).to_pylist()
                if langs:
                    columns.append([main_language(found, ps)[0] or "" for ps, found in texts_languages(texts_, langs)])
                for *key, text in zip(*columns, texts_):
                    if text:
                        own = slices.setdefault(tuple(key), len(slices))
                        cut = enc.split(text)
                        held.append(np.fromiter(map(pieces.__getitem__, cut), dtype=np.int64, count=len(cut)) | own << 32)
                        size += len(cut)
                if size > HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    schema = ", ".join(f"{k} {types[k]}" for k in names) + ", piece binary, n bigint"
    return texts.select(*keys, "text").mapInArrow(run, schema)


def piece_tokens(pieces: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``piece, tokens`` of the distinct values of column ``piece``."""
    tokens = pieces.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = TrieWalk(encoder(vocabulary, tokens.value))
        for b in batches:
            n = [walk.count(p) for p in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32())], names=["piece", "tokens"])

    # Sorted ranges are sub-tries in depth-first order.
    return pieces.select("piece").distinct().repartitionByRange("piece").sortWithinPartitions("piece").mapInArrow(run, "piece binary, tokens int")


def token_totals(texts: DataFrame, keys: list[str], vocabulary: str = VOCABULARY, model: Profiles | None = None) -> DataFrame:
    """``*keys, [language,] tokens``: exact totals; keys whose texts are all null or empty have none."""
    from lectern.plans.shared import stage_table

    names = keys + (["language"] if model else [])
    counts = piece_counts(texts, keys, vocabulary, model).groupBy(*names, "piece").agg(F.sum("n").alias("n"))
    counts = stage_table(counts, "piece-counts")
    known = piece_tokens(counts, vocabulary)
    return counts.join(known, "piece").groupBy(*names).agg(F.sum(F.col("n") * F.col("tokens")).alias("tokens"))


def slices(documents: DataFrame, chunk: DataFrame, md_doc: DataFrame) -> DataFrame:
    """``source, discipline, text`` of documents and chunks; chunks have the source ``books`` and their book's discipline.

    A missing source or discipline is ''.
    """
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit(""))
    docs = documents.select(blank("source").alias("source"), blank("discipline").alias("discipline"), "text")
    books = md_doc.where("stem is not null").groupBy("stem").agg(F.min("discipline").alias("discipline"))
    parts = chunk.select("stem", "text").join(books, "stem", "left").select(F.lit("books").alias("source"), blank("discipline").alias("discipline"), "text")
    return docs.unionByName(parts)


def slice_totals(documents: DataFrame, chunk: DataFrame, md_doc: DataFrame) -> DataFrame:
    """``source, discipline, language, tokens`` by the detected language of each text."""
    return token_totals(slices(documents, chunk, md_doc), ["source", "discipline"], model=profiles_of(md_doc, documents))


def book_totals(chunk: DataFrame, run_status: DataFrame) -> DataFrame:
    """``stem, tokens, words, stated_words, tokens_in``: counted figures of each book beside the stated ones.

    words are counted as figures of the texts; tokens_in is that of the run that was loaded last with a positive one.
    """
    counted = token_totals(chunk.where("stem is not null").select("stem", "text"), ["stem"])
    words = F.regexp_count("text", F.lit("[A-Za-z]+|[一-鿿]"))
    stated = chunk.where("stem is not null").groupBy("stem").agg(F.sum(words).cast("bigint").alias("words"), F.sum("word_count").cast("bigint").alias("stated_words"))
    runs = run_status.where("tokens_in > 0").groupBy("stem").agg(F.max_by("tokens_in", F.struct("loaded_at", "run_id")).alias("tokens_in"))
    return stated.join(counted, "stem", "left").join(runs, "stem", "left").select("stem", F.coalesce("tokens", F.lit(0)).alias("tokens"), "words", "stated_words", "tokens_in")
