"""Byte-level BPE from a public rank file, exact, without the tokenizer library.

Problem 8's method: a minimal perfect hash over the vocabulary resolves pre-tokens that are entries themselves; the
rest is merged by a heap over linked bytes. Problem 7 walks prefix tries instead (``budget``), over the same tables.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from itertools import chain, pairwise

import numpy as np
import regex
import xxhash

#: Fixed value: how the rank file's tokenizer cuts text before it merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ASCII = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"""
_LATIN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""

#: A worker's memo of pre-tokens is emptied when it holds so many; it only saves time.
MEMO = 400_000


def read_ranks(path: str) -> list[bytes]:
    """The entries of a rank file, by id."""
    with open(path, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(rows)
    for word, rank in rows:
        tokens[int(rank)] = base64.b64decode(word)
    return tokens


class PerfectHash:
    """Minimal perfect hash of byte strings: a displacement per bucket sends each key to a slot of its own."""

    def __init__(self, keys: list[bytes]):
        self.n = n = max(1, len(keys))
        self.buckets = nb = n // 3 + 1
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        members: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            members.setdefault(h % nb, []).append(i)
        self.shift = [0] * nb
        self.slots = [-1] * n
        free = 0
        for bucket, own in sorted(members.items(), key=lambda x: -len(x[1])):
            if len(own) == 1:  # the rest fills the gaps directly
                while self.slots[free] >= 0:
                    free += 1
                self.shift[bucket] = -1 - free
                self.slots[free] = own[0]
                continue
            d = 0
            while True:
                at = {self._slot(hashes[i], d) for i in own}
                if len(at) == len(own) and all(self.slots[s] < 0 for s in at):
                    break
                d += 1
            self.shift[bucket] = d
            for i in own:
                self.slots[self._slot(hashes[i], d)] = i
        self.keys = keys

    def _slot(self, h: int, d: int) -> int:
        return (((h >> 20) ^ (d * 0x9E3779B97F4A7C15)) * 0xD6E8FEB86659FD93 >> 17 & 0x7FFFFFFF) % self.n

    def get(self, key: bytes) -> int:
        """The id of ``key``, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        i = self.slots[-1 - d if d < 0 else self._slot(h, d)]
        return i if i >= 0 and self.keys[i] == key else -1


class Encoder:
    """Ids of texts under one rank file."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.find = PerfectHash(tokens).get
        spanned = {a << 8 | b for t in tokens for a, b in pairwise(t)}
        self.spanned = spanned
        self.full = regex.compile(PATTERN).findall
        self.ascii = re.compile(_ASCII).findall
        self.latin = re.compile(_LATIN).findall
        self.odd = regex.compile(r"[^\x00-\x7F -±´-¸º»¿-ɏ‐-‧、-〃〈-】一-鿿！-／：-＠]").search
        self.memo: dict[str, tuple[int, ...]] = {}
        self.parts: dict[bytes, tuple[int, ...]] = {}

    def merge(self, piece: bytes, but: int = -1) -> tuple[int, ...]:
        """Join the pair of lowest rank, leftmost first, until none is in the vocabulary or the entry ``but``."""
        n = len(piece)
        part: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        find = self.find
        for i in range(n - 1):
            if (r := find(piece[i : i + 2])) >= 0:
                heap.append((r, i, 2))
        heapq.heapify(heap)
        while heap:
            r, i, size = heapq.heappop(heap)
            left = part[i]
            if r == but or left is None or (j := after[i]) >= n or len(left) + len(part[j]) != size:
                continue
            both = left + part[j]
            part[i], part[j] = both, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := find(both + part[k])) >= 0:
                    heapq.heappush(heap, (r, i, size + len(part[k])))
            if (h := before[i]) >= 0 and (r := find(part[h] + both)) >= 0:
                heapq.heappush(heap, (r, h, len(part[h]) + size))
        return tuple([find(p) for p in part if p is not None])

    def cut(self, piece: bytes) -> list[bytes]:
        """The parts of a pre-token between neighbouring bytes that no entry spans: no merge can cross there."""
        spanned = self.spanned
        at = [i + 1 for i, (a, b) in enumerate(pairwise(piece)) if a << 8 | b not in spanned]
        return [piece[a:b] for a, b in pairwise([0, *at, len(piece)])] if at else [piece]

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token."""
        if (one := self.find(piece)) >= 0:
            return (one,)
        cut = self.cut(piece) if len(piece) > 8 else [piece]
        if len(cut) == 1:
            return self.merge(piece)
        out: list[int] = []
        parts = self.parts
        if len(parts) > MEMO:
            parts.clear()
        for part in cut:
            if (ids := parts.get(part)) is None:
                one = self.find(part)
                ids = (one,) if one >= 0 else self.merge(part)
                if len(part) < 64:
                    parts[part] = ids
            out.extend(ids)
        return tuple(out)

    def split(self, text: str) -> list[str]:
        """Pre-tokens; plain ASCII and common scripts go through the faster standard engine, which agrees on them."""
        if text.isascii():
            return self.ascii(text) if not any(c in text for c in "\x1c\x1d\x1e\x1f") else self.full(text)
        return self.full(text) if self.odd(text) else self.latin(text)

    def encode(self, text: str | None) -> array:
        """Ids of a text; null and empty texts have none."""
        out = array("i")
        if not text:
            return out
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        pieces = self.split(text)
        try:
            out.extend(chain.from_iterable([memo[p] for p in pieces]))
        except KeyError:
            for p in pieces:
                if p not in memo:
                    memo[p] = self.encode_piece(p.encode("utf-8", "surrogatepass"))
            out = array("i", chain.from_iterable([memo[p] for p in pieces]))
        return out

    def decode(self, ids) -> str:
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")


_BY_PATH: dict[str, Encoder] = {}


def encoder(key: str, tokens: list[bytes]) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if key not in _BY_PATH:
        _BY_PATH[key] = Encoder(tokens)
    return _BY_PATH[key]


def ids_column(texts, enc: Encoder):
    """Arrow list<int32> of the texts' ids."""
    import pyarrow as pa

    offsets, flat = [0], array("i")
    for t in texts:
        flat.extend(enc.encode(t))
        offsets.append(len(flat))
    return pa.ListArray.from_arrays(pa.array(np.array(offsets, "int32")), pa.array(np.frombuffer(flat, "int32") if len(flat) else np.array([], "int32")))
