"""A character-level bidirectional LSTM with CRF transitions, in numpy: training and decoding."""

from __future__ import annotations

import unicodedata
from collections import Counter

import numpy as np

KINDS = ("email", "phone", "id_number", "address", "person")
#: O, then B and I of each kind.
TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
EMBED, HIDDEN = 24, 24
#: The same of the gate, and how often it counts what it misses.
GATE_EMBED, GATE_HIDDEN, MISSED = 8, 8, 4.0
#: Characters that get an embedding of their own, the most frequent of the training windows.
CHARACTERS = 420
#: Ids that stand for a class of characters: padding, rare Chinese, lower letters, capitals, figures, others.
CLASSES = 6
_NEG = np.float32(-1e4)
#: Steps after which texts that have ended are left out.
STEPS = 16


def _base(c: str) -> str:
    if ord(c) < 128 or "一" <= c <= "鿿":
        return c
    return unicodedata.normalize("NFKD", c)[0]


class Vocabulary:
    """Ids of characters: the first ones stand for classes (``CLASSES``), the others for a character each."""

    def __init__(self, chars: str):
        self.chars = chars
        self.ids = {c: i + CLASSES for i, c in enumerate(chars)}
        self.table = np.full(0x110000, -1, dtype=np.int32)

    @classmethod
    def of(cls, texts: list[str]) -> Vocabulary:
        count = Counter(_base(c) for t in texts for c in t)
        return cls("".join(sorted(c for c, _ in count.most_common(CHARACTERS))))

    def __len__(self) -> int:
        return len(self.chars) + CLASSES

    def _id(self, c: str) -> int:
        b = _base(c)
        return self.ids.get(b) or (1 if "一" <= b <= "鿿" else 3 if b.isupper() else 2 if b.isalpha() else 4 if b.isdigit() else 5)

    def encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ids = self.table[points]
        if (new := ids < 0).any():
            for p in np.unique(points[new]).tolist():
                self.table[p] = self._id(chr(p))
            ids = self.table[points]
        return ids


def allowed() -> np.ndarray:
    """Transitions that tags permit: I of a kind comes after its B or I only."""
    ok = np.ones((len(TAGS), len(TAGS)), dtype=bool)
    for j, t in enumerate(TAGS):
        if t[0] == "I":
            for i, s in enumerate(TAGS):
                ok[i, j] = s[2:] == t[2:] and s != "O"
    return ok


def initial(vocabulary: int, seed: int = 7, hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    h, e, k = hidden, EMBED, len(TAGS)
    w = {"embed": rng.normal(0, 0.3, (vocabulary, e))}
    for d in ("f", "b"):
        w[f"x{d}"] = rng.normal(0, (1 / e) ** 0.5, (e, 4 * h))
        w[f"h{d}"] = rng.normal(0, (1 / h) ** 0.5, (h, 4 * h))
        bias = np.zeros(4 * h)
        bias[h : 2 * h] = 1.0
        w[f"c{d}"] = bias
    w["out"] = rng.normal(0, (1 / (2 * h)) ** 0.5, (2 * h, k))
    w["bias"] = np.zeros(k)
    w["trans"] = rng.normal(0, 0.05, (k, k))
    return {n: a.astype(np.float32) for n, a in w.items()}


def _lstm(x: np.ndarray, wh: np.ndarray, mask: np.ndarray, keep: bool):
    """Outputs (T, B, H) of one direction from the projected inputs (T, B, 4H); gates in the order i, f, o, g."""
    steps, batch, h4 = x.shape
    h = h4 // 4
    out = np.zeros((steps, batch, h), dtype=np.float32)
    state, cell = np.zeros((batch, h), dtype=np.float32), np.zeros((batch, h), dtype=np.float32)
    saved = []
    for t in range(steps):
        z = x[t] + state @ wh
        z[:, : 3 * h] *= 0.5
        np.tanh(z, out=z)
        z[:, : 3 * h] *= 0.5
        z[:, : 3 * h] += 0.5
        i, f, o, g = z[:, :h], z[:, h : 2 * h], z[:, 2 * h : 3 * h], z[:, 3 * h :]
        m = mask[t][:, None]
        new = f * cell + i * g
        tanh = np.tanh(new)
        if keep:
            saved.append((z, cell, state, tanh))
        cell = new * m
        state = o * tanh * m
        out[t] = state
    return out, saved


def _lstm_back(dout: np.ndarray, saved: list, wh: np.ndarray, mask: np.ndarray):
    """Gradients of the projected inputs and of the recurrent weights."""
    steps, batch, h = dout.shape
    dx = np.zeros((steps, batch, 4 * h), dtype=np.float32)
    dwh = np.zeros_like(wh)
    dh, dc = np.zeros((batch, h), dtype=np.float32), np.zeros((batch, h), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        z, cell, state, tanh = saved[t]
        i, f, o, g = z[:, :h], z[:, h : 2 * h], z[:, 2 * h : 3 * h], z[:, 3 * h :]
        m = mask[t][:, None]
        d = (dout[t] + dh) * m
        dcell = dc * m + d * o * (1 - tanh * tanh)
        dz = np.concatenate([dcell * g * i * (1 - i), dcell * cell * f * (1 - f), d * tanh * o * (1 - o), dcell * i * (1 - g * g)], axis=1)
        dx[t] = dz
        dwh += state.T @ dz
        dh = dz @ wh.T
        dc = dcell * f
    return dx, dwh


def _reverse(a: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each sequence of (T, B, ...) turned round within its length."""
    steps = a.shape[0]
    at = length[None, :] - 1 - np.arange(steps)[:, None]
    at = np.where(at < 0, np.arange(steps)[:, None], at)
    return np.take_along_axis(a, at.reshape(at.shape + (1,) * (a.ndim - 2)), axis=0)


def forward(w: dict[str, np.ndarray], ids: np.ndarray, length: np.ndarray, keep: bool = False):
    """Scores (T, B, tags) of padded character ids (T, B)."""
    mask = (np.arange(ids.shape[0])[:, None] < length[None, :]).astype(np.float32)
    x = w["embed"][ids]
    xr = _reverse(x, length)
    of, sf = _lstm(x @ w["xf"] + w["cf"], w["hf"], mask, keep)
    ob, sb = _lstm(xr @ w["xb"] + w["cb"], w["hb"], mask, keep)
    both = np.concatenate([of, _reverse(ob, length)], axis=2)
    return both @ w["out"] + w["bias"], (mask, x, xr, both, sf, sb)


class Layer:
    """A bidirectional layer with trained weights, as fast as numpy allows: texts lie side by side, so that every step
    works on whole rows of memory, and a text takes part in the steps of its own length only, up to ``STEPS``.

    What a step reads of a character is its embedding, a one for the bias, and a one for padding, which shuts the input
    gate, so that the backward direction comes to a text's end with an empty state. A tangent is a sigmoid of twice the
    argument, and sigmoids are reciprocals of exponentials, which are cheaper; factors and signs are in the weights. Cells
    are kept times -2, as the next exponential wants them, and states halved.
    """

    def __init__(self, w: dict[str, np.ndarray]):
        h, e = w["hf"].shape[0], w["embed"].shape[1]
        sign = np.r_[np.full(3 * h, -1), np.full(h, -2)].astype(np.float32)
        shut = np.r_[np.full(h, _NEG), np.zeros(3 * h)].astype(np.float32)[None]
        self.hidden, self.inputs = h, e + 2
        self.over = np.r_[np.ones(3 * h), np.full(h, -4)].astype(np.float32)[:, None]
        self.chars = np.zeros((e + 2, len(w["embed"])), dtype=np.float32)
        self.chars[:e], self.chars[e], self.chars[e + 1, 0] = w["embed"].T, 1, 1
        self.gates = [np.ascontiguousarray((np.r_[w[f"x{d}"], w[f"c{d}"][None], shut, w[f"h{d}"] * np.float32(2)] * sign).T) for d in "fb"]

    def scored(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(what both directions add to the scores (T, outputs, B), lengths) of encoded texts."""
        order = np.argsort([len(r) for r in rows], kind="stable")
        ids, length = pad([rows[i] for i in order])
        out = np.zeros((len(ids), len(self.out[0]), len(rows)), dtype=np.float32)
        with np.errstate(over="ignore"):  # a shut gate is one over infinity
            for d in (0, 1):
                self._add(d, ids, length, out)
        if (order[1:] < order[:-1]).any():
            back = np.argsort(order)
            return out[:, :, back], length[back]
        return out, length

    def _add(self, d: int, ids: np.ndarray, length: np.ndarray, out: np.ndarray) -> None:
        """One direction's part, over padded ids (T, B) in the order of their lengths."""
        steps, batch = ids.shape
        h, n = self.hidden, self.inputs
        cell, state = np.zeros((h, 0), dtype=np.float32), np.zeros((h, 0), dtype=np.float32)
        starts = range(0, steps, STEPS)
        for start in reversed(starts) if d else starts:
            k = int(np.searchsorted(length, start, side="right"))  # those before have ended
            live, same = batch - k, min(batch - k, cell.shape[1])
            if live != cell.shape[1] or start == (starts[-1] if d else 0):
                fed, kept = np.zeros((n + h, live), dtype=np.float32), np.zeros((h, live), dtype=np.float32)
                fed[n:, live - same :], kept[:, live - same :] = state[:, state.shape[1] - same :], cell[:, cell.shape[1] - same :]
                cell, char, state = kept, fed[:n], fed[n:]
                z, tmp, said = np.empty((4 * h, live), dtype=np.float32), np.empty((h, live), dtype=np.float32), np.empty((out.shape[1], live), dtype=np.float32)
                i, f, o, g = (z[j * h : (j + 1) * h] for j in range(4))
            within = range(start, min(start + STEPS, steps))
            for t in reversed(within) if d else within:
                np.take(self.chars, ids[t, k:], axis=1, out=char, mode="clip")
                np.dot(self.gates[d], fed, out=z)
                np.exp(z, out=z)
                np.add(z, 1, out=z)
                np.divide(self.over, z, out=z)
                np.add(g, 2, out=g)
                np.multiply(f, cell, out=cell)
                np.multiply(i, g, out=tmp)
                np.add(cell, tmp, out=cell)
                np.exp(cell, out=tmp)
                np.add(tmp, 1, out=tmp)
                np.reciprocal(tmp, out=tmp)
                np.subtract(tmp, 0.5, out=tmp)
                np.multiply(o, tmp, out=state)
                np.dot(self.out[d], state, out=said)
                row = out[t, :, k:]
                np.add(row, said, out=row)


class Gate(Layer):
    """A small network that reads all of a text and tells where personal data may be, for the large one to look closely."""

    def __init__(self, w: dict[str, np.ndarray]):
        super().__init__(w)
        h = self.hidden
        self.out = [np.ascontiguousarray(w["out"][x].T * np.float32(2)) for x in (slice(0, h), slice(h, 2 * h))]
        self.bias = float(w["bias"][0])

    def above(self, rows: list[np.ndarray], threshold: float) -> list[np.ndarray]:
        """Places of each encoded text whose log-odds exceed the threshold."""
        odds, length = self.scored(rows)
        at, who = np.nonzero(odds[:, 0, :] > threshold - self.bias)
        on = at < length[who]
        order = np.argsort(who[on], kind="stable")
        at, who = at[on][order], who[on][order]
        return np.split(at, np.searchsorted(who, np.arange(1, len(rows))))


class Reader(Layer):
    """Best paths with trained weights."""

    def __init__(self, w: dict[str, np.ndarray]):
        super().__init__(w)
        h = self.hidden
        n = len(KINDS)
        order = np.r_[np.arange(1, 2 * n, 2), np.arange(2, 2 * n + 1, 2)]  # all B, then all I, each less O
        less = w["out"][:, order] - w["out"][:, :1]
        self.out = [np.ascontiguousarray(less[x].T * np.float32(2)) for x in (slice(0, h), slice(h, 2 * h))]
        self.bias = (w["bias"][order] - w["bias"][0])[None, :, None]
        self.order = order
        t = self.trans = np.where(allowed(), w["trans"], _NEG).astype(np.float32)
        begin, inner = order[:n], order[n:]
        # What a span's transitions add to those of O at most: into it, inside it, and out of it.
        self.into = (t[:, begin].max(axis=0) - t[0, 0])[:, None]
        self.within = (np.maximum(t[begin, inner], t[inner, inner]) - t[0, 0])[:, None]
        # What two spans that touch may gain by each other.
        touch = max(0.0, float((t[1:, begin] - t[1:, :1] - t[:1, begin] + t[0, 0]).max()))
        self.exit = (np.maximum(t[begin, 0], t[inner, 0]) - t[0, 0] + 2 * touch)[:, None]

    def scores(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(scores (T, tags, B) of all B and all I less that of O, lengths) of encoded texts."""
        scores, length = self.scored(rows)
        scores += self.bias
        return scores, length

    def _may_hold(self, scores: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Where the best path may have another tag than O, by text (B, T), with the O on either side.

        For each kind and place: the most that a span of the kind through this place could gain over O. Where that is
        never above zero the best path is O, as leaving such a span out would not make it worse.
        """
        n, steps = len(KINDS), len(scores)
        through = scores[:, :n] + self.into
        go_on = scores[:, n:] + self.within
        off = (np.arange(steps)[:, None] >= length[None, :])[:, None, :]
        np.copyto(through, _NEG, where=off)
        np.copyto(go_on, _NEG, where=off)
        tmp = np.empty_like(through[0])
        for t in range(1, steps):  # the best span up to here
            np.add(through[t - 1], go_on[t], out=tmp)
            np.maximum(through[t], tmp, out=through[t])
        after = np.broadcast_to(self.exit, tmp.shape).copy()
        for t in range(steps - 1, -1, -1):  # and the best way on from here
            np.add(through[t], after, out=through[t])
            np.add(after, go_on[t], out=after)
            np.maximum(after, self.exit, out=after)
        on = (through.max(axis=1) > 0).T
        wide = on.copy()
        wide[:, 1:] |= on[:, :-1]
        wide[:, :-1] |= on[:, 1:]
        return wide

    def paths(self, rows: list[np.ndarray]) -> list[np.ndarray | None]:
        """The best path of each encoded text, or None where all of it is O.

        The search covers only the stretches that may hold another tag; it is exact, as the places around them are O.
        """
        scores, length = self.scores(rows)
        on = self._may_hold(scores, length)
        out: list[np.ndarray | None] = [None] * len(rows)
        some = np.flatnonzero(on.any(axis=1))
        if not len(some):
            return out
        edge = np.diff(np.pad(on[some], ((0, 0), (1, 1))).astype(np.int8), axis=1)
        begin, end = np.argwhere(edge == 1), np.argwhere(edge == -1)
        end[:, 1] = np.minimum(end[:, 1], length[some][end[:, 0]])
        keep = end[:, 1] > begin[:, 1]
        begin, end = begin[keep], end[keep]
        size = end[:, 1] - begin[:, 1]
        order = np.argsort(size, kind="stable")
        for i in range(0, len(order), 256):
            part = order[i : i + 256]
            steps = int(size[part].max())
            at = np.minimum(begin[part, 1][None, :] + np.arange(steps)[:, None], len(scores) - 1)
            stretch = np.zeros((steps, len(part), len(TAGS)), dtype=np.float32)
            stretch[:, :, self.order] = scores[at, :, some[begin[part, 0]][None, :]]
            for j, path in zip(part.tolist(), viterbi(stretch, self.trans, size[part])):
                if any(path):
                    k = int(some[begin[j, 0]])
                    if out[k] is None:
                        out[k] = np.zeros(int(length[k]), dtype=np.int8)
                    out[k][begin[j, 1] : end[j, 1]] = path
        return out


def viterbi(scores: np.ndarray, trans: np.ndarray, length: np.ndarray) -> list[list[int]]:
    """Best paths (of equal ones that with the first tags, from the end) over scores (T, B, tags).

    The way back is looked up where it is walked, as that takes one tag a step instead of all."""
    steps, batch, k = scores.shape
    trans = np.where(allowed(), trans, _NEG).astype(np.float32)
    scores = np.ascontiguousarray(scores.transpose(0, 2, 1))
    best = np.empty_like(scores)
    best[0] = scores[0] + np.array([_NEG if t[0] == "I" else 0 for t in TAGS], dtype=np.float32)[:, None]
    into, all_ = trans[:, :, None], np.empty((k, k, batch), dtype=np.float32)
    for t in range(1, steps):
        np.add(best[t - 1][:, None, :], into, out=all_)
        np.max(all_, axis=0, out=best[t])
        best[t] += scores[t]
    end, rows = length - 1, np.arange(batch)
    tag = last = best[end, :, rows].argmax(axis=1)
    paths = np.zeros((batch, steps), dtype=np.int8)
    for t in range(steps - 1, -1, -1):
        if t < steps - 1:
            tag = np.where(t < end, (best[t].T + trans.T[tag]).argmax(axis=1), last)
        paths[:, t] = tag
    return [paths[b, : int(n)].tolist() for b, n in enumerate(length)]


def _crf(scores: np.ndarray, trans: np.ndarray, tags: np.ndarray, length: np.ndarray):
    """Mean negative log-likelihood, and its gradients for scores and transitions.

    In double precision: sums over a window reach thousands, and what is lost of them would outweigh the gradients.
    """
    scores, trans = scores.astype(np.float64), trans.astype(np.float64)
    steps, batch, k = scores.shape
    trans = np.where(allowed(), trans, _NEG)
    on = np.arange(steps)[:, None] < length[None, :]

    def lse(a: np.ndarray, axis: int) -> np.ndarray:
        m = a.max(axis=axis, keepdims=True)
        return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)

    alpha = np.zeros_like(scores)
    alpha[0] = scores[0]
    for t in range(1, steps):
        new = lse(alpha[t - 1][:, :, None] + trans[None], 1) + scores[t]
        alpha[t] = np.where(on[t][:, None], new, alpha[t - 1])
    beta = np.zeros_like(scores)
    for t in range(steps - 2, -1, -1):
        new = lse(trans[None] + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        beta[t] = np.where(on[t + 1][:, None], new, 0)
    z = lse(alpha[-1], 1)
    mean = np.exp(np.minimum(alpha + beta - z[None, :, None], 0)) * on[:, :, None]
    gold = np.zeros_like(scores)
    np.put_along_axis(gold, tags[:, :, None], 1, axis=2)
    gold *= on[:, :, None]
    score = (scores * gold).sum()
    dtrans = np.zeros_like(trans)
    for t in range(1, steps):
        live = on[t]
        if not live.any():
            break
        p = np.exp(np.minimum(alpha[t - 1][:, :, None] + trans[None] + (scores[t] + beta[t])[:, None, :] - z[:, None, None], 0))
        dtrans += p[live].sum(axis=0)
        np.add.at(dtrans, (tags[t - 1][live], tags[t][live]), -1)
        score += trans[tags[t - 1][live], tags[t][live]].sum()
    n = float(length.sum())
    return (z.sum() - score) / n, (mean - gold) / n, np.where(allowed(), dtrans / n, 0).astype(np.float32)


def _binary(scores: np.ndarray, target: np.ndarray, length: np.ndarray):
    """Mean cross-entropy of each place's log-odds, in which what is missed counts ``MISSED`` times, and its gradient."""
    on = (np.arange(len(scores))[:, None] < length[None, :])[:, :, None]
    y = target[:, :, None].astype(np.float64)
    weight = on * np.where(y > 0, MISSED, 1.0) / float(length.sum())
    z = scores.astype(np.float64)
    return float((weight * (np.logaddexp(0, z) - y * z)).sum()), weight * (1 / (1 + np.exp(-z)) - y)


def gradients(w: dict[str, np.ndarray], ids: np.ndarray, tags: np.ndarray, length: np.ndarray):
    """Loss and gradients of the tagging network, or of the gate, which has no transitions."""
    scores, (mask, x, xr, both, sf, sb) = forward(w, ids, length, keep=True)
    if "trans" in w:
        loss, dscores, dtrans = _crf(scores, w["trans"], tags, length)
    else:
        loss, dscores = _binary(scores, tags, length)
    dscores = dscores.astype(np.float32)
    h = w["hf"].shape[0]
    g = {"bias": dscores.sum((0, 1)), "out": np.tensordot(both, dscores, ((0, 1), (0, 1)))}
    if "trans" in w:
        g["trans"] = dtrans
    dboth = dscores @ w["out"].T
    dxf, g["hf"] = _lstm_back(dboth[:, :, :h], sf, w["hf"], mask)
    dxb, g["hb"] = _lstm_back(_reverse(dboth[:, :, h:], length), sb, w["hb"], mask)
    g["xf"], g["cf"] = np.tensordot(x, dxf, ((0, 1), (0, 1))), dxf.sum((0, 1))
    g["xb"], g["cb"] = np.tensordot(xr, dxb, ((0, 1), (0, 1))), dxb.sum((0, 1))
    dx = dxf @ w["xf"].T + _reverse(dxb @ w["xb"].T, length)
    g["embed"] = np.zeros_like(w["embed"])
    np.add.at(g["embed"], ids, dx)
    return loss, g


def pad(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """(ids (T, B) with zeros after each end, lengths)."""
    length = np.array([len(r) for r in rows])
    out = np.zeros((len(rows), max(length)), dtype=np.int64)
    for j, r in enumerate(rows):
        out[j, : len(r)] = r
    return np.ascontiguousarray(out.T), length


def tags_of(n: int, spans: list[tuple[int, int, str]]) -> list[int]:
    out = [0] * n
    for a, b, kind in spans:
        i = 1 + 2 * KINDS.index(kind)
        for x in range(max(0, a), min(n, b)):
            out[x] = i if x == a else i + 1
        if a < 0 < b:
            out[0] = i  # a span that began before the window
    return out


def initial_gate(vocabulary: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    h, e = GATE_HIDDEN, GATE_EMBED
    w = {"embed": rng.normal(0, 0.5, (vocabulary, e)), "out": rng.normal(0, (1 / (2 * h)) ** 0.5, (2 * h, 1)), "bias": np.full(1, -2.0)}
    for d in ("f", "b"):
        w[f"x{d}"], w[f"h{d}"] = rng.normal(0, (1 / e) ** 0.5, (e, 4 * h)), rng.normal(0, (1 / h) ** 0.5, (h, 4 * h))
        w[f"c{d}"] = np.r_[np.zeros(h), np.ones(h), np.zeros(2 * h)]
    return {n: a.astype(np.float32) for n, a in w.items()}


def train(windows: list[str], spans: list[list[tuple[int, int, str]]], epochs: int = 18, batch: int = 64, seed: int = 7, rate: float = 5e-3, hidden: int = HIDDEN, say=None, start: tuple[Vocabulary, dict[str, np.ndarray]] | None = None, gate: bool = False) -> tuple[Vocabulary, dict[str, np.ndarray]]:
    """Fit on labelled windows by Adam with a falling rate, from new weights or from given ones."""
    vocabulary = start[0] if start else Vocabulary.of(windows)
    w = dict(start[1]) if start else initial(len(vocabulary), seed, hidden)
    first = {n: np.zeros_like(a) for n, a in w.items()}
    second = {n: np.zeros_like(a) for n, a in w.items()}
    rows = [vocabulary.encode(t) for t in windows]
    gold = [tags_of(len(t), s) for t, s in zip(windows, spans)]
    if gate:
        gold = [[int(x > 0) for x in g] for g in gold]
    rng = np.random.default_rng(seed)
    order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
    groups = [order[i : i + batch] for i in range(0, len(order), batch)]
    step, total = 0, epochs * len(groups)
    for epoch in range(epochs):
        losses = []
        for gi in rng.permutation(len(groups)):
            ids, length = pad([rows[i] for i in groups[gi]])
            tags, _ = pad([gold[i] for i in groups[gi]])
            loss, grad = gradients(w, ids, tags, length)
            norm = np.sqrt(sum(float((a.astype(np.float64) ** 2).sum()) for a in grad.values()))
            step += 1
            lr = rate * (1 - step / (total + 1))
            for n, a in grad.items():
                a = a * min(1.0, 0.3 / (norm + 1e-9))
                first[n] = 0.9 * first[n] + 0.1 * a
                second[n] = 0.998 * second[n] + 0.002 * a * a
                w[n] -= (lr * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.998**step)) + 1e-7)).astype(np.float32)
            losses.append(loss)
        if say:
            say(epoch, float(np.mean(losses)), vocabulary, w)
    return vocabulary, w


def save(path: str, vocabulary: Vocabulary, w: dict[str, np.ndarray], gate: dict[str, np.ndarray] | None = None) -> None:
    both = w | {f"gate_{n}": a for n, a in (gate or {}).items()}
    np.savez_compressed(path, chars=np.frombuffer(vocabulary.chars.encode("utf-32-le"), dtype=np.uint32), **{n: a.astype(np.float16) for n, a in both.items()})


def load(path: str) -> tuple[Vocabulary, dict[str, np.ndarray], dict[str, np.ndarray]]:
    """(vocabulary, weights, the gate's weights); without a gate the last are empty."""
    with np.load(path) as f:
        chars = "".join(map(chr, f["chars"]))
        all_ = {n: f[n].astype(np.float32) for n in f.files if n != "chars"}
    return Vocabulary(chars), {n: a for n, a in all_.items() if not n.startswith("gate_")}, {n[5:]: a for n, a in all_.items() if n.startswith("gate_")}
