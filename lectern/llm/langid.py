"""Problem 1: the language of each text and each of its paragraphs, by rank-order profiles.

A language's profile is its most frequent n-grams of one and three characters, in order (two tell no more). A paragraph's n-grams are
ranked likewise and the sum of how far each is out of place gives the distance to each language; an n-gram that a
profile lacks costs the most. A text that is far from all, or hardly nearer to one, is in none. The profiles are
fitted on a bounded sample of labelled rows (``SAMPLE``), and refined by labelling that sample's paragraphs again, so
wrong labels in it do no harm. All texts are then classified whole, paragraph by paragraph.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.plans.shared import stage_table

#: Labelled rows of each table that profiles are fitted on, about.
SAMPLE = 1500
#: n-grams in a language's profile, and the number of a paragraph's n-grams that are compared.
PROFILE, COMPARED = 300, 60
#: Paragraphs with fewer letters (a Chinese character counts three times) have no language.
LEAST_LETTERS = 18
#: The share by which the second best language must be farther, for texts of at least so many letters.
LEAST_MARGIN = ((0, 0.1), (60, 0.15), (80, 0.22))
#: From this share of letters in capitalised words on these count.
ALL_CAPITALS = 0.95
#: A text farther than this share of the greatest distance from every profile is in none of the languages.
FARTHEST = 0.95

#: The writings of each language's label, lower case, up to the first hyphen or underscore.
LABELS = {
    "en": ("en", "eng", "english"),
    "zh": ("zh", "zho", "chi", "chinese", "cmn"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "francais", "français"),
    "es": ("es", "spa", "spanish", "espanol", "español", "castellano"),
}


def label_code(c: Column) -> Column:
    """The code that a label in any writing names, or null."""
    first = F.lower(F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)[-_\s].*$", ""))
    pairs = [F.lit(x) for code, names in LABELS.items() for n in names for x in (n, code)]
    return F.create_map(*pairs)[F.when(first != "", first)]


_FRONT = re.compile(r"\A\s*---[ \t]*\n.*?\n---[ \t]*(?:\n|\Z)", re.S)
_SKIP = re.compile(
    r"^[ \t]*(?:#{1,6}[ \t].*|<!--.*?-->[ \t]*|(?:chapter|kapitel|chapitre|capítulo|part|section)[ \t]+[\divxlc]+\b.{0,80}"
    r"|第[一二三四五六七八九十百零〇\d]+[章节篇部].{0,40}|(?:source|author|kind|title|type|updated|date|tags|isbn)[ \t]*:.*|[-*_=|:][-*_=|: \t]{2,})$",
    re.I | re.M,
)
_HIDDEN_MAIL = re.compile(r"(?<![\w.+-])[\w.+-]+ ?(?:[\[(]at[\])] ?[\w.-]+|\bat\b ?[\w-]+ ?\bdot\b)(?: ?[\[(]?\bdot\b[\])]? ?[\w-]+| ?[\w-]+)*?(?=[^\w ]|$| [^\[(])", re.I | re.A)
_ANCHOR = re.compile(r"\[{1,2}raw/[^\[\]\n]*\]{1,2}|\[\[[^\[\]\n]*\]\]|<!--.*?-->|https?://[!-~]+", re.A)
_MAIL = re.compile(r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*", re.A)
_QUOTED = re.compile(r"“[^”]{25,}”|„[^“”]{25,}[“”]|«[^»]{25,}»|(?<!\S)»(?=\S)[^«»]{25,}(?<=\S)«|「[^」]{8,}」|『[^』]{8,}』|\"[^\"\n]{25,}\"|“[^”]{8,}”(?<=[一-鿿。！？]”)|‘[^’]{40,}’")
_MARK = re.compile("[“„«»「『\"‘]")
_BULLET = re.compile(r"\n(?=[ \t]*(?:[-*•][ \t]|\d{1,3}[.)][ \t]|[QA]:[ \t]))")
_BLANK = re.compile(r"\n[ \t\r\f\v 　]*\n")
_LEAD = re.compile(r"^[ \t]*(?:[-*•][ \t]+|\d{1,3}[.)][ \t]+|[QA]:[ \t]+)*(?:(?:Inference|Uncertain):[ \t]+)?")


def paragraphs(text: str) -> list[str]:
    """The paragraphs and list items of a text, without headings, front matter, markers, anchors and long quotations."""
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if text.lstrip()[:3] == "---":
        text = _FRONT.sub("", text, count=1)
    text = _SKIP.sub("\n", text)
    out = []
    for block in _BLANK.split(text):
        for p in _BULLET.split(block):
            p = _LEAD.sub("", p.strip())
            if "[" in p or "<" in p or "/" in p:
                p = _ANCHOR.sub(" ", p)
            if "@" in p:
                p = _MAIL.sub(" ", p)
            if "dot" in p or "DOT" in p or "at)" in p or "at]" in p:
                p = _HIDDEN_MAIL.sub(" ", p)
            if _MARK.search(p):
                rest = _QUOTED.sub(" ", p)
                if len(rest) * 4 > len(p):
                    p = rest
            if p and not p.isspace():
                out.append(p)
    return out


def prose(text: str) -> str:
    """A text without headings, markers and anchors, in one piece."""
    text = _SKIP.sub(" ", text)
    return _MAIL.sub(" ", _ANCHOR.sub(" ", text)) if "[" in text or "@" in text else text


_LETTER = np.zeros(0x10000, dtype=np.uint16)
_UPPER = np.zeros(0x10000, dtype=bool)
#: Stands for any Chinese character, beside the character itself.
_HAN = 1 << 50


def _letters() -> np.ndarray:
    if not _LETTER[97]:
        _LETTER[0xE000] = 0xE000
        for i in range(0x10000):
            if (c := chr(i)).isalpha():
                low = c.lower()
                _LETTER[i] = ord(low) if len(low) == 1 and ord(low) < 0x10000 else i
                _UPPER[i] = c.isupper()
    return _LETTER


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letter codes with 0 for each run of other characters, text index of each, letters of each text that count)."""
    joined = "\n" + "\n".join(t.replace("\n", " ") for t in texts) + "\n"
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.cumsum(raw == 10, dtype=np.int32) - 1
    far = np.flatnonzero(raw > 0xFFFF)
    if len(far):  # rare Chinese characters and other letters beyond are each one of their kind
        points, which = np.unique(raw[far], return_inverse=True)
        kinds = [0x4E00 if 0x20000 <= p < 0x33480 else 0xE000 if chr(p).isalpha() else 0 for p in points.tolist()]
        raw = raw.copy()
        raw[far] = np.array(kinds, dtype=raw.dtype)[which]
    code = _letters()[raw]
    full = code != 0
    letters = np.bincount(owner[full], minlength=len(texts) + 1)
    if (wide := code >= 0x2E80).any():
        letters = letters + 2 * np.bincount(owner[wide], minlength=len(texts) + 1)
    # Names say little of the language: capitalised words go, unless the text is written in capitals throughout.
    begins = np.empty_like(full)
    begins[0], begins[1:] = True, full[1:] & ~full[:-1]
    start = np.flatnonzero(begins)
    name = np.repeat(_UPPER[raw[start]], np.diff(np.r_[start, len(code)])) & full
    names = np.bincount(owner[name], minlength=len(texts) + 1)
    running = names < ALL_CAPITALS * np.bincount(owner[full], minlength=len(texts) + 1)
    full &= ~(name & running[owner])
    letters = (letters - np.where(running, names, 0))[: len(texts)]
    code = np.where(full, code, 0)
    keep = np.empty_like(full)
    keep[0], keep[1:] = True, full[1:] | full[:-1]  # runs of other characters to one blank
    keep[-1] = True
    return code[keep], owner[keep], letters


def _orders(code: np.ndarray, owner: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(order, middle positions) of the n-grams without inner blanks, for any Chinese character (0) and orders 1 and 3.

    A Chinese character is a word; it counts alone.
    """
    c0, c1, c2 = code[:-2], code[1:-1], code[2:]
    inner = c1 != 0
    han = (c1 >= 0x4E00) & (c1 < 0xA000)
    one = np.flatnonzero(inner)
    some = han.any()
    three = np.flatnonzero(inner & ~han & ((c0 != 0) | (c2 != 0)) & (owner[:-2] == owner[2:]))
    return [(0, np.flatnonzero(han) if some else np.zeros(0, dtype=np.int64)), (1, one), (3, three)]


def _packed(code: np.ndarray, order: int, at: np.ndarray) -> np.ndarray:
    """The n-grams at these positions as integers."""
    if order == 0:
        return np.full(len(at), _HAN)
    c1 = code[at + 1].astype(np.int64)
    if order == 1:
        return c1
    c0 = code[at].astype(np.int64)
    return c0 << 16 | c1 | 1 << 48 if order == 2 else c0 << 32 | c1 << 16 | code[at + 2].astype(np.int64) | 1 << 49


def _grams(texts: list[str]) -> np.ndarray:
    """All packed n-grams of the texts."""
    code, owner, _ = _codes(texts)
    return np.concatenate([_packed(code, n, at) for n, at in _orders(code, owner)])


#: Odd multipliers that spread the characters of n-grams over a hash table.
_SPREAD = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_APART = [np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF) for n in range(4)]


def _hashed(code: np.ndarray, order: int) -> np.ndarray:
    """A hash of the n-gram around each position."""
    c0, c1, c2 = code[:-2], code[1:-1], code[2:]
    if order == 0:
        return np.zeros(len(c1), dtype=np.uint32)
    h = c1 * _SPREAD[0] + _APART[order]
    if order > 1:
        h += c0 * _SPREAD[1]
    if order > 2:
        h += c2 * _SPREAD[2]
    return h


#: More often than this an n-gram isn't counted.
_MOST = (1 << 22) - 1


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and how often each comes, ``_MOST`` at most."""
    values = np.sort(values)
    new = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, dtype=np.int64)
    return values[new], np.minimum(np.diff(np.r_[new, len(values)]), _MOST)


class Profiles:
    """Rank profiles of some languages over the union of their n-grams."""

    def __init__(self, ranked: dict[str, list[int]]):
        self.ranked = ranked
        self.names = list(ranked)
        keys = sorted({g for grams in ranked.values() for g in grams})
        self.keys = np.array(keys or [-1], dtype=np.int64)
        place = {g: i for i, g in enumerate(keys)}
        self.rank = np.full((len(self.names), len(self.keys)), PROFILE, dtype=np.int32)
        for i, name in enumerate(self.names):
            for r, g in enumerate(ranked[name]):
                self.rank[i, place[g]] = r
        self.stretch = np.array([len(ranked[name]) / COMPARED / 2 for name in self.names])
        order = np.where(self.keys == _HAN, 0, np.where(self.keys >> 49 & 1, 3, np.where(self.keys >> 48 & 1, 2, 1)))
        lo = self.keys & (1 << 48) - 1
        c = np.stack([np.where(order == 3, lo >> 32, np.where(order == 2, lo >> 16, 0)), np.where(order == 3, lo >> 16, lo), np.where(order == 3, lo, 0)]) & 0xFFFF
        code = c.astype(np.uint32)
        h = np.where(order == 0, 0, code[1] * _SPREAD[0] + np.array(_APART)[order])
        h = (h + np.where(order > 1, code[0] * _SPREAD[1], 0) + np.where(order > 2, code[2] * _SPREAD[2], 0)).astype(np.uint32)
        # A table in which each n-gram has a slot of its own; n-grams of one hash share it, and are told apart in a chain.
        bits = 18
        while bits < 24 and len(np.unique(h >> np.uint32(32 - bits))) < len(h):
            bits += 1
        self.shift = np.uint32(32 - bits)
        self.table = np.full(1 << bits, -1, dtype=np.int32)
        self.next = np.full(len(self.keys), -1, dtype=np.int32)
        for i, slot in enumerate((h >> self.shift).tolist()):
            self.next[i] = self.table[slot]
            self.table[slot] = i
        self.chained = bool((self.next >= 0).any())

    def _known(self, code: np.ndarray, wide: np.ndarray, order: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the profiles' n-gram or -1, packed n-gram) at each position."""
        packed = _packed(code, order, at)
        f = self.table[(_hashed(wide, order) >> self.shift)[at]]
        found = np.where(self.keys[f] == packed, f, -1)  # -1 takes the last key, which is -1 or met by its own number
        while self.chained and (more := (f >= 0) & (found < 0)).any():
            f = np.where(more, self.next[f], -1)
            found = np.where((f >= 0) & (self.keys[f] == packed), f, found)
        return found, packed

    def classify(self, texts: list[str]) -> list[tuple[str | None, float]]:
        """The nearest language and its margin over the next (0 to 1), or (None, 0.0) where nothing tells."""
        out: list[tuple[str | None, float]] = []
        for i in range(0, len(texts), 256):
            out += self._classify(texts[i : i + 256])
        return out

    def _classify(self, texts: list[str]) -> list[tuple[str | None, float]]:
        if not self.names:
            return [(None, 0.0)] * len(texts)
        code, owner, letters = _codes(texts)
        wide, t = code.astype(np.uint32), len(texts)
        grams = []
        for order, at in _orders(code, owner):
            f, packed = self._known(code, wide, order, at)
            packed &= (1 << 50) - 1
            packed += 1 << 20  # beyond the numbers of the known ones
            np.copyto(packed, f, where=f >= 0)
            packed |= owner[at + 1].astype(np.int64) << 52
            grams.append(packed)
        gram, often = _runs(np.concatenate(grams))
        known = gram & (1 << 52) - 1 < 1 << 20
        far, size = gram[~known] >> 52, often[~known]
        gram, often = gram[known], often[known]
        gram = gram >> 52 << 20 | gram & (1 << 20) - 1
        # Each text's n-grams, the frequent first, ties by key.
        ranked = np.sort(gram >> 20 << 42 | (_MOST - often) << 20 | gram & (1 << 20) - 1)
        row, often, key = ranked >> 42, _MOST - (ranked >> 20 & (1 << 22) - 1), ranked & (1 << 20) - 1
        place = np.arange(len(row)) - np.searchsorted(row, np.arange(t))[row]
        # n-grams that no profile has take places too: of equal frequency the known ones come first.
        begin = np.searchsorted(far, np.arange(t + 1))
        place += np.searchsorted(np.sort(far << 22 | _MOST - size), row << 22 | _MOST - often) - begin[row]
        there = place < COMPARED
        row, key, place = row[there], key[there], place[there]
        met = np.bincount(row, minlength=t)
        strange = np.minimum(COMPARED - met, np.diff(begin))  # cost the most in every language
        # The place among those compared is stretched to the length of each profile.
        here = (place * self.stretch[:, None]).astype(np.int32)
        rank = self.rank[:, key]
        away = np.where(rank >= PROFILE, PROFILE, np.abs(rank - here))
        dist = np.stack([np.bincount(row, weights=x, minlength=t) for x in away])
        dist = (dist + strange * PROFILE) / np.maximum(1, met + strange)
        best = np.argsort(dist, axis=0, kind="stable")
        cols = np.arange(len(texts))
        first = dist[best[0], cols]
        second = dist[best[1], cols] if len(self.names) > 1 else np.full(len(texts), PROFILE)
        margin = (second - first) / np.maximum(second, 1e-9)
        least = np.array([m for _, m in LEAST_MARGIN])[np.searchsorted([n for n, _ in LEAST_MARGIN], letters, side="right") - 1]
        ok = (letters >= LEAST_LETTERS) & (met > 3) & (margin >= least) & (first <= FARTHEST * PROFILE)
        return [(self.names[best[0, i]], float(margin[i])) if ok[i] else (None, 0.0) for i in range(len(texts))]

def fit(rows: list[tuple[str, str]]) -> Profiles:
    """Profiles of the languages in (label code, text) rows; two rounds of labelling paragraphs anew."""
    paras = [(code, p) for code, text in rows for p in paragraphs(text)]
    model = Profiles({})
    for _ in range(3):
        by: dict[str, list[str]] = {}
        got = model.classify([p for _, p in paras]) if model.names else []
        for i, (code, p) in enumerate(paras):
            at = got[i][0] if got else code
            if at:
                by.setdefault(at, []).append(p)
        ranked = {}
        for code in sorted(by):
            grams, n = np.unique(_grams(by[code]), return_counts=True)
            ranked[code] = grams[np.lexsort((grams, -n))][:PROFILE].tolist()
        model = Profiles(ranked)
    return model


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(code, p) for code, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for p in paragraphs(text)]
        cols = list(zip(*rows)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["code", "text"])


def _gram_counts(ranked):
    """n-grams and their counts by the language that the last profiles give a paragraph, or by its label without any; summed per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(ranked.value)
        for b in batches:
            by: dict[str, list[str]] = {}
            codes, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for code, p in zip([c for c, _ in model.classify(texts)] if model.names else codes, texts):
                if code:
                    by.setdefault(code, []).append(p)
            for code, ps in by.items():
                grams, n = np.unique(_grams(ps), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([code] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(n, pa.int64())], names=["code", "gram", "n"])

    return run


def fit_on(*tables: tuple[DataFrame, str, str, str], sample: int = SAMPLE) -> Profiles:
    """Fit on about ``sample`` labelled rows of each (table, key, label, text), those of the smallest key hashes.

    The n-grams are counted by Spark; only the profiles, ``PROFILE`` n-grams a language, reach the driver.
    """
    rows = None
    for df, key, label, text in tables:
        share = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 30)) / float(1 << 30)
        known = df.select(share.alias("h"), label_code(F.col(label)).alias("code"), F.col(text).alias("text")).where("code is not null")
        n = known.select("h").count()
        some = known.where(F.col("h") < sample / max(n, 1)).where("length(text) > 80").select("code", "text")
        rows = some if rows is None else rows.unionByName(some)
    paras = stage_table(rows.mapInArrow(_sampled, "code string, text string"), "language-sample")
    ranked: dict[str, list[int]] = {}
    for _ in range(3):
        ref = paras.sparkSession.sparkContext.broadcast(ranked)
        counts = paras.mapInArrow(_gram_counts(ref), "code string, gram bigint, n bigint").groupBy("code", "gram").agg(F.sum("n").alias("n"))
        place = F.row_number().over(Window.partitionBy("code").orderBy(F.desc("n"), "gram"))
        ranked = {}
        for r in counts.withColumn("place", place).where(F.col("place") <= PROFILE).orderBy("code", "place").collect():
            ranked.setdefault(r.code, []).append(r.gram)
    return Profiles(ranked)


def main_language(found: list[tuple[str | None, float]], texts: list[str]) -> tuple[str | None, float]:
    """The language of most characters of the paragraphs, and the share of those it holds times its mean confidence."""
    size: dict[str, float] = {}
    sure: dict[str, float] = {}
    for (code, conf), p in zip(found, texts):
        if code:
            n = len(p) * (3 if code == "zh" else 1)
            size[code] = size.get(code, 0) + n
            sure[code] = sure.get(code, 0) + n * conf
    if not size:
        return None, 0.0
    best = max(sorted(size), key=size.get)
    return best, sure[best] / sum(size.values())


def texts_languages(texts: list[str | None], model: Profiles) -> list[tuple[list[str], list[tuple[str | None, float]]]]:
    """(paragraphs, their languages) of each text; a null text has none."""
    cut = [paragraphs(t) if t else [] for t in texts]
    flat = model.classify([p for ps in cut for p in ps])
    out, at = [], 0
    for ps in cut:
        found = flat[at : at + len(ps)]
        at += len(ps)
        out.append((ps, found))
    return out


def _segments(model_ref, with_paragraphs: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(model_ref.value)
        for b in batches:
            for start in range(0, b.num_rows, 500):
                part = b.slice(start, 500)
                keys = part.column(0).to_pylist()
                rows: list[tuple] = []
                for key, (ps, found) in zip(keys, texts_languages(part.column(1).to_pylist(), model)):
                    if with_paragraphs:
                        rows += [(key, i + 1, code, conf) for i, (code, conf) in enumerate(found)]
                    else:
                        code, conf = main_language(found, ps)
                        rows.append((key, code, conf, sorted({c for c, _ in found if c})))
                if with_paragraphs:
                    names = ["rec_key", "segment", "language", "confidence"]
                    kinds = [pa.string(), pa.int32(), pa.string(), pa.float64()]
                else:
                    names = ["rec_key", "language", "confidence", "languages"]
                    kinds = [pa.string(), pa.string(), pa.float64(), pa.list_(pa.string())]
                cols = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return run


def detect(df: DataFrame, key: str, text: str, model: Profiles, segments: bool = False) -> DataFrame:
    """Language and confidence of each row's text, or of each of its paragraphs.

    Texts: ``rec_key, language, confidence, languages``, the last holding every language with a whole paragraph;
    null, empty and wordless texts have a null language and confidence 0. Paragraphs: ``rec_key, segment, language,
    confidence``. No shuffle; the broadcast profiles are of fixed size (``PROFILE`` n-grams a language).
    """
    ref = df.sparkSession.sparkContext.broadcast(model.ranked)
    kind = "rec_key string, segment int, language string, confidence double" if segments else "rec_key string, language string, confidence double, languages array<string>"
    return df.select(F.col(key).cast("string").alias("rec_key"), F.col(text).alias("text")).mapInArrow(_segments(ref, segments), kind)


def profiles_of(md_doc: DataFrame, documents: DataFrame) -> Profiles:
    return fit_on((documents, "doc_id", "lang", "text"), (md_doc, "stem", "language", "text"))


def mislabelled(md_doc: DataFrame, run_status: DataFrame, documents: DataFrame) -> DataFrame:
    """``tbl, rec_key, language``: languages with a whole paragraph in a record's text that its label doesn't name."""
    model = profiles_of(md_doc, documents)
    label = lambda c: F.coalesce(label_code(F.col(c)), F.lit(""))

    def rows(tbl: str, df: DataFrame) -> DataFrame:
        return df.where("language <> label and rec_key is not null").select(F.lit(tbl).alias("tbl"), "rec_key", "language")

    docs = documents.select(F.concat_ws("|", F.col("doc_id").cast("string"), label("lang")).alias("k"), "text")
    docs = detect(docs, "k", "text", model).select(
        F.substring_index("rec_key", "|", 1).alias("rec_key"), F.substring_index("rec_key", "|", -1).alias("label"), F.explode("languages").alias("language")
    )
    books = md_doc.where("stem is not null").select(F.concat(label("language"), F.lit("|"), "stem").alias("k"), "text")
    books = detect(books, "k", "text", model).select(
        F.expr("substr(rec_key, instr(rec_key, '|') + 1)").alias("rec_key"), F.substring_index("rec_key", "|", 1).alias("label"), F.explode("languages").alias("language")
    )
    books = stage_table(books, "book-languages")
    runs = run_status.select(F.col("run_id").cast("string").alias("run"), "stem", label("language").alias("label"))
    runs = runs.join(books.select(F.col("rec_key").alias("stem"), "language").distinct(), "stem").select(F.col("run").alias("rec_key"), "label", "language")
    return rows("md_doc", books).distinct().unionByName(rows("documents", docs)).unionByName(rows("run_status", runs).distinct())
