"""Problem 6: noise in text from scanned pages.

Headers and footers are lines at page edges that come again within a book, up to a few misread characters, or that
repeat the book's own title or a chapter mark at a page break. Page numbers are lines that hold nothing but a number
which rises with the pages of the book. The rest is joined to paragraphs. A hyphen at a line's end is judged by the
vocabulary of the whole corpus: the word is joined where it is known joined, keeps its hyphen where it is known as a
compound, and stays in two where the halves are words and the second is as frequent as only words like "and" are.
Misread words are told by the frequent word that has the same skeleton (what remains of a word when the characters that
scanners mix up are made equal). Whether a chunk is a scan is seen from its hard line ends, as the status labels can't
be trusted.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.names import osa, segments
from lectern.plans.shared import stage_table

#: The least share of line ends inside sentences that marks a scan.
WRAPPED = 0.42
#: Pages that may be missing between two page numbers of a sequence, and for each missing chunk.
GAP, CHUNK_GAP = 3, 8
#: Chunks of a book whose page numbers are put in order together, so that a book of any length is split.
BOOK_PART = 200
#: The most frequent safe words, which go to the workers so that most words need no join; all others are joined.
SAFE_WORDS = 20_000
#: A second half with this share of all words is a word like "and", before which a hyphen is no break.
FREQUENT = 0.002
#: A word is misread if one of its skeleton is so many times as frequent: rare words, others.
RARE_RATIO, RATIO = 3, 20
#: Signs for a broken word at a line's end.
HYPHENS = "-‐¬­"

#: What scanners mix up; a character becomes the smallest strokes that it may be taken for.
_CHARS = str.maketrans(
    {"1": "i", "!": "i", "l": "i", "|": "i", "e": "c", "f": "t", "0": "o", "5": "s", "@": "a", "9": "g", "6": "é", "ı": "i"}
    | {"u": "ii", "h": "ii", "b": "ii", "ü": "ii", "d": "ci", "w": "vv", "n": "ri", "m": "rri"}
)
_PAGE = re.compile(
    r"^(?P<before>[\W_]*)(?P<sign>(?:page|seite|p[áa]gina|p|s|pp|第)[\s.]*)?(?:(?P<number>\d[\dlIO]{0,4})|(?P<roman>[ivxlc]+))\s*(?P<han>页)?\s*(?P<of>[/／]\s*\d{1,5}|(?:of|von|de|sur)\s+\d{1,5})?(?P<after>[\W_]*)$",
    re.I,
)
_ROMAN = re.compile(r"(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})|c{1,3}(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})", re.I)
_NUMBERED = re.compile(r"^\s*\d{1,4}\s{2,}\S|\S\s{2,}\d{1,4}\s*$")
_CHAPTER = re.compile(r"^\W*(?:ch[a@]p[tf][e3c]r|kapitel|chapitre|cap[íi]tulo|part|section)\W+[\divxlc]+\b|^\W*第.{1,4}[章节篇部]", re.I)
_ENDED = re.compile(r"[.!?。！？:：\]»”>]\s*$")
_ROWS = re.compile(r"^\s*(?:<!--|\d[\d.,]*(?:\s{2,}\d[\d.,]*)+\s*$|#|[-*•]\s)")
_EDGE_WORD = re.compile(r"([^\W\d_][^\s]*?)([-‐¬­])\s*$")
_TOKEN = re.compile(r"(?:[^\W_]|[@!|'’­])+(?:[-‐](?:[^\W_]|[@!|'’])+)*")


def skeleton(word: str) -> str:
    """Equal for a word and its likely misreadings."""
    s = unicodedata.normalize("NFKC", word).lower().replace("\u00ad", "").translate(_CHARS)
    return s.replace("iri", "rri")


def line_skeleton(line: str) -> str:
    """The skeleton of a header without the page number at either end."""
    s = re.sub(r"^[\s\W]*\d{1,4}\s{2,}|\s{2,}\d{1,4}[\s\W]*$", "", line.replace("\f", ""))
    return re.sub(r"[\W_]+", "", skeleton(s))


def is_scan(text: str) -> bool:
    """Whether lines mostly end inside sentences, where another line follows at once."""
    lines = text.split("\n")
    pairs = [(a, b) for a, b in zip(lines, lines[1:]) if a.strip() and b.strip()]
    wrapped = sum(not _ENDED.search(a) and not _ROWS.match(a) and not _ROWS.match(b) for a, b in pairs)
    return bool(pairs) and wrapped >= WRAPPED * len(pairs)


def _roman(s: str) -> int:
    values = [dict(i=1, v=5, x=10, l=50, c=100)[c] for c in s.lower()]
    return sum(-v if v < max(values[i:]) else v for i, v in enumerate(values))


def page_marks(lines: list[str]) -> dict[int, tuple[int, bool]]:
    """(number, whether a sign beside it says that it is a page's) of the lines that hold one number only, by index.

    Roman numbers must be written as such: neither ``civil`` nor ``mix`` is one.
    """
    out = {}
    for i, x in enumerate(lines):
        if not (m := _PAGE.match(x.strip())):
            continue
        if m["roman"] and not _ROMAN.fullmatch(m["roman"]):
            continue
        value = _roman(m["roman"]) if m["roman"] else int(m["number"].translate(str.maketrans("lIO", "110")))
        bracketed = m["before"].strip()[:1] in tuple("[(-–—") and m["after"].strip()[:1] in tuple("])-–—")
        out[i] = value, bool(m["sign"] or m["han"] or m["of"] or bracketed)
    return out


def edge_lines(lines: list[str], pages: Collection[int], stem: str) -> list[tuple[int, str, bool, bool]]:
    """(index, skeleton, certain, placed) of lines at page edges that look like headers.

    Certain ones needn't come again; placed ones stand at a sign of a page's edge, the others at the chunk's.
    """
    full = [i for i, x in enumerate(lines) if x.strip()]
    place = {i: n for n, i in enumerate(full)}
    title = re.sub(r"[\W_]+", "", skeleton(stem))
    width = max(map(len, lines), default=0)
    out = []
    for n, i in enumerate(full):
        x = lines[i]
        text = x.replace("\f", "").strip()
        if i in pages or (_ENDED.search(text) and not _CHAPTER.match(text)) or text[-1:] in ",;，；、" or _EDGE_WORD.search(text):
            continue
        first = next((c for c in text if c.isalpha()), "")
        if not first or first.islower():
            continue
        han = "一" <= first <= "鿿"
        if han and (re.search("[，。；：！？]", text) or len(text) > 0.7 * width):
            continue
        broken = "\f" in x or (n > 0 and lines[i - 1].strip() == "" and "\f" in lines[i - 1])
        near = any(0 <= n + d < len(full) and full[n + d] in pages for d in (-1, 1))
        numbered = bool(_NUMBERED.search(x))
        edge = n <= 1 or n >= len(full) - 2 or any(0 <= n + d < len(full) and full[n + d] in pages for d in (-2, 2))
        code = line_skeleton(x)
        capitals = not han and not any(c.islower() for c in text) and sum(c.isalpha() for c in text) > 3
        named = code == title or bool(_CHAPTER.match(text))
        if not code or not (broken or near or numbered or edge or capitals or named):
            continue
        certain = code == title or (capitals and named) or ((broken or near or numbered) and (named or capitals or han)) or (named and n == 0)
        out.append((i, code, certain, broken or near or numbered or capitals or named))
    return out


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines that may be headers (with a skeleton) or page numbers (with a number)."""
    for b in batches:
        rows = []
        for key, stem, index, low, high, text in zip(*(b.column(i).to_pylist() for i in range(6))):
            if text and is_scan(text):
                lines, stem = text.split("\n"), stem or ""
                pages = page_marks(lines)
                rows += [(key, stem, index, i, *found, None) for i, *found in edge_lines(lines, pages, stem)]
                for i, (value, marked) in pages.items():
                    within = low is not None and high is not None and low - 1 <= value <= high + 1
                    rows.append((key, stem, index, i, None, marked or within, True, value))
        cols = list(zip(*rows)) or [()] * 8
        kinds = [b.column(0).type, pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["chunk_id", "stem", "chunk_index", "line", "code", "certain", "placed", "value"])


def header_errors(length: int) -> int:
    """Misread characters that two copies of a header may differ by."""
    return 0 if length < 6 else 1 if length < 16 else 2


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The segments of each skeleton (``typed`` false), and what they are looked up by (true); see ``names``.

    With k errors in k+1 segments some segment is unharmed that has no more errors before it than segments, and no more
    after it, so that its shift is bounded on both sides.
    """
    for b in batches:
        rows = []
        for stem, code in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            n = len(code)
            for i, text, _ in segments(code, header_errors(n) + 1):
                rows.append((stem, code, False, n, i, text))
            for size in range(max(1, n - 2), n + 3):
                k, more = header_errors(size), n - size
                if abs(more) > k:
                    continue
                for i, cut, at in segments("x" * size, k + 1):
                    width = len(cut)
                    starts = {at + x for x in range(-i, i + 1) if abs(x - more) <= k - i and 0 <= at + x <= n - width}
                    rows += [(stem, code, True, size, i, text) for text in {code[x : x + width] for x in starts}]
        cols = list(zip(*rows)) or [()] * 6
        kinds = [pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["stem", "code", "typed", "size", "part", "text"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        stem, one, other = (b.column(i).to_pylist() for i in range(3))
        figures = lambda s: re.sub(r"\D", "", s)
        ok = [figures(x) == figures(y) and osa(x, y, header_errors(len(y))) <= header_errors(len(y)) for x, y in zip(one, other)]
        yield pa.RecordBatch.from_arrays([pa.array([v for v, k in zip(c, ok) if k], pa.string()) for c in (stem, one, other)], names=["stem", "code", "other"])


def _repeated(edges: DataFrame) -> DataFrame:
    """``stem, code`` of the skeletons that come again within the book or are certain; placed ones up to ``header_errors``."""
    codes = edges.where("code is not null").groupBy("stem", "code").agg(F.count("*").alias("n"), F.max("certain").alias("sure"), F.max("placed").alias("placed"))
    codes = stage_table(codes, "scan-codes")
    exact = codes.where("n > 1 or sure").select("stem", "code")
    pieces = codes.where("placed").select("stem", "code").mapInArrow(_pieces, "stem string, code string, typed boolean, size int, part int, text string")
    pieces = stage_table(pieces, "scan-pieces")
    index = pieces.where("not typed").select("stem", "size", "part", "text", F.col("code").alias("other"))
    pairs = pieces.where("typed").join(index, ["stem", "size", "part", "text"]).where("code <> other").select("stem", "code", "other").distinct()
    near = pairs.mapInArrow(_near, "stem string, code string, other string")
    return exact.unionByName(near.select("stem", "code")).distinct()


def _page_numbers(edges: DataFrame) -> DataFrame:
    """``chunk_id, line`` of the numbers that belong to a sequence rising with the pages of their book, or are marked as page numbers.

    Books are put in order in parts of ``BOOK_PART`` chunks, which share a chunk at their borders.
    """
    part = F.floor(F.col("chunk_index") / BOOK_PART)
    place = F.pmod("chunk_index", F.lit(BOOK_PART))
    parts = F.filter(F.array(part, F.when(place < 2, part - 1), F.when(place >= BOOK_PART - 2, part + 1)), lambda x: x.isNotNull())
    rows = edges.where("value is not null").select("*", part.alias("home"), F.explode(parts).alias("part"))
    order = Window.partitionBy("stem", "part").orderBy("chunk_index", "chunk_id", "line")

    def follows(a: Column, b: Column, chunks: Column) -> Column:
        return (b > a) & (b - a <= GAP + CHUNK_GAP * F.greatest(chunks - 1, F.lit(0)))

    # An equal number in the next chunk is the same page's; the one beyond it tells.
    at = lambda c, n: F.lag(c, n).over(order) if n > 0 else F.lead(c, -n).over(order)
    rows = rows.select(
        "*", *[at(c, n).alias(f"{c}{i}") for c in ("value", "chunk_index") for i, n in enumerate((1, 2, -1, -2))]
    )
    v, x = F.col("value"), F.col("chunk_index")
    before = [follows(F.col(f"value{i}"), v, x - F.col(f"chunk_index{i}")) for i in (0, 1)]
    after = [follows(v, F.col(f"value{i}"), F.col(f"chunk_index{i}") - x) for i in (2, 3)]
    between = follows(F.col("value0"), F.col("value2"), F.col("chunk_index2") - F.col("chunk_index0")) & (F.col("value2") - F.col("value0") >= 2)
    between &= F.length(v.cast("string")).isin(F.length(F.col("value0").cast("string")), F.length(F.col("value2").cast("string")))  # a misread figure
    near = lambda i, j: F.coalesce(before[i], F.lit(False)) if j else F.coalesce(after[i], F.lit(False))
    good = F.col("certain") | near(0, 1) | near(1, 1) | near(0, 0) | near(1, 0) | F.coalesce(between, F.lit(False))
    return rows.where((F.col("part") == F.col("home")) & good).select("chunk_id", "line").distinct()


def running_text(text: str, headers: Collection[int] | None, pages: Collection[int] | None = None) -> tuple[list[str], list[str | None], list[int]]:
    """(lines, kinds, indices of the running text); kinds are header, page_no or None."""
    lines = text.split("\n")
    pages, heads = set(pages or ()), set(headers or ())
    kinds = ["header" if i in heads else "page_no" if i in pages else None for i in range(len(lines))]
    return lines, kinds, [i for i, x in enumerate(lines) if not kinds[i] and x.strip()]


def tokens(lines: list[str], body: list[int]) -> list[tuple[int, int | None, str, int]]:
    """(line, line of the second half or None, word, length of the first half) of the running text's words.

    A hyphen at a line's end parts a word if the next line begins with letters.
    """
    out: list[tuple[int, int | None, str, int]] = []
    carried: tuple[int, str] | None = None
    for n, i in enumerate(body):
        x = lines[i].replace("\f", "").rstrip()
        cut = _EDGE_WORD.search(x) if n + 1 < len(body) else None
        ahead = _TOKEN.match(lines[body[n + 1]].strip()) if cut else None
        goes_on = bool(ahead) and any(c.isalpha() for c in ahead.group())
        words = [m.group().lstrip("'’|\u00ad").rstrip("'’!|\u00ad") for m in _TOKEN.finditer(x[: cut.start(2)] if goes_on else x)]
        words = [w for w in words if w]
        if carried and words:
            out.append((carried[0], i, carried[1] + words[0], len(carried[1])))
            words = words[1:]
        carried = None
        if goes_on and words:
            carried = (i, words.pop())
        out += [(i, None, w, len(w)) for w in words]
    return out


def _odd_inside(w: str) -> bool:
    """A sign or figure inside a word that no word has."""
    if "@" in w or "!" in w or "|" in w:
        return w.count("@") < 2 and any(c.isalpha() for c in w)
    return bool(re.search(r"[^\W\d_][01569][^\W\d_]", w)) and sum(c.isdigit() for c in w) <= 2


def _counted(w: str) -> bool:
    return len(w) > 1 and not w.isdigit() and not "一" <= w[0] <= "鿿"


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and how often they come in texts that are no scans, in scans, and broken at a line's end; summed per batch."""
    for b in batches:
        clean: Counter[str] = Counter()
        scan: Counter[str] = Counter()
        broken: Counter[str] = Counter()
        for text, headers, pages in zip(*(b.column(i).to_pylist() for i in range(3))):
            if not text:
                continue
            if not is_scan(text):
                clean.update(re.findall(r"[^\W\d_]{2,}(?:['’-][^\W\d_]+)*", text.lower()))
                continue
            lines, _, body = running_text(text, headers, pages)
            for _, j, w, _ in tokens(lines, body):
                if _counted(w):
                    (scan if j is None else broken)[w.lower()] += 1
        words = list(clean.keys() | scan.keys() | broken.keys())
        cols = [pa.array(words, pa.string())] + [pa.array([c[w] for w in words], pa.int64()) for c in (clean, scan, broken)]
        yield pa.RecordBatch.from_arrays(cols, names=["word", "clean", "scan", "broken"])


def _lines(safe):
    """Furniture, broken words with their halves, and the words of scans that are not known to be safe."""
    names = ["chunk_id", "line_no", "kind", "word", "next_no", "cut"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = safe.value
        for b in batches:
            rows: list[tuple] = []
            for key, text, headers, pages in zip(*(b.column(i).to_pylist() for i in range(4))):
                if not text or not is_scan(text):
                    continue
                lines, kinds, body = running_text(text, headers, pages)
                rows += [(key, i + 1, k, None, None, None) for i, k in enumerate(kinds) if k]
                for i, j, w, cut in tokens(lines, body):
                    if j is not None:
                        rows.append((key, i + 1, "hyphen", w.lower(), j + 1, cut))
                    if (low := w.lower()) not in known and _counted(w):
                        rows.append((key, i + 1, "word", low, None if j is None else j + 1, cut))
            cols = list(zip(*rows)) or [()] * 6
            kinds_ = [b.column(0).type, pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds_)], names=names)

    return run


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words = b.column(0).to_pylist()
        odd = pa.array([_odd_inside(w) for w in words], pa.bool_())
        code = pa.array([skeleton(w) for w in words], pa.string())
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), code, odd], names=["word", "clean", "scan", "broken", "code", "odd"])


def _vocabulary(rows: DataFrame) -> DataFrame:
    """``word, clean, scan, broken, code, odd`` of every word of the corpus."""
    count = rows.select("text", "headers", "pages").mapInArrow(_counts, "word string, clean bigint, scan bigint, broken bigint")
    count = count.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("clean", "scan", "broken")])
    return stage_table(count.mapInArrow(_skeletons, "word string, clean bigint, scan bigint, broken bigint, code string, odd boolean"), "scan-words")


def _strange() -> Column:
    """Whether texts without scans use the word so much less than scans that it may be misread."""
    return (F.col("clean") == 0) | (F.col("scan") + F.col("broken") > 4 * F.col("clean"))


def misread_words(count: DataFrame) -> DataFrame:
    """``word, meant``: the misread words of scans and what they stand for, null where only the sign inside tells.

    Counts are over the whole corpus. A word that texts without scans use at about the same rate is never misread.
    """
    n = F.col("clean") + F.col("scan") + F.col("broken")
    best = count.where("not odd").groupBy("code").agg(F.max(F.struct(n.alias("n"), "word")).alias("best"))
    rows = count.where("scan + broken > 0").join(best, "code", "left")
    ratio = F.when(n <= 2, RARE_RATIO).otherwise(RATIO)
    other = (F.col("best.word") != F.col("word")) & (F.col("best.n") >= ratio * n) & _strange()
    return rows.where(other | F.col("odd")).select("word", F.when(F.col("best.word") != F.col("word"), F.col("best.word")).alias("meant"))


def judge_breaks(breaks: DataFrame, count: DataFrame) -> DataFrame:
    """``first, second, how`` of the halves at line ends, by counts of the corpus without such breaks.

    ``join`` where the joined word is known at least as well as the hyphenated one, ``keep`` where only that is known, or
    where the halves are words and the first makes compounds (it has a hyphen itself or comes before one elsewhere),
    ``apart`` where both are words and the second is one like "and", else ``join``.
    """
    pairs = breaks.select("first", "second").distinct()
    known = count.where("clean + scan > 0").select("word", (F.col("clean") + F.col("scan")).alias("n"))
    heads = known.where("instr(word, '-') > 0").select(F.regexp_extract("word", "^(.*?)-", 1).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n"))
    known = known.select("word", F.lit("").alias("as"), "n").unionByName(heads.select("word", F.lit("head").alias("as"), "n"))
    total = known.where("as = ''").agg(F.sum("n")).first()[0] or 0
    forms = F.array(
        *[
            F.struct(F.lit(name).alias("form"), word.alias("word"), F.lit(as_).alias("as"))
            for name, word, as_ in (
                ("joined", F.concat("first", "second"), ""), ("hyphened", F.concat("first", F.lit("-"), "second"), ""), ("a", F.col("first"), ""), ("b", F.col("second"), ""), ("head", F.col("first"), "head"),
            )
        ]
    )
    rows = pairs.select("first", "second", F.explode(forms).alias("f")).select("first", "second", "f.*").join(known, ["word", "as"], "left")
    sums = rows.groupBy("first", "second").agg(*[F.coalesce(F.sum(F.when(F.col("form") == f, F.col("n"))), F.lit(0)).alias(f) for f in ("joined", "hyphened", "a", "b", "head")])
    words = (F.col("b") > 0) & ((F.col("a") > 0) | (F.instr("first", "-") > 0) | (F.col("head") > 0))
    how = (
        F.when((F.col("joined") > 0) & (F.col("joined") >= F.col("hyphened")), "join").when(F.col("hyphened") > 0, "keep")
        .when((F.col("a") > 0) & (F.col("b") >= FREQUENT * total), "apart")
        .when(words & ((F.instr("first", "-") > 0) | (F.col("head") > 0)), "keep").otherwise("join")
    )
    return sums.select("first", "second", how.alias("how"))


def _found(chunk: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(lines of scans, breaks with how to mend them, misread words, chunks with their furniture)."""
    kind = dict(chunk.dtypes)["chunk_id"]
    column = lambda c: F.col(c).cast("bigint") if c in chunk.columns else F.lit(None).cast("bigint")
    source = chunk.select("chunk_id", "stem", F.coalesce(column("chunk_index"), F.lit(0)).alias("chunk_index"), column("start_page").alias("low"), column("end_page").alias("high"), "text")
    edges = source.mapInArrow(_edges, f"chunk_id {kind}, stem string, chunk_index bigint, line int, code string, certain boolean, placed boolean, value bigint")
    edges = stage_table(edges, "scan-edges")
    heads = edges.join(_repeated(edges), ["stem", "code"]).select("chunk_id", "line", F.lit("header").alias("kind"))
    furniture = heads.unionByName(_page_numbers(edges).select("chunk_id", "line", F.lit("page_no").alias("kind")))
    lines_of = lambda k: F.collect_set(F.when(F.col("kind") == k, F.col("line")))
    furniture = furniture.groupBy("chunk_id").agg(lines_of("header").alias("headers"), lines_of("page_no").alias("pages"))
    rows = chunk.select("chunk_id", "text").join(furniture, "chunk_id", "left").select("chunk_id", "text", "headers", "pages")
    rows = stage_table(rows, "scan-texts")
    count = _vocabulary(rows)
    safe = count.where(~F.col("odd") & ~_strange()).orderBy(F.desc(F.col("scan") + F.col("broken")), "word").limit(SAFE_WORDS)
    safe = chunk.sparkSession.sparkContext.broadcast(frozenset(r.word for r in safe.select("word").collect()))
    found = rows.mapInArrow(_lines(safe), f"chunk_id {kind}, line_no int, kind string, word string, next_no int, cut int")
    found = stage_table(found, "scan-lines")
    halves = [F.expr("left(word, cut)").alias("first"), F.expr("substr(word, cut + 1)").alias("second")]
    breaks = found.where("kind = 'hyphen'").select("chunk_id", "line_no", *halves)
    breaks = breaks.join(judge_breaks(breaks, count), ["first", "second"])
    return found, breaks, misread_words(count), rows


def noisy_lines(chunk: DataFrame) -> DataFrame:
    """``chunk_id, line_no, kind`` of each line of scans with furniture, a broken word or a misread word.

    Null and empty texts and texts that are no scans have none; each line and kind comes once, repeated chunk ids
    under their id. Books of any length are only counted, never gathered.
    """
    found, breaks, bad, _ = _found(chunk)
    words = found.where("kind = 'word'").join(bad, "word")
    differs = F.expr("coalesce(get(filter(sequence(1, greatest(1, cut)), i -> substr(word, i, 1) <> substr(meant, i, 1)), 0), cut + 1)")
    line = F.when(F.col("next_no").isNotNull() & (differs > F.col("cut")), F.col("next_no")).otherwise(F.col("line_no"))
    chars = words.select("chunk_id", line.alias("line_no"), F.lit("chars").alias("kind"))
    broken = breaks.where("how <> 'apart'").select("chunk_id", "line_no", F.lit("hyphen").alias("kind"))
    return found.where("kind in ('header', 'page_no')").select("chunk_id", "line_no", "kind").unionByName(broken).unionByName(chars).distinct()


def rebuild(text: str, headers: list[int] | None, pages: list[int] | None, fixes: dict[str, str], breaks: dict[int, str]) -> str:
    """The running text as paragraphs: furniture dropped, words joined and corrected; breaks has how to mend a line's end."""
    if not is_scan(text):
        return text
    lines, kinds, _ = running_text(text, headers, pages)

    def fix(m: re.Match) -> str:
        good = fixes.get(m.group().lower())
        if not good:
            return m.group()
        return good.upper() if m.group().isupper() and len(good) > 1 else good[0].upper() + good[1:] if m.group()[0].isupper() else good

    out, current, gap, last = [], "", False, -1
    for i, x in enumerate(lines):
        if kinds[i]:
            gap = True
            continue
        line = x.replace("\f", "")
        if not line.strip():
            if current and not gap and not _EDGE_WORD.search(current):
                out.append(current)
                current = ""
            continue
        indented = bool(re.match(r"^(?:\s{3,}|　)", line)) and bool(_ENDED.search(current))
        if indented and current:
            out.append(current)
            current = ""
        gap = False
        line = line.strip()
        how = breaks.get(last + 1)
        if not current:
            current = line
        elif how in ("join", "keep") and (m := _EDGE_WORD.search(current)):
            current = (current[: m.start(2)] if how == "join" else current[: m.end(2)]) + line
        else:
            han = "⺀" <= current[-1] <= "￯" and "⺀" <= line[0] <= "￯"
            current = current + ("" if han else " ") + line
        last = i
    if current:
        out.append(current)
    return "\n\n".join(_TOKEN.sub(fix, p) for p in out)


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        done = []
        for text, headers, pages, fixes, breaks in zip(*(b.column(i).to_pylist() for i in range(1, 6))):
            words = {f["word"]: f["meant"] for f in fixes or []}
            done.append(None if text is None else rebuild(text, headers, pages, words, {x["line_no"]: x["how"] for x in breaks or []}))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(done, pa.string())], names=["chunk_id", "text"])


def repaired(chunk: DataFrame) -> DataFrame:
    """``chunk_id, text``: every chunk, those of scans as continuous paragraphs; null stays null."""
    found, breaks, bad, rows = _found(chunk)
    bad = bad.where("meant is not null")
    fixes = found.where("kind = 'word'").select("chunk_id", "word").join(bad, "word").groupBy("chunk_id").agg(F.collect_set(F.struct("word", "meant")).alias("fixes"))
    ends = breaks.groupBy("chunk_id").agg(F.collect_set(F.struct("line_no", "how")).alias("breaks"))
    kind = dict(chunk.dtypes)["chunk_id"]
    rows = rows.join(fixes, "chunk_id", "left").join(ends, "chunk_id", "left")
    return rows.select("chunk_id", "text", "headers", "pages", "fixes", "breaks").mapInArrow(_rebuilt, f"chunk_id {kind}, text string")
